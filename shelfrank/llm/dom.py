"""A light DOM of block nodes for text extraction, and features of its nodes.

`parse` reads any byte soup of HTML without failing: raw-text elements are
skipped whole, unclosed paragraphs and list items close where HTML closes them,
unknown tags are inline. Inline elements join their block; text directly in a
container that also holds blocks becomes a node of its own (tag "#text").

Hidden and skipped elements stand on the stack like others, so the same rules
end them: their end tag, that of an element around them, or a start tag that
closes them. A head holds nothing but raw-text and void elements, so its tags
need no rule: whatever else follows is the body, as in HTML.
"""

from __future__ import annotations

import html
import math
import re
from bisect import bisect_left
from collections import Counter, defaultdict

import numpy as np

from shelfrank.llm.common import ship

ship(__name__)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^\"'>]|\"[^\"]*\"|'[^']*')*)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'<>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")

# Element kinds of HTML.
BLOCKS = frozenset(
    "html body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section summary table tbody td tfoot "
    "th thead tr ul caption legend option button search".split()
)
SKIPPED = frozenset(
    "script style noscript noframes template svg math iframe object title textarea select audio video canvas".split()
)
_RAW = frozenset("script style noscript noframes template iframe title textarea".split())
VOID = frozenset("area base basefont bgsound br col embed hr img input link meta param source track wbr".split())
_SPACES = frozenset("br hr wbr img input".split())
#: A start tag of the first kind closes an open element of the second.
_CLOSES = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th", "caption", "colgroup"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
    "rt": {"rt", "rp"},
    "rp": {"rt", "rp"},
} | dict.fromkeys(("tbody", "thead", "tfoot"), {"tbody", "thead", "tfoot", "tr", "td", "th", "caption", "colgroup"})
_SCOPES = SKIPPED | frozenset(
    "html body ul ol dl table td th div section article main aside nav form header footer foreignobject".split()
)
#: Elements skipped for what stands in for them; without an end tag they hold nothing.
_STANDINS = frozenset("object audio video canvas".split())
#: Elements of svg and math that hold HTML again, and start tags that end svg and math elsewhere.
_INTEGRATION = frozenset("foreignobject desc title annotation-xml mi mo mn ms mtext".split())
_BREAKOUT = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta "
    "nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split()
)
_TABLE = frozenset("table tbody thead tfoot tr td th caption".split())
_CELLS = ("td", "th", "table")
_MARKERS = _INTEGRATION | {"table", "td", "th", "caption"}
#: A slash at the end of an unquoted attribute value.
_VALUE_SLASH = re.compile(r"=\s*[^\s\"'>]*/\Z")

#: Words of class, id and role values, by what they tell.
LEXICON = {
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toc tabs toolbar topbar skip",
    "chrome": "header footer masthead banner logo copyright legal colophon contentinfo imprint bottom",
    "side": "sidebar aside side widget related recommended popular trending complementary rail more teaser",
    "notice": "cookie cookies consent notice notification popup modal newsletter subscribe signup gdpr alert overlay paywall",
    "advert": "ad ads adv advert adverts advertisement adsense sponsor sponsored promo promotion promoted dfp banner",
    "social": "share sharing social follow like tweet facebook",
    "comment": "comment comments commentlist reply replies respond discussion disqus reader feedback",
    "form": "form search login register contact input field",
    "content": "content article post entry story main body text page prose single hentry",
}
_LEXICON = {w: k for k, words in enumerate(LEXICON.values()) for w in words.split()}

TAG_KINDS = {
    "heading": "h1 h2 h3 h4 h5 h6 hgroup",
    "paragraph": "p blockquote pre",
    "list": "ul ol dl menu dir",
    "item": "li dt dd",
    "nav": "nav",
    "header": "header",
    "footer": "footer address",
    "aside": "aside",
    "form": "form fieldset button option legend dialog search",
    "article": "article",
    "main": "main",
    "box": "div section center details",
    "table": "table tbody thead tfoot tr td th caption",
    "figure": "figure figcaption",
    "text": "#text",
}
_TAG_KIND = {t: k for k, tags in enumerate(TAG_KINDS.values()) for t in tags.split()}

FEATURES = (
    [f"tag_{k}" for k in TAG_KINDS]
    + [f"in_{k}" for k in TAG_KINDS]
    + [f"attr_{k}" for k in LEXICON]
    + [f"above_{k}" for k in LEXICON]
    + ["beside_here", "beside_above", "content_above"]
    + ["depth", "log_chars", "link_density", "tag_density", "chars_per_block", "punctuation", "digits"]
    + ["share_of_parent", "place", "siblings", "same_tag_siblings", "blocks_below"]
)
_KINDS, _WORDS = len(TAG_KINDS), len(LEXICON)
_CONTENT = list(LEXICON).index("content")
#: Tags that surround an article as a rule, and that hold one.
_BESIDE_TAGS = [list(TAG_KINDS).index(k) for k in ("nav", "header", "footer", "aside", "form")]
_CONTENT_TAGS = [list(TAG_KINDS).index(k) for k in ("article", "main")]


class Page:
    """Block nodes in document order (a parent comes before its children) and
    `runs`: (node, text) in page order."""

    def __init__(self) -> None:
        self.tag: list[str] = []
        self.parent: list[int] = []
        self.attrs: list[frozenset[int]] = []
        self.runs: list[tuple[int, str]] = []
        self.linked: dict[int, int] = {}
        self.inline: dict[int, int] = {}

    def add(self, tag: str, parent: int, attrs: frozenset[int]) -> int:
        self.tag.append(tag)
        self.parent.append(parent)
        self.attrs.append(attrs)
        return len(self.tag) - 1


def _marks(attributes: str) -> tuple[frozenset[int], bool]:
    """Lexicon kinds of an element's class, id and role; whether it is hidden."""
    kinds, hidden = set(), False
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), html.unescape(value.strip("\"'"))
        if name in ("class", "id", "role", "aria-label", "itemprop"):
            split = re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower()
            for word in re.split(r"[^a-z]+", split):
                kind = _LEXICON.get(word)
                if kind is not None:
                    kinds.add(kind)
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            hidden = True
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value.lower()):
            hidden = True
    return frozenset(kinds), hidden


def _bars(name: str, tag: str) -> bool:
    """Whether an open element keeps the end tag from the elements around it."""
    if tag not in BLOCKS:
        return name in BLOCKS and tag not in SKIPPED
    if tag in _TABLE:
        return name == "table"
    return name in _MARKERS or tag == "li" and name in ("ul", "ol")


def parse(source: str) -> Page:
    """The page's block nodes and texts."""
    page = Page()
    none: frozenset[int] = frozenset()
    # (tag, its block node, whether it is svg or math)
    stack: list[tuple[str, int, bool]] = [("#root", page.add("body", -1, none), False)]
    held: list[str] = []
    links = 0
    skipping = 0  # place in the stack of the outermost element that is not shown
    last_ends: dict[str, int] = {}
    # Places in the stack of the open elements of each name, and how many there are
    # of each within the element that is not shown: no tag walks the stack.
    places: dict[str, list[int]] = defaultdict(list)
    unseen: Counter[str] = Counter()

    def flush() -> None:
        text = " ".join(html.unescape("".join(held)).split())
        held.clear()
        if text:
            page.runs.append((stack[-1][1], text))

    def say(text: str) -> None:
        held.append(text)
        if links:
            node = stack[-1][1]
            page.linked[node] = page.linked.get(node, 0) + len(text.strip())

    def close(index: int) -> None:
        """Close the open elements from stack[index] up."""
        nonlocal links, skipping
        shown = [tag for tag, _, _ in stack[index : skipping or None]]
        if any(tag in BLOCKS for tag in shown):
            flush()
        links -= sum(tag == "a" for tag in shown)
        for tag, _, _ in stack[index:]:
            places[tag].pop()
        if skipping:
            unseen.subtract(tag for tag, _, _ in stack[max(index, skipping) :])
        del stack[index:]
        if len(stack) <= skipping:
            skipping = 0
            unseen.clear()

    def push(tag: str, node: int, inside: bool) -> None:
        places[tag].append(len(stack))
        if skipping:
            unseen[tag] += 1
        stack.append((tag, node, inside))

    def topmost(names, below: int | None = None) -> int:
        """Highest place of an open element of these names, 0 if there is none."""
        found = (places[n] for n in names if places.get(n))
        if below is None:
            return max((p[-1] for p in found), default=0)
        return max((p[i - 1] for p in found if (i := bisect_left(p, below))), default=0)

    def closable(tag: str) -> int:
        """Place of the element that an end tag closes, 0 if it closes none."""
        at = topmost((tag,))
        if not at or skipping and at >= skipping:
            return at
        if skipping and any(n and _bars(name, tag) for name, n in unseen.items()):
            return 0
        # Cells keep end tags of inline elements from what is around them.
        return at if tag in BLOCKS or topmost(_CELLS, skipping or None) <= at else 0

    def wraps(tag: str) -> bool:
        """Whether the next tag of this name is an end tag."""
        found = re.compile(rf"<(/?){re.escape(tag)}[\s/>]", re.I).search(source, at)
        return found is not None and bool(found[1])

    def ends(tag: str) -> bool:
        """Whether an end tag of this name follows."""
        if tag not in last_ends:
            found = re.finditer(rf"</{re.escape(tag)}[\s/>]", source, re.I)
            last_ends[tag] = max((m.start() for m in found), default=-1)
        return last_ends[tag] >= at

    at, end = 0, len(source)
    while at < end:
        token = _TOKEN.search(source, at)
        stop = token.start() if token else end
        if stop > at and not skipping:
            say(source[at:stop])
        if token is None:
            break
        at = token.end()
        closing, tag, attributes = (token[1], token[2], token[3]) if token[2] else (token[4], token[5], token[6])
        if tag is None:
            continue
        tag = tag.lower()
        if closing:
            within, found = skipping, closable(tag)
            if found:
                close(found)
            if tag in BLOCKS and not within:
                flush()
            continue
        if stack[-1][2] and tag in _BREAKOUT:
            i = len(stack) - 1
            while stack[i - 1][2]:
                i -= 1
            close(i)
        if tag in ("html", "head", "body"):
            if tag == "body":
                page.attrs[0] |= _marks(attributes)[0]
            continue
        if tag in VOID:
            if not skipping:
                if tag in _SPACES:
                    held.append(" ")
                if tag == "hr":
                    flush()
            continue
        marks, hidden = _marks(attributes) if attributes else (none, False)
        foreign = stack[-1][2]
        skipped = hidden or tag in SKIPPED
        # HTML knows no empty elements but the void ones, yet pages written as XML have them.
        slash = attributes.endswith("/") and not _VALUE_SLASH.search(attributes)
        if slash and (foreign or tag not in BLOCKS and not ((tag in SKIPPED or tag == "a") and wraps(tag))):
            if not skipping and not skipped:
                node = stack[-1][1]
                page.inline[node] = page.inline.get(node, 0) + 1
            continue
        if tag in _RAW and (not foreign or tag in ("script", "style")):
            found = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(source, at) if ends(tag) else None
            if found is not None:
                at = source.find(">", found.start()) + 1 or end
                held.append(" ")
                continue
            if not foreign:
                break
        if tag in _STANDINS and not ends(tag):
            continue
        closed = _CLOSES.get(tag, set()) | ({"p"} if tag in BLOCKS else set())
        while closed and (found := topmost(closed)) and found >= topmost(_SCOPES):
            close(found)
            if stack[-1][0] not in closed:
                break
        if skipping or skipped:
            if not skipping:
                skipping = len(stack)
                held.append(" ")
            inside = tag in ("svg", "math") or foreign and tag not in _INTEGRATION
            push(tag, stack[-1][1], inside)
        elif tag in BLOCKS:
            flush()
            push(tag, page.add(tag, stack[-1][1], marks), False)
        else:
            node = stack[-1][1]
            page.inline[node] = page.inline.get(node, 0) + 1
            links += tag == "a"
            push(tag, node, False)
    flush()
    _separate(page)
    return page


def _separate(page: Page) -> None:
    """Give texts of nodes that hold other blocks nodes of their own. Children
    come after their parents, as before."""
    inner = set(page.parent)
    for i, (node, text) in enumerate(page.runs):
        if node in inner:
            page.runs[i] = (page.add("#text", node, frozenset()), text)


def features(page: Page) -> np.ndarray:
    """FEATURES of each node, shape (nodes, features)."""
    n = len(page.tag)
    out = np.zeros((n, len(FEATURES)), np.float32)
    parent = page.parent
    chars, blocks, punct, digits = [0] * n, [0] * n, [0] * n, [0] * n
    linked = [page.linked.get(i, 0) for i in range(n)]
    tags = [1 + page.inline.get(i, 0) for i in range(n)]
    before = [None] * n
    seen = 0
    for node, text in page.runs:
        up = node
        while up >= 0 and before[up] is None:
            before[up] = seen
            up = parent[up]
        chars[node] += len(text)
        seen += len(text)
        blocks[node] += 1
        punct[node] += sum(map(text.count, ".,;:!?"))
        digits[node] += sum(map(text.count, "0123456789"))
    children: list[list[int]] = [[] for _ in range(n)]
    below = [0] * n
    for i in range(n - 1, 0, -1):
        p = parent[i]
        chars[p] += chars[i]
        blocks[p] += blocks[i]
        punct[p] += punct[i]
        digits[p] += digits[i]
        linked[p] += linked[i]
        tags[p] += tags[i]
        below[p] += below[i] + 1
        children[p].append(i)
    total = max(1, chars[0])
    depth = [0] * n
    for kids in children:
        kids.reverse()
        same: dict[str, int] = {}
        for k in kids:
            same[page.tag[k]] = same.get(page.tag[k], 0) + 1
        for k in kids:
            out[k, -3], out[k, -2] = len(kids), same[page.tag[k]] / len(kids)
    words = 2 * _KINDS
    above = words + _WORDS
    told = above + _WORDS
    first = told + 3
    for i in range(n):
        row = out[i]
        kind = _TAG_KIND.get(page.tag[i])
        if i:
            p = parent[i]
            depth[i] = depth[p] + 1
            row[_KINDS : 2 * _KINDS] = np.maximum(out[p, _KINDS : 2 * _KINDS], out[p, :_KINDS])
            row[above:told] = np.maximum(out[p, above:told], out[p, words:above])
            row[told + 1] = max(out[p, told], out[p, told + 1])
            row[told + 2] = max(out[p, told + 2], out[p, words + _CONTENT], *out[p, _CONTENT_TAGS])
        if kind is not None:
            row[kind] = 1
        for k in page.attrs[i]:
            row[words + k] = 1
        row[told] = kind in _BESIDE_TAGS or any(k != _CONTENT for k in page.attrs[i])
        c = max(1, chars[i])
        row[first : first + 9] = (
            depth[i],
            math.log1p(chars[i]),
            min(1.0, linked[i] / c),
            tags[i] / c,
            chars[i] / max(1, blocks[i]),
            punct[i] / c,
            digits[i] / c,
            chars[i] / max(1, chars[parent[i]] if i else c),
            (before[i] or 0) / total,
        )
        row[-1] = below[i]
    return out
