"""Main text of web pages by gradient-boosted trees over DOM nodes.

A node is kept if its subtree holds any of the article, so a dropped node's
descendants are all dropped. Boosted trees (Spark ML) score each block node from
its features; decoding then takes the best labelling without contradictions:
bottom up, a kept node is worth its log odds plus what its children are worth
where that is positive, a dropped one nothing; top down, a child is kept if its
parent is and it is worth more than nothing.

Pages carry no labels, so the trees are fitted on labelled pages built from
them: texts of a bounded sample of pages (`SAMPLE_PAGES`, the smallest hashes of
their ids) are set into random layouts of articles and of what surrounds them,
in semantic tags and in plain boxes with the usual class names.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfrank.llm.common import fresh, ship, slices
from shelfrank.llm.dom import Page, features, parse

ship(__name__)

SAMPLE_PAGES = 200
#: Layouts built for training.
LAYOUTS = 900
TREES = 32
DEPTH = 4
STEP = 0.3
#: Bins per feature; the square is more than the training nodes, so that splits
#: come from all of them.
BINS = 180

_MAIN = (
    ("article", ""),
    ("article", 'class="post"'),
    ("main", ""),
    ("main", 'id="main"'),
    ("div", 'class="content"'),
    ("div", 'id="content"'),
    ("div", 'class="post-content entry"'),
    ("div", 'class="article-body"'),
    ("section", 'class="story"'),
    ("div", ""),
)
#: Surroundings: (elements that may hold them, contents: l links, t short text, p paragraphs, h heading, f form fields, c comments).
_OUTSIDE = {
    "top": ((("nav", ""), ("ul", 'class="menu"'), ("div", 'class="navbar"'), ("div", 'id="nav"')), "l"),
    "crumbs": ((("div", 'class="breadcrumbs"'), ("nav", 'class="breadcrumb"')), "l"),
    "header": ((("header", ""), ("div", 'id="header"'), ("div", 'class="header"'), ("div", 'class="site-header masthead"')), "tlhh"),
    "footer": ((("footer", ""), ("div", 'id="footer"'), ("div", 'class="footer"'), ("div", 'class="site-footer"')), "tpl"),
    "side": ((("aside", ""), ("div", 'class="sidebar"'), ("div", 'id="sidebar"'), ("div", 'class="related widget"')), "lp"),
}
_ANYWHERE = {
    "notice": ((("div", 'class="cookie-notice"'), ("div", 'id="consent"'), ("div", 'class="notice"'), ("div", 'role="alert"')), "p"),
    "advert": ((("div", 'class="ad"'), ("div", 'class="advert"'), ("div", 'class="ads banner"'), ("section", 'class="sponsored"'), ("aside", 'class="promo"')), "tp"),
    "form": ((("form", ""), ("form", 'class="newsletter"'), ("div", 'class="subscribe"')), "f"),
    "social": ((("div", 'class="share"'), ("ul", 'class="social"')), "l"),
    "comments": ((("div", 'class="comments"'), ("section", 'id="comments"'), ("ol", 'class="commentlist"'), ("div", 'class="reader-comments"')), "c"),
}


class Layout:
    """One labelled page. Texts of the article are marked while it is built."""

    MARK = "\u2063"

    def __init__(self, dice: random.Random, texts: list[str]):
        self.dice, self.texts = dice, texts

    def text(self, few: bool = False, main: bool = False) -> str:
        words = self.dice.choice(self.texts).split()
        if few:
            words = words[: self.dice.randint(1, 8)]
        elif self.dice.random() < 0.4:
            words = words[: self.dice.randint(5, 20)]
        plain = " ".join(words).replace("&", "&amp;").replace("<", "&lt;")
        return (self.MARK if main else "") + plain

    def within(self, tag: str, attributes: str, body: str) -> str:
        return f"<{tag}{' ' * bool(attributes)}{attributes}>{body}</{tag}>"

    def filling(self, kinds: str) -> str:
        kind, dice = self.dice.choice(kinds), self.dice
        if kind == "l":
            items = [f'<a href="/{i}">{self.text(few=True)}</a>' for i in range(dice.randint(2, 9))]
            if dice.random() < 0.7:
                return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>"
            return dice.choice([" | ", " ", ""]).join(items)
        if kind == "h":
            level = dice.choice("1223")
            return f"<h{level}>{self.text(few=True)}</h{level}>" + dice.choice(["", self.filling("l")])
        if kind == "f":
            return f"<p>{self.text(few=True)}</p><label>{self.text(few=True)}</label><input><button>{self.text(few=True)}</button>"
        if kind == "c":
            one = dice.choice(["p", "div", "li"])
            return f"<h3>{self.text(few=True)}</h3>" + "".join(
                f'<{one} class="{dice.choice(["comment", "reply", "c"])}">{self.text()}</{one}>' for _ in range(dice.randint(1, 5))
            )
        if kind == "t":
            return self.text(few=dice.random() < 0.4)
        return "".join(f"<p>{self.text(few=dice.random() < 0.3)}</p>" for _ in range(dice.randint(1, 3)))

    def around(self, table: dict, chance: float) -> str:
        out = []
        for places, kinds in table.values():
            if self.dice.random() < chance:
                out.append(self.within(*self.dice.choice(places), self.filling(kinds)))
        self.dice.shuffle(out)
        return "".join(out)

    def article(self) -> str:
        dice, out = self.dice, []
        if dice.random() < 0.9:
            heading = f"<h1>{self.text(few=True, main=True)}</h1>"
            if dice.random() < 0.15:
                heading = f"<header>{heading}</header>"
            out.append(heading)
        loose = dice.random() < 0.3
        for _ in range(dice.choice([0, 1, 1, 2, 3, 5, 8, 13, 20])):
            r, text = dice.random(), self.text(few=dice.random() < 0.2, main=True)
            if r < 0.75:
                out.append(f"<p>{'<b>' * (loose and r < 0.1)}{text}" + ("<br>" if loose and r < 0.1 else "</p>"))
            elif r < 0.82:
                out.append(f"<h2>{self.text(few=True, main=True)}</h2>")
            elif r < 0.88:
                items = "".join(f"<li>{self.text(few=True, main=True)}</li>" for _ in range(dice.randint(2, 5)))
                out.append(self.within(dice.choice(["ul", "ol"]), "", items))
            elif r < 0.92:
                out.append(f"<blockquote>{text}</blockquote>")
            elif r < 0.96:
                link = f'<a href="/x">{self.text(few=True, main=True)}</a>'
                out.append(f"<p>{text} {link}</p>")
            else:
                out.append(f"<div>{text}</div>")
        inside = self.around(_ANYWHERE, 0.12)
        out.insert(dice.randint(0, len(out)), inside)
        if dice.random() < 0.1:
            return "".join(out)
        return self.within(*dice.choice(_MAIN), "".join(out))

    def page(self) -> str:
        dice = self.dice
        before = self.around({k: _OUTSIDE[k] for k in ("top", "crumbs", "header")}, 0.6) + self.around(_ANYWHERE, 0.2)
        after = self.around({k: _OUTSIDE[k] for k in ("side", "footer")}, 0.6) + self.around(_ANYWHERE, 0.25)
        if dice.random() < 0.08:
            return dice.choice([self.text(main=True), f"<p>{self.text(main=True)}", self.article()])
        body = before + self.article() + after
        for _ in range(dice.randint(0, 2)):
            body = self.within("div", dice.choice(["", 'class="wrapper"', 'id="page"', 'class="container"']), body)
        return f"<html><head><title>x</title></head><body>{body}</body></html>"


def labelled(page: Page) -> np.ndarray:
    """1 for nodes whose subtree holds a marked text."""
    out = np.zeros(len(page.tag), np.int64)
    for node, text in page.runs:
        while Layout.MARK in text and node >= 0 and not out[node]:
            out[node] = 1
            node = page.parent[node]
    return out


class Trees:
    """Boosted trees as arrays; leaves point to themselves."""

    def __init__(self, feature, threshold, left, right, value, roots, depth):
        self.feature, self.threshold, self.left, self.right = feature, threshold, left, right
        self.value, self.roots, self.depth = value, roots, depth

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        total, rows = np.zeros(len(x)), np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            for _ in range(self.depth):
                at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
            total += self.value[at]
        return 2 * total


def _arrays(model) -> Trees:
    """The fitted model's trees, read node by node."""
    feature, threshold, left, right, value, roots = [], [], [], [], [], []

    def walk(node, weight: float) -> int:
        at = len(feature)
        for column, item in ((feature, 0), (threshold, 0.0), (left, at), (right, at)):
            column.append(item)
        value.append(weight * node.prediction())
        if node.getClass().getSimpleName() == "InternalNode":
            split = node.split()
            feature[at], threshold[at] = split.featureIndex(), split.threshold()
            left[at], right[at] = walk(node.leftChild(), weight), walk(node.rightChild(), weight)
        return at

    for tree, weight in zip(model._call_java("trees"), model.treeWeights):
        roots.append(walk(tree.rootNode(), weight))
    columns = [np.array(c) for c in (feature, threshold, left, right, value)]
    return Trees(*columns, roots, DEPTH)


def train(pages: DataFrame, sample: int = SAMPLE_PAGES, layouts: int = LAYOUTS) -> Trees | None:
    """Fit the trees on layouts of the texts of a sample of pages (page_id,
    html); None where no page of the sample has a text."""
    spark = pages.sparkSession
    known = pages.where(F.col("page_id").isNotNull() & F.col("html").isNotNull())
    chosen = known.select("page_id").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(sample)
    found = known.join(F.broadcast(chosen), "page_id").select("page_id", "html").orderBy("page_id", "html").toPandas()
    texts = [text for source in found["html"] for _, text in parse(source).runs]
    if not texts:
        return None
    rows, marks = [], []
    for i in range(layouts):
        page = parse(Layout(random.Random(i), texts).page())
        rows.append(features(page))
        marks.append(labelled(page))
    x, y = np.vstack(rows), np.concatenate(marks)
    table = pa.table(
        {"i": pa.array(range(len(y))), "x": pa.array(x.tolist(), pa.list_(pa.float64())), "label": pa.array(y.astype(float))}
    )
    nodes = spark.createDataFrame(table).repartition(8, "i").sortWithinPartitions("i")
    data = nodes.select(array_to_vector("x").alias("features"), "label").checkpoint()
    fitted = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=1, maxBins=BINS).fit(data)
    return _arrays(fitted)


def decode(page: Page, odds: np.ndarray) -> list[bool]:
    """Nodes kept by the best labelling in which kept nodes have kept parents."""
    worth = odds.tolist()
    for i in range(len(worth) - 1, 0, -1):
        if worth[i] > 0:
            worth[page.parent[i]] += worth[i]
    kept = [False] * len(worth)
    for i, w in enumerate(worth):
        kept[i] = w > 0 and (i == 0 or kept[page.parent[i]])
    return kept


def main_texts(sources: list[str | None], trees: Trees | None) -> list[str]:
    """Main text of each page."""
    pages = [parse(s) if s and trees else None for s in sources]
    matrices = [features(p) for p in pages if p and p.runs]
    odds = trees.log_odds(np.vstack(matrices)) if matrices else np.zeros(0)
    out, at = [], 0
    for page in pages:
        if page is None or not page.runs:
            out.append("")
            continue
        n = len(page.tag)
        kept = decode(page, odds[at : at + n])
        at += n
        out.append("\n\n".join(text for node, text in page.runs if kept[node]))
    return out


def extract(pages: DataFrame, trees: Trees | None, source: str = "html") -> tuple[DataFrame, list[str]]:
    """pages with two more columns, whose names are returned: the main text and
    its number of code points.

    Blocks are joined by two line feeds; references are decoded and white space
    within a block is one space. Every row gives one row; a null, empty or
    textless page, and any page without trees, has an empty text."""
    names = fresh(pages, "text", "n_chars")
    shared = pages.sparkSession.sparkContext.broadcast(trees and vars(trees))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = Trees(**shared.value) if shared.value else None
        for whole in batches:
            for part in slices(whole, source):
                found = main_texts(part.column(source).to_pylist(), fitted)
                columns = [*part.columns, pa.array(found, pa.string()), pa.array(list(map(len, found)), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names, *names])

    schema = T.StructType(
        [*pages.schema.fields, T.StructField(names[0], T.StringType()), T.StructField(names[1], T.LongType())]
    )
    return pages.mapInArrow(run, schema), names
