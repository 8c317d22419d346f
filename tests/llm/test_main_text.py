import html
import re
import time

import numpy as np
import pytest

from shelfrank.llm import dom, main_text

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def trees(spark):
    return main_text.train(spark.read.parquet(f"{SF}/pages.parquet"))


def gold(source):
    """The article of the test pages, whose blocks are h1 and p."""
    article = re.search("<article>(.*)</article>", source, re.S)[1]
    blocks = re.split("</?(?:p|h1)>", re.sub("<br>", " ", re.sub("</?b>", "", article)))
    return "\n\n".join(b for b in (" ".join(html.unescape(b).split()) for b in blocks) if b)


def test_pages(spark, trees):
    pages = spark.read.parquet(f"{SF}/pages.parquet").selectExpr("*", "'mine' AS text")
    rows, (text, n_chars) = main_text.extract(pages, trees)
    assert text != "text"
    found = rows.collect()
    assert all(r[text] == gold(r["html"]) and r[n_chars] == len(r[text]) for r in found)


PLAIN = [
    "A first sentence of the article, with some words in it.",
    "Then a second one; it is a bit longer than the first & it goes on.",
    "Last words.",
]
BODY = "<h1>Some title here</h1>" + "".join(f"<p>{html.escape(t)}</p>" for t in PLAIN)
WANT = "\n\n".join(["Some title here", *PLAIN])


@pytest.mark.parametrize(
    "page",
    [
        f"<body><nav><a href=a>Home</a> <a href=b>News</a></nav><main>{BODY}</main><footer><p>&copy; us</p></footer>",
        f"<div class=header><a href=/>Logo</a></div><div class='post-content'>{BODY}</div>"
        "<div class=comments><p>I do not agree with any of this at all.</p></div><div id=footer>Imprint</div>",
        f"<article>{BODY}<div class='ad'>Buy now, it is cheap</div></article><aside><ul><li><a href=x>More</a></ul></aside>",
        f"<div class='cookie-notice'><p>We use cookies, accept them all please.</p></div><article>{BODY}</article>"
        "<form><label>Mail</label><input><button>Go</button></form><script>var x = '</p><p>';</script>",
    ],
)
def test_layouts(trees, page):
    assert main_text.main_texts([page], trees) == [WANT]


def test_hierarchy_is_consistent(trees):
    page = dom.parse("<body><div class=comments><article><p>Nice words, all of them good.</p></article></div></body>")
    kept = main_text.decode(page, np.array([1.0, -5.0, 2.0, 2.0]))
    assert all(not k or i == 0 or kept[page.parent[i]] for i, k in enumerate(kept))
    assert main_text.decode(page, np.array([1.0, -1.0, 2.0, 2.0])) == [True] * 4


def test_broken_markup():
    runs = lambda s: [t for _, t in dom.parse(s).runs]
    assert runs("<p>a<p>b<b>c<br>d &amp;&am; &lt;x&gt; &#233;") == ["a", "bc d &&am; <x> é"]
    assert runs("<ul><li>a<li>b</ul>c<!-- x --><style>p{}</style> d") == ["a", "b", "c d"]
    assert runs("<div title='a > b'>x</div><p attr='un>closed>y") != []
    assert runs("<script>never closed <p>x") == []
    assert runs("a < b <3 </> <p") != []
    assert runs("<p hidden>no</p><div style='display: none'><p>no</p></div><p>yes") == ["yes"]


def test_skips_end_where_html_ends_them():
    runs = lambda s: [t for _, t in dom.parse(s).runs]
    article = "<article><h1>T</h1><p>it's x</article>"
    assert runs(f"<html><head><title>x</title><body>{article}") == ["T", "it's x"]
    assert runs(f"<head><meta charset=utf-8><title>x</title>{article}") == ["T", "it's x"]
    assert runs(f"<head><script>var s = '<head>'</script></head><body>{article}") == ["T", "it's x"]
    assert runs(f"<head><script>if (i<n && a == 'x) y</script></head><body>{article}") == ["T", "it's x"]
    assert runs("<p hidden>a<p>b<p>c") == ["b", "c"]
    assert runs("<ul><li hidden>a<li>b</ul>c") == ["b", "c"]
    assert runs("<table><tr><td hidden>a<td>b<tr><td>c</table>d") == ["b", "c", "d"]
    assert runs("<table><tbody hidden><tr><td>a<tbody><tr><td>b</table>") == ["b"]
    assert runs("<div><p hidden>a</div>b") == ["b"]
    assert runs("<div><svg><g><path d=x></div>b") == ["b"]
    assert runs("<svg><path d=x><p>b") == ["b"]
    assert runs("<video src=x><p>b") == ["b"]
    assert runs("<div hidden><script>'</div>'</script>a</div>b") == ["b"]


def test_skips_go_on_over_what_they_hold():
    runs = lambda s: [t for _, t in dom.parse(s).runs]
    assert runs("<p>a<video><p>no</p></video>b") == ["a b"]
    assert runs("<p>a<object><div>no</div></object>b") == ["a b"]
    assert runs("<li>a<ul hidden><li>no</li></li>no</ul>b") == ["a b"]
    assert runs("<b><div hidden>no</b>no</div>b") == ["b"]
    assert runs("a<div style='display:none'><div>no</div><p>no</div>b") == ["a b"]
    assert runs("<svg><title>no</title><style>a>b{}</style><g><text>no</text></g></svg>b") == ["b"]
    assert runs("<svg><foreignObject><div>no</div></div>no</foreignObject></svg>b") == ["b"]


def test_slash_at_the_end_of_a_tag():
    text = lambda s: [t for _, t in dom.parse(s).runs]
    linked = lambda s: sum(dom.parse(s).linked.values())
    assert linked("<a href=/de/>Home</a><p>text") == 4
    assert linked("<a href = /de/ >Home</a><p>text") == 4
    assert linked("<a name='top'/><p>text<p><a href='/x'>link</a>") == 4
    assert linked("<a href='/x'/>link</a><p>text") == 4
    assert text("<script src=/js/>code</script>b") == ["b"]
    assert text("<script src='/js'/>code</script>b") == ["b"]
    assert text("<script src='/js'/><p>a<script>code</script>") == ["a"]
    assert text("<div hidden class=x/>no</div>b") == ["b"]
    assert text("<svg><path d='x'/><g/></svg>b<i hidden/>c") == ["bc"]


def test_edge_rows(spark, trees):
    deep = "<div>" * 3000 + "deep text in many boxes" + "</div>" * 3000
    rows = [(1, None), (2, ""), (2, ""), (3, "<html></html>"), (None, deep), (4, "<p>" + "word " * 100_000)]
    found = main_text.extract(spark.createDataFrame(rows, "page_id long, html string"), trees)[0].collect()
    assert len(found) == len(rows)
    assert all(r["text"] == "" and r["n_chars"] == 0 for r in found if r["page_id"] in (1, 2, 3))
    none = spark.createDataFrame([], "page_id long, html string")
    assert main_text.train(none) is None
    assert main_text.extract(none, None)[0].collect() == []
    assert main_text.main_texts(["<p>x"], None) == [""]


@pytest.mark.parametrize(
    "source",
    [
        "<div>" * 40_000 + "</i>" * 40_000,
        "<b><table><td>" + "<div>" * 30_000 + "</b>" * 30_000 + "<p>" * 20_000,
        "<b><div hidden>" + "<div>" * 30_000 + "</b>" * 30_000 + "<svg><title>" * 20_000,
        "<li>" * 100_000 + "</td>" * 50_000,
    ],
)
def test_broken_pages_take_linear_time(source):
    start = time.time()
    page = dom.parse(source)
    dom.features(page)
    assert time.time() - start < 20
