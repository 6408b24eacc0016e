import re

import duckdb
import html
import numpy as np
import pytest

from grainmill.llm.catalog import QUERIES
from grainmill.llm.html_blocks import blocks
from grainmill.llm.page_text import extract_text, fit_labeller, told_by_names
from grainmill.llm.recurrent import HIDDEN, Sequence, _forward, _unroll, initial, label

FOLDER = "/root/testdata/sf0.001"
MADE = """<html><body><header><h1>Site</h1><a href=x>Home</a></header><div class='cookie-banner'>We use cookies. Accept all.</div><main>
<h1>A &amp; B</h1><p>Some long  paragraph<br>of text that says a lot, <b>and</b> more.<aside>Related: other story</aside><p>Another paragraph of text.</main>
<section id=comments><h2>Comments</h2><p>I liked this a lot, thank you for the paragraph, friend.</p></section>
<form><label>Email</label><button>Send</button></form><footer>c 2020</footer><script>var t = "<p>no</p>";</script></body></html>"""


@pytest.mark.parametrize(
    "page,want",
    [
        ("<ul><li>one<li>two<ul><li>in</ul><li>three</ul>x", ["one", "two", "in", "three", "x"]),
        ("<table><tr><th>a<td>1<td>2<tr><td>z</table>", ["a", "1", "2", "z"]),
        ("<p>a<p>b<div>c</p>d", ["a", "b", "c", "d"]),
        ("a<br>b &lt;p&gt; &amp;amp; &eacute;&#233; <!-- x <p> --> c<script>if(a<b)</script>d", ["a b <p> &amp; éé cd"]),
        ("<a title='x>y'>l</a> <b", ["l"]),
        ("<title>t</title><body>x\n\t <style>p{</style>y<nav>", ["x y"]),
        ("<p>5 < 6 and 7 > 3</p>", ["5 < 6 and 7 > 3"]),
        ("", []),
        ("<p></p><p> &nbsp; </p>", []),
        ("<div>" * 3000 + "deep", ["deep"]),
        ("<p class=\"a" * 200 + ">x", ["x"]),
        ("<article>a<svg class=\"i\"/>b<p>c</article><svg><text>no</text></svg>d", ["ab", "c", "d"]),
        ("<p>a<title-bar>b</title-bar><object-view>c<head-line>d<p>e", ["abcd", "e"]),
        ("<head><title>t</title><p>x<p>y", ["x", "y"]),
        ("<head><title>t</head><p>x", ["x"]),
        ("<head><meta name=a><style>p{}</style><script>'<p>'</script><title>t</title></head>x", ["x"]),
        ("<p>a<object data=x>b<p>c", ["ab", "c"]),
        ('<article>a<script>w.document.write("<body>"+x+"</body>");</script>b</article>', ["ab"]),
        ("<p>a<script>if(s.indexOf(\"</head>\")>0){run()}</script >b<style>/*</head>*/p{}</style\n>c", ["abc"]),
        ("<p>a<textarea><body>no</textarea>b<script>never closed </body><p>no", ["ab"]),
        ("<head><title>t<body>x", ["x"]),
        ("<p title='it's'>one two don't three<p title=a\"b>four\"", ["one two don't three", "four\""]),
    ],
)
def test_blocks(page, want):
    assert [b.text for b in blocks(page)] == want


def test_paths_and_links():
    found = blocks("<body><div class='side-bar topNav' id=main><ul><li><a href=x>abc</a> d<li>e</ul></div>")
    assert [(b.path, b.linked) for b in found] == [
        (("body", "div", ".side", ".bar", ".top", ".nav", ".main", "ul", "li"), 3),
        (("body", "div", ".side", ".bar", ".top", ".nav", ".main", "ul", "li"), 0),
    ]
    assert [b.path for b in blocks("<article data-id='nav-12' my-class=footer title='class=menu' CLASS=\"a\">x")] == [("article", ".a")]
    assert told_by_names(blocks("<article data-id=\"nav-12\"><p>x")[0])
    assert told_by_names(blocks("<article><header><h1>x")[0]) and told_by_names(blocks("<header><h1>x")[0]) is False


def sequences(sizes):
    rng = np.random.default_rng(1)
    return [Sequence(rng.integers(0, 99, 2 * n), np.full(n, 2), rng.integers(0, 99, 3 * n), np.full(n, 3), rng.normal(size=(n, 7))) for n in sizes]


def test_gradients_of_the_recurrent_network():
    weights, pages = initial(), sequences([4, 1, 3])

    def loss(w):
        logits, _, mask, *_ = _forward(pages, w)
        return float((np.where(mask, logits, 0) ** 2).sum() / 2)

    logits, x, mask, at, flat, joined, traces = _forward(pages, weights, keep=True)
    d_joined = np.where(mask, logits, 0)[..., None] @ weights["out"].T
    own, _ = _unroll(d_joined[..., :HIDDEN], x, traces[0], weights, "ahead")
    back, _ = _unroll(d_joined[..., HIDDEN : 2 * HIDDEN], x, traces[1], weights, "back")
    for name, gradient in (own | back).items():
        for place in [tuple(np.random.default_rng(k).integers(s) for s in gradient.shape) for k in range(5)]:
            changed = {n: w.copy() for n, w in weights.items()}
            changed[name][place] += 1e-5
            assert (loss(changed) - loss(weights)) / 1e-5 == pytest.approx(gradient[place], abs=1e-3, rel=1e-3)


def test_labels_do_not_depend_on_the_batch():
    weights, pages = initial(), sequences([5, 0, 2, 9, 1])
    together, apart = label(pages, weights), [label([p], weights)[0] for p in pages]
    assert all(np.allclose(a, b) for a, b in zip(together, apart)) and [len(x) for x in together] == [5, 0, 2, 9, 1]


@pytest.fixture(scope="module")
def weights(spark):
    return fit_labeller(spark.read.parquet(f"{FOLDER}/pages.parquet"))


def test_made_pages(frame, weights):
    rows = [(1, MADE, "old"), (2, None, "old"), (3, "", None), (4, MADE, "old"), (5, "<article>" + "<p>word and word, more of it.</p>" * 3000 + "</article>", "")]
    got = {r["page_id"]: r["text"] for r in extract_text(frame(rows, "page_id int, html string, text string"), weights).collect()}
    main = "A & B\nSome long paragraph of text that says a lot, and more.\nAnother paragraph of text."
    assert got == {1: main, 2: "", 3: "", 4: main, 5: "\n".join(["word and word, more of it."] * 3000)}


def test_no_pages_to_learn_from(frame):
    empty = frame([], "page_id int, html string")
    assert fit_labeller(empty) is None
    assert extract_text(empty, None).count() == 0
    got = extract_text(frame([(1, "<main>yes</main><nav>no</nav>other")], "page_id int, html string"), None)
    assert [r["text"] for r in got.collect()] == ["yes"]


def test_lessons_are_looked_for_until_they_are_found(frame):
    """One page in thousands tells of main text."""
    rows = [(i, f"<p>page {i}") for i in range(6000)] + [(9000, "<nav>menu</nav><article><p>Text of the only article.</article>")]
    assert fit_labeller(frame(rows, "page_id int, html string"), fit_pages=20) is not None
    assert fit_labeller(frame(rows[:-1], "page_id int, html string"), fit_pages=20) is None


def test_clashing_columns(frame, weights):
    rows = [(1, MADE, "a", "b", {"k": 1})]
    got = extract_text(frame(rows, "page_id int, html string, page string, PAGE_ string, m map<string,int>"), weights)
    assert got.columns == ["page_id", "page", "PAGE_", "m", "text"]
    assert got.first()["page"] == "a" and got.first()["text"].startswith("A & B")


def test_query_finds_the_articles(spark):
    got = {r["page_id"]: r for r in QUERIES["op8_page_text"](spark, FOLDER).collect()}
    for page, url, text in duckdb.sql(f"select page_id, url, html from '{FOLDER}/pages.parquet'").fetchall():
        article = re.search("<article>(.*?)</article>", text, re.S)[1].replace("<br>", " ")
        want = "\n".join(filter(None, (" ".join(html.unescape(x).split()) for x in re.split("</?p>|</?h1>", article.replace("<b>", "").replace("</b>", "")))))
        assert (got[page]["url"], got[page]["text"], got[page]["n_chars"]) == (url, want, len(want))
    assert len(got) == 50
