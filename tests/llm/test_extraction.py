from __future__ import annotations

import random
from itertools import product

import pytest
from pyspark.sql import functions as F

from dumpflow.llm import extraction

PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var a="</p><p>x";</script></head>
<body class="has-sidebar"><header><a href="/">Home</a></header><nav><ul><li><a href="/a">A</a></li></ul></nav>
<div class="cookie-notice">We use cookies. Accept them.</div><!-- <p>not here</p> -->
<main><article><h1>A&nbsp;great
 title</h1><p><b>First  paragraph, long enough to be prose &eacute;&#33; It has two sentences.<br>After a break.<p>Second &lt;one&gt;.</p>
<div class="ad">Buy this now.</div><ul><li>point one</li><li>point two</li></ul>
<section id="comments"><h2>Comments</h2><p>I liked reading this article very much indeed. Thank you for it.</p></section></article></main>
<aside>Related posts here.</aside><form><label>Your email</label><input><button>Go</button></form><footer>&copy; us, all rights reserved.</footer></body></html>"""


def test_article_of_a_page():
    text, blocks, kept = extraction.main_text(PAGE)
    assert text.split("\n") == [
        "A great title", "First paragraph, long enough to be prose é! It has two sentences. After a break.", "Second <one>.", "point one", "point two"]
    assert kept == 5 and blocks > kept


@pytest.mark.parametrize(("page", "text"), [
    (None, ""), ("", ""), ("   ", ""), ("<nav>menu</nav>", ""), ("Just some plain text, without any markup at all.", "Just some plain text, without any markup at all."),
    ("<p>One paragraph", "One paragraph"), ("<article><p>a &amp b</article>", "a & b"), ("<script>never closed", ""), ("<p>x < y and <b>z</p>", "x < y and z"),
])
def test_awkward_pages(page, text):
    assert extraction.main_text(page)[0] == text


@pytest.mark.parametrize("before", [
    "<select><option>A<option>B</select>", "<datalist><option>A<option>B</datalist>", "<div><button>Go</div>", "<div><object><div>No player</div></div>",
    "<div><select><option>A</div>", "<svg width='1>' />", "<math/>", "<svg-icon></svg-icon>", "<button>A<button>B</button>", "<head><title>T</title>", "<head><meta charset=utf-8>",
])
def test_text_after_hidden_elements_stays(before):
    """End tags that may be left out, or are, hide no more than their surroundings."""
    text = "The article goes on after this, with a sentence of its own."
    assert extraction.main_text(f"{before}<p>{text}</p>")[0] == text


def test_hidden_elements_stay_hidden():
    page = "<body><p>Some words of the article come here.</p><button><p>Go</p><div>on</div></button><svg><text>S</text></svg><select><option>A<option>B</select><object><p>none</p></object></body>"
    assert [b.text for b in extraction.blocks_of(page)] == ["Some words of the article come here."]


def test_cut_is_the_cheapest_labelling():
    rng = random.Random(5)
    for _ in range(300):
        n = rng.randint(1, 7)
        excess = [rng.randint(-9, 9) for _ in range(n)]
        edges = [(a, b, rng.randint(0, 6)) for a in range(n) for b in range(a + 1, n) if rng.random() < 0.5]

        def cost(kept, excess=excess, edges=edges):
            return sum(max(e, 0) if not k else max(-e, 0) for e, k in zip(excess, kept, strict=True)) + sum(c for a, b, c in edges if kept[a] != kept[b])

        assert cost(extraction.minimum_cut(excess, edges)) == min(map(cost, product((False, True), repeat=n)))


def test_long_page_is_fast():
    page = "<article>" + "<p>A sentence of some words, as they come.</p>" * 50_000 + "</article>"
    text, blocks, kept = extraction.main_text(page)
    assert blocks == kept == 50_000 and text.count("\n") == 49_999


def test_frame(spark):
    rows = [(1, "u", PAGE), (2, None, None), (3, "u", ""), (3, "u", ""), (None, "v", "<p>Some words here.</p>")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumns({"text": F.lit("clash"), "n_kept": F.lit("x")})
    got = extraction.extract(pages).collect()
    assert len(got) == 5 and all(r.n_chars == len(r.text) for r in got)
    assert {r.page_id: r.text for r in got}[None] == "Some words here."
    assert extraction.extract(pages.where("false")).count() == 0


def test_given_pages(spark):
    """Everything of the article, and nothing else, on the test pages."""
    import html
    import re

    for r in extraction.extract(spark.read.parquet("/root/testdata/sf0.01/pages.parquet").withColumn("raw", F.col("html"))).collect():
        article = re.search(r"<article>(.*?)</article>", r.raw, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", p))).split()) for p in re.split(r"</?(?:p|h1)>", article)]
        assert r.text == "\n".join(x for x in blocks if x)


@pytest.mark.parametrize("attrs", [
    'title="hidden gems of Rome"', 'data-label="it is hidden here"', 'aria-label="a hidden place"', 'data-role="x footer"', 'id="post-search"',
    'class="social-history"', 'class="p-comment"', "data-x=it's", 'aria-hidden="false"', 'data-hidden', "title = 'a class=ad b'", 'href=?a="b', 'a="x" b="> class=ad"'])
def test_attributes_that_say_nothing(attrs):
    first, own, last = (f"The {x} paragraph of this article has enough words to be prose, and it's whole." for x in ("first", "middle", "last"))
    page = f"<nav><a href=/>Home</a></nav><article><p>{first}</p><p {attrs}>{own}</p><p>{last}</p></article>"
    assert extraction.main_text(page)[0].split("\n") == [first, own, last]


@pytest.mark.parametrize("attrs", ["hidden", 'HIDDEN=""', "hidden=until-found", 'aria-hidden = "true"', "class=ad", "class='ad-label'", 'class="&#97;d"'])
def test_attributes_that_hide(attrs):
    first, last = (f"The {x} paragraph of this article has enough words to be prose." for x in ("first", "last"))
    page = f"<article><p>{first}</p><p {attrs}>Buy now</p><p>{last}</p></article>"
    assert extraction.main_text(page)[0].split("\n") == [first, last]


def test_deep_nesting_in_linear_memory():
    import tracemalloc

    page = "<div>word " * 100_000 + "</p></section>" * 50_000
    tracemalloc.start()
    blocks = extraction.blocks_of(page)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(blocks) == 100_000 and peak < 150_000_000
    assert len(extraction.edges_of(blocks)) == 99_999
