"""Main text: what a wrapper adds, broken pages, names, depth, columns of any name."""

import pytest
from pyspark.sql import functions as F

from caselake.llm.main_text import _extract, _match, _no_article_name, _tree, extract_main_text, induce, op6_main_text

SCHEMA = "page_id bigint, url string, html string"


def texts(spark, htmls, host="h.example"):
    df = spark.createDataFrame([(i, f"http://{host}/{i}", h) for i, h in enumerate(htmls)], SCHEMA)
    return [r.text for r in extract_main_text(df).orderBy("page_id").collect()]


def test_the_wrapper_decides_what_no_name_tells(spark):
    """Without its constants the same pages keep their template; nothing in them is named."""
    form = "<body><div class=a>Daily paper since 1901</div><div class=b><p>Story {n} of today</p><p>Goes on {n}</p></div><div class=c><p>All rights with the paper</p><span>Printed in town</span></div></body>"
    pages = [form.format(n=n) for n in range(6)]
    want = [f"Story {n} of today\n\nGoes on {n}" for n in range(6)]
    assert texts(spark, pages) == want
    assert all(_extract(p, set()) != w and w in _extract(p, set()) for p, w in zip(pages, want))
    assert sorted(t for _, t in induce(pages)["constants"]) == ["All rights with the paper", "Daily paper since 1901", "Printed in town"]


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("<article><p>one<svg viewBox='0 0 1 1'/> two</p><p>three</p></article>", "one two\n\nthree"),
        ("<article><p>one</p><iframe src=x /><p>two</p></article>", "one\n\ntwo"),
        ("<article><p>one</p><iframe src=x><p>two</p></article>", "one\n\ntwo"),
        ("<article><p>one</p><svg><path d=x/><text>no</text></svg><p>two</p></article>", "one\n\ntwo"),
        ("<article>one<button>Click<p>two</p></article>", "one\n\ntwo"),
        ("<article><p>one<button>Click</button> more</p><select><option>a<option>b<p>two</p></article>", "one more\n\ntwo"),
        ("<body><form action=/><div><p>one and more words</p><p>two</p></div><input></form></body>", "one and more words\n\ntwo"),
        ("<body><form action=/><h1>one</h1></form><p>two and many more words than the form has</p></body>", "one\n\ntwo and many more words than the form has"),
        ("<body><p>one and some words</p><form>Your name <input> <label>mail</label></form></body>", "one and some words"),
        ("<article><p>one</p><div class='related-work'>two</div><section id=search-results-analysis>three</section><div class='related posts'>no</div></article>", "one\n\ntwo\n\nthree"),
        ("<div class='with-sidebar'><p>one</p><div class='sidebar-left'>no</div></div>", "one"),
        ("<article><script>if(a<b)</script>one<script>two", "one"),
    ],
)
def test_no_text_is_lost_to_odd_markup(page, want):
    assert _extract(page, set()) == want


def test_names():
    assert all(_no_article_name(n.split("-")) for n in ("ad", "cookie-notice", "site-nav", "comment-list", "ad-slot-12", "share-buttons", "related-posts"))
    assert not any(_no_article_name(n.split("-")) for n in ("related-work", "search-results-analysis", "content", "main-content", "with-sidebar", "advertising-law", "box"))


def test_ten_thousand_levels(spark):
    deep = lambda n, end: "<div>" * 10_000 + f"<p>Words {n}</p>" + end
    pages = [deep(1, "<p>x</p>"), deep(2, "<b>y</b>"), "<article>" + deep(3, "") + "</article>"]
    assert texts(spark, pages)[2] == "Words 3"
    size, pairs = _match(_tree(pages[0]), _tree(pages[1]))
    assert size == len(pairs) >= 10_001
    nested = "<article>" + "".join(f"<div>t{i}" for i in range(10_000))
    assert len(_extract(nested, {1}).split("\n\n")) == 10_000


def test_columns_of_any_name_stay(spark):
    names = ["_host", "host", "layout", "_layout", "of_host", "_of_host", "of_layout", "group", "keys", "page"]
    df = spark.createDataFrame([(i, "http://a/", f"<p>Same</p><p>One {i}</p>") for i in range(3)], SCHEMA).select("*", *[F.lit(c).alias(c) for c in names])
    out = extract_main_text(df)
    assert out.columns == [*df.columns, "text"]
    got = out.collect()
    assert sorted(r.text for r in got) == ["One 0", "One 1", "One 2"] and all(tuple(r[c] for c in names) == tuple(names) for r in got)


def test_the_query_returns_every_page(spark):
    rows = op6_main_text(spark, "/root/testdata/sf0.001").collect()
    pages = {r.page_id: r for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()}
    assert len(rows) == len(pages)
    for r in rows:
        html = pages[r.page_id].html or ""
        assert r.n_chars == len(r.text) and (r.text == "") == ("<article>" not in html)


def test_no_text_is_lost_to_optional_tags_and_odd_comments():
    from caselake.llm.main_text import _blocks

    read = lambda page: "\n\n".join(t for _, t in _blocks(page))
    assert read("<html><head><title>T</title><meta charset=x><p>one<p>two</html>") == "one\n\ntwo"
    assert read("<head><title>T</title>bare <b>text</b>") == "bare text" and read("<head> <style>x</style> </head><p>a") == "a"
    assert read("<p>one<!--><p>two<!---><p>three<!-- x --!><p>four<!-- gone") == "one\n\ntwo\n\nthree\n\nfour"
    assert read("<article>Let <math><mi>x</mi><annotation>\\x</annotation></math> be.<noscript><p>plain</p></noscript></article><noscript>enable</noscript>") == "Let x be.\n\nplain"
    assert read("<article><section id=notice><h2 id=comments>Notice</h2><p>a</p></section><div id=comments>c</div><section class=notice>d</section></article>") == "Notice\n\na"
    assert read("<header>site</header><section><header><h1>Head</h1></header><p>a</p></section><div class=user-feedback>f</div>") == "Head\n\na"
