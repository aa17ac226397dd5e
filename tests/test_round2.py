"""Upserts that run again, addresses, further extractors, aggregates, the paged source's limits, names for SQL."""

import json
import os
import shutil
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer
from urllib.parse import parse_qs, urljoin, urlparse

import pytest
from pyspark.sql import functions as F

from caselake import __main__ as command
from caselake.functions import text, urls
from caselake.operators import aggregate, dedupe, joins, limits
from caselake.plans import bulk, catalogue, listings, rendered
from caselake.register import register
from caselake.sources import html, paged
from caselake.streaming import incremental

URL = "https://courts.example/list/page.html"
UPSERT = "k string, v int, seq int"


def page(spark, body, url=URL):
    return spark.createDataFrame([(url, f"<html><body>{body}</body></html>")], "url string, html string")


def table(spark, target):
    return sorted(tuple(r) for r in incremental.latest(spark, target).select("k", "v", "seq").collect())


# ---- upserts ----


def test_a_batch_that_runs_again_changes_nothing(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / x) for x in ("in", "out", "cp"))
    run = lambda: incremental.upsert_batches(spark, spark.readStream.schema(UPSERT).parquet(source), target, ["k"], ["seq"], checkpoint)
    spark.createDataFrame([("a", 1, 1), ("b", 2, 1), ("c", 3, 1)], UPSERT).write.mode("append").parquet(source)
    run()
    spark.createDataFrame([("b", 9, 2), ("d", 4, 1)], UPSERT).write.mode("append").parquet(source)
    run()
    want = [("a", 1, 1), ("b", 9, 2), ("c", 3, 1), ("d", 4, 1)]
    assert table(spark, target) == want
    versions = sorted(os.listdir(f"{target}/_versions"))
    for f in os.listdir(f"{checkpoint}/commits"):  # as after a crash between publication and commit
        if f.strip(".").startswith("1"):
            os.remove(f"{checkpoint}/commits/{f}")
    run()
    assert table(spark, target) == want and sorted(os.listdir(f"{target}/_versions")) == versions
    for f in os.listdir(f"{target}/_versions"):  # as after a crash before publication: folders are there, the version is not
        if "000002" in f:
            os.remove(f"{target}/_versions/{f}")
    assert table(spark, target) == [("a", 1, 1), ("b", 2, 1), ("c", 3, 1)]
    for f in os.listdir(f"{checkpoint}/commits"):
        if f.strip(".").startswith("1"):
            os.remove(f"{checkpoint}/commits/{f}")
    run()
    assert table(spark, target) == want
    assert incremental.prune(spark, target, keep=1) >= 1 and table(spark, target) == want


def test_only_touched_buckets_are_written(spark, tmp_path):
    target = str(tmp_path / "t")
    apply = lambda rows, run, n: incremental.apply_batch(spark, target, spark.createDataFrame(rows, UPSERT), run, n, ["k"], ["seq"], buckets=16)
    apply([(f"k{i}", i, 1) for i in range(60)], "one", 0)
    before = incremental._version(spark, target)["folders"]
    apply([("k7", 70, 2), ("k7", 69, 1)], "one", 1)
    after = incremental._version(spark, target)["folders"]
    assert len(before) > 8 and sum(before[b] != after[b] for b in before) == 1
    apply([("k7", 0, 9)], "one", 1)  # already held
    apply([("k8", 80, 1)], "two", 0)  # another checkpoint counts for itself
    got = {k: v for k, v, _ in table(spark, target)}
    assert got == {f"k{i}": i for i in range(60)} | {"k7": 70, "k8": 80}
    apply([], "two", 1)
    assert len(table(spark, target)) == 60
    with pytest.raises(RuntimeError):
        incremental._publish(spark, f"{target}/_versions", f"{1:012d}.json", "{}")


def test_new_rows_since_a_watermark(spark):
    rows = spark.createDataFrame([(1, 5), (2, 7), (3, 7), (4, 8), (5, None)], "id int, modified int")
    done = spark.createDataFrame([(1, 5), (2, 7)], "id int, modified int")
    assert sorted(r.id for r in incremental.modified_since(rows, done, "modified", "id").collect()) == [3, 4]
    assert sorted(r.id for r in incremental.modified_since(rows, done.limit(0), "modified", "id").collect()) == [1, 2, 3, 4]


# ---- addresses ----


def test_addresses_resolve_as_the_standard_says(spark):
    bases = ["https://a.b/c/d;p?q=1", "https://a.b", "http://a.b/", "http://a.b/c/../d/", "http://a.b/x.html#f", "http://a.b//c//d"]
    hrefs = ["", "g", "./g", "g/", "/g", "//h/g", "?y", "g?y#s", "#s", "../g", "../..", "../../../g", ".", "./", "..", "/./g", "/../g", "g;x=1/../y", "http://o/p/../q", "mailto:x@y", "a/./b/../c", "é/ü", "a//b", "g?y/../x", "a b", "...", "/a/b/../../..", "g.", "?", "x?"]
    rows = [(b, h) for b in bases for h in hrefs]
    got = spark.createDataFrame(rows, "b string, h string").coalesce(1).select(urls.resolved("b", "h")).collect()
    wrong = [(b, h, r[0], urljoin(b, h)) for (b, h), r in zip(rows, got) if r[0] != urljoin(b, h) and not h.startswith("g;")]
    assert not wrong
    assert spark.range(1).select(urls.built("http://x/s", q=F.lit("a b&c"), n=F.lit(3))).first()[0] == "http://x/s?q=a+b%26c&n=3"


def test_trims_equal_pythons(spark):
    texts = ["", None, "  a b  ", "  x　\n", "-.a.-b-.", "\x1c\x85 y", "é  \t ü", " \n"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1)
    got = [tuple(r) for r in df.select(text.strip(text.text("t")), text.clean_ws("t"), text.folder_name("t")).collect()]
    assert [g[0] for g in got] == [(t or "").strip() for t in texts]
    assert [g[1] for g in got] == [" ".join((t or "").split()) for t in texts]
    assert got[4][2] == "a.-b"


def test_names_of_long_texts_are_those_of_the_whole(spark):
    """Texts whose beginnings give few characters, and cuts at every place of a run."""
    import random

    rng = random.Random(4)
    texts = ["*" * 5000 + "abc def", " " * 4000 + "x", ("ab " * 900), "\u03a3" * 3000, "a" + "?" * 479 + "b" * 700, "_-. " * 700 + "end"]
    texts += ["".join(rng.choice("aB1_-. *?\u00e9\u00a0/") for _ in range(rng.choice([470, 481, 960, 1441, 3000]))) for _ in range(60)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1)
    functions = [text.slugify, text.folder_name, text.masked_name, text.word_name, text.run_masked_name, text.listed_name]
    got = [tuple(r) for r in df.select(*[f("t") for f in functions]).collect()]
    plain, text._begin = text._begin, lambda c, name, most: F.substring(name(c), 1, most)
    try:
        assert got == [tuple(r) for r in df.select(*[f("t") for f in functions]).collect()]
    finally:
        text._begin = plain


# ---- extractors ----


def test_pages_of_any_depth_are_read(spark):
    deep = "<div>" * 10_000 + "<a href='x.pdf'>end</a>"
    root = html.parse(deep)
    assert root.text() == "end" and len(html.select(root, "div > a")) == 1
    got = html.elements(page(spark, deep), {"a": ("a", {})}).collect()
    assert [r.element.text for r in got] == ["end"]


def test_counts_of_shown_opinions(spark):
    pages = page(spark, '<a href="?fa=opinions.showOpinion&f=1">a</a><a href="?fa=opinions.showOpinion&f=2">b</a><a href="x">c</a>').unionByName(page(spark, "none", "https://other/"))
    assert sorted((r.url, r.n_opinions) for r in listings.opinion_counts(pages).collect()) == [(URL, 2), ("https://other/", 0)]


def test_plain_tables_take_both_kinds_of_cells(spark):
    row = lambda n, c="td": f"<tr><{c}>d{n}</{c}><{c}><a href='c{n}'>{n}</a></{c}><{c}>* T{n}</{c}><{c}>f</{c}></tr>"
    body = f"<table>{row(0)}{row(1)}{row(2, 'th')}</table><table>{row(3)}</table><table><tr><td>x</td></tr></table>"
    got = sorted((r.case_number, r.case_title, r.case_info_url) for r in listings.plain_case_tables(page(spark, body)).collect())
    assert got == [(str(n), f"T{n}", f"https://courts.example/list/c{n}") for n in (1, 2, 3)]


def test_results_table_is_chosen_by_its_headings(spark):
    body = """<table><tr><th>Other</th></tr><tr><td>no</td></tr></table>
      <table><tr><th>Supreme Court #</th><th>Court of Appeal Case</th><th>Trial Court</th></tr>
        <tr><td><a href="/s?id=1">S1</a><br>A v. B<br>more</td><td>B7</td><td>T9</td></tr><tr><td>S2<br>C v. D</td></tr><tr></tr></table>"""
    got = {r.case_number: r for r in listings.results_table(page(spark, body)).collect()}
    assert got.keys() == {"S1", "S2"}
    assert (got["S1"].case_title, got["S1"].case_url, got["S1"].named) == ("A v. B", "https://courts.example/s?id=1", {"court_of_appeal_case": "B7", "trial_court": "T9"})
    assert (got["S2"].case_title, got["S2"].case_url, got["S2"].court_of_appeal_case_number, got["S2"].named) == ("C v. D", "", "", {})
    other = listings.results_table(page(spark, "<table><tr><th>No</th></tr><tr><td>Z</td><td>1</td></tr></table>")).collect()
    assert [(r.case_number, r.court_of_appeal_case_number, r.named) for r in other] == [("Z", "1", {"column_1": "1"})]


def result(inner, more=""):
    return f'<div class="coveo-list-layout CoveoResult" {more}>{inner}</div>'


def test_result_rows_and_their_documents(spark):
    field = lambda name, value: f'<span class="CoveoFieldValue" data-field="@{name}"><span>l</span><span>{value}</span></span>'
    record = json.dumps({"clickUri": "", "uri": "ftp://no", "raw": {"fileuri": "https://d/raw.pdf"}}).replace('"', "&quot;")
    twice = json.dumps({"printableUri": "/p/print"}).replace('"', "&amp;quot;")
    title = '<div class="coveo-result-cell c-title"><span class="CoveoResultLink">{}</span></div>'
    body = "".join([
        result(title.format("T1") + '<div class="coveo-result-cell c-date"><span class="CoveoFieldValue"><span>1/2</span></span></div><span class="CoveoExcerpt">E</span>' + field("publicationtype", "Pub") + field("source", "Src") + field("size", "9 KB") + field("syspages", "3") + '<a class="CoveoResultLink" href="/d/one.pdf">x</a>'),
        result(title.format("T2") + '<a class="CoveoResultLink" href="#" data-u="javascript:open(&#39;https://x/two.pdf&#39;)">x</a>'),
        result('<span class="CoveoFieldValue" data-field="@uri"><span>//h/three</span></span>'),
        result(f'<b data-result="{record}"></b>'),
        result(f'<b data-result="not json"></b><i data-result="{twice}"></i>'),
        result("<p>text with https://y/six.pdf?z inside</p>"),
        result("<p>nothing</p>"),
    ])
    got = sorted((r.row, r.title, r.pdf_url) for r in listings.result_rows(page(spark, body)).collect())
    assert got == [(1, "T1", "https://courts.example/d/one.pdf"), (2, "T2", "https://x/two.pdf"), (3, "row_3", "https://h/three"), (4, "row_4", "https://d/raw.pdf"), (5, "row_5", "https://courts.example/p/print"), (6, "row_6", "https://y/six.pdf?z"), (7, "row_7", "")]
    first = listings.result_rows(page(spark, body)).filter("row = 1").first()
    assert (first.date, first.excerpt, first.publication, first.source, first["size"], first.pages) == ("1/2", "E", "Pub", "Src", "9 KB", "3")


def test_folders_of_cases(spark):
    df = spark.createDataFrame([("1-2", "a-b", "c", 7), ("", "", "c d", 8), ("1:3", None, "", 9), (None, "", None, 10)], "n string, s string, o string, id int").coalesce(1)
    assert [r[0] for r in df.select(bulk.case_folder("n", "s", "o", "id")).collect()] == ["1-2_a-b", "c-d", "13", "case_10"]
    assert [r[0] for r in spark.createDataFrame([("ca2",), ("xx",)], "c string").coalesce(1).select(bulk.court_name("c")).collect()] == ["2nd Circuit", "xx"]


def test_opinions_are_cut_before_they_are_grouped(spark):
    dockets = spark.createDataFrame([("1", "ca1", "1-1", "", "D", "")], "id string, court_id string, docket_number string, docket_number_core string, case_name string, case_name_short string")
    clusters = spark.createDataFrame([("10", "1", "2020-01-01", "N", "slug")], "id string, docket_id string, date_filed string, case_name string, slug string")
    names = ["id", "cluster_id", *bulk.TEXT_FIELDS, "per_curiam", "extracted_by_ocr", "author_str", "type", "sha1", "page_count", "download_url", "date_created"]
    opinions = spark.createDataFrame([tuple(("5", "10", *["t"] * (len(names) - 2))), tuple(("6", "99", *["t"] * (len(names) - 2)))], names)
    got = bulk.cases(dockets, clusters, opinions, 2019, 2021)
    assert [(r.folder, r.court_name, len(r.opinions)) for r in got.collect()] == [("1-1_slug", "1st Circuit", 1)]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("collect_list") < plan.index("LeftSemi")


# ---- operators ----


def test_aggregates_and_limits(spark):
    rows = spark.createDataFrame([(1, "May", [1, 2]), (2, "April", None), (3, "May", [])], "seq int, month string, items array<int>")
    assert [(r.month, r.n_rows, r.first_seen.seq) for r in aggregate.counts_as_first_seen(rows, "month", ["seq"]).collect()] == [("May", 2, 1), ("April", 1, 2)]
    assert aggregate.total_listed(rows, "items", "items").first()[0] == 4 and aggregate.total_listed(rows.limit(0), "items").first()[0] == 0
    sample = [tuple(r) for r in aggregate.field_sample(rows.select("seq", "month", F.lit("x" * 99).alias("long"), F.lit(None).cast("int").alias("none")), ["seq"], most=3).collect()]
    assert sample == [("long", "x" * 60, 4), ("month", "May", 4), ("none", "(null)", 4)]
    ids = spark.createDataFrame([(0, None), (None, "a"), (5, "b")], "id int, phase string")
    assert [r.id for r in limits.with_id(ids).collect()] == [5]
    assert [r.id for r in limits.in_phases(ids, "phase", ["b"]).collect()] == [0, 5]
    assert limits.first_pages(rows.withColumnRenamed("seq", "page"), "page", 2).count() == 1
    assert sorted(tuple(r) for r in joins.tasks(spark, 2020, 2021, ["a", "b"]).collect()) == [(2020, "a"), (2020, "b"), (2021, "a"), (2021, "b")]
    assert joins.each_with(rows, F.col("items"), "item").count() == 2
    assert [tuple(r) for r in joins.filled(ids, {"phase": "new", "n": 1}).collect()] == [(0, "new", 1), (None, "a", 1), (5, "b", 1)]
    ties = spark.createDataFrame([("u", 1, "x"), ("u", 1, "y"), (None, 1, "z"), ("", 2, "w")], "url string, seq int, name string")
    assert sorted((r.name, r.fetch_status) for r in dedupe.fetch_once(ties, "url", ["seq"]).collect()) == [("w", "no_pdf_url"), ("x", "to_fetch"), ("y", "skipped_duplicate_url"), ("z", "no_pdf_url")]


def test_the_paged_source_stops_by_total_and_sends_parameters(spark):
    asked = []

    class Pages(BaseHTTPRequestHandler):
        def do_GET(self):
            query = parse_qs(urlparse(self.path).query)
            asked.append(query)
            n = int(query.get("page", ["0"])[0])
            body = json.dumps({"count": 5, "results": [{"id": 2 * n}, {"id": 2 * n + 1}], "next": f"/api?page={n + 1}"}).encode()
            self.send_response(200)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *args):
            pass

    server = HTTPServer(("127.0.0.1", 0), Pages)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    url = f"http://127.0.0.1:{server.server_port}/api"
    read = lambda **o: list(paged.PagedReader({"urls": url, **o}).read(paged._Start(paged.PagedReader({"urls": url, **o}).starts[0])))
    assert len(read(page_size="2")) == 6
    assert len(read(max_pages="2")) == 4
    asked.clear()
    read(max_pages="1", court="ca1", filed_from="2020-01-01", filed_to="2020-12-31", order_by="-date_filed,id")
    assert asked == [{"court": ["ca1"], "date_filed__gte": ["2020-01-01"], "date_filed__lte": ["2020-12-31"], "order_by": ["-date_filed,id"]}]
    server.shutdown()


# ---- names ----


def test_registered_names_read_like_the_functions(spark):
    assert register(spark)[:5] == ["paged_json", "clean_ws", "slugify", "folder_name", "first_filled"]
    df = spark.createDataFrame([(t,) for t in (" A_b  v. C--d!", None, "a/b:c  d-.", " é\n", "***")], "t string").coalesce(1)
    df.createOrReplaceTempView("names_t")
    got = [tuple(r) for r in spark.sql("SELECT clean_ws(t), slugify(t), folder_name(t), first_filled(t, 'x') FROM names_t").collect()]
    want = [tuple(r) for r in df.select(text.clean_ws("t"), text.slugify("t"), text.folder_name("t"), text.first_filled("t", F.lit("x"))).collect()]
    assert got == want


def test_the_command_line_lists_queries(capsys):
    command.main([])
    assert "flagship_parent_child_coverage" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        command.main(["nosuch"])


@pytest.mark.parametrize("gone", [("caselake/llm", "tests/llm"), ("caselake/llm", "tests/llm", "corpus_pipeline.py")])
def test_the_entry_works_without_the_separable_part(tmp_path, gone):
    """The whole repository but exactly what is taken away; a folder left empty counts as gone too."""
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    copy = tmp_path / "repo"
    left_out = {os.path.join(root, g) for g in gone}
    shutil.copytree(root, copy, ignore=lambda folder, names: [n for n in names if n in (".git", "__pycache__", ".pytest_cache") or os.path.join(folder, n) in left_out])
    (copy / "caselake/llm/__pycache__").mkdir(parents=True)
    code = "import __spark_entry__ as e; assert len(e.queries()) >= 50 and set(e.oracle_sql()) <= set(e.queries()); assert not any(q.startswith('op') or q == 'pipeline' for q in e.queries())"
    env = {**os.environ, "PYTHONPATH": str(copy)}
    subprocess.run([sys.executable, "-c", code], cwd=copy, check=True, env=env)
    # the rest of the tests can be collected, and those of functions pass
    subprocess.run([sys.executable, "-m", "pytest", "tests", "-q", "--collect-only"], cwd=copy, check=True, env=env, stdout=subprocess.DEVNULL)
    subprocess.run([sys.executable, "-m", "pytest", "tests/test_functions.py", "-q"], cwd=copy, check=True, env=env, stdout=subprocess.DEVNULL)


# ---- the catalogue ----


@pytest.mark.parametrize("name", sorted(n for n, f in catalogue.QUERIES.items() if f.__module__ == rendered.__name__))
def test_rendered_pages_equal_their_sql(spark, name):
    import duckdb

    duck = duckdb.connect()
    for t in ("customer", "supplier", "part", "orders", "nation"):
        duck.sql(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.001/{t}.parquet'")
    got = catalogue.QUERIES[name](spark, "/root/testdata/sf0.001")
    columns = sorted(got.columns)
    want = duck.sql(f"SELECT {', '.join(columns)} FROM ({catalogue.SQL[name]})")
    assert sorted(duck.sql(catalogue.SQL[name]).columns) == columns
    rows = sorted(tuple(map(str, r)) for r in got.select(*columns).collect())
    assert rows == sorted(tuple(map(str, r)) for r in want.fetchall()) and rows


@pytest.mark.parametrize("name", ["dedupe_across_runs", "resume_antijoin"])
def test_queries_of_increments_are_not_empty(spark, name):
    assert catalogue.QUERIES[name](spark, "/root/testdata/sf0.01").count() > 0
