"""Listings, the bulk pipeline, unification and sources on small invented inputs."""

import json
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer

from pyspark.sql import functions as F

from caselake.plans import bulk, listings, unify
from caselake.sources import captures, html, paged, sinks

URL = "https://courts.example/list/page.html"


def page(spark, body, url=URL):
    return spark.createDataFrame([(url, f"<html><body>{body}</body></html>")], "url string, html string")


def dicts(df):
    return [r.asDict() for r in df.collect()]


def test_selectors():
    root = html.parse('<div id="a" class="x y"><p>1<p>2<ul><li><a href="/f.PDF">k</a><li>m<ul><li>n</ul></ul></div><br><div class="x">z')
    text = lambda s: [e.text() for e in html.select(root, s)]
    assert text("p") == ["1", "2 k m n"] or text("p")[0] == "1"
    assert text("#a > ul > li") or text("li") == ["k", "m n", "n"]
    assert text(".x.y a[href$=.PDF]") == ["k"] and text('a[href*="f."]') == ["k"] and text("a[href^=q], div.x") and text("nav") == []


def test_case_tables(spark):
    body = """<table><tr><th>Date</th><th>No</th><th>Title</th><th>File</th></tr>
      <tr><td>Jan. 3, 2025</td><td><a href="/c?filename=1">101</a></td><td>* A v. B</td><td>op</td></tr>
      <tr><td>Feb. 3, 2025</td><td><a href="c2">102</a></td><td>II</td><td>C v. D</td><td>op</td></tr>
      <tr><td>Feb. 4, 2025</td><td><a href="c3">103</a></td><td>V</td><td>x</td><td>op</td></tr>
      <tr><td>Feb. 5, 2025</td><td>104</td><td>no link</td><td>op</td></tr><tr><td>a</td><td>b</td><td>c</td></tr></table>"""
    got = dicts(listings.case_tables(page(spark, body)).orderBy("case_number"))
    assert [(r["case_number"], r["division"], r["case_title"]) for r in got] == [("101", "", "A v. B"), ("102", "II", "C v. D"), ("103", "", "V")]
    assert got[0]["case_info_url"] == "https://courts.example/c?filename=1" and got[1]["case_info_url"] == "https://courts.example/list/c2"


def test_month_tables(spark):
    row = lambda d, n: f'<tr><td>{d}</td><td><a href="c{n}">{n}</a></td><td>T</td><td>f</td></tr>'
    body = f"<table>{row('x', 1)}{row('Apr. 2', 2)}</table><h3>March 2025</h3><table>{row('x', 3)}</table><table>{row('x', 4)}</table>"
    assert sorted((r.case_number, r.month) for r in listings.month_tables(page(spark, body)).collect()) == [("2", "April"), ("3", "March"), ("4", "March")]


def test_years(spark):
    body = '<a href="?byYear&crtLevel=S&pubStatus=PUB">2024 |</a><a href="?byYear&crtLevel=C&pubStatus=PUB">2023</a><a href="?byYear&crtLevel=S&pubStatus=UNP">2022</a><a href="x">no</a>'
    assert [r.year for r in listings.year_links(page(spark, body)).collect()] == [2024, 2023, 2022]
    assert [r.year for r in listings.year_links(page(spark, body), "S", "PUB").collect()] == [2024]


def test_result_cards(spark):
    body = """<div class="result-excerpt"><span class="case-number">S1</span><h3>A</h3><span class="notation">Supreme Court • Opinion • x</span><a href="/v?doc_no=S1">i</a><a href="/opinions/documents/S1.PDF?v">p</a></div>
      <div class="result-excerpt"><a href="/v?doc_no=S2">i</a><span class="notation">Appeal</span></div><div class="result-excerpt"><h3>none</h3></div>"""
    got = dicts(listings.result_cards(page(spark, body)).orderBy("case_number"))
    assert [(r["case_number"], r["court"], r["opinion_type"], r["pdf_url"]) for r in got] == [("S1", "Supreme Court", "Opinion • x", "https://courts.example/opinions/documents/S1.PDF?v"), ("S2", "Appeal", "", "")]


def test_badge_cards(spark):
    body = """<article class="w-100"><div class="card mb-3"><span class="badge">A-1</span><span class="badge">App</span><h5 class="card-title"><a href="/a1">One</a></h5><a href="a1.pdf">pdf</a><button data-bs-target="#m1">s</button></div>
      <div class="card mb-3"><h5 class="card-title">Two</h5></div><div class="card"><span class="badge">no</span></div></article><div class="modal" id="m1"><div class="modal-body"><p>First.</p><p>Second.</p></div></div>"""
    got = dicts(listings.badge_cards(page(spark, body)).orderBy("position"))
    assert [(r["no"], r["court"], r["case_name"], r["description"]) for r in got] == [("A-1", "App", "One", "First. Second."), ("", "", "Two", "")]
    assert len(dicts(listings.badge_cards(page(spark, body), "div.card"))) == 3


def test_articles_metadata_and_grids(spark):
    body = '<article><h2><a href="/n">N</a></h2><span>Court</span><span> </span><span>20 C 1</span><span>Filed</span><p>d</p><a href="x.pdf">p</a></article><article><span>Only</span></article>'
    got = dicts(listings.dated_articles(page(spark, body)))
    assert [(r["court"], r["docket"], r["status"]) for r in got] == [("Court", "20 C 1", "Filed"), ("Only", "", "")]
    got = dicts(listings.dated_articles(page(spark, body), "Business"))
    assert [(r["court"], r["docket"], r["status"]) for r in got] == [("Business", "Court", "Filed"), ("Business", "Only", "Only")]
    body = '<li class="result"><span class="case-id">7</span><a href="/d">t</a><span class="meta">C</span><span class="meta">1/2/25</span><span class="meta">x</span><span class="meta">y</span></li><li class="result"></li>'
    assert [(r["court"], r["date"], r["citation"]) for r in dicts(listings.metadata_items(page(spark, body)))] == [("C", "1/2/25", "x | y"), ("", "", "")]
    body = '<div role="row"><div data-column-id="1">1/2/25</div><div data-column-id="3">N1</div><div data-column-id="4"><a href="a.pdf">a</a></div></div><div role="row"><div data-column-id="3">N2</div><a href="b.pdf">b</a></div><div role="row">h</div>'
    assert [(r["case_no"], r["pdf_url"][-5:]) for r in dicts(listings.grid_rows(page(spark, body)).orderBy("position"))] == [("N1", "a.pdf"), ("N2", "b.pdf")]


def test_sections(spark):
    body = """<ul><li>S24A0000. Early <a href="0.pdf">o</a></li></ul><h3>January</h3><p><strong>January 5, 2025 — SUMMARIES</strong></p>
      <ul><li><a href="1.pdf">S24A0001, S24A0002. Doe v. State</a></li><li>S24A0003. No link</li></ul><h3>February</h3><ul><li><a href="2.pdf">S24A0004. Roe</a></li></ul>"""
    got = dicts(listings.sectioned_items(page(spark, body)).orderBy("case_id"))
    assert [(r["case_id"], r["month"], r["date"], r["case_title"]) for r in got] == [("S24A0001", "January", "January 5, 2025", "Doe v. State"), ("S24A0002", "January", "January 5, 2025", "Doe v. State"), ("S24A0004", "February", "January 5, 2025", "Roe")]


def test_terms(spark):
    body = """<table><tr><td>R-</td><td>Date</td><td>Docket</td><td>Name</td><td>J.</td><td>Pt.</td></tr><tr><td>1</td><td>1/14/26</td><td>24-1</td><td><a href="/o/24-1.pdf">A v. B</a></td><td>R</td><td>607/1</td></tr>
      <tr><td>Revisions: 1</td><td>1/2/26</td><td>a</td><td><a href="x.pdf">b</a></td><td>c</td></tr><tr><td>2</td><td>soon</td><td>24-2</td><td><a href="y.pdf">C</a></td><td>K</td><td>q</td></tr><tr><td>3</td><td>1/9/26</td><td>24-3</td><td>no link</td><td>K</td><td>q</td></tr></table>"""
    got = dicts(listings.term_rows(page(spark, body, "https://x.example/opinions/slipopinion/25")))
    assert [(r["term_year"], r["docket"], r["justice"], r["citation"]) for r in got] == [(2025, "24-1", "R", "607/1")]
    links = '<a href="slipopinion/24">a</a><a href="/opinions/slipopinion/25/">b</a><a href="slipopinion/24">c</a><a href="slipopinion/x">d</a>'
    assert [r.nn for r in listings.term_links(page(spark, links, "https://x.example/opinions/")).collect()] == [25, 24]


def test_links_and_states(spark):
    assert dicts(listings.next_pages(page(spark, '<a class="next" href="n9">x</a><a rel="next" href="n2">x</a>')))[0]["next_url"].endswith("/list/n2")
    first = lambda body, url=URL: dicts(listings.pdf_links(page(spark, body, url)))[0]["pdf_url"]
    assert first('<a href="a.pdf">other</a><a href="b.pdf">Slip Opinion</a>').endswith("b.pdf")
    assert first('<embed src="/e.pdf"><script>"https://z.example/q.pdf"</script>') == "https://courts.example/e.pdf"
    assert first('<script>x = "https://z.example/q.pdf"</script>') == "https://z.example/q.pdf"
    assert first("nothing", "https://c.example/info?filename=871051MAJ") == "https://c.example/opinions/pdf/871051.pdf"
    state = dicts(listings.page_state(page(spark, "<b>1 - 4</b> of 4 Records Found. 1-9 of 1,234 results")))[0]
    assert (state["blocked"], state["n_results"], state["records"]["total"]) == (False, 1234, 4)


DOCKET = "id string, court_id string, docket_number string, docket_number_core string, case_name string, case_name_short string"
CLUSTER = "id string, docket_id string, date_filed string, case_name string, slug string"
OPINION = "id string, cluster_id string, per_curiam string, extracted_by_ocr string, author_str string, type string, sha1 string, page_count string, download_url string, date_created string, " + ", ".join(f"{c} string" for c in bulk.TEXT_FIELDS)


def tables(spark):
    opinion = lambda i, c, **t: (i, c, "t", "f", "J", "010", "s", "14", "u", "2020-01-01", *[t.get(f) for f in bulk.TEXT_FIELDS])
    dockets = spark.createDataFrame([("1", "ca9", "20-1234", "x", "Doe v. Roe", "Doe"), ("2", "txs", "20-1", "x", "Out", "Out"), ("3", "ca1", "20-9", "x", "", "")], DOCKET)
    clusters = spark.createDataFrame([("10", "1", "2020-02-03", "Doe", "doe"), ("11", "1", "2020-05-03", "Doe", "doe"), ("12", "2", "2020-01-01", "o", "o"), ("13", "9", "2020-01-01", "o", "o"), ("14", "1", "abcd", "", ""), ("15", "3", "", "", ""), ("16", "3", "2013-12-31", "Late", ""), ("17", "1", "2021-01-01", "n", "n")], CLUSTER)
    opinions = spark.createDataFrame([opinion("103", "10", plain_text="late"), opinion("101", "10", html_with_citations=" \n", html="<p>x"), opinion("x", "11", plain_text="p"), opinion("104", None), opinion("105", "99"), opinion("106", "16")], OPINION)
    return dockets, clusters, opinions


def test_bulk(spark, tmp_path):
    got = {r.cluster_id: r for r in bulk.cases(*tables(spark), 2013, 2021).collect()}
    assert sorted(got) == [10, 11, 16]
    assert [(o.id, o.text, o.per_curiam) for o in got[10].opinions] == [(101, "<p>x", True), (103, "late", True)]
    assert got[10].n_in_folder == got[11].n_in_folder == 2 and got[16].n_in_folder == 1 and got[10].folder == "20-1234_doe" and got[11].opinions[0].id is None
    assert tuple(bulk.losses(*tables(spark), 2013, 2021).first()) == (3, 2, 1)
    out = str(tmp_path / "cases")
    for _ in range(2):
        sinks.write_cases(bulk.cases(*tables(spark), 2013, 2021), out, ["court", "year"])
    assert spark.read.parquet(out).count() == 3 and {r.court for r in spark.read.parquet(out).select("court").collect()} == {"ca9", "ca1"}


def test_unified(spark):
    wa = spark.createDataFrame([("101", "A v. B", "Jan. 3, 2025", "Success")], "case_number string, case_title string, file_date string, download_status string")
    us = spark.createDataFrame([("24-1", "C v. D", "1/14/26", "failed: X", "")], "docket string, name string, date string, download_status string, citation string")
    got = {r.jurisdiction: r for r in unify.all_cases({"WA": wa, "US": us}).collect()}
    assert (got["WA"].case_id, str(got["WA"].filed_date), got["WA"].year, got["WA"].month, got["WA"].fetch_status) == ("101", "2025-01-03", 2025, "01", "fetched")
    assert (got["US"].case_id, str(got["US"].filed_date), got["US"].fetch_status, got["US"].citation) == ("24-1", "2026-01-14", "failed", None)
    words = {"Download failed - will retry": "failed", "PDF URL not found": "missing", "already_exists": "cached", "failed_html_instead_of_pdf": "failed", "skipped_duplicate_url": "skipped", "pdf:ok|zip:ok": "fetched", "pdf:fail": "failed", "no-file": "missing", "blocked_html_saved": "blocked", "pending": "pending", "": "pending"}
    df = spark.createDataFrame(list(words.items()), "s string, want string")
    assert df.filter(unify.fetch_status("s") != F.col("want")).collect() == []


def test_captured_files(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "1.html").write_text("<p>x</p>\n<p>y</p>")
    (tmp_path / "a" / "1.json").write_text('[{"id": 1}, {"id": 2}]')
    (tmp_path / "2.json").write_text('{"id": 3}')
    (tmp_path / "3.json").write_text("{broken")
    (tmp_path / "d.csv").write_text('id,t\n1,"two\nlines ""q"""\n2, \n')
    assert [r.html for r in captures.pages(spark, str(tmp_path)).collect()] == ["<p>x</p>\n<p>y</p>"]
    read = captures.records(spark, str(tmp_path), "id int").collect()
    assert sorted(r.id for r in read if r.id is not None) == [1, 2, 3] and [r.path[-6:] for r in read if r["_corrupt"]] == ["3.json"]
    assert captures.bulk_csv(spark, str(tmp_path / "d.csv"), "id string, t string").collect()[0].t == 'two\nlines "q"'
    assert {(r.name, r.folder.rsplit("/", 1)[1]) for r in captures.files(spark, str(tmp_path), "*.html").collect()} == {("1.html", "a")}
    assert [r.id for r in captures.keys_in_csv(spark, str(tmp_path / "d.csv"), "id").orderBy("id").collect()][0] == "1"


class _Pages(BaseHTTPRequestHandler):
    def do_GET(self):
        n = int(self.path.rsplit("=", 1)[1])
        body = json.dumps({"results": [{"id": n * 10 + i} for i in range(3)], "next": f"/p?cursor={n + 1}" if n < 2 else None}).encode()
        self.send_response(200)
        self.end_headers()
        self.wfile.write(body)

    def log_message(self, *args):
        pass


def test_paged_source(spark):
    server = HTTPServer(("127.0.0.1", 0), _Pages)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        spark.dataSource.register(paged.PagedSource)
        base = f"http://127.0.0.1:{server.server_port}/p?cursor="
        read = spark.read.format("paged_json").option("urls", f"{base}0 {base}2")
        got = sorted(json.loads(r.record)["id"] for r in read.load().collect())
        assert got == [0, 1, 2, 10, 11, 12, 20, 20, 21, 21, 22, 22]
        assert read.option("limit", "2").load().count() == 4
    finally:
        server.shutdown()


def test_sinks_run_again(spark, tmp_path):
    df = spark.createDataFrame([(1, ("x",))], "a int, b struct<c:string>")
    for _ in range(2):
        sinks.export_csv([df], str(tmp_path / "csv"))
        sinks.append_once(df.select("a"), str(tmp_path / "log"), "r1")
    sinks.append_once(df.select("a"), str(tmp_path / "log"), "r2")
    assert [tuple(r) for r in spark.read.option("header", True).csv(str(tmp_path / "csv")).collect()] == [("1", "x")]
    assert spark.read.parquet(str(tmp_path / "log")).count() == 2


def test_elements_go_back_a_few_pages_at_a_time(spark):
    import pyarrow as pa
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_type

    read = []

    def find(text):
        read.append(text)
        return html.found_elements(text, {"a": ("a", {})})

    page = "<a href=x>t</a>" * 300
    batch = pa.RecordBatch.from_arrays([pa.array(range(20)), pa.array([page, None] * 10)], ["n", "html"])
    out = html.element_batches([batch], find, to_arrow_type(T.DataType.fromDDL(f"array<{html.ELEMENT}>")))
    first = next(out)
    assert len(read) <= 4 and [len(r) for r in first["element"].to_pylist()] == [256, 44] * 2 and first["n"].to_pylist() == [0, 0, 2, 2]
    assert sum(len(r) for b in out for r in b["element"].to_pylist()) == 8 * 300
    rows = html.elements(spark.createDataFrame([(1, page, "u"), (2, None, "v")], "n int, html string, url string"), {"a": ("a", {})})
    assert rows.columns == ["n", "url", "element"] and rows.filter("n = 1 AND url = 'u' AND element.text = 't'").count() == 300
    assert "MapInArrow" in rows._jdf.queryExecution().executedPlan().toString()


def test_pages_go_to_python_a_few_megabytes_at_a_time(spark, monkeypatch):
    import pyarrow as pa

    def sizes(batches, find, listed):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0)[:1], pa.array([[{"kind": str(b.num_rows), "position": b.nbytes}]], listed)], ["url", "element"])

    monkeypatch.setattr(html, "element_batches", sizes)
    size = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(size)
    spark.conf.unset(size)
    try:
        pages = spark.range(0, 300, 1, 1).select(F.col("id").cast("string").alias("url"), F.repeat(F.lit("x"), 100_000).alias("html"))
        got = html.elements(pages, {"a": ("a", {})}).select("element.*").collect()
        assert sum(int(r.kind) for r in got) == 300 and max(r.position for r in got) < 5_000_000
        spark.conf.set(size, "1m")
        html.elements(pages, {"a": ("a", {})})
        assert spark.conf.get(size) == "1m"
    finally:
        spark.conf.set(size, before)


def test_cards_of_many_pages_are_not_held_at_once(spark, monkeypatch):
    import os

    real = html.found_elements

    def found(*args, **more):
        rows = real(*args, **more)
        with open("/proc/self/statm") as f:
            held = int(f.read().split()[1]) * os.sysconf("SC_PAGE_SIZE") >> 20
        return [r | {"parts": [(p, [x | {"text": f"{os.getpid()} {held}"} for x in items] if p == "date" else items) for p, items in r["parts"]]} for r in rows]

    monkeypatch.setattr(html, "found_elements", found)
    size = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(size)
    spark.conf.unset(size)
    try:
        card = F.concat(F.lit("<div class=result-excerpt><i class=case-number>S1</i><i class=date>1</i><h3>"), F.repeat(F.lit("x"), 100_000), F.lit("</h3></div>"))
        pages = spark.range(0, 1000, 1, 1).select(F.lit(URL).alias("url"), card.alias("html"))
        got = [r.date.split() for r in listings.result_cards(pages).select("date").collect()]
    finally:
        spark.conf.set(size, before)
    held = [int(mb) for _, mb in got]
    # several batches have gone through by the 200th page; the rest add nothing
    assert len(got) == 1000 and len({pid for pid, _ in got}) == 1 and max(held) - max(held[:200]) < 60, held[::50]
