"""Plans of bounded size, and the sources, sinks and streams of the third round."""

import json
import os
import threading
import time
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qs, urlencode, urlparse

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from caselake.functions import urls
from caselake.operators import variants
from caselake.plans import bulk, candidates, catalogue, listings, rendered, round_trips, stored, table_functions
from caselake.register import register
from caselake.sources import captures, case_files, paged, split_csv
from caselake.streaming import tries

SMALL = "/root/testdata/sf0.001"


def plan_size(df):
    return len(df._jdf.queryExecution().analyzed().toString())


def test_addresses_have_small_plans(spark):
    df = spark.createDataFrame([("a", "b")], "a string, b string")
    assert plan_size(df.select(urls.resolved("a", "b"))) < 20_000
    assert plan_size(df.select(urls.normalized("b", F.col("a")))) < 20_000
    assert plan_size(df.select(urls.looks_like_pdf(urls.normalized("b", F.col("a"))))) < 40_000


@pytest.mark.parametrize("name", sorted(n for n, f in catalogue.QUERIES.items() if f.__module__ == rendered.__name__))
def test_listings_have_small_plans(spark, name):
    catalogue.QUERIES[name](spark, SMALL)
    began = time.time()
    size = plan_size(catalogue.QUERIES[name](spark, SMALL))
    assert size < 50_000 and time.time() - began < 10


# ---- extracts read by many tasks ----

CSV_SCHEMA = "id int, text string, more string"


def csv_text(rows, end, escape):
    """As a database writes it: quotes around what needs them, now and then around what does not."""
    def field(v, always):
        if v is None:
            return ""
        special = always or v == "" or any(c in v for c in '",\n\r\\') or v != v.strip()
        return '"' + v.replace(escape, escape * 2).replace('"', escape + '"' if escape != '"' else '"') + '"' if special else v

    return "".join(",".join(field(v, i % 3 == 0) for i, v in enumerate(r)) + end for r in [("id", "te\nxt" if end == "\n" else "text", "more"), *rows])


def csv_rows(seed, n):
    import random

    rng = random.Random(seed)
    bits = ["a", "é", '"', '""', "\n", "\n\n", ",", " ", "\r\n", '",', '\n"', "x" * 40, "", "'"]
    some = lambda: None if rng.random() < 0.1 else "".join(rng.choice(bits) for _ in range(rng.randint(0, 9)))
    return [(str(i), some(), some()) for i in range(n)]


def same_rows(got, want):
    key = lambda r: tuple((v is not None, v) for v in r)
    return sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, want), key=key)


@pytest.fixture
def cut_into(spark):
    """Sets the size of splits, and puts the session's own back."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    before = {n: spark.conf.get(n, None) for n in names}

    def cut(size, tasks=64):
        for n, v in zip(names, (size, size, tasks)):
            spark.conf.set(n, str(v))

    yield cut
    for n, v in before.items():
        spark.conf.unset(n) if v is None else spark.conf.set(n, v)


@pytest.mark.parametrize("end,escape", [("\n", '"'), ("\r\n", '"'), ("\n", "\\")])
def test_split_extracts_equal_the_one_task_reader(spark, tmp_path, cut_into, end, escape):
    for name, seed, n in (("a.csv", 1, 60), ("b.csv", 2, 25), ("c.csv", 3, 0)):
        (tmp_path / name).write_bytes(csv_text(csv_rows(seed, n), end, escape).encode())
    (tmp_path / "long.csv").write_bytes(csv_text([("7", "l\n" * 400 + '"', "z"), ("8", None, "")], end, escape).encode())
    want = captures.whole_csv(spark, str(tmp_path), CSV_SCHEMA, escape=escape).collect()
    assert len(want) == 87 and len({r.id for r in want}) == 60
    for size in (40, 300, 10**6):
        cut_into(size)
        got = split_csv.split_csv(spark, str(tmp_path), CSV_SCHEMA, escape=escape)
        assert same_rows(got, want)
        lines = split_csv._lines(spark, str(tmp_path))
        assert size > 100 or lines.select("path", "start").distinct().count() > 20


def test_split_extracts_of_a_splittable_codec(spark, tmp_path, cut_into):
    import bz2
    import random

    rng = random.Random(5)
    rows = [(str(i), "\n".join("".join(rng.choices('abcdefghij "klmnop,', k=60)) for _ in range(rng.randint(1, 6))), None) for i in range(6000)]
    (tmp_path / "x.csv.bz2").write_bytes(bz2.compress(csv_text(rows, "\n", '"').encode(), 1))
    cut_into(100_000, 8)
    got = split_csv.split_csv(spark, str(tmp_path), CSV_SCHEMA)
    assert split_csv._lines(spark, str(tmp_path)).select("start").distinct().count() > 3
    assert same_rows(got, captures.whole_csv(spark, str(tmp_path), CSV_SCHEMA).collect())


def test_split_extracts_without_rows_or_header(spark, tmp_path, cut_into):
    (tmp_path / "e.csv").write_text("")
    assert split_csv.split_csv(spark, str(tmp_path), CSV_SCHEMA).count() == 0
    (tmp_path / "f.csv").write_text('1,"a\nb",\n\n2,c,d\n3,"open\nend')
    cut_into(5)
    got = sorted(tuple(r) for r in split_csv.split_csv(spark, str(tmp_path), CSV_SCHEMA, header=False).collect())
    assert [r[:2] for r in got] == [(1, "a\nb"), (2, "c"), (3, "open\nend")]


# ---- table functions ----


def test_table_functions_read_awkward_pages(spark):
    names = table_functions.register_tables(spark)
    pages = spark.createDataFrame([(1, None, "http://h/"), (2, "", None), (3, "<a href=x>2024 |</a><a>2023</a><a href='/y'>2022</a><a href=x>2024</a>", None), (4, "<tr><td>", "http://h/25")], "id int, html string, url string")
    for name in names[:-1]:
        if name == "listed_opinion_counts":  # a row for each page
            continue
        got = spark.sql(f"SELECT p.id, c.* FROM {{pages}} AS p, LATERAL {name}(p.html, p.url) AS c", pages=pages).collect()
        assert sorted(tuple(r) for r in got) == ([(3, 2022, "/y"), (3, 2024, "x")] if name == "listed_years" else [])
    plan = spark.sql("SELECT p.id, c.* FROM {pages} AS p, LATERAL listed_cards(p.html, p.url) AS c", pages=pages)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    with pytest.raises(AnalysisException, match="html must be a string"):
        spark.sql("SELECT * FROM listed_cards(1, 'x')")


def test_table_functions_agree_with_the_extractors(spark):
    row = lambda d, n, t="T": f'<tr><td>{d}</td><td><a href="c{n}">{n}</a></td><td>{t}</td><td>f</td><td>g</td></tr>'
    body = f"<table>{row('x', 1)}{row('Apr. 2', 2, 'III')}</table><h3>March 2025</h3><table>{row('x', 3, '* A')}</table><h4>none</h4><table>{row('x', 4)}</table>"
    body += "<article><h2><a href=a>B</a></h2><span>C</span><span>D</span><p>E</p><a href=z.zip>z</a></article><div class=result-excerpt><a href='v?doc_no=S%2F9&amp;x=1'>i</a></div>"
    body += "<h3>M</h3><p><strong>Jan 1 - x — </strong></p><ul><li>S24A0001, S24A0002 name <a href=/q.PDF>p</a></li></ul>"
    body += "<ul><li class=result><b class=case-id>1</b><i class=title>T</i><a href=d>x</a><p class=meta>C</p><p class=meta>D</p><p class=meta>E</p><p class=meta>F</p></li></ul><a rel=next href='?p=2'>n</a><a href=/slipopinion/24/>t</a><a href=/slipopinion/24/>u</a>"
    pages = spark.createDataFrame([("https://h/l/25", body), ("https://h/m", "<div>")], "url string, html string")
    same = {"listed_case_tables": listings.month_tables, "listed_articles": listings.dated_articles, "listed_cards": listings.result_cards, "listed_sections": listings.sectioned_items, "listed_terms": listings.term_rows, "listed_grid": listings.grid_rows, "listed_items": listings.metadata_items, "listed_term_links": listings.term_links, "listed_next": listings.next_pages, "listed_opinion_counts": listings.opinion_counts, "listed_plain_tables": listings.plain_case_tables, "listed_results": listings.results_table, "listed_search": listings.result_rows}
    for name, read in same.items():
        want = read(pages)
        got = table_functions.read_by(name)(pages).select(*want.columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())), name
    assert table_functions.read_by("listed_sections")(pages).count() == 2


def test_values_are_carried_forward_within_partitions(spark):
    table_functions.register_tables(spark)
    rows = spark.createDataFrame([("a", 1, None), ("a", 2, "x"), ("a", 3, None), ("b", 1, None), (None, 1, "y"), (None, 2, None)], "k string, o int, v string")
    ask = "SELECT k, o, w FROM carry_forward(TABLE(SELECT * FROM {rows}) PARTITION BY k ORDER BY (o), '%s', '%s')"
    got = spark.sql(ask % ("v", "w"), rows=rows).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, [("a", 1, None), ("a", 2, "x"), ("a", 3, "x"), ("b", 1, None), (None, 1, "y"), (None, 2, "y")]))
    for wrong in (("z", "w"), ("v", "o")):
        with pytest.raises(AnalysisException):
            spark.sql(ask % wrong, rows=rows)


# ---- the paged service ----


class Service:
    """Records behind a local address, filtered and ordered by the service's own parameters; ``asked`` holds what it was asked."""

    def __init__(self, records, size=3):
        self.records, self.size, self.asked, self.failures = list(records), size, [], []
        outer = self

        class Pages(BaseHTTPRequestHandler):
            def do_GET(self):
                query = {k: v[0] for k, v in parse_qs(urlparse(self.path).query).items()}
                if outer.failures and (code := outer.failures.pop(0)):
                    self.send_response(code)
                    self.end_headers()
                    return
                page = int(query.pop("page", 0))
                if not page:
                    outer.asked.append(dict(query))
                rows = [r for r in outer.records if all(outer.fits(r, k, v) for k, v in query.items())]
                for key in reversed([k for k in query.get("order_by", "").split(",") if k]):
                    rows.sort(key=lambda r: r[key.lstrip("-")], reverse=key.startswith("-"))
                rest = urlencode(query | {"page": page + 1})
                body = {"count": len(rows), "results": rows[page * outer.size : (page + 1) * outer.size], "next": f"?{rest}" if (page + 1) * outer.size < len(rows) else None}
                self.send_response(200)
                self.end_headers()
                self.wfile.write(json.dumps(body).encode())

            def log_message(self, *args):
                pass

        self.server = ThreadingHTTPServer(("127.0.0.1", 0), Pages)
        threading.Thread(target=self.server.serve_forever, daemon=True).start()
        self.url = f"http://127.0.0.1:{self.server.server_port}/api"

    @staticmethod
    def fits(r, k, v):
        name, _, how = k.partition("__")
        if name == "order_by":
            return True
        have = r.get(name)
        return have is not None and {"": have == v, "gte": have >= v, "lte": have[: len(v)] <= v}[how]


@pytest.fixture
def service():
    courts, made = ["ca1", "ca2", "cafc", None], []

    def make(n, **kw):
        rows = [{"id": i, "court": courts[i % 4], "date_filed": None if i % 11 == 0 else f"20{20 + i % 4}-0{1 + i % 9}-1{i % 3}", "date_modified": f"2024-01-0{1 + i // 7 % 8}T00:00:00Z", "name": f"n{i}", "more": {"x": i}} for i in range(n)]
        made.append(Service(rows, **kw))
        return made[-1]

    yield make
    for s in made:
        s.server.shutdown()


TYPED = "id bigint, court string, date_filed date, date_modified timestamp, name string, more string"


@pytest.mark.parametrize(
    "where,asked",
    [
        ("court = 'ca1'", [{"court": "ca1"}]),
        ("court IN ('ca1', 'cafc') AND date_filed >= DATE '2021-03-11'", [{"court": c, "date_filed__gte": "2021-03-11"} for c in ("ca1", "cafc")]),
        ("date_filed BETWEEN DATE '2021-01-01' AND DATE '2022-12-31' AND length(name) = 3", [{"date_filed__gte": "2021-01-01", "date_filed__lte": "2022-12-31"}]),
        ("date_filed > DATE '2021-02-11' AND name <> 'n5'", [{"date_filed__gte": "2021-02-11"}]),
        ("date_filed = DATE '2021-02-11' OR court = 'ca2'", [{}]),
        ("court = 'ca1' AND court = 'ca2'", []),
        ("court IS NULL", [{}]),
        ("date_modified >= TIMESTAMP '2024-01-04 00:00:00'", [{"date_modified__gte": "2024-01-03"}]),
    ],
)
def test_conditions_become_parameters_of_the_service(spark, service, where, asked):
    register(spark)
    s = service(50)
    rows = spark.read.format("paged_json").schema(TYPED).option("urls", s.url).load()
    want = sorted(map(str, (r for r in rows.collect())))
    assert len(want) == 50
    told = spark.createDataFrame(rows.collect(), TYPED).filter(where)
    s.asked.clear()
    got = sorted(map(str, rows.filter(where).collect()))
    assert got == sorted(map(str, told.collect())) and (got or not asked)
    key = lambda a: sorted(a.items())
    distinct = [dict(t) for t in {tuple(sorted(a.items())) for a in s.asked}]
    assert sorted(distinct, key=key) == sorted(asked, key=key)


def test_ranges_are_read_by_year_and_options_hold(spark, service):
    register(spark)
    s = service(50)
    read = spark.read.format("paged_json").schema(TYPED).options(urls=s.url, by_year="true", filed_from="2021-05-01", court="ca2").load()
    s.asked.clear()
    got = read.filter("date_filed <= DATE '2023-02-12'")
    assert got.rdd.getNumPartitions() == 3
    want = sorted(r["id"] for r in s.records if r["court"] == "ca2" and r["date_filed"] and "2021-05-01" <= r["date_filed"] <= "2023-02-12")
    assert sorted(r.id for r in got.collect()) == want and want
    assert {(a["date_filed__gte"], a["date_filed__lte"], a["court"]) for a in s.asked} == {("2021-05-01", "2021-12-31", "ca2"), ("2022-01-01", "2022-12-31", "ca2"), ("2023-01-01", "2023-02-12", "ca2")}
    assert read.filter("court = 'ca1'").count() == 0


def test_a_failing_service_is_tried_again_and_then_fails(spark, service):
    from urllib.error import HTTPError

    s = service(7)
    s.failures = [503, 0, 429]
    read = lambda **o: paged.PagedReader({"urls": s.url, "seconds_before_retry": "0.01", **o})
    first = read()
    assert [json.loads(r[2])["id"] for r in first.read(first.partitions()[0])] == list(range(7))
    for failures in ([500] * 3, [404]):
        s.failures = list(failures)
        with pytest.raises(HTTPError):
            list(first.read(first.partitions()[0]))
        assert not s.failures
    assert [paged.wait_before(n, 10) for n in (1, 2, 6, 2000)] == [10, 20, 300, 300] and paged.wait_before(2, 10, 429) == 60


def test_a_stream_of_changes_goes_on_where_it_stopped(spark, service, tmp_path):
    register(spark)
    s = service(20)
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")

    def run():
        stream = spark.readStream.format("paged_json").schema(TYPED).option("urls", s.url).load()
        stream.select("id", "name", F.date_format("date_modified", "dd").alias("day")).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
        return sorted((r.id, r.name) for r in spark.read.parquet(out).collect())

    first = [(i, f"n{i}") for i in range(20)]
    assert run() == first and run() == first
    last = s.records[-1]["date_modified"]
    s.records += [dict(s.records[0], id=i, name="tie", date_modified=last) for i in (30, 31)]  # of the very time of the last one
    s.records[3] = dict(s.records[3], name="changed", date_modified="2024-02-01T00:00:00Z")
    s.asked.clear()
    more = sorted([*first, (30, "tie"), (31, "tie"), (3, "changed")])
    assert run() == more
    assert [a["date_modified__gte"] for a in s.asked if "date_modified__gte" in a] and all(a["date_modified__gte"] == last for a in s.asked if "date_modified__gte" in a)
    # a batch that ran but was not committed runs again, and the sink drops it
    newest = max(int(f) for f in os.listdir(f"{checkpoint}/commits") if f.isdigit())
    for f in (f"{newest}", f".{newest}.crc"):
        os.remove(f"{checkpoint}/commits/{f}")
    assert run() == more
    s.records += [dict(s.records[0], id=32, name="late", date_modified="2024-02-01T00:00:00Z")]
    assert run() == sorted([*more, (32, "late")])
    empty = service(0)
    assert paged.PagedStream({"urls": empty.url}).latestOffset() == {"modified": "", "id": -1}


# ---- state with an end ----

OUTCOMES = "k string, at timestamp, status string, n int"


def outcome(k, second, status, n=0):
    import datetime

    return (k, datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=second), status, n)


def run_stream(spark, make, source, checkpoint, sink):
    """Batches of one file each, whatever there is; what came out, and the state's rows at the end."""
    stream = spark.readStream.schema(OUTCOMES).option("maxFilesPerTrigger", 1).parquet(source)

    def keep(batch, number):
        batch.write.mode("overwrite").parquet(f"{sink}/{number}")

    query = make(stream).writeStream.foreachBatch(keep).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    states = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    folders = sorted(os.listdir(sink), key=int)
    return [tuple(r) for f in folders for r in spark.read.parquet(f"{sink}/{f}").collect()], states


@pytest.fixture
def stateful(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    yield tries.with_state(spark)
    spark.conf.set(name, before)
    spark.conf.unset("spark.sql.streaming.noDataMicroBatches.enabled")


def test_failed_keys_are_tried_again_by_timers_and_forgotten(stateful, tmp_path):
    spark, source = stateful, str(tmp_path / "in")
    add = lambda *rows: spark.createDataFrame(list(rows), OUTCOMES).coalesce(1).write.mode("append").parquet(source)
    make = lambda s: tries.next_tries(s, "k", "status", "at", "1 second", base=10, most=3, keep_seconds=100).select("k", "event", "tries", F.unix_seconds("at") - 1704067200, "statuses")
    check, sink = str(tmp_path / "cp"), str(tmp_path / "out")
    add(outcome("a", 0, "failed"), outcome("b", 0, "429"), outcome("c", 1, "Success"), outcome(None, 1, "failed"), outcome("d", 0, None))
    got, _ = run_stream(spark, make, source, check, sink)
    assert set(got) == {("a", "wait", 1, 10, "failed"), ("b", "wait", 1, 30, "429"), ("c", "done", 0, 1, ""), ("d", "wait", 1, 10, "")}
    add(outcome("z", 20, "Success"))  # the watermark passes 10: a and d are due
    add(outcome("a", 25, "Success"), outcome("b", 21, "failed"), outcome("b", 22, "failed"), outcome("d", 21, "429"))
    add(outcome("z", 1000, "Success"))  # all is due, then forgotten
    before = len(got)
    got, states = run_stream(spark, make, source, check, sink)
    assert set(got[before:]) == {
        ("z", "done", 0, 20, ""), ("a", "retry", 1, 10, "failed"), ("d", "retry", 1, 10, ""), ("a", "done", 0, 25, ""), ("b", "given up", 3, 22, "429,failed,failed"), ("d", "wait", 2, 81, ",429"),
        ("z", "done", 0, 1000, ""), ("d", "retry", 2, 81, ",429"), ("d", "forgotten", 2, 181, ",429"), ("b", "forgotten", 3, 122, "429,failed,failed"),
    }
    assert max(states) > 0 and states[-1] == 0
    replay, _ = run_stream(spark, make, source, str(tmp_path / "cp2"), str(tmp_path / "out2"))
    assert sorted(replay) == sorted(got)


def test_phases_are_forgotten_by_the_clock(stateful, tmp_path):
    spark, source = stateful, str(tmp_path / "in")
    add = lambda *rows: spark.createDataFrame(list(rows), OUTCOMES).coalesce(1).write.mode("append").parquet(source)
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")  # by the clock there is always another one
    run = lambda keep, cp: run_stream(spark, lambda s: tries.furthest_phase_kept(s, "k", "status", ["one", "two"], keep), source, str(tmp_path / cp), str(tmp_path / f"out{cp}"))[0]
    add(outcome("a", 0, "one"), outcome("b", 0, "two"), outcome("c", 0, "none"))
    for keep, cp in ((3600, "long"), (1, "short")):
        assert sorted(run(keep, cp)) == [("a", "one", 1), ("b", "two", 2)]
    time.sleep(1.5)
    add(outcome("a", 0, "two"), outcome("b", 0, "one"))
    assert sorted(run(3600, "long"))[2:] == [("b", "two", 2)] and len(run(3600, "long")) == 3
    assert sorted(run(1, "short")) == [("a", "one", 1), ("a", "two", 2), ("b", "one", 1), ("b", "two", 2)]


def test_due_tries_of_a_table(spark):
    rows = [outcome("a", 0, "failed"), outcome("a", 5, "Success"), outcome("a", 6, "429"), outcome("b", 1, "failed", 1), outcome("b", 1, "Success", 2), outcome("c", 0, None), outcome("c", 9, "failed"), *[outcome("d", i, "x") for i in range(9)], outcome(None, 0, "x"), ("e", None, "x", 0)]
    got = tries.due_tries(spark.createDataFrame(rows, OUTCOMES), "k", "status", "at", ["n"], base=10, most=5)
    assert sorted(tuple(r) for r in got.select("k", "tries", "status", F.unix_seconds("due") - 1704067200).collect()) == [("a", 1, "429", 36), ("c", 2, "failed", 29), ("d", 9, "x", None)]
    assert tries.due_tries(spark.createDataFrame([], OUTCOMES), "k", "status", "at", []).count() == 0
    seconds = spark.range(1, 70).select("id", *[tries.wait_seconds(F.col("id"), F.lit(t), 2.0).alias(str(t)) for t in (True, False)]).collect()
    assert all(r["True"] == paged.wait_before(r.id, 2.0, 429) and r["False"] == paged.wait_before(r.id, 2.0) for r in seconds)


# ---- files of cases ----

CASES = "court string, year int, folder string, docket string, cluster struct<id:int,name:string>, opinion string, id int"


def case_rows(spark, rows):
    return spark.createDataFrame(rows, CASES)


def held(spark, uri):
    return {(r.court, r.year, r.folder, r.kind, r.number): r.json for r in case_files.case_files(spark, uri).collect()}


def test_case_files_are_published_as_a_whole(spark, tmp_path):
    uri = f"file://{tmp_path}/tree"
    assert case_files.case_files(spark, uri) is None
    first = [("ca1", 2020, "1-1_a", '{"id": 1}', (10, "x"), '{"id": 100}', 2), ("ca1", 2020, "1-1_a", '{"id": 9}', (11, "é"), None, 3), ("ca2", 2021, "b +%c", None, None, '{"id": 200}', 1)]
    case_files.write_case_files(case_rows(spark, first), uri, ["id"])
    want = {
        ("ca1", 2020, "1-1_a", "docket", 1): '{"id": 1}', ("ca1", 2020, "1-1_a", "cluster", 1): '{"id":10,"name":"x"}', ("ca1", 2020, "1-1_a", "cluster", 2): '{"id":11,"name":"é"}',
        ("ca1", 2020, "1-1_a", "opinion", 1): '{"id": 100}', ("ca2", 2021, "b +%c", "opinion", 1): '{"id": 200}',
    }
    assert held(spark, uri) == want
    # a run that fails in one of its tasks leaves the old tree, and its rest can be pruned
    bad = [*[("ca3", 2022, f"f{i}", "{}", None, None, i) for i in range(40)], ("ca3", 2022, "a/b", "{}", None, None, 1)]
    for wrong in (bad, [("ca1", 2020, None, "{}", None, None, 1)], [("ca1", 2020, "..", "{}", None, None, 1)]):
        with pytest.raises(Exception, match="no name for a folder"):
            case_files.write_case_files(case_rows(spark, wrong), uri, ["id"])
    assert held(spark, uri) == want and len(os.listdir(tmp_path / "tree/_versions")) == 1
    case_files.prune_case_files(uri)
    assert held(spark, uri) == want and case_files.prune_case_files(uri) == 0
    # a folder that is written again counts as a whole, others stay
    case_files.write_case_files(case_rows(spark, [("ca1", 2020, "1-1_a", "{}", None, None, 1)]), uri, ["id"])
    assert held(spark, uri) == {("ca1", 2020, "1-1_a", "docket", 1): "{}", ("ca2", 2021, "b +%c", "opinion", 1): '{"id": 200}'}
    case_files.write_case_files(case_rows(spark, [("cadc", 1999, "z", "{}", None, None, 1)]), uri, ["id"], overwrite=True)
    assert held(spark, uri) == {("cadc", 1999, "z", "docket", 1): "{}"}
    case_files.write_case_files(case_rows(spark, []), uri, ["id"], overwrite=True)
    assert held(spark, uri) == {} and case_files.prune_case_files(uri) > 0


def test_documents_of_cases(spark, tmp_path):
    uri = f"file://{tmp_path}/tree"
    kind = CASES + ", files array<struct<name:string,content:binary>>"
    rows = [
        ("ca1", 2020, "a", "{}", None, None, 1, [("x y+z.pdf", b"%PDF\x00\xff"), ("docket.json", b"[]"), ("none.pdf", None)]), ("ca1", 2020, "a", None, None, None, 2, [("x y+z.pdf", b"second")]),
        ("ca1", 2020, "b", "{}", None, None, 3, []), ("ca2", 2021, "c", None, None, None, 4, [("e.pdf", b"e")]),
    ]
    case_files.write_case_files(spark.createDataFrame(rows, kind), uri, ["id"])
    told = lambda: {(r.court, r.folder, r.name): bytes(r.content) for r in case_files.case_documents(spark, uri).collect()}
    want = {("ca1", "a", "x y+z.pdf"): b"%PDF\x00\xff", ("ca1", "a", "docket.json"): b"[]", ("ca2", "c", "e.pdf"): b"e"}
    assert told() == want and set(held(spark, uri)) == {("ca1", 2020, "a", "docket", 1), ("ca1", 2020, "b", "docket", 1)}
    case_files.write_case_files(spark.createDataFrame([("ca1", 2020, "a", "{}", None, None, 1, [("n.pdf", b"n")])], kind), uri, ["id"])
    assert told() == {("ca1", "a", "n.pdf"): b"n", ("ca2", "c", "e.pdf"): b"e"}
    with pytest.raises(Exception, match="no name for a folder or file"):
        case_files.write_case_files(spark.createDataFrame([("ca1", 2020, "a", "{}", None, None, 1, [("../n.pdf", b"n")])], kind), uri, ["id"])


def test_a_writer_that_is_killed_leaves_the_version(tmp_path):
    """As the driver sees it: tasks that never report, an abort, and two commits of one number."""
    uri = f"file://{tmp_path}/tree"
    row = {"court": "c", "year": 1, "folder": "f", "docket": "{}", "cluster": None, "opinion": "{}", "files": None}
    writer = case_files.CaseWriter(uri, False)
    done, lost = writer.write(iter([row])), writer.write(iter([row, row]))
    assert lost.files == {"docket": 1, "opinion": 2} and not os.path.exists(tmp_path / "tree/_versions")
    writer.abort([lost, None])
    assert os.listdir(tmp_path / "tree/data") == [done.attempt.split("/")[1]]
    writer.commit([done, None])
    assert sorted(os.listdir(tmp_path / "tree/_versions")) == ["000000000001.json"]


def test_conditions_on_court_and_year_leave_other_folders_unread(spark, tmp_path):
    uri = f"file://{tmp_path}/tree"
    rows = [(c, y, f"f{i}", "{}", None, None, i) for c in ("ca1", "ca2", "ca3") for y in (2020, 2021) for i in range(3)]
    case_files.write_case_files(case_rows(spark, rows), uri, ["id"])
    some = case_files.case_files(spark, uri).filter("court = 'ca1' AND year = 2021")
    assert len(some.collect()) == 3
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(court" in plan
    courts = spark.createDataFrame([("ca2", "x"), ("ca9", "y")], "court string, name string").write.mode("overwrite")
    courts.parquet(f"{tmp_path}/courts")
    joined = case_files.case_files(spark, uri).join(spark.read.parquet(f"{tmp_path}/courts").filter("name = 'x'"), "court")
    assert joined.count() == 6
    assert "dynamicpruning" in joined._jdf.queryExecution().executedPlan().toString()


def test_readers_list_the_index_and_not_the_cases(spark, tmp_path):
    uri = f"file://{tmp_path}/tree"
    kind = CASES + ", files array<struct<name:string,content:binary>>"
    rows = [(c, 2020 + i % 2, f"f{i}", f'{{"id": {i}}}', None, None, i, [("n.pdf", b"n")] if i == 7 else []) for c in ("01", "c%41 d") for i in range(150)]
    rows += [("01", 2020, "files", "{}", None, "", 1, [])]
    case_files.write_case_files(spark.createDataFrame(rows, kind), uri, ["id"])
    listed = case_files.case_files(spark, uri)
    assert len(listed.inputFiles()) <= 4 * spark.sparkContext.defaultParallelism
    want = {(r[0], r[1], r[2], "docket", 1): r[3] for r in rows}
    papers = lambda: {(r.court, r.year, r.folder, r.name, r.length, bytes(r.content)) for r in case_files.case_documents(spark, uri).collect()}
    told = {(c, 2021, "f7", "n.pdf", 1, b"n") for c in ("01", "c%41 d")}
    assert held(spark, uri) == want and papers() == told
    # a case that is written again without documents has none, those written without an index are listed
    os.rename(tmp_path / "tree/index", tmp_path / "gone")
    old = held(spark, uri)
    assert {k: v for k, v in old.items() if k[0] == "01"} == {k: v for k, v in want.items() if k[0] == "01"} and len(old) == len(want)
    case_files.write_case_files(case_rows(spark, [("01", 2021, "f7", "{}", None, None, 1)]), uri, ["id"])
    assert held(spark, uri).get(("01", 2021, "f7", "docket", 1)) == "{}" and len(held(spark, uri)) == len(want) and len(papers()) == 1


def test_files_go_back_a_few_at_a_time(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(case_files, "_READ_BYTES", 1000)
    uri = f"file://{tmp_path}/tree"
    rows = [("ca1", 2020, f"f{i}", json.dumps({"id": i, "t": "é" * (i * 37 % 700)}, ensure_ascii=False), None, None, i) for i in range(60)]
    case_files.write_case_files(case_rows(spark, rows), uri, ["id"])
    assert held(spark, uri) == {(*r[:3], "docket", 1): r[3] for r in rows}


# ---- JSON of no known schema ----


def test_roots_and_keys_of_any_json(spark):
    rows = [
        (1, '{"a": 1, "b": {"c": true, "d.e": "x"}}'), (2, '[{"a": "s"}, {"b": {"c": null}, "l": [1, {"z": 2}]}, 5, null]'), (3, "{broken"), (4, None), (5, "[]"), (6, "7"),
        (7, '{"b": 3, "it\'s": 1.50, "OBJECT<x: y": 2, "e": {}, "é ü": ""}'), (8, '{"b_c": "later"}'),
    ]
    df = spark.createDataFrame(rows, "n int, json string").withColumn("x", F.lit(1))
    records = variants.opened(df, "json")
    assert records.columns == ["n", "json", "x", "record"] and records.count() == 5
    assert sorted(r.n for r in variants.unread(df, "json").collect()) == [3, 4]
    out = variants.key_union(records, keep=("n",))
    assert out.columns == ["n", "OBJECT<x: y", "a", "b", "e", "it's", "l", "é ü"] or "b" in out.columns
    got = {(r.n, r.a): r for r in out.collect()}
    assert got[1, "1"]["b"] == '{"c":true,"d.e":"x"}' and got[7, ""]["b"] == "3" and got[7, ""]["it's"] == "1.5" and got[7, ""]["OBJECT<x: y"] == "2"
    assert any(r.l == '[1,{"z":2}]' for r in out.collect())
    even = variants.opened(spark.createDataFrame([('{"b": {"c": true, "d.e": "x"}}',), ('{"b": {"c": null}, "b_c": "later"}',), ("{}",)], "json string"), "json")
    assert sorted(tuple(r) for r in variants.key_union(even).collect()) == [("", ""), ("later", ""), ("true", "x")] and variants.key_union(even).columns == ["b_c", "b_d.e"]
    for none in (df.limit(0), df.filter("n IN (3, 5)")):
        assert variants.key_union(variants.opened(none, "json"), keep=("n",)).columns == ["n"]


# ---- data stored for joins ----


def test_a_stored_join_moves_no_texts(spark, tmp_path):
    names = ["id", "cluster_id", *bulk.TEXT_FIELDS, "per_curiam", "extracted_by_ocr", "author_str", "type", "sha1", "page_count", "download_url", "date_created"]
    dockets = spark.createDataFrame([(str(i), "ca1" if i % 2 else "xx", f"1-{i}", f"D{i}") for i in range(20)], "id string, court_id string, docket_number string, case_name string")
    clusters = spark.createDataFrame([(str(100 + i), str(i % 25), f"20{10 + i % 5}-01-01", "" if i % 3 else f"C{i}") for i in range(60)] + [(None, "1", "2011-01-01", "x")], "id string, docket_id string, date_filed string, case_name string")
    opinions = spark.createDataFrame([tuple([str(i), str(100 + i % 70) if i % 7 else "none", *[f"t{i}"] * (len(names) - 2)]) for i in range(200)], names)
    stored.store(dockets, clusters, opinions, "kept", buckets=8, path=str(tmp_path / "kept"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = stored.stored_cases(spark, "kept", 2011, 2013)
        want = bulk.cases(dockets.withColumn("docket_number_core", F.lit("")).withColumn("case_name_short", F.lit("")), clusters.withColumn("slug", F.lit("")), opinions, 2011, 2013)
        key = lambda r: (r.cluster_id, r.court, r.case_name, len(r.opinions), r.opinions[0].text)
        assert sorted(map(key, got.collect())) == sorted(map(key, want.collect())) and got.count() > 5
        plan = got._jdf.queryExecution().executedPlan().toString()
        final = plan[: plan.index("== Initial Plan ==")] if "== Initial Plan ==" in plan else plan
        texts = next(line for line in final.splitlines() if "FileScan" in line and "text#" in line)
        above = final.splitlines()[: final.splitlines().index(texts)]
        # from the scan of texts up to the root only what encloses it counts: lines with less indentation
        depth, enclosing = len(texts) - len(texts.lstrip(" :+-")), []
        for line in reversed(above):
            indent = len(line) - len(line.lstrip(" :+-"))
            if indent < depth:
                depth = indent
                enclosing.append(line)
        assert "Bucketed: true" in texts and not any("Exchange" in line for line in enclosing)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        for t in ("dockets", "clusters", "opinions"):
            spark.sql(f"DROP TABLE IF EXISTS kept_{t}")


# ---- candidate addresses ----


def test_the_first_captured_place_counts(spark):
    base = "https://www.courts.ca.gov/opinions/"
    cases = spark.createDataFrame([(" s1 ", 1), ("S2", 2), ("S3", 3), ("", 4), (None, 5), ("S2", 6), ("S4", 7), ("S5", 8)], "no string, n int")
    captured = spark.createDataFrame([(f"{base}archive/S1.PDF",), (f"{base}revnppub/S1.PDF",), (f"{base}documents/S2.PDF",), (f"{base}documents/S2.PDF",), (None,)], "url string")
    listed = spark.createDataFrame([("S4", "/x/other.PDF"), ("S4", "/x/s4-a.pdf"), ("S2", "/s2.PDF"), ("S5", "/none.html"), (None, "/y.pdf")], "no string, href string")
    got = {r.n: (r.pdf_url, r["rank"]) for r in candidates.first_found(cases, "no", captured, "url", listed=listed).collect()}
    none = (None, None)
    assert got == {1: (f"{base}archive/S1.PDF", 2), 2: (f"{base}documents/S2.PDF", 1), 3: none, 4: none, 5: none, 6: (f"{base}documents/S2.PDF", 1), 7: ("/x/s4-a.pdf", 4), 8: none}
    assert candidates.candidates(cases, "no").count() == 18 and candidates.first_found(cases.limit(0), "no", captured, "url").count() == 0


@pytest.mark.parametrize("name", sorted(n for n, f in catalogue.QUERIES.items() if f.__module__ == round_trips.__name__))
def test_round_trips_equal_their_sql(spark, name):
    import duckdb

    duck = duckdb.connect()
    for t in ("documents", "supplier", "events", "orders", "customer", "lineitem", "pages"):
        duck.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    got = catalogue.QUERIES[name](spark, SMALL)
    columns = sorted(got.columns)
    show = lambda rows: sorted(tuple("null" if v is None else f"{v:.9g}" if isinstance(v, float) else str(v) for v in r) for r in rows)
    want = duck.sql(catalogue.SQL[name])
    order = [want.columns.index(c) for c in columns]
    assert show(got.select(*columns).collect()) == show([[r[i] for i in order] for r in want.fetchall()]) and want.fetchall()


def test_statuses_by_whole_words(spark):
    from caselake.plans import unify

    words = {"token refresh": "pending", "lookup broken": "pending", "ok": "fetched", "pdf:ok": "fetched", "OK.": "fetched", "not ok?": "fetched", "saved": "fetched"}
    df = spark.createDataFrame(list(words.items()), "s string, want string")
    assert df.filter(unify.fetch_status("s") != F.col("want")).collect() == []
