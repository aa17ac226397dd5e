from pyspark.sql import functions as F

from caselake.operators import aggregate, dedupe, joins, limits, nested
from caselake.streaming import incremental


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def test_joins_keep_what_they_say(spark):
    kids = spark.createDataFrame([(1, 10), (2, 11), (3, None), (4, 10)], "id int, p int")
    keys = spark.createDataFrame([(10,), (10,), (None,)], "p int")
    assert rows(joins.members(kids, keys, "p"), "id") == [(1,), (4,)]
    assert rows(joins.orphans(kids, keys, "p"), "id") == [(2,), (3,)]
    assert rows(joins.known_or_unkeyed(kids, keys, "p"), "id", "orphan") == [(1, False), (3, True), (4, False)]


def test_enrichment_and_upsert(spark):
    partial = spark.createDataFrame([(1, "p", None), (2, "p", "x")], "id int, s string, t string")
    full = spark.createDataFrame([(1, "f", None)], "id int, s string, t string")
    assert rows(joins.enriched(partial, full, "id"), "id", "s", "t") == [(1, "f", None), (2, "p", "x")]
    new = spark.createDataFrame([(2, "n", "y"), (3, "n", "z")], "id int, s string, t string")
    once = joins.upserted(partial, new, ["id"])
    assert rows(once, "id", "s") == [(1, "p"), (2, "n"), (3, "n")]
    assert rows(joins.upserted(once, new, ["id"]), "id", "s") == [(1, "p"), (2, "n"), (3, "n")]


def test_prefixes(spark):
    pairs = [r[0] for r in joins.letter_pairs(spark).collect()]
    assert len(set(pairs)) == 676 and "AA" in pairs and "ZZ" in pairs
    assert spark.range(1).select(joins.parsed_prefixes(F.lit("ab, C1,zz ,abc"))).first()[0] == ["AB", "ZZ"]


def test_dedupe_flavours(spark):
    df = spark.createDataFrame([(1, "a", 1), (2, "a", 2), (3, None, 3), (4, None, 4), (5, "b", 5)], "seq int, k string, v int")
    assert rows(dedupe.first_wins(df, ["k"], ["seq"]), "k", "v") == [("a", 1), ("b", 5), (None, 3)]
    assert rows(dedupe.last_wins(df, ["k"], ["seq"]), "k", "v", "position.seq") == [("a", 2, 1), ("b", 5, 5), (None, 4, 3)]
    done = spark.createDataFrame([("a",)], "k string")
    assert rows(dedupe.first_across_runs(df, done, ["k"], ["seq"]), "k", "v") == [("b", 5), (None, 3)]
    assert rows(dedupe.collisions(df, "k"), "k", "n_rows") == [("a", 2), (None, 2)]
    assert rows(dedupe.numbered_names(df.filter("k = 'a'"), "k", ["seq"]), "file_name") == [("a",), ("a_2",)]
    assert rows(dedupe.fetch_once(df, "k", ["seq"]), "seq", "fetch_status") == [(1, "to_fetch"), (2, "skipped_duplicate_url"), (3, "no_pdf_url"), (4, "no_pdf_url"), (5, "to_fetch")]


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "seq int, k string, v int")
    assert dedupe.first_wins(empty, ["k"], ["seq"]).count() == 0
    assert dedupe.last_wins(empty, ["k"], ["seq"]).count() == 0
    assert aggregate.collected(empty, "k", ["seq"], ["v"]).count() == 0
    assert limits.pending(empty, empty, ["k"]).count() == 0


def test_aggregates(spark):
    df = spark.createDataFrame([("x", "docket"), ("x", "cluster"), ("x", "opinion"), ("y", "docket"), ("z", "cluster"), ("w", None)], "c string, k string")
    assert rows(aggregate.completeness(df, "c", "k"), "c", "state") == [("w", "partial"), ("x", "complete"), ("y", "docket_only"), ("z", "partial")]
    kids = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (2, 1, "c")], "p int, n int, t string")
    got = aggregate.collected(kids, "p", ["n"], ["t"]).orderBy("p").collect()
    assert [[x.t for x in r.children] for r in got] == [["a", "b"], ["c"]]
    shapes = [r[0] for r in aggregate.collected(kids, "p", ["n"], ["t"]).orderBy("p").select(aggregate.one_or_many(F.col("children"))).collect()]
    assert shapes == ['{"sub_opinions":[{"n":1,"t":"a"},{"n":2,"t":"b"}]}', '{"n":1,"t":"c"}']
    assert rows(aggregate.first_child(kids, "p", ["n"], ["t"]), "p", "t", "n_children") == [(1, "a", 2), (2, "c", 1)]
    covered = spark.createDataFrame([("a", True), ("a", False), ("b", True)], "g string, covered boolean")
    assert rows(aggregate.coverage_report(covered, ["g"]), "g", "total", "n_missing", "pct_covered") == [("a", 2, 1, 50.0), ("b", 1, 0, 100.0)]


def test_nested(spark):
    df = spark.createDataFrame([(1, ("x", [1, 2]))], "a int, b struct<c:string,d:array<int>>")
    assert nested.flattened(df).collect()[0].asDict() == {"a": 1, "b_c": "x", "b_d": "[1,2]"}
    other = spark.createDataFrame([(2, "z")], "a int, e string")
    assert [tuple(r) for r in nested.exported([df, other]).orderBy("a").collect()] == [("1", "x", "[1,2]", ""), ("2", "", "", "z")]
    assert spark.range(1).select(nested.first_key(F.lit('{"p":"","q":{"r":"s"}}'), ["$.p", "$.q.r"])).first()[0] == "s"


def test_limits(spark):
    df = spark.createDataFrame([(1, "a", "1994-01-01"), (2, "a", "1995-05-05"), (3, "b", "abcd"), (4, " ", "1998-01-01")], "id int, g string, d string")
    assert rows(limits.limit_per_group(df, ["g"], [F.desc("id")], 1), "id") == [(2,), (3,), (4,)]
    assert rows(limits.between_years(df, "d", 1995, 1998), "id") == [(2,), (4,)]
    assert rows(limits.pending(df, spark.createDataFrame([("a",)], "g string"), ["g"]), "id") == [(3,)]


def test_stream_upserts_once(spark, tmp_path):
    schema = "k string, v int, seq int"
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    read = lambda: spark.readStream.schema(schema).parquet(source)
    spark.createDataFrame([("a", 1, 1), ("a", 2, 2), ("b", 3, 1)], schema).write.mode("append").parquet(source)
    incremental.upsert_batches(spark, read(), target, ["k"], ["seq"], str(tmp_path / "cp"))
    incremental.upsert_batches(spark, read(), target, ["k"], ["seq"], str(tmp_path / "cp"))
    assert rows(incremental.latest(spark, target), "k", "v") == [("a", 2), ("b", 3)]
    spark.createDataFrame([("b", 9, 5), ("c", 4, 1)], schema).write.mode("append").parquet(source)
    incremental.upsert_batches(spark, read(), target, ["k"], ["seq"], str(tmp_path / "cp"))
    assert rows(incremental.latest(spark, target), "k", "v") == [("a", 2), ("b", 9), ("c", 4)]


def test_retry_is_by_the_latest_status(spark):
    df = spark.createDataFrame([("a", 1, "failed"), ("a", 2, "ok"), ("b", 1, "ok"), ("b", 2, "failed"), ("c", 1, None)], "k string, n int, status string")
    assert rows(incremental.to_retry(df, ["k"], ["n"], ["ok"]), "k") == [("b",), ("c",)]


def test_phases_only_go_forward(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.createDataFrame([("x", "clusters"), ("x", "dockets"), ("y", "dockets")], "c string, phase string").write.parquet(source)
    stream = incremental.furthest_phase(spark.readStream.schema("c string, phase string").parquet(source), "c", "phase", ["dockets", "clusters", "opinions"])
    q = stream.writeStream.outputMode("update").format("memory").queryName("phases").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert rows(spark.table("phases"), "c", "phase", "rank") == [("x", "clusters", 2), ("y", "dockets", 1)]
