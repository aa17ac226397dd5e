"""Queries over the star-schema and document tables, each with its SQL.

Orders stand in for dockets and line items for their clusters, nations for
courts, conversations for opinions in parts, labels for a coverage side, events
for an incremental log, and pages for listing pages.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caselake.functions import dates, text, urls, values
from caselake.operators import aggregate, dedupe, joins, limits, nested

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _day(c: str) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def _us_date(c: str) -> Column:
    return F.date_format(c, "M/d/yy")


# White space and names, as RE2 writes them.
_WS = r"\s\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{1C}-\x{1F}\x{85}\x{0B}"


# ---- joins ----


@query("""
SELECT r_name, n_name, count(*) AS n_parents, count(k) AS n_with_child, count(*) - count(k) AS n_without_child
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
LEFT JOIN (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE year(l_shipdate) BETWEEN 1995 AND 1998) ON k = o_orderkey
GROUP BY r_name, n_name""")
def flagship_parent_child_coverage(spark: SparkSession, d: str) -> DataFrame:
    """For each court, parents with and without a child filed in a range of years."""
    orders, lines = table(spark, d, "orders"), table(spark, d, "lineitem")
    courts = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    placed = orders.join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(courts, F.col("c_nationkey") == F.col("n_nationkey"))
    kept = limits.between_years(lines, "l_shipdate", 1995, 1998).select(F.col("l_orderkey").alias("o_orderkey"))
    return aggregate.parents_with_children(placed, kept, "o_orderkey", ["r_name", "n_name"])


@query("""
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey IN (1, 3)))""")
def semi_join_dim_filter(spark: SparkSession, d: str) -> DataFrame:
    courts = table(spark, d, "nation").filter(F.col("n_regionkey").isin(1, 3)).select(F.col("n_nationkey").alias("c_nationkey"))
    parties = joins.members(table(spark, d, "customer"), courts, "c_nationkey").select(F.col("c_custkey").alias("o_custkey"))
    return joins.members(table(spark, d, "orders"), parties, "o_custkey").select("o_orderkey", "o_custkey", "o_totalprice")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def anti_join_no_children(spark: SparkSession, d: str) -> DataFrame:
    keys = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return joins.orphans(table(spark, d, "orders"), keys, "o_orderkey").select("o_orderkey", "o_custkey")


@query("""
SELECT l_orderkey, l_linenumber, coalesce(nullif(c_name, ''), nullif(o_orderpriority, ''), 'unknown') AS label, n_name AS court
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey AND o_orderstatus <> 'P'
LEFT JOIN customer ON o_custkey = c_custkey AND c_acctbal > 0 LEFT JOIN nation ON c_nationkey = n_nationkey""")
def chained_left_join_resolution(spark: SparkSession, d: str) -> DataFrame:
    parents = table(spark, d, "orders").filter("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderpriority")
    over = table(spark, d, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_nationkey")
    out = joins.resolved_chain(table(spark, d, "lineitem"), parents, over, "l_orderkey", "o_custkey")
    courts = table(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    label = F.coalesce(text.first_filled("c_name", "o_orderpriority"), F.lit("unknown"))
    return out.join(courts, "c_nationkey", "left").select("l_orderkey", "l_linenumber", label.alias("label"), F.col("n_name").alias("court"))


@query("""
WITH l AS (SELECT CASE WHEN doc_id % 7 = 0 THEN NULL ELSE doc_id END AS doc_id, quality, toxic FROM labels)
SELECT doc_id, quality, toxic, doc_id IS NULL AS orphan FROM l WHERE doc_id IS NULL OR doc_id IN (SELECT doc_id FROM documents WHERE lang = 'en')""")
def null_or_known_semi(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "labels").withColumn("doc_id", F.when(F.col("doc_id") % 7 != 0, F.col("doc_id")))
    return joins.known_or_unkeyed(rows, table(spark, d, "documents").filter("lang = 'en'"), "doc_id").select("doc_id", "quality", "toxic", "orphan")


@query("""
SELECT p.o_orderkey, CASE WHEN f.o_orderkey IS NOT NULL THEN f.o_orderstatus ELSE p.o_orderstatus END AS o_orderstatus,
  CASE WHEN f.o_orderkey IS NOT NULL THEN f.o_totalprice ELSE NULL END AS o_totalprice
FROM orders p LEFT JOIN (SELECT * FROM orders WHERE o_orderkey % 3 = 0) f ON p.o_orderkey = f.o_orderkey""")
def upsert_enrichment(spark: SparkSession, d: str) -> DataFrame:
    full = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    partial = full.withColumn("o_totalprice", F.lit(None).cast("double"))
    return joins.enriched(partial, full.filter("o_orderkey % 3 = 0"), "o_orderkey")


@query("""
SELECT user_id, value, source FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY rank) AS n FROM (
    SELECT user_id, max(value) AS value, 'map' AS source, 0 AS rank FROM events WHERE event_type = 'purchase' GROUP BY user_id
    UNION ALL SELECT user_id, max(value), 'cache', 1 FROM events WHERE event_type = 'click' GROUP BY user_id
    UNION ALL SELECT user_id, max(value), 'fetch', 2 FROM events GROUP BY user_id)) WHERE n = 1""")
def lookup_precedence(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events")
    best = lambda rows, name: rows.groupBy("user_id").agg(F.max("value").alias("value"), F.lit(name).alias("source"))
    return joins.preferred([best(events.filter("event_type = 'purchase'"), "map"), best(events.filter("event_type = 'click'"), "cache"), best(events, "fetch")], "user_id")


@query("""
SELECT n_nationkey, n_name, coalesce(r_name, n_regionkey::VARCHAR) AS region FROM nation LEFT JOIN (SELECT * FROM region WHERE r_regionkey < 3) ON n_regionkey = r_regionkey""")
def default_name_lookup(spark: SparkSession, d: str) -> DataFrame:
    names = table(spark, d, "region").filter("r_regionkey < 3").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    return joins.named(table(spark, d, "nation"), names, "n_regionkey", "r_name", "region").select("n_nationkey", "n_name", "region")


@query("SELECT chr((65 + a)::INT) || chr((65 + b)::INT) AS prefix FROM range(26) x(a), range(26) y(b)")
def prefix_cross_product(spark: SparkSession, d: str) -> DataFrame:
    return joins.letter_pairs(spark)


@query("""
SELECT doc_id, quality, toxic FROM labels UNION ALL
SELECT doc_id, 0, 0 FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def upsert_by_key(spark: SparkSession, d: str) -> DataFrame:
    old = table(spark, d, "documents").select("doc_id", F.lit(0).alias("quality"), F.lit(0).alias("toxic"))
    return joins.upserted(old, table(spark, d, "labels").select("doc_id", F.col("quality").cast("int").alias("quality"), F.col("toxic").cast("int").alias("toxic")), ["doc_id"])


# ---- deduplication ----


@query("""
SELECT user_id, event_type, event_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS n FROM events) WHERE n = 1""")
def dedupe_first_wins(spark: SparkSession, d: str) -> DataFrame:
    return dedupe.first_wins(table(spark, d, "events").select("user_id", "event_type", "event_id", "value", "ts"), ["user_id", "event_type"], ["ts", "event_id"]).drop("ts")


@query("""
SELECT user_id, event_type, event_id, value, first_id FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS n,
    first_value(event_id) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS first_id FROM events) WHERE n = 1""")
def dedupe_last_wins(spark: SparkSession, d: str) -> DataFrame:
    out = dedupe.last_wins(table(spark, d, "events").select("user_id", "event_type", "event_id", "value", "ts"), ["user_id", "event_type"], ["ts", "event_id"])
    return out.select("user_id", "event_type", "event_id", "value", F.col("position.event_id").alias("first_id"))


@query("""
SELECT k, doc_id FROM (
  SELECT coalesce(nullif(CASE WHEN doc_id % 3 = 0 THEN '' ELSE source END, ''), nullif(CASE WHEN doc_id % 5 = 0 THEN '' ELSE lang END, ''), 'none') AS k, doc_id,
    row_number() OVER (PARTITION BY coalesce(nullif(CASE WHEN doc_id % 3 = 0 THEN '' ELSE source END, ''), nullif(CASE WHEN doc_id % 5 = 0 THEN '' ELSE lang END, ''), 'none') ORDER BY doc_id) AS n
  FROM documents) WHERE n = 1""")
def dedupe_fallback_key(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "source", "lang")
    key = F.coalesce(text.first_filled(F.when(F.col("doc_id") % 3 == 0, "").otherwise(F.col("source")), F.when(F.col("doc_id") % 5 == 0, "").otherwise(F.col("lang"))), F.lit("none"))
    return dedupe.first_wins(docs.select(key.alias("k"), "doc_id"), ["k"], ["doc_id"])


@query("""
SELECT user_id, event_type, min(event_id) AS event_id FROM events e
WHERE ts >= TIMESTAMP '2024-01-03' AND NOT EXISTS (SELECT 1 FROM events p WHERE p.ts < TIMESTAMP '2024-01-03' AND p.user_id = e.user_id AND p.event_type = e.event_type)
GROUP BY user_id, event_type""")
def dedupe_across_runs(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events").select("user_id", "event_type", "event_id", "ts")
    cut = F.lit("2024-01-03").cast("timestamp_ntz")
    early, late = events.filter(F.col("ts").cast("timestamp_ntz") < cut), events.filter(F.col("ts").cast("timestamp_ntz") >= cut)
    return dedupe.first_across_runs(late, early, ["user_id", "event_type"], ["event_id"]).select("user_id", "event_type", "event_id")


@query("""
SELECT path, count(*) AS n_rows FROM (SELECT lower(replace(p_type, ' ', '-')) || '/' || p_size AS path FROM part) GROUP BY path HAVING count(*) > 1""")
def collision_report(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part").select(F.concat_ws("/", F.lower(F.replace("p_type", F.lit(" "), F.lit("-"))), F.col("p_size").cast("string")).alias("path"))
    return dedupe.collisions(rows, "path")


@query("""
SELECT l_orderkey, l_linenumber, CASE WHEN n = 1 THEN p ELSE p || '_' || n END AS file_name FROM (
  SELECT *, 'cluster' || l_orderkey AS p, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS n FROM lineitem)""")
def suffix_numbering(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").withColumn("p", F.concat(F.lit("cluster"), F.col("l_orderkey").cast("string")))
    return dedupe.numbered_names(rows, "p", ["l_linenumber", "l_partkey", "l_suppkey"]).select("l_orderkey", "l_linenumber", "file_name")


@query("""
SELECT event_id, CASE WHEN user_id % 10 = 0 THEN 'no_pdf_url' WHEN row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1 THEN 'to_fetch' ELSE 'skipped_duplicate_url' END AS fetch_status FROM events""")
def fetch_once_per_url(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").select("event_id", "ts", F.when(F.col("user_id") % 10 != 0, F.concat(F.lit("u"), F.col("user_id").cast("string"))).alias("url"))
    return dedupe.fetch_once(rows, "url", ["ts", "event_id"]).select("event_id", "fetch_status")


@query("SELECT DISTINCT event_type, user_id FROM events")
def distinct_values(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_type", "user_id").distinct()


# ---- aggregates ----


@query("SELECT n_nationkey, n_name, count(*) AS n_customers FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL")
def counts_by_court(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").alias("n_customers"))
    return n.join(table(spark, d, "nation").select("n_nationkey", "n_name"), "n_nationkey").select("n_nationkey", "n_name", "n_customers").orderBy("n_nationkey")


@query("""
SELECT conv_id, count(*) AS n_turns, string_agg(turn || ':' || role || ':' || length(text), '|' ORDER BY turn) AS turns,
  CASE WHEN count(*) = 1 THEN 'one' ELSE 'many' END AS shape FROM conversations GROUP BY conv_id""")
def collect_children(spark: SparkSession, d: str) -> DataFrame:
    got = aggregate.collected(table(spark, d, "conversations"), "conv_id", ["turn"], ["role", "text"])
    line = lambda t: F.concat_ws(":", t["turn"].cast("string"), t["role"], F.char_length(t["text"]).cast("string"))
    return got.select("conv_id", F.size("children").cast("bigint").alias("n_turns"), F.array_join(F.transform("children", line), "|").alias("turns"), F.when(F.size("children") == 1, "one").otherwise("many").alias("shape"))


@query("""
SELECT l_orderkey, l_partkey, l_quantity, n_children FROM (
  SELECT *, count(*) OVER (PARTITION BY l_orderkey) AS n_children, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS n FROM lineitem) WHERE n = 1""")
def first_child_synthesised(spark: SparkSession, d: str) -> DataFrame:
    return aggregate.first_child(table(spark, d, "lineitem"), "l_orderkey", ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity"], ["l_partkey", "l_quantity"])


@query("""
SELECT l_returnflag, l_linestatus, count(*) AS n_rows, (grouping(l_returnflag) + grouping(l_linestatus))::INT AS level
FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)""")
def rollup_counts(spark: SparkSession, d: str) -> DataFrame:
    return aggregate.counts_with_totals(table(spark, d, "lineitem"), "l_returnflag", "l_linestatus")


@query("""
SELECT user_id, count(*) AS total, count(*) FILTER (event_type = 'click') AS click, count(*) FILTER (event_type = 'purchase') AS purchase,
  count(*) FILTER (event_type = 'view') AS view FROM events GROUP BY user_id""")
def status_counters(spark: SparkSession, d: str) -> DataFrame:
    return aggregate.status_counts(table(spark, d, "events"), ["user_id"], "event_type", ["click", "purchase", "view"])


@query("""
WITH p AS (
  SELECT o_orderkey AS c, 'docket' AS k FROM orders WHERE o_orderstatus <> 'P' UNION ALL SELECT l_orderkey, 'cluster' FROM lineitem WHERE l_returnflag <> 'R'
  UNION ALL SELECT l_orderkey, 'opinion' FROM lineitem WHERE l_linestatus = 'O'),
f AS (SELECT c, bool_or(k = 'docket') AS d, bool_or(k = 'cluster') AS cl, bool_or(k = 'opinion') AS o FROM p GROUP BY c)
SELECT CASE WHEN d AND cl AND o THEN 'complete' WHEN d AND NOT cl AND NOT o THEN 'docket_only' ELSE 'partial' END AS state, count(*) AS n_cases FROM f GROUP BY state""")
def completeness_classify(spark: SparkSession, d: str) -> DataFrame:
    part = lambda name, where, key, kind: table(spark, d, name).filter(where).select(F.col(key).alias("c"), F.lit(kind).alias("k"))
    parts = part("orders", "o_orderstatus <> 'P'", "o_orderkey", "docket").unionByName(part("lineitem", "l_returnflag <> 'R'", "l_orderkey", "cluster")).unionByName(part("lineitem", "l_linestatus = 'O'", "l_orderkey", "opinion"))
    return aggregate.completeness(parts, "c", "k").groupBy("state").agg(F.count("*").alias("n_cases"))


@query("""
SELECT d.lang, count(*) AS total, count(l.doc_id) AS n_covered, count(*) - count(l.doc_id) AS n_missing,
  CASE WHEN count(*) > 0 THEN round(100.0::DOUBLE * count(l.doc_id) / count(*), 1) ELSE 0 END AS pct_covered
FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON l.doc_id = d.doc_id GROUP BY d.lang""")
def coverage_pct(spark: SparkSession, d: str) -> DataFrame:
    covered = joins.coverage(table(spark, d, "documents").select("doc_id", "lang"), table(spark, d, "labels"), ["doc_id"])
    return aggregate.coverage_report(covered, ["lang"])


@query("""
SELECT o_orderpriority, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total, min(o_orderkey) AS first_key, (grouping(o_orderpriority) = 1) AS is_total
FROM orders GROUP BY ROLLUP (o_orderpriority)""")
def run_summary(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").rollup("o_orderpriority").agg(F.count("*").alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("total"), F.min("o_orderkey").alias("first_key"), (F.grouping("o_orderpriority") == 1).alias("is_total"))


# ---- text ----


@query(rf"""
WITH t AS (SELECT doc_id, regexp_replace(regexp_replace(lower(text), '[^\p{{L}}\p{{N}}_{_WS}-]', '', 'g'), '^[{_WS}]+|[{_WS}]+$', '', 'g') AS k FROM documents)
SELECT doc_id, coalesce(nullif(regexp_replace(substring(regexp_replace(regexp_replace(k, '[{_WS}_]+', '-', 'g'), '-+', '-', 'g'), 1, 60), '^-+|-+$', '', 'g'), ''), 'unknown') AS slug FROM t""")
def slugify(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", text.slugify("text").alias("slug"))


@query(rf"""
SELECT doc_id,
  substring(regexp_replace(regexp_replace(regexp_replace(text, '[<>:"/\\|?*]', '', 'g'), '[{_WS}]+', '-', 'g'), '^[.-]+|[.-]+$', '', 'g'), 1, 120) AS folder,
  substring(regexp_replace(text, '[<>:"/\\|?*]', '_', 'g'), 1, 50) AS masked,
  substring(regexp_replace(regexp_replace(regexp_replace(text, '[^\p{{L}}\p{{N}}_{_WS}-]', '', 'g'), '[{_WS}]+', '_', 'g'), '^_+|_+$', '', 'g'), 1, 200) AS words,
  regexp_replace(substring(regexp_replace(regexp_replace(regexp_replace(text, '[<>:"/\\|?*]+', '_', 'g'), '[{_WS}]+', ' ', 'g'), '^ +| +$', '', 'g'), 1, 180), ' +$', '') AS runs,
  coalesce(nullif(substring(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '[{_WS}]+', ' ', 'g'), '^ +| +$', '', 'g'), '[^A-Za-z0-9._ -]+', '_', 'g'), '^[._ ]+|[._ ]+$', '', 'g'), 1, 180), ''), 'file') AS listed
FROM documents""")
def sanitize_names(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select(
        "doc_id", text.folder_name("text").alias("folder"), text.masked_name("text", 50).alias("masked"), text.word_name("text").alias("words"), text.run_masked_name("text").alias("runs"), text.listed_name("text").alias("listed")
    )


@query(rf"""SELECT doc_id, regexp_replace(regexp_replace(text, '[{_WS}]+', ' ', 'g'), '^ +| +$', '', 'g') AS clean, length(text) = n_chars AS same_length FROM documents""")
def clean_whitespace(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", text.clean_ws("text").alias("clean"), (F.char_length("text") == F.col("n_chars")).alias("same_length"))


@query(r"""
SELECT doc_id, case_no, i::INT AS position FROM (SELECT doc_id, regexp_extract_all(text, '\b([A-Za-z]*\d{4})\b', 1) AS ids FROM documents), LATERAL (SELECT unnest(ids) AS case_no, unnest(range(1, len(ids) + 1)) AS i)""")
def case_ids_explode(spark: SparkSession, d: str) -> DataFrame:
    found = table(spark, d, "documents").select("doc_id", text.case_numbers("text", r"\b([A-Za-z]*\d{4})\b").alias("ids"))
    return found.select("doc_id", F.posexplode("ids").alias("i", "case_no")).select("doc_id", "case_no", (F.col("i") + 1).alias("position"))


@query(r"""
SELECT doc_id,
  CASE WHEN contains(text, '. ') THEN trim(substring(text, strpos(text, '. ') + 2), chr(9) || chr(10) || chr(13) || ' ')
    ELSE trim(regexp_replace(coalesce(text, ''), '\bS[0-9]{2}[A-Z][0-9]{4}\b', '', 'g'), chr(9) || chr(10) || chr(13) || ' ,.') END AS title,
  CASE WHEN contains(lower(text), 'jan') THEN 'January' WHEN contains(lower(text), 'feb') THEN 'February' WHEN contains(lower(text), 'mar') THEN 'March' WHEN contains(lower(text), 'apr') THEN 'April'
    WHEN contains(lower(text), 'may') THEN 'May' WHEN contains(lower(text), 'jun') THEN 'June' WHEN contains(lower(text), 'jul') THEN 'July' WHEN contains(lower(text), 'aug') THEN 'August'
    WHEN contains(lower(text), 'sep') THEN 'September' WHEN contains(lower(text), 'oct') THEN 'October' WHEN contains(lower(text), 'nov') THEN 'November' WHEN contains(lower(text), 'dec') THEN 'December' END AS month,
  CASE WHEN contains(text, '; ') THEN 2 ELSE 1 END AS n_parts
FROM documents""")
def titles_and_months(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return docs.select("doc_id", text.case_title("text").alias("title"), text.month_in("text").alias("month"), F.size(text.split_once("text", "; ")).alias("n_parts"))


@query(r"""
SELECT doc_id, CASE WHEN doc_id % 3 <> 0 AND regexp_matches(source, '\S') THEN source WHEN doc_id % 2 = 0 THEN lang ELSE text END AS best,
  array_to_string(list_filter([nullif(CASE WHEN doc_id % 4 = 0 THEN '' ELSE source END, ''), nullif(lang, ''), NULL], lambda x: x IS NOT NULL), ';') AS notes
FROM documents""")
def best_text(spark: SparkSession, d: str) -> DataFrame:
    blank = F.when(F.col("doc_id") % 3 == 0, F.lit(" \t\n")).otherwise(F.col("source"))
    second = F.when(F.col("doc_id") % 2 == 0, F.col("lang"))
    notes = text.joined(";", F.when(F.col("doc_id") % 4 == 0, "").otherwise(F.col("source")), "lang", F.lit(None).cast("string"))
    return table(spark, d, "documents").select("doc_id", text.best_text(blank, second, "text").alias("best"), notes.alias("notes"))


# ---- dates, numbers ----


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN strftime(o_orderdate, '%Y') WHEN o_orderkey % 4 = 1 THEN strftime(o_orderdate, '%Y')
  WHEN o_orderkey % 4 = 2 THEN strftime(o_orderdate, '%Y') ELSE NULL END AS year FROM orders""")
def year_heuristic(spark: SparkSession, d: str) -> DataFrame:
    """The year from a date, from a long and from a two-digit docket number, or none."""
    k = F.col("o_orderkey") % 4
    filed = F.when(k == 0, _day("o_orderdate"))
    number = F.when(k == 1, F.concat(F.date_format("o_orderdate", "yyyy"), F.lit("-12"))).when(k == 2, F.concat(F.date_format("o_orderdate", "yy"), F.lit("-345"))).otherwise("X-1")
    return table(spark, d, "orders").select("o_orderkey", dates.docket_year(number, filed).alias("year"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 3 THEN '2000' ELSE strftime(o_orderdate, '%Y') END AS year, CASE WHEN o_orderkey % 4 = 3 THEN '01' ELSE strftime(o_orderdate, '%m') END AS month FROM orders""")
def year_month(spark: SparkSession, d: str) -> DataFrame:
    """Year and month of dates written in three ways; of a fixed day where they can't be read."""
    k = F.col("o_orderkey") % 4
    short = F.concat(F.regexp_replace(F.date_format("o_orderdate", "MMM"), "^Sep$", "Sept"), F.date_format("o_orderdate", ". d, yyyy"))
    written = F.when(k == 0, short).when(k == 1, F.date_format("o_orderdate", "MMMM d, yyyy")).when(k == 2, F.date_format("o_orderdate", "M/d/yyyy")).otherwise("none")
    year, month = dates.year_and_month(written, F.lit("2000-01-01"))
    return table(spark, d, "orders").select("o_orderkey", year.alias("year"), month.alias("month"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%-m/%-d/%y') AS shown, row_number() OVER (PARTITION BY o_custkey ORDER BY strftime(o_orderdate, '%-m/%-d/%y'), o_orderkey) AS as_text, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate::DATE, o_orderkey) AS as_date FROM orders")
def string_date_sort_key(spark: SparkSession, d: str) -> DataFrame:
    """Places within a customer by the date as text, as listings sort, and as a date."""
    rows = table(spark, d, "orders").withColumn("shown", _us_date("o_orderdate"))
    place = lambda c: F.row_number().over(Window.partitionBy("o_custkey").orderBy(c, "o_orderkey")).cast("bigint")
    return rows.select("o_orderkey", "shown", place("shown").alias("as_text"), place(F.to_date("o_orderdate")).alias("as_date"))


@query("""
SELECT event_id, try_cast(json_extract_string(props, '$.k') AS BIGINT) AS k, event_type = 't' AS flag, try_cast(event_type AS BIGINT) AS not_a_number,
  (value * 1000)::BIGINT AS grouped FROM events""")
def safe_casts(spark: SparkSession, d: str) -> DataFrame:
    whole = F.round(F.col("value") * 1000).cast("bigint")
    return table(spark, d, "events").select("event_id", values.whole_number(F.get_json_object("props", "$.k")).alias("k"), values.flag("event_type").alias("flag"), values.whole_number("event_type").alias("not_a_number"), values.grouped_number(F.format_number(whole, 0)).alias("grouped"))


# ---- addresses, pages ----


@query(r"""
SELECT page_id, lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*):', 1)) AS scheme, lower(regexp_extract(url, '^[^:]+://([^/?#]*)', 1)) AS host, regexp_extract(url, '^[^:]+://[^/?#]*([^?#]*)', 1) AS path,
  regexp_extract(url, '^[^?#]*\?([^#]*)', 1) AS query, nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS page, nullif(regexp_extract(url, '[?&]utm_source=([^&#]*)', 1), '') AS utm,
  coalesce(nullif(regexp_extract(regexp_extract(url, '^[^:]+://[^/?#]*([^?#]*)', 1), '([^/]*)$', 1), ''), 'index') AS base, contains(lower(url), '.pdf') AS is_pdf
FROM pages""")
def url_parts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select(
        "page_id", urls.scheme("url").alias("scheme"), urls.host("url").alias("host"), urls.path("url").alias("path"), urls.query("url").alias("query"), urls.parameter("url", "page").alias("page"),
        urls.parameter("url", "utm_source").alias("utm"), urls.base_name("url", "index").alias("base"), urls.looks_like_pdf("url").alias("is_pdf"),
    )


@query(r"""
SELECT page_id, CASE WHEN contains(url, 'page=') THEN regexp_replace(url, '([?&]page=)[^&#]*', '\1' || page_id) ELSE
  regexp_extract(url, '^([^#]*)', 1) || CASE WHEN contains(url, '?') THEN '&' ELSE '?' END || 'page=' || page_id || regexp_extract(url, '(#.*)$', 1) END AS next_url,
  regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || '/opinions/' || page_id || '.pdf' AS joined, CASE WHEN url <> '' THEN url ELSE '' END AS same
FROM pages""")
def url_rewrites(spark: SparkSession, d: str) -> DataFrame:
    href = F.concat(F.lit("/opinions/"), F.col("page_id").cast("string"), F.lit(".pdf"))
    return table(spark, d, "pages").select("page_id", urls.with_parameter("url", "page", F.col("page_id")).alias("next_url"), urls.resolved("url", href).alias("joined"), urls.normalized("url", "https://example.com/").alias("same"))


@query(r"""
SELECT page_id, position::INT AS position, href FROM (SELECT page_id, regexp_extract_all(html, '<a [^>]*href="([^"]*)"', 1) AS links FROM pages), LATERAL (SELECT unnest(links) AS href, unnest(range(1, len(links) + 1)) AS position)""")
def html_links(spark: SparkSession, d: str) -> DataFrame:
    links = F.regexp_extract_all("html", F.lit(r'<a [^>]*href="([^"]*)"'), F.lit(1))
    return table(spark, d, "pages").select("page_id", F.posexplode(links).alias("i", "href")).select("page_id", (F.col("i") + 1).alias("position"), "href")


@query(r"""
SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, length(regexp_replace(html, '<[^>]*>', '', 'g')) AS text_length,
  coalesce(contains(lower(html), 'request rejected') OR (contains(lower(html), 'support id') AND contains(lower(html), 'rejected')), FALSE) AS blocked FROM pages""")
def html_titles_and_blocks(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select(
        "page_id", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"), F.char_length(F.regexp_replace("html", "<[^>]*>", "")).cast("bigint").alias("text_length"), text.looks_blocked("html").alias("blocked")
    )


# ---- limits, orders, increments, nesting ----


@query("""
SELECT o_orderkey, o_custkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS n FROM orders) WHERE n <= 3""")
def limit_per_group(spark: SparkSession, d: str) -> DataFrame:
    return limits.limit_per_group(table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate"), ["o_custkey"], [F.desc("o_orderdate"), "o_orderkey"], 3).drop("o_orderdate")


@query("""
SELECT o_orderkey, o_custkey, year FROM (
  SELECT *, year(o_orderdate)::INT AS year, row_number() OVER (PARTITION BY o_custkey, year(o_orderdate) ORDER BY o_orderdate DESC, o_orderkey) AS n FROM orders) WHERE n <= 1""")
def limit_per_group_year(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate", F.year("o_orderdate").alias("year"))
    return limits.limit_per_group(rows, ["o_custkey", "year"], [F.desc("o_orderdate"), "o_orderkey"], 1).drop("o_orderdate")


@query("""
SELECT e.event_id, e.user_id FROM events e WHERE e.ts >= TIMESTAMP '2024-01-03'
AND NOT EXISTS (SELECT 1 FROM events p WHERE p.ts < TIMESTAMP '2024-01-03' AND p.event_type = 'purchase' AND p.user_id = e.user_id)""")
def resume_antijoin(spark: SparkSession, d: str) -> DataFrame:
    events, cut = table(spark, d, "events"), F.lit("2024-01-03").cast("timestamp_ntz")
    done = events.filter((F.col("ts").cast("timestamp_ntz") < cut) & (F.col("event_type") == "purchase"))
    return limits.pending(events.filter(F.col("ts").cast("timestamp_ntz") >= cut), done, ["user_id"]).select("event_id", "user_id")


@query("""
SELECT event_id, user_id, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS header FROM events""")
def carry_forward_fill(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").withColumn("v", F.when(F.col("event_type") == "purchase", F.col("value")))
    return aggregate.carried_forward(rows, ["user_id"], ["ts", "event_id"], "v", "header").select("event_id", "user_id", "header")


@query("""
SELECT event_id AS id, user_id AS who_user, event_type AS who_kind, try_cast(json_extract_string(props, '$.k') AS BIGINT) AS props_k, '[' || user_id || ',' || event_id || ']' AS keys FROM events""")
def json_flatten(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    rows = e.select(F.col("event_id").alias("id"), F.struct(F.col("user_id").alias("user"), F.col("event_type").alias("kind")).alias("who"), F.from_json("props", "k bigint").alias("props"), F.array("user_id", "event_id").alias("keys"))
    return nested.flattened(rows)


@query("""
SELECT user_id, list_max(list_transform(list(event_type), lambda t: CASE t WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'purchase' THEN 3 ELSE 0 END))::INT AS phase FROM events GROUP BY user_id""")
def phase_state(spark: SparkSession, d: str) -> DataFrame:
    """The furthest phase each key has reached; phases only go forward."""
    from caselake.streaming.incremental import phase_rank

    rank = phase_rank("event_type", ["view", "click", "purchase"])
    return table(spark, d, "events").groupBy("user_id").agg(F.max(rank).alias("phase"))


@query("""
SELECT l_shipmode_year AS year, court, count(*) AS n_cases FROM (
  SELECT year(l_shipdate)::INT AS l_shipmode_year, n_name AS court FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  WHERE n_regionkey IN (0, 2) AND year(l_shipdate) BETWEEN 1996 AND 1997) GROUP BY ALL""")
def bulk_pipeline_shape(spark: SparkSession, d: str) -> DataFrame:
    """Courts, dockets of theirs, clusters of those in a range of years, counted as they would be written."""
    courts = table(spark, d, "nation").filter(F.col("n_regionkey").isin(0, 2)).select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("court"))
    dockets = table(spark, d, "orders").join(table(spark, d, "customer").join(courts, "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")).select(F.col("o_orderkey").alias("l_orderkey"), "court")
    clusters = limits.between_years(table(spark, d, "lineitem").select("l_orderkey", "l_shipdate"), "l_shipdate", 1996, 1997)
    return clusters.join(dockets, "l_orderkey").groupBy(F.year("l_shipdate").alias("year"), "court").agg(F.count("*").alias("n_cases"))


# ---- elements of pages; event time (extensions) ----


@query(r"""
WITH n AS (SELECT page_id, regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1) AS nav FROM pages)
SELECT page_id, count(*) AS n_links, string_agg(href, '|' ORDER BY i) AS hrefs
FROM (SELECT page_id, unnest(regexp_extract_all(nav, '<a href="([^"]*)"', 1)) AS href, unnest(range(len(regexp_extract_all(nav, '<a href="([^"]*)"', 1)))) AS i FROM n) GROUP BY page_id""")
def navigation_links(spark: SparkSession, d: str) -> DataFrame:
    """Links of each page's menu, found as elements."""
    from caselake.sources.html import elements

    found = elements(table(spark, d, "pages").select("page_id", "html"), {"link": ("nav a[href]", {})})
    got = found.groupBy("page_id").agg(F.count("*").alias("n_links"), F.array_sort(F.collect_list(F.struct("element.position", "element.href"))).alias("l"))
    return got.select("page_id", "n_links", F.array_join("l.href", "|").alias("hrefs"))


@query("""
SELECT time_bucket(INTERVAL 1 DAY, ts) AS day, event_type, count(*) AS n_events, round(sum(value), 4) AS total FROM events GROUP BY ALL""")
def ext_event_windows(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").groupBy(F.window("ts", "1 day").alias("w"), "event_type").agg(F.count("*").alias("n_events"), F.round(F.sum("value"), 4).alias("total"))
    return rows.select(F.col("w.start").cast("timestamp_ntz").alias("day"), "event_type", "n_events", "total")


@query("""
WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS new FROM events),
s AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts) AS s FROM g)
SELECT user_id, min(ts) AS first_ts, count(*) AS n_events FROM s GROUP BY user_id, s""")
def ext_sessions(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").groupBy("user_id", F.session_window("ts", "6 hours").alias("w")).agg(F.count("*").alias("n_events"))
    return rows.select("user_id", F.col("w.start").cast("timestamp_ntz").alias("first_ts"), "n_events")
