"""Queries that write the tables as sources of other kinds, or read parts of them as such, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caselake.operators import variants
from caselake.plans import candidates, stored
from caselake.plans.catalogue import query, table
from caselake.sources.case_files import case_files, write_case_files
from caselake.sources.scratch import scratch
from caselake.sources.split_csv import split_csv
from caselake.streaming.tries import due_tries


@query("SELECT doc_id, lang, length(text) AS n_chars, md5(text) AS digest FROM documents")
def split_extract(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "extract")
    docs = table(spark, d, "documents").select("doc_id", "text", "lang")
    docs.write.options(header=True, quoteAll=True, escape='"', nullValue="\\N", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    read = split_csv(spark, path, "doc_id bigint, text string, lang string", nullValue="\\N")
    return read.select("doc_id", "lang", F.char_length("text").cast("bigint").alias("n_chars"), F.md5(F.col("text").cast("binary")).alias("digest"))


@query("""
SELECT 'ca' || s_nationkey AS court, 2000 + s_suppkey % 20 AS year, s_name AS folder, s_suppkey AS id, round(s_acctbal, 2) AS balance FROM supplier WHERE s_nationkey < 20 AND s_suppkey % 20 >= 5""")
def case_tree(spark: SparkSession, d: str) -> DataFrame:
    uri = scratch(spark, "cases")
    uri = uri if "://" in uri else f"file://{uri.removeprefix('file:')}"
    rows = table(spark, d, "supplier").select(
        F.concat(F.lit("ca"), F.col("s_nationkey").cast("string")).alias("court"), (F.col("s_suppkey") % 20 + 2000).cast("int").alias("year"), F.col("s_name").alias("folder"),
        F.struct(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance")).alias("docket"), F.lit(None).cast("string").alias("cluster"), F.lit(None).cast("string").alias("opinion"), "s_suppkey",
    )
    write_case_files(rows, uri, ["s_suppkey"])
    some = case_files(spark, uri).filter(F.col("court").isin(*[f"ca{n}" for n in range(20)]) & (F.col("year") >= 2005))
    record = F.from_json("json", "id bigint, balance double")
    return some.select("court", F.col("year").cast("bigint").alias("year"), "folder", record["id"].alias("id"), F.round(record["balance"], 2).alias("balance"))


@query("""
WITH o AS (SELECT user_id, event_id, ts, CASE event_type WHEN 'purchase' THEN 'Success' WHEN 'click' THEN '429' ELSE event_type END AS s FROM events),
g AS (SELECT user_id, max((ts, event_id)) FILTER (s = 'Success') AS good FROM o GROUP BY user_id),
b AS (SELECT o.*, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS back, count(*) OVER (PARTITION BY user_id) AS tries FROM o JOIN g USING (user_id) WHERE s <> 'Success' AND (good IS NULL OR (ts, event_id) > good))
SELECT user_id, tries::INT AS tries, s AS status,
  CASE WHEN tries < 5 THEN strftime(ts + to_seconds(least(300, 10 * 2 ** (tries - 1) * CASE WHEN s = '429' THEN 3 ELSE 1 END)), '%Y-%m-%d %H:%M:%S') END AS due
FROM b WHERE back = 1""")
def retry_due(spark: SparkSession, d: str) -> DataFrame:
    status = F.when(F.col("event_type") == "purchase", "Success").when(F.col("event_type") == "click", "429").otherwise(F.col("event_type"))
    rows = table(spark, d, "events").select("user_id", "event_id", F.col("ts").cast("timestamp").alias("ts"), status.alias("status"))
    return due_tries(rows, "user_id", "status", "ts", ["event_id"], base=10, most=5).withColumn("due", F.date_format("due", "yyyy-MM-dd HH:mm:ss"))


@query("""
SELECT event_id::VARCHAR AS id, coalesce(user_id::VARCHAR, '') AS "user", coalesce(json_extract_string(props, '$.k'), '') AS props_k, '' AS kinds FROM events WHERE event_id % 3 <> 0
UNION ALL SELECT event_id::VARCHAR, '', '', '["' || event_type || '"]' FROM events WHERE event_id % 3 = 0
UNION ALL SELECT (-event_id)::VARCHAR, '', coalesce(json_extract_string(props, '$.k'), ''), '' FROM events WHERE event_id % 3 = 0""")
def variant_export(spark: SparkSession, d: str) -> DataFrame:
    one = "concat('{\"id\":', event_id, ',\"user\":', user_id, ',\"props\":', props, '}')"
    several = "concat('[{\"id\":', event_id, ',\"kinds\":[\"', event_type, '\"]},{\"id\":', -event_id, ',\"props\":', props, '}]')"
    rows = table(spark, d, "events").select(F.expr(f"if(event_id % 3 = 0, {several}, {one})").alias("json"))
    return variants.key_union(variants.opened(rows, "json"))


@query("""
SELECT o_orderkey AS cluster_id, o_custkey AS docket_id, c_mktsegment AS court, count(*) AS n_opinions, sum(length(l_comment)) AS n_chars
FROM orders JOIN customer ON o_custkey = c_custkey JOIN (SELECT l_orderkey, coalesce(l_returnflag, '') || l_linenumber AS l_comment FROM lineitem) ON l_orderkey = o_orderkey
WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND year(o_orderdate) BETWEEN 1995 AND 1996 GROUP BY o_orderkey, o_custkey, c_mktsegment""")
def stored_join(spark: SparkSession, d: str) -> DataFrame:
    text = lambda c: F.col(c).cast("string")
    dockets = table(spark, d, "customer").select(text("c_custkey").alias("id"), F.col("c_mktsegment").alias("court_id"), F.lit("").alias("docket_number"), F.col("c_name").alias("case_name"))
    clusters = table(spark, d, "orders").select(text("o_orderkey").alias("id"), text("o_custkey").alias("docket_id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("date_filed"), F.lit("").alias("case_name"))
    line = F.concat(F.coalesce("l_returnflag", F.lit("")), text("l_linenumber"))
    empty = [F.lit("").alias(c) for c in ("html_with_citations", "html_columbia", "html_lawbox", "html_anon_2020", "html", "xml_harvard", "per_curiam", "extracted_by_ocr", "author_str", "type", "sha1", "page_count", "download_url", "date_created")]
    opinions = table(spark, d, "lineitem").select(F.concat(text("l_orderkey"), text("l_linenumber")).alias("id"), text("l_orderkey").alias("cluster_id"), line.alias("plain_text"), *empty)
    path = scratch(spark, "stored")
    name = "stored_" + path.split("/")[-2].rpartition("-")[2]
    stored.store(dockets, clusters, opinions, name, buckets=16, path=path)
    out = stored.stored_cases(spark, name, 1995, 1996, ("BUILDING", "MACHINERY"))
    n_chars = F.aggregate("opinions", F.lit(0).cast("bigint"), lambda n, o: n + F.char_length(o["text"]))
    return out.select("cluster_id", "docket_id", "court", F.size("opinions").cast("bigint").alias("n_opinions"), n_chars.alias("n_chars"))


_PLACES = ("https://{case}", "http://{case}/", "http://{case}")


@query("""
WITH c AS (SELECT page_id, upper(regexp_extract(url, '://(.*)$', 1)) AS n FROM pages),
t AS (SELECT page_id, n, unnest(['https://' || n, 'http://' || n || '/', 'http://' || n]) AS a, unnest([1, 2, 3]) AS rank FROM c)
SELECT c.page_id, min(t.rank) FILTER (u.a IS NOT NULL) AS rank, arg_min(t.a, t.rank) FILTER (u.a IS NOT NULL) AS pdf_url
FROM c LEFT JOIN t USING (page_id) LEFT JOIN (SELECT DISTINCT split_part(url, '://', 1) || '://' || upper(split_part(url, '://', 2)) AS a FROM pages) u ON u.a = t.a GROUP BY c.page_id""")
def candidate_addresses(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "pages").select("page_id", "url", F.regexp_extract("url", "://(.*)$", 1).alias("n"))
    captured = pages.select(F.concat(F.substring_index("url", "://", 1), F.lit("://"), F.upper("n")).alias("url"))
    return candidates.first_found(pages.select("page_id", "n"), "n", captured, "url", _PLACES).drop("n")
