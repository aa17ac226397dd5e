"""Queries over listing pages that are made from the tables, each with its SQL.

A page holds some fifty rows of a table as a court's site would show them; an
extractor reads them back, and SQL says what was shown.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caselake.plans import listings
from caselake.plans.catalogue import SQL, query, table
from caselake.plans.table_functions import EXTRACTORS, read_by, register_tables

SITE = "https://courts.example/lists/"
#: Rows of a page.
ROWS = 50
#: What reads pages (url, html) back into rows.
Read = Callable[[DataFrame], DataFrame]


def rendered(rows: DataFrame, key: str, row: str, head: str = "''", tail: str = "''") -> DataFrame:
    """url and html: pages of ``ROWS`` keys each; ``row`` is SQL of a row's markup, ``head`` and ``tail`` of the page's, where ``p`` is its number."""
    shown = rows.select(F.col(key).alias("k"), F.expr(row).alias("m"), (F.col(key) / ROWS).cast("bigint").alias("p"))
    # as many tasks as there are cores: pages are short, but reading them takes time, so their bytes are no measure
    pages = shown.repartition(rows.sparkSession.sparkContext.defaultParallelism, "p").groupBy("p").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "m"))), lambda x: x["m"]), "\n").alias("body"))
    return pages.select(F.concat(F.lit(SITE), F.col("p").cast("string"), F.lit("/page.html")).alias("url"), F.concat(F.lit("<!DOCTYPE html><html><body>"), F.expr(head), F.col("body"), F.expr(tail), F.lit("</body></html>")).alias("html"))


def _page(c: str = "url") -> Column:
    return F.regexp_extract(c, r"/lists/(\d+)/", 1).cast("bigint")


def _tags(markup: str) -> str:
    """SQL that puts columns, named in braces, into markup."""
    parts = markup.replace("{", "\0").replace("}", "\0").split("\0")
    return "concat(" + ", ".join(f"cast({p} AS STRING)" if i % 2 else "'" + p.replace("'", "\\'") + "'" for i, p in enumerate(parts)) + ")"


@query("""
SELECT c_custkey // 50 AS page, 'Jan. ' || (c_custkey % 28 + 1) AS file_date, 'N' || c_custkey AS case_number, CASE WHEN c_custkey % 4 = 0 THEN 'II' ELSE '' END AS division,
  c_name AS case_title, c_mktsegment AS file_contains, 'https://courts.example/info?filename=' || c_custkey || 'MAJ' AS case_info_url,
  CASE WHEN (c_custkey // 50) % 2 = 0 THEN 'March' ELSE 'January' END AS month
FROM customer WHERE c_custkey % 9 <> 0""")
def listed_case_tables(spark: SparkSession, d: str, read: Read = listings.month_tables) -> DataFrame:
    row = "<tr><td>Jan. {c_custkey % 28 + 1}</td><td>{if(c_custkey % 9 = 0, concat(\"N\", c_custkey), concat(\"<a href=/info?filename=\", c_custkey, \"MAJ>N\", c_custkey, \"</a>\"))}</td>{if(c_custkey % 4 = 0, \"<td>II</td>\", \"\")}<td>* {c_name}</td><td> {c_mktsegment} </td></tr>"
    pages = rendered(table(spark, d, "customer"), "c_custkey", _tags(row), _tags("{if(p % 2 = 0, \"<h3>Filed in March 2025</h3>\", \"\")}<table><tr><th>Date</th><th>No</th><th>Title</th><th>File</th></tr>"), "'</table>'")
    return read(pages).select(_page().alias("page"), "file_date", "case_number", "division", "case_title", "file_contains", "case_info_url", "month")


@query("""
SELECT c_custkey // 50 AS page, 'd' || c_custkey AS file_date, 'N' || c_custkey AS case_number, c_name AS case_title, c_mktsegment AS file_contains,
  'https://courts.example/lists/' || (c_custkey // 50) || '/c' || c_custkey AS case_info_url
FROM customer WHERE c_custkey % 50 <> 0""")
def listed_plain_tables(spark: SparkSession, d: str, read: Read = listings.plain_case_tables) -> DataFrame:
    row = "<tr><{if(c_custkey % 2 = 0, \"td\", \"th\")}>d{c_custkey}</td><td><a href=c{c_custkey}>N{c_custkey}</a></td><th>{c_name}</th><td>{c_mktsegment}</td></tr>"
    pages = rendered(table(spark, d, "customer"), "c_custkey", _tags(row), "'<table>'", "'</table>'")
    return read(pages).select(_page().alias("page"), "file_date", "case_number", "case_title", "file_contains", "case_info_url")


@query("""
SELECT DISTINCT year(o_orderdate)::INT AS year, 'https://courts.example/lists/opinions?fa=byYear&fileYear=' || year(o_orderdate) || '&crtLevel=S&pubStatus=PUB' AS year_url
FROM orders WHERE o_orderkey % 3 = 0""")
def listed_years(spark: SparkSession, d: str, read: Read = lambda pages: listings.year_links(pages, "S", "PUB")) -> DataFrame:
    years = table(spark, d, "orders").select((F.year("o_orderdate") * 10 + F.col("o_orderkey") % 3).alias("k")).distinct()
    row = "<a href=\"../opinions?fa=byYear&amp;fileYear={k div 10}&amp;crtLevel={if(k % 10 = 0, \"S\", \"C\")}&amp;pubStatus=PUB\">{k div 10} |</a><a href=\"other\">none</a>"
    return read(rendered(years, "k", _tags(row))).select("year", "year_url").distinct()


@query("""
SELECT p AS page, count(*) FILTER (s_nationkey % 2 = 0) AS n_opinions FROM (SELECT *, s_suppkey // 50 AS p FROM supplier) GROUP BY p""")
def listed_opinion_counts(spark: SparkSession, d: str, read: Read = listings.opinion_counts) -> DataFrame:
    pages = rendered(table(spark, d, "supplier"), "s_suppkey", _tags("<a href=\"?fa=opinions.{if(s_nationkey % 2 = 0, \"showOpinion\", \"byYear\")}&f={s_suppkey}\">x</a>"))
    return read(pages).select(_page().alias("page"), "n_opinions")


@query("""
SELECT 'S' || p_partkey AS case_number, '1/2/25' AS date, p_brand AS court, p_type AS opinion_type, p_name AS title, 'https://courts.example/view?doc_no=S' || p_partkey AS case_info_url,
  CASE WHEN p_size % 2 = 0 THEN 'https://courts.example/opinions/documents/S' || p_partkey || '.PDF' ELSE '' END AS pdf_url
FROM part""")
def listed_cards(spark: SparkSession, d: str, read: Read = listings.result_cards) -> DataFrame:
    row = "<div class=\"result-excerpt\">{if(p_size % 3 = 0, \"\", concat(\"<span class=case-number>S\", p_partkey, \"</span>\"))}<h3>{p_name}</h3><span class=date>1/2/25</span><span class=notation>{p_brand} • {p_type}</span><a href=\"/view?doc_no=S{p_partkey}\">i</a>{if(p_size % 2 = 0, concat(\"<a href=/opinions/documents/S\", p_partkey, \".PDF>p</a>\"), \"\")}</div>"
    return read(rendered(table(spark, d, "part"), "p_partkey", _tags(row))).drop("url")


@query("""
SELECT 'A-' || s_suppkey AS no, 'App ' || s_nationkey AS court, s_name AS case_name, 'https://courts.example/a/' || s_suppkey AS page_url,
  CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE 'https://courts.example/a/' || s_suppkey || '.pdf' END AS pdf_url, CASE WHEN s_suppkey % 2 = 0 THEN 'First. Balance ' || s_nationkey ELSE '' END AS description
FROM supplier""")
def listed_badges(spark: SparkSession, d: str, read: Read = lambda pages: listings.badge_cards(pages, "article div.card")) -> DataFrame:
    row = "<div class=\"card mb-3\"><span class=badge>A-{s_suppkey}</span><span class=badge>App {s_nationkey}</span><h5 class=card-title><a href=/a/{s_suppkey}>{s_name}</a></h5>{if(s_suppkey % 3 = 0, \"\", concat(\"<a href=/a/\", s_suppkey, \".pdf>pdf</a>\"))}<button data-bs-target=\"#m{s_suppkey}\">s</button></div>{if(s_suppkey % 2 = 0, concat(\"<div class=modal id=m\", s_suppkey, \"><div class=modal-body><p>First.</p><p>Balance \", s_nationkey, \"</p></div></div>\"), \"\")}"
    pages = rendered(table(spark, d, "supplier"), "s_suppkey", _tags(row), "'<article class=w-100>'", "'</article>'")
    return read(pages).select("no", "court", "case_name", "page_url", "pdf_url", "description")


@query("""
SELECT s_name AS case_name, '2025-01-0' || (s_suppkey % 9 + 1) AS date, 'Court ' || s_nationkey AS court, CASE WHEN s_suppkey % 2 = 0 THEN '20 C ' || s_suppkey ELSE '' END AS docket, 'Filed' AS status, 'Of ' || s_suppkey AS description,
  'https://courts.example/lists/' || (s_suppkey // 50) || '/n' || s_suppkey AS page_url, 'https://courts.example/x' || s_suppkey || '.pdf' AS pdf_url, '' AS zip_url
FROM supplier""")
def listed_articles(spark: SparkSession, d: str, read: Read = listings.dated_articles) -> DataFrame:
    row = "<article><h2><a href=n{s_suppkey}>{s_name}</a></h2><time>2025-01-0{s_suppkey % 9 + 1}</time><span>Court {s_nationkey}</span><span> </span>{if(s_suppkey % 2 = 0, concat(\"<span>20 C \", s_suppkey, \"</span>\"), \"\")}<span>Filed</span><p>Of {s_suppkey}</p><a href=\"/a/../x{s_suppkey}.pdf\">p</a></article>"
    return read(rendered(table(spark, d, "supplier"), "s_suppkey", _tags(row))).drop("url")


@query("""
SELECT c_custkey AS id, '1/' || (c_custkey % 28 + 1) || '/25' AS release_date, c_mktsegment AS court, 'N' || c_custkey AS case_no, c_name AS case_name, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE 'Affirmed' END AS disposition,
  CASE WHEN c_custkey % 2 = 0 THEN 'https://courts.example/g/' || c_custkey || '.pdf' ELSE '' END AS pdf_url
FROM customer""")
def listed_grid(spark: SparkSession, d: str, read: Read = listings.grid_rows) -> DataFrame:
    cell = lambda k, of: f"<div data-column-id={k}>{of}</div>"
    row = "<div role=row>" + cell(1, "1/{c_custkey % 28 + 1}/25") + cell(2, "{c_mktsegment}") + cell(3, "N{c_custkey}") + cell(4, "{c_name}{if(c_custkey % 2 = 0, concat(\" <a href=/g/\", c_custkey, \".pdf></a>\"), \"\")}") + "{if(c_custkey % 3 = 0, \"\", \"<div data-column-id=5>Affirmed</div>\")}</div>"
    out = read(rendered(table(spark, d, "customer"), "c_custkey", _tags(row)))
    return out.select(F.substring("case_no", 2, 20).cast("bigint").alias("id"), "release_date", "court", "case_no", "case_name", "disposition", "pdf_url")


@query("""
SELECT 'S24A' || lpad((s_suppkey % 10000)::VARCHAR, 4, '0') AS case_id, s_name || ' v. State' AS case_title, 'https://courts.example/s/' || s_suppkey || '.pdf' AS pdf_url,
  'Month ' || (s_suppkey // 50) AS month, 'January ' || (s_suppkey // 50 % 28 + 1) || ', 2025' AS date FROM supplier
UNION ALL SELECT 'S24B' || lpad((s_suppkey % 10000)::VARCHAR, 4, '0'), s_name || ' v. State', 'https://courts.example/s/' || s_suppkey || '.pdf', 'Month ' || (s_suppkey // 50), 'January ' || (s_suppkey // 50 % 28 + 1) || ', 2025'
FROM supplier WHERE s_suppkey % 5 = 0""")
def listed_sections(spark: SparkSession, d: str, read: Read = listings.sectioned_items) -> DataFrame:
    row = "<li>S24A{lpad(s_suppkey % 10000, 4, \"0\")}{if(s_suppkey % 5 = 0, concat(\", S24B\", lpad(s_suppkey % 10000, 4, \"0\")), \"\")}. {s_name} v. State <a href=/s/{s_suppkey}.pdf></a></li><li>no number</li>"
    pages = rendered(table(spark, d, "supplier"), "s_suppkey", _tags(row), _tags("<h3>Month {p}</h3><p><strong>January {p % 28 + 1}, 2025 — SUMMARIES</strong></p><ul>"), "'</ul>'")
    return read(pages).select("case_id", "case_title", "pdf_url", "month", "date")


@query("""
SELECT 'R' || c_custkey AS r_number, (c_custkey % 12 + 1) || '/' || (c_custkey % 28 + 1) || '/26' AS date, '24-' || c_custkey AS docket, c_name AS name, 'K' AS justice, c_mktsegment AS citation, 'https://courts.example/o/24-' || c_custkey || '.pdf' AS pdf_url
FROM customer WHERE c_custkey % 7 <> 0""")
def listed_terms(spark: SparkSession, d: str, read: Read = listings.term_rows) -> DataFrame:
    row = "<tr><td>R{c_custkey}</td><td>{if(c_custkey % 7 = 0, \"soon\", concat(c_custkey % 12 + 1, \"/\", c_custkey % 28 + 1, \"/26\"))}</td><td>24-{c_custkey}</td><td><a href=/o/24-{c_custkey}.pdf>{c_name}</a></td><td>K</td><td>{c_mktsegment}</td></tr>"
    pages = rendered(table(spark, d, "customer"), "c_custkey", _tags(row), "'<table><tr><td>R-</td><td>Date</td><td>Docket</td><td>Name</td><td>J.</td><td>Pt.</td></tr>'", "'</table>'")
    return read(pages).select("r_number", "date", "docket", "name", "justice", "citation", "pdf_url")


@query("""
SELECT 'S' || c_custkey AS case_number, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_name END AS case_title, 'https://courts.example/s?id=' || c_custkey AS case_url, 'B' || c_nationkey AS court_of_appeal_case_number, c_mktsegment AS trial_court_case_number,
  'court_of_appeal=B' || c_nationkey || ';trial_no=' || c_mktsegment AS named
FROM customer""")
def listed_results(spark: SparkSession, d: str, read: Read = listings.results_table) -> DataFrame:
    row = "<tr><td><a href=\"/s?id={c_custkey}\">S{c_custkey}</a>{if(c_custkey % 3 = 0, \"\", concat(\"<br>\", c_name))}</td><td>B{c_nationkey}</td><td>{c_mktsegment}</td></tr>"
    head = "'<table><tr><th>Menu</th></tr><tr><td>x</td></tr></table><table><tr><th>Supreme Court</th><th>Court of Appeal</th><th>Trial #</th></tr>'"
    named = F.array_join(F.transform(F.array_sort(F.map_entries("named")), lambda e: F.concat_ws("=", e["key"], e["value"])), ";")
    return read(rendered(table(spark, d, "customer"), "c_custkey", _tags(row), head, "'</table>'")).select("case_number", "case_title", "case_url", "court_of_appeal_case_number", "trial_court_case_number", named.alias("named"))


@query("""
SELECT p_partkey // 50 AS page, (row_number() OVER (PARTITION BY p_partkey // 50 ORDER BY p_partkey))::INT AS row, p_name AS title, 'E ' || p_brand AS excerpt, p_size || ' KB' AS size,
  CASE p_partkey % 5 WHEN 0 THEN 'https://courts.example/d/' || p_partkey || '.pdf' WHEN 1 THEN 'https://d.example/' || p_partkey WHEN 2 THEN 'https://r.example/' || p_partkey || '.pdf'
    WHEN 3 THEN 'https://t.example/' || p_partkey || '.pdf' ELSE '' END AS pdf_url
FROM part""")
def listed_search(spark: SparkSession, d: str, read: Read = listings.result_rows) -> DataFrame:
    where = (
        "{case p_partkey % 5 when 0 then concat(\"<a class=CoveoResultLink href=/d/\", p_partkey, \".pdf></a>\") when 1 then concat(\"<span class=CoveoFieldValue data-field=@uri><span>//d.example/\", p_partkey, \"</span></span>\") "
        "when 2 then concat(\"<b data-result=\", chr(39), replace(to_json(named_struct(\"uri\", \"\", \"raw\", named_struct(\"fileuri\", concat(\"https://r.example/\", p_partkey, \".pdf\")))), chr(34), concat(\"&amp;quot\", chr(59))), chr(39), \"></b>\") "
        "when 3 then concat(\"<p>see https://t.example/\", p_partkey, \".pdf there</p>\") else \"\" end}"
    )
    row = "<div class=\"coveo-list-layout CoveoResult\"><div class=\"coveo-result-cell c-title\"><span class=CoveoResultLink>{p_name}</span></div><span class=CoveoExcerpt>E {p_brand}</span><span class=CoveoFieldValue data-field=@size><span>Size</span><span>{p_size} KB</span></span>" + where + "</div>"
    return read(rendered(table(spark, d, "part"), "p_partkey", _tags(row))).select(_page().alias("page"), "row", "title", "excerpt", "size", "pdf_url")


# ---- the same pages read by the table functions, and by SQL as its users write it ----


def _by_table_function(name: str) -> None:
    shown = globals()[name]

    def run(spark: SparkSession, d: str) -> DataFrame:
        return shown(spark, d, read_by(name))

    run.__name__, run.__doc__ = f"sql_{name}", f"{name}, its pages read by LATERAL {name}(html, url)."
    query(SQL[name])(run)


# years of other courts are on the pages too, and the table function takes all
for _name in EXTRACTORS:
    if _name in globals() and _name != "listed_years":
        _by_table_function(_name)


@query("""
SELECT DISTINCT year(o_orderdate)::INT AS year, 'https://courts.example/lists/opinions?fa=byYear&fileYear=' || year(o_orderdate) || '&crtLevel=' || CASE WHEN o_orderkey % 3 = 0 THEN 'S' ELSE 'C' END || '&pubStatus=PUB' AS year_url
FROM orders""")
def sql_listed_years(spark: SparkSession, d: str) -> DataFrame:
    return listed_years(spark, d, read_by("listed_years"))


@query("""
SELECT event_id, user_id, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS bought
FROM events""")
def sql_carry_forward(spark: SparkSession, d: str) -> DataFrame:
    register_tables(spark)
    told = table(spark, d, "events").select("event_id", "user_id", "ts", F.when(F.col("event_type") == "purchase", F.col("value")).alias("value"))
    return spark.sql("SELECT event_id, user_id, bought FROM carry_forward(TABLE(SELECT * FROM {told}) PARTITION BY user_id ORDER BY (ts, event_id), 'value', 'bought')", told=told)
