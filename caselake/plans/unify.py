"""One schema for the cases of all jurisdictions, and one vocabulary for fetching."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselake.functions import dates, text

#: Columns of the common schema, all text but for filed_date and year.
COLUMNS = "jurisdiction court publication_status case_id case_name docket_number filed_date filed_date_raw year month citation disposition author description page_url pdf_url pdf_file fetch_status source".split()

# What each jurisdiction calls the columns of the common schema.
RENAMED = {
    "WA": {"case_number": "case_id", "case_title": "case_name", "file_date": "filed_date_raw", "case_info_url": "page_url", "pdf_filename": "pdf_file", "download_status": "fetch_status"},
    "CA": {"case_number": "case_id", "title": "case_name", "date": "filed_date_raw", "case_info_url": "page_url", "pdf_filename": "pdf_file", "download_status": "fetch_status"},
    "CO": {"title": "case_name", "date": "filed_date_raw", "detail_url": "page_url", "pdf_filename": "pdf_file", "download_status": "fetch_status"},
    "FL": {"case_no": "case_id", "release_date": "filed_date_raw", "download_status": "fetch_status"},
    "GA": {"case_title": "case_name", "date": "filed_date_raw", "download_status": "fetch_status"},
    "NC": {"docket": "case_id", "date": "filed_date_raw", "downloaded_pdf": "pdf_file", "download_status": "fetch_status"},
    "NJ": {"no": "case_id", "date": "filed_date_raw", "download_status": "fetch_status"},
    "PA": {"title": "case_name", "date": "filed_date_raw", "excerpt": "description"},
    "US": {"docket": "case_id", "name": "case_name", "date": "filed_date_raw", "justice": "author", "pdf_filename": "pdf_file", "download_status": "fetch_status"},
}


def fetch_status(raw: Column | str) -> Column:
    """fetched, cached, pending, skipped, missing, blocked or failed, from any source's own words."""
    s = F.lower(text.text(raw))
    has = lambda *w: reduce(lambda a, b: a | b, [F.contains(s, F.lit(x)) for x in w])
    word = lambda w: F.regexp_like(s, F.lit(f"(^|[^a-z]){w}($|[^a-z])"))  # noqa: E731, "ok" also stands in "token" and "lookup"
    return (
        F.when(has("blocked"), "blocked").when(has("html_instead", "fail", "error"), "failed").when(has("not found", "missing", "no_pdf", "no-pdf", "no-file"), "missing")
        .when(has("skipped"), "skipped").when(has("already_exists", "cached"), "cached").when(has("success", "downloaded", "saved") | word("ok"), "fetched").otherwise("pending")
    )


def unified(jurisdiction: str, rows: DataFrame) -> DataFrame:
    """Rows of one jurisdiction in the common schema; what it lacks is null, what is empty becomes null."""
    out = rows
    for old, new in RENAMED[jurisdiction].items():
        if old in out.columns:
            out = out.withColumnRenamed(old, new)
    filled = out.select(*[F.nullif(F.col(c).cast("string"), F.lit("")).alias(c) for c in out.columns if c in COLUMNS])
    for c in COLUMNS:
        if c not in filled.columns:
            filled = filled.withColumn(c, F.lit(None).cast("string"))
    day = F.coalesce(dates.long_date("filed_date_raw"), dates.short_date("filed_date_raw"), F.col("filed_date_raw").try_cast("date"))
    return filled.withColumns({"jurisdiction": F.lit(jurisdiction), "filed_date": day, "year": F.coalesce(F.col("year").try_cast("int"), F.year(day)), "month": F.coalesce("month", F.date_format(day, "MM")), "fetch_status": fetch_status("fetch_status")}).select(*COLUMNS)


def all_cases(sources: dict[str, DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), [unified(j, rows) for j, rows in sources.items()])
