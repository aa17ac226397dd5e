"""The document of a case, looked for at several addresses among captured files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselake.functions import text

# Where a case's document may be, in the order in which the places are tried.
PLACES = (
    "https://www.courts.ca.gov/opinions/documents/{case}.PDF",
    "https://www.courts.ca.gov/opinions/archive/{case}.PDF",
    "https://www.courts.ca.gov/opinions/revnppub/{case}.PDF",
)


def filled(place: str, case: Column) -> Column:
    """The address of a place, {case} being the case's number, trimmed and in capitals."""
    return F.replace(F.lit(place), F.lit("{case}"), F.upper(text.strip(case)))


def candidates(cases: DataFrame, case: str, places: tuple[str, ...] = PLACES) -> DataFrame:
    """A row for each case and place: the case's columns, rank (from 1) and address; cases without a number have none."""
    tried = F.array(*[F.struct(F.lit(i).alias("rank"), filled(p, F.col(case)).alias("address")) for i, p in enumerate(places, 1)])
    numbered = cases.filter(text.strip(text.text(case)) != "")
    return numbered.select(*cases.columns, F.inline(tried))


def first_found(cases: DataFrame, case: str, captured: DataFrame, address: str, places: tuple[str, ...] = PLACES, listed: DataFrame | None = None) -> DataFrame:
    """Every case with ``pdf_url``, the first place that was captured, its ``rank``, and null where none was.

    ``captured`` holds the addresses of captured files in ``address``; repeats do
    no harm.  ``listed`` (case, href) has links on the cases' own pages, which
    are tried last, those that hold the number first; their rank is one more than
    that of the last place.  A number that repeats in ``cases`` is looked for once.
    """
    keys = cases.select(case).distinct()
    there = captured.select(F.col(address).alias("address"))
    hits = candidates(keys, case, places).join(there, "address", "left_semi").groupBy(case).agg(F.min(F.struct("rank", F.col("address").alias("pdf_url"))).alias("hit"))
    found = keys.join(hits, case, "left")
    if listed is not None:
        named = ~F.contains(F.upper("href"), F.upper(text.strip(text.text(case))))
        own = listed.filter(F.contains(F.upper("href"), F.lit(".PDF"))).groupBy(case).agg(F.min(F.struct(named.alias("other"), F.col("href"))).alias("own"))
        found = found.join(own, case, "left").withColumn("hit", F.coalesce("hit", F.when(F.col("own").isNotNull(), F.struct(F.lit(len(places) + 1).alias("rank"), F.col("own.href").alias("pdf_url"))))).drop("own")
    return cases.join(found, case, "left").select(*cases.columns, "hit.pdf_url", "hit.rank")
