"""The bulk pipeline: dockets, clusters and opinions to one row for each case."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselake.functions import text, values
from caselake.operators import dedupe, limits

# The courts of appeals, their display names, and the order in which an opinion's texts are tried.
COURTS = ("ca1", "ca2", "ca3", "ca4", "ca5", "ca6", "ca7", "ca8", "ca9", "ca10", "ca11", "cadc", "cafc")
NAMES = {
    "ca1": "1st Circuit", "ca2": "2nd Circuit", "ca3": "3rd Circuit", "ca4": "4th Circuit", "ca5": "5th Circuit", "ca6": "6th Circuit", "ca7": "7th Circuit",
    "ca8": "8th Circuit", "ca9": "9th Circuit", "ca10": "10th Circuit", "ca11": "11th Circuit", "cadc": "DC Circuit", "cafc": "Federal Circuit",
}
TEXT_FIELDS = ("html_with_citations", "html_columbia", "html_lawbox", "html_anon_2020", "html", "xml_harvard", "plain_text")


def typed_opinions(opinions: DataFrame) -> DataFrame:
    """Numbers and flags as such, and the best of an opinion's texts."""
    fields: list[Column] = [values.whole_number("id").alias("id"), values.whole_number("cluster_id").alias("cluster_id"), text.best_text(*TEXT_FIELDS).alias("text")]
    flags = [values.flag(c).alias(c) for c in ("per_curiam", "extracted_by_ocr")]
    rest = [text.text(c).alias(c) for c in ("author_str", "type", "sha1", "page_count", "download_url", "date_created")]
    return opinions.select(*fields, *flags, *rest)


def court_name(court: Column | str) -> Column:
    """The court's display name; its code where it has none."""
    c = F.col(court) if isinstance(court, str) else court
    return F.coalesce(*[F.when(c == k, v) for k, v in NAMES.items()], c)


def case_folder(number: Column | str, slug: Column | str, other_slug: Column | str, id: Column | str) -> Column:
    """number_slug, of which either may be missing; the cluster's slug before the docket's; case_<id> without both."""
    key = F.col(id) if isinstance(id, str) else id
    parts = [F.when(text.first_filled(c).isNotNull(), text.folder_name(c)) for c in (number, F.coalesce(text.first_filled(slug, other_slug), F.lit("")))]
    return F.when(parts[0].isNull() & parts[1].isNull(), F.concat(F.lit("case_"), key.cast("string"))).otherwise(F.concat_ws("_", *parts))


def _column(rows: DataFrame, name: str) -> Column:
    """The column, or empty text where an extract lacks it."""
    return F.col(name) if name in rows.columns else F.lit("").alias(name)


def cases(dockets: DataFrame, clusters: DataFrame, opinions: DataFrame, first: int, last: int, courts: tuple[str, ...] = COURTS) -> DataFrame:
    """One row for each cluster with an opinion, of one of ``courts`` and filed in the range of years.

    Columns: court, court_name, year, cluster_id, docket_id, folder, case_name,
    opinions (array, by id), n_in_folder (clusters that would share the folder).
    Clusters are keyed by id, so none overwrites another.  Years cut the clusters
    and courts the dockets; opinions are cut to the clusters that are left, by
    their ids alone, before a text is read or grouped.
    """
    ours = dockets.filter(F.col("court_id").isin(*courts)).select(F.col("id").alias("docket_id"), "court_id", "docket_number", "docket_number_core", F.col("case_name").alias("docket_name"), "case_name_short", _column(dockets, "slug").alias("docket_slug"))
    filed = limits.between_years(clusters, "date_filed", first, last).select(F.col("id").alias("cluster_id"), "docket_id", "date_filed", "case_name", "slug")
    placed = filed.join(ours, "docket_id").withColumn("cluster_id", values.whole_number(F.col("cluster_id").cast("string")))
    wanted = placed.select(F.col("cluster_id").alias("_wanted"))
    kept = opinions.join(wanted, values.whole_number("cluster_id") == F.col("_wanted"), "left_semi")
    texts = typed_opinions(kept)
    parts = texts.groupBy("cluster_id").agg(F.array_sort(F.collect_list(F.struct(*[c for c in texts.columns if c != "cluster_id"]))).alias("opinions"))
    joined = placed.join(parts, "cluster_id")
    folder = case_folder("docket_number", "slug", "docket_slug", "cluster_id")
    named = joined.select(F.col("court_id").alias("court"), court_name("court_id").alias("court_name"), F.substring("date_filed", 1, 4).try_cast("int").alias("year"), "cluster_id", "docket_id", folder.alias("folder"), F.coalesce(text.first_filled("case_name", "docket_name"), F.lit("")).alias("case_name"), "opinions")
    path = F.concat_ws("/", "court", F.col("year").cast("string"), "folder")
    shared = dedupe.collisions(named.select(path.alias("path")), "path")
    return named.withColumn("path", path).join(shared, "path", "left").withColumn("n_in_folder", F.coalesce("n_rows", F.lit(1).cast("bigint"))).drop("n_rows", "path")


def losses(dockets: DataFrame, clusters: DataFrame, opinions: DataFrame, first: int, last: int, courts: tuple[str, ...] = COURTS) -> DataFrame:
    """How many clusters of the range are written, lack a docket of these courts, or have no opinion."""
    ours = dockets.filter(F.col("court_id").isin(*courts)).select(F.col("id").alias("docket_id"), F.lit(True).alias("d")).distinct()
    told = opinions.select(F.col("cluster_id").cast("string").alias("id"), F.lit(True).alias("o")).distinct()
    rows = limits.between_years(clusters, "date_filed", first, last).select(F.col("id").cast("string").alias("id"), "docket_id").join(ours, "docket_id", "left").join(told, "id", "left")
    return rows.agg(F.count_if(F.col("d") & F.col("o")).alias("written"), F.count_if(F.col("d").isNull()).alias("no_docket"), F.count_if(F.col("d") & F.col("o").isNull()).alias("no_opinion"))
