"""Deduplication with a stated winner.

Every function takes ``seq``, the columns that order the rows; rows are told
apart by them, so the winner does not hang on the layout of partitions.  Winners
are found by aggregates, which combine before the shuffle, where the whole row
can be carried in one; a hot key then costs no more than any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _winner(rows: DataFrame, keys: list[str], seq: list[str], last: bool) -> DataFrame:
    rest = [c for c in rows.columns if c not in keys]
    pick = F.max_by if last else F.min_by
    order = F.struct(*seq)
    out = rows.groupBy(*keys).agg(pick(F.struct(*rest), order).alias("_row"), F.min(order).alias("_first"))
    return out.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in rows.columns], F.col("_first"))


def first_wins(rows: DataFrame, keys: list[str], seq: list[str]) -> DataFrame:
    """Of rows with equal keys the first; null keys are equal."""
    return _winner(rows, keys, seq, False).drop("_first")


def last_wins(rows: DataFrame, keys: list[str], seq: list[str]) -> DataFrame:
    """Of rows with equal keys the last, with ``position``: the order columns of the first one."""
    out = _winner(rows, keys, seq, True)
    return out.withColumnRenamed("_first", "position")


def first_across_runs(rows: DataFrame, processed: DataFrame, keys: list[str], seq: list[str]) -> DataFrame:
    """The first of rows with equal keys that no earlier run has processed."""
    return first_wins(rows.join(processed.select(*keys), keys, "left_anti"), keys, seq)


def collisions(rows: DataFrame, path: str) -> DataFrame:
    """Paths that more than one row would be written to, with the number of rows."""
    return rows.groupBy(path).agg(F.count("*").alias("n_rows")).filter("n_rows > 1")


def numbered_names(rows: DataFrame, path: str, seq: list[str], alias: str = "file_name") -> DataFrame:
    """A name of its own for each row: the path, and from the second row on path_2, path_3, ..."""
    n = F.row_number().over(Window.partitionBy(path).orderBy(*seq))
    return rows.withColumn("_n", n).withColumn(alias, F.when(F.col("_n") == 1, F.col(path)).otherwise(F.concat_ws("_", path, F.col("_n").cast("string")))).drop("_n")


def fetch_once(rows: DataFrame, url: str, seq: list[str], alias: str = "fetch_status") -> DataFrame:
    """All rows; the first of each address is to fetch, the others are skipped, those without one have none.

    Rows of an address that ``seq`` does not tell apart are told apart by all
    other columns that have an order; rows that are equal in all are of one
    status.  The first is found by an aggregate, so a hot address costs no sort.
    """
    others = [c for c, kind in rows.dtypes if c not in (url, *seq) and "map<" not in kind and kind != "variant"]
    order = F.struct(*seq, *others)
    first = rows.groupBy(url).agg(F.min(order).alias("_first"))
    joined = rows.join(first.filter(F.col(url).isNotNull()), url, "left")
    status = F.when(F.coalesce(F.col(url), F.lit("")) == "", "no_pdf_url").when(order == F.col("_first"), "to_fetch").otherwise("skipped_duplicate_url")
    return joined.withColumn(alias, status).drop("_first").select(*rows.columns, alias)
