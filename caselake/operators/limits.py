"""Limits within groups and orders of listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def limit_per_group(rows: DataFrame, by: list[str], order: list[Column | str], most: int) -> DataFrame:
    """The first ``most`` rows of each group; Spark cuts each partition to that before the shuffle."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("_n") <= most).drop("_n")


def between_years(rows: DataFrame, date: str, first: int, last: int) -> DataFrame:
    """Rows whose date begins with a year of the range; without one they go."""
    return rows.filter(F.substring(F.col(date).cast("string"), 1, 4).try_cast("int").between(first, last))


def pending(rows: DataFrame, processed: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with a whole key that is not among the processed ones."""
    keyed = rows
    for k in keys:
        keyed = keyed.filter(F.length(F.trim(F.col(k).cast("string"))) > 0)
    return keyed.join(processed.select(*keys), keys, "left_anti")


def with_id(rows: DataFrame, id: str = "id") -> DataFrame:
    """Rows whose id counts as one: null and 0 do not."""
    return rows.filter(F.col(id).isNotNull() & (F.col(id) != 0))


def in_phases(rows: DataFrame, phase: str, names: list[str]) -> DataFrame:
    """Rows whose phase is among ``names``, or not set yet."""
    return rows.filter(F.col(phase).isNull() | F.col(phase).isin(names))


def first_pages(rows: DataFrame, page: str, most: int) -> DataFrame:
    """Rows of the first ``most`` pages, which are counted from 0."""
    return rows.filter(F.col(page) < most)
