"""Counts, collected children, completeness and coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselake.functions.values import percent


def parents_with_children(parents: DataFrame, children: DataFrame, on: str, by: list[str]) -> DataFrame:
    """For each group of parents how many there are, have a child, and have none.

    Children are reduced to their keys first, so a parent with many counts once.
    """
    has = children.select(on).distinct().withColumn("_has", F.lit(1))
    joined = parents.join(has, on, "left")
    return joined.groupBy(*by).agg(
        F.count("*").alias("n_parents"),
        F.count("_has").alias("n_with_child"),
        (F.count("*") - F.count("_has")).alias("n_without_child"),
    )


def collected(children: DataFrame, by: str, order: list[str], fields: list[str], alias: str = "children") -> DataFrame:
    """The children of each parent as an array of structs in a stated order."""
    items = F.array_sort(F.collect_list(F.struct(*order, *[f for f in fields if f not in order])))
    return children.groupBy(by).agg(items.alias(alias))


def one_or_many(children: Column) -> Column:
    """JSON of a single child as itself, of several as their list."""
    return F.when(F.size(children) == 1, F.to_json(F.get(children, F.lit(0)))).when(F.size(children) > 1, F.to_json(F.struct(children.alias("sub_opinions"))))


def first_child(children: DataFrame, by: str, order: list[str], fields: list[str]) -> DataFrame:
    """A parent made from its first child: its fields, and how many children there are."""
    best = F.min_by(F.struct(*fields), F.struct(*order))
    out = children.groupBy(by).agg(best.alias("_c"), F.count("*").alias("n_children"))
    return out.select(by, *[F.col(f"_c.{f}").alias(f) for f in fields], "n_children")


def counts_with_totals(rows: DataFrame, outer: str, inner: str) -> DataFrame:
    """Counts by both columns, by the outer one, and of all; level is 0, 1 and 2."""
    return rows.rollup(outer, inner).agg(F.count("*").alias("n_rows"), (F.grouping(outer) + F.grouping(inner)).cast("int").alias("level"))


def status_counts(rows: DataFrame, by: list[str], status: str, names: list[str]) -> DataFrame:
    """total, and a count of each status."""
    return rows.groupBy(*by).agg(F.count("*").alias("total"), *[F.count_if(F.col(status) == n).alias(n) for n in names])


def completeness(parts: DataFrame, case: str, kind: str) -> DataFrame:
    """Each case as complete, docket_only or partial, by the kinds of its parts."""
    has = lambda k: F.coalesce(F.bool_or(F.col(kind) == k), F.lit(False))
    flags = parts.groupBy(case).agg(has("docket").alias("_d"), has("cluster").alias("_c"), has("opinion").alias("_o"))
    state = F.when(F.col("_d") & F.col("_c") & F.col("_o"), "complete").when(F.col("_d") & ~F.col("_c") & ~F.col("_o"), "docket_only").otherwise("partial")
    return flags.select(case, state.alias("state"))


def coverage_report(covered: DataFrame, by: list[str]) -> DataFrame:
    """total, covered, missing and the share covered, of rows with a flag ``covered``."""
    n, hit = F.count("*"), F.count_if(F.col("covered"))
    return covered.groupBy(*by).agg(n.alias("total"), hit.alias("n_covered"), (n - hit).alias("n_missing"), percent(hit, n).alias("pct_covered"))


def carried_forward(rows: DataFrame, by: list[str], order: list[str], value: str, alias: str) -> DataFrame:
    """The last value that was not null, up to each row of its group."""
    from pyspark.sql import Window

    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(alias, F.last(value, ignorenulls=True).over(w))


def counts_as_first_seen(rows: DataFrame, by: str, seq: list[str]) -> DataFrame:
    """The count of each value, in the order in which values first occur."""
    found = rows.groupBy(by).agg(F.count("*").alias("n_rows"), F.min(F.struct(*seq)).alias("first_seen"))
    return found.orderBy("first_seen")


def total_listed(rows: DataFrame, *lists: str) -> DataFrame:
    """One row: the number of items in all lists of all rows; null lists hold none."""
    sizes = [F.when(F.col(c).isNotNull(), F.size(c)).otherwise(0) for c in lists]
    return rows.agg(F.coalesce(F.sum(sum(sizes[1:], sizes[0])), F.lit(0)).cast("bigint").alias("n_items"))


def field_sample(rows: DataFrame, order: list[str], most: int = 10, chars: int = 60) -> DataFrame:
    """The last row by ``order`` as field and value: its first ``most`` columns by name, each cut to ``chars``, and the number of columns."""
    names = sorted(rows.columns)
    last = rows.agg(F.max_by(F.struct(*[F.substring(F.coalesce(F.col(c).cast("string"), F.lit("(null)")), 1, chars).alias(c) for c in names[:most]]), F.struct(*order)).alias("r")).filter("r IS NOT NULL")
    pairs = F.array(*[F.struct(F.lit(c).alias("field"), F.col(f"r.`{c}`").alias("value")) for c in names[:most]])
    return last.select(F.inline(pairs), F.lit(len(names)).alias("n_fields")) if names else last
