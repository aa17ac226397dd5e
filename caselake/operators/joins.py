"""Parents and children resolved by joins.

No side is broadcast by hand: which one is small is for the optimiser to tell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def members(rows: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows whose key is among ``keys``; each row at most once, whatever repeats there."""
    return rows.join(keys.select(on), on, "left_semi")


def orphans(rows: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows whose key is not among ``keys``; rows without a key are orphans."""
    return rows.join(keys.select(on), on, "left_anti")


def known_or_unkeyed(rows: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows whose key is known or missing, with ``orphan`` true for the latter."""
    unkeyed = rows.filter(F.col(on).isNull()).withColumn("orphan", F.lit(True))
    return members(rows, keys, on).withColumn("orphan", F.lit(False)).unionByName(unkeyed)


def resolved_chain(children: DataFrame, parents: DataFrame, grandparents: DataFrame, parent_key: str, grandparent_key: str) -> DataFrame:
    """Children with what is known of their parent and its parent; none is lost."""
    return children.join(parents, parent_key, "left").join(grandparents, grandparent_key, "left")


def preferred(sources: list[DataFrame], on: str) -> DataFrame:
    """One row for each key, from the first source that has it (map, cache, fetch).

    All sources have the same columns; a key repeats in none of them.
    """
    ranked = [s.withColumn("_source", F.lit(i)) for i, s in enumerate(sources)]
    out = ranked[0]
    for s in ranked[1:]:
        out = out.unionByName(s)
    rest = [c for c in sources[0].columns if c != on]
    best = out.groupBy(on).agg(F.min_by(F.struct(*rest), "_source").alias("_row"))
    return best.select(on, *[F.col(f"_row.{c}").alias(c) for c in rest])


def enriched(partial: DataFrame, full: DataFrame, on: str) -> DataFrame:
    """Rows of ``partial``, taken from ``full`` as a whole where that has the key."""
    rest = [c for c in partial.columns if c != on]
    there = full.select(on, F.struct(*[F.col(c) for c in rest]).alias("_full"))
    joined = partial.join(there, on, "left")
    return joined.select(on, *[F.when(F.col("_full").isNotNull(), F.col(f"_full.{c}")).otherwise(F.col(c)).alias(c) for c in rest])


def upserted(old: DataFrame, new: DataFrame, on: list[str]) -> DataFrame:
    """``new`` and the rows of ``old`` whose key it lacks."""
    return old.join(new.select(*on), on, "left_anti").unionByName(new, allowMissingColumns=True)


def named(rows: DataFrame, names: DataFrame, key: str, name: str, alias: str) -> DataFrame:
    """``alias`` is the name of the key, and the key itself where it has none."""
    return rows.join(names.select(key, F.col(name).alias(alias)), key, "left").withColumn(alias, F.coalesce(alias, F.col(key).cast("string")))


def letter_pairs(spark) -> DataFrame:
    """The 676 two-letter prefixes AA to ZZ."""
    return spark.range(676).select(F.concat(F.chr((F.col("id") / 26).cast("int") + 65), F.chr(F.col("id") % 26 + 65)).alias("prefix"))


def parsed_prefixes(listed: Column) -> Column:
    """The two-letter prefixes in a comma-separated list, upper-cased; all else is left out."""
    return F.filter(F.transform(F.split(listed, ","), lambda p: F.upper(F.trim(p))), lambda p: p.rlike("^[A-Z]{2}$"))


def coverage(whole: DataFrame, part: DataFrame, on: list[str]) -> DataFrame:
    """``whole`` with ``covered``: whether ``part`` has the key."""
    return whole.join(part.select(*on).distinct().withColumn("covered", F.lit(True)), on, "left").withColumn("covered", F.coalesce("covered", F.lit(False)))


def tasks(spark, first: int, last: int, courts: list[str]) -> DataFrame:
    """Every year of a range with every court: the dimensions of a run, as parameters give them."""
    years = spark.range(first, last + 1).select(F.col("id").cast("int").alias("year"))
    return years.select("year", F.explode(F.array(*[F.lit(c) for c in courts])).alias("court"))


def each_with(rows: DataFrame, listed: Column, alias: str) -> DataFrame:
    """A row for each item of a list that hangs on the row, as kinds of opinions have their own years; without items the row goes."""
    return rows.withColumn(alias, F.explode(listed))


def filled(rows: DataFrame, defaults: dict) -> DataFrame:
    """Columns that an older record lacks, or holds as null, get their defaults."""
    return rows.select(*[F.coalesce(F.col(c), F.lit(defaults[c])).alias(c) if c in defaults else F.col(c) for c in rows.columns], *[F.lit(v).alias(c) for c, v in defaults.items() if c not in rows.columns])
