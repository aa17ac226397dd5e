"""Nested records: flattening, the union of schemas, cascades of keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _leaves(schema: T.StructType, prefix: tuple[str, ...] = ()) -> list[tuple[tuple[str, ...], T.DataType]]:
    out = []
    for f in schema.fields:
        path = (*prefix, f.name)
        out += _leaves(f.dataType, path) if isinstance(f.dataType, T.StructType) else [(path, f.dataType)]
    return out


def flattened(rows: DataFrame, sep: str = "_") -> DataFrame:
    """Nested fields as columns parent_child; arrays and maps as JSON; the later of two equal names counts."""
    cols: dict[str, Column] = {}
    for path, kind in _leaves(rows.schema):
        c = F.col(".".join(f"`{p}`" for p in path))
        cols[sep.join(path)] = F.to_json(c) if isinstance(kind, (T.ArrayType, T.MapType)) else c
    return rows.select(*[c.alias(n) for n, c in cols.items()])


def exported(frames: list[DataFrame]) -> DataFrame:
    """All rows of flattened frames as text, columns sorted by name, empty where missing."""
    flat = [flattened(f) for f in frames]
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [f.select(*[F.col(c).cast("string").alias(c) for c in f.columns]) for f in flat])
    return both.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in sorted(both.columns)])


def first_key(json: Column, paths: list[str]) -> Column:
    """The first of some JSON paths that holds text."""
    return F.coalesce(*[F.nullif(F.get_json_object(json, p), F.lit("")) for p in paths])


def items(rows: DataFrame, array: str, alias: str) -> DataFrame:
    """A row for each item; rows whose array is empty or null go."""
    return rows.withColumn(alias, F.explode(array))
