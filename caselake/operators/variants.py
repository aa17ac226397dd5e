"""JSON of no known schema: roots that are a record or a list of them, and the union of all keys."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caselake.operators.nested import _leaves


def opened(rows: DataFrame, json: str, alias: str = "record") -> DataFrame:
    """A row for each record in the column ``json``: of a list each of its items, else the root itself; what is no JSON, or no record, gives none.

    Other columns stay; ``alias`` is a VARIANT.
    """
    whole = F.try_parse_json(json)
    listed = F.startswith(F.schema_of_variant("_whole"), F.lit("ARRAY<"))
    items = F.when(listed, F.expr("CAST(_whole AS ARRAY<VARIANT>)")).otherwise(F.array("_whole"))
    kept = [c for c in rows.columns if c != alias]
    out = rows.withColumn("_whole", whole).filter("_whole IS NOT NULL")
    return out.select(*kept, F.explode(items).alias(alias)).filter(F.startswith(F.schema_of_variant(alias), F.lit("OBJECT<")))


def unread(rows: DataFrame, json: str) -> DataFrame:
    """Rows whose column ``json`` is missing or no JSON."""
    return rows.filter(F.try_parse_json(json).isNull())


def key_schema(records: DataFrame, record: str = "record") -> T.StructType:
    """The union of all records' keys with types that hold all their values: one aggregate, of which one row reaches the driver."""
    told = records.agg(F.schema_of_variant_agg(record)).first()[0] or "VOID"
    # names stand in backticks where they are no plain words, and are left as they are
    parts = re.split(r"(`(?:[^`]|``)*`)", told)
    ddl = "".join(p if i % 2 else p.replace("OBJECT<", "STRUCT<") for i, p in enumerate(parts))
    if not ddl.startswith("STRUCT<"):
        return T.StructType()
    return T.DataType.fromDDL(ddl) if ddl != "STRUCT<>" else T.StructType()


def _place(path: tuple[str, ...]) -> str:
    """A path within a variant; names may hold dots and blanks."""
    def step(name: str) -> str:
        if "'" in name and '"' in name:
            raise ValueError(f"a key with both kinds of quotes has no path: {name}")
        return f'["{name}"]' if "'" in name else f"['{name}']"

    return "$" + "".join(step(p) for p in path)


def key_union(records: DataFrame, record: str = "record", sep: str = "_", keep: tuple[str, ...] = ()) -> DataFrame:
    """All keys as text columns parent_child, sorted by name, empty where a record lacks them; lists as JSON.

    Values of keys that are a record here and none there stand under the key
    itself, as JSON if they are no scalars.  Of two paths of one name the later
    counts where it has a value.  ``keep`` names columns that stay in front.
    """
    columns: dict[str, list[Column]] = {}
    for path, kind in _leaves(key_schema(records, record)):
        if isinstance(kind, (T.ArrayType, T.VariantType, T.StructType)):
            whole = F.try_variant_get(F.col(record), _place(path), "variant")
            text = F.coalesce(F.try_variant_get(F.col(record), _place(path), "string"), F.to_json(whole)) if isinstance(kind, T.VariantType) else F.to_json(whole)
        else:
            text = F.try_variant_get(F.col(record), _place(path), "string")
        columns.setdefault(sep.join(path), []).append(text)
    return records.select(*keep, *[F.coalesce(*c[::-1], F.lit("")).alias(n) for n, c in sorted(columns.items())])
