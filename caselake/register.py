"""Names for SQL: the paged source, functions that read like the Column ones, and listings as table functions."""

from __future__ import annotations

from pyspark.sql import SparkSession

from caselake.functions import text
from caselake.plans.table_functions import register_tables
from caselake.sources.paged import PagedSource


def _quoted(s: str) -> str:
    """A SQL literal, every character but letters and digits by its number."""
    return "'" + "".join(c if c.isascii() and c.isalnum() else f"\\u{ord(c):04x}" for c in s) + "'"


def functions() -> dict[str, tuple[str, str, str]]:
    """Name, parameters, type and body of each SQL function."""
    spaces, white = _quoted(text.SPACES), _quoted(f"[{text.WS}]+")
    signs = _quoted(rf"[^\p{{L}}\p{{N}}_{text.WS}-]")
    kept = f"btrim(regexp_replace(lower(coalesce(s, '')), {signs}, ''), {spaces})"
    joined = f"regexp_replace(regexp_replace({kept}, {_quoted(f'[{text.WS}_]+')}, '-'), '-+', '-')"
    return {
        "clean_ws": ("s STRING", "STRING", f"btrim(regexp_replace(coalesce(s, ''), {white}, ' '), ' ')"),
        "slugify": ("s STRING", "STRING", f"coalesce(nullif(btrim(substring({joined}, 1, 60), '-'), ''), 'unknown')"),
        "folder_name": ("s STRING", "STRING", f"substring(btrim(regexp_replace(regexp_replace(coalesce(s, ''), {_quoted(f'[{text.FORBIDDEN}]')}, ''), {white}, '-'), '-.'), 1, 120)"),
        "first_filled": ("a STRING, b STRING", "STRING", "coalesce(nullif(a, ''), nullif(b, ''))"),
    }


def register(spark: SparkSession) -> list[str]:
    """Register the data source ``paged_json``, the SQL functions of ``functions`` and the table functions for this session; their names."""
    spark.dataSource.register(PagedSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    names = []
    for name, (parameters, kind, body) in functions().items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {kind} RETURN {body}")
        names.append(name)
    return [PagedSource.name(), *names, *register_tables(spark)]
