"""Where results go.  Every sink may be run again with the same outcome."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caselake.operators.nested import exported


def write_cases(cases: DataFrame, path: str, by: list[str]) -> None:
    """Parquet in folders by ``by``; only the folders that occur in ``cases`` are replaced."""
    cases.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def write_case_json(cases: DataFrame, path: str, by: list[str]) -> None:
    """As JSON lines, a record for each case."""
    cases.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).json(path)


def export_csv(frames: list[DataFrame], path: str) -> None:
    """Flattened records of all frames in one schema, columns sorted, with a header."""
    exported(frames).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def append_once(rows: DataFrame, path: str, run: str) -> None:
    """Add the rows of one run; running it again replaces its own rows only."""
    write_cases(rows.withColumn("run", F.lit(run)), path, ["run"])
