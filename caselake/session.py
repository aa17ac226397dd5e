"""A session with the settings that the operators expect."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(name: str = "caselake", master: str | None = None, **options: str) -> SparkSession:
    """UTC, adaptive execution and Arrow; ``options`` are further settings, dots written as double underscores."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
    } | {k.replace("__", "."): v for k, v in options.items()}
    return builder.config(map=settings).getOrCreate()
