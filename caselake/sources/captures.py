"""Captured files as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caselake.sources.split_csv import split_csv


def pages(spark: SparkSession, path: str, glob: str = "*.html") -> DataFrame:
    """path and html of every captured page below ``path``."""
    read = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(path, wholetext=True)
    return read.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("html"))


def files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """path, folder, name and length of every file below ``path``; contents are not read."""
    read = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path).select("path", "length")
    return read.withColumn("name", F.substring_index("path", "/", -1)).withColumn("folder", F.expr("left(path, length(path) - length(name) - 1)"))


def whole_csv(spark: SparkSession, path: str, schema: str, escape: str = '"') -> DataFrame:
    """An extract with a header and quoted texts over several lines, each file read by one task."""
    return spark.read.schema(schema).option("header", True).option("multiLine", True).option("quote", '"').option("escape", escape).csv(path)


def bulk_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """An extract with a header and quoted texts over several lines, compressed or not, each file read by all the tasks it can be cut for."""
    return split_csv(spark, path, schema)


def records(spark: SparkSession, path: str, schema: str, glob: str = "*.json") -> DataFrame:
    """JSON records, one or a list in a file, with ``path``; what can't be read is in ``_corrupt``."""
    read = spark.read.schema(f"{schema}, _corrupt string").option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt")
    return read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).json(path).withColumn("path", F.col("_metadata.file_path"))


def keys_in_csv(spark: SparkSession, path: str, key: str) -> DataFrame:
    """The distinct filled values of one column."""
    return spark.read.option("header", True).csv(path).select(F.trim(key).alias(key)).filter(F.col(key) != "").distinct()
