"""Dockets, clusters and opinions stored for joins: bucketed and sorted by the keys they meet on.

Texts are written to the bucket of their cluster once.  Grouping them by cluster
and joining them to it then moves no text: only clusters, which are short, go to
where the opinions are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caselake.functions import values
from caselake.operators import limits
from caselake.plans.bulk import COURTS, typed_opinions


def store(dockets: DataFrame, clusters: DataFrame, opinions: DataFrame, name: str, buckets: int = 256, path: str | None = None) -> None:
    """Write the tables ``name``_dockets, _clusters and _opinions of the catalogue; keys are numbers, rows without one go.

    Their files lie below ``path``, or in the warehouse without one.  A bucket should hold some hundred megabytes of opinions.
    """
    number = lambda c: values.whole_number(c)
    texts = typed_opinions(opinions).filter("cluster_id IS NOT NULL")
    whole = {
        "dockets": (dockets.select(number("id").alias("docket_id"), "court_id", "docket_number", F.col("case_name").alias("docket_name")), "docket_id"),
        "clusters": (clusters.select(number("id").alias("cluster_id"), number("docket_id").alias("docket_id"), "date_filed", "case_name"), "cluster_id"),
        "opinions": (texts, "cluster_id"),
    }
    for table, (rows, key) in whole.items():
        # as many files as buckets: each task has the rows of its own
        rows = rows.filter(F.col(key).isNotNull()).repartition(buckets, key)
        rows.write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key).saveAsTable(f"{name}_{table}", **({"path": f"{path}/{table}"} if path else {}))


def stored_cases(spark: SparkSession, name: str, first: int, last: int, courts: tuple[str, ...] = COURTS) -> DataFrame:
    """One row for each cluster with an opinion, of one of ``courts`` and filed in the range of years: cluster_id, docket_id, court, docket_number, case_name, date_filed, opinions (by id)."""
    ours = spark.table(f"{name}_dockets").filter(F.col("court_id").isin(*courts)).select("docket_id", F.col("court_id").alias("court"), "docket_number", "docket_name")
    filed = limits.between_years(spark.table(f"{name}_clusters"), "date_filed", first, last)
    placed = filed.join(ours, "docket_id")
    opinions = spark.table(f"{name}_opinions")
    texts = opinions.groupBy("cluster_id").agg(F.array_sort(F.collect_list(F.struct(*[c for c in opinions.columns if c != "cluster_id"]))).alias("opinions"))
    out = placed.join(texts, "cluster_id")
    return out.select("cluster_id", "docket_id", "court", "docket_number", F.coalesce(F.nullif("case_name", F.lit("")), "docket_name").alias("case_name"), "date_filed", "opinions")
