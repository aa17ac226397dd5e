"""Incremental ingestion with Structured Streaming, and its batch forms."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from caselake.operators.dedupe import last_wins
from caselake.operators.joins import upserted


def phase_rank(phase: Column | str, order: list[str]) -> Column:
    """The place of a phase in ``order``, from 1; 0 for none or another one."""
    c = F.col(phase) if isinstance(phase, str) else phase
    out = F.lit(0)
    for i, name in enumerate(order, 1):
        out = F.when(c == name, i).otherwise(out)
    return out


def new_keys(stream: DataFrame, keys: list[str], time: str, delay: str) -> DataFrame:
    """The first row of each key; a key is remembered until ``delay`` after its time."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def furthest_phase(stream: DataFrame, key: str, phase: str, order: list[str]) -> DataFrame:
    """A row whenever a key reaches a later phase than ever before: key, phase and its rank."""
    rank = {name: i for i, name in enumerate(order, 1)}

    def advance(k: tuple[Any, ...], frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        best = state.get[0] if state.exists else 0
        seen = max((rank.get(p, 0) for f in frames for p in f[phase]), default=0)
        if seen > best:
            state.update((seen,))
            yield pd.DataFrame({key: [k[0]], phase: [order[seen - 1]], "rank": [seen]})

    kind = stream.schema[key].dataType.simpleString()
    return stream.groupBy(key).applyInPandasWithState(advance, f"{key} {kind}, {phase} string, rank int", "rank int", "update", GroupStateTimeout.NoTimeout)


#: Key ranges of an upserted table; a batch rewrites only those that its keys fall into.
BUCKETS = 64


def upsert_batches(spark: SparkSession, stream: DataFrame, target: str, keys: list[str], seq: list[str], checkpoint: str, buckets: int = BUCKETS):
    """Run a stream once and upsert its rows into the Parquet table ``target``, the last of each key winning.

    The table is a list of folders, one for each bucket of keys, and each version
    of that list is a file of its own under ``target/_versions``.  A micro-batch
    writes the buckets that it touches into fresh folders and is published by
    the renaming of one such file; no file that a version names is ever written
    again.  A batch that runs again after that changes nothing, as versions tell
    which batches of which checkpoint they hold; one that fails before leaves
    folders that no version names (``prune`` deletes them).
    """
    import json

    def write(batch: DataFrame, number: int) -> None:
        run = json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]
        apply_batch(spark, target, batch, run, number, keys, seq, buckets)

    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def apply_batch(spark: SparkSession, target: str, batch: DataFrame, run: str, number: int, keys: list[str], seq: list[str], buckets: int = BUCKETS) -> None:
    """Upsert batch ``number`` of ``run`` as the table's next version, unless a version holds it."""
    import json
    import uuid

    last = _version(spark, target)
    if last is not None and last["runs"].get(run, -1) >= number:
        return
    buckets = last["buckets"] if last else buckets
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    rows = last_wins(batch, keys, seq).drop("position")
    rows.persist()
    touched = sorted(r[0] for r in rows.select(bucket.alias("b")).distinct().collect())
    held = {b: f for b, f in (last["folders"] if last else {}).items() if int(b) in touched}
    merged = rows
    if held:
        old = spark.read.schema(T.StructType.fromJson(last["schema"])).parquet(*[f"{target}/{f}" for f in held.values()])
        merged = upserted(old, rows, keys)
    attempt = f"data/{uuid.uuid4().hex}"
    part = fresh_name(merged, "bucket")
    merged.withColumn(part, bucket).repartition(part).write.partitionBy(part).parquet(f"{target}/{attempt}")
    rows.unpersist()
    now = {
        "version": (last["version"] if last else 0) + 1,
        "runs": (last["runs"] if last else {}) | {run: number},
        "buckets": buckets,
        "folders": (last["folders"] if last else {}) | {str(b): f"{attempt}/{part}={b}" for b in touched},
        "schema": json.loads(merged.schema.json()),
    }
    _publish(spark, f"{target}/_versions", f"{now['version']:012d}.json", json.dumps(now))


def fresh_name(rows: DataFrame, name: str) -> str:
    """``name``, with underlines before it until no column is called so."""
    while name.lower() in {c.lower() for c in rows.columns}:
        name = f"_{name}"
    return name


def _files(spark: SparkSession, folder: str):
    """Hadoop's file system for a folder, and its Path class."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    return path(folder).getFileSystem(spark._jsc.hadoopConfiguration()), path


def _publish(spark: SparkSession, folder: str, name: str, content: str) -> None:
    """Write a file and give it its name in one step; a name that exists is not replaced."""
    import uuid

    fs, path = _files(spark, folder)
    draft = path(f"{folder}/_draft-{uuid.uuid4().hex}")
    out = fs.create(draft)
    out.write(bytearray(content.encode()))
    out.close()
    if fs.exists(path(f"{folder}/{name}")) or not fs.rename(draft, path(f"{folder}/{name}")):
        fs.delete(draft, False)
        raise RuntimeError(f"{folder}/{name} was published by another writer")


def _version(spark: SparkSession, target: str) -> dict | None:
    """The last published version, if there is one."""
    import json

    fs, path = _files(spark, target)
    if not fs.exists(path(f"{target}/_versions")):
        return None
    names = [f.getPath().getName() for f in fs.listStatus(path(f"{target}/_versions"))]
    whole = sorted(n for n in names if n.endswith(".json") and n[0].isdigit())
    return json.loads(spark.read.option("wholetext", True).text(f"{target}/_versions/{whole[-1]}").first()[0]) if whole else None


def latest(spark: SparkSession, target: str) -> DataFrame | None:
    """The table as of its last whole batch; None before the first."""
    now = _version(spark, target)
    if now is None:
        return None
    kind = T.StructType.fromJson(now["schema"])
    return spark.read.schema(kind).parquet(*[f"{target}/{f}" for f in now["folders"].values()]) if now["folders"] else spark.createDataFrame([], kind)


def prune(spark: SparkSession, target: str, keep: int = 2) -> int:
    """Delete all but the last ``keep`` versions, and data folders that those do not name; the number of folders that went.

    Not while a batch runs, as its folders are named by no version yet.
    """
    import json

    fs, path = _files(spark, target)
    names = sorted(f.getPath().getName() for f in fs.listStatus(path(f"{target}/_versions")))
    kept = [n for n in names if n.endswith(".json") and n[0].isdigit()][-keep:]
    used = {f.split("/")[1] for n in kept for f in json.loads(spark.read.option("wholetext", True).text(f"{target}/_versions/{n}").first()[0])["folders"].values()}
    for n in names:
        if n not in kept:
            fs.delete(path(f"{target}/_versions/{n}"), False)
    gone = [f.getPath() for f in fs.listStatus(path(f"{target}/data")) if f.getPath().getName() not in used]
    for f in gone:
        fs.delete(f, True)
    return len(gone)


def modified_since(rows: DataFrame, processed: DataFrame, modified: str, id: str) -> DataFrame:
    """Rows later than the latest of ``processed``, and those of that very time whose id it lacks.

    The high-watermark is one row, from an aggregate; without processed rows all
    are new.  Rows without a time are never new, as no time tells when they were
    processed; ``rows.filter("<modified> IS NULL")`` has them.
    """
    mark = processed.agg(F.max(modified).alias("_mark"))
    late = rows.join(F.broadcast(mark), F.col(modified) >= F.coalesce("_mark", F.col(modified)))
    same = processed.select(F.col(id), F.col(modified), F.lit(True).alias("_seen")).distinct()
    return late.join(same, [id, modified], "left").filter("_seen IS NULL").select(*rows.columns)


def to_retry(status: DataFrame, keys: list[str], seq: list[str], done: list[str]) -> DataFrame:
    """Keys whose latest status is not among ``done``."""
    return last_wins(status, keys, seq).drop("position").filter(~F.coalesce(F.col("status").isin(done), F.lit(False)))
