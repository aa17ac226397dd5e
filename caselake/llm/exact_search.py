"""Exact top-k search by integer inner products, in tiles.

Vectors are packed where they are read into shards of bounded size, a row each,
and so are the queries.  A grid of block of queries x group of shards is dealt
out; a task of it multiplies its queries with one shard after the other, picks
the best of each tile and merges them into one list a query.  Lists of several
groups are merged as a tree, so that no task ever holds more than ``FAN`` lists
of a query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import staged, table, unstage

#: Vectors of a shard, queries of a block, and vectors of a group of shards on average.
SHARD_ROWS, BLOCK_ROWS, GROUP_ROWS = 4096, 2048, 32_768
#: Bytes of a shard or block, however wide its vectors are (one vector at least).
SHARD_BYTES = 4 << 20
#: Scores that a task holds at a time, and lists of a query that are merged at a time.
TILE_SCORES, FAN = 1 << 20, 64
_LONG = np.iinfo(np.int64)
#: The kinds in which integers are packed, narrowest first.
_KINDS = ("<i2", "<i4", "<i8")
_PACKED = "shard bigint, width int, n int, ids binary, kind string, data binary"


def scaled(x: np.ndarray, scale: float = 256.0) -> np.ndarray:
    """floor(scale * x) as 64-bit integers; what lies beyond them becomes the nearest."""
    with np.errstate(over="ignore"):
        v = np.floor(x * scale)
    out = v.clip(-(2.0**63), 2.0**63 - 1024).astype(np.int64)
    out[v >= 2.0**63] = _LONG.max
    return out


def packed(vectors: DataFrame, rows: int) -> DataFrame:
    """Shards of at most ``rows`` vectors of one width: ids, ascending, and the integers row by row.

    ``vectors`` has vec_id and embedding (doubles).  A task packs what it reads,
    so nothing moves; a shard's number is that of its task and its place there.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, place = TaskContext.get().partitionId(), 0
        for b in batches:
            ids, lists = b.column(0).to_numpy(zero_copy_only=False), b.column(1)
            widths, flat = np.diff(lists.offsets.to_numpy()), lists.flatten().to_numpy(zero_copy_only=False)
            starts = np.cumsum(widths) - widths
            for width in np.unique(widths).tolist():
                own = np.flatnonzero(widths == width)
                own = own[np.argsort(ids[own], kind="stable")]
                step = max(1, min(rows, SHARD_BYTES // max(8 * width, 1)))
                for s in range(0, len(own), step):
                    at = own[s : s + step]
                    v = scaled(flat[starts[at][:, None] + np.arange(width)])
                    kind = next(k for k in _KINDS if k == "<i8" or (v.size == 0 or (v.min() >= np.iinfo(k).min and v.max() <= np.iinfo(k).max)))
                    row = [(task << 33) + place, width, len(at), ids[at].astype("<i8").tobytes(), kind, v.astype(kind).tobytes()]
                    place += 1
                    yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.string(), pa.binary()))], ["shard", "width", "n", "ids", "kind", "data"])

    return vectors.select("vec_id", "embedding").mapInArrow(pack, _PACKED)


def _unpacked(row: dict) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["data"], row["kind"]).reshape(row["n"], row["width"])


def products(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Exact inner products; floating point where no sum can pass 2**53, else integers of any size, cut to 64 bits."""
    most = lambda x: max(abs(int(x.min())), abs(int(x.max()))) if x.size else 0
    bound = max(1, q.shape[1]) * most(q) * most(v)
    if bound < 1 << 53:
        return (q.astype(np.float64) @ v.astype(np.float64).T).astype(np.int64)
    if bound <= _LONG.max:
        return q.astype(np.int64) @ v.astype(np.int64).T
    out = np.empty((len(q), len(v)), np.int64)
    wide = v.astype(object)
    for i, x in enumerate(q.astype(object)):
        out[i] = [min(max(int(s), _LONG.min), _LONG.max) for s in wide @ x]
    return out


def best(score: np.ndarray, valid: np.ndarray, k: int) -> np.ndarray:
    """Of each row the columns of its ``k`` largest valid scores, best first, ties to the smaller column; -1 where there are fewer."""
    n = score.shape[1]
    k = min(k, n)
    if max(abs(int(score.min(initial=0))), int(score.max(initial=0))) < (1 << 62) // max(n, 1):  # a score and its column in one number
        one = np.where(valid, score * n + (n - 1 - np.arange(n)), _LONG.min)
        top = np.sort(np.partition(one, n - k, axis=1)[:, n - k :], axis=1)[:, ::-1] if k else one[:, :0]
        return np.where(top == _LONG.min, -1, n - 1 - top % max(n, 1))
    out = np.full((len(score), k), -1, np.int64)
    for i, (s, ok) in enumerate(zip(score, valid)):
        at = np.flatnonzero(ok)
        at = at[np.argsort(~s[at], kind="stable")][:k]  # ~s falls as s rises, and never overflows
        out[i, : len(at)] = at
    return out


def tile(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, vec_id and score of the ``k`` best of the shard for each query, itself left out; ``ids`` ascend."""
    found = []
    for s in range(0, len(q), max(1, TILE_SCORES // max(len(v), 1))):
        e = min(len(q), s + max(1, TILE_SCORES // max(len(v), 1)))
        score = products(q[s:e], v)
        valid = np.ones(score.shape, bool)
        first, last = np.searchsorted(ids, q_ids[s:e]), np.searchsorted(ids, q_ids[s:e], "right")
        for i in np.flatnonzero(first < last):
            valid[i, first[i] : last[i]] = False
        at = best(score, valid, k)
        row, col = np.nonzero(at >= 0)
        found.append((row + s, ids[at[row, col]], score[row, at[row, col]]))
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 3


def _least(row: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """The places of the ``k`` best of each row."""
    order = np.lexsort((ids, ~score, row))
    r = row[order]
    first = np.searchsorted(r, r)
    return order[np.arange(len(r)) - first < k]


def top_k(queries: DataFrame, vectors: DataFrame, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` largest integer inner products of each query.

    ``queries`` and ``vectors`` have vec_id and embedding.  Each component x
    counts as floor(256 * x) of its value as double; components and scores beyond
    64 bits become the nearest long.  Ties go to the smaller vec_id, and a vector
    with the query's own id is no candidate.  Null vectors, such with null or
    non-finite components and rows without vec_id take no part on either side; a
    query is held against the vectors of its own width (those without components
    score 0).  Rows that repeat a vec_id are candidates each; a repeated query
    is answered for its smallest vector.  With fewer candidates than ``k`` all
    come back; an empty table gives an empty result.  Other columns are not read.
    """
    asked = staged(finite(queries).groupBy("vec_id").agg(F.min("embedding").alias("embedding")), "asked")
    slots = max(1, -(-asked.count() // BLOCK_ROWS))
    shards, blocks = staged(packed(finite(vectors), SHARD_ROWS), "shards"), staged(packed(asked.repartition(slots), BLOCK_ROWS), "blocks")
    unstage(asked)
    groups = max(1, -(-shards.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] // GROUP_ROWS))
    # a stated set of queries against all rows, in blocks: every shard meets the blocks of each slot in the task of its group
    left = blocks.select(F.shiftright("shard", 33).cast("int").alias("slot"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("node"), "width", "n", "ids", "kind", "data")
    right = shards.select(F.explode(F.sequence(F.lit(0), F.lit(slots - 1))).alias("slot"), F.pmod(F.xxhash64("shard"), F.lit(groups)).cast("int").alias("node"), "width", "n", "ids", "kind", "data")

    def search(key: tuple, mine: pa.Table, theirs: pa.Table) -> pa.Table:
        parts = [(np.zeros(0, np.int64),) * 3]
        for block in mine.to_pylist():
            q_ids, q = _unpacked(block)
            row, ids, score = (np.zeros(0, np.int64),) * 3
            for i in np.flatnonzero(theirs.column("width").to_numpy() == block["width"]):
                more = tile(q_ids, q, *_unpacked(theirs.slice(i, 1).to_pylist()[0]), k)
                row, ids, score = (np.concatenate(x) for x in zip((row, ids, score), more))
                kept = _least(row, ids, score, k)
                row, ids, score = row[kept], ids[kept], score[kept]
            parts.append((q_ids[row], ids, score))
        asked_, ids, score = (np.concatenate(x) for x in zip(*parts))
        return pa.table({"query_id": asked_, "node": pa.array(np.full(len(ids), key[1].as_py(), np.int32)), "vec_id": ids, "score": score})

    lists = left.groupBy("slot", "node").cogroup(right.groupBy("slot", "node")).applyInArrow(search, "query_id bigint, node int, vec_id bigint, score bigint")
    best_first = [F.desc("score"), F.col("vec_id")]
    while groups > FAN:
        groups = -(-groups // FAN)
        lists = lists.withColumn("node", F.expr(f"node div {FAN}").cast("int"))
        lists = lists.withColumn("r", F.row_number().over(Window.partitionBy("query_id", "node").orderBy(*best_first))).filter(F.col("r") <= k).drop("r")
    ranked = lists.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*best_first))).filter(F.col("rank") <= k)
    out = staged(ranked.select("query_id", "rank", "vec_id", "score"), "top")
    unstage(shards)
    unstage(blocks)
    return out


def finite(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding (doubles) of the rows that have both, all components finite."""
    held = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.transform("embedding", lambda v: v.cast("double")).alias("embedding"))
    fine = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return held.filter("vec_id IS NOT NULL AND embedding IS NOT NULL").filter(fine)


OP11_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.e, v.e)::BIGINT AS score
  FROM v AS q, v WHERE q.vec_id % 50 = 0 AND q.vec_id <> v.vec_id)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank, vec_id, score
FROM s QUALIFY rank <= 5"""


def op11_exact_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five largest integer inner products of every fiftieth vector with all others."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_k(vectors.filter(F.col("vec_id") % 50 == 0), vectors)
