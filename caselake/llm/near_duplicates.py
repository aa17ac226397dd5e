"""Near-duplicate documents by MinHash: fast similarity sketches, bands, exact sets.

The sketch of a set fills ``bands * rows`` bins.  Round after round throws every
element into one bin by a fresh hash, and a bin keeps the least value of the
first round that reaches it; rounds of one bin each, over all elements, end it,
so that every bin is filled.  Two sets agree in a bin with the probability of
their Jaccard similarity, and the share of bins in which they agree is
concentrated around it.  Sets that agree in all bins of a band meet in a bucket.

With 56 bands of 6 bins, sets at a similarity of 0.8 miss each other with a
probability of 4e-8; every pair that meets is held against the full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import staged, table, unstage
from .words import Words, grams, mix, slices

BANDS, ROWS = 56, 6
#: Up to so many ids (16 bytes each) go to all executors; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000
#: Most members of a bucket that are compared with as many others in one step.
BLOCK = 512


def few(ids: DataFrame, most: int = BROADCAST_IDS) -> DataFrame:
    """``ids``, marked for broadcast if a count shows that they are few."""
    return F.broadcast(ids) if ids.limit(most + 1).count() <= most else ids


def _sets(text: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of the distinct k-word shingles of each row, sorted by row and hash."""
    w = Words(text, lower=True)
    h, words, row = w.hashes(), w.counts(), w.row_of_word()
    g = grams(h, k)
    whole = np.arange(len(h)) + k <= w.first[1:][row]
    rows, shingles = [row[whole]], [g[whole]]
    for n in range(1, k):  # fewer words are one shingle
        short = np.flatnonzero(words == n)
        if len(short):
            rows.append(short)
            shingles.append(grams(h, n)[w.first[short]])
    rows, shingles = np.concatenate(rows), np.concatenate(shingles)
    order = np.lexsort((shingles, rows))
    rows, shingles = rows[order], shingles[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (shingles[1:] != shingles[:-1])
    return rows[new], shingles[new]


def _sketch(row: np.ndarray, x: np.ndarray, n: int, t: int) -> np.ndarray:
    """The t-bin sketch of each of n sets, which are given by sorted row and element."""
    empty = np.uint64((1 << 64) - 1)
    out = np.full(n * t, empty)
    for i in range(2 * t):
        v = mix(x, i + 7)
        low = v & np.uint64(0xFFFFFFFF)
        at = ((v >> np.uint64(32)) * np.uint64(t)) >> np.uint64(32) if i < t else np.uint64(i - t)
        np.minimum.at(out, row * t + at.astype(np.int64), (np.uint64(i) << np.uint64(32)) | low)
        live = np.unique(row)
        open_ = np.zeros(n, bool)
        open_[live] = (out.reshape(n, t)[live] == empty).any(1)
        keep = open_[row]
        if not keep.any():
            break
        row, x = row[keep], x[keep]
    return out.reshape(n, t)


def _describe(k: int, bands: int, rows: int):
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s, e in slices(b.column(1)):
                row, g = _sets(b.column(1).slice(s, e - s), k)
                n = np.bincount(row, minlength=e - s)
                held = np.flatnonzero(n)
                first = np.searchsorted(row, held)
                prints = [np.zeros(e - s, np.uint64), np.zeros(e - s, np.uint64)]
                keys = np.zeros((0, bands), np.uint64)
                if len(held):
                    for j, p in enumerate(prints):
                        p[held] = np.add.reduceat(mix(g, 1001 + j), first)
                    sketch = _sketch(np.searchsorted(held, row), g, len(held), bands * rows).reshape(len(held), bands, rows)
                    keys = np.broadcast_to(np.arange(bands, dtype=np.uint64), (len(held), bands))
                    for r in range(rows):
                        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + sketch[:, :, r], r)
                offsets = np.concatenate(([0], np.cumsum((n > 0) * bands))).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.view(np.int64).ravel()))
                columns = [b.column(0).slice(s, e - s), pa.array(n.astype(np.int64)), *(pa.array(p.view(np.int64)) for p in prints), lists]
                yield pa.RecordBatch.from_arrays(columns, ["id", "n", "p", "q", "keys"])

    return describe


def _shingle_sets(docs: DataFrame, k: int) -> DataFrame:
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s, e in slices(b.column(1)):
                row, g = _sets(b.column(1).slice(s, e - s), k)
                first = np.searchsorted(row, np.arange(e - s + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(s, e - s), pa.ListArray.from_arrays(pa.array(first), pa.array(g.view(np.int64)))], ["id", "shingles"])

    return docs.mapInArrow(build, "id long, shingles array<long>")


def components(links: DataFrame) -> DataFrame:
    """id and component (the smallest id reachable) of every id in ``links`` (a, b).

    Stars are merged until nothing moves: each id hands its larger neighbours to
    the smallest one, then its smaller neighbours.  Ids without links are not
    listed; an empty table gives an empty one.
    """
    edges = staged(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "edges")
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = staged(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")), "least")  # staged, so that a hub's links can be split in the join
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        large = staged(large, "large")
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(down.select("a", F.col("m").alias("b"))).distinct()
        small = staged(small, "small")
        unstage(edges)
        unstage(large)
        unstage(least)
        edges = small
        # done when all edges lead to a centre that leads nowhere itself
        ends = edges.groupBy("a").agg(F.count("*").alias("n"), F.lit(0).alias("m")).unionByName(edges.select(F.col("b").alias("a")).distinct().select("a", F.lit(1).cast("long").alias("n"), F.lit(1).alias("m")))
        if ends.groupBy("a").agg(F.sum("n").alias("n")).filter("n > 1").isEmpty():
            return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())


def _verified(pairs: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """Those of the distinct ``pairs`` (a, b) whose full sets are similar, staged; rows that repeat an id may repeat a link."""
    ids = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    sets = staged(_shingle_sets(docs.join(few(ids), "id", "left_semi"), k), "sets")
    a, b = sets.select(F.col("id").alias("a"), F.col("shingles").alias("x")), sets.select(F.col("id").alias("b"), F.col("shingles").alias("y"))
    shared = F.size(F.array_intersect("x", "y"))
    held = pairs.join(a, "a").join(b, "b").select("a", "b", shared.alias("s"), (F.size("x") + F.size("y") - shared).alias("u"))
    # no distinct here: it would tie the joins' tasks to their keys, and a hub's pairs could not be split
    out = staged(held.filter(F.col("s") * 100 >= F.col("u") * percent).select("a", "b"), "links")
    unstage(sets)
    return out


def _links_within(sets: list[np.ndarray], ids: np.ndarray, component: np.ndarray, side: np.ndarray | None, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of some sets that are not of one component yet, as each id and the smallest id it reaches here.

    All shared shingles are counted at once, as products of incidence matrices of
    some columns each.  With ``side`` only pairs from different sides count.
    """
    n = np.array([len(x) for x in sets])
    owner, flat = np.repeat(np.arange(len(sets)), n), np.concatenate(sets)
    _, column, seen = np.unique(flat, return_inverse=True, return_counts=True)
    owner, column = owner[seen[column] > 1], column[seen[column] > 1]
    _, column = np.unique(column, return_inverse=True)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    shared = np.zeros((len(sets), len(sets)), np.float32)
    for low in range(0, int(column.max(initial=-1)) + 1, 4096):
        s, e = np.searchsorted(column, (low, low + 4096))
        held = np.zeros((len(sets), int(column[e - 1]) - low + 1), np.float32)
        held[owner[s:e], column[s:e] - low] = 1
        shared += held @ held.T
    linked = shared * 100 >= percent * (n[:, None] + n[None, :] - shared)
    linked &= component[:, None] != component[None, :]
    if side is not None:
        linked &= side[:, None] != side[None, :]
    label = ids.copy()
    while True:
        least = np.minimum(label, np.where(linked, label[None, :], np.iinfo(np.int64).max).min(1))
        if (least == label).all():
            break
        label = least
    moved = np.flatnonzero(label != ids)
    return ids[moved], label[moved]


def _compare(percent: int):
    """Links of each bucket block, from rows sorted by key, i and j."""

    def links(group: pa.Table, i: int, j: int) -> pa.RecordBatch | None:
        group = group.combine_chunks()
        lists = group["shingles"].chunk(0)
        flat, offsets = lists.flatten().to_numpy(zero_copy_only=False), np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))))
        sets = [flat[s:e] for s, e in zip(offsets[:-1], offsets[1:])]
        side = group["block"].to_numpy() if i != j else None
        a, b = _links_within(sets, group["id"].to_numpy(), group["c"].to_numpy(), side, percent)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"]) if len(a) else None

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        now = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in range(3)], 1)
            first = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]).any(1))))
            for s, e in zip(first, np.append(first[1:], batch.num_rows)):
                key = tuple(keys[s])
                if now is not None and key != now:
                    if out := links(pa.Table.from_batches(held), now[1], now[2]):
                        yield out
                    held = []
                now = key
                held.append(batch.slice(s, e - s))
        if held and (out := links(pa.Table.from_batches(held), now[1], now[2])):
            yield out

    return compare


def _block(blocks: Column) -> Column:
    return F.pmod(F.xxhash64("id"), blocks).cast("int")


def _rest_blocks(split: DataFrame) -> DataFrame:
    """Blocks that hold the members outside a bucket's main component against one another."""
    blocks = F.ceil(F.col("rest") / BLOCK)
    rest = split.filter("c <> main").withColumn("block", _block(blocks)).withColumn("with", F.explode(F.sequence(F.lit(0), (blocks - 1).cast("int"))))
    return rest.select("key", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"), "block", "id", "c")


def _main_blocks(split: DataFrame) -> DataFrame:
    """Blocks that hold each main component against all members that meet it, once for all their buckets.

    They are keyed by the component; ``i`` is negative, so none is taken for a bucket's.
    """
    sides = split.select(F.col("main").alias("key"), "id", "c", (F.col("c") != F.col("main")).alias("out")).distinct()
    sizes = sides.groupBy("key").agg(*(F.ceil(F.count(F.when(F.col("out") == out, 1)) / BLOCK).alias(n) for n, out in (("ins", False), ("outs", True))))
    sides = sides.join(sizes, "key").withColumn("own", _block(F.when(F.col("out"), F.col("outs")).otherwise(F.col("ins"))))
    sides = sides.withColumn("with", F.explode(F.sequence(F.lit(0), (F.when(F.col("out"), F.col("ins")).otherwise(F.col("outs")) - 1).cast("int"))))
    pair = lambda x, y: F.when(F.col("out"), F.col(x)).otherwise(F.col(y))
    return sides.select("key", (-1 - pair("own", "with")).alias("i"), pair("with", "own").alias("j"), F.col("out").cast("int").alias("block"), "id", "c")


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """id, n_shingles and component of every row of ``docs`` (doc_id, text).

    Words are runs of anything but white space, A-Z lower-cased; a text of
    fewer than ``shingle`` words is one shingle.  Two documents are linked when
    the Jaccard similarity of their sets is ``percent`` hundredths or more, and
    a component is named by its smallest id.  A text without words, or null, has
    no shingles and links with nothing.  Sets are held as 64-bit hashes of their
    shingles, and taken for equal by 128 bits of a digest.  A row without id has a null component.
    Rows that repeat an id are one document, linked if any of them is.  An empty
    table gives an empty result.

    Equal sets are first put into one class, of which only the smallest id goes
    on.  In a bucket, every member is held against the smallest and the largest
    id there, so a bucket of any size gives as many pairs as it has members.
    Where members of a bucket are then still in different components, one component
    is the bucket's main one.  The others' members there are held against one
    another, and against the main component's members of all such buckets once,
    not bucket by bucket.  Both go in blocks of ``BLOCK`` members a side, so that no
    link is lost; a block gives no more rows than it has members.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text")
    described = staged(texts.mapInArrow(_describe(shingle, bands, rows), "id long, n long, p long, q long, keys array<long>"), "sketches")
    held = described.filter("id IS NOT NULL AND n > 0")
    classes = held.groupBy("p", "q", "n").agg(F.min("id").alias("rep"), F.max("id").alias("other"))
    copies = staged(classes.filter("rep < other").select("p", "q", "n", "rep"), "classes")
    # all but the first of equal sets step back; the join meets copies only, and as classes are staged a large one can be split
    again = staged(held.select("id", "p", "q", "n").join(few(copies), ["p", "q", "n"]).filter("id > rep").select("id", "rep"), "copies")
    unstage(copies)
    firsts = held.join(few(again.select("id")), "id", "left_anti")
    members = firsts.select("id", "n", F.explode("keys").alias("key"))
    ends = staged(members.groupBy("key").agg(F.min(F.struct("id", "n")).alias("low"), F.max(F.struct("id", "n")).alias("high")).filter("low.id < high.id"), "ends")
    met = staged(members.join(ends, "key").select("key", "id", "n", "low", "high"), "buckets")
    unstage(ends)

    small, big = lambda x, y: F.least(x, y) * 100, lambda x, y: F.greatest(x, y) * percent
    near = lambda x, y: small(x, y) >= big(x, y)
    ordered = lambda df, x, y: df.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).filter("a < b").distinct()
    candidates = ordered(
        met.filter(near("n", "low.n")).select("id", F.col("low.id").alias("to")).unionByName(met.filter(near("n", "high.n")).select("id", F.col("high.id").alias("to"))), "id", "to"
    )
    candidates = staged(candidates, "pairs")
    links = _verified(candidates, texts, shingle, percent)
    unstage(candidates)
    found = components(links)
    unstage(links)

    placed = met.select("key", "id").join(found, "id", "left").select("key", "id", F.coalesce("component", "id").alias("c"))
    shares = placed.groupBy("key", "c").agg(F.count("*").alias("m"))
    apart = shares.groupBy("key").agg(F.max_by("c", F.struct("m", "c")).alias("main"), F.sum("m").alias("m"), F.max("m").alias("most"), F.count("*").alias("parts")).filter("parts > 1")
    split = staged(placed.join(apart.select("key", "main", (F.col("m") - F.col("most")).alias("rest")), "key"), "split")
    if not split.isEmpty():
        sets = _shingle_sets(texts.join(few(split.select("id").distinct()), "id", "left_semi"), shingle)
        blocks = _rest_blocks(split).unionByName(_main_blocks(split)).join(sets, "id").select("key", "i", "j", "block", "id", "c", "shingles")
        blocks = blocks.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
        more = staged(blocks.mapInArrow(_compare(percent), "a long, b long"), "links")
        if not more.isEmpty():
            found = components(more.unionByName(found.select(F.col("id").alias("a"), F.col("component").alias("b"))))
        unstage(more)
    unstage(split)
    unstage(met)
    whole = again.withColumnRenamed("id", "a").select("a", F.col("rep").alias("b")).join(found.withColumnRenamed("id", "b"), "b", "left").select(F.col("a").alias("id"), F.coalesce("component", "b").alias("component"))
    named = found.unionByName(whole).groupBy("id").agg(F.min("component").alias("component"))
    return described.select("id", F.col("n").alias("n_shingles")).join(named, "id", "left").select("id", "n_shingles", F.coalesce("component", "id").alias("component"))


def drop_near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without the documents of a component that are not its smallest id.

    Rows without id stay; rows that repeat an id stay or go together.
    """
    gone = near_duplicates(docs, shingle, percent).filter("id <> component").select(F.col("id").alias("doc_id")).distinct()
    gone = staged(gone, "gone")
    return docs.join(few(gone), "doc_id", "left_anti").select(*docs.columns)


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the size of its set of two-word shingles and its component."""
    found = near_duplicates(table(spark, sf_dir, "documents"), shingle=2)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"), F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"))


OP2_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]] ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM w),
e AS (SELECT doc_id, unnest(s) AS g FROM s),
shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM e x JOIN e y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
link AS (
  SELECT a, b FROM shared JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b WHERE 100 * n >= 80 * (len(x.s) + len(y.s) - n)),
both_ways AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (
  SELECT doc_id, doc_id AS r FROM documents
  UNION SELECT reach.doc_id, both_ways.b FROM reach JOIN both_ways ON reach.r = both_ways.a)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, min(r) AS component_id, s.doc_id = min(r) AS kept
FROM s JOIN reach ON reach.doc_id = s.doc_id GROUP BY s.doc_id, s.s
"""
