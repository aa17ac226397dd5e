"""Removal of long word sequences that repeat across documents, by de Bruijn compaction.

A window of ``window`` words is an edge from the node of its first words to the
node of its last ones, the word sequences one shorter.  Edges are first grouped
by their anchor, the least hash among their ``anchor``-word sequences: equal
edges have equal anchors, and runs of edges in a document share one.  Only edges
whose anchor occurs in two documents can repeat, so only those are keyed one by
one; the graph is made of the repeated ones, each with the coordinates of its
first occurrence.  A node with one edge in and one out, whose coordinates go on,
does not branch: its edges are of one path.  Paths are compacted by joins, first
within blocks of 64 coordinates and then across blocks by pointer doubling.
What a document has of a path in one go is a span, and every span is held
against the words at its source coordinates.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import fresh, staged, table, unstage
from .near_duplicates import few
from .words import Words, grams, mix, slices

WINDOW, ANCHOR = 13, 5
#: Up to so many keys (some 60 bytes each) go to all executors; more are joined by a shuffle.
BROADCAST_KEYS = 200_000
_BASE = 0x9FB21C651E98DF25


class _Edges:
    """Windows of the rows of one slice: where they start, their row, anchor and hash."""

    def __init__(self, text: pa.Array, window: int, anchor: int) -> None:
        self.words = w = Words(text)
        self.hash = w.hashes()
        row = w.row_of_word()
        self.at = np.flatnonzero(np.arange(len(row)) + window <= w.first[1:][row])
        self.row = row[self.at]
        a = grams(self.hash, anchor)
        least = a.copy()
        for j in range(1, window - anchor + 1):
            np.minimum(least[:-j], a[j:], out=least[:-j])
        self.anchor = least[self.at]
        self.place = self.at - w.first[self.row]


def _runs(window: int, anchor: int):
    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False)
            for s, e in slices(b.column(1)):
                x = _Edges(b.column(1).slice(s, e - s), window, anchor)
                new = np.ones(len(x.row), bool)
                new[1:] = (x.row[1:] != x.row[:-1]) | (x.anchor[1:] != x.anchor[:-1])
                first = np.flatnonzero(new)
                size = np.diff(np.append(first, len(new)))
                columns = [x.anchor[first].view(np.int64), ids[s:e][x.row[first]], x.place[first].astype(np.int32), size.astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["anchor", "id", "start", "size"])

    return runs


def _edges(window: int, anchor: int):
    """Edges of the listed runs: two independent hashes (64 and 16 bits), id, place, and the nodes they lead from and to."""

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False)
            for s, e in slices(b.column(1)):
                w = Words(b.column(1).slice(s, e - s))
                h = w.hashes()
                runs = b.column(2).slice(s, e - s)
                row = np.repeat(np.arange(e - s), runs.value_lengths().to_numpy(zero_copy_only=False))
                flat = runs.flatten()
                start, size = (flat.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(2))
                place = np.repeat(start - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
                row = np.repeat(row, size)
                inside = place + window <= w.counts()[row]
                place, row = place[inside], row[inside]
                at = w.first[row] + place
                node = grams(h, window - 1)
                more = grams(mix(h, 5), window, 17)[at] >> np.uint64(48)
                key = mix(node[at] ^ mix(h[at + window - 1], 41), 42)
                columns = [key.view(np.int64), more.astype(np.int32), ids[s:e][row], place.astype(np.int32), node[at].view(np.int64), node[at + 1].view(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "more", "id", "place", "tail", "head"])

    return edges


def _digests(b: pa.RecordBatch) -> Iterator[tuple[int, int, Words, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each slice of (id, text, spans): words, and row, start, size (in words) and digest of its spans."""
    for s, e in slices(b.column(1)):
        w = Words(b.column(1).slice(s, e - s))
        spans = b.column(2).slice(s, e - s)
        size = pc.fill_null(spans.value_lengths(), 0).to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(e - s), size)
        flat = spans.flatten()
        start, n = (flat.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(2))
        ends = np.minimum(start + n, w.counts()[row])
        power, back = (np.multiply.accumulate(np.concatenate((np.ones(1, np.uint64), np.full(len(w.start), x, np.uint64)))) for x in (_BASE, pow(_BASE, -1, 1 << 64)))
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(w.hashes(3), 31) * power[:-1])))
        low, high = w.first[row] + start, w.first[row] + ends
        # a polynomial of the span's words, shifted back to begin at power 0
        digest = (total[high] - total[low]) * back[low]
        yield s, e, w, row, start, n, digest, flat


def _paths(source: DataFrame) -> DataFrame:
    """source_id, low, high and path: the compacted paths of the graph of ``source``, in pieces of a block of 64 places each.

    ``source`` has an edge a row: source_id, source_place, tail and head.  A path
    is named by its first place; all its edges follow one another at the source.
    """
    at = F.struct("source_id", "source_place")
    out = source.select(F.col("tail").alias("node"), at.alias("goes"), F.lit(None).cast("struct<source_id:bigint,source_place:int>").alias("comes"))
    in_ = source.select(F.col("head").alias("node"), F.lit(None).cast("struct<source_id:bigint,source_place:int>").alias("goes"), at.alias("comes"))
    nodes = out.unionByName(in_).groupBy("node").agg(F.count("goes").alias("n_out"), F.count("comes").alias("n_in"), F.max("goes").alias("goes"), F.max("comes").alias("comes"))
    simple = nodes.filter("n_out = 1 AND n_in = 1 AND goes.source_id = comes.source_id AND goes.source_place = comes.source_place + 1")

    bit = lambda c: F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(c, F.lit(64)).cast("int"))
    none = F.lit(0).cast("long")
    edges = source.select("source_id", "source_place", bit(F.col("source_place")).alias("edges"), none.alias("links"))
    links = simple.select("comes.source_id", "comes.source_place", none.alias("edges"), bit(F.col("comes.source_place")).alias("links"))
    blocks = edges.unionByName(links).groupBy("source_id", F.floor(F.col("source_place") / 64).cast("int").alias("block")).agg(F.bit_or("edges").alias("edges"), F.bit_or("links").alias("links"))
    places = F.sequence(F.lit(0), F.lit(63))
    is_ = lambda mask, i: F.getbit(mask, i) == 1
    lows = F.filter(places, lambda i: is_(F.col("edges"), i) & ((i == 0) | ~is_(F.col("links"), F.greatest(i - 1, F.lit(0)))))
    highs = F.filter(places, lambda i: is_(F.col("edges"), i) & ((i == 63) | ~is_(F.col("links"), i)))
    pieces = blocks.select("source_id", "block", (F.getbit("links", F.lit(63)) == 1).alias("last_goes_on"), F.explode(F.arrays_zip(lows.alias("low"), highs.alias("high"))).alias("x"))
    first = F.col("block") * 64
    pieces = pieces.select("source_id", (first + F.col("x.low")).alias("low"), (first + F.col("x.high")).alias("high"), (F.col("last_goes_on") & (F.col("x.high") == 63)).alias("goes_on"))
    pieces = staged(pieces, "pieces")

    before = pieces.filter("goes_on").select("source_id", (F.col("high") + 1).alias("low"), F.col("low").alias("path"))
    at_edge = pieces.filter("low % 64 = 0").join(before, ["source_id", "low"], "left").select("source_id", "low", "high", F.coalesce("path", "low").alias("path"), F.col("path").isNotNull().alias("open"))
    inner = pieces.filter("low % 64 <> 0").select("source_id", "low", "high", F.col("low").alias("path"))
    at_edge = staged(at_edge, "paths")
    while not at_edge.filter("open").isEmpty():  # each round doubles the way back to the first piece
        ahead = at_edge.unionByName(inner.withColumn("open", F.lit(False))).select("source_id", F.col("low").alias("path"), F.col("path").alias("further"), F.col("open").alias("still"))
        moved = at_edge.filter("open").join(ahead, ["source_id", "path"]).select("source_id", "low", "high", F.col("further").alias("path"), F.col("still").alias("open"))
        now = staged(moved.unionByName(at_edge.filter("NOT open")), "paths")
        unstage(at_edge)
        at_edge = now
    out = staged(at_edge.drop("open").unionByName(inner), "compacted")
    unstage(at_edge)
    unstage(pieces)
    return out


def repeated_spans(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> tuple[DataFrame, DataFrame]:
    """Copies, and spans of repeated words, of ``docs`` (doc_id, text).

    Copies are the ids whose whole text a smaller id has.  For all others a row
    of spans is doc_id, start and size (in words), source_id and source_start:
    ``size`` words that stand at the source too, which has a smaller id.  A row
    without id or with fewer than ``window`` words neither has spans nor is a
    source.  Both tables are staged.

    Rows that repeat an id count as one document; what they have, or give to
    others, stays in spans of one window each, as they share their places.

    What a join looks up is staged before it, so that the join's other side can
    be split where a key is hot; small tables go to all executors.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text").filter("id IS NOT NULL AND text IS NOT NULL")
    same = staged(texts.select("id", F.md5(F.col("text").cast("binary")).alias("m")), "texts")
    twice = staged(same.groupBy("id").count().filter("count > 1").select("id"), "twice")
    repeated_ids = not twice.isEmpty()
    groups = staged(same.groupBy("m").agg(F.min("id").alias("low"), F.max("id").alias("high")).filter("low < high").drop("high"), "groups")
    copies = staged(same.join(few(groups, BROADCAST_KEYS), "m").filter("id > low").select("id"), "copies")
    if repeated_ids:
        once = staged(copies.distinct(), "copies")
        unstage(copies)
        copies = once
    unstage(groups)
    unstage(same)
    firsts = texts.join(few(copies), "id", "left_anti").select("id", "text")

    runs = staged(firsts.mapInArrow(_runs(window, anchor), "anchor long, id long, start int, size int"), "runs")
    shared = staged(runs.groupBy("anchor").agg(F.min("id").alias("low"), F.max("id").alias("high")).filter("low < high").select("anchor"), "anchors")
    kept = staged(runs.join(few(shared, BROADCAST_KEYS), "anchor", "left_semi").drop("anchor"), "kept")
    unstage(runs)
    unstage(shared)
    alive = staged(kept.groupBy("id").agg(F.collect_list(F.struct("start", "size")).alias("runs")), "alive")
    unstage(kept)
    edges = staged(firsts.join(alive, "id").select("id", "text", "runs").mapInArrow(_edges(window, anchor), "key long, more int, id long, place int, tail long, head long"), "edges")
    unstage(alive)
    least = F.min(F.struct("id", "place", "tail", "head")).alias("x")
    source = edges.groupBy("key", "more").agg(least, F.max("id").alias("high")).filter("x.id < high")
    source = staged(source.select("key", "more", F.col("x.id").alias("source_id"), F.col("x.place").alias("source_place"), "x.tail", "x.head"), "source")
    paths = _paths(source)
    block = lambda c: F.floor(F.col(c) / 64)
    placed = source.withColumn("block", block("source_place")).join(paths.withColumn("block", block("low")), ["source_id", "block"]).filter("source_place BETWEEN low AND high")
    placed = staged(placed.select("key", "more", "source_id", "source_place", "path"), "placed")
    unstage(source)
    unstage(paths)
    hits = edges.select("key", "more", "id", "place").join(few(placed, BROADCAST_KEYS), ["key", "more"]).filter("id > source_id").select("id", "place", "source_id", "source_place", "path")
    hits = staged(hits, "hits")
    unstage(edges)
    unstage(placed)
    alone = None
    if repeated_ids:  # rows of one id share its places, so what they have stays in single windows
        again = hits.distinct()
        for c in ("id", "source_id"):
            again = again.join(few(twice.select(F.col("id").alias(c), F.lit(True).alias(f"{c}_twice"))), c, "left")
        again = staged(again.withColumn("twice", F.col("id_twice").isNotNull() | F.col("source_id_twice").isNotNull()).select(*hits.columns, "twice"), "hits")
        unstage(hits)
        alone = again.filter("twice").select("id", "source_id", F.col("place").alias("start"), F.lit(window).alias("size"), F.col("source_place").alias("source_start"))
        hits = again.filter("NOT twice").drop("twice")
    # what a document has of a path, at one distance from it, is one span unless words are left out
    by = ["id", "source_id", "path", "apart"]
    met = hits.withColumn("apart", F.col("place") - F.col("source_place")).groupBy(by).agg(F.min("place").alias("start"), F.max("place").alias("end"), F.count(F.lit(1)).alias("n"))
    met = staged(met, "met")
    size = lambda n: (n + window - 1).cast("int").alias("size")
    whole = met.filter("n = end - start + 1").select("id", "source_id", "start", size(F.col("n")), (F.col("start") - F.col("apart")).alias("source_start"))
    gaps = met.filter("n <> end - start + 1").select(*by)
    parted = hits.withColumn("apart", F.col("place") - F.col("source_place")).join(few(gaps, BROADCAST_KEYS), by, "left_semi")
    island = F.col("place") - F.row_number().over(Window.partitionBy(*by).orderBy("place"))  # the places of one document on one path
    parts = parted.withColumn("island", island).groupBy(*by, "island").agg(F.min("place").alias("start"), F.count(F.lit(1)).alias("n"))
    spans = whole.unionByName(parts.select("id", "source_id", "start", size(F.col("n")), (F.col("start") - F.col("apart")).alias("source_start")))
    spans = staged(spans if alone is None else spans.unionByName(alone), "spans")
    unstage(hits)
    unstage(twice)
    unstage(met)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s, e, _, row, start, n, digest, _ in _digests(b):
                yield pa.RecordBatch.from_arrays([b.column(0).slice(s, e - s).take(pa.array(row)), pa.array(start.astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(digest.view(np.int64))], ["source_id", "source_start", "size", "digest"])

    wanted = spans.select("source_id", "source_start", "size").distinct().groupBy(F.col("source_id").alias("id")).agg(F.collect_list(F.struct("source_start", "size")).alias("spans"))
    at_source = firsts.join(wanted, "id").select("id", "text", "spans").mapInArrow(digests, "source_id long, source_start int, size int, digest long")
    keys = ["source_id", "source_start", "size"]
    at_source = staged(at_source.distinct() if repeated_ids else at_source, "digests")
    checked = staged(spans.join(few(at_source, BROADCAST_KEYS), keys), "checked")
    unstage(spans)
    unstage(at_source)
    return copies.withColumnRenamed("id", "doc_id"), checked.withColumnRenamed("id", "doc_id")


def drop_repeats(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """``docs`` with text stripped of repeated words, and n_words and n_removed.

    A word goes when a window of ``window`` words covers it whose word sequence
    also starts in a document of a smaller id; windows are those of the input.
    Words are runs of anything but white space, and the words kept are joined by
    one space.  A null text has no words and becomes empty; a row without id
    loses nothing.  Rows that repeat an id count as one document.  Columns named
    n_words or n_removed are replaced.  An empty table gives an empty result.
    """
    copies, spans = repeated_spans(docs, window, anchor)
    held = docs.drop("n_words", "n_removed")
    found_, copy_, cut_ = fresh(held, "spans", "copy", "cut")
    lists = spans.groupBy("doc_id").agg(F.collect_list(F.struct("start", "size", "digest")).alias(found_))

    @F.arrow_udf("struct<text:string,n_words:bigint,n_removed:bigint>")
    def cut(text: pa.Array, found: pa.Array, copy: pa.Array) -> pa.Array:
        out, all_words, removed = [], [], []
        batch = pa.RecordBatch.from_arrays([copy, text, found], ["copy", "text", "spans"])
        for s, e, w, row, start, n, digest, flat in _digests(batch):
            true = np.flatnonzero(digest.view(np.int64) == flat.field(2).to_numpy(zero_copy_only=False))
            change = np.zeros(len(w.start) + 1, np.int64)
            np.add.at(change, w.first[row[true]] + start[true], 1)
            np.add.at(change, w.first[row[true]] + start[true] + n[true], -1)
            kept = np.cumsum(change)[:-1] == 0
            counts = w.counts()
            for r in np.flatnonzero(copy.slice(s, e - s).to_numpy(zero_copy_only=False)):
                if counts[r] >= window:
                    kept[w.first[r] : w.first[r + 1]] = False
            gone = counts - np.add.reduceat(np.append(kept, 0), w.first[:-1]) * (counts > 0)
            for r in range(e - s):
                parts = (text[s + r].as_py() or "").encode().split()
                out.append(b" ".join(compress(parts, kept[w.first[r] : w.first[r + 1]]) if gone[r] else parts).decode())
            all_words.append(counts)
            removed.append(gone)
        cat = lambda x: pa.array(np.concatenate([np.zeros(0, np.int64), *x]).astype(np.int64))
        return pa.StructArray.from_arrays([pa.array(out, pa.string()), cat(all_words), cat(removed)], ["text", "n_words", "n_removed"])

    marked = held.join(few(copies.withColumn(copy_, F.lit(True))), "doc_id", "left").join(lists, "doc_id", "left")
    done = marked.withColumn(cut_, cut("text", found_, F.coalesce(copy_, F.lit(False))))
    return done.select(*[F.col(f"{cut_}.text").alias("text") if c == "text" else F.col(f"`{c}`") for c in held.columns], f"{cut_}.n_words", f"{cut_}.n_removed")


def op8_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document when 13-word repeats are removed."""
    left = drop_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


OP8_SQL = """
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
g AS (
  SELECT doc_id, unnest(range(1, len(w) - 11)) AS i, w FROM w WHERE len(w) >= 13),
h AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS g FROM g),
lows AS (SELECT g, min(doc_id) AS low FROM h GROUP BY g),
hit AS (SELECT h.doc_id, h.i FROM h JOIN lows ON h.g = lows.g WHERE low < h.doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM hit),
lists AS (SELECT doc_id, list(i) AS gone FROM gone GROUP BY doc_id)
SELECT w.doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
  sha256(array_to_string(CASE WHEN gone IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(gone, i)) END, ' ')) AS kept_sha256
FROM w LEFT JOIN lists ON lists.doc_id = w.doc_id
"""
