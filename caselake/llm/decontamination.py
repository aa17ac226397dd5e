"""Benchmark decontamination by SimHash over item-sized windows.

Every item of the benchmark has its own window size, its number of words.  A
window of a document is a candidate for the items of its size whose 64-bit
SimHash lies within ``radius``; eight blocks of eight bits find all of those,
as one block at least differs in no more than radius // 8 bits: for each block,
items are listed under every value that near to their own, and a window looks
up its value.  Candidates are then held against the item by the weighted
similarity of their shingles.

A window without a single shingle of an item cannot be similar to it, so
windows are laid only where a document has a shingle of the benchmark.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh, staged, table, unstage
from .words import LETTERS, Words, grams, mix, slices

#: Most characters of benchmark text that one index holds (about as many bytes in each worker, times fifteen).
INDEX_CHARS = 4_000_000
#: So many shingles of windows, and pairs of windows and items, are looked at together.
STEP = 100_000
_BITS = np.array([bin(i).count("1") for i in range(256)], dtype=np.uint8)
LEAKS = "array<struct<item_id:bigint,start_word:int,n_words:int,similarity:double>>"


class _Items:
    """The items of one index: sizes, shingles with weights, fingerprints, blocks."""

    def __init__(self, ids: list[int], texts: list[str], shingle: int, threshold: float, radius: int, whole: tuple[int, np.ndarray, np.ndarray] | None = None) -> None:
        """``whole``: of a benchmark in several indexes, the number of items, and the shingles of two items or more with their frequencies."""
        w = Words(pa.array(texts, pa.large_string()), lower=True, classes=LETTERS)
        size = w.counts()
        held = np.flatnonzero(size)
        self.k, self.threshold, self.radius = shingle, threshold, radius
        self.item_id = np.array(ids, np.int64)[held]
        self.size = size[held]
        h = w.hashes()
        lists = [_shingles(h[w.first[i] : w.first[i + 1]], shingle) for i in held]
        self.n_shingles = np.array([len(x) for x in lists], np.int64)
        flat = np.concatenate([np.zeros(0, np.uint64), *lists])
        owner = np.repeat(np.arange(len(held)), self.n_shingles)
        self.shingle, sid = np.unique(flat, return_inverse=True)
        pair, count = np.unique(owner * max(len(self.shingle), 1) + sid, return_counts=True)
        n = len(self.shingle)
        item, kind = pair // max(n, 1), pair % max(n, 1)
        df = np.bincount(kind, minlength=n)
        n_items, self.common, common_df = (len(held), np.zeros(0, np.uint64), np.zeros(0, np.int64)) if whole is None else whole
        if whole is not None:
            at = _places(self.common, self.shingle)
            df = np.where(at >= 0, common_df[at] if len(common_df) else 1, 1)
        #: rare shingles weigh more; what is in no item weighs most, as much as what is in one
        self.weight = np.log1p(n_items / np.maximum(df, 1))
        self.common_weight = np.log1p(n_items / np.maximum(common_df, 1))
        self.other = float(np.log1p(n_items))
        self.key, self.count = pair, count
        self.total = np.bincount(item, count * self.weight[kind], len(held))
        order = np.argsort(kind, kind="stable")
        self.with_shingle, self.first_with = item[order], np.searchsorted(kind[order], np.arange(n + 1))
        #: the different sizes of the items that have a shingle
        sized = np.unique(kind * (int(self.size.max(initial=0)) + 1) + self.size[item])
        self.size_with, self.first_size = sized % (int(self.size.max(initial=0)) + 1), np.searchsorted(sized // (int(self.size.max(initial=0)) + 1), np.arange(n + 1))
        self.seen = np.zeros(1 << 20, bool)
        self.seen[(self.shingle & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
        self.print = _fingerprints(flat, self.weight[sid], np.concatenate(([0], np.cumsum(self.n_shingles)))[:-1])
        self.by_size = {int(s): np.flatnonzero(self.size == s) for s in np.unique(self.size)}
        self.blocks = {s: [_block(self.print[which, b], which, radius // 8) for b in range(8)] for s, which in self.by_size.items()}

    def sids(self, g: np.ndarray) -> np.ndarray:
        """Each hash's number among the benchmark's shingles, or -1."""
        out = np.full(len(g), -1, np.int64)
        maybe = np.flatnonzero(self.seen[(g & np.uint64((1 << 20) - 1)).astype(np.int64)])
        out[maybe] = _places(self.shingle, g[maybe])
        return out

    def weights(self, g: np.ndarray, kind: np.ndarray) -> np.ndarray:
        """The weight of each hash in the whole benchmark; ``kind`` is its number here, or -1."""
        out = np.where(kind >= 0, self.weight[kind] if len(self.weight) else 0.0, self.other)
        if len(self.common):
            away = np.flatnonzero(kind < 0)
            at = _places(self.common, g[away])
            out[away[at >= 0]] = self.common_weight[at[at >= 0]]
        return out


def _block(values: np.ndarray, items: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """The items under each of 256 values that differs from their own in ``reach`` bits at most, and where each value's begin."""
    near = np.flatnonzero(_BITS[np.arange(256)] <= reach)
    value = (values[:, None] ^ near[None, :].astype(np.uint8)).ravel()
    order = np.argsort(value, kind="stable")
    return np.repeat(items, len(near))[order].astype(np.int32), np.searchsorted(value[order], np.arange(257))


def _places(known: np.ndarray, g: np.ndarray) -> np.ndarray:
    """The place of each hash in the sorted ``known``, or -1."""
    if not len(known):
        return np.full(len(g), -1, np.int64)
    at = np.minimum(np.searchsorted(known, g), len(known) - 1)
    return np.where(known[at] == g, at, -1)


def _shingles(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k-word shingles of one word sequence; a shorter sequence is one shingle."""
    if len(h) == 0:
        return np.zeros(0, np.uint64)
    return grams(h, k)[: len(h) - k + 1] if len(h) >= k else grams(h, len(h))[:1]


def _fingerprints(g: np.ndarray, weight: np.ndarray, first: np.ndarray) -> np.ndarray:
    """SimHash, as 8 bytes a row, of the runs of shingles that begin at ``first``."""
    if not len(first):
        return np.zeros((0, 8), np.uint8)
    sign = np.unpackbits(mix(g, 99).view(np.uint8).reshape(-1, 8), axis=1).astype(np.float32) * 2 - 1
    return np.packbits(np.add.reduceat(sign * weight[:, None].astype(np.float32), first, axis=0) > 0, axis=1)


def _ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first[0], first[0]+1, ... of size[0], then the next."""
    return np.repeat(first - np.cumsum(size) + size, size) + np.arange(int(size.sum()))


def _matches(text: pa.Array, items: _Items) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of one slice: row, item number, start word, words and similarity of the best matching window of each row and item."""
    w = Words(text, lower=True, classes=LETTERS)
    h, words, row = w.hashes(), w.counts(), w.row_of_word()
    g = grams(h, items.k)
    last = w.first[1:] - items.k  # the last word of a row that begins a shingle
    sid = items.sids(g)
    sid[np.arange(len(h)) > last[row]] = -1
    found = [[np.zeros(0, np.int64)] * 4 + [np.zeros(0)]]
    for n in (n for n in items.by_size if n < items.k):  # such an item is one shingle, and so is a window of its size
        short = items.sids(grams(h, n))
        short[np.arange(len(h)) > w.first[1:][row] - n] = -1
        hit = np.flatnonzero(short >= 0)
        _, once = np.unique(row[hit] * (len(items.shingle) + 1) + short[hit], return_index=True)  # the first of equal ones in a row
        hit = hit[once]
        n_with = items.first_with[short[hit] + 1] - items.first_with[short[hit]]
        place, item = np.repeat(hit, n_with), items.with_shingle[_ranges(items.first_with[short[hit]], n_with)]
        found.append([row[place], item, place - w.first[row[place]], np.full(len(place), n), np.ones(len(place))])
    hit = np.flatnonzero(sid >= 0)
    n_with = items.first_size[sid[hit] + 1] - items.first_size[sid[hit]]
    bounds = np.searchsorted(np.cumsum(n_with), np.arange(0, int(n_with.sum()) + STEP, STEP))
    for s, e in zip(bounds[:-1], np.append(bounds[1:-1], len(hit))):  # windows of some hits; those of neighbours may come twice
        start, size = _windows(hit[s:e], n_with[s:e], sid, row, w, items)
        span = np.maximum(size - items.k + 1, 1)
        steps = np.searchsorted(np.cumsum(span), np.arange(0, int(span.sum()) + STEP, STEP))
        for a, z in zip(steps[:-1], np.append(steps[1:-1], len(start))):
            if z > a:
                found.append(_verified(w, g, sid, row, start[a:z], size[a:z], span[a:z], items))
        found = [_best(*(np.concatenate(x) for x in zip(*found)))]
    return _best(*(np.concatenate(x) for x in zip(*found)))


def _best(row: np.ndarray, number: np.ndarray, start: np.ndarray, size: np.ndarray, similarity: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of the windows of each row and item the most similar, of equal ones the first."""
    order = np.lexsort((start, -similarity, number, row))
    row, number, start, size, similarity = (x[order] for x in (row, number, start, size, similarity))
    best = np.ones(len(row), bool)
    best[1:] = (row[1:] != row[:-1]) | (number[1:] != number[:-1])
    return row[best], number[best], start[best], size[best], similarity[best]


def _windows(hit: np.ndarray, n_with: np.ndarray, sid: np.ndarray, row: np.ndarray, w: Words, items: _Items) -> tuple[np.ndarray, np.ndarray]:
    """Start and size of the windows that hold a shingle at one of ``hit``, for each size of the items that have it."""
    at, size = np.repeat(hit, n_with), items.size_with[_ranges(items.first_size[sid[hit]], n_with)]
    r = row[at]
    size = np.minimum(size, w.counts()[r])
    order = np.lexsort((at, size, r))
    at, size, r = at[order], size[order], r[order]
    span = np.maximum(size - items.k + 1, 1)  # shingles in a window
    low, high = np.maximum(at - span + 1, w.first[r]), np.minimum(at, w.first[r + 1] - size)
    again = np.zeros(len(at), bool)
    again[1:] = (r[1:] == r[:-1]) & (size[1:] == size[:-1])
    low[1:] = np.where(again[1:], np.maximum(low[1:], high[:-1] + 1), low[1:])
    n_starts = np.maximum(high - low + 1, 0)
    return _ranges(low, n_starts), np.repeat(size, n_starts)


def _verified(w: Words, g: np.ndarray, sid: np.ndarray, row: np.ndarray, start: np.ndarray, size: np.ndarray, span: np.ndarray, items: _Items) -> list[np.ndarray]:
    first = np.cumsum(span) - span
    at = _ranges(start, span)
    kind = sid[at]
    weight = items.weights(g[at], kind)
    prints = _fingerprints(g[at], weight, first)
    total = np.add.reduceat(weight, first)
    windows, numbers = [], []
    words = w.counts()[row[start]]
    for n, blocks in items.blocks.items():
        mine = np.flatnonzero((size == n) | ((size == words) & (size < n)))  # a text shorter than the item is one window
        step = max(1, STEP // max(1, len(items.by_size[n])))
        for low in range(0, len(mine), step):
            some = mine[low : low + step]
            pairs = [np.zeros(0, np.int64)]
            for b, (listed, first_of) in enumerate(blocks):
                value = prints[some, b].astype(np.int64)
                count = first_of[value + 1] - first_of[value]
                pairs.append(np.repeat(some, count) * len(items.size) + listed[_ranges(first_of[value], count)])
            pair = np.unique(np.concatenate(pairs))
            i, j = pair // max(len(items.size), 1), pair % max(len(items.size), 1)
            close = _BITS[prints[i] ^ items.print[j]].sum(1) <= items.radius
            windows.append(i[close])
            numbers.append(j[close])
    window = np.concatenate([np.zeros(0, np.int64), *windows])
    number = np.concatenate([np.zeros(0, np.int64), *numbers])
    n = max(len(items.shingle), 1)
    pair, where = np.repeat(np.arange(len(window)), span[window]), _ranges(first[window], span[window])
    ours = kind[where] >= 0
    key, count = np.unique(pair[ours] * n + kind[where][ours], return_counts=True)
    pair, k = key // n, key % n
    theirs = number[pair] * n + k
    slot = np.minimum(np.searchsorted(items.key, theirs), max(len(items.key) - 1, 0))
    both = np.minimum(count, np.where(items.key[slot] == theirs, items.count[slot], 0)) if len(items.key) else np.zeros(0)
    shared = np.bincount(pair, both * items.weight[k] if len(items.weight) else both, len(window))
    similarity = shared / (total[window] + items.total[number] - shared)
    ok = similarity >= items.threshold - 1e-12
    window, number = window[ok], number[ok]
    return [row[start[window]], number, start[window] - w.first[row[start[window]]], size[window], similarity[ok]]


def _index(items: list[tuple[int, str]], *options) -> _Items:
    return _Items([r[0] for r in items], [r[1] for r in items], *options)


def _frequencies(known: DataFrame, shingle: int) -> tuple[int, np.ndarray, np.ndarray]:
    """The number of items with words, and the sorted shingles that two items or more have, with the number of those."""

    @F.arrow_udf("array<bigint>")
    def distinct(text: pa.Array) -> pa.Array:
        out = []
        for s, e in slices(text):
            w = Words(text.slice(s, e - s), lower=True, classes=LETTERS)
            h = w.hashes()
            out += [np.unique(_shingles(h[w.first[i] : w.first[i + 1]], shingle)).view(np.int64) for i in range(e - s)]
        return pa.array(out, pa.list_(pa.int64()))

    lists = known.select(distinct("text").alias("shingles"))
    often = lists.select(F.explode("shingles").alias("shingle")).groupBy("shingle").agg(F.count(F.lit(1)).alias("df")).filter("df > 1").toArrow()
    hashes = often["shingle"].to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return lists.filter(F.size("shingles") > 0).count(), hashes[order], often["df"].to_numpy().astype(np.int64)[order]


def _told(docs: DataFrame, name: str, benchmark: DataFrame, shingle: int = 5, threshold: float = 0.8, radius: int = 22, index_chars: int = INDEX_CHARS) -> DataFrame:
    """``docs`` with a column ``name``: for each similar item of ``benchmark`` (item_id, text) the best window of text.

    A benchmark of several indexes goes through one after the other, with the
    result so far staged in between, so that no worker holds two of them.
    """
    known = benchmark.filter(F.col("item_id").isNotNull() & F.col("text").isNotNull()).select(F.col("item_id").cast("long"), "text")
    chars = known.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = -(-chars // index_chars)
    whole = _frequencies(known, shingle) if parts > 1 else None
    out = docs.withColumn(name, F.array().cast(LEAKS)) if parts == 0 else docs
    for p in range(parts):
        part = known.filter(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == p) if parts > 1 else known
        rows = part.toArrow()
        items = sorted(zip(rows["item_id"].to_pylist(), rows["text"].to_pylist()))
        found = _leaks_udf(_index(items, shingle, threshold, radius, whole))(F.col("text"))
        before, out = out, out.withColumn(name, F.concat(name, found) if p else found)
        if parts > 1:
            out = staged(out, "leaks")
            if p:
                unstage(before)
    return out


def find_leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` with a column leaks: for each similar item of ``benchmark`` (item_id, text) the best window of text.

    A leak is an item with a window of as many words (the whole text, if that is
    shorter) whose weighted shingle similarity is ``threshold`` or more; of equal
    windows the first counts.  Words are folded runs of letters and digits; fewer
    than ``shingle`` words are one shingle.  A null or empty text has no leaks, a
    null id or an item without words leaks nowhere, repeated items leak each
    under its own id, and an empty benchmark leaks nothing.  A benchmark beyond
    ``index_chars`` is held against the texts in several indexes of that size,
    one after the other; weights are those of the whole benchmark in each.  A
    column named leaks is replaced, all others stay.
    """
    return _told(docs, "leaks", benchmark, **options)


def drop_leaking(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows that leak an item, as ``find_leaks`` finds them; all columns stay as they are."""
    (name,) = fresh(docs, "leaks")
    return _told(docs, name, benchmark, **options).filter(F.size(name) == 0).select(*[F.col(f"`{c}`") for c in docs.columns])


def _leaks_udf(items: _Items):
    @F.arrow_udf(LEAKS)
    def leaks(text: pa.Array) -> pa.Array:
        n, first, parts = 0, [0], [[], [], [], []]
        for s, e in slices(text):
            row, number, start, size, similarity = _matches(text.slice(s, e - s), items)
            for part, x in zip(parts, (items.item_id[number], start, size, similarity)):
                part.append(x)
            first.extend((n + np.searchsorted(row, np.arange(1, e - s + 1))).tolist())
            n = first[-1]
        cols = [np.concatenate(p) if p else np.zeros(0) for p in parts]
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.float64())
        struct = pa.StructArray.from_arrays([pa.array(c.astype(t.to_pandas_dtype()), t) for c, t in zip(cols, kinds)], ["item_id", "start_word", "n_words", "similarity"])
        return pa.ListArray.from_arrays(pa.array(first, pa.int32()), struct)

    return leaks


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that leaks an item, with the items and the best similarity."""
    found = find_leaks(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "leaks").filter(F.size("leaks") > 0).select(
        "doc_id",
        F.size("leaks").cast("long").alias("n_items"),
        F.array_join(F.transform(F.array_sort("leaks.item_id"), lambda x: x.cast("string")), ",").alias("item_ids"),
        F.round(F.array_max("leaks.similarity"), 9).alias("best_similarity"),
    )
