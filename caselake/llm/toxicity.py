"""Toxicity scores by a factorisation machine over hashed terms.

Terms are words (runs of letters and digits, folded) and their first 3 to 6 characters,
so that inflected insults share weight; each is hashed into one of ``BINS`` bins.
Bins that speak for the toxic class beyond chance are screened on the training
sample; the machine then learns a weight and a vector for each of them, and
pairs of bins interact through the inner product of their vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .words import LETTERS, Words, slices

PREFIXES = (3, 4, 5, 6)
#: Terms are hashed into so many bins.
BITS = 20
BINS = 1 << BITS
#: Bounds on the labelled rows that the machine is fitted on, those of the smallest hash of doc_id, and on their characters.
MAX_TRAIN_ROWS, MAX_TRAIN_CHARS = 30_000, 40_000_000
#: A bin is screened if its log-likelihood ratio is as high as chance makes it once in a thousand times.
LEAST_RATIO = 10.83


def _terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, bin) of every term of a slice."""
    w = Words(column, lower=True, classes=LETTERS)
    row = w.row_of_word()
    parts = [(row, w.hashes())] + [(row[longer], h) for longer, h in w.prefix_hashes(PREFIXES)]
    return np.concatenate([p[0] for p in parts]), (np.concatenate([p[1] for p in parts]) >> np.uint64(64 - BITS)).astype(np.int64)


class Machine:
    """A fitted machine: the sorted screened bins, their weights and vectors, the bias."""

    def __init__(self, bins: np.ndarray, bias: float, weight: np.ndarray, vector: np.ndarray) -> None:
        self.bins, self.bias, self.weight, self.vector = bins, bias, weight, vector
        self._number: np.ndarray | None = None

    def known(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (row, number of the bin) of a slice, screened bins only, by row."""
        if self._number is None:
            self._number = np.full(BINS, -1, np.int32)
            self._number[self.bins] = np.arange(len(self.bins), dtype=np.int32)
        row, bin_ = _terms(column)
        number = self._number[bin_]
        hit = number >= 0
        n = max(len(self.bins), 1)
        key = np.unique(row[hit] * n + number[hit])
        return key // n, key % n

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_number": None}

    def scores(self, rows: np.ndarray, numbers: np.ndarray, n: int) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(_raw(self.bias, self.weight, self.vector, rows, numbers, n)[0], -35, 35)))


def _raw(bias: float, weight: np.ndarray, vector: np.ndarray, rows: np.ndarray, numbers: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The machine's output for each of n rows, and the sum of each row's vectors."""
    v = vector[numbers]
    total = np.stack([np.bincount(rows, v[:, f], n) for f in range(vector.shape[1])], 1)
    squares = np.bincount(rows, (v * v).sum(1), n)
    return bias + np.bincount(rows, weight[numbers], n) + 0.5 * ((total * total).sum(1) - squares), total


def _fit(bins: np.ndarray, label: np.ndarray, rows: np.ndarray, numbers: np.ndarray, factors: int = 8, epochs: int = 30, rate: float = 0.1, decay: float = 1e-4, batch: int = 256) -> Machine:
    """AdaGrad on the logistic loss with weight decay; the rows are shuffled by a fixed seed."""
    rng = np.random.default_rng(7)
    n, m = len(label), len(bins)
    weight, vector = np.zeros(m), rng.normal(0, 0.02, (m, factors))
    bias = float(np.log((label.sum() + 0.5) / (n - label.sum() + 0.5)))
    g_weight, g_vector, g_bias = np.full(m, 1e-3), np.full((m, factors), 1e-3), 1e-3
    first = np.searchsorted(rows, np.arange(n + 1))
    for _ in range(epochs if m else 0):
        order = rng.permutation(n)
        for s in range(0, n, batch):
            pick = order[s : s + batch]
            size = first[pick + 1] - first[pick]
            at = np.repeat(first[pick] - np.cumsum(size) + size, size) + np.arange(size.sum())
            r, k = np.repeat(np.arange(len(pick)), size), numbers[at]
            out, total = _raw(bias, weight, vector, r, k, len(pick))
            err = 1 / (1 + np.exp(-np.clip(out, -35, 35))) - label[pick]
            used, slot = np.unique(k, return_inverse=True)
            d_weight = np.bincount(slot, err[r], len(used)) / len(pick) + decay * weight[used]
            share = err[r, None] * (total[r] - vector[k])
            d_vector = np.stack([np.bincount(slot, share[:, f], len(used)) for f in range(factors)], 1) / len(pick) + decay * vector[used]
            d_bias = err.mean()
            g_weight[used] += d_weight**2
            g_vector[used] += d_vector**2
            g_bias += d_bias**2
            weight[used] -= rate * d_weight / np.sqrt(g_weight[used])
            vector[used] -= 0.3 * rate * d_vector / np.sqrt(g_vector[used])
            bias -= rate * d_bias / np.sqrt(g_bias)
    return Machine(bins, bias, weight, vector)


def _ratio(toxic: Column, docs: Column, n1: int, n: int) -> Column:
    """The log-likelihood ratio of a bin's share among toxic rows against its share among all; 0 if it is not the higher."""
    part = lambda seen, expected: F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)
    share = n1 / max(n, 1)
    away1, away0 = n1 - toxic, (n - docs) - (n1 - toxic)
    cells = [part(toxic, docs * share), part(docs - toxic, docs * (1 - share)), part(away1, (n - docs) * share), part(away0, (n - docs) * (1 - share))]
    return F.when(toxic > docs * share, 2 * sum(cells[1:], cells[0])).otherwise(0.0)


def fit_toxicity(docs: DataFrame, labelled: DataFrame, max_rows: int = MAX_TRAIN_ROWS, max_chars: int = MAX_TRAIN_CHARS, least_ratio: float = LEAST_RATIO) -> Machine:
    """Fit on at most ``max_rows`` labelled rows of ``max_chars`` characters, those of the smallest hash of doc_id.

    ``docs`` has doc_id and text, ``labelled`` has doc_id and toxic (0 or 1).
    Rows with a null id or label teach nothing; of several labels of one id the
    largest counts.  Without labelled rows the machine scores every text 0.5.
    All bins of the sample that pass the screen take part.
    """
    ids = labelled.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    sample = ids.withColumn("h", F.xxhash64("doc_id")).orderBy("h", "doc_id").limit(max_rows)
    joined = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    size = F.sum(F.coalesce(F.char_length("text"), F.lit(0)))
    held = joined.groupBy("h", "doc_id", "toxic").agg(size.alias("chars"), F.count(F.lit(1)).alias("n")).select("h", "toxic", "chars", "n").toArrow()
    h, label, chars, times = (held[c].to_numpy().astype(np.int64) for c in ("h", "toxic", "chars", "n"))
    order = np.argsort(h)
    within = order[np.cumsum(chars[order]) <= max_chars]
    last = int(h[within].max()) if len(within) else -(1 << 63)
    n, n1 = int(times[within].sum()), int((times * label)[within].sum())
    rows = joined.filter(F.col("h") <= last).select("text", "toxic")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s, e in slices(b.column(0)):
                row, bin_ = _terms(b.column(0).slice(s, e - s))
                key = np.unique(row * BINS + bin_)
                y = b.column(1).slice(s, e - s).to_numpy(zero_copy_only=False)
                bins, slot = np.unique(key % BINS, return_inverse=True)
                toxic = np.bincount(slot, y[key // BINS], len(bins)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(bins), pa.array(toxic), pa.array(np.bincount(slot, minlength=len(bins)))], ["bin", "toxic", "docs"])

    counts = rows.mapInArrow(count, "bin long, toxic long, docs long").groupBy("bin").agg(F.sum("toxic").alias("toxic"), F.sum("docs").alias("docs"))
    screened = counts.filter(_ratio(F.col("toxic"), F.col("docs"), n1, n) >= least_ratio).select("bin")
    bins = np.sort(screened.toArrow()["bin"].to_numpy().astype(np.int64))
    empty = Machine(bins, 0.0, np.zeros(len(bins)), np.zeros((len(bins), 1)))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s, e in slices(b.column(0)):
                r, k = empty.known(b.column(0).slice(s, e - s))
                first = np.searchsorted(r, np.arange(e - s + 1)).astype(np.int32)
                k = k.astype(np.int32)
                packed = pa.array([k[i:j].tobytes() for i, j in zip(first[:-1], first[1:])], pa.binary())
                yield pa.RecordBatch.from_arrays([b.column(1).slice(s, e - s), packed], ["toxic", "bins"])

    # numbers stay packed, four bytes each, until they are one array
    told = rows.mapInArrow(encode, "toxic int, bins binary").toArrow()
    got = sorted(zip(told["toxic"].to_pylist(), told["bins"].to_pylist()))
    label = np.array([r[0] for r in got], float)
    size = np.array([len(r[1]) // 4 for r in got], np.int64)
    return _fit(bins, label, np.repeat(np.arange(len(got)), size), np.frombuffer(b"".join(r[1] for r in got), np.int32))


def toxicity_of(text: Column, machine: Machine) -> Column:
    """The score of whole texts, 0 to 1.  A null or empty text has no terms and gets the bias' score."""

    @F.arrow_udf("double")
    def score(column: pa.Array) -> pa.Array:
        found = [np.zeros(0)]
        for s, e in slices(column):
            r, k = machine.known(column.slice(s, e - s))
            found.append(machine.scores(r, k, e - s))
        return pa.array(np.concatenate(found))

    return score(text)


def score_toxicity(docs: DataFrame, machine: Machine, threshold: float = 0.7) -> DataFrame:
    """``docs`` (text and any other columns) with toxicity double and is_toxic boolean.

    Both replace columns of the same names.  An empty table gives an empty result.
    """
    return docs.withColumn("toxicity", toxicity_of(F.col("text"), machine)).withColumn("is_toxic", F.col("toxicity") >= threshold)


def drop_toxic(docs: DataFrame, machine: Machine, threshold: float = 0.7) -> DataFrame:
    """``docs`` without the rows whose score is ``threshold`` or more; all columns stay as they are."""
    return docs.filter(toxicity_of(F.col("text"), machine) < threshold)


def held_out() -> Column:
    """True for the third of the rows whose labels are kept for testing."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score for every document; the labels of every third are never learned from."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    machine = fit_toxicity(docs, table(spark, sf_dir, "labels").filter(~held_out()))
    scored = score_toxicity(docs, machine)
    return scored.select("doc_id", held_out().alias("held_out"), F.col("toxicity").alias("score"), F.col("is_toxic").cast("int").alias("predicted"))
