"""Compression of vectors to a byte a part, with exact integer arithmetic.

Vectors are cut into equal parts, and each part is replaced by the number of the
nearest entry of its codebook.  Nearest entries are found by partial distances:
dimensions go by the descending variance of the codebook, and an entry is dropped
as soon as what it has added up strictly exceeds the best complete distance so
far.  Codebooks are moved by rounds of sums over all vectors; what a task sends
on is a row for each number of the codebooks, whatever it has read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .ann import common_width
from .common import staged, table, unstage
from .exact_search import scaled
from .near_duplicates import few

#: Vectors that a task looks at together, and entries that it brings to an end before the bound is drawn tighter.
ROWS, STEP = 2048, 16
_LONG = 2**63 - 1


class Codebook:
    """The entries of one part (integers, a row each) and the order in which its dimensions are looked at."""

    def __init__(self, entries: np.ndarray) -> None:
        self.entries = entries
        columns = [[int(x) for x in c] for c in entries.T]
        spread = [len(c) * sum(x * x for x in c) - sum(c) ** 2 for c in columns]
        self.order = sorted(range(len(columns)), key=lambda j: (-spread[j], j))
        self.most = max((abs(int(x)) for x in entries.ravel()), default=0)

    def nearest(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of the nearest entry of each row of ``v``; ties to the lower number.

        Where a sum of squares could pass 64 bits, integers of any size are used.
        """
        book, order = self.entries, self.order
        if not len(v) or not order:
            return np.zeros(len(v), np.int64), np.zeros(len(v), np.int64)
        if len(order) * (max(abs(int(v.min())), abs(int(v.max()))) + self.most) ** 2 > _LONG:
            v, book = v.astype(object), book.astype(object)
        # the entry that is near in the widest dimension gives the first complete distance
        by = np.argsort(book[:, order[0]], kind="stable")
        code = by[np.searchsorted(book[by, order[0]], v[:, order[0]]).clip(0, len(by) - 1)]
        gap = v - book[code]
        best = (gap * gap).sum(1)
        for s in range(0, len(book), STEP):
            gap = v[:, order[0], None] - book[None, s : s + STEP, order[0]]
            total = gap * gap
            row, entry = np.nonzero(total <= best[:, None])
            total, entry = total[row, entry], entry + s
            for j in order[1:]:
                gap = v[row, j] - book[entry, j]
                total = total + gap * gap
                alive = total <= best[row]
                row, entry, total = row[alive], entry[alive], total[alive]
            # what is left is complete; of each row the best, then the lowest number
            at = np.lexsort((entry, total, row)) if total.dtype != object else np.array(sorted(range(len(row)), key=lambda i: (row[i], total[i], entry[i])), np.int64)
            at = at[np.concatenate((np.ones(min(1, len(at)), bool), row[at][1:] != row[at][:-1]))]
            row, entry, total = row[at], entry[at], total[at]
            better = ((total < best[row]) | (entry < code[row])).astype(bool)
            code[row[better]], best[row[better]] = entry[better], total[better]
        return code, best


class Codebooks:
    """A codebook for each of ``parts`` equal parts of ``width`` components; past the last component parts are shorter or empty."""

    def __init__(self, books: list[np.ndarray], width: int) -> None:
        self.books, self.width = [Codebook(b) for b in books], width
        self.ends = np.cumsum([b.shape[1] for b in books]).tolist()

    @classmethod
    def of(cls, first: np.ndarray, parts: int) -> Codebooks:
        step = -(-first.shape[1] // parts)
        return cls([first[:, p * step : (p + 1) * step] for p in range(parts)], first.shape[1])

    def split(self, v: np.ndarray) -> list[np.ndarray]:
        return np.split(v, self.ends[:-1], axis=1)

    def encode(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes (a column each part) and squared distances of the rows of ``v``, the latter cut to 64 bits."""
        codes, gaps = zip(*(b.nearest(x) for b, x in zip(self.books, self.split(v))))
        error = sum(g.astype(object) for g in gaps)
        return np.stack(codes, 1).astype(np.uint8), np.array([min(int(e), _LONG) for e in error], np.int64)

    def digest(self) -> str:
        """SHA-256 of all entries' components, by part, entry and place, joined by commas."""
        return hashlib.sha256(",".join(str(int(x)) for b in self.books for x in b.entries.ravel()).encode()).hexdigest()


def kept_vectors(vectors: DataFrame, label: str = "label") -> DataFrame:
    """vec_id, embedding (doubles) and label of the rows whose vector is there and finite throughout, and as wide as most of them."""
    fine = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.transform("embedding", lambda v: v.cast("double")).alias("embedding"), F.col(label).alias("label"))
    rows = rows.filter("embedding IS NOT NULL AND size(embedding) > 0").filter(fine)
    return rows.filter(F.size("embedding") == common_width(rows))


def _blocks(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Parts of the batches of at most ``ROWS`` rows, and the integers of their vectors in column ``at``."""
    for b in batches:
        for s in range(0, b.num_rows, ROWS):
            some = b.slice(s, ROWS)
            yield some, scaled(some.column(at).flatten().to_numpy(zero_copy_only=False).reshape(some.num_rows, -1))


def moved(rows: DataFrame, books: Codebooks) -> Codebooks:
    """The codebooks whose entries are the floored means of the parts nearest to them; an entry that none is nearest to stays."""
    shared = rows.sparkSession.sparkContext.broadcast(books)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        total = [np.zeros(b.entries.shape, object) for b in held.books]
        count = [np.zeros(len(b.entries), np.int64) for b in held.books]
        for _, v in _blocks(batches, 0):
            wide = max(abs(int(v.min())), abs(int(v.max()))) * len(v) > _LONG
            for p, (book, x) in enumerate(zip(held.books, held.split(v))):
                code = book.nearest(x)[0]
                own = np.zeros(book.entries.shape, object if wide else np.int64)
                np.add.at(own, code, x.astype(own.dtype))
                total[p] += own.astype(object)
                count[p] += np.bincount(code, minlength=len(count[p]))
        keys = [(p, e, j) for p in range(len(total)) for e in np.flatnonzero(count[p]).tolist() for j in range(total[p].shape[1])]
        part, entry, place = (np.array(x, np.int32) for x in zip(*keys)) if keys else (np.zeros(0, np.int32),) * 3
        told = pa.array([Decimal(int(total[p][e, j])) for p, e, j in keys], pa.decimal128(38, 0))
        times = pa.array([int(count[p][e]) for p, e, _ in keys], pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(entry), pa.array(place), told, times], ["part", "entry", "place", "total", "n"])

    # a row for each number of the codebooks: entries x width
    found = rows.select("embedding").mapInArrow(sums, "part int, entry int, place int, total decimal(38,0), n bigint").groupBy("part", "entry", "place").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect()
    shared.unpersist()
    out = [b.entries.copy() for b in books.books]
    for r in found:
        out[r.part][r.entry, r.place] = int(r.total) // r.n
    return Codebooks(out, books.width)


def fit_codebooks(rows: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2) -> Codebooks | None:
    """Codebooks that start as the vectors of the smallest ids and move ``rounds`` times; None without vectors."""
    first = rows.orderBy(F.asc_nulls_last("vec_id"), "embedding").limit(entries).select("embedding").collect()
    if not first:
        return None
    books = Codebooks.of(scaled(np.array([r[0] for r in first], np.float64)), parts)
    for _ in range(rounds):
        books = moved(rows, books)
    return books


def compress(vectors: DataFrame, label: str = "label", parts: int = 16, entries: int = 64, rounds: int = 2) -> DataFrame:
    """vec_id, code (binary, a byte a part), error, label_error, codebooks_sha256 and width of every vector that is kept.

    ``vectors`` has vec_id, embedding and ``label``; other columns are not read.
    Each component x counts as floor(256 * x), beyond 64 bits as the nearest such
    integer.  Vectors that are null, empty, or hold null or non-finite components
    go, and so do those of another width than most have (of equally many the
    smaller).  Codebooks start as the parts of the ``entries`` (256 at most)
    smallest vec_ids, of equal ids by their vectors, null ids last; fewer vectors
    make fewer entries.  Where ``parts`` does not divide the width, the last parts
    are shorter or empty, and an empty one has code 0.  error is the sum of the
    parts' squared distances, label_error its sum over all rows of an equal label
    (null labels are equal); either is cut to 64 bits.  Rows that repeat an id
    count each; an empty table gives an empty result.
    """
    spark = vectors.sparkSession
    rows = kept_vectors(vectors, label)
    books = fit_codebooks(rows, parts, entries, rounds)
    kind = rows.schema["label"].dataType.simpleString()
    if books is None:
        return spark.createDataFrame([], "vec_id bigint, code binary, error bigint, label_error bigint, codebooks_sha256 string, width int")
    shared = spark.sparkContext.broadcast(books)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, v in _blocks(batches, 2):
            codes, error = shared.value.encode(v)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error)], ["vec_id", "label", "code", "error"])

    coded = staged(rows.select("vec_id", "label", "embedding").mapInArrow(encode, f"vec_id bigint, label {kind}, code binary, error bigint"), "codes")
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(Decimal(_LONG))).cast("bigint")
    labels = staged(coded.groupBy("label").agg(total.alias("label_error")).withColumnRenamed("label", "_label"), "labels")
    out = coded.join(few(labels), F.col("label").eqNullSafe(F.col("_label")))
    return out.select("vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"), F.lit(books.width).alias("width"))


def _assigned(n: int) -> str:
    """SQL of the nearest entry of codebook ``n`` for each part: squared distance x 64 + number."""
    return f"""a{n} AS MATERIALIZED (
  SELECT x.rn, x.part, min(list_sum(list_transform(list_zip(x.c, b{n}.c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT * 64 + b{n}.entry) AS near
  FROM x JOIN b{n} USING (part) GROUP BY x.rn, x.part)"""


def _moved(n: int) -> str:
    """SQL of codebook ``n`` + 1."""
    return f"""s{n} AS (
  SELECT part, entry, i, sum(v)::BIGINT AS s, count(*) AS n FROM (SELECT a.part, a.near % 64 AS entry, unnest(x.c) AS v, generate_subscripts(x.c, 1) AS i FROM a{n} AS a JOIN x USING (rn, part))
  GROUP BY part, entry, i),
m{n} AS (SELECT part, entry, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM s{n} GROUP BY part, entry),
b{n + 1} AS MATERIALIZED (SELECT part, entry, coalesce(m{n}.c, b{n}.c) AS c FROM b{n} LEFT JOIN m{n} USING (part, entry))"""


OP13_SQL = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS rn, vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e
  FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
x AS MATERIALIZED (SELECT rn, part, list_slice(e, part * (len(e) // 16) + 1, (part + 1) * (len(e) // 16)) AS c FROM kept, range(16) AS t(part)),
b0 AS MATERIALIZED (SELECT part, rn - 1 AS entry, c FROM x WHERE rn <= 64),
{_assigned(0)},
{_moved(0)},
{_assigned(1)},
{_moved(1)},
{_assigned(2)},
r AS (SELECT rn, string_agg(format('{{:02x}}', near % 64), '' ORDER BY part) AS code, sum(near // 64)::BIGINT AS error FROM a2 GROUP BY rn),
h AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b2)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM kept JOIN r USING (rn), h"""


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of 16 parts by 64 entries, moved twice, of all embeddings."""
    coded = compress(table(spark, sf_dir, "embeddings"))
    return coded.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", "codebooks_sha256")
