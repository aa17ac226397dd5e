"""Approximate nearest neighbours by inner product: inverted file and product quantisation.

Every vector is filed under its nearest coarse centroid, and what is left of it
is coded by the nearest centroids of its parts.  A query visits the cells whose
centroids promise most, adds up tabulated products of its parts for each code,
and the best of what it finds is ranked again by exact products.

Equal vectors are filed once, as a class with its smallest ids, so a common
vector takes one place of a shortlist.

Only centroids are fitted on a bounded sample; every class is indexed.  Cells are
packed into shards of bounded size, a large one into several, so a cell may hold
a third of all vectors; a query goes to a shard once, with the cells it visits.
How many cells a query visits and how long its shortlist is are measured on
some of the queries, whose nearest are found among all vectors by brute force.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import staged, table, unstage
from .near_duplicates import few

#: Bounds on the vectors that the centroids are fitted on, those of the smallest hash of the id: their number, and bytes (one vector at least).
MAX_TRAIN_ROWS, MAX_TRAIN_BYTES = 20_000, 64 << 20
#: Bound on the number of cells, about the square root of the number of vectors below it.
MAX_CELLS = 16_384
#: Bound on the queries that are answered by brute force first, those of the smallest hash of the id; ``MAX_TRAIN_BYTES`` bounds them too.
TRIAL_QUERIES = 256
#: A shard's vectors, and the queries that meet them in one task.
BLOCK_ROWS, BLOCK_QUERIES = 2048, 512


def _kmeans(x: np.ndarray, k: int, seed: int, rounds: int = 12) -> np.ndarray:
    """Lloyd's centroids; a centroid without points moves to the point worst served."""
    rng = np.random.default_rng(seed)
    distinct = np.unique(x, axis=0)
    k = max(1, min(k, len(distinct)))
    centres = distinct[rng.choice(len(distinct), k, replace=False)]
    for _ in range(rounds):
        near, gap = _nearest(x, centres)
        count = np.bincount(near, minlength=k)
        total = np.zeros_like(centres)
        np.add.at(total, near, x)
        centres = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], centres)
        empty = np.flatnonzero(count == 0)
        if len(empty):
            centres[empty] = x[np.argsort(-gap, kind="stable")[: len(empty)]]
    return centres


def _nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    near, gap = np.empty(len(x), np.int64), np.empty(len(x))
    norms = (centres * centres).sum(1)
    for s in range(0, len(x), 4096):
        d = norms - 2 * x[s : s + 4096] @ centres.T
        near[s : s + 4096] = d.argmin(1)
        gap[s : s + 4096] = d.min(1) + (x[s : s + 4096] ** 2).sum(1)
    return near, gap


class Index:
    """Coarse centroids, a codebook for each part, and the sample they were fitted on with the ids of vectors of one id (or None)."""

    def __init__(self, centres: np.ndarray, books: list[np.ndarray], sample_ids: np.ndarray, sample: np.ndarray, spread: float) -> None:
        self.centres, self.books, self.sample_ids, self.sample, self.spread = centres, books, sample_ids, sample, spread
        #: of each cell the first of its shards and their number, once they are packed
        self.shard, self.n_shards = np.zeros(len(centres), np.int64), np.ones(len(centres), np.int64)
        self.width = sum(b.shape[1] for b in books)

    def split(self, x: np.ndarray) -> list[np.ndarray]:
        x = np.pad(x, ((0, 0), (0, self.width - x.shape[1])))
        ends = np.cumsum([b.shape[1] for b in self.books])
        return np.split(x, ends[:-1], axis=1)

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cell = _nearest(x, self.centres)[0]
        parts = self.split(x - self.centres[cell])
        return cell, np.stack([_nearest(p, b)[0].astype(np.uint8) for p, b in zip(parts, self.books)], 1)

    def tables(self, q: np.ndarray) -> np.ndarray:
        """For each query, part and code the product of the part with the code's centroid."""
        wide = max(len(b) for b in self.books)
        return np.stack([np.pad(p @ b.T, ((0, 0), (0, wide - len(b)))) for p, b in zip(self.split(q), self.books)], 1)


    def probes(self, k: int, share: float, most_queries: int = 256) -> int:
        """So many cells, the most promising first, hold ``share`` of the ``k`` nearest in the sample of some of its vectors."""
        n = min(most_queries, len(self.sample))
        products = self.sample[:n] @ self.sample.T
        products[np.arange(n), np.arange(n)] = -np.inf
        best = np.argsort(-products, axis=1, kind="stable")[:, : min(k, len(self.sample) - 1)]
        cell = _nearest(self.sample, self.centres)[0]
        rank = np.argsort(np.argsort(-(self.sample[:n] @ self.centres.T), axis=1, kind="stable"), axis=1)
        places = np.sort(np.take_along_axis(rank, cell[best], axis=1).ravel())
        return int(places[min(len(places) - 1, int(np.ceil(share * len(places))) - 1)]) + 1 if len(places) else 1

    def pack(self, size: np.ndarray) -> None:
        """Deal cells out to shards of ``BLOCK_ROWS`` vectors or fewer, a larger cell to several of its own."""
        shard = held = 0
        for c, n in enumerate(size.tolist()):
            blocks = -(-n // BLOCK_ROWS)
            if blocks > 1 or held + n > BLOCK_ROWS:
                shard, held = shard + (held > 0), 0
            self.shard[c], self.n_shards[c] = shard, max(blocks, 1)
            held += n
            if blocks > 1:
                shard, held = shard + blocks, 0


def valid_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding (doubles) of the rows that take part."""
    x = F.transform("embedding", lambda v: v.cast("double"))
    fine = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))
    held = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("embedding")).filter("vec_id IS NOT NULL AND size(embedding) > 0")
    return held.filter(F.forall("embedding", fine)).filter(F.exists("embedding", lambda v: v != 0))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)


def common_width(vectors: DataFrame) -> int:
    """The width that most of the valid ``vectors`` have, of equally many the smallest; 0 without vectors."""
    first = vectors.groupBy(F.size("embedding").alias("w")).count().orderBy(F.desc("count"), "w").first()
    return first[0] if first else 0


def _classes(held: DataFrame, k: int) -> DataFrame:
    """Each different embedding with a number cls, the ``k`` + 1 smallest of its ids with their counts, the least, and whether that is its only id."""
    rows = held.groupBy("embedding", "vec_id").agg(F.count(F.lit(1)).alias("n"))
    least = rows.withColumn("r", F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))).filter(F.col("r") <= k + 1)
    ids = least.groupBy("embedding").agg(F.sort_array(F.collect_list(F.struct("vec_id", F.least("n", F.lit(k)).cast("int").alias("n")))).alias("ids"))
    return ids.select(F.monotonically_increasing_id().alias("cls"), "embedding", "ids", F.col("ids")[0]["vec_id"].alias("least"), (F.size("ids") == 1).alias("single"))


def fit_index(vectors: DataFrame, n: int, parts: int = 16, codes: int = 256, max_rows: int = MAX_TRAIN_ROWS) -> Index:
    """Centroids for ``n`` classes, from at most ``max_rows`` of them (one at least) within ``MAX_TRAIN_BYTES``."""
    width = vectors.select(F.max(F.size("embedding"))).first()[0]
    most = max(1, min(max_rows, MAX_TRAIN_BYTES // (8 * width)))
    rows = vectors.select("least", "single", "embedding").orderBy(F.xxhash64("least"), "least", "embedding").limit(most).toArrow().combine_chunks()
    least, single = (rows[c].to_numpy() for c in ("least", "single"))
    ids, x = np.where(single, least.astype(object), None), _matrix(rows["embedding"].combine_chunks())
    cells = int(min(MAX_CELLS, len(x), max(1, 2 ** round(np.log2(np.sqrt(n))))))
    centres = _kmeans(x, cells, 1)
    rest = x - centres[_nearest(x, centres)[0]]
    step = -(-x.shape[1] // parts)
    rest = np.pad(rest, ((0, 0), (0, step * -(-x.shape[1] // step) - x.shape[1])))
    books = [_kmeans(rest[:, s : s + step], codes, 2 + s) for s in range(0, rest.shape[1], step)]
    left = np.concatenate([rest[:, i * step : (i + 1) * step] - b[_nearest(rest[:, i * step : (i + 1) * step], b)[0]] for i, b in enumerate(books)], 1)
    return Index(centres, books, ids, x, float(np.sqrt((left**2).sum(1).mean() / max(x.shape[1], 1))))


class Trial:
    """Some queries, and of each the classes nearest to it among all (from brute force): their queries' places, cells and codes."""

    def __init__(self, index: Index, asked: DataFrame, held: DataFrame, filed: DataFrame, k: int) -> None:
        width = index.sample.shape[1]
        most = max(1, min(TRIAL_QUERIES, MAX_TRAIN_BYTES // (8 * width)))
        rows = asked.orderBy(F.xxhash64("query_id"), "query_id").limit(most).toArrow().combine_chunks()
        self.ids = rows["query_id"].to_numpy()
        self.q = _matrix(rows["q"].combine_chunks()) if len(self.ids) else np.zeros((0, width))
        near = None
        if len(self.ids):
            nearest = self._nearest(held, k)
            near = few(nearest).join(filed.select("cls", "cell", "code"), "cls").toArrow().combine_chunks()
            unstage(nearest)
        self.at, self.cell = (near[c].to_numpy().astype(np.int64) if near else np.zeros(0, np.int64) for c in ("at", "cell"))
        self.code = np.frombuffer(b"".join(near["code"].to_pylist()) if near else b"", np.uint8).reshape(len(self.at), len(index.books))

    def _nearest(self, held: DataFrame, k: int) -> DataFrame:
        """at (the query's place) and cls of the ``k`` nearest of each query."""
        shared = held.sparkSession.sparkContext.broadcast((self.ids, self.q))

        def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ids, q = shared.value
            score, cls, least = np.full((len(q), 0), -np.inf), np.zeros((len(q), 0), np.int64), np.zeros((len(q), 0), np.int64)
            for b in batches:
                for s in range(0, b.num_rows, 2048):
                    part = b.slice(s, 2048)
                    numbers, low, single = (part.column(i).to_numpy(zero_copy_only=False) for i in range(3))
                    new = q @ _matrix(part.column(3)).T
                    new[single & (ids[:, None] == low)] = -np.inf
                    score, cls, least = (np.concatenate((a, np.broadcast_to(c, new.shape)), 1) for a, c in ((score, new), (cls, numbers), (least, low)))
                    keep = np.lexsort((least, -score))[:, :k]
                    score, cls, least = (np.take_along_axis(a, keep, axis=1) for a in (score, cls, least))
            at = np.repeat(np.arange(len(q)), score.shape[1])
            out = pa.RecordBatch.from_arrays([pa.array(at), pa.array(cls.ravel()), pa.array(least.ravel()), pa.array(score.ravel())], ["at", "cls", "least", "score"])
            yield out.filter(pa.array(score.ravel() > -np.inf))

        found = held.select("cls", "least", "single", "embedding").mapInArrow(best, "at long, cls long, least long, score double")
        r = F.row_number().over(Window.partitionBy("at").orderBy(F.desc("score"), "least"))
        return staged(found.withColumn("r", r).filter(F.col("r") <= k).select("at", "cls"), "trial")

    def places(self, index: Index) -> np.ndarray:
        """Of each nearest class the place of its cell among those its query prefers."""
        out = np.zeros(len(self.at), np.int64)
        for i in range(len(self.q)):
            own = self.at == i
            rank = np.empty(len(index.centres), np.int64)
            rank[np.argsort(-(self.q[i] @ index.centres.T), kind="stable")] = np.arange(len(rank))
            out[own] = rank[self.cell[own]]
        return out

    def near(self, index: Index) -> np.ndarray:
        """The tabulated score of each nearest class."""
        tables = index.tables(self.q)
        return (self.q[self.at] * index.centres[self.cell]).sum(1) + tables[self.at[:, None], np.arange(self.code.shape[1]), self.code].sum(1)

    def before(self, index: Index, filed: DataFrame) -> np.ndarray:
        """How many of all classes have a better tabulated score than each nearest one."""
        near = self.near(index)
        shared = filed.sparkSession.sparkContext.broadcast((Index(index.centres, index.books, index.sample_ids[:0], index.sample[:0], index.spread), self.q, [np.sort(near[self.at == i]) for i in range(len(self.q))]))
        width = max(1, int(np.bincount(self.at).max()) if len(self.at) else 1)

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            x, q, edges = shared.value
            tables, base = x.tables(q), q @ x.centres.T
            out = np.zeros((len(q), width + 1), np.int64)
            for b in batches:
                cell = b.column(0).to_numpy()
                code = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint8).reshape(b.num_rows, -1)
                for i in range(len(q)):
                    score = base[i][cell] + tables[i][np.arange(code.shape[1]), code].sum(1)
                    # a score counts for every edge below it, but for a difference that rounding makes
                    out[i] += np.bincount(np.searchsorted(edges[i], score - 1e-9 * np.abs(score)), minlength=width + 1)
            at = np.repeat(np.arange(len(q)), width + 1)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.tile(np.arange(width + 1), len(q))), pa.array(out.ravel())], ["at", "edge", "n"])

        told = filed.select("cell", "code").mapInArrow(count, "at long, edge long, n long").groupBy("at", "edge").agg(F.sum("n").alias("n")).toArrow()
        better = np.zeros((len(self.q), width + 1), np.int64)
        better[told["at"].to_numpy(), told["edge"].to_numpy()] = told["n"].to_numpy()
        better = better[:, ::-1].cumsum(1)[:, ::-1]
        out = np.zeros(len(self.at), np.int64)
        for i in range(len(self.q)):
            own = np.flatnonzero(self.at == i)
            order = own[np.argsort(near[own], kind="stable")]
            out[order] = better[i, 1 : len(order) + 1]
        return out


def _least_for(share: float, values: np.ndarray) -> float:
    """The least value that so many of the ``values`` do not exceed."""
    return np.sort(values)[min(len(values) - 1, max(0, int(np.ceil(share * len(values))) - 1))]


def _sample_floor(index: Index, ids: np.ndarray, q: np.ndarray, k: int) -> np.ndarray:
    """Each query's k-th best product in the sample; minus infinity in a sample of fewer."""
    products = q @ index.sample.T
    products[ids[:, None] == index.sample_ids[None, :]] = -np.inf
    return np.partition(products, products.shape[1] - k, axis=1)[:, -k] if products.shape[1] >= k else np.full(len(q), -np.inf)


def _top(score: np.ndarray, least: np.ndarray, most: int) -> np.ndarray:
    """The places of the ``most`` best scores, best first, ties to the smaller id."""
    edge = np.partition(score, len(score) - most)[len(score) - most]
    at = np.flatnonzero(score >= edge)
    return at[np.lexsort((least[at], -score[at]))][:most]


def search(queries: DataFrame, vectors: DataFrame, k: int = 20, probes: float | None = None, least_probes: int = 8, refine: int = 20, share: float = 0.95) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` nearest vectors found for each query.

    ``queries`` and ``vectors`` have vec_id and embedding.  Nearest is the
    largest inner product in double precision, ties go to the smaller vec_id, and
    the vector with the query's own id is no candidate.  Vectors that are null,
    empty, zero, or hold a null or non-finite component take no part on either
    side, nor do rows without vec_id, nor vectors of another width than most of
    ``vectors``.  Rows that repeat a vec_id are candidates each; a repeated query
    is answered for its smallest vector.  With fewer candidates than ``k`` all
    that are found come back; an empty table gives an empty result.

    Some queries are answered by brute force among all vectors first, and what
    they need is given to every query: so many cells and so long a shortlist that
    each loses at most half of what ``share`` leaves open.  The cells are those that
    hold that much of the nearest, in the sample too, or the share ``probes`` of all
    cells if that is given; ``least_probes`` at least, and more until they hold
    fifty times ``k`` different vectors.  From each shard come its ``k`` best and
    whatever may beat the query's k-th best in the sample, up to the shortlist's
    length, ``refine`` times ``k`` at least; as many different vectors over all
    shards are ranked exactly, and those that stay stand for all their ids.
    """
    spark = vectors.sparkSession
    valid = valid_vectors(vectors)
    width = common_width(valid)
    held = staged(_classes(valid.filter(F.size("embedding") == width), k), "vectors")
    n = held.count()
    fit = valid_vectors(queries).filter(F.size("embedding") == width)
    asked = fit.groupBy(F.col("vec_id").alias("query_id")).agg(F.min("embedding").alias("q"))
    if n == 0:
        unstage(held)
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    index = fit_index(held, n)
    # vectors are coded without the sample, which only the queries need
    shared = spark.sparkContext.broadcast(Index(index.centres, index.books, index.sample_ids[:0], index.sample[:0], index.spread))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                cell, code = shared.value.encode(_matrix(b.column(3)))
                yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(cell.astype(np.int32)), pa.array([c.tobytes() for c in code], pa.binary())], ["cls", "least", "single", "cell", "code"])

    filed = staged(held.select("cls", "least", "single", "embedding").mapInArrow(encode, "cls long, least long, single boolean, cell int, code binary"), "filed")
    shared.unpersist()
    sizes = dict(filed.groupBy("cell").count().collect())
    size = np.array([sizes.get(c, 0) for c in range(len(index.centres))])
    trial, each = Trial(index, asked, held, filed, k), (1 + share) / 2
    wanted = max(index.probes(k, share), int(_least_for(each, trial.places(index))) + 1 if len(trial.at) else 1) if probes is None else int(np.ceil(probes * len(size)))
    n_probes = min(len(size), max(least_probes, wanted))
    most, slack = refine * k, 3 * index.spread
    if len(trial.at):
        most = max(most, int(_least_for(each, trial.before(index, filed))) + 1)
        lengths = np.sqrt((trial.q**2).sum(1))
        short = np.concatenate([_sample_floor(index, trial.ids[s : s + 256], trial.q[s : s + 256], k) for s in range(0, len(trial.q), 256)])[trial.at] - trial.near(index)
        slack = max(slack, float(_least_for(each, short / np.maximum(lengths[trial.at], np.finfo(float).tiny))) * (1 + 1e-9))
    index.pack(size)
    packed = spark.sparkContext.broadcast(index)
    # a row for each cell, so MAX_CELLS at most
    shards = F.broadcast(spark.createDataFrame([(c, int(s), int(b)) for c, (s, b) in enumerate(zip(index.shard, index.n_shards))], "cell int, shard int, n_shards int"))

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = packed.value
        for b in batches:
            for s in range(0, b.num_rows, 256):
                ids = b.column(0).slice(s, 256).to_numpy(zero_copy_only=False)
                q = _matrix(b.column(1).slice(s, 256))
                order = np.argsort(-(q @ x.centres.T), axis=1, kind="stable")
                held_so_far = np.cumsum(size[order], axis=1) - size[order]
                go = ((np.arange(len(size)) < n_probes) | (held_so_far < 50 * k)) & (size[order] > 0)
                floor = _sample_floor(x, ids, q, k) - slack * np.sqrt((q * q).sum(1))
                at, place = np.nonzero(go)
                cell = order[at, place]
                # a cell of several shards is visited in each of them
                times = x.n_shards[cell]
                at, cell = np.repeat(at, times), np.repeat(cell, times)
                shard = x.shard[cell] + np.arange(len(cell)) - np.repeat(np.cumsum(times) - times, times)
                by = np.lexsort((cell, shard, at))
                at, cell, shard = at[by], cell[by], shard[by]
                new = np.flatnonzero(np.concatenate((np.ones(min(1, len(at)), bool), (at[1:] != at[:-1]) | (shard[1:] != shard[:-1]))))
                lists = pa.ListArray.from_arrays(pa.array(np.append(new, len(at)).astype(np.int32)), pa.array(cell.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([pa.array(ids[at[new]]), b.column(1).slice(s, 256).take(pa.array(at[new])), pa.array(floor[at[new]]), pa.array(shard[new].astype(np.int32)), lists], ["query_id", "q", "floor", "shard", "cells"])

    visits = staged(asked.mapInArrow(visit, "query_id long, q array<double>, floor double, shard int, cells array<int>"), "visits")
    guests = visits.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / BLOCK_QUERIES).cast("int").alias("q_blocks"))
    guests = staged(guests, "guests")  # a row for each shard that a query visits
    codes = filed.join(shards, "cell").withColumn("shard", (F.col("shard") + F.pmod(F.xxhash64("cls"), F.col("n_shards"))).cast("int"))
    codes = codes.join(few(guests), "shard").select("shard", F.explode(F.sequence(F.lit(0), F.col("q_blocks") - 1)).alias("q_block"), "cell", "cls", "least", "single", "code")
    calls = visits.join(few(guests), "shard").select("shard", F.pmod(F.xxhash64("query_id"), F.col("q_blocks")).cast("int").alias("q_block"), "query_id", "q", "floor", "cells")

    def scan(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[np.ndarray, ...]] = []
        if len(left) and len(right):
            x = packed.value
            right = right.sort_values(["cell", "least"], kind="stable")
            numbers, least, single = (right[c].to_numpy() for c in ("cls", "least", "single"))
            cells, first, place = np.unique(right["cell"].to_numpy(), return_index=True, return_inverse=True)
            ends = np.append(first[1:], len(right))
            code = np.frombuffer(b"".join(right["code"]), np.uint8).reshape(len(right), -1).astype(np.int64)
            q = np.stack(left["q"].to_numpy())
            base = q @ x.centres[cells].T
            tables = x.tables(q)
            code += np.arange(code.shape[1]) * tables.shape[2]
            tables = tables.reshape(len(q), -1)
            for i, (own, floor, visited) in enumerate(zip(left["query_id"].to_numpy(), left["floor"].to_numpy(), left["cells"])):
                at = np.flatnonzero(np.isin(cells, visited))
                some = slice(None) if len(at) == len(cells) else np.concatenate([np.zeros(0, np.int64), *(np.arange(first[c], ends[c]) for c in at)])
                score = base[i][place[some]] + tables[i][code[some]].sum(1)
                score[single[some] & (least[some] == own)] = -np.inf
                # ties of the shortlist go to the class of the smaller id
                best = np.lexsort((least[some], -score))[:most] if len(score) <= most else _top(score, least[some], most)
                best = best[(score[best] >= floor) | (np.arange(len(best)) < k)]
                best = best[score[best] > -np.inf]
                out.append((np.full(len(best), own), numbers[some][best], least[some][best], score[best]))
        cols = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 3 + [np.zeros(0)]
        return pd.DataFrame(dict(zip(("query_id", "cls", "least", "near"), cols)))

    keys = ["shard", "q_block"]
    found = calls.groupBy(keys).cogroup(codes.groupBy(keys)).applyInPandas(scan, "query_id long, cls long, least long, near double")
    by_query = lambda *order: Window.partitionBy("query_id").orderBy(*order)
    top = found.withColumn("r", F.row_number().over(by_query(F.desc("near"), "least"))).filter(F.col("r") <= most).select("query_id", "cls")
    top = staged(top, "candidates")
    unstage(filed)
    unstage(visits)
    unstage(guests)
    product = F.aggregate(F.zip_with("q", "embedding", lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v)
    others = F.filter("ids", lambda x: x["vec_id"] != F.col("query_id"))
    exact = top.join(held, "cls").join(asked, "query_id").select("query_id", product.alias("score"), others.alias("ids"))
    # a class of the k best has one id at least, so no id of a later one is among the k best
    best = exact.withColumn("r", F.row_number().over(by_query(F.desc("score"), F.col("ids")[0]["vec_id"]))).filter(F.col("r") <= k)
    ids = best.select("query_id", "score", F.explode(F.flatten(F.transform("ids", lambda x: F.array_repeat(x["vec_id"], x["n"])))).alias("vec_id"))
    ranked = ids.withColumn("rank", F.row_number().over(by_query(F.desc("score"), "vec_id"))).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op10_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every twentieth vector among all others."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return search(vectors.filter(F.col("vec_id") % 20 == 0), vectors)
