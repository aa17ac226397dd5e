"""Extracts with quoted texts over several lines, read by many tasks.

Spark cuts a file (a plain one, or one of a splittable codec such as bzip2) at
line ends, but whether a line end lies inside a quoted field depends on all that
comes before.  So one pass finds for each split whether it holds an odd number of
quotes; going through these in order tells of each split whether it starts inside
a field.  A second pass puts lines together to records, task by task, and only
the parts of records that run over a split's end are brought together by a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_PIN = "spark.sql.files.minPartitionNum"


class Split(NamedTuple):
    """What is known of a split before it is read again."""

    inside: bool  #: it starts inside a quoted field
    anchor: int  #: the split in which the record begins that goes on here
    wide: bool  #: the lines of its file end in \\r\\n, as the first one does


def _lines(spark: SparkSession, path: str) -> DataFrame:
    read = spark.read.option("lineSep", "\n").text(path)
    return read.select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"))


def _quotes(value: pa.Array, quote: str, escape: str) -> np.ndarray:
    """How many quotes of each line open or close a field, or do so in pairs."""
    if escape not in (quote, ""):
        value = pc.replace_substring_regex(value, rf"(?s)\x{ord(escape):02x}.", "")
    return pc.count_substring(value, quote).to_numpy(zero_copy_only=False).astype(np.int64)


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], pa.Array]]:
    """Lines of one split after another, in pieces of a batch, with the split's path and start."""
    for b in batches:
        value, path, start = (b.column(i) for i in range(3))
        starts, paths = start.to_numpy(), path.dictionary_encode()
        codes = paths.indices.to_numpy()
        cuts = np.flatnonzero((starts[1:] != starts[:-1]) | (codes[1:] != codes[:-1])) + 1
        for s, e in zip([0, *cuts], [*cuts, b.num_rows]):
            if s < e:
                yield (paths.dictionary[int(codes[s])].as_py(), int(starts[s])), value.slice(s, e - s)


def splits(lines: DataFrame, quote: str, escape: str) -> tuple[dict[tuple[str, int], Split], bool]:
    """What each split starts with, and whether any record runs over a split's end: one row a split goes through the driver, some 50 bytes for ``maxPartitionBytes`` of input."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, int], tuple[bool, bool, bool]] = {}  # a task has few splits
        for key, value in _stretches(batches):
            odd, at_odd, wide = found.get(key, (False, False, key[1] == 0 and value[0].as_py().endswith("\r")))
            state = (int(odd) + np.cumsum(_quotes(value, quote, escape))) & 1
            found[key] = (bool(state[-1]), at_odd or bool(state.max()), wide)
        names, kinds = ["path", "start", "odd", "at_odd", "wide"], [pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_()]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*[(*key, *v) for key, v in found.items()]), kinds)], names)

    out: dict[tuple[str, int], Split] = {}
    inside, anchor, wide, of, cut = False, 0, False, None, False
    for r in sorted(lines.mapInArrow(scan, "path string, start bigint, odd boolean, at_odd boolean, wide boolean").collect()):
        if r.path != of:
            inside, anchor, wide, of = False, r.start, r.wide, r.path
        out[r.path, r.start] = Split(inside, anchor, wide)
        # what is open at the end began here, unless it was open at the start and no line of the split ends outside
        if not inside or r.at_odd:
            anchor = r.start
        inside ^= r.odd
        cut |= inside
    return out, cut


def _assembled(known, quote: str, escape: str, whole: bool):
    """A task's work: its whole records, or only the parts of records that run over a split's start or end."""
    names = ["first", "wide", "record", "path", "anchor", "part"][: 3 if whole else 6]
    kinds = [pa.bool_(), pa.bool_(), pa.string(), pa.string(), pa.int64(), pa.int64()]

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, inside, held, head, first = None, False, [], False, False
        out: list[tuple] = []

        def emit(record: list[str]) -> None:
            split = known.value[at]
            out.append((first, split.wide, "\n".join(record), at[0], split.anchor if head else at[1], at[1])[: len(names)])

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

        for key, value in _stretches(batches):
            if key != at:
                if held and not whole:
                    emit(held)
                if key not in known.value:
                    raise RuntimeError(f"{key} is no split of the first pass: the files or the sizes of splits have changed")
                at, inside, held = key, known.value[key].inside, []
                head, first = inside, key[1] == 0
            state = (int(inside) + np.cumsum(_quotes(value, quote, escape))) & 1
            text, begin = value.to_pylist(), 0
            for end in (np.flatnonzero(state == 0) + 1).tolist():
                if head != whole:
                    emit(held + text[begin:end])
                held, begin, head, first = [], end, False, False
            held += text[begin:]
            inside = bool(state[-1])
            if out:
                yield batch()
                out.clear()
        if held and not whole:
            emit(held)
            yield batch()

    return assemble


def split_csv(spark: SparkSession, path: str, schema: str, header: bool = True, quote: str = '"', escape: str = '"', **options: str) -> DataFrame:
    """The rows of extracts whose quoted texts may hold line ends, each file read by as many tasks as it has splits.

    The rows are those of Spark's own reader with ``multiLine``, which reads a file
    in one task, for files as a database writes them: a quote is one that encloses
    a field or is escaped.  Lines end in \\n, or in \\r\\n if a file's first one
    does, which then becomes \\n inside fields too; empty ones go.  ``header``
    leaves out each file's first record; columns go by their places.  ``options``
    are those of ``from_csv``.  A file that ends inside a quoted field gives what
    there is of it; no file, or empty ones, give no rows.

    The first pass runs at once, and reads quotes only.  Sizes of splits depend on
    the parallelism at the time, so the session's ``spark.sql.files.minPartitionNum``
    is set to that, unless it has a value; a second pass over other splits fails.
    Files of a codec that can't be split are read by one task each.
    """
    if spark.conf.get(_PIN, None) is None:
        spark.conf.set(_PIN, str(spark.sparkContext.defaultParallelism))
    lines = _lines(spark, path)
    known, cut = splits(lines, quote, escape)
    shared = spark.sparkContext.broadcast(known)
    records = lines.mapInArrow(_assembled(shared, quote, escape, whole=True), "first boolean, wide boolean, record string")
    if cut:
        ends = lines.mapInArrow(_assembled(shared, quote, escape, whole=False), "first boolean, wide boolean, record string, path string, anchor bigint, part bigint")
        parts = F.array_sort(F.collect_list(F.struct("part", "record")))
        records = records.unionByName(ends.groupBy("path", "anchor").agg(F.bool_or("first").alias("first"), F.bool_or("wide").alias("wide"), F.array_join(F.transform(parts, lambda x: x["record"]), "\n").alias("record")).select("first", "wide", "record"))
    record = F.when(F.col("wide"), F.replace(F.rtrim("record", F.lit("\r")), F.lit("\r\n"), F.lit("\n"))).otherwise(F.col("record"))
    rows = records.filter(~F.col("first") if header else F.lit(True)).select(record.alias("record")).filter("record <> ''")
    told = {"sep": ",", "quote": quote, "escape": escape, "multiLine": "true", **options}
    return rows.select(F.from_csv("record", schema, told).alias("r")).select("r.*")
