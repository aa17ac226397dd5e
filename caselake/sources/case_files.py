"""A folder of JSON files for each case, written so that a run that fails leaves what was there.

``data/attempt=<id>/court=<court>/year=<year>/<folder>/`` holds docket.json, cluster.json and
opinion.json, further ones as cluster_2.json and so on, and files of any kind
under their own names.  A task writes into a folder of its own with a fresh name, and the names of its files as lines of JSON into
``index/attempt=<id>/court=<court>/year=<year>/``.  Only when all tasks are through is a small
file published that names those folders; it is the version that readers go by.  They
list the index, a few files for each court and year, and never the cases.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

# The kinds of files of a case.
KINDS = ("docket", "cluster", "opinion")
SCHEMA = "court string, year int, folder string, docket string, cluster string, opinion string, files array<struct<name:string,content:binary>>"
_VERSIONS = "_versions"
#: What a line of the index says; its folders have the rest.
_LINE = "folder string, kind string, number int, name string, length bigint"
_PLACES = "court string, year int, attempt string"
#: So many tasks share a court and year, each with a file of the index.
_SPREAD = 32
#: So many bytes of files go back from Python at once (one file may be longer).
_READ_BYTES = 4 << 20


@dataclass
class _Written(WriterCommitMessage):
    """What a task wrote: its folder, and how many files of each kind."""

    attempt: str
    files: dict[str, int] = field(default_factory=dict)


def _versions(files: fs.FileSystem, root: str) -> list[str]:
    found = files.get_file_info(fs.FileSelector(f"{root}/{_VERSIONS}", allow_not_found=True))
    return sorted(f.base_name for f in found if f.base_name.endswith(".json") and f.base_name[0].isdigit())


def _index(attempt: str) -> str:
    """The folder that indexes what a task wrote."""
    return f"index/{attempt.split('/')[1]}"


def _escaped(value: str) -> str:
    """A value in a partition's folder, as Spark reads it."""
    return re.sub(r"""[\x01-\x1f"#%'*:=?\\\x7f{\[\]^]""", lambda m: f"%{ord(m[0]):02X}", value)


def _latest(files: fs.FileSystem, root: str) -> dict:
    """The last published version: its number, and the folders that each run wrote, oldest first."""
    names = _versions(files, root)
    if not names:
        return {"version": 0, "runs": []}
    with files.open_input_file(f"{root}/{_VERSIONS}/{names[-1]}") as f:
        return json.loads(f.read())


class CaseWriter(DataSourceWriter):
    def __init__(self, path: str, overwrite: bool) -> None:
        self.path, self.overwrite = path, overwrite

    def write(self, iterator: Iterator) -> _Written:
        files, root = fs.FileSystem.from_uri(self.path)
        attempt = f"attempt={uuid.uuid4().hex}"
        out = _Written(f"data/{attempt}")
        at = index = None

        def put(kind: str, number: int, name: str, content: bytes) -> None:
            with files.open_output_stream(f"{folder}/{name}") as f:
                f.write(content)
            index.write(json.dumps({"folder": parts[2], "kind": kind, "number": number, "name": name, "length": len(content)}).encode() + b"\n")
            out.files[kind] = out.files.get(kind, 0) + 1

        try:
            for row in iterator:
                parts = (str(row["court"]), str(row["year"]), str(row["folder"]))
                own = row["files"] or []
                if any("/" in p or p in ("", ".", "..", "None") for p in (*parts, *(str(f["name"]) for f in own))):
                    raise ValueError(f"no name for a folder or file: {parts}, {[f['name'] for f in own]}")
                if at is None or parts[:2] != at[:2]:
                    if index is not None:
                        index.close()
                    place = f"{root}/index/{attempt}/court={_escaped(parts[0])}/year={parts[1]}"
                    files.create_dir(place, recursive=True)
                    index = files.open_output_stream(f"{place}/{uuid.uuid4().hex}.json")
                if parts != at:
                    at, seen, names = parts, dict.fromkeys(KINDS, 0), set()
                    folder = f"{root}/{out.attempt}/court={parts[0]}/year={parts[1]}/{parts[2]}"
                    files.create_dir(folder, recursive=True)
                for kind in KINDS:
                    if row[kind] is None or (kind == "docket" and seen[kind]):
                        continue
                    seen[kind] += 1
                    put(kind, seen[kind], f"{kind}{'' if seen[kind] == 1 else f'_{seen[kind]}'}.json", row[kind].encode())
                if own:
                    files.create_dir(f"{folder}/files", recursive=True)
                for file in own:
                    if file["name"] in names or file["content"] is None:  # the first of a name counts
                        continue
                    names.add(file["name"])
                    put("files", len(names), f"files/{file['name']}", bytes(file["content"]))
        finally:
            if index is not None:
                index.close()
        return out

    def commit(self, messages: list[_Written | None]) -> None:
        files, root = fs.FileSystem.from_uri(self.path)
        told = [m for m in messages if m is not None and m.files]
        last = _latest(files, root)
        runs = [*([] if self.overwrite else last["runs"]), *([[m.attempt for m in told]] if told else [])]
        now = {"version": last["version"] + 1, "runs": runs, "files": {k: sum(m.files.get(k, 0) for m in told) for k in (*KINDS, "files")}}
        files.create_dir(f"{root}/{_VERSIONS}", recursive=True)
        draft, name = f"{root}/{_VERSIONS}/_draft-{uuid.uuid4().hex}", f"{root}/{_VERSIONS}/{now['version']:012d}.json"
        with files.open_output_stream(draft) as f:
            f.write(json.dumps(now).encode())
        if files.get_file_info(name).type != fs.FileType.NotFound:
            files.delete_file(draft)
            raise RuntimeError(f"{name} was published by another writer")
        files.move(draft, name)

    def abort(self, messages: list[_Written | None]) -> None:
        files, root = fs.FileSystem.from_uri(self.path)
        for m in messages:
            for path in [f"{root}/{m.attempt}", f"{root}/{_index(m.attempt)}"] if m is not None else []:
                if files.get_file_info(path).type != fs.FileType.NotFound:
                    files.delete_dir(path)


class CaseFiles(DataSource):
    """``df.write.format("case_files").mode("append").save(uri)``; columns as in ``SCHEMA``, rows of a folder together (``write_case_files`` sees to that)."""

    @classmethod
    def name(cls) -> str:
        return "case_files"

    def schema(self) -> str:
        return SCHEMA

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return CaseWriter(self.options["path"], overwrite)


def write_case_files(cases: DataFrame, uri: str, order: list[str], overwrite: bool = False) -> None:
    """Write rows of court, year, folder, docket, cluster and opinion (structs or JSON; null for none) as files below ``uri``.

    Rows of one folder are one case: its first docket, and its clusters and
    opinions by ``order``; a column ``files`` (array of name and content) has
    documents, as PDFs, the first of a name counting.  A folder that is written again takes the place of the
    older one as a whole; with ``overwrite`` all others go too.  ``uri`` names a
    place that all executors reach, as file:///shared/..., hdfs:// or s3://.
    Rows without court, year or folder, or such that name no folder, fail.
    """
    cases.sparkSession.dataSource.register(CaseFiles)
    asked = [F.col(k).cast("string") if cases.schema[k].dataType.typeName() in ("string", "void") else F.when(F.col(k).isNotNull(), F.to_json(k)) for k in KINDS]
    own = F.col("files") if "files" in cases.columns else F.lit(None)
    rows = cases.select("court", F.col("year").cast("int").alias("year"), "folder", *[c.alias(k) for c, k in zip(asked, KINDS)], own.cast("array<struct<name:string,content:binary>>").alias("files"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)])
    place = ["court", "year", "folder"]
    # a court and year goes to some tasks only, so that the index has few files for it
    together = rows.repartition("court", "year", F.pmod(F.hash("folder"), F.lit(_SPREAD))).sortWithinPartitions(*place, *[f"_o{i}" for i in range(len(order))])
    together.select(*place, *KINDS, "files").write.format("case_files").mode("overwrite" if overwrite else "append").save(uri)


def case_files(spark: SparkSession, uri: str) -> DataFrame | None:
    """court, year, folder, kind, number and json of the files of the last version; None before the first.

    court and year are partitions of the index, so that conditions on them, also
    through a join, leave other folders unread.  Files are read by the tasks that
    read the index, and only if their JSON is asked for.
    """
    rows = _indexed(spark, uri)
    if rows is None:
        return None
    return rows.filter("kind <> 'files'").select("folder", "kind", "number", _content(uri, "string").alias("json"), "court", "year")


def case_documents(spark: SparkSession, uri: str) -> DataFrame | None:
    """court, year, folder, name, length and content of the documents of the last version; None before the first.  Contents are read only if asked for; empty files have no row."""
    rows = _indexed(spark, uri)
    if rows is None:
        return None
    return rows.filter("kind = 'files'").select("folder", F.substr("name", F.lit(len("files/") + 1)).alias("name"), "length", _content(uri, "binary").alias("content"), "court", "year")


def _indexed(spark: SparkSession, uri: str) -> DataFrame | None:
    """A row for each file of the last version that is not empty, with its path from ``uri``; of each folder those of the last run that wrote it."""
    files, root = fs.FileSystem.from_uri(uri)
    now = _latest(files, root)
    if not now["version"]:
        return None
    base, schema = uri.rstrip("/"), f"{_LINE}, {_PLACES}"
    with_index = {f.base_name for f in files.get_file_info(fs.FileSelector(f"{root}/index", allow_not_found=True))}
    told = [a for run in now["runs"] for a in run]
    new = [f"{base}/{_index(a)}" for a in told if a.split("/")[1] in with_index]
    old = [f"{base}/{a}" for a in told if a.split("/")[1] not in with_index]
    rows = spark.createDataFrame([], f"{schema}, path string")
    if new:
        place = F.concat(F.lit("data/attempt="), "attempt", F.lit("/court="), "court", F.lit("/year="), F.col("year").cast("string"), F.lit("/"), "folder", F.lit("/"), "name")
        rows = spark.read.schema(schema).options(basePath=f"{base}/index", mode="FAILFAST").json(new).withColumn("path", place)
    if old:
        listed = _listed(spark, base, old)
        rows = rows.unionByName(listed) if new else listed
    return _last_run(rows, now).filter("length > 0")


def _listed(spark: SparkSession, base: str, paths: list[str]) -> DataFrame:
    """The index of folders that were written without one, from a listing of all their files."""
    part = lambda k: F.regexp_extract("path", r".*/year=[^/]*/([^/]+)/((?:files/)?[^/]+)$", k)
    found = spark.read.format("binaryFile").schema(f"path string, modificationTime timestamp, length bigint, content binary, {_PLACES}").option("basePath", f"{base}/data").load(paths)
    named = found.select(part(1).alias("folder"), part(2).alias("name"), "length", "court", "year", "attempt", F.regexp_extract("path", r".*/(data/attempt=.*)$", 1).alias("path"))
    own = F.startswith("name", F.lit("files/"))
    kind, number = (F.regexp_extract("name", r"^([a-z]+)(?:_([0-9]+))?\.json$", k) for k in (1, 2))
    return named.withColumns({"kind": F.when(own, F.lit("files")).otherwise(kind), "number": F.when(~own, F.coalesce(F.nullif(number, F.lit("")).cast("int"), F.lit(1)))})


def _content(uri: str, kind: str) -> Column:
    """What the file of each row of the index holds."""

    @F.arrow_udf(kind)
    def content(paths: Iterator[pa.Array]) -> Iterator[pa.Array]:
        files, root = fs.FileSystem.from_uri(uri)
        for batch in paths:
            held, size = [], 0
            for path in batch.to_pylist():
                with files.open_input_stream(f"{root}/{path}") as f:
                    held.append(f.read())
                size += len(held[-1])
                if size >= _READ_BYTES:
                    yield pa.array(held, pa.binary()).cast(pa.string() if kind == "string" else pa.binary())
                    held, size = [], 0
            if held:
                yield pa.array(held, pa.binary()).cast(pa.string() if kind == "string" else pa.binary())

    return content("path")


def _last_run(rows: DataFrame, now: dict) -> DataFrame:
    """Rows of each folder as the last run that wrote it has them."""
    if len(now["runs"]) <= 1:
        return rows
    run = F.create_map(*[F.lit(x) for i, attempts in enumerate(now["runs"]) for a in attempts for x in (a.split("=")[1], i)])[F.col("attempt")]
    last = F.max("run").over(Window.partitionBy("court", "year", "folder"))
    return rows.withColumn("run", run).withColumn("last", last).filter("run = last").drop("run", "last")


def prune_case_files(uri: str) -> int:
    """Delete folders that the last version does not name, as of tasks that were killed or of older versions; their number.  Not while a run is on."""
    files, root = fs.FileSystem.from_uri(uri)
    used = {a.split("/")[1] for run in _latest(files, root)["runs"] for a in run}
    found = lambda of: [f.path for f in files.get_file_info(fs.FileSelector(f"{root}/{of}", allow_not_found=True)) if f.base_name not in used]
    gone = found("data")
    for path in gone + found("index"):
        files.delete_dir(path)
    return len(gone)
