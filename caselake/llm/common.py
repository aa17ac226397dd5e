"""Reading tables and staging intermediate results for the operators of this subpackage."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_OWNED: set[str] = set()
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


_BATCH, _BATCH_DEFAULT, _BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", "4m"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the folder.

    Texts go to Python in batches of ``_BATCH_BYTES``, unless the session sets
    another size: with Spark's own default a task holds 64 MB of them twice.
    """
    if spark.conf.get(_BATCH) == _BATCH_DEFAULT:
        spark.conf.set(_BATCH, _BATCH_BYTES)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the session names it.

    Only a single-process session may go without the setting; it then gets a
    temporary folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="caselake-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", root)
    return root


def _folder(spark: SparkSession) -> str:
    """This application's own folder in the shared one, which goes when the driver ends."""
    folder = f"{shared_root(spark).rstrip('/')}/{spark.sparkContext.applicationId}"
    if folder not in _OWNED:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
        _OWNED.add(folder)
    return folder


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage with files that outlive any executor.  The shuffle
    files behind them are given back as soon as the write has ended.  What
    ``unstage`` does not delete before, as a lazy result still reads it, goes
    with the application.
    """
    spark = df.sparkSession
    path = f"{_folder(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def unstage(df: DataFrame) -> None:
    """Delete what ``staged`` wrote for ``df``, once nothing reads it any more."""
    spark = df.sparkSession
    jvm, hadoop = spark._jvm, spark._jsc.hadoopConfiguration()
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(hadoop).delete(path, True)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with underlines before it until ``df`` has no column so called (case aside)."""
    held = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in held:
            name = f"_{name}"
        held.add(name.lower())
        out.append(name)
    return out
