"""Shared scratch tables: the way to fix an intermediate result that is read twice.

Everything goes below the folder the cluster names in ``spark.checkpoint.dir``, so a lost
executor never takes an intermediate result with it.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Folders staged inside the cleared_staging blocks that are open now, innermost last.
_open: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """Shared folder of the session; a temporary one only for a local master."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    existing = context.getCheckpointDir()
    if existing:
        return existing.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="trendlake-")
    context.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, label: str) -> str:
    """Name of a fresh folder for ``label``; nothing is created yet."""
    return f"{shared_dir(spark)}/trendlake/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written rows."""
    spark = df.sparkSession
    folder = new_folder(spark, label)
    if _open:
        _open[-1].append(folder)
    with brief_shuffles(spark):
        df.write.mode("errorifexists").parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


@contextmanager
def brief_shuffles(spark: SparkSession) -> Iterator[None]:
    """Inside the block a query's shuffle files go when the query ends, not when the driver comes to collect garbage.

    For writes of frames that are not run again: Spark would have to make the files anew.
    """
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, True)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


@contextmanager
def cleared_staging(spark: SparkSession) -> Iterator[None]:
    """Remove what is materialized inside the block when it ends, whether well or not.

    A job writes its results inside the block, so nothing reads the tables afterwards.
    """
    folders: list[str] = []
    _open.append(folders)
    try:
        yield
    finally:
        _open.remove(folders)
        remove_folders(spark, folders)


def remove_folders(spark: SparkSession, folders: list[str]) -> None:
    """Delete folders of any file system Spark can reach."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for folder in folders:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def is_finished(spark: SparkSession, folder: str) -> bool:
    """Whether a table was written to ``folder`` to its end."""
    files = spark._jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    return files.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS"))


def list_folders(spark: SparkSession, folder: str) -> list[str]:
    """The folders right below ``folder``, none if it does not exist."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return []
    return [str(s.getPath().toString()) for s in files.listStatus(path) if s.isDirectory()]


def existing(spark: SparkSession, folders: list[str]) -> list[str]:
    """Those of ``folders`` that exist."""
    conf, path = spark._jsc.hadoopConfiguration(), spark._jvm.org.apache.hadoop.fs.Path
    return [folder for folder in folders if path(folder).getFileSystem(conf).exists(path(folder))]
