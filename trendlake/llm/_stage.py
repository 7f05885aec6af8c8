"""Intermediate tables in the shared folder, and their removal."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from trendlake.staging import new_folder, remove_folders

# Lists that take the folders staged while their block is open, of this thread only.
_open: ContextVar[tuple[list[str], ...]] = ContextVar("open", default=())


def stage(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Write ``df`` below the folder of ``spark.checkpoint.dir``; the rows read back, and their folder.

    Cuts the lineage: a lost executor takes nothing of it along, and no row is made anew in
    another order.
    """
    spark = df.sparkSession
    folder = new_folder(spark, label)
    for taken in _open.get():
        taken.append(folder)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder), folder


@contextmanager
def recorded(folders: list[str]) -> Iterator[None]:
    """Add the folders staged inside the block to ``folders``, for who knows when they can go."""
    token = _open.set((*_open.get(), folders))
    try:
        yield
    finally:
        _open.reset(token)


def discard(spark: SparkSession, *folders: str) -> None:
    """Remove staged tables that nothing reads any more."""
    remove_folders(spark, list(folders))


def read_roots(df: DataFrame) -> list[str]:
    """The folders or files that ``df`` was told to read; not the files inside them."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    roots = []
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.getClass().getSimpleName() == "LogicalRelation" and hasattr(leaf.relation(), "location"):
            paths = leaf.relation().location().rootPaths()
            roots += [str(paths.apply(j).toString()) for j in range(paths.size())]
    return roots
