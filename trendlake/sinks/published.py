"""Tables that readers see whole: written beside the old version, then swapped by one step in the catalog."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession

from trendlake.sinks.tables import write_partitions
from trendlake.staging import is_finished, list_folders, remove_folders


def new_version() -> str:
    """Name of a version; names sort by time."""
    return f"version={datetime.now(UTC):%Y%m%d_%H%M%S_%f}-{uuid.uuid4().hex[:8]}"


def publish(df: DataFrame, name: str, root: str, partition_by: Sequence[str] = ("region",), keep: int = 2) -> str:
    """Write ``df`` as a new version below ``root`` and make ``name`` show it; returns the version's folder.

    ``name`` is a view over the folder of one version, so replacing it is a single step in the catalog: a query
    sees the old rows or the new ones, never a part, and if the write fails ``name`` still shows the last good version.
    Give ``df`` a rebalance hint where its tasks are many and small.
    Filters and columns are pushed to the files as for a table. ``keep`` versions stay, the newest among them, so
    that queries which began before the swap can end; folders of writes that broke off are removed with the older ones.
    """
    spark = df.sparkSession
    folder = f"{root.rstrip('/')}/{new_version()}"
    write_partitions(df, folder, partition_by, rebalance=False, whole=True)
    show(spark, name, folder)
    remove_old(spark, root, folder, keep)
    return folder


def show(spark: SparkSession, name: str, folder: str) -> None:
    """Make ``name`` the rows of ``folder``."""
    quoted = ".".join(f"`{part}`" for part in name.split("."))
    spark.sql(f"CREATE OR REPLACE VIEW {quoted} AS SELECT * FROM parquet.`{folder}`")


def versions(spark: SparkSession, root: str) -> list[str]:
    """Folders of the versions that were written to their end, the newest last."""
    return sorted(f for f in list_folders(spark, root) if "/version=" in f and is_finished(spark, f))


def remove_old(spark: SparkSession, root: str, current: str, keep: int) -> None:
    """Remove all versions before the newest ``keep`` up to ``current``; later ones, of another run, stay."""
    past = [f for f in versions(spark, root) if f.rsplit("/", 1)[-1] <= current.rsplit("/", 1)[-1]]
    kept = {f.rsplit("/", 1)[-1] for f in past[-keep:]}
    older = [f for f in list_folders(spark, root) if "/version=" in f and f.rsplit("/", 1)[-1] < min(kept)]
    remove_folders(spark, older)
