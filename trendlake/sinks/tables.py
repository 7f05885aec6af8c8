"""Partitioned Parquet tables that are replaced partition by partition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from trendlake.staging import brief_shuffles


def write_partitions(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = ("region",),
    table: str | None = None,
    rebalance: bool = True,
    whole: bool = False,
) -> None:
    """Replace the partitions of ``path`` that occur in ``df``; leave the others alone.

    With ``whole`` the table is replaced as a whole, so no partition of an earlier run stays.

    Running a job twice therefore gives the same table. ``rebalance`` lets adaptive
    execution shape the files: small partitions are joined, and a region with most of the
    rows is split over many tasks and files. Turn it off when ``df`` already arrives in
    large tasks and the extra shuffle costs more than small files would.
    """
    shaped = df.hint("rebalance", *partition_by) if rebalance else df
    with brief_shuffles(df.sparkSession):
        (
            shaped.write.mode("overwrite")
            .option("partitionOverwriteMode", "static" if whole else "dynamic")
            .option("compression", "snappy")
            .partitionBy(*partition_by)
            .parquet(path)
        )
    if table is not None:
        register_table(df.sparkSession, table, path)


def partition_folder(spark: SparkSession, path: str, values: dict) -> str:
    """Folder of a partition, as Spark names it."""
    names = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    parts = [names.getPartitionPathString(name, None if value is None else str(value)) for name, value in values.items()]
    return "/".join([path.rstrip("/"), *parts])


def register_table(spark: SparkSession, table: str, path: str) -> None:
    """Make the folder known to the catalog, with the partitions it has now and no others."""
    if not spark.catalog.tableExists(table):
        spark.catalog.createTable(table, path=path, source="parquet")
    spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")
    spark.catalog.refreshTable(table)
