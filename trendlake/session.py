"""Session settings the jobs rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Partitions a shuffle starts with on a cluster; a local master takes its own setting.
INITIAL_PARTITIONS = 20_000
_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


# On one machine tables are few and small files, of which a task reads one: a split of at least
# the file's size leaves no empty tasks beside it, a shuffle of a few hundred kB still goes to all
# cores, and a low broadcast threshold lets the joins spread the rows of that one task.
LOCAL_SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "1m",
    "spark.sql.files.openCostInBytes": "16m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128k",
}


def build_session(app_name: str, master: str | None = None, extra: dict[str, str] | None = None) -> SparkSession:
    """Session with UTC clocks, adaptive plans and per-partition overwrite.

    On a cluster shuffles start with many partitions, enough for the largest (100 TB in 20,000
    are 5 GB each, and most shuffles move partial sums only), and adaptive execution joins small
    ones. A setting the cluster or ``extra`` brings along is left alone. A local ``master`` takes
    ``LOCAL_SETTINGS``.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.ui.enabled", "false")
    )
    local = bool(master) and master.startswith("local")
    if master:
        builder = builder.master(master)
    for key, value in ((LOCAL_SETTINGS if local else {}) | (extra or {})).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if not spark.sparkContext.master.startswith("local") and spark.conf.get(_INITIAL, None) is None:
        spark.conf.set(_INITIAL, INITIAL_PARTITIONS)
    return spark
