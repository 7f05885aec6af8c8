"""Quality checks from mergeable profiles: what the checks measure, kept for every partition.

A profile row holds the measures of one partition. Counts merge by sums and times by maxima, so the report of a
whole table follows from its profile, and only partitions that changed are read again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendlake.config import QualityRules
from trendlake.operators.quality import Check, table_checks
from trendlake.schemas import SILVER_PARTITIONS
from trendlake.sinks.tables import write_partitions
from trendlake.sources.files import optional_frame
from trendlake.staging import cleared_staging, materialize
from trendlake.streaming.incremental import stored_rows

ROWS = "rows"
#: The measure that merges by its maximum; all others are counts.
LATEST = "latest"


def _measures(checks: Sequence[Check]) -> dict[str, Column]:
    found = {ROWS: F.count(F.lit(1))}
    for check in checks:
        found.update(check.measures)
    return found


def rules_key(rules: QualityRules, table: str) -> str:
    """Name of the rules that shape what is measured: a profile by others says nothing about these."""
    shaping = (table, tuple(rules.critical_columns.get(table, ())), rules.ranged_columns.get(table), rules.max_views)
    return hashlib.sha256(repr(shaping).encode()).hexdigest()[:16]


def profile(df: DataFrame, table: str, rules: QualityRules, by: Sequence[str] = SILVER_PARTITIONS) -> DataFrame:
    """One row of measures for each partition, with the rules they were taken by."""
    measures = _measures(table_checks(df, table, rules))
    # A partition column may be a critical column, so it is grouped under another name.
    keyed = df.withColumns({f"_by_{name}": F.col(name) for name in by})
    measured = keyed.groupBy(*(f"_by_{name}" for name in by)).agg(*(column.alias(f"m_{name}") for name, column in measures.items()))
    return measured.withColumnsRenamed({f"_by_{name}": name for name in by}).withColumn("rules", F.lit(rules_key(rules, table)))


def report(profiles: DataFrame, like: DataFrame, table: str, rules: QualityRules, now: Column | None = None) -> DataFrame:
    """The rows that ``check_table`` gives for the profiled table, from its profile alone.

    ``like`` has the schema of the table; none of its rows are read.
    """
    checks = table_checks(like, table, rules, now)
    names = list(_measures(checks))
    merged = profiles.where(F.col("rules") == rules_key(rules, table)).agg(
        *((F.max(f"m_{n}") if n == LATEST else F.coalesce(F.sum(f"m_{n}"), F.lit(0))).alias(n) for n in names)
    )
    return merged.select(F.inline(F.array(*(check.row for check in checks))))


def update_profiles(statistics: DataFrame, changed: DataFrame, path: str, table: str, rules: QualityRules) -> None:
    """Bring the profile at ``path`` to the statistics, of which only the ``changed`` partitions are read.

    The first time, and after a change of the rules, ``changed`` has to name all partitions. A
    partition without rows any more leaves the profile.
    """
    spark = statistics.sparkSession
    with cleared_staging(spark):
        changed = materialize(changed.select(*SILVER_PARTITIONS).distinct(), "changed")
        fresh = profile(stored_rows(statistics, changed), table, rules) if not changed.isEmpty() else None
        if fresh is None:
            return
        regions = changed.select(F.col("region").alias("_region")).distinct()
        kept = read_profiles(spark, path, fresh.schema)
        kept = kept.join(regions, F.col("region").eqNullSafe(F.col("_region")), "left_semi")
        gone = changed.withColumnsRenamed({name: f"_{name}" for name in SILVER_PARTITIONS})
        same = F.lit(True)
        for name in SILVER_PARTITIONS:
            same &= F.col(name).eqNullSafe(F.col(f"_{name}"))
        whole = kept.join(gone, same, "left_anti").unionByName(fresh)
        # A region whose partitions all left keeps one row of nothing, so that its old rows are replaced too.
        missing = regions.join(whole.select("region").distinct(), F.col("region").eqNullSafe(F.col("_region")), "left_anti")
        empty = missing.select(*(_nothing(f).alias(f.name) for f in fresh.schema.fields))
        write_partitions(materialize(whole.unionByName(empty), "profiles"), path, ("region",), rebalance=False)


def _nothing(item: T.StructField) -> Column:
    if item.name == "region":
        return F.col("_region")
    return F.lit(0 if isinstance(item.dataType, T.LongType) else None).cast(item.dataType)


def read_profiles(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    stored = optional_frame(lambda: spark.read.schema(schema).parquet(path))
    return spark.createDataFrame([], schema) if stored is None else stored.select(*schema.names)
