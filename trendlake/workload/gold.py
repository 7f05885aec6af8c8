"""Queries over the gold rollups and the quality gate."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlake.config import REFERENCE_TABLE, STATISTICS_TABLE, QualityRules
from trendlake.operators import enrich, quality, rollups
from trendlake.operators.ranking import rank_in_group
from trendlake.plans.gold import silver_to_gold as run_gold
from trendlake.plans.gold import staged_base
from trendlake.plans.gold_changes import update_gold
from trendlake.plans.medallion import run_all as run_medallion
from trendlake.schemas import SILVER_PARTITIONS, SILVER_STATISTICS
from trendlake.sinks.landing import land_reference_json
from trendlake.sinks.reports import failed_checks_json
from trendlake.sinks.tables import partition_folder, write_partitions
from trendlake.sources.tables import optional_table as optional
from trendlake.staging import materialize, new_folder, remove_folders
from trendlake.workload import inputs
from trendlake.workload.oracle_ctes import (
    BRONZE,
    CATEGORY,
    CHANNEL,
    ENRICHED,
    REFERENCE,
    SILVER,
    SILVER_OF_TEXT,
    TRENDING,
    with_,
)
from trendlake.workload.registry import query
from trendlake.workload.statistics import _write_csv, projected, silver_frame

FIXED_NOW = "2024-01-31 12:00:00"


def enriched_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.enrich_category(silver_frame(spark, sf_dir), inputs.reference_rows(spark, sf_dir))


def based(spark: SparkSession, sf_dir: str, twice: bool = False) -> tuple[DataFrame, DataFrame]:
    """The statistics and their staged base with category names, as the gold job has them.

    The statistics are a table of their own if they are read twice.
    """
    silver = silver_frame(spark, sf_dir).select(*rollups.READ_COLUMNS)
    silver = materialize(silver, "silver") if twice else silver
    return silver, staged_base(silver, inputs.reference_rows(spark, sf_dir))


def _joined_text(channels: DataFrame) -> DataFrame:
    return channels.withColumn("categories", F.array_join("categories", ","))


@query(
    with_(
        ENRICHED,
        """SELECT category_id, category_name, region, count(*) AS videos, CAST(sum(views) AS BIGINT) AS views
           FROM enriched GROUP BY 1, 2, 3""",
    )
)
def enrich_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        enriched_frame(spark, sf_dir)
        .groupBy("category_id", "category_name", "region")
        .agg(F.count(F.lit(1)).alias("videos"), F.sum("views").alias("views"))
    )


@query(
    with_(
        SILVER,
        """SELECT 'Unknown' AS category_name, category_id, count(*) AS videos FROM silver GROUP BY category_id""",
    )
)
def optional_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without a reference table every category is unknown."""
    reference = optional(lambda: spark.read.table("no_such_reference_table"))
    enriched = enrich.enrich_category(silver_frame(spark, sf_dir), reference)
    return enriched.groupBy("category_name", "category_id").agg(F.count(F.lit(1)).alias("videos"))


@query(with_(SILVER, TRENDING.format(source="silver")))
def trending_analytics(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = silver_frame(spark, sf_dir)
    return rollups.trending_analytics(silver, materialize(rollups.gold_base(silver), "gold-base"))


@query(with_(ENRICHED, CHANNEL.format(source="enriched")))
def channel_analytics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined_text(rollups.channel_analytics(*based(spark, sf_dir, twice=True)))


@query(with_(ENRICHED, CATEGORY.format(source="enriched")))
def category_analytics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.category_analytics(*based(spark, sf_dir))


@query(
    """SELECT r_name, c_custkey, c_acctbal,
              CAST(row_number() OVER (PARTITION BY r_name ORDER BY c_acctbal DESC, c_custkey) AS INTEGER)
                  AS rank_in_region
       FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""
)
def rank_customers_in_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distributed rank on a group per region, with many rows each."""
    customers = (
        inputs.table(spark, sf_dir, "customer")
        .join(inputs.table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(inputs.table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("r_name", "c_custkey", "c_acctbal")
    )
    order = [F.col("c_acctbal").desc(), F.col("c_custkey").asc()]
    return rank_in_group(customers, "r_name", order, "rank_in_region")


@query(
    """SELECT region, trending_date_parsed, category, total_views,
              round(total_views / sum(total_views) OVER (PARTITION BY region, trending_date_parsed) * 100, 2)
                  AS view_share_pct
       FROM (SELECT event_type AS region, CAST(ts AS DATE) AS trending_date_parsed, user_id % 44 AS category,
                    CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT) + 1) AS BIGINT) AS total_views
             FROM events GROUP BY 1, 2, 3)"""
)
def view_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The share of views per type and day over events."""
    events = inputs.table(spark, sf_dir, "events")
    totals = events.groupBy(
        F.col("event_type").alias("region"),
        F.to_date("ts").alias("trending_date_parsed"),
        (F.col("user_id") % 44).alias("category"),
    ).agg(F.sum(inputs.event_number() + 1).alias("total_views"))
    return rollups.view_share(totals)


def _report(report: DataFrame) -> DataFrame:
    return report.select(
        F.col("check").alias("check_name"), F.col("column").alias("column_name"), "value", "threshold", "passed"
    )


def _statistics_report(spark, sf_dir, check) -> DataFrame:
    rows = projected(spark, sf_dir)
    return quality.evaluate(rows, check(rows, STATISTICS_TABLE, QualityRules(max_null_pct=1.0)))


@query(
    with_(
        BRONZE,
        """SELECT 'row_count' AS check_name, CAST(count(*) AS DOUBLE) AS value, 10e0 AS threshold,
                  count(*) >= 10 AS passed, count(*) || ' rows, at least 10 wanted' AS message
           FROM bronze""",
    )
)
def dq_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = _statistics_report(spark, sf_dir, quality.row_count_check)
    return report.select(F.col("check").alias("check_name"), "value", "threshold", "passed", "message")


def _null_pct_sql(column: str) -> str:
    share = f"(count(*) - count({column})) * 100e0 / count(*)"
    return f"""SELECT 'null_pct' AS check_name, '{column}' AS column_name, round({share}, 2) AS value,
                      1e0 AS threshold, {share} <= 1 AS passed FROM bronze"""


@query(
    with_(
        BRONZE,
        " UNION ALL ".join(map(_null_pct_sql, ("video_id", "title", "channel_title", "views", "region"))),
    )
)
def dq_null_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Against a limit of one percent, which the video id misses."""
    return _report(_statistics_report(spark, sf_dir, quality.null_pct_check))


@query(
    """SELECT 'schema' AS check_name, 'region, title, video_id, views' AS missing, false AS passed,
              count(*) AS rows FROM lineitem"""
)
def dq_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table with one of the critical columns, checked together with its row count."""
    rows = inputs.table(spark, sf_dir, "lineitem").withColumnRenamed("l_returnflag", "channel_title")
    rules = QualityRules()
    checks = [
        *quality.schema_check(rows, STATISTICS_TABLE, rules),
        *quality.row_count_check(rows, STATISTICS_TABLE, rules),
    ]
    report = quality.evaluate(rows, checks)
    return report.groupBy().agg(
        F.max(F.when(F.col("check") == "schema", F.col("check"))).alias("check_name"),
        F.max(F.array_join("missing_columns", ", ")).alias("missing"),
        F.bool_and(F.when(F.col("check") == "schema", F.col("passed"))).alias("passed"),
        F.max("value").cast("bigint").alias("rows"),
    )


@query(
    with_(
        BRONZE,
        """SELECT 'value_range' AS check_name, 'views' AS column_name,
                  count(*) FILTER (views - 20000 < 0) AS negative_count,
                  count(*) FILTER (views - 20000 > 50000) AS extreme_count,
                  false AS passed
           FROM bronze""",
    )
)
def dq_value_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shifted views against a lower limit, so that both counts are above zero."""
    rows = projected(spark, sf_dir).withColumn("views", F.col("views") - 20_000)
    checks = quality.value_range_check(rows, STATISTICS_TABLE, QualityRules(max_views=50_000))
    return quality.evaluate(rows, checks).select(
        F.col("check").alias("check_name"),
        F.col("column").alias("column_name"),
        "negative_count",
        "extreme_count",
        "passed",
    )


@query(
    f"""SELECT event_type, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS latest_record,
               strftime(TIMESTAMP '{FIXED_NOW}' - INTERVAL 48 HOUR, '%Y-%m-%d %H:%M:%S') AS cutoff,
               max(ts) >= TIMESTAMP '{FIXED_NOW}' - INTERVAL 48 HOUR AS passed
        FROM (SELECT 'all' AS event_type, ts FROM events
              UNION ALL SELECT 'old', ts FROM events WHERE ts < TIMESTAMP '2024-01-15')
        GROUP BY event_type"""
)
def dq_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events, and those of the first half of the month only, seen from a fixed time."""
    events = inputs.table(spark, sf_dir, "events").withColumnRenamed("ts", "_processed_at")
    now = F.lit(FIXED_NOW).cast("timestamp")

    def check(rows: DataFrame, name: str) -> DataFrame:
        report = quality.evaluate(rows, quality.freshness_check(rows, name, QualityRules(), now))
        text = [F.substring(c, 1, 19).alias(c) for c in ("latest_record", "cutoff")]
        return report.select(F.col("table").alias("event_type"), *text, "passed")

    old = events.filter(F.col("_processed_at") < F.lit("2024-01-15").cast("timestamp_ntz"))
    return check(events, "all").unionByName(check(old, "old"))


def _reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = F.lit(FIXED_NOW).cast("timestamp")
    rules = QualityRules(max_null_pct=1.0)
    tables = {
        STATISTICS_TABLE: projected(spark, sf_dir),
        REFERENCE_TABLE: inputs.reference_rows(spark, sf_dir),
    }
    reports = [quality.check_table(frame, name, rules, now) for name, frame in tables.items()]
    return reduce(DataFrame.unionByName, reports)


_SUMMARY = f"""{BRONZE},{REFERENCE},
results AS (
    SELECT count(*) >= 10 AS passed FROM bronze
    UNION ALL SELECT (count(*) - count(video_id)) * 100e0 / count(*) <= 1 FROM bronze
    UNION ALL SELECT (count(*) - count(title)) * 100e0 / count(*) <= 1 FROM bronze
    UNION ALL SELECT (count(*) - count(channel_title)) * 100e0 / count(*) <= 1 FROM bronze
    UNION ALL SELECT (count(*) - count(views)) * 100e0 / count(*) <= 1 FROM bronze
    UNION ALL SELECT (count(*) - count(region)) * 100e0 / count(*) <= 1 FROM bronze
    UNION ALL SELECT true
    UNION ALL SELECT count(*) FILTER (views < 0) = 0 AND count(*) FILTER (views > 50000000000) = 0 FROM bronze
    UNION ALL SELECT true
    UNION ALL SELECT count(*) >= 10 FROM reference
    UNION ALL SELECT (count(*) - count(id)) * 100e0 / count(*) <= 1 FROM reference
    UNION ALL SELECT (count(*) - count(region)) * 100e0 / count(*) <= 1 FROM reference
    UNION ALL SELECT true
    UNION ALL SELECT to_timestamp(max(position) + 1704067200) >=
        TIMESTAMPTZ '{FIXED_NOW}+00' - INTERVAL 48 HOUR FROM reference
)"""


@query(
    with_(
        _SUMMARY,
        """SELECT bool_and(passed) AS quality_passed, count(*) FILTER (passed) AS checks_passed,
                  count(*) AS checks_total FROM results""",
    )
)
def dq_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All checks of both tables and their totals."""
    return quality.check_summary(_reports(spark, sf_dir))


@query(
    with_(
        _SUMMARY,
        f"""SELECT 'null_pct' AS check_name, '{STATISTICS_TABLE}' AS table_name,
                   'quality check failed - {STATISTICS_TABLE} - null_pct' AS subject, 'video_id' AS failed_column,
                   round((count(*) - count(video_id)) * 100e0 / count(*), 2) AS value
            FROM bronze HAVING (count(*) - count(video_id)) * 100e0 / count(*) > 1
            UNION ALL
            SELECT 'freshness', '{REFERENCE_TABLE}', 'quality check failed - {REFERENCE_TABLE} - freshness',
                   NULL, NULL FROM reference
            HAVING to_timestamp(max(position) + 1704067200) < TIMESTAMPTZ '{FIXED_NOW}+00' - INTERVAL 48 HOUR""",
    )
)
def failed_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failed report rows as JSON, read back here for two of their fields."""
    rows = failed_checks_json(_reports(spark, sf_dir))
    return rows.select(
        F.col("check").alias("check_name"),
        F.col("table").alias("table_name"),
        "subject",
        F.get_json_object("details", "$.column").alias("failed_column"),
        F.get_json_object("details", "$.value").cast("double").alias("value"),
    )


@query(
    with_(
        SILVER,
        """SELECT 'default' AS gate, region, count(*) AS videos FROM silver GROUP BY region""",
    )
)
def quality_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two gates before the same rollup; the one that asks for more rows stays shut."""
    silver = materialize(silver_frame(spark, sf_dir), "silver")
    gates = {"default": QualityRules(), "unreachable": QualityRules(min_rows=1 << 60)}
    built = silver.groupBy("region").agg(F.count(F.lit(1)).alias("videos"))
    opened = []
    for name, rules in gates.items():
        report = quality.run_checks(spark, {STATISTICS_TABLE: lambda: silver}, rules)
        if quality.quality_gate(report):
            opened.append(built.select(F.lit(name).alias("gate"), "region", "videos"))
    return reduce(DataFrame.unionByName, opened)


def _gold_rows(spark: SparkSession, gold: str) -> DataFrame:
    """All rows of the three gold tables with all their columns."""

    def rows(name: str) -> DataFrame:
        frame = spark.read.schema(rollups.GOLD_TABLES[name][1]).parquet(f"{gold}/{name}")
        frame = frame.withColumn("stamped", F.col("_aggregated_at").isNotNull()).drop("_aggregated_at")
        return frame.withColumn("table_name", F.lit(name))

    channels = _joined_text(rows("channel_analytics"))
    frames = (rows("trending_analytics"), channels, rows("category_analytics"))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _gold_sql(ctes: str, source: str) -> str:
    parts = {"trending": TRENDING, "channel": CHANNEL, "category": CATEGORY}
    bodies = " UNION ALL BY NAME ".join(
        f"SELECT *, true AS stamped, '{name}_analytics' AS table_name FROM ({sql.format(source=source)})"
        for name, sql in parts.items()
    )
    return f"WITH {ctes.strip()}\n{bodies}"


@query(_gold_sql(ENRICHED, "enriched"))
def silver_to_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gold job: three tables replaced as a whole, then read back with every row."""
    gold = new_folder(spark, "gold")
    silver = materialize(silver_frame(spark, sf_dir).select(*rollups.READ_COLUMNS), "silver")
    run_gold(silver, lambda: inputs.reference_rows(spark, sf_dir), gold)
    return _gold_rows(spark, gold)


@query(_gold_sql(ENRICHED, "enriched"))
def gold_after_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold kept up to date: built over other statistics first, then following the days that change.

    At first every third month has other counts and channels and lacks half of its rows, and each region has a day
    that goes away. Only the changed days are read again, yet gold is that of the final statistics.
    """
    silver, state, gold = (new_folder(spark, label) for label in ("silver", "state", "gold"))
    final = materialize(silver_frame(spark, sf_dir), "silver")
    third = F.coalesce(F.month("trending_date_parsed") % 3 == 0, F.lit(False))
    early = final.filter(~third | (F.col("views") % 2 == 0)).withColumns(
        {
            "views": F.when(third, F.col("views") + 1_000_000).otherwise(F.col("views")),
            "channel_title": F.when(third & (F.col("views") % 5 == 0), F.lit("passing")).otherwise(F.col("channel_title")),
        }
    )
    vanishing = final.filter(F.month("trending_date_parsed") == 1).withColumn("trending_date_parsed", F.lit("1999-01-01").cast("date"))
    first = early.unionByName(vanishing.dropDuplicates(["video_id", "region"]))
    write_partitions(first, silver, SILVER_PARTITIONS)

    def loader() -> DataFrame:
        return inputs.reference_rows(spark, sf_dir)

    def stored() -> DataFrame:
        return spark.read.schema(SILVER_STATISTICS).parquet(silver)

    update_gold(stored(), loader, stored(), state, gold)
    changed = materialize(first.filter(third | (F.year("trending_date_parsed") == 1999)).select(*SILVER_PARTITIONS).distinct(), "changed")
    write_partitions(final.filter(third), silver, SILVER_PARTITIONS)
    gone = changed.filter(F.year("trending_date_parsed") == 1999).collect()  # one row a region
    remove_folders(spark, [partition_folder(spark, silver, row.asDict()) for row in gone])
    changed = changed.unionByName(final.filter(third).select(*SILVER_PARTITIONS).distinct())
    update_gold(stored(), loader, changed, state, gold)
    return _gold_rows(spark, gold)


# In one run all reference rows are ingested at the same time: the greatest name of an id counts.
_LANDED_LOOKUP = f"""{REFERENCE},
last_names AS (
    SELECT region, id, arg_max(snippet_title, position) AS snippet_title FROM reference GROUP BY region, id
),
lookup AS (
    SELECT CAST(id AS BIGINT) AS category_id, max(snippet_title) AS category_name FROM last_names GROUP BY id
)"""

_NAMED = f"""{SILVER_OF_TEXT},{_LANDED_LOOKUP},
named AS (
    SELECT silver.*, coalesce(category_name, 'Unknown') AS category_name
    FROM silver LEFT JOIN lookup ON silver.category_id = lookup.category_id
)"""


def _landed(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, str]:
    """Fresh folders, with the statistics as CSV in that of the first name."""
    folders = {name: new_folder(spark, f"all-{name}") for name in names}
    _write_csv(inputs.bronze_files(inputs.bronze_statistics(spark, sf_dir)), folders[names[0]])
    return folders


@query(_gold_sql(_NAMED, "named"))
def run_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files to gold through the quality gate, with the names of the landed reference data."""
    folders = _landed(spark, sf_dir, "stats", "reference", "silver", "gold")
    documents = inputs.reference_documents(spark, sf_dir)
    landed_at = F.timestamp_seconds(F.lit(inputs.REFERENCE_EPOCH))
    land_reference_json(documents, folders["reference"], landed_at, "page")
    run_medallion(spark, folders["stats"], folders["reference"], folders["silver"], folders["gold"])
    return _gold_rows(spark, folders["gold"])


_UNNAMED = f"""{SILVER_OF_TEXT},
named AS (SELECT silver.*, 'Unknown' AS category_name FROM silver)"""


@query(_gold_sql(_UNNAMED, "named"))
def run_all_without_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same without any reference folder: the run goes on and every category is unknown."""
    folders = _landed(spark, sf_dir, "stats", "silver", "gold")
    run_medallion(spark, folders["stats"], new_folder(spark, "no-reference"), folders["silver"], folders["gold"])
    return _gold_rows(spark, folders["gold"])


@query(
    f"""SELECT 'read_table' AS check_name, 'broken' AS table_name, false AS passed, NULL::DOUBLE AS value
        UNION ALL SELECT 'row_count', 'lineitem', count(*) >= 10, count(*)::DOUBLE FROM lineitem
        UNION ALL SELECT 'schema', 'lineitem', true, NULL
        UNION ALL SELECT 'freshness', 'lineitem', true, NULL"""
)
def check_readable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table whose files are unreadable is a failed row; the other table is checked all the same."""
    broken = new_folder(spark, "broken")
    inputs.table(spark, sf_dir, "region").write.option("compression", "none").csv(broken)
    tables = {
        "broken": lambda: spark.read.schema("n bigint").option("pathGlobFilter", "*.csv").parquet(broken),
        "lineitem": lambda: inputs.table(spark, sf_dir, "lineitem"),
    }
    report = quality.run_checks(spark, tables, QualityRules())
    return report.select(F.col("check").alias("check_name"), F.col("table").alias("table_name"), "passed", "value")
