"""Queries over the statistics branch: projection, cleaning, deduplication, files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlake import schemas
from trendlake.config import STATISTICS_TABLE, QualityRules
from trendlake.functions import cleaning, clock
from trendlake.functions.columns import flatten_struct
from trendlake.functions.paths import decode_key, region_of_path
from trendlake.operators import clean, normalize
from trendlake.operators.quality import evaluate, row_count_check, value_range_check
from trendlake.operators.quality import null_counts as count_nulls
from trendlake.plans.silver import STORE_SCHEMA
from trendlake.plans.silver import bronze_to_silver_statistics as run_statistics
from trendlake.sinks.landing import land_raw_json, landing_metadata as add_metadata
from trendlake.sinks.reports import region_outcomes as outcomes
from trendlake.sinks.reports import run_summary as summarize
from trendlake.sinks.tables import write_partitions
from trendlake.sources.quarantine import split_quarantine
from trendlake.sources.files import json_texts
from trendlake.sources.statistics import api_documents, explode_items
from trendlake.sources.statistics import read_stats_api_json as read_api
from trendlake.sources.statistics import read_stats_csv as read_csv
from trendlake.sources.tables import read_table
from trendlake.sources.tables import region_pruned_scan as prune
from trendlake.staging import brief_shuffles, new_folder
from trendlake.streaming.incremental import incremental_statistics as run_new_statistics
from trendlake.workload import inputs
from trendlake.workload.oracle_ctes import (
    API,
    BRONZE,
    BRONZE_TEXT,
    SILVER,
    SILVER_OF_TEXT,
    STANDARD,
    silver,
    standard,
    with_,
)
from trendlake.workload.registry import query

SILVER_COLUMNS = [name for name in schemas.SILVER_STATISTICS.names if name not in ("_processed_at", "_job_name")]
TEN = ", ".join(schemas.STATISTICS.names)

_OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"
# Tasks that regions of one file each are dealt out to; more regions share tasks.
_REGION_TASKS = 64


def projected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.project_csv(inputs.bronze_statistics(spark, sf_dir))


def silver_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.silver_statistics(projected(spark, sf_dir), "workload")


def _write_csv(rows: DataFrame, folder: str, mode: str = "errorifexists", one_file: bool = False) -> None:
    """Rows as CSV below a folder for each region; with ``one_file`` in a single file each, which tasks of their own write.

    A task then keeps a file open for each of its regions instead of sorting its rows by region, so what it
    holds does not grow with them.
    """
    spark = rows.sparkSession
    before = spark.conf.get(_OPEN_FILES)
    if one_file:
        rows = rows.repartition(_REGION_TASKS, "region")
        spark.conf.set(_OPEN_FILES, _REGION_TASKS)
    try:
        with brief_shuffles(spark):
            rows.write.mode(mode).option("header", True).option("escape", '"').partitionBy("region").csv(folder)
    finally:
        spark.conf.set(_OPEN_FILES, before)


def _land_documents(spark: SparkSession, sf_dir: str, label: str) -> str:
    """API documents as files, landed at the start of their day: one folder per region and day."""
    folder = new_folder(spark, label)
    documents = inputs.api_documents(spark, sf_dir).withColumn("landed_at", F.date_trunc("day", "landed_at"))
    land_raw_json(documents.drop("page"), folder, F.col("landed_at"))
    return folder


@query(with_(f"{BRONZE},{BRONZE_TEXT}", f"SELECT {TEN} FROM bronze_text"))
def project_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.project_csv(inputs.bronze_text(inputs.bronze_statistics(spark, sf_dir)))


@query(with_(BRONZE, "SELECT video_id, title, region FROM bronze WHERE video_id IS NOT NULL"))
def drop_null_video_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.drop_null_video_id(projected(spark, sf_dir)).select("video_id", "title", "region")


@query(with_(BRONZE, "SELECT video_id, lower(trim(region)) AS region FROM bronze"))
def normalize_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.normalize_region(projected(spark, sf_dir)).select("video_id", "region")


@query(with_(STANDARD, "SELECT video_id, trending_date, trending_date_parsed FROM standard"))
def parse_trending_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = projected(spark, sf_dir).transform(clean.drop_null_video_id).transform(clean.parse_trending_date)
    return rows.select("video_id", "trending_date", "trending_date_parsed")


@query(
    with_(
        BRONZE,
        """SELECT video_id, coalesce(views, 0) AS views, coalesce(likes, 0) AS likes,
                  coalesce(comment_count, 0) AS comment_count FROM bronze""",
    )
)
def coalesce_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.coalesce_counts(projected(spark, sf_dir)).select("video_id", *clean.COUNTS)


@query(
    with_(
        STANDARD,
        """SELECT video_id, views, likes, comment_count,
                  CASE WHEN views > 0 THEN round(likes / views * 100, 4) ELSE 0e0 END AS like_ratio,
                  CASE WHEN views > 0 THEN round((likes + comment_count) / views * 100, 4) ELSE 0e0 END
                      AS engagement_rate
           FROM standard""",
    )
)
def derive_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = clean.clean_statistics(projected(spark, sf_dir))
    return rows.select("video_id", *clean.COUNTS, "like_ratio", "engagement_rate")


@query(with_(SILVER, f"SELECT {', '.join(SILVER_COLUMNS)} FROM silver"))
def dedup_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_frame(spark, sf_dir).select(*SILVER_COLUMNS)


@query(
    """SELECT user_id, event_type, day, event_id, value FROM (
           SELECT *, CAST(ts AS DATE) AS day, row_number() OVER (
               PARTITION BY user_id, event_type, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS place
           FROM events)
       WHERE place = 1"""
)
def dedup_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The deduplication with other keys and a latest-first order."""
    events = inputs.table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    order = [F.col("ts").desc(), F.col("event_id").desc()]
    latest = clean.keep_first(events, ["user_id", "event_type", "day"], order)
    return latest.select("user_id", "event_type", "day", "event_id", "value")


@query(
    with_(
        SILVER,
        """SELECT video_id, region, views FROM silver WHERE region IN ('asia', 'europe')""",
    )
)
def region_pruned_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A partitioned silver table read for two regions only."""
    folder = new_folder(spark, "pruned")
    write_partitions(silver_frame(spark, sf_dir), folder)
    table = read_table(spark, path=folder, schema=schemas.SILVER_STATISTICS)
    return prune(table, ["asia", "europe"]).select("video_id", "region", "views")


@query(
    """SELECT 'value_range' AS check_name, count(*) AS rows, count(*) FILTER (l_orderkey > 1000) AS negative_count,
              count(*) FILTER (l_orderkey > 1000) = 0 AS passed
       FROM lineitem"""
)
def sample_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checks look at the whole table: all rows are counted, whatever their place in it.

    The first orders are fine and all later ones negative, which a look at some rows could miss.
    """
    rows = inputs.table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_orderkey") > 1000, F.lit(-1)).otherwise(F.lit(1)).cast("bigint").alias("views")
    )
    report = evaluate(
        rows,
        [
            *value_range_check(rows, STATISTICS_TABLE, QualityRules()),
            *row_count_check(rows, STATISTICS_TABLE, QualityRules()),
        ],
    )
    ranged = F.col("check") == "value_range"
    return report.agg(
        F.lit("value_range").alias("check_name"),
        F.max("value").cast("bigint").alias("rows"),
        F.max("negative_count").alias("negative_count"),
        F.bool_and(F.when(ranged, F.col("passed"))).alias("passed"),
    )


@query(
    with_(
        BRONZE,
        """SELECT * FROM (
               SELECT 'video_id' AS "column", count(*) - count(video_id) AS null_count FROM bronze
               UNION ALL SELECT 'title', count(*) - count(title) FROM bronze
               UNION ALL SELECT 'likes', count(*) - count(likes) FROM bronze)""",
    )
)
def null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_nulls(projected(spark, sf_dir), ("video_id", "title", "likes"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS \"props.k\" FROM events")
def flatten_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON text to a struct, then one column per leaf."""
    events = inputs.table(spark, sf_dir, "events")
    nested = events.select("event_id", F.from_json("props", "k bigint").alias("props"))
    return flatten_struct(nested)


@query(with_(API, f"SELECT {TEN} FROM api"))
def project_api(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = inputs.api_documents(spark, sf_dir).withColumnRenamed("landed_at", "_landed_at")
    return normalize.project_api(explode_items(documents))


@query(
    with_(
        f"{BRONZE},{API}",
        f"SELECT {TEN} FROM bronze UNION ALL SELECT {TEN} FROM api",
    )
)
def unify_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = inputs.api_documents(spark, sf_dir).withColumnRenamed("landed_at", "_landed_at")
    return normalize.unify_formats(inputs.bronze_statistics(spark, sf_dir), explode_items(documents))


@query(
    """SELECT event_type AS region, event_id // 50 AS page,
              strftime(max(ts), '%Y%m%d_%H%M%S') AS run_id,
              strftime(max(ts), '%Y-%m-%d') AS date, strftime(max(ts), '%H') AS hour,
              count(*) AS video_count
       FROM events GROUP BY event_type, CAST(ts AS DATE), event_id // 50"""
)
def landing_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = inputs.api_documents(spark, sf_dir)
    landed = add_metadata(documents, F.col("landed_at"))
    return landed.select(
        "region", "page", F.col("_metadata.run_id").alias("run_id"), "date", "hour",
        F.col("_metadata.video_count").alias("video_count"),
    )


@query(with_(API, f"SELECT {TEN} FROM api"))
def read_stats_api_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses landed as lines, and others as whole files of several objects, below one root."""
    folder = new_folder(spark, "api")
    documents = inputs.api_documents(spark, sf_dir).withColumn("landed_at", F.date_trunc("day", "landed_at"))
    as_lines = F.col("page") % 2 == 0
    land_raw_json(documents.filter(as_lines).drop("page"), folder, F.col("landed_at"))
    others = add_metadata(documents.filter(~as_lines), F.col("landed_at"))
    text = F.to_json(F.struct("items", "_metadata"), {"pretty": "true"})
    files = others.select("region", "date", text.alias("value"))
    files.write.mode("append").partitionBy("region", "date").text(folder)
    good, _ = split_quarantine(read_api(spark, folder))
    texts = json_texts(spark.read, folder, "document", "*.txt")
    more, _ = split_quarantine(api_documents(texts))
    return normalize.project_api(explode_items(good.unionByName(more)))


@query(
    with_(
        f"{BRONZE},{BRONZE_TEXT}",
        f"SELECT * REPLACE (lower(trim(region)) AS region) FROM (SELECT {TEN} FROM bronze_text)",
    )
)
def read_stats_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics written as CSV by region folder, read back and projected."""
    folder = new_folder(spark, "csv")
    _write_csv(inputs.bronze_files(inputs.bronze_statistics(spark, sf_dir)), folder)
    return normalize.project_csv(read_csv(spark, folder))


@query(
    """SELECT event_type AS region, count(*) AS items, count(DISTINCT (CAST(ts AS DATE), event_id // 50)) AS documents,
              CASE WHEN event_id // 50 % 7 = 3 THEN 'malformed JSON' ELSE 'good' END AS outcome
       FROM events GROUP BY 1, 4"""
)
def quarantine_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh page cut short: the others still go through.

    The size of a broken document is written beside it, as it cannot be read any more.
    """
    folder = new_folder(spark, "quarantine")
    documents = inputs.api_documents(spark, sf_dir)
    text = F.to_json(F.struct("items"))
    broken = F.col("page") % 7 == 3
    lines = documents.select(
        F.when(broken, F.concat(F.lit('{"items": [ '), F.size("items").cast("string"))).otherwise(text).alias("value"),
        "region",
    )
    lines.write.partitionBy("region").option("compression", "none").text(folder)
    raw = api_documents(json_texts(spark.read, folder, "lines", "*.txt"))
    good, bad = split_quarantine(raw.withColumn("size", F.size("items")))
    kept = good.groupBy("region").agg(
        F.sum("size").cast("bigint").alias("items"), F.count(F.lit(1)).alias("documents")
    )
    sizes = raw.filter(F.col(schemas.CORRUPT_COLUMN).isNotNull()).select(
        "region", F.regexp_extract(schemas.CORRUPT_COLUMN, r"(\d+)$", 1).cast("bigint").alias("size")
    )
    errors = bad.groupBy("region", F.col("error").alias("outcome")).agg(F.count(F.lit(1)).alias("documents"))
    lost = sizes.groupBy("region").agg(F.sum("size").alias("items")).join(errors, "region")
    columns = ["region", "items", "documents", "outcome"]
    return kept.withColumn("outcome", F.lit("good")).select(columns).unionByName(lost.select(columns))


@query(
    """SELECT lower(r_name) AS region, count(*) AS files
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
       JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
       WHERE l_partkey % 97 <> 0 GROUP BY 1
       UNION ALL
       SELECT 'unknown', count(*)
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
       JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
       WHERE l_partkey % 97 = 0"""
)
def region_from_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URL-encoded object keys; rows without a video id have no region folder."""
    rows = projected(spark, sf_dir).withColumn("region", F.lower(F.trim("region")))
    folder = F.when(
        F.col("video_id").isNotNull(), F.concat(F.lit("raw+files/region%3D"), F.col("region"))
    ).otherwise(F.lit("raw+files/nowhere"))
    key = decode_key(F.concat(folder, F.lit("/date%3D2024-01-01/a+b.json")))
    return rows.groupBy(region_of_path(key).alias("region")).agg(F.count(F.lit(1)).alias("files"))


@query(
    with_(
        SILVER,
        f"""SELECT * REPLACE (CASE WHEN region < 'asia' THEN views + 1 ELSE views END AS views)
            FROM (SELECT {', '.join(SILVER_COLUMNS)} FROM silver)
            WHERE NOT (region < 'asia' AND views % 2 = 0)""",
    )
)
def write_read_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The silver table written by region; a second run replaces two regions by other rows.

    In those the even rows are gone and the odd ones changed; the other regions stay.
    """
    folder = new_folder(spark, "roundtrip")
    write_partitions(silver_frame(spark, sf_dir), folder)
    first = read_table(spark, path=folder)
    again = first.filter((F.col("region") < "asia") & (F.col("views") % 2 != 0))
    write_partitions(again.withColumn("views", F.col("views") + 1), folder)
    return read_table(spark, path=folder, schema=schemas.SILVER_STATISTICS).select(*SILVER_COLUMNS)


@query(with_(BRONZE, "SELECT channel_title AS _source_file, region, count(*) AS rows FROM bronze GROUP BY 1, 2"))
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per source and region, the channel standing for the file."""
    return summarize(projected(spark, sf_dir).withColumnRenamed("channel_title", "_source_file"))


@query(
    """SELECT event_type AS region, sum(CASE WHEN event_type = 'error' AND value > 10 THEN 1 ELSE 0 END)::BIGINT AS errors,
              CASE WHEN sum(CASE WHEN event_type = 'error' AND value > 10 THEN 1 ELSE 0 END) = 0
                   THEN 'success' ELSE 'failed' END AS outcome
       FROM events GROUP BY event_type"""
)
def region_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as landings by type, of which some of type ``error`` failed."""
    events = inputs.table(spark, sf_dir, "events").withColumnRenamed("event_type", "region")
    failed = (F.col("region") == "error") & (F.col("value") > 10)
    errors = events.filter(failed).select("region", F.lit("x").alias("error"))
    return outcomes(events.filter(~failed), errors)


@query(
    """SELECT event_id, strftime(ts, '%Y%m%d_%H%M%S') AS run_id, strftime(ts, '%Y-%m-%d') AS date,
              strftime(ts, '%H') AS hour, strftime(ts - INTERVAL 48 HOUR, '%Y-%m-%d %H:%M:%S') AS cutoff,
              strftime(ts, '%Y-%m-%dT%H:%M:%S') AS parsed,
              substr(repeat(event_type || ' ', 30), 1, 100) AS subject,
              lower(trim(event_type)) AS region,
              '{"user_id":' || user_id || ',"type":"' || event_type || '"}' AS details
       FROM events"""
)
def scalar_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Formatting, parsing and shifting instants; subjects, regions and JSON text."""
    ts = F.col("ts").cast("timestamp")
    wide = F.repeat(F.concat("event_type", F.lit(" ")), 30)
    seconds = "yyyy-MM-dd'T'HH:mm:ss"
    return inputs.table(spark, sf_dir, "events").select(
        "event_id",
        clock.run_id(ts).alias("run_id"),
        clock.day_text(ts).alias("date"),
        clock.hour_text(ts).alias("hour"),
        F.date_format(clock.hours_before(ts, 48), "yyyy-MM-dd HH:mm:ss").alias("cutoff"),
        F.date_format(clock.instant(clock.iso_text(ts)), seconds).alias("parsed"),
        clock.subject_line(wide).alias("subject"),
        cleaning.landing_region(F.concat(F.lit("\t"), F.upper("event_type"), F.lit(" \n"))).alias("region"),
        F.to_json(F.struct("user_id", F.col("event_type").alias("type"))).alias("details"),
    )


@query(
    with_(
        SILVER,
        """SELECT region, count(*) AS rows, count(*) AS processed_rows, 1::BIGINT AS job_names
           FROM silver GROUP BY region""",
    )
)
def audit_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every silver row carries its processing time and the one job name."""
    return silver_frame(spark, sf_dir).groupBy("region").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("_processed_at").alias("processed_rows"),
        F.count_distinct("_job_name").alias("job_names"),
    )


_BOTH = f"""{BRONZE},{BRONZE_TEXT},{API},
landed AS (
    SELECT * REPLACE (lower(trim(region)) AS region), CAST(NULL AS TIMESTAMP) AS landed_at FROM bronze_text
    UNION ALL SELECT * REPLACE (date_trunc('day', landed_at) AS landed_at) FROM api
),{standard("landed", landed=True)},{silver(landed=True)}"""


@query(with_(_BOTH, f"SELECT {', '.join(SILVER_COLUMNS)} FROM silver"))
def bronze_to_silver_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job on files: CSV history beside landed documents, of mixed folder depth."""
    bronze, target = _land_documents(spark, sf_dir, "bronze"), new_folder(spark, "silver")
    _write_csv(inputs.bronze_files(inputs.bronze_statistics(spark, sf_dir)), bronze, "append")
    run_statistics(spark, bronze, target)
    return read_table(spark, path=target, schema=schemas.SILVER_STATISTICS).select(*SILVER_COLUMNS)


@query(with_(SILVER_OF_TEXT, f"SELECT {', '.join(SILVER_COLUMNS)} FROM silver"))
def incremental_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two drops of files, merged one after the other, give the table of one batch.

    The second drop holds part of the latest days, so only those are merged again.
    """
    bronze, store, checkpoint = (new_folder(spark, label) for label in ("drops", "store", "progress"))
    rows = inputs.bronze_files(inputs.bronze_statistics(spark, sf_dir))
    late = (F.col("title") >= "m") & (F.col("publish_time") >= "2001-03")
    for drop in (rows.filter(~late), rows.filter(late)):
        _write_csv(with_more_columns(drop), bronze, "append")
        run_new_statistics(spark, bronze, store, checkpoint, source="csv")
    return spark.read.schema(STORE_SCHEMA).parquet(store).select(*SILVER_COLUMNS)


def with_more_columns(rows: DataFrame) -> DataFrame:
    """Columns as historic files have them, among those the statistics need."""
    first, *others = [c for c in rows.columns if c != "region"]
    return rows.select(first, F.lit("x|y").alias("tags"), *others, F.lit("0").alias("dislikes"), "region")


@query(with_(_BOTH, f"SELECT {', '.join(SILVER_COLUMNS)} FROM silver"))
def batch_then_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch job over the CSV history, then landed documents merged into the same table."""
    csv, store, checkpoint = (new_folder(spark, label) for label in ("history", "store", "progress"))
    _write_csv(inputs.bronze_files(inputs.bronze_statistics(spark, sf_dir)), csv)
    run_statistics(spark, csv, store)
    run_new_statistics(spark, _land_documents(spark, sf_dir, "landed"), store, checkpoint)
    return spark.read.schema(STORE_SCHEMA).parquet(store).select(*SILVER_COLUMNS)


@query(
    """SELECT event_type AS region, event_id // 50 % 7 = 3 AS broken, count(*) AS items,
              CASE WHEN event_id // 50 % 7 = 3 THEN 'malformed JSON' END AS error,
              CASE WHEN event_id // 50 % 7 = 3 THEN count(DISTINCT (CAST(ts AS DATE), event_id // 50)) END AS documents
       FROM events GROUP BY 1, 2, 4"""
)
def statistics_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broken documents beside good ones: the good rows are written, the others reported.

    Every item is a day and id of its own here, so that no row is lost to deduplication.
    """
    folder, store = new_folder(spark, "broken"), new_folder(spark, "silver")
    documents = inputs.api_documents(spark, sf_dir, unique=True)
    broken = F.col("page") % 7 == 3
    documents.filter(~broken).select("items", "region").write.partitionBy("region").json(folder)
    cut = documents.filter(broken).select(F.lit("cut short").alias("items"), "region")
    cut.write.mode("append").partitionBy("region").json(folder)
    done = run_statistics(spark, folder, store)
    kept = spark.read.schema(STORE_SCHEMA).parquet(store).groupBy("region").agg(F.count(F.lit(1)).alias("items"))
    sizes = documents.filter(broken).groupBy("region").agg(F.sum(F.size("items")).cast("bigint").alias("items"))
    errors = done.errors.groupBy("region", "error").agg(F.count(F.lit(1)).alias("documents"))
    good = kept.select("region", F.lit(False).alias("broken"), "items", F.lit(None).cast("string").alias("error"), F.lit(None).cast("bigint").alias("documents"))
    bad = sizes.join(errors, "region").select("region", F.lit(True).alias("broken"), "items", "error", "documents")
    return good.unionByName(bad)


@query(
    """SELECT 'nothing' AS run, true AS skipped, 0::BIGINT AS rows_read, 0::BIGINT AS rows_written
       UNION ALL SELECT 'no id', false, NULL, 0
       UNION ALL SELECT 'events', false, count(*), count(*) FROM events"""
)
def empty_input_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run without files is skipped, one without ids writes nothing, one with all writes all."""
    csv = inputs.table(spark, sf_dir, "events").select(
        F.concat(F.lit("v"), F.col("event_id")).alias("video_id"),
        F.date_format("ts", "yyyy-MM-dd").alias("trending_date"),
        *(F.lit("x").alias(c) for c in ("title", "channel_title", "category_id", "publish_time")),
        *(F.lit("1").alias(c) for c in ("views", "likes", "comment_count")),
        F.col("event_type").alias("region"),
    )
    runs = []
    for name, rows in (("nothing", None), ("no id", csv.withColumn("video_id", F.lit(None).cast("string"))), ("events", csv)):
        bronze, store = new_folder(spark, "guard"), new_folder(spark, "silver")
        if rows is not None:
            _write_csv(rows, bronze)
        done = run_statistics(spark, bronze, store)
        runs.append((name, done.skipped, done.rows_read, done.rows_written))
    return spark.createDataFrame(runs, "run string, skipped boolean, rows_read bigint, rows_written bigint")
