"""Bronze to silver: statistics and category reference data."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendlake import schemas
from trendlake.operators.clean import dedup_statistics, finished_silver, standardize
from trendlake.operators.normalize import unify_formats
from trendlake.operators.reference import missing_fields, newest_landing_per_region, silver_reference
from trendlake.schemas import SILVER_PARTITIONS
from trendlake.sinks.reports import RowMetrics, new_run_id, run_summary, write_run_rows
from trendlake.sinks.tables import register_table, write_partitions
from trendlake.sources.csv_records import read_csv_files
from trendlake.sources.files import optional_frame
from trendlake.sources.quarantine import split_quarantine
from trendlake.sources.reference import read_reference_json
from trendlake.sources.statistics import CSV_COLUMNS, explode_items, read_stats_api_json
from trendlake.staging import cleared_staging, materialize, remove_folders

# What batch and incremental runs store: the silver columns and the landing time, which decides
# between duplicates of different runs.
STORE_SCHEMA = T.StructType([*schemas.SILVER_STATISTICS.fields, schemas.LANDED_AT])
# The same for the reference table: the landing of a row and its place, by which runs are united.
REFERENCE_STORE_SCHEMA = T.StructType(
    [
        *schemas.SILVER_REFERENCE.fields,
        schemas.LANDED_AT,
        T.StructField("_landing", T.StringType()),
        T.StructField("_page", T.LongType()),
        T.StructField("_pos", T.IntegerType()),
    ]
)
ERRORS = T.StructType([T.StructField(name, T.StringType()) for name in ("_source_file", "region", "error")])


class LayoutError(RuntimeError):
    """The folder holds a table with other partitions than this job writes."""


@dataclass(frozen=True)
class StatisticsRun:
    """What a statistics run did; ``skipped`` when there was nothing to read.

    ``rows_read`` is None when no row had an id, as nothing was then counted. ``errors`` has
    a row for each document or CSV file that could not be used; it reads what is stored beside the table.
    """

    errors: DataFrame
    run_id: str
    skipped: bool = False
    rows_read: int | None = 0
    rows_written: int = 0
    null_counts: dict[str, int] = field(default_factory=dict)


@dataclass(frozen=True)
class ReferenceRun:
    """Written rows per file, unusable files, and files whose items lack a required field.

    All three read what is stored beside the table.
    """

    run_id: str
    processed: DataFrame
    errors: DataFrame
    warnings: DataFrame


def read_bronze_statistics(
    spark: SparkSession,
    root: str,
    regions: Sequence[str] | None = None,
    layout: str = "auto",
    multi_line: bool = True,
) -> tuple[DataFrame | None, DataFrame]:
    """CSV history and API documents below ``root`` as one frame, and the unusable files and documents.

    The frame is None without any file. The documents are parsed once, into a staged table that
    rows and errors share.
    """
    csv = read_csv_files(spark, root, CSV_COLUMNS, regions, multi_line)
    documents = optional_frame(lambda: read_stats_api_json(spark, root, regions, layout))
    frames, errors = [], spark.createDataFrame([], ERRORS)
    if csv is not None:
        frames.append(csv.rows)
        errors = errors.unionByName(csv.errors)
    if documents is not None:
        good, bad = split_quarantine(materialize(documents, "api-documents"))
        frames.append(explode_items(good))
        errors = errors.unionByName(bad)
    return unify_formats(*frames, keep_landed_at=True) if frames else None, errors


def bronze_to_silver_statistics(
    spark: SparkSession,
    bronze: str,
    silver: str,
    job_name: str = "bronze_to_silver_statistics",
    regions: Sequence[str] | None = None,
    layout: str = "auto",
    multi_line: bool = True,
    table: str | None = None,
    rebalance: bool = True,
) -> StatisticsRun:
    """Clean, deduplicate and write the statistics in one job.

    Row and null counts are observed during the write instead of being counted again. A region
    is replaced as a whole: days it no longer has are removed. All unusable files and documents are
    stored by run id beside the table, before anything of it is written.
    """
    check_layout(spark, silver, SILVER_PARTITIONS)
    with cleared_staging(spark):
        run_id = new_run_id()
        raw, errors = read_bronze_statistics(spark, bronze, regions, layout, multi_line)
        errors = write_run_rows(errors, silver, "errors", run_id)
        if raw is None or raw.isEmpty():
            return StatisticsRun(errors, run_id, skipped=True)
        read, written = RowMetrics.new("read"), RowMetrics.new("written")
        unique = read.watch(raw).transform(standardize).transform(dedup_statistics)
        if rebalance:
            # Staged, so that the disk holds one shuffle of the rows at a time; ratios and stamps follow the second.
            unique = materialize(unique, "unique").hint("rebalance", *SILVER_PARTITIONS)
        result = finished_silver(unique, job_name, keep_landed_at=True).select(*STORE_SCHEMA.names)
        stamp = F.unix_micros(F.max("_processed_at")).alias("stamp")
        regions = F.collect_set(F.coalesce("region", F.lit(""))).alias("regions")  # some ten; null and empty are one folder
        checked = written.watch(result, nulls=("video_id", "title", "views"), more=[stamp, regions])
        write_partitions(checked, silver, SILVER_PARTITIONS, rebalance=False)
        counts = written.result()
        stamp, regions = counts.pop("stamp", None), counts.pop("regions", [])
        if stamp is not None:
            remove_stale_days(spark, silver, regions, stamp, run_id)
            if table is not None:
                register_table(spark, table, silver)
        rows = counts.pop("rows", 0)
        return StatisticsRun(
            errors,
            run_id,
            rows_read=read.result().get("rows") if rows else None,
            rows_written=rows,
            null_counts={name.removeprefix("null_"): count for name, count in counts.items()},
        )


def check_layout(spark: SparkSession, path: str, partitions: Sequence[str]) -> None:
    """Refuse a folder whose partition folders are not those of ``partitions``, before writing.

    Two depths of folders in one table can't be read any more. Looks at folder names only.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return
    depth = []
    while True:
        inner = [s.getPath() for s in files.listStatus(folder) if s.isDirectory() and "=" in s.getPath().getName()]
        if not inner:
            break
        depth.append(inner[0].getName().split("=")[0])
        folder = inner[0]
    if depth and depth != list(partitions):
        raise LayoutError(f"{path} is partitioned by {depth}, not by {list(partitions)}")


def remove_stale_days(spark: SparkSession, silver: str, regions: Sequence[str], stamp: int, run_id: str) -> None:
    """Drop the days that a run did not write, of the ``regions`` that it did; store all days of these regions as changed.

    Rows of a run share their processing time, ``stamp`` in microseconds. Only the folders of these
    regions are read, and only that column of them. One row a partition reaches the driver, of partitions that are to be removed.
    """
    stored = spark.read.schema(STORE_SCHEMA).parquet(silver)
    ours = F.col("region").isin([name for name in regions if name])
    stored = stored.filter(ours | F.col("region").isNull() if "" in regions else ours)
    file = stored.metadataColumn("_metadata").getField("file_path").alias("file")
    fresh = (F.unix_micros("_processed_at") == stamp).alias("fresh")
    # By file first: the folder is taken out of its name once a file, not once a row.
    files = stored.select(*SILVER_PARTITIONS, file, fresh).groupBy(*SILVER_PARTITIONS, "file").agg(F.bool_or("fresh").alias("fresh"))
    folder = F.regexp_replace("file", "/[^/]*$", "").alias("folder")
    days = files.groupBy(*SILVER_PARTITIONS, folder).agg(F.bool_or("fresh").alias("fresh"))
    touched = materialize(days, "touched-days")
    write_run_rows(touched.select(*SILVER_PARTITIONS), silver, "changes", run_id)
    remove_folders(spark, [unquote(row["folder"]) for row in touched.filter("NOT fresh").select("folder").collect()])


def bronze_to_silver_reference(
    spark: SparkSession,
    bronze: str,
    silver: str,
    regions: Sequence[str] | None = None,
    layout: str = "auto",
    table: str | None = None,
) -> ReferenceRun:
    """Flatten the newest good landing of every region and replace its rows."""
    documents = read_reference_json(spark, bronze, regions, layout)
    return write_reference(documents, silver, table)


def reference_rows(good: DataFrame) -> DataFrame:
    """Staged rows of the newest landing of every region among good documents."""
    rows = good.transform(newest_landing_per_region).transform(silver_reference, keep_landing=True)
    return materialize(rows.select(*REFERENCE_STORE_SCHEMA.names), "reference-rows")


def write_reference(documents: DataFrame, silver: str, table: str | None = None) -> ReferenceRun:
    """Replace the rows of every region with a good landing among ``documents``.

    The parsed documents are staged once: the rows, the errors and the summaries come from the
    staged table, so that a file is not parsed again for each of them. Errors and warnings are
    stored by run id beside the table.
    """
    with cleared_staging(documents.sparkSession):
        run_id = new_run_id()
        parsed = materialize(documents, "reference-documents")
        good, errors = split_quarantine(parsed, require_items=True)
        stored = write_run_rows(errors.select("_source_file", "region", "error"), silver, "errors", run_id)
        rows = reference_rows(good)
        warnings = write_run_rows(missing_fields(rows), silver, "warnings", run_id)
        write_partitions(rows, silver, table=table)
        files = write_run_rows(run_summary(rows), silver, "files", run_id)
        return ReferenceRun(run_id, processed=files, errors=stored, warnings=warnings)
