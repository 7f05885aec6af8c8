"""Landing raw API responses with the metadata of the run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendlake.functions import clock
from trendlake.functions.cleaning import landing_region
from trendlake.sinks.tables import partition_folder
from trendlake.sources.files import LINES_FOLDER
from trendlake.staging import brief_shuffles, existing, materialize


def landing_metadata(
    documents: DataFrame, landed_at: Column, count_items: bool = True, page: Column | None = None
) -> DataFrame:
    """Add ``_metadata`` (run, region, time, number of items) and the folder columns.

    ``documents`` has one response per row and its ``region``. Category responses carry
    no item count but the ``page`` that orders the responses of a region. The folder
    ``layout=lines`` tells readers that the files hold an object per line.
    """
    region = landing_region(F.col("region"))
    entries = [
        clock.run_id(landed_at).alias("run_id"),
        region.alias("region"),
        clock.iso_text(landed_at).alias("timestamp"),
    ]
    if count_items:
        entries.append(F.coalesce(F.size("items"), F.lit(0)).cast("bigint").alias("video_count"))
    if page is not None:
        entries.append(page.cast("bigint").alias("page"))
    return documents.withColumns(
        {
            "_metadata": F.struct(*entries),
            "region": region,
            "date": clock.day_text(landed_at),
            "hour": clock.hour_text(landed_at),
        }
    )


def _as_lines(landed: DataFrame) -> DataFrame:
    name, value = LINES_FOLDER.split("=")
    return landed.withColumn(name, F.lit(value))


def land_raw_json(documents: DataFrame, root: str, landed_at: Column) -> None:
    """Append responses below ``root`` by region, date and hour, one object per line.

    Many responses share a file: one file per response would be far too many small files.
    The rebalancing brings the responses of a folder together before they are written.
    """
    landed = landing_metadata(documents, landed_at).hint("rebalance", "region", "date", "hour")
    with brief_shuffles(documents.sparkSession):
        _as_lines(landed).write.mode("append").partitionBy("region", "date", "hour", "layout").json(root)


#: What is landed where a response had its content before: the digest of region, time and payload.
DIGEST = "digest"


def land_once(documents: DataFrame, root: str, landed_at: Column) -> None:
    """Like :func:`land_raw_json`, but landing again what was landed already adds nothing.

    Every response is known by a digest of its region, landing time and content, which is stored in
    its metadata. A landing that broke off, or whose answer was lost, is simply repeated: responses that
    the folders of its regions, dates and hours hold are left out, the others are added. Equal responses of
    one landing are one. Only these folders are read.
    """
    spark = documents.sparkSession
    landed = landing_metadata(documents, landed_at)
    payload = F.to_json(F.struct(*(F.col(name) for name in documents.columns if name != "region")))
    key = F.sha2(F.concat_ws("\x1f", F.coalesce("region", F.lit("")), "_metadata.timestamp", payload), 256)
    landed = materialize(landed.withColumn("_metadata", F.col("_metadata").withField(DIGEST, key)), "landing")
    folders = landed.select("region", "date", "hour").distinct().collect()  # one row for each folder of this landing
    known = existing(spark, [partition_folder(spark, root, row.asDict()) for row in folders])
    fresh = landed.withColumn("_key", F.col(f"_metadata.{DIGEST}")).dropDuplicates(["_key"])
    if known:
        held = spark.read.schema(f"_metadata struct<{DIGEST}:string>").option("recursiveFileLookup", True).json(known)
        fresh = fresh.join(held.select(F.col(f"_metadata.{DIGEST}").alias("_key")).distinct(), "_key", "left_anti")
    shaped = fresh.drop("_key").hint("rebalance", "region", "date", "hour")
    _as_lines(shaped).write.mode("append").partitionBy("region", "date", "hour", "layout").json(root)


def land_reference_json(
    documents: DataFrame, root: str, landed_at: Column, page: str | None = None
) -> None:
    """Land category responses by region and date; a second run of a day replaces it.

    The responses of a region may be written by any number of tasks: readers take all files of
    a landing as one, in the order of the column ``page``, which is kept in the metadata only. Name
    it where an id can be in several responses.
    """
    extra = [] if page is None else [page]
    landed = landing_metadata(documents, landed_at, count_items=False, page=None if page is None else F.col(page)).drop("hour", *extra)
    (
        _as_lines(landed)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("region", "date", "layout")
        .json(root)
    )
