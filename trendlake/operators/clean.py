"""From the ten projected columns to the silver statistics table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendlake import schemas
from trendlake.functions import cleaning

SILVER_KEY = ("video_id", "region", "trending_date_parsed")
COUNTS = ("views", "likes", "comment_count")


def drop_null_video_id(df: DataFrame) -> DataFrame:
    return df.filter(F.col("video_id").isNotNull())


def normalize_region(df: DataFrame) -> DataFrame:
    return df.withColumn("region", cleaning.region_key(F.col("region")))


def parse_trending_date(df: DataFrame) -> DataFrame:
    return df.withColumn("trending_date_parsed", cleaning.trending_day(F.col("trending_date")))


def coalesce_counts(df: DataFrame) -> DataFrame:
    return df.withColumns({name: cleaning.zero_if_null(F.col(name)) for name in COUNTS})


def derive_ratios(df: DataFrame) -> DataFrame:
    views, likes, comments = (F.col(name) for name in COUNTS)
    return df.withColumns(
        {
            "like_ratio": cleaning.percent_of_views(likes, views),
            "engagement_rate": cleaning.percent_of_views(likes.cast("double") + comments.cast("double"), views),
        }
    )


def standardize(df: DataFrame) -> DataFrame:
    """Rows with an id, a normal region, a parsed date and counts without nulls."""
    return (
        df.transform(drop_null_video_id)
        .transform(normalize_region)
        .transform(parse_trending_date)
        .transform(coalesce_counts)
    )


def clean_statistics(df: DataFrame) -> DataFrame:
    """All cleaning steps and both ratios, duplicates still in."""
    return df.transform(standardize).transform(derive_ratios)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of every key in the given order.

    Spark keeps one row per key and task before the shuffle and again after it, so a key
    that fills a third of the table still arrives as one row per task.
    """
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_position", position).filter(F.col("_position") == 1).drop("_position")


def dedup_order(df: DataFrame) -> list[Column]:
    """Latest landing first, then the highest counts, then every other column.

    All columns take part, so the survivor does not depend on the order of the rows.
    """
    landed = schemas.LANDED_AT.name
    latest = [F.col(landed).desc_nulls_last()] if landed in df.columns else []
    rest = ("title", "channel_title", "category_id", "publish_time", "trending_date")
    return [*latest, *(F.col(name).desc() for name in COUNTS), *(F.col(name).asc() for name in rest)]


def dedup_statistics(df: DataFrame) -> DataFrame:
    """One row per video, region and day."""
    return keep_first(df, SILVER_KEY, dedup_order(df))


def stamp_processed(df: DataFrame, job_name: str) -> DataFrame:
    return df.withColumns({"_processed_at": F.current_timestamp(), "_job_name": F.lit(job_name)})


def silver_statistics(df: DataFrame, job_name: str, keep_landed_at: bool = False) -> DataFrame:
    """Silver table out of projected statistics.

    The ratios are derived after the shuffle of the deduplication, which then moves two
    columns less.
    """
    return finished_silver(df.transform(standardize).transform(dedup_statistics), job_name, keep_landed_at)


def finished_silver(unique: DataFrame, job_name: str, keep_landed_at: bool = False) -> DataFrame:
    """Silver table out of standardized statistics without duplicates."""
    silver = unique.transform(derive_ratios).transform(stamp_processed, job_name)
    names = list(schemas.SILVER_STATISTICS.names)
    if keep_landed_at:
        names.append(schemas.LANDED_AT.name)
    return silver.select(*names)
