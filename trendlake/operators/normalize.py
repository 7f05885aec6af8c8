"""Both input formats as the same ten statistics columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendlake import schemas
from trendlake.functions.cleaning import short_date_text, to_count
from trendlake.functions.columns import missing_columns, resolve_column

ITEM = "item"
_LANDED = schemas.LANDED_AT.name

# Where the API response keeps each statistics column.
API_PATHS = {
    "video_id": "id",
    "title": "snippet.title",
    "channel_title": "snippet.channelTitle",
    "category_id": "snippet.categoryId",
    "publish_time": "snippet.publishedAt",
    "views": "statistics.viewCount",
    "likes": "statistics.likeCount",
    "comment_count": "statistics.commentCount",
}
COUNT_COLUMNS = ("category_id", "views", "likes", "comment_count")


def detect_format(df: DataFrame) -> str:
    """``api`` when the schema has the nested title in any spelling, else ``csv``."""
    return "csv" if resolve_column(df, API_PATHS["title"], ITEM) is None else "api"


def _as_statistics(df: DataFrame, found: dict[str, Column], keep_landed_at: bool) -> DataFrame:
    source = df.select(*(found[name].alias(name) for name in schemas.STATISTICS.names)).schema

    def convert(name: str) -> Column:
        if name in COUNT_COLUMNS:
            return to_count(found[name], source[name].dataType)
        return found[name].cast("string")

    columns = [convert(name).alias(name) for name in schemas.STATISTICS.names]
    if keep_landed_at:
        landed = F.col(_LANDED) if _LANDED in df.columns else F.lit(None).cast("timestamp")
        columns.append(landed.alias(_LANDED))
    return df.select(*columns)


def project_api(df: DataFrame, landed_at: Column | None = None, keep_landed_at: bool = False) -> DataFrame:
    """Statistics columns of exploded API items or of an already flattened API table.

    The trending date is the UTC day the document was landed (``landed_at``, by default
    the ``_landed_at`` column), so reading old files again does not move them to today.
    """
    if landed_at is None:
        landed_at = F.col(_LANDED)
    found = {name: resolve_column(df, path, ITEM) for name, path in API_PATHS.items()}
    absent = F.lit(None).cast("string")
    found = {name: absent if column is None else column for name, column in found.items()}
    found["trending_date"] = short_date_text(F.to_date(landed_at))
    found["region"] = F.col("region")
    return _as_statistics(df, found, keep_landed_at)


def project_csv(df: DataFrame, keep_landed_at: bool = False) -> DataFrame:
    """Statistics columns of a historic CSV table; further columns are ignored."""
    return _as_statistics(df, {name: F.col(name) for name in schemas.STATISTICS.names}, keep_landed_at)


def project_any(df: DataFrame, keep_landed_at: bool = False) -> DataFrame:
    """Project with whichever format the schema shows."""
    project = project_api if detect_format(df) == "api" else project_csv
    return project(df, keep_landed_at=keep_landed_at)


def unify_formats(*frames: DataFrame, keep_landed_at: bool = False) -> DataFrame:
    """One statistics frame out of any mix of CSV and API frames."""
    return reduce(DataFrame.unionByName, (project_any(df, keep_landed_at) for df in frames))


def required_columns_warning(df: DataFrame, required: tuple[str, ...], table: str) -> DataFrame:
    """One report row naming the required columns the schema lacks; reads no data."""
    missing = missing_columns(df, required)
    message = f"without {', '.join(missing)}" if missing else "no column is missing"
    row = ("schema", table, missing, not missing, message)
    return df.sparkSession.createDataFrame(
        [row], "check string, table string, missing_columns array<string>, passed boolean, message string"
    )
