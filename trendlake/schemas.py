"""Explicit schemas of every layer; nothing is inferred in a job."""

from __future__ import annotations

from pyspark.sql import types as T


def _fields(*pairs: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in pairs])


_STR, _LONG, _DBL = T.StringType(), T.LongType(), T.DoubleType()
_TS, _DATE, _BOOL, _INT = T.TimestampType(), T.DateType(), T.BooleanType(), T.IntegerType()

# The ten columns both input formats are projected to.
STATISTICS = _fields(
    ("video_id", _STR),
    ("trending_date", _STR),
    ("title", _STR),
    ("channel_title", _STR),
    ("category_id", _LONG),
    ("publish_time", _STR),
    ("views", _LONG),
    ("likes", _LONG),
    ("comment_count", _LONG),
    ("region", _STR),
)

# Landing time of the source document; orders duplicates, null for historic files.
LANDED_AT = T.StructField("_landed_at", _TS, True)

# Folders of the silver statistics, for batch and incremental runs alike.
SILVER_PARTITIONS = ("region", "trending_date_parsed")

SILVER_STATISTICS = T.StructType(
    STATISTICS.fields
    + _fields(
        ("trending_date_parsed", _DATE),
        ("like_ratio", _DBL),
        ("engagement_rate", _DBL),
        ("_processed_at", _TS),
        ("_job_name", _STR),
    ).fields
)

CORRUPT_COLUMN = "_corrupt_record"

API_ITEM = _fields(
    ("id", _STR),
    (
        "snippet",
        _fields(("title", _STR), ("channelTitle", _STR), ("categoryId", _STR), ("publishedAt", _STR)),
    ),
    (
        "statistics",
        _fields(("viewCount", _STR), ("likeCount", _STR), ("commentCount", _STR)),
    ),
)

LANDING_METADATA = _fields(("run_id", _STR), ("region", _STR), ("timestamp", _STR), ("video_count", _LONG))

API_DOCUMENT = _fields(("items", T.ArrayType(API_ITEM)), ("_metadata", LANDING_METADATA))

REFERENCE_SNIPPET = _fields(("channelId", _STR), ("title", _STR), ("assignable", _BOOL))

REFERENCE_ITEM = _fields(("kind", _STR), ("etag", _STR), ("id", _STR), ("snippet", REFERENCE_SNIPPET))

# A file is either a list response with ``items`` or one bare item.
REFERENCE_DOCUMENT = _fields(
    ("kind", _STR),
    ("etag", _STR),
    ("id", _STR),
    ("snippet", REFERENCE_SNIPPET),
    ("items", T.ArrayType(REFERENCE_ITEM)),
    ("_metadata", _fields(("run_id", _STR), ("region", _STR), ("timestamp", _STR), ("page", _LONG))),
)

SILVER_REFERENCE = _fields(
    ("kind", _STR),
    ("etag", _STR),
    ("id", _STR),
    ("snippet_channel_id", _STR),
    ("snippet_title", _STR),
    ("snippet_assignable", _BOOL),
    ("_extra", _STR),  # further fields of the item as one JSON object
    ("_ingestion_timestamp", _STR),
    ("_source_file", _STR),
    ("region", _STR),
)

TRENDING_ANALYTICS = _fields(
    ("region", _STR),
    ("trending_date_parsed", _DATE),
    ("total_videos", _LONG),
    ("total_views", _LONG),
    ("total_likes", _LONG),
    ("total_comments", _LONG),
    ("avg_views_per_video", _DBL),
    ("avg_like_ratio", _DBL),
    ("avg_engagement_rate", _DBL),
    ("max_views", _LONG),
    ("unique_channels", _LONG),
    ("unique_categories", _LONG),
    ("_aggregated_at", _TS),
)

CHANNEL_ANALYTICS = _fields(
    ("channel_title", _STR),
    ("region", _STR),
    ("total_videos", _LONG),
    ("total_views", _LONG),
    ("total_likes", _LONG),
    ("total_comments", _LONG),
    ("avg_views_per_video", _DBL),
    ("avg_engagement_rate", _DBL),
    ("peak_views", _LONG),
    ("times_trending", _LONG),
    ("first_trending", _DATE),
    ("last_trending", _DATE),
    ("categories", T.ArrayType(_STR)),
    ("rank_in_region", _INT),
    ("_aggregated_at", _TS),
)

CATEGORY_ANALYTICS = _fields(
    ("category_name", _STR),
    ("category_id", _LONG),
    ("region", _STR),
    ("trending_date_parsed", _DATE),
    ("video_count", _LONG),
    ("total_views", _LONG),
    ("total_likes", _LONG),
    ("total_comments", _LONG),
    ("avg_engagement_rate", _DBL),
    ("unique_channels", _LONG),
    ("view_share_pct", _DBL),
    ("_aggregated_at", _TS),
)

DQ_REPORT = _fields(
    ("check", _STR),
    ("table", _STR),
    ("column", _STR),
    ("value", _DBL),
    ("threshold", _DBL),
    ("negative_count", _LONG),
    ("extreme_count", _LONG),
    ("missing_columns", T.ArrayType(_STR)),
    ("latest_record", _STR),
    ("cutoff", _STR),
    ("passed", _BOOL),
    ("message", _STR),
)
