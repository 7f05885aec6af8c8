"""Projection, cleaning and deduplication."""

from __future__ import annotations

import datetime as dt
import random

from conftest import as_tuples
from pyspark.sql import functions as F

from trendlake import schemas
from trendlake.operators import clean, normalize

ROW = {
    "video_id": "v1",
    "trending_date": "17.14.11",
    "title": "t",
    "channel_title": "c",
    "category_id": "10",
    "publish_time": "p",
    "views": "100",
    "likes": "5",
    "comment_count": "1",
    "region": " US ",
}


def csv_rows(spark, *changes):
    rows = [tuple({**ROW, **change}.values()) for change in changes]
    return spark.createDataFrame(rows, ", ".join(f"{name} string" for name in ROW))


def item(**counts):
    statistics = {"viewCount": "10", "likeCount": "2", "commentCount": None, **counts}
    snippet = ("title", "chan", "23", "2024-01-01T00:00:00Z")
    return ("a1", snippet, tuple(statistics.values()))


def api_rows(spark, landed="2024-03-05 23:30:00"):
    frame = spark.createDataFrame([("us", item())], "region string, item " + schemas.API_ITEM.simpleString())
    return frame.withColumn("_landed_at", F.lit(landed).cast("timestamp"))


def test_detect_format(spark):
    assert normalize.detect_format(api_rows(spark)) == "api"
    assert normalize.detect_format(csv_rows(spark, {})) == "csv"
    for name in ("snippet.title", "snippet__title"):
        assert normalize.detect_format(spark.createDataFrame([("x",)], [name])) == "api"


def test_project_csv_types_and_extras(spark):
    rows = csv_rows(spark, {"views": "x1", "likes": "12.7", "category_id": None}).withColumn("tags", F.lit("z"))
    projected = normalize.project_csv(rows)
    assert projected.schema == schemas.STATISTICS
    assert tuple(projected.first())[4:9] == (None, "p", None, 12, 1)


def test_project_api_uses_the_landing_day(spark):
    projected = normalize.project_api(api_rows(spark))
    assert projected.columns == schemas.STATISTICS.names
    row = projected.first()
    assert (row["video_id"], row["trending_date"], row["views"], row["comment_count"]) == ("a1", "24.05.03", 10, None)


def test_project_flat_api_without_counts(spark):
    flat = spark.createDataFrame(
        [("a1", "us", "t", "c", "7", "p")],
        ["id", "region", "snippet__title", "snippet__channelTitle", "snippet__categoryId", "snippet__publishedAt"],
    )
    row = normalize.project_api(flat, landed_at=F.lit("2024-01-02").cast("timestamp")).first()
    assert (row["channel_title"], row["category_id"], row["views"]) == ("c", 7, None)


def test_unify_formats(spark):
    both = normalize.unify_formats(csv_rows(spark, {}), api_rows(spark), keep_landed_at=True)
    assert as_tuples(both, "video_id", F.col("_landed_at").isNull().alias("n")) == [("a1", False), ("v1", True)]


def test_clean_statistics(spark):
    rows = csv_rows(
        spark,
        {},
        {"video_id": None},
        {"video_id": "v2", "views": "0", "likes": None, "trending_date": "garbage"},
        {"video_id": "v3", "views": "3", "likes": "1", "comment_count": "1", "trending_date": "2020-01-02"},
    )
    cleaned = clean.clean_statistics(normalize.project_csv(rows))
    got = as_tuples(cleaned, "video_id", "region", "trending_date_parsed", "likes", "like_ratio", "engagement_rate")
    assert got == [
        ("v1", "us", dt.date(2017, 11, 14), 5, 5.0, 6.0),
        ("v2", "us", None, 0, 0.0, 0.0),
        ("v3", "us", dt.date(2020, 1, 2), 1, 33.3333, 66.6667),
    ]


def test_dedup_ignores_the_order_of_the_rows(spark):
    changes = [
        {"views": "7", "title": "b"},
        {"views": "7", "title": "a"},
        {"views": "6", "title": "0"},
        {"region": "us", "views": "7", "title": "a", "trending_date": "2017-11-14"},
        {"region": "ca"},
        {"trending_date": None},
        {"trending_date": "garbage"},
    ]
    results = set()
    for seed in range(3):
        random.Random(seed).shuffle(changes)
        silver = clean.silver_statistics(normalize.project_csv(csv_rows(spark, *changes)), "job")
        results.add(tuple(as_tuples(silver, "region", "trending_date", "title", "views")))
    assert results == {
        (("ca", "17.14.11", "t", 100), ("us", "17.14.11", "a", 7), ("us", None, "t", 100))
    }


def test_later_landing_wins_over_higher_counts(spark):
    old = normalize.project_csv(csv_rows(spark, {"region": "us", "trending_date": "2024-03-05", "video_id": "a1"}), True)
    new = normalize.project_api(api_rows(spark), keep_landed_at=True)
    silver = clean.silver_statistics(old.unionByName(new), "job", keep_landed_at=True)
    assert as_tuples(silver, "video_id", "views") == [("a1", 10)]
    assert silver.columns == [*schemas.SILVER_STATISTICS.names, "_landed_at"]


def test_silver_schema(spark):
    silver = clean.silver_statistics(normalize.project_csv(csv_rows(spark, {})), "job")
    assert [(f.name, f.dataType) for f in silver.schema] == [
        (f.name, f.dataType) for f in schemas.SILVER_STATISTICS
    ]
    assert silver.first()["_job_name"] == "job"


def test_dedup_keeps_one_row_per_key_and_task_before_the_shuffle(spark):
    plan = plan_of(clean.silver_statistics(normalize.project_csv(csv_rows(spark, {})), "job"))
    assert plan.count("WindowGroupLimit") == 2
    assert "Python" not in plan


def test_required_columns_warning(spark):
    report = normalize.required_columns_warning(csv_rows(spark, {}), ("id", "title"), "t").first()
    assert (report["passed"], report["missing_columns"]) == (False, ["id"])


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
