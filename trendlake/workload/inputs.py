"""Bronze and reference inputs derived from the test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlake.functions.clock import iso_text

# Two-digit years are read differently by the engines compared, so dates move to 2012-2018.
YEAR_SHIFT_MONTHS = 240
ITEMS_PER_DOCUMENT = 50
REFERENCE_EPOCH = 1_704_067_200  # 2024-01-01, the ingestion time of the first reference row


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bronze_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics rows with null ids, unusable dates, both date forms and padded regions."""

    def t(name: str) -> DataFrame:
        return table(spark, sf_dir, name)

    # The smaller tables meet first, the few regions last and the wide names late, so that little is shuffled.
    regions = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name")
    orders = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
    rows = (
        t("lineitem")
        .join(orders.select("o_orderkey", "o_orderdate", "c_nationkey"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(t("part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(regions, F.col("c_nationkey") == F.col("n_nationkey"))
    )
    month = F.add_months(F.trunc("o_orderdate", "month"), YEAR_SHIFT_MONTHS)
    price = F.col("l_extendedprice")
    return rows.select(
        F.when(F.col("l_partkey") % 97 != 0, F.concat(F.lit("v"), F.col("l_partkey"))).alias("video_id"),
        F.when(F.col("l_partkey") % 50 == 7, F.lit("garbage"))
        .when(F.col("l_linenumber") == 1, F.date_format(month, "yyyy-MM-dd"))
        .otherwise(F.date_format(month, "yy.dd.MM"))
        .alias("trending_date"),
        F.col("p_name").alias("title"),
        F.col("s_name").alias("channel_title"),
        # Every eleventh category is not in the reference data.
        F.when(F.col("l_partkey") % 11 == 5, F.col("s_nationkey") + 100).otherwise(F.col("s_nationkey")).cast("bigint").alias("category_id"),
        F.concat(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), F.lit(".000Z")).alias("publish_time"),
        F.floor(price).cast("bigint").alias("views"),
        F.when(F.col("l_linenumber") != 7, F.floor(price * F.col("l_discount")).cast("bigint")).alias("likes"),
        F.col("l_quantity").cast("bigint").alias("comment_count"),
        F.concat(F.lit(" "), F.col("r_name"), F.lit(" ")).alias("region"),
    )


def bronze_text(bronze: DataFrame) -> DataFrame:
    """The same rows as text, as a CSV file holds them, with some unusable counts."""
    views = F.col("views")
    return bronze.withColumns(
        {
            "category_id": F.col("category_id").cast("string"),
            "views": F.when(views % 10 == 3, F.concat(views.cast("string"), F.lit(".7"))).otherwise(
                views.cast("string")
            ),
            "likes": F.when(views % 10 == 4, F.lit("x1")).otherwise(F.col("likes").cast("string")),
            "comment_count": F.when(views % 10 == 5, F.lit("")).otherwise(
                F.col("comment_count").cast("string")
            ),
        }
    )


def bronze_files(bronze: DataFrame) -> DataFrame:
    """Columns of a CSV file and the region that names its folder."""
    return bronze_text(bronze).withColumn("region", F.lower(F.trim("region")))


def reference_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category rows: several names per id and region, later rows replacing earlier ones."""
    named = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return named.select(
        F.col("n_nationkey").cast("string").alias("id"),
        F.concat_ws(" ", "n_name", "c_mktsegment").alias("snippet_title"),
        iso_text(F.timestamp_seconds(F.col("c_custkey") + REFERENCE_EPOCH)).alias("_ingestion_timestamp"),
        F.lower("c_mktsegment").alias("region"),
        F.col("c_custkey").alias("position"),
    )


def reference_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category responses of at most 50 items, the later page of a region replacing others."""
    rows = reference_rows(spark, sf_dir)
    item = F.struct(
        "position",
        F.lit("category").alias("kind"),
        F.concat(F.lit("e"), F.col("position")).alias("etag"),
        "id",
        F.struct(
            F.concat(F.lit("c"), F.col("id")).alias("channelId"),
            F.col("snippet_title").alias("title"),
            (F.col("position") % 2 == 0).alias("assignable"),
        ).alias("snippet"),
    )
    page = F.floor(F.col("position") / ITEMS_PER_DOCUMENT).alias("page")
    grouped = rows.groupBy("region", page).agg(F.sort_array(F.collect_list(item)).alias("items"))
    items = F.transform("items", lambda i: F.struct(i.kind, i.etag, i.id, i.snippet))
    return grouped.select(
        "region",
        "page",
        F.lit("categoryList").alias("kind"),
        F.concat_ws("/", "region", "page").alias("etag"),
        items.alias("items"),
    )


def event_number() -> Column:
    """The number ``k`` in the ``props`` of an event."""
    return F.get_json_object("props", "$.k").cast("bigint")


def api_items(events: DataFrame, unique: bool = False) -> DataFrame:
    """One response item per event; with ``unique`` each has an id of its own."""
    k, text = event_number(), lambda c: c.cast("string")
    video = F.col("event_id") if unique else F.col("user_id")
    return events.select(
        "event_id",
        "event_type",
        "ts",
        F.struct(
            F.concat(F.lit("v"), video).alias("id"),
            F.struct(
                F.col("event_type").alias("title"),
                F.concat(F.lit("u"), F.col("user_id") % 10).alias("channelTitle"),
                text(F.col("user_id") % 44).alias("categoryId"),
                F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")).alias("publishedAt"),
            ).alias("snippet"),
            F.struct(
                text(k * 1000).alias("viewCount"),
                text(k * 7).alias("likeCount"),
                F.when(k % 10 != 0, text(k)).alias("commentCount"),
            ).alias("statistics"),
        ).alias("item"),
    )


def api_documents(spark: SparkSession, sf_dir: str, unique: bool = False) -> DataFrame:
    """Responses of at most 50 items: one per event type, day and page of event ids.

    The page bounds every document, however many events a type has.
    """
    items = api_items(table(spark, sf_dir, "events"), unique)
    keys = (
        F.col("event_type").alias("region"),
        F.to_date("ts").alias("day"),
        F.floor(F.col("event_id") / ITEMS_PER_DOCUMENT).alias("page"),
    )
    ordered = F.sort_array(F.collect_list(F.struct("event_id", "item")))
    return (
        items.groupBy(*keys)
        .agg(ordered.alias("ordered"), F.max("ts").cast("timestamp").alias("landed_at"))
        .select("region", "page", "landed_at", F.col("ordered.item").alias("items"))
    )
