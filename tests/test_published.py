"""Tables published as a whole, profiles instead of scans, and landings that can be repeated."""

from __future__ import annotations

import random
from datetime import date

import pytest
from conftest import as_tuples
from pyspark.sql import functions as F

from trendlake import schemas
from trendlake.config import STATISTICS_TABLE, QualityRules
from trendlake.operators.profiles import profile, read_profiles, report, update_profiles
from trendlake.operators.quality import check_table
from trendlake.schemas import SILVER_PARTITIONS
from trendlake.sinks import published
from trendlake.sinks.landing import land_once
from trendlake.sinks.published import publish, versions
from trendlake.sinks.tables import write_partitions
from trendlake.sources.statistics import read_stats_api_json


def rows(spark, n, region="us"):
    return spark.range(n).select("id", F.lit(region).alias("region"))


def test_readers_see_the_last_good_version(spark, tmp_path, monkeypatch):
    root, name = f"{tmp_path}/table", "published_rows"
    publish(rows(spark, 3), name, root)
    assert spark.table(name).count() == 3
    before = spark.table(name)

    def breaks(df, path, *args, **options):
        df.write.parquet(f"{path}/half")
        raise OSError("lost")

    monkeypatch.setattr(published, "write_partitions", breaks)
    with pytest.raises(OSError, match="lost"):
        publish(rows(spark, 9), name, root)
    assert spark.table(name).count() == 3
    monkeypatch.undo()
    failing = rows(spark, 5).select(F.raise_error(F.lit("bad row")).cast("bigint").alias("id"), "region")
    with pytest.raises(Exception, match="bad row"):
        publish(failing, name, root)
    assert spark.table(name).count() == 3 and before.count() == 3
    publish(rows(spark, 7), name, root)
    assert spark.table(name).count() == 7 and before.count() == 3  # a query of the version before can end
    publish(rows(spark, 8, "ca"), name, root)
    assert as_tuples(spark.table(name), "region")[0] == ("ca",) and len(versions(spark, root)) == 2
    spark.sql(f"DROP VIEW {name}")


def test_filters_reach_the_files_of_a_published_table(spark, tmp_path):
    publish(rows(spark, 5).unionByName(rows(spark, 5, "ca")), "published_pruned", f"{tmp_path}/t")
    plan = spark.table("published_pruned").where("region = 'ca' AND id > 2").select("id")
    text = spark._jvm.PythonSQLUtils.explainString(plan._jdf.queryExecution(), "formatted")
    assert "PartitionFilters: [isnotnull(region" in text and "PushedFilters: [IsNotNull(id), GreaterThan(id,2)]" in text
    spark.sql("DROP VIEW published_pruned")


def statistics(spark, seed, days):
    chance = random.Random(seed)
    made = [
        (f"v{i}" if i % 5 else None, None, chance.choice(["t", None]), chance.choice(["c", None]), 1, None, chance.choice([-1, 5, 10**11, None]), 1, 2, region, day, 0.0, 0.0, None, None)
        for region, day in days
        for i in range(chance.randint(1, 9))
    ]
    return spark.createDataFrame(made, schemas.SILVER_STATISTICS).withColumn("_processed_at", F.timestamp_seconds(F.lit(1_700_000_000 + seed)))


def test_report_of_a_profile_is_that_of_the_table(spark, tmp_path):
    silver, path, rules = f"{tmp_path}/silver", f"{tmp_path}/profiles", QualityRules(max_null_pct=20.0)
    now = F.lit("2023-11-15 00:00:00").cast("timestamp")
    keys = [(r, d) for r in ("ca", "us", None) for d in (date(2024, 1, 1), date(2024, 1, 2), None)]
    write_partitions(statistics(spark, 1, keys), silver, SILVER_PARTITIONS)
    stored = lambda: spark.read.schema(schemas.SILVER_STATISTICS).parquet(silver)

    def same():
        kept = read_profiles(spark, path, profile(stored(), STATISTICS_TABLE, rules).schema)
        got = as_tuples(report(kept, stored(), STATISTICS_TABLE, rules, now), "*")
        assert got == as_tuples(check_table(stored(), STATISTICS_TABLE, rules, now), "*")

    update_profiles(stored(), stored(), path, STATISTICS_TABLE, rules)
    same()
    changed = keys[:1] + keys[5:7]
    write_partitions(statistics(spark, 2, changed), silver, SILVER_PARTITIONS)
    update_profiles(stored(), spark.createDataFrame(changed, "region string, trending_date_parsed date"), path, STATISTICS_TABLE, rules)
    same()
    # All days of a region leave.
    gone = spark.createDataFrame([k for k in keys if k[0] == "ca"], "region string, trending_date_parsed date")
    left = stored().where("region IS NULL OR region <> 'ca'")
    update_profiles(left, gone, path, STATISTICS_TABLE, rules)
    kept = read_profiles(spark, path, profile(stored(), STATISTICS_TABLE, rules).schema)
    assert as_tuples(report(kept, stored(), STATISTICS_TABLE, rules, now), "*") == as_tuples(check_table(left, STATISTICS_TABLE, rules, now), "*")
    # Other rules measure other things: this profile says nothing about them.
    other = QualityRules(max_views=1)
    assert report(kept, stored(), STATISTICS_TABLE, other).where("check = 'row_count'").first()["value"] == 0


def test_landing_again_adds_nothing(spark, tmp_path):
    root = f"{tmp_path}/raw"
    schema = "region string, items " + schemas.API_DOCUMENT["items"].dataType.simpleString()
    item = ("a1", ("t", "c", "1", "p"), ("10", "1", None))
    documents = spark.createDataFrame([(" US\n", [item, item]), ("ca", [item]), ("mx", None), (None, [item])], schema)
    at = F.lit("2024-01-02 05:06:07").cast("timestamp")
    for attempt in (documents.where("region = 'ca'"), documents, documents.unionByName(documents)):
        land_once(attempt, root, at)
    back = read_stats_api_json(spark, root)
    assert as_tuples(back, "_metadata.region", "_metadata.video_count") == sorted([("ca", 1), ("mx", 0), ("us", 2), (None, 1)], key=repr)
    land_once(documents, root, F.lit("2024-01-02 06:00:00").cast("timestamp"))  # another landing
    assert read_stats_api_json(spark, root).count() == 8
    changed = spark.createDataFrame([("ca", [item, item])], schema)
    land_once(changed, root, at)
    assert read_stats_api_json(spark, root).count() == 9
