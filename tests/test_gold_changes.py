"""Gold that follows changed days is the gold that would be built anew."""

from __future__ import annotations

import random
from datetime import date

import pytest
from conftest import as_tuples
from pyspark.sql import functions as F

from trendlake import schemas
from trendlake.config import QualityRules
from trendlake.operators.quality import QualityGateError
from trendlake.operators.rollups import GOLD_TABLES
from trendlake.plans import gold_changes
from trendlake.plans.gold import silver_to_gold
from trendlake.plans.gold_changes import counted_references, follow_changes, update_gold
from trendlake.plans.silver import STORE_SCHEMA, bronze_to_silver_statistics
from trendlake.schemas import SILVER_PARTITIONS
from trendlake.sinks.tables import partition_folder, write_partitions
from trendlake.staging import remove_folders
from trendlake.streaming.incremental import stored_rows

DAYS = [date(2024, 1, d) for d in (1, 2, 3)] + [None]


def statistics(spark, chance, keys):
    """Rows for some (region, day) with few channels, videos and categories, so that changes meet."""
    rows = [
        (f"v{chance.randint(1, 9)}", None, "t", chance.choice(["x", "y", None]), chance.choice([1, 2, None]), None, chance.randint(0, 9), 1, 2, region, day, 1.5, chance.random(), None, None)
        for region, day in keys
        for _ in range(chance.randint(1, 6))
    ]
    return spark.createDataFrame(rows, schemas.SILVER_STATISTICS).dropDuplicates(["video_id", *SILVER_PARTITIONS])


def gold_rows(spark, gold):
    return {name: as_tuples(spark.read.schema(schema).parquet(f"{gold}/{name}").drop("_aggregated_at"), "*") for name, (_, schema) in GOLD_TABLES.items()}


def names(spark, *pairs):
    return lambda: spark.createDataFrame([(str(i), n) for i, n in pairs], "id string, snippet_title string")


def check(spark, silver, reference, state, gold, anew):
    silver_to_gold(spark.read.schema(schemas.SILVER_STATISTICS).parquet(silver), reference, anew)
    assert gold_rows(spark, gold) == gold_rows(spark, anew)


def test_follows_changes_vanished_days_new_names_and_broken_writes(spark, tmp_path, monkeypatch):
    chance = random.Random(4)
    silver, state, gold, anew = (f"{tmp_path}/{n}" for n in ("silver", "state", "gold", "anew"))
    keys = [(region, day) for region in ("ca", "us", None) for day in DAYS]
    write_partitions(statistics(spark, chance, keys), silver, SILVER_PARTITIONS)
    stored = lambda: spark.read.schema(schemas.SILVER_STATISTICS).parquet(silver)
    reference = names(spark, (1, "one"), (2, "two"))
    update_gold(stored(), reference, stored(), state, gold)
    check(spark, silver, reference, state, gold, anew)

    touched = [("ca", DAYS[0]), ("us", None), (None, DAYS[1])]
    gone = ("us", DAYS[2])
    write_partitions(statistics(spark, chance, touched), silver, SILVER_PARTITIONS)
    remove_folders(spark, [partition_folder(spark, silver, dict(zip(SILVER_PARTITIONS, gone, strict=True)))])
    changed = spark.createDataFrame([*touched, gone], f"region string, {SILVER_PARTITIONS[1]} date")
    plain, writes = write_partitions, []

    def breaks(*args, **options):
        writes.append(args)
        if len(writes) == 4:
            raise OSError("lost")
        plain(*args, **options)

    monkeypatch.setattr(gold_changes, "write_partitions", breaks)
    with pytest.raises(OSError, match="lost"):
        update_gold(stored(), reference, changed, state, gold)
    monkeypatch.undo()
    # The next update takes the broken one up first; its own days are none.
    update_gold(stored(), reference, changed.where("false"), state, gold)
    check(spark, silver, reference, state, gold, anew)

    renamed = names(spark, (1, "one"), (2, "three"))
    write_partitions(statistics(spark, chance, touched[:1]), silver, SILVER_PARTITIONS)
    update_gold(stored(), renamed, changed.limit(1), state, gold)
    check(spark, silver, renamed, state, gold, anew)


def test_only_changed_days_of_the_statistics_are_read(spark, tmp_path):
    silver = f"{tmp_path}/silver"
    write_partitions(statistics(spark, random.Random(1), [(r, d) for r in "ab" for d in DAYS[:3]]), silver, SILVER_PARTITIONS)
    stored = spark.read.schema(schemas.SILVER_STATISTICS).parquet(silver)
    changed = spark.createDataFrame([("a", DAYS[1])], f"region string, {SILVER_PARTITIONS[1]} date")
    plan = stored_rows(stored, changed)._sc._jvm.PythonSQLUtils.explainString(stored_rows(stored, changed)._jdf.queryExecution(), "formatted")
    filters = [line for line in plan.splitlines() if line.startswith("PartitionFilters")]
    assert any("region" in line and "trending_date_parsed" in line and "2024-01-02" in line for line in filters)
    assert {r.region for r in stored_rows(stored, changed).select("region").collect()} == {"a"}


def test_reference_counts_fall_to_nothing(spark):
    schema = "region string, channel_title string, video_id string, n bigint"
    make = lambda *rows: spark.createDataFrame(list(rows), schema)
    stored = make(("a", "x", "v", 2), ("a", "x", "w", 1), (None, None, "v", 1))
    got = counted_references(stored, make(("a", "x", "u", 1), (None, None, "v", 1)), make(("a", "x", "v", 1), ("a", "x", "w", 1)), "video_id")
    assert as_tuples(got, "*") == sorted([("a", "x", "u", 1), ("a", "x", "v", 1), (None, None, "v", 2)], key=repr)


def test_jobs_tell_their_changes(spark, write, tmp_path):
    head = "video_id,trending_date,title,channel_title,category_id,publish_time,views,likes,comment_count\n"
    root = write("region=us/a.csv", head + "v1,17.14.11,t,c,1,p,5,1,1\nv2,17.15.11,t,c,1,p,6,1,1\n")
    silver, state, gold, anew = (f"{tmp_path}/{n}" for n in ("silver", "state", "gold", "anew"))
    bronze_to_silver_statistics(spark, root, silver)
    with pytest.raises(QualityGateError, match="1 of 9"):
        follow_changes(spark, silver, None, state, gold)  # two rows are too few
    few = QualityRules(min_rows=1)
    assert follow_changes(spark, silver, None, state, gold, few) == 1
    write("region=us/a.csv", head + "v1,17.14.11,t,d,1,p,9,1,1\n")  # the other day goes away
    bronze_to_silver_statistics(spark, root, silver)
    assert follow_changes(spark, silver, None, state, gold, few) == 1
    assert follow_changes(spark, silver, None, state, gold, few) == 0
    silver_to_gold(spark.read.schema(STORE_SCHEMA).parquet(silver), None, anew)
    assert gold_rows(spark, gold) == gold_rows(spark, anew)
    assert spark.read.schema(schemas.TRENDING_ANALYTICS).parquet(f"{gold}/trending_analytics").select(F.sum("total_videos")).first()[0] == 1


def test_new_tables_are_written_where_they_are_read(spark, tmp_path, monkeypatch):
    silver, state, gold, anew = (f"{tmp_path}/{n}" for n in ("silver", "state", "gold", "anew"))
    write_partitions(statistics(spark, random.Random(2), [(r, d) for r in "ab" for d in DAYS]), silver, SILVER_PARTITIONS)
    stored = spark.read.schema(schemas.SILVER_STATISTICS).parquet(silver)
    labels, real = [], gold_changes.materialize
    monkeypatch.setattr(gold_changes, "materialize", lambda df, label: labels.append(label) or real(df, label))
    assert "LocalRelation <empty>" in gold_changes.state_table(spark, state, "days")._jdf.queryExecution().optimizedPlan().toString()
    update_gold(stored, names(spark, (1, "one")), stored, state, gold)
    assert not {"new-days", "new-videos", "videos", "categories"} & set(labels)
    check(spark, silver, names(spark, (1, "one")), state, gold, anew)
