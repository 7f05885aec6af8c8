"""Bronze files, sinks, jobs and incremental runs end to end."""

from __future__ import annotations

import glob
import json
import os

import pytest
from conftest import as_tuples
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from trendlake import schemas
from trendlake.config import REFERENCE_TABLE, STATISTICS_TABLE, QualityRules
from trendlake.operators.quality import QualityGateError
from trendlake.operators import rollups
from trendlake.operators.rollups import gold_base
from trendlake.plans import cli
from trendlake.plans.gold import silver_to_gold
from trendlake.plans.medallion import run_all, silver_loaders, silver_quality
from trendlake.plans.silver import (
    STORE_SCHEMA,
    LayoutError,
    bronze_to_silver_reference,
    bronze_to_silver_statistics,
    read_bronze_statistics,
)
from trendlake.sinks.landing import land_raw_json, land_reference_json
from trendlake.sinks.reports import RowMetrics
from trendlake.sinks.tables import write_partitions
from trendlake.sources.quarantine import split_quarantine
from trendlake.sources.statistics import explode_items, read_stats_api_json, read_stats_csv
from trendlake.sources.tables import optional_table, read_table, region_pruned_scan
from trendlake.staging import materialize, shared_dir
from trendlake.streaming import incremental
from trendlake.streaming.incremental import error_folder, incremental_reference, incremental_statistics

HEADER = "video_id,trending_date,title,channel_title,category_id,publish_time,tags,views,likes,dislikes,comment_count\n"


def csv_line(video="v1", date="17.14.11", title="t", channel="c", category="1", views="100", likes="5", comments="1"):
    return f"{video},{date},{title},{channel},{category},p,x,{views},{likes},0,{comments}\n"


def document(*ids, timestamp="2024-01-02T05:00:00+00:00", region="us", views="10"):
    items = [
        {
            "id": key,
            "snippet": {"title": "t", "channelTitle": "c", "categoryId": "1", "publishedAt": "p"},
            "statistics": {"viewCount": views, "likeCount": "1"},
            "contentDetails": {"duration": "x"},
        }
        for key in ids
    ]
    return {"kind": "list", "items": items, "_metadata": {"run_id": "r", "region": region, "timestamp": timestamp}}


def category(key, title):
    return {"id": key, "snippet": {"title": title, "channelId": "c", "assignable": True}}


def silver_of(spark, path):
    return spark.read.schema(schemas.SILVER_STATISTICS).parquet(path)


def test_csv_quotes_line_breaks_and_column_order(spark, write):
    root = write("region=ca/x.csv", HEADER + csv_line(title='"a ""q"",\nb"') + csv_line("v2"))
    rows = read_stats_csv(spark, root)
    assert as_tuples(rows, "video_id", "title", "views", "region") == [
        ("v1", 'a "q",\nb', "100", "ca"), ("v2", "t", "100", "ca"),
    ]


def test_csv_with_other_columns_is_not_shifted(spark, write):
    root = write("region=ca/x.csv", HEADER + csv_line())
    write("region=us/x.csv", "video_id,views\nv9,5\n")
    with pytest.raises(Exception, match="header|FAILED_READ_FILE"):
        read_stats_csv(spark, root).collect()
    assert read_stats_csv(spark, root, ["us"]).first()["views"] == "5"


def test_only_the_wanted_region_folders_are_read(spark, write):
    root = write("region=ca/x.csv", HEADER + csv_line())
    write("region=us/x.csv", "not,a\nstatistics,file\n")
    write("region=us/date=2024-01-02/hour=05/r.json", document("a1"))
    assert as_tuples(read_stats_csv(spark, root, ["ca", "mx"]), "region") == [("ca",)]
    assert read_stats_api_json(spark, root, ["us"]).count() == 1


def test_mixed_formats_and_depths(spark, write):
    root = write("region=ca/x.csv", HEADER + csv_line() + csv_line(date="garbage", video="v2"))
    write("region=us/date=2024-01-02/hour=05/r.json", document("a1", "a2"))
    write("loose.json", document("a3", region="mx"))
    write("region=us/date=2024-01-02/hour=06/broken.json", '{"items": [{"id"')
    rows, errors = read_bronze_statistics(spark, root)
    assert as_tuples(rows, "video_id", "region", "trending_date") == [
        ("a1", "us", "24.02.01"), ("a2", "us", "24.02.01"), ("a3", "mx", "24.02.01"),
        ("v1", "ca", "17.14.11"), ("v2", "ca", "garbage"),
    ]
    _, bad = split_quarantine(read_stats_api_json(spark, root))
    assert as_tuples(bad, "region", "error") == as_tuples(errors, "region", "error") == [("us", "malformed JSON")]


def test_layout_is_checked(spark, write):
    with pytest.raises(ValueError, match="layout"):
        read_stats_api_json(spark, write("a.json", "{}"), layout="csv")


def test_statistics_job_is_repeatable_and_reports_counts(spark, write, tmp_path):
    root = write("region=ca/x.csv", HEADER + csv_line() + csv_line(views="90") + csv_line(video="", title=""))
    write("region=us/date=2024-01-02/hour=05/r.json", document("a1"))
    target = str(tmp_path / "silver")
    for _ in range(2):
        run = bronze_to_silver_statistics(spark, root, target, "nightly")
        assert (run.rows_read, run.rows_written) == (4, 2)
        assert run.null_counts == {"video_id": 0, "title": 0, "views": 0}
        assert as_tuples(silver_of(spark, target), "video_id", "views", "region", "_job_name") == [
            ("a1", 10, "us", "nightly"), ("v1", 100, "ca", "nightly"),
        ]
    write("region=us/date=2024-01-02/hour=05/r.json", document("a1", views="11"))
    bronze_to_silver_statistics(spark, root, target, regions=["us"], table=None)
    assert as_tuples(silver_of(spark, target), "video_id", "views") == [("a1", 11), ("v1", 100)]


def test_nothing_to_read_is_skipped(spark, write, tmp_path):
    root = write("region=ca/readme.txt", "nothing here")
    assert bronze_to_silver_statistics(spark, root, str(tmp_path / "silver")).skipped
    assert bronze_to_silver_statistics(spark, str(tmp_path / "gone"), str(tmp_path / "silver")).skipped


def test_rows_without_any_id_write_nothing(spark, write, tmp_path):
    root = write("region=ca/x.csv", HEADER + csv_line(video=""))
    run = bronze_to_silver_statistics(spark, root, str(tmp_path / "silver"))
    assert (run.skipped, run.rows_read, run.rows_written) == (False, None, 0)


def test_metrics_of_an_empty_frame(spark):
    metrics = RowMetrics.new("none")
    metrics.watch(spark.range(0)).write.format("noop").mode("overwrite").save()
    assert metrics.result()["rows"] == 0


def test_catalog_table(spark, tmp_path):
    path = str(tmp_path / "t")
    table = f"cat_{abs(hash(path))}"
    rows = spark.createDataFrame([("us", 1), ("ca", 2), (None, 3)], "region string, n int")
    write_partitions(rows, path, table=table)
    write_partitions(rows.filter("region = 'us'").withColumn("n", F.lit(9)), path, table=table)
    write_partitions(spark.createDataFrame([("mx", 4)], "region string, n int"), path, table=table)
    assert as_tuples(read_table(spark, name=table), "region", "n") == [("ca", 2), ("mx", 4), ("us", 9), (None, 3)]
    write_partitions(rows.filter("region = 'ca'"), path, table=table, whole=True)
    assert as_tuples(read_table(spark, name=table), "region", "n") == [("ca", 2)]
    spark.sql(f"DROP TABLE {table}")


def test_catalog_follows_days_that_left(spark, write, tmp_path):
    target = str(tmp_path / "silver")
    table = f"silver_{abs(hash(target))}"
    root = write("region=ca/x.csv", HEADER + csv_line() + csv_line("v2", date="17.15.11"))
    bronze_to_silver_statistics(spark, root, target, table=table)
    assert read_table(spark, name=table).count() == 2
    write("region=ca/x.csv", HEADER + csv_line("v3", date="17.15.11"))
    bronze_to_silver_statistics(spark, root, target, table=table)
    assert as_tuples(read_table(spark, name=table), "video_id") == [("v3",)]
    spark.sql(f"DROP TABLE {table}")


def test_region_filter_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    write_partitions(spark.createDataFrame([("us", 1), ("ca", 2)], "region string, n int"), path)
    pruned = region_pruned_scan(read_table(spark, path=path), ["us"])
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(region" in plan
    assert as_tuples(pruned, "region", "n") == [("us", 1)]


def test_optional_table_hides_only_absence(spark):
    assert optional_table(lambda: spark.read.table("no_such_table")) is None
    assert optional_table(lambda: spark.read.parquet("/no/such/folder")) is None
    with pytest.raises(AnalysisException):
        optional_table(lambda: spark.range(1).select("nothing"))


def test_landing(spark, tmp_path):
    root = str(tmp_path / "raw")
    schema = "region string, items " + schemas.API_DOCUMENT["items"].dataType.simpleString()
    item = ("a1", ("t", "c", "1", "p"), ("10", "1", None))
    documents = spark.createDataFrame([(" US\n", [item, item]), ("ca", [item]), ("mx", None)], schema)
    landed_at = F.lit("2024-01-02 05:06:07").cast("timestamp")
    for _ in range(2):
        land_raw_json(documents, root, landed_at)
    back = read_stats_api_json(spark, root)
    meta = as_tuples(back, "region", "_metadata.run_id", "_metadata.video_count", "_metadata.timestamp")
    expected = [(r, "20240102_050607", n, "2024-01-02T05:06:07.000000+00:00") for r, n in (("ca", 1), ("mx", 0), ("us", 2))]
    assert meta == sorted(expected * 2, key=repr)
    assert explode_items(back).count() == 6
    assert "/region=us/date=2024-01-02/hour=05/" in back.filter("region = 'us'").first()["_source_file"]


def test_reference_landing_replaces_the_day(spark, tmp_path):
    root = str(tmp_path / "raw")
    documents = spark.createDataFrame([("us", [("1",)])], "region string, items array<struct<id:string>>")
    landed_at = F.lit("2024-01-02 05:06:07").cast("timestamp")
    for _ in range(2):
        land_reference_json(documents, root, landed_at)
    assert spark.read.json(root).count() == 1


def bronze_tree(write):
    lines = "".join(csv_line(f"v{i}", f"17.{1 + i % 3:02}.11", views=str(100 + i)) for i in range(30))
    root = write("stats/region=ca/x.csv", HEADER + lines)
    write("stats/region=us/date=2024-01-02/hour=05/r.json", document("a1", "a2"))
    write("reference/region=ca/c.json", {"items": [category(str(i), f"name {i}") for i in range(12)]})
    return f"{root}/stats", f"{root}/reference"


def test_whole_flow(spark, write, tmp_path):
    stats, reference = bronze_tree(write)
    silver, gold, report = (str(tmp_path / name) for name in ("silver", "gold", "report"))
    run = run_all(spark, stats, reference, silver, gold, report_path=report)
    assert run.quality.quality_passed and run.statistics.rows_written == 32
    assert run.gold_rows == {"trending_analytics": 4, "channel_analytics": 2, "category_analytics": 4}
    for name, schema in (
        ("trending_analytics", schemas.TRENDING_ANALYTICS),
        ("channel_analytics", schemas.CHANNEL_ANALYTICS),
        ("category_analytics", schemas.CATEGORY_ANALYTICS),
    ):
        table = spark.read.parquet(f"{gold}/{name}")
        assert {f.name: f.dataType for f in table.schema} == {f.name: f.dataType for f in schema}
    channels = spark.read.parquet(f"{gold}/channel_analytics")
    assert as_tuples(channels, "region", "total_videos", "rank_in_region", "categories") == [
        ("ca", 30, 1, ["name 1"]), ("us", 2, 1, ["name 1"]),
    ]
    assert spark.read.parquet(report).count() == run.quality.checks_total
    again = run_all(spark, stats, reference, silver, gold)
    assert again.gold_rows == run.gold_rows
    assert spark.read.parquet(f"{gold}/trending_analytics").count() == 4


def test_closed_gate_builds_no_gold(spark, write, tmp_path):
    stats, reference = bronze_tree(write)
    gold = tmp_path / "gold"
    with pytest.raises(QualityGateError, match="1 of"):
        run_all(spark, stats, reference, str(tmp_path / "silver"), str(gold), QualityRules(min_rows=20))
    assert not gold.exists()


def test_missing_silver_fails_the_verdict(spark, tmp_path):
    run = silver_quality(spark, silver_loaders(spark, str(tmp_path / "none")))
    assert not run.quality_passed
    assert {r["check"] for r in run.report.collect()} == {"read_table"}


def test_command_line(spark, write, tmp_path, capsys):
    stats, reference = bronze_tree(write)
    silver, gold = str(tmp_path / "silver"), str(tmp_path / "gold")
    assert cli.main(["statistics", "--bronze", stats, "--silver", f"{silver}/{STATISTICS_TABLE}"]) == 0
    assert cli.main(["reference", "--bronze", reference, "--silver", f"{silver}/{REFERENCE_TABLE}"]) == 0
    assert cli.main(["quality", "--silver", silver]) == 0
    wrong = ["quality", "--silver", silver, "--tables", f"{STATISTICS_TABLE},{REFERENCE_TABLE},absent"]
    assert cli.main(wrong) == 1
    assert cli.main(["gold", "--silver", silver, "--gold", gold]) == 0
    lines = [json.loads(line) for line in capsys.readouterr().out.splitlines() if line.startswith("{")]
    assert lines[0] == {"skipped": False, "read": 32, "written": 32, "errors": {"count": 0, "first": []}}
    assert lines[2] == {"quality_passed": True, "checks_passed": 9, "checks_total": 9}
    assert lines[3] == {"quality_passed": False, "checks_passed": 14, "checks_total": 15}
    assert lines[4]["channel_analytics"] == 2


def test_gold_without_reference_table(spark, write, tmp_path):
    stats, _ = bronze_tree(write)
    silver, gold = str(tmp_path / "silver"), str(tmp_path / "gold")
    cli.main(["statistics", "--bronze", stats, "--silver", f"{silver}/{STATISTICS_TABLE}"])
    cli.main(["gold", "--silver", silver, "--gold", gold])
    assert as_tuples(spark.read.parquet(f"{gold}/category_analytics"), "category_name")[0] == ("Unknown",)


def test_incremental_statistics(spark, write, tmp_path):
    store, progress = str(tmp_path / "store"), str(tmp_path / "progress")

    def run():
        incremental_statistics(spark, str(tmp_path / "bronze"), store, progress)
        return as_tuples(spark.read.schema(STORE_SCHEMA).parquet(store), "video_id", "region", "views")

    write("region=us/date=2024-01-02/hour=05/r.json", document("a1", "a2", views="50"))
    first = [("a1", "us", 50), ("a2", "us", 50)]
    assert run() == first
    assert run() == first
    # Later on the same day: the later landing wins, even with a lower count.
    write("region=us/date=2024-01-02/hour=09/r.json", document("a1", timestamp="2024-01-02T09:00:00Z", views="40"))
    write("region=ca/date=2024-01-03/hour=01/r.json", document("a1", timestamp="2024-01-03T01:00:00Z"))
    write("region=ca/date=2024-01-03/hour=02/broken.json", "{")
    second = [("a1", "ca", 10), ("a1", "us", 40), ("a2", "us", 50)]
    assert run() == second
    # An old file that arrives late does not replace what was landed after it.
    write("region=us/date=2024-01-02/hour=01/r.json", document("a1", timestamp="2024-01-02T01:00:00Z", views="99"))
    assert run() == second


def test_incremental_csv_with_unknown_dates_and_regions(spark, write, tmp_path):
    store, progress = str(tmp_path / "store"), str(tmp_path / "progress")
    header = "video_id,trending_date,title,channel_title,category_id,publish_time,views,likes,comment_count\n"

    def run():
        incremental_statistics(spark, str(tmp_path / "bronze"), store, progress, source="csv")
        return as_tuples(spark.read.schema(STORE_SCHEMA).parquet(store), "video_id", "region", "views")

    write("region=us/a.csv", header + "v1,garbage,t,c,1,p,5,1,1\nv2,garbage,t,c,1,p,5,1,1\n")
    assert run() == [("v1", "us", 5), ("v2", "us", 5)]
    write("region=us/b.csv", header + "v1,garbage,t,c,1,p,9,1,1\n")
    write("region= /b.csv", header + "v1,garbage,t,c,1,p,9,1,1\n")
    assert run() == [("v1", "us", 9), ("v1", None, 9), ("v2", "us", 5)]
    write("region= /c.csv", header + "v3,garbage,t,c,1,p,9,1,1\n")
    assert run() == [("v1", "us", 9), ("v1", None, 9), ("v2", "us", 5), ("v3", None, 9)]


def test_stored_rows_are_pruned_and_exact(spark, tmp_path):
    path = str(tmp_path / "store")
    days = [f"2024-01-{d:02}" for d in range(1, 29)]
    rows = [(r, d, r, i) for i, d in enumerate([*days, None]) for r in ("us", "ca", None)]
    stored = spark.createDataFrame(rows, "region string, trending_date_parsed string, r string, n int")
    stored = stored.withColumn("trending_date_parsed", F.col("trending_date_parsed").cast("date"))
    write_partitions(stored, path, incremental.STORE_PARTITIONS)
    back = spark.read.parquet(path)
    touched = [("us", "2024-01-03"), ("us", "2024-01-05"), (None, None), (None, "2024-01-01")]
    fresh = spark.createDataFrame(touched, "region string, trending_date_parsed string")
    fresh = fresh.withColumn("trending_date_parsed", F.col("trending_date_parsed").cast("date"))
    found = incremental.stored_rows(back, fresh)
    assert as_tuples(found, "r", "n") == sorted([("us", 2), ("us", 4), (None, 28), (None, 0)], key=repr)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: []" not in plan and "LeftSemi" in plan


def test_broken_replacement_is_taken_up_again(spark, write, tmp_path, monkeypatch):
    store, progress = str(tmp_path / "store"), str(tmp_path / "progress")

    def run():
        incremental_statistics(spark, str(tmp_path / "bronze"), store, progress)
        return as_tuples(spark.read.schema(STORE_SCHEMA).parquet(store), "video_id", "views")

    write("region=us/date=2024-01-02/hour=05/r.json", document("a1", "a2", views="50"))
    assert run() == [("a1", 50), ("a2", 50)]
    write("region=us/date=2024-01-02/hour=09/r.json", document("a3", timestamp="2024-01-02T09:00:00Z"))
    plain = incremental.write_partitions

    def lost(df, path, *more):
        # The driver is lost when the old files are gone and the new ones not yet there.
        incremental.remove_folders(spark, [path])
        raise RuntimeError("lost")

    monkeypatch.setattr(incremental, "write_partitions", lost)
    with pytest.raises(Exception, match="lost"):
        run()
    monkeypatch.setattr(incremental, "write_partitions", plain)
    assert run() == [("a1", 50), ("a2", 50), ("a3", 10)]
    assert run() == [("a1", 50), ("a2", 50), ("a3", 10)]


def test_both_layouts_below_one_root(spark, write, tmp_path):
    root = str(tmp_path / "bronze")
    schema = "region string, items " + schemas.API_DOCUMENT["items"].dataType.simpleString()
    many = [("us", [(f"a{i}", ("t", "c", "1", "p"), ("10", "1", None))]) for i in range(20)]
    land_raw_json(spark.createDataFrame(many, schema), root, F.lit("2024-01-02 05:06:07").cast("timestamp"))
    write("region=us/date=2024-01-02/hour=06/one.json", document("b1", "b2"))
    several = "\n".join(json.dumps(document(f"c{i}")) for i in range(5))
    write("region=us/date=2024-01-02/hour=07/several.json", several)
    indented = "\n\n".join(json.dumps(document(f"d{i}"), indent=1) for i in range(3))
    write("region=us/date=2024-01-02/hour=08/indented.json", indented)
    target = str(tmp_path / "silver")
    run = bronze_to_silver_statistics(spark, root, target)
    assert run.rows_written == 30 and run.errors.count() == 0


def test_text_after_a_document_is_an_error(spark, write):
    write("region=us/a.json", json.dumps(document("a1")) + " {}")
    write("region=us/b.json", json.dumps(document("a2")) + "\nrest")
    tricky = document("a3")
    tricky["items"][0]["snippet"]["title"] = '} { "}\n{" \\'
    root = write("region=us/c.json", tricky)
    good, bad = split_quarantine(read_stats_api_json(spark, root))
    assert as_tuples(explode_items(good), "item.id") == [("a3",)]
    assert as_tuples(bad, "error") == [("malformed JSON",)] * 2


def test_broken_files_are_reported_by_every_run(spark, write, tmp_path):
    root = write("region=us/date=2024-01-02/hour=05/r.json", document("a1"))
    write("region=ca/date=2024-01-02/hour=05/r.json", "{")
    batch = bronze_to_silver_statistics(spark, root, str(tmp_path / "silver"))
    assert as_tuples(batch.errors, "region", "error") == [("ca", "malformed JSON")]
    store = str(tmp_path / "store")
    for _ in range(2):
        incremental_statistics(spark, root, store, str(tmp_path / "progress"))
        assert as_tuples(spark.read.parquet(error_folder(store)), "region", "error") == [("ca", "malformed JSON")]


def test_batch_and_incremental_share_a_table(spark, write, tmp_path):
    target = str(tmp_path / "silver")
    root = write("region=ca/x.csv", HEADER + csv_line() + csv_line("v2", date="17.15.11"))
    bronze_to_silver_statistics(spark, root, target)
    write("region=us/date=2024-01-02/hour=05/r.json", document("a1"))
    incremental_statistics(spark, root, target, str(tmp_path / "progress"))
    rows = silver_of(spark, target)
    assert as_tuples(rows, "video_id", "region") == [("a1", "us"), ("v1", "ca"), ("v2", "ca")]
    other = str(tmp_path / "old")
    write_partitions(rows, other)
    with pytest.raises(LayoutError, match="region"):
        bronze_to_silver_statistics(spark, root, other)
    with pytest.raises(LayoutError):
        incremental_statistics(spark, root, other, str(tmp_path / "more"))


def test_days_that_left_bronze_leave_silver(spark, write, tmp_path):
    target = str(tmp_path / "silver")
    root = write("region=a b/x.csv", HEADER + csv_line() + csv_line("v2", date="17.15.11"))
    write("region=us/x.csv", HEADER + csv_line("u1"))
    bronze_to_silver_statistics(spark, root, target)
    write("region=a b/x.csv", HEADER + csv_line("v3"))
    bronze_to_silver_statistics(spark, root, target, regions=["a b"])
    assert as_tuples(silver_of(spark, target), "video_id", "region") == [("u1", "us"), ("v3", "a b")]


def test_largest_counts_do_not_end_a_run(spark, write, tmp_path):
    huge = str(2**63 - 1)
    lines = "".join(csv_line(f"v{i}", views=huge, likes=huge, comments=huge) for i in range(3))
    root = write("stats/region=ca/x.csv", HEADER + lines + "".join(csv_line(f"n{i}", date="17.15.11") for i in range(9)))
    silver, gold = str(tmp_path / "silver"), str(tmp_path / "gold")
    rules = QualityRules(max_views=2**63 - 1)
    run = run_all(spark, f"{root}/stats", f"{root}/none", silver, gold, rules)
    assert run.reference is None and run.gold_rows["trending_analytics"] == 2
    rows = {str(r["trending_date_parsed"]): r for r in spark.read.parquet(f"{gold}/trending_analytics").collect()}
    assert rows["2017-11-14"]["total_likes"] is None and rows["2017-11-14"]["max_views"] == 2**63 - 1
    assert rows["2017-11-15"]["total_likes"] == 45
    assert rows["2017-11-14"]["avg_engagement_rate"] == 200.0


def test_regions_that_left_silver_leave_gold(spark, write, tmp_path):
    stats, reference = bronze_tree(write)
    silver, gold = str(tmp_path / "silver"), str(tmp_path / "gold")
    run_all(spark, stats, reference, silver, gold)
    table = silver_loaders(spark, silver)[STATISTICS_TABLE]().filter("region = 'us'")
    silver_to_gold(table, None, gold)
    for name in ("trending_analytics", "channel_analytics", "category_analytics"):
        assert as_tuples(spark.read.parquet(f"{gold}/{name}").select("region").distinct(), "region") == [("us",)]


def test_gold_reads_silver_twice_and_copies_no_row(spark, write, tmp_path):
    stats, reference = bronze_tree(write)
    silver = str(tmp_path / "silver")
    bronze_to_silver_statistics(spark, stats, f"{silver}/{STATISTICS_TABLE}")
    statistics = silver_loaders(spark, silver)[STATISTICS_TABLE]()
    base = gold_base(statistics)
    staged = materialize(base, "base")
    builds = (rollups.trending_analytics, rollups.channel_totals, rollups.category_analytics)
    plans = [base, *(build(statistics, staged) for build in builds)]
    texts = [p._jdf.queryExecution().executedPlan().toString() for p in plans]
    scans = [line for text in texts for line in text.splitlines() if "FileScan" in line and "video_id#" in line]
    assert len(scans) == 2 and not any("Expand" in text for text in texts)


def test_staged_tables_go_when_the_job_ends(spark, write, tmp_path):
    stats, _ = bronze_tree(write)
    silver = str(tmp_path / "silver")
    bronze_to_silver_statistics(spark, stats, silver)
    before = set(glob.glob(f"{shared_dir(spark).removeprefix('file:')}/trendlake/*"))
    silver_to_gold(silver_of(spark, silver), None, str(tmp_path / "gold"))
    assert set(glob.glob(f"{shared_dir(spark).removeprefix('file:')}/trendlake/*")) == before


def test_outcomes_failed_rows_and_report_runs(spark, write, tmp_path):
    stats, reference = bronze_tree(write)
    write("stats/region=mx/date=2024-01-02/hour=05/r.json", "{")
    folders = [str(tmp_path / n) for n in ("silver", "gold", "report", "failed")]
    run = run_all(spark, stats, reference, *folders[:2], report_path=folders[2], failed_path=folders[3])
    outcomes = {r["region"]: (r["outcome"], r["errors"]) for r in run.outcomes.collect()}
    assert outcomes == {"ca": ("success", 0), "us": ("success", 0), "mx": ("failed", 1)}
    report = spark.read.parquet(folders[2])
    assert report.select("run_id").distinct().count() == 1 and report.filter("checked_at IS NULL").count() == 0
    strict = QualityRules(min_rows=10_000)
    silver_quality(spark, silver_loaders(spark, folders[0]), strict, folders[2], folders[3])
    assert spark.read.parquet(folders[2]).select("run_id").distinct().count() == 2
    assert {r["check"] for r in spark.read.json(folders[3]).collect()} == {"row_count"}


def test_incremental_reference(spark, write, tmp_path):
    target, progress = str(tmp_path / "silver"), str(tmp_path / "progress")

    def run():
        incremental_reference(spark, str(tmp_path / "bronze"), target, progress)
        return as_tuples(spark.read.schema(schemas.SILVER_REFERENCE).parquet(target), "region", "id")

    write("region=us/a.json", {"items": [category("1", "x"), category("2", "y")]})
    write("region=ca/a.json", {"items": [category("1", "x")]})
    assert run() == [("ca", "1"), ("us", "1"), ("us", "2")]
    write("region=us/b.json", {"items": [category("3", "z")]})
    write("region=ca/b.json", {"items": []})
    assert run() == [("ca", "1"), ("us", "3")]
    assert run() == [("ca", "1"), ("us", "3")]


def test_incremental_reference_in_batches_as_the_batch_job(spark, write, tmp_path, monkeypatch):
    bronze, target, progress = (str(tmp_path / name) for name in ("bronze", "silver", "progress"))

    def land(day, pages, regions=("us", "ca")):
        for region in regions:
            for p in pages:
                landing = {"run_id": f"run{day}", "region": region, "timestamp": f"2024-01-0{day}T05:00:00+00:00", "page": p}
                items = [category(f"{day}{p}", "x"), category("same", f"day {day} page {p}")]
                write(f"region={region}/date=2024-01-0{day}/layout=lines/{p}.json", json.dumps({"items": items, "_metadata": landing}))

    def rows(path):
        return as_tuples(spark.read.schema(schemas.SILVER_REFERENCE).parquet(path), "region", "id", "snippet_title")

    def run():
        incremental_reference(spark, bronze, target, progress, max_files=1)
        bronze_to_silver_reference(spark, bronze, str(tmp_path / "batch"))
        assert rows(target) == rows(str(tmp_path / "batch"))
        return len(rows(target))

    land(2, [0, 3])
    assert run() == 2 * 3  # two pages and the shared id, from four batches
    land(2, [2])  # a page between pages, in another run
    assert run() == 2 * 4
    land(1, [0, 9])  # late files of an older landing
    assert run() == 2 * 4
    land(3, [0], regions=("us",))
    assert run() == 2 + 4
    land(3, [1], regions=("us",))
    plain = incremental.write_partitions

    def lost(df, path, *more):
        # The driver is lost when the old files are gone and the new ones not yet there.
        incremental.remove_folders(spark, [path + "/region=us"])
        raise RuntimeError("lost")

    monkeypatch.setattr(incremental, "write_partitions", lost)
    with pytest.raises(Exception, match="lost"):
        run()
    monkeypatch.setattr(incremental, "write_partitions", plain)
    assert run() == 3 + 4


def test_incremental_reference_keeps_a_newer_landing_of_the_batch_job(spark, write, tmp_path):
    target = str(tmp_path / "silver")
    root = write("batch/region=us/b.json", {"items": [category("2", "new")]})
    bronze_to_silver_reference(spark, f"{root}/batch", target)
    write("stream/region=us/a.json", {"items": [category("1", "old")]})
    os.utime(f"{root}/stream/region=us/a.json", (1, 1))
    incremental_reference(spark, f"{root}/stream", target, str(tmp_path / "progress"))
    table = spark.read.schema(schemas.SILVER_REFERENCE).parquet(target)
    assert as_tuples(table, "id", "snippet_title") == [("2", "new")]
