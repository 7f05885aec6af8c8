"""Truth table of the checks, the report and the gate."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from trendlake import schemas
from trendlake.config import REFERENCE_TABLE, STATISTICS_TABLE, QualityRules
from trendlake.operators import quality
from trendlake.sinks.reports import failed_checks_json, region_outcomes, run_summary


def now():
    return F.lit("2024-01-10 00:00:00").cast("timestamp")


def table(spark, rows=20, views="id", stamp="timestamp '2024-01-09'", **replaced):
    columns = {
        "video_id": "concat('v', id)",
        "title": "'t'",
        "channel_title": "'c'",
        "views": views,
        "region": "'us'",
        "_processed_at": stamp,
        **replaced,
    }
    kept = [f"{expression} AS {name}" for name, expression in columns.items() if expression]
    return spark.range(rows).selectExpr(*kept)


def report(df, name=STATISTICS_TABLE, **rules):
    rows = quality.check_table(df, name, QualityRules(**rules), now()).collect()
    return {(r["check"], r["column"]): r for r in rows}


def failed(df, **rules):
    return sorted((c, col) for (c, col), r in report(df, **rules).items() if not r["passed"])


def test_good_table(spark):
    rows = report(table(spark))
    assert len(rows) == 9 and all(r["passed"] for r in rows.values())
    assert rows["row_count", None]["message"] == "20 rows, at least 10 wanted"
    assert rows["null_pct", "views"]["message"] == "views: 0.00 percent null, at most 5.0 allowed"
    assert quality.check_table(table(spark), STATISTICS_TABLE).schema.names == schemas.DQ_REPORT.names


def test_too_few_rows(spark):
    assert failed(table(spark, rows=9)) == [("row_count", None)]
    assert failed(table(spark, rows=9), min_rows=9) == []


def test_empty_table(spark):
    assert failed(table(spark, rows=0)) == [("freshness", None), ("row_count", None)]


def test_null_share_is_compared_before_rounding(spark):
    nulls = table(spark, rows=10_000, title="if(id < 500, null, 't')")
    assert failed(nulls) == []
    just_over = table(spark, rows=100_000, title="if(id < 5001, null, 't')")
    rows = report(just_over)
    assert rows["null_pct", "title"]["value"] == 5.0
    assert not rows["null_pct", "title"]["passed"]


def test_nan_counts_as_null(spark):
    assert ("null_pct", "views") in failed(table(spark, views="double('NaN')"))


def test_missing_column_fails_twice(spark):
    rows = report(table(spark, title=None))
    assert not rows["null_pct", "title"]["passed"] and not rows["schema", None]["passed"]
    assert rows["schema", None]["missing_columns"] == ["title"]


def test_value_range(spark):
    rows = report(table(spark, views="case id when 1 then -1 when 2 then 60000000000 when 3 then null else 5 end"))
    row = rows["value_range", "views"]
    assert (row["negative_count"], row["extreme_count"], row["passed"]) == (1, 1, False)
    assert report(table(spark, views="50000000000"))["value_range", "views"]["passed"]
    assert ("value_range", "views") not in report(table(spark, views=None))
    assert ("value_range", "views") not in report(table(spark), REFERENCE_TABLE)


@pytest.mark.parametrize(
    ("stamp", "passed"),
    [
        ("timestamp '2024-01-08 00:00:00'", True),
        ("timestamp '2024-01-07 23:59:59'", False),
        ("cast(null as timestamp)", False),
        ("'2024-01-09T10:00:00+00:00'", True),
        ("'2024-01-09T10:00:00'", True),
        ("'2023-01-09'", False),
        ("if(id = 1, 'nonsense', '2023-01-09')", True),
    ],
)
def test_freshness(spark, stamp, passed):
    assert report(table(spark, stamp=stamp))["freshness", None]["passed"] is passed


def test_freshness_options(spark):
    assert report(table(spark, stamp=None))["freshness", None]["passed"]
    broken = table(spark, stamp="'nonsense'")
    assert not report(broken, strict_freshness=True)["freshness", None]["passed"]
    ingested = table(spark, stamp=None, _ingestion_timestamp="'2023-01-01'")
    assert not report(ingested)["freshness", None]["passed"]


def test_one_scan_with_only_the_needed_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    table(spark).withColumn("unused", F.lit("x")).write.parquet(path)
    plan = quality.check_table(spark.read.parquet(path), STATISTICS_TABLE)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "unused" not in plan


def test_unreadable_tables_do_not_stop_the_others(spark, tmp_path):
    folder = tmp_path / "broken"
    folder.mkdir()
    (folder / "a.parquet").write_text("this is no parquet file")
    loaders = {
        "gone": lambda: spark.read.table("no_such_table"),
        "broken": lambda: spark.read.schema("video_id string").parquet(str(folder)),
        STATISTICS_TABLE: lambda: table(spark),
    }
    rows = quality.run_checks(spark, loaders, now=now())
    found = {(r["table"], r["check"]): r["passed"] for r in rows.collect()}
    assert found["gone", "read_table"] is False
    assert found["broken", "read_table"] is False
    assert found[STATISTICS_TABLE, "row_count"] is True
    assert not quality.quality_gate(rows)
    summary = quality.check_summary(rows).first()
    assert (summary["checks_passed"], summary["checks_total"]) == (9, 11)
    texts = failed_checks_json(rows).collect()
    assert len(texts) == 2 and all(len(r["subject"]) <= 100 for r in texts)


def test_whole_tables_are_checked_and_no_tables_pass(spark):
    rows = quality.run_checks(spark, {STATISTICS_TABLE: lambda: table(spark, rows=50)}, now=now())
    assert {r["value"] for r in rows.collect() if r["check"] == "row_count"} == {50.0}
    assert quality.quality_gate(quality.run_checks(spark, {}))


def test_rules_from_env():
    rules = QualityRules.from_env({"DQ_MIN_ROW_COUNT": "3", "DQ_MAX_NULL_PERCENT": "1.5"})
    assert (rules.min_rows, rules.max_null_pct, rules.max_age_hours) == (3, 1.5, 48)
    assert QualityRules.from_env({}) == QualityRules()


def test_null_counts(spark):
    rows = quality.null_counts(table(spark, title="if(id < 3, null, 't')")).collect()
    assert {r["column"]: r["null_count"] for r in rows} == {"video_id": 0, "title": 3, "views": 0}


def test_summaries(spark):
    rows = spark.createDataFrame([("a", "us"), ("a", "us"), ("b", "ca")], "_source_file string, region string")
    assert sorted(map(tuple, run_summary(rows).collect())) == [("a", "us", 2), ("b", "ca", 1)]
    failed_rows = spark.createDataFrame([("ca", "x"), ("mx", "y")], "region string, error string")
    got = {r["region"]: r["outcome"] for r in region_outcomes(rows, failed_rows).collect()}
    assert got == {"us": "success", "ca": "failed", "mx": "failed"}
