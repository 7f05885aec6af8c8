"""Quality checks: all checks of a table are answered by one aggregate over it."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendlake import schemas
from trendlake.config import FRESHNESS_COLUMNS, QualityRules
from trendlake.functions.clock import hours_before, instant
from trendlake.functions.columns import missing_columns, quoted

_ROWS = "rows"


@dataclass(frozen=True)
class Check:
    """One report row, and the aggregates over the table it is computed from."""

    row: Column
    measures: Mapping[str, Column] = field(default_factory=dict)


def _report_row(**values: Column | str | float | bool | None) -> Column:
    def typed(item: T.StructField) -> Column:
        value = values.get(item.name)
        column = value if isinstance(value, Column) else F.lit(value)
        return column.cast(item.dataType).alias(item.name)

    return F.struct(*(typed(item) for item in schemas.DQ_REPORT.fields))


def is_missing(df: DataFrame, name: str) -> Column:
    """True for null, and for NaN in a floating column."""
    column = quoted(name)
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def row_count_check(df: DataFrame, table: str, rules: QualityRules) -> list[Check]:
    rows = F.col(_ROWS)
    return [
        Check(
            _report_row(
                check="row_count",
                table=table,
                value=rows,
                threshold=rules.min_rows,
                passed=rows >= rules.min_rows,
                message=F.format_string(f"%d rows, at least {rules.min_rows} wanted", rows),
            )
        )
    ]


def null_pct_check(df: DataFrame, table: str, rules: QualityRules) -> list[Check]:
    """Share of nulls per critical column; an empty table has none, a missing column fails."""
    checks = []
    for name in rules.critical_columns.get(table, ()):
        shared = {"check": "null_pct", "table": table, "column": name}
        if name not in df.columns:
            checks.append(Check(_report_row(**shared, passed=False, message=f"there is no column {name}")))
            continue
        nulls = F.col(f"nulls_{name}")
        share = F.coalesce(F.try_divide(nulls, F.col(_ROWS)) * 100, F.lit(0.0))
        text = f"{name}: %.2f percent null, at most {rules.max_null_pct} allowed"
        checks.append(
            Check(
                _report_row(
                    **shared,
                    value=F.round(share, 2),
                    threshold=rules.max_null_pct,
                    passed=share <= rules.max_null_pct,
                    message=F.format_string(text, share),
                ),
                {f"nulls_{name}": F.count_if(is_missing(df, name))},
            )
        )
    return checks


def schema_check(df: DataFrame, table: str, rules: QualityRules) -> list[Check]:
    missing = missing_columns(df, rules.critical_columns.get(table, ()))
    message = f"without {', '.join(missing)}" if missing else "no column is missing"
    names = F.array(*(F.lit(name) for name in missing))
    row = _report_row(
        check="schema", table=table, missing_columns=names, passed=not missing, message=message
    )
    return [Check(row)]


def value_range_check(df: DataFrame, table: str, rules: QualityRules) -> list[Check]:
    """Negative and implausibly large values; nulls are neither."""
    name = rules.ranged_columns.get(table)
    if name is None or name not in df.columns:
        return []
    negative, extreme = F.col("negative"), F.col("extreme")
    row = _report_row(
        check="value_range",
        table=table,
        column=name,
        negative_count=negative,
        extreme_count=extreme,
        passed=(negative == 0) & (extreme == 0),
        message=F.format_string(f"{name}: %d below zero, %d beyond {rules.max_views}", negative, extreme),
    )
    values = quoted(name)
    measures = {
        "negative": F.count_if(values < 0),
        "extreme": F.count_if(values > F.lit(rules.max_views).cast("bigint")),
    }
    return [Check(row, measures)]


def freshness_check(df: DataFrame, table: str, rules: QualityRules, now: Column) -> list[Check]:
    """Latest timestamp within the allowed age.

    Without a timestamp column the check passes. A table with no timestamp at all fails.
    One unreadable text skips the check, or fails it under ``strict_freshness``.
    """
    name = next((column for column in FRESHNESS_COLUMNS if column in df.columns), None)
    if name is None:
        message = "not judged: the table has no time column"
        return [Check(_report_row(check="freshness", table=table, passed=True, message=message))]
    column = quoted(name)
    is_text = isinstance(df.schema[name].dataType, T.StringType)
    moment = instant(column) if is_text else column.cast("timestamp")
    cutoff = hours_before(now, rules.max_age_hours)
    latest, unreadable = F.col("latest"), F.col("unreadable") > 0
    fresh = F.coalesce(latest >= cutoff, F.lit(False))
    message = F.when(unreadable, F.lit("not judged: some times are unreadable")).otherwise(
        F.concat(
            F.lit("newest record "),
            F.coalesce(latest.cast("string"), F.lit("none")),
            F.lit(", oldest allowed "),
            cutoff.cast("string"),
        )
    )
    row = _report_row(
        check="freshness",
        table=table,
        latest_record=F.when(~unreadable, latest.cast("string")),
        cutoff=F.when(~unreadable, cutoff.cast("string")),
        passed=F.when(unreadable, F.lit(not rules.strict_freshness)).otherwise(fresh),
        message=message,
    )
    measures = {"latest": F.max(moment), "unreadable": F.count_if(column.isNotNull() & moment.isNull())}
    return [Check(row, measures)]


def evaluate(df: DataFrame, checks: Iterable[Check]) -> DataFrame:
    """Report rows of ``checks`` from one pass; only the columns they name are read."""
    checks = list(checks)
    measures = {_ROWS: F.count(F.lit(1))}
    for check in checks:
        measures.update(check.measures)
    profile = df.agg(*(column.alias(name) for name, column in measures.items()))
    return profile.select(F.inline(F.array(*(check.row for check in checks))))


def table_checks(
    df: DataFrame, table: str, rules: QualityRules, now: Column | None = None
) -> list[Check]:
    now = F.current_timestamp() if now is None else now
    return [
        *row_count_check(df, table, rules),
        *null_pct_check(df, table, rules),
        *schema_check(df, table, rules),
        *value_range_check(df, table, rules),
        *freshness_check(df, table, rules, now),
    ]


def check_table(
    df: DataFrame, table: str, rules: QualityRules | None = None, now: Column | None = None
) -> DataFrame:
    """All checks of one table, one row each."""
    rules = rules or QualityRules()
    return evaluate(df, table_checks(df, table, rules, now))


def unreadable_report(spark: SparkSession, table: str, error: Exception) -> DataFrame:
    """The single failed row of a table that could not be read."""
    message = str(error).split("\n\tat ")[0]  # without the stack trace
    row = {"check": "read_table", "table": table, "passed": False, "message": message}
    return spark.createDataFrame([row], schemas.DQ_REPORT)


def run_checks(
    spark: SparkSession,
    tables: Mapping[str, Callable[[], DataFrame]],
    rules: QualityRules | None = None,
    now: Column | None = None,
) -> DataFrame:
    """Reports of several tables, each given as a loader.

    Every table is checked by its own job, so one that cannot be read, now or halfway
    through, becomes a failed ``read_table`` row and the others are still checked. What
    comes to the driver is the finished report, a handful of rows per table.
    """
    reports = []
    for table, load in tables.items():
        try:
            report = check_table(load(), table, rules, now)
            reports.append(spark.createDataFrame(report.collect(), schemas.DQ_REPORT))
        except (PySparkException, Py4JJavaError) as error:
            reports.append(unreadable_report(spark, table, error))
    empty = spark.createDataFrame([], schemas.DQ_REPORT)
    return reduce(DataFrame.unionByName, reports, empty)


def failed_checks(report: DataFrame) -> DataFrame:
    return report.filter(~F.col("passed"))


def check_summary(report: DataFrame) -> DataFrame:
    """One row: verdict, checks passed and checks in total. No checks at all pass."""
    return report.agg(
        F.coalesce(F.bool_and("passed"), F.lit(True)).alias("quality_passed"),
        F.count_if(F.col("passed")).alias("checks_passed"),
        F.count(F.lit(1)).alias("checks_total"),
    )


def null_counts(df: DataFrame, columns: Iterable[str] = ("video_id", "title", "views")) -> DataFrame:
    """Nulls per column, all columns in one pass: rows of ``column, null_count``."""
    columns = list(columns)
    counted = df.agg(*(F.count_if(is_missing(df, name)).alias(name) for name in columns))
    pairs = (F.struct(F.lit(name).alias("column"), quoted(name).alias("null_count")) for name in columns)
    return counted.select(F.inline(F.array(*pairs)))


class QualityGateError(RuntimeError):
    """The quality verdict was negative, so nothing downstream may run."""


def quality_gate(report: DataFrame) -> bool:
    """Verdict over a report; the one row of the summary is all that is collected."""
    return bool(check_summary(report).first()["quality_passed"])
