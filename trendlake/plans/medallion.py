"""The whole flow: both silver tables, the quality gate, then gold."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from trendlake import schemas
from trendlake.config import REFERENCE_TABLE, STATISTICS_TABLE, QualityRules
from trendlake.operators.quality import QualityGateError, check_summary, run_checks
from trendlake.plans.gold import silver_to_gold
from trendlake.plans.silver import (
    ReferenceRun,
    StatisticsRun,
    bronze_to_silver_statistics,
    write_reference,
)
from trendlake.sinks.reports import region_outcomes, run_summary, write_dq_report, write_failed_checks, write_run_rows
from trendlake.sources.files import optional_frame
from trendlake.sources.reference import read_reference_json
from trendlake.sources.tables import read_table


@dataclass(frozen=True)
class QualityRun:
    """Verdict, totals and the report behind them."""

    quality_passed: bool
    checks_passed: int
    checks_total: int
    report: DataFrame


@dataclass(frozen=True)
class MedallionRun:
    """What a whole run did; ``reference`` is None when there was no reference folder.

    ``outcomes`` has every region that was landed, with the number of its unusable documents; it is stored
    by the run id of the statistics beside their table.
    """

    statistics: StatisticsRun
    reference: ReferenceRun | None
    quality: QualityRun
    gold_rows: dict[str, int]
    outcomes: DataFrame


def silver_quality(
    spark: SparkSession,
    tables: Mapping[str, Callable[[], DataFrame]],
    rules: QualityRules | None = None,
    report_path: str | None = None,
    failed_path: str | None = None,
) -> QualityRun:
    """Check the whole tables, keep the report and its failed rows, and give the verdict."""
    report = run_checks(spark, tables, rules)
    if report_path is not None:
        write_dq_report(report, report_path)
    if failed_path is not None:
        write_failed_checks(report, failed_path)
    summary = check_summary(report).first()
    return QualityRun(
        summary["quality_passed"], summary["checks_passed"], summary["checks_total"], report
    )


def silver_loaders(spark: SparkSession, silver: str) -> dict[str, Callable[[], DataFrame]]:
    """Loaders of both silver tables below the folder ``silver``."""
    paths = {name: f"{silver.rstrip('/')}/{name}" for name in (STATISTICS_TABLE, REFERENCE_TABLE)}
    return {
        STATISTICS_TABLE: lambda: read_table(
            spark, path=paths[STATISTICS_TABLE], schema=schemas.SILVER_STATISTICS
        ),
        # New columns of later files are seen too.
        REFERENCE_TABLE: lambda: read_table(spark, path=paths[REFERENCE_TABLE], merge_schema=True),
    }


def run_all(
    spark: SparkSession,
    bronze_statistics: str,
    bronze_reference: str,
    silver: str,
    gold: str,
    rules: QualityRules | None = None,
    regions: Sequence[str] | None = None,
    layout: str = "auto",
    report_path: str | None = None,
    failed_path: str | None = None,
) -> MedallionRun:
    """Silver, gate, gold. A negative verdict raises before anything of gold is written.

    Without a reference folder the run goes on: the checks then cover the statistics, and every
    category without an earlier reference table is unknown.
    """
    silver = silver.rstrip("/")
    documents = optional_frame(lambda: read_reference_json(spark, bronze_reference, regions, layout))
    reference = None if documents is None else write_reference(documents, f"{silver}/{REFERENCE_TABLE}")
    statistics = bronze_to_silver_statistics(
        spark, bronze_statistics, f"{silver}/{STATISTICS_TABLE}", regions=regions, layout=layout
    )
    loaders = silver_loaders(spark, silver)
    checked = dict(loaders)
    if reference is None and optional_frame(loaders[REFERENCE_TABLE]) is None:
        del checked[REFERENCE_TABLE]
    quality = silver_quality(spark, checked, rules, report_path, failed_path)
    if not quality.quality_passed:
        passed, total = quality.checks_passed, quality.checks_total
        raise QualityGateError(f"{total - passed} of {total} quality checks failed; gold was not built")
    gold_rows = silver_to_gold(loaders[STATISTICS_TABLE](), loaders[REFERENCE_TABLE], gold)
    stored = run_summary(loaders[STATISTICS_TABLE](), ["region"])
    errors = statistics.errors if reference is None else statistics.errors.unionByName(reference.errors)
    outcomes = write_run_rows(region_outcomes(stored, errors), f"{silver}/{STATISTICS_TABLE}", "outcomes", statistics.run_id)
    return MedallionRun(statistics, reference, quality, gold_rows, outcomes)

