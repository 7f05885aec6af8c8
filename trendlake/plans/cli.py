"""Command line of the jobs, for ``spark-submit`` or ``python -m trendlake.plans.cli``."""

from __future__ import annotations

import argparse
import json
import sys
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from trendlake import schemas
from trendlake.config import REFERENCE_TABLE, STATISTICS_TABLE, QualityRules
from trendlake.operators.quality import QualityGateError
from trendlake.plans.gold import silver_to_gold
from trendlake.plans.gold_changes import follow_changes
from trendlake.plans.medallion import run_all, silver_loaders, silver_quality
from trendlake.plans.silver import bronze_to_silver_reference, bronze_to_silver_statistics
from trendlake.session import build_session
from trendlake.sources.tables import read_table
from trendlake.streaming.incremental import incremental_reference, incremental_statistics
from trendlake.streaming.notices import missing_files, noticed_reference


def _names(text: str) -> list[str]:
    return [name.strip() for name in text.split(",") if name.strip()]


def build_parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="trendlake")
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, *folders: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name)
        for folder in folders:
            sub.add_argument(f"--{folder}", required=True)
        return sub

    def bronze_options(sub: argparse.ArgumentParser) -> None:
        sub.add_argument("--regions", type=_names, help="only these region folders, comma separated")
        sub.add_argument("--layout", choices=("auto", "document", "lines"), default="auto")

    statistics = job("statistics", "bronze", "silver")
    bronze_options(statistics)
    statistics.add_argument("--job-name", default="bronze_to_silver_statistics")
    statistics.add_argument("--table", help="catalog name to register")
    statistics.add_argument("--single-line", action="store_true", help="no line breaks inside CSV values")
    statistics.add_argument("--no-rebalance", action="store_true")

    reference = job("reference", "bronze", "silver")
    bronze_options(reference)
    reference.add_argument("--table", help="catalog name to register")

    quality = job("quality", "silver")
    quality.add_argument("--tables", type=_names, default=[STATISTICS_TABLE], help="comma separated")
    quality.add_argument("--report", help="folder the report rows are appended to")
    quality.add_argument("--failed", help="folder the failed rows are appended to as JSON")

    gold = job("gold", "silver", "gold")
    gold.add_argument("--database", help="catalog database to register the gold tables in")
    gold.add_argument("--publish", help="catalog database to show the gold tables in, each swapped as a whole")

    follow = job("new-gold", "silver", "gold", "state")
    follow.description = "Bring gold to the days that the silver jobs changed since the last time."

    whole = job("all", "bronze-statistics", "bronze-reference", "silver", "gold")
    bronze_options(whole)
    whole.add_argument("--report", help="folder the report rows are appended to")
    whole.add_argument("--failed", help="folder the failed rows are appended to as JSON")

    new_statistics = job("new-statistics", "bronze", "silver", "checkpoint")
    bronze_options(new_statistics)
    new_statistics.add_argument("--source", choices=("json", "csv"), default="json")
    new_statistics.add_argument("--job-name", default="incremental_statistics")
    new_statistics.add_argument("--single-line", action="store_true", help="no line breaks inside CSV values")

    new_reference = job("new-reference", "bronze", "silver", "checkpoint")
    new_reference.add_argument("--layout", choices=("auto", "document", "lines"), default="auto")
    new_reference.add_argument("--notices", help="folder of file notices; the bronze folder is then not listed")
    return parser


def table_loader(spark: SparkSession, silver: str, name: str):
    """Loader of a silver table, of one of another name by its folder."""
    known = silver_loaders(spark, silver)
    return known.get(name, lambda: read_table(spark, path=f"{silver.rstrip('/')}/{name}"))


def listed(rows: DataFrame, most: int = 100) -> dict:
    """Number of rows and the first of them, for the printed summary; all are stored by run id."""
    shown = rows.orderBy(*rows.columns).limit(most).toJSON().collect()
    return {"count": rows.count(), "first": [json.loads(row) for row in shown]}


def tell_run(run_id: str) -> None:
    """Name the run, under which its errors, warnings and outcomes are stored, beside the summary."""
    print(f"run {run_id}", file=sys.stderr)


def run(spark: SparkSession, args: argparse.Namespace) -> dict:
    """Run the chosen job and return its summary."""
    if args.job == "statistics":
        done = bronze_to_silver_statistics(
            spark,
            args.bronze,
            args.silver,
            args.job_name,
            args.regions,
            args.layout,
            not args.single_line,
            args.table,
            not args.no_rebalance,
        )
        tell_run(done.run_id)
        return {
            "skipped": done.skipped,
            "read": done.rows_read,
            "written": done.rows_written,
            "errors": listed(done.errors),
        }
    if args.job == "reference":
        done = bronze_to_silver_reference(
            spark, args.bronze, args.silver, args.regions, args.layout, args.table
        )
        tell_run(done.run_id)
        return {
            "files_written": done.processed.count(),
            "errors": listed(done.errors),
            "warnings": listed(done.warnings),
        }
    if args.job == "quality":
        loaders = {name: table_loader(spark, args.silver, name) for name in args.tables}
        done = silver_quality(spark, loaders, QualityRules.from_env(), args.report, args.failed)
        return {
            "quality_passed": done.quality_passed,
            "checks_passed": done.checks_passed,
            "checks_total": done.checks_total,
        }
    if args.job == "gold":
        silver = args.silver.rstrip("/")
        statistics = read_table(
            spark, path=f"{silver}/{STATISTICS_TABLE}", schema=schemas.SILVER_STATISTICS
        )
        names = ("trending_analytics", "channel_analytics", "category_analytics")
        tables = {name: f"{args.database}.{name}" for name in names} if args.database else None
        published = {name: f"{args.publish}.{name}" for name in names} if args.publish else None
        loader = silver_loaders(spark, silver)[REFERENCE_TABLE]
        return silver_to_gold(statistics, loader, args.gold, tables, published)
    if args.job == "new-gold":
        silver = args.silver.rstrip("/")
        loader = silver_loaders(spark, silver)[REFERENCE_TABLE]
        return {"runs": follow_changes(spark, f"{silver}/{STATISTICS_TABLE}", loader, args.state, args.gold, QualityRules.from_env())}
    if args.job == "all":
        done = run_all(
            spark,
            args.bronze_statistics,
            args.bronze_reference,
            args.silver,
            args.gold,
            QualityRules.from_env(),
            args.regions,
            args.layout,
            args.report,
            args.failed,
        )
        tell_run(done.statistics.run_id)
        return {
            "read": done.statistics.rows_read,
            "written": done.statistics.rows_written,
            **done.gold_rows,
            "failed_regions": listed(done.outcomes.filter("outcome = 'failed'")),
        }
    if args.job == "new-statistics":
        incremental_statistics(
            spark,
            args.bronze,
            args.silver,
            args.checkpoint,
            args.source,
            args.layout,
            not args.single_line,
            args.regions,
            args.job_name,
        )
        return {"done": True}
    if args.notices:
        noticed_reference(spark, args.notices, args.bronze, args.silver, args.checkpoint, args.layout)
        return {"done": True, "missing_files": listed(missing_files(spark, args.checkpoint))}
    incremental_reference(spark, args.bronze, args.silver, args.checkpoint, args.layout)
    return {"done": True}


def main(argv: Sequence[str] | None = None) -> int:
    args = build_parser().parse_args(argv)
    spark = build_session(f"trendlake-{args.job}")
    try:
        summary = run(spark, args)
    except QualityGateError as stopped:
        print(json.dumps({"quality_passed": False, "message": str(stopped)}))
        return 1
    print(json.dumps(summary))
    return 0 if summary.get("quality_passed", True) else 1


if __name__ == "__main__":
    raise SystemExit(main())
