"""Quality reports and run summaries."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import UTC, datetime

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from trendlake.functions.clock import subject_line
from trendlake.operators.quality import failed_checks


def write_dq_report(report: DataFrame, path: str, run_id: str | None = None) -> None:
    """Append the report rows with the run they belong to; a report has a few rows per table."""
    run = F.lit(run_id or uuid.uuid4().hex)
    stamped = report.withColumns({"checked_at": F.current_timestamp(), "run_id": run})
    stamped.write.mode("append").parquet(path)


def failed_checks_json(report: DataFrame, title: str = "quality check failed") -> DataFrame:
    """Failed rows as JSON text with an alert subject of at most 100 characters."""
    subject = subject_line(F.concat_ws(" - ", F.lit(title), F.col("table"), F.col("check")))
    return failed_checks(report).select(
        "check", "table", subject.alias("subject"), F.to_json(F.struct("*")).alias("details")
    )


def write_failed_checks(report: DataFrame, path: str) -> None:
    """Append the failed rows, as an alert needs them, one JSON object per line."""
    failed_checks_json(report).write.mode("append").json(path)


def new_run_id() -> str:
    """Name of a run: its start, and a part that no other run has."""
    return f"{datetime.now(UTC):%Y%m%d_%H%M%S}-{uuid.uuid4().hex[:8]}"


def run_folder(target: str, kind: str) -> str:
    """Where the runs that write the table ``target`` keep rows of a kind, beside it."""
    return f"{target.rstrip('/')}_run_{kind}"


def write_run_rows(rows: DataFrame, target: str, kind: str, run_id: str) -> DataFrame:
    """Store all rows that a run has to tell, its errors say, by its id; the stored rows.

    The folder of a run is a partition ``run`` of the table of all runs.
    """
    folder = f"{run_folder(target, kind)}/run={run_id}"
    rows.write.mode("overwrite").parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def run_summary(df: DataFrame, by: Sequence[str] = ("_source_file", "region")) -> DataFrame:
    """Rows per file and region."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"))


def region_outcomes(landed: DataFrame, failed: DataFrame) -> DataFrame:
    """Outcome per region: ``success`` without an error, else ``failed`` with the errors.

    ``landed`` has ``region``, ``failed`` has ``region`` and ``error``.
    """
    regions = landed.select("region", F.lit(0).alias("errors")).unionByName(
        failed.select("region", F.lit(1).alias("errors"))
    )
    counted = regions.groupBy("region").agg(F.sum("errors").alias("errors"))
    outcome = F.when(F.col("errors") == 0, F.lit("success")).otherwise(F.lit("failed"))
    return counted.withColumn("outcome", outcome)


@dataclass(frozen=True)
class RowMetrics:
    """Counts taken while the rows pass by, so that no second job is needed.

    Place it last before a write: there a retried task is counted once. Before a shuffle a
    lost executor can make rows pass twice, so such a count is for the log only.
    """

    observation: Observation

    @classmethod
    def new(cls, name: str) -> RowMetrics:
        return cls(Observation(name))

    def watch(self, df: DataFrame, nulls: Sequence[str] = (), more: Sequence[Column] = ()) -> DataFrame:
        measures: list[Column] = [F.count(F.lit(1)).alias("rows"), *more]
        measures += [F.count_if(F.col(name).isNull()).alias(f"null_{name}") for name in nulls]
        return df.observe(self.observation, *measures)

    def result(self) -> dict[str, int]:
        """The counts, after the write. Empty when adaptive execution found the whole
        result to be empty and dropped the plan the rows would have passed through.
        """
        try:
            return self.observation.get
        except Py4JJavaError:
            return {}
