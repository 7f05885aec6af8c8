"""Settings of the jobs: quality thresholds, critical columns and size limits."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field

STATISTICS_TABLE = "clean_statistics"
REFERENCE_TABLE = "clean_reference_data"

# They must equal the published behaviour for the verdicts to agree.
UNKNOWN_REGION = "unknown"
UNKNOWN_CATEGORY = "Unknown"
CRITICAL_COLUMNS: Mapping[str, tuple[str, ...]] = {
    STATISTICS_TABLE: ("video_id", "title", "channel_title", "views", "region"),
    REFERENCE_TABLE: ("id", "region"),
}
FRESHNESS_COLUMNS = ("_processed_at", "_ingestion_timestamp")


@dataclass(frozen=True)
class QualityRules:
    """Thresholds of the quality checks.

    ``strict_freshness`` turns an unparseable timestamp into a failure; by default
    such a table skips the freshness check, like one without a timestamp column.
    """

    min_rows: int = 10
    max_null_pct: float = 5.0
    max_views: int = 50_000_000_000
    max_age_hours: int = 48
    critical_columns: Mapping[str, tuple[str, ...]] = field(default_factory=lambda: dict(CRITICAL_COLUMNS))
    ranged_columns: Mapping[str, str] = field(default_factory=lambda: {STATISTICS_TABLE: "views"})
    strict_freshness: bool = False

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> QualityRules:
        """Rules with the row and null thresholds taken from the environment where set."""
        env = os.environ if env is None else env
        return cls(
            min_rows=int(env.get("DQ_MIN_ROW_COUNT", cls.min_rows)),
            max_null_pct=float(env.get("DQ_MAX_NULL_PERCENT", cls.max_null_pct)),
        )
