"""Silver to gold."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame

from trendlake.operators.enrich import enrich_category
from trendlake.operators.rollups import GOLD_TABLES, gold_base, stamp_aggregated
from trendlake.sinks.published import publish
from trendlake.sinks.reports import RowMetrics
from trendlake.sinks.tables import write_partitions
from trendlake.sources.tables import optional_table
from trendlake.staging import cleared_staging, materialize


def staged_base(statistics: DataFrame, reference: DataFrame | None) -> DataFrame:
    """The base of all rollups with category names, written once to the shared folder.

    The lookup is joined to the base, not to the rows.
    """
    return materialize(enrich_category(gold_base(statistics), reference), "gold-base")


def gold_frames(statistics: DataFrame, reference: DataFrame | None) -> Iterator[tuple[str, DataFrame]]:
    """The three rollups with their names, over one staged base, each made when it is its turn.

    The statistics are read twice: for the base and for the distinct videos of a channel. The
    rank of the channels stages its rows, so building that frame starts a job.
    """
    base = staged_base(statistics, reference)
    for name, (build, schema) in GOLD_TABLES.items():
        yield name, stamp_aggregated(build(statistics, base)).select(*schema.names)


def silver_to_gold(
    statistics: DataFrame,
    load_reference: Callable[[], DataFrame] | None,
    gold: str,
    tables: dict[str, str] | None = None,
    published: dict[str, str] | None = None,
) -> dict[str, int]:
    """Write the three gold tables below ``gold``; returns the rows written of each.

    Gold is made anew from all of silver, so each table is replaced as a whole and a region
    that left silver leaves gold too. Staged tables are removed at the end.

    A table with a name in ``published`` is written as a new version beside the old one and then shown under that
    name by one step, so that readers never miss it and a broken write leaves the last good version.
    """
    reference = None if load_reference is None else optional_table(load_reference)
    written = {}
    with cleared_staging(statistics.sparkSession):
        for name, frame in gold_frames(statistics, reference):
            metrics = RowMetrics.new(name)
            shaped = metrics.watch(frame.hint("rebalance", "region"))
            target = None if tables is None else tables.get(name)
            if published is not None and name in published:
                publish(shaped, published[name], f"{gold.rstrip('/')}/{name}")
            else:
                write_partitions(shaped, f"{gold.rstrip('/')}/{name}", table=target, rebalance=False, whole=True)
            written[name] = metrics.result().get("rows", 0)
    return written
