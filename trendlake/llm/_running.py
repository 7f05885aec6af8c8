"""Running sums inside groups of any size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendlake.llm._stage import stage


def sum_before(df: DataFrame, group: str, order: list[Column], value: str, name: str) -> DataFrame:
    """``df`` with ``name``: the sum of ``value`` (bigint) over the rows before in ``group``.

    The rows are range-partitioned by group and order, so a large group spans many tasks. Every
    task sums what it holds; the sums of a group's slices, one for each task, are added up and
    joined back. ``df`` should be a staged table, as the sort samples it first. Rows alike in
    ``order`` come in any order: give one that tells different rows apart. Null groups are one
    group, null values count zero.
    """
    keys = [F.col(group).asc_nulls_first(), *order]
    sliced = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_slice", F.spark_partition_id())
    schema = T.StructType([*sliced.schema.fields, T.StructField("_inside", T.LongType())])
    summed = sliced.mapInArrow(lambda batches: _inside(batches, group, value), schema)
    placed, _ = stage(summed, "running")
    slices = placed.groupBy(F.col(group).alias("_g"), F.col("_slice").alias("_s")).agg(F.sum(F.coalesce(value, F.lit(0))).alias("_total"))
    earlier = Window.partitionBy("_g").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slices.select("_g", "_s", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_offset"))
    offsets, _ = stage(offsets, "offsets")
    same = F.col(group).eqNullSafe(F.col("_g")) & (F.col("_slice") == F.col("_s"))
    return placed.join(offsets, same).select(*df.columns, (F.col("_inside") + F.col("_offset")).alias(name))


def _inside(batches: Iterator[pa.RecordBatch], group: str, value: str) -> Iterator[pa.RecordBatch]:
    """Adds the sum over the rows before of the same group and the same sorted partition."""
    last, carried = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        of, values = batch.column(group), pc.fill_null(batch.column(value), 0).to_numpy().astype(np.int64)
        starts = np.flatnonzero(~_same(of.slice(1), of.slice(0, len(of) - 1))) + 1
        goes_on = last is not None and bool(_same(of.slice(0, 1), last)[0])
        before = np.cumsum(values) - values
        base = np.zeros(len(values), np.int64)
        base[starts] = before[starts] - np.r_[0, before[starts[:-1]]] if len(starts) else 0
        inside = before - np.cumsum(base)
        if goes_on:
            inside[: starts[0] if len(starts) else None] += carried
        carried, last = int(inside[-1] + values[-1]), of.slice(len(of) - 1)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(inside)], [*batch.schema.names, "_inside"])


def _same(a: pa.Array, b: pa.Array) -> np.ndarray:
    equal = pc.fill_null(pc.equal(a, b), False)
    return pc.or_(equal, pc.and_(pc.is_null(a), pc.is_null(b))).to_numpy(zero_copy_only=False)
