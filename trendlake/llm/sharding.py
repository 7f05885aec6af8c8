"""Sharding by jump consistent hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendlake.llm._frames import Carried
from trendlake.llm._running import sum_before
from trendlake.llm._stage import stage

#: Fixed value: the multiplier of the generator in the published algorithm.
MULTIPLIER = 2862933555777941757


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each 64-bit key (Lamping and Veach 2014), for many keys at once.

    A key's walk jumps ahead to the next number of shards at which the key would move, and the
    last place it moved to is its shard; so one shard more only takes keys into itself.
    """
    state, at, ahead = keys.astype(np.uint64), np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
    moving = np.arange(len(keys))
    while len(moving):
        at[moving] = ahead[moving]
        state[moving] = state[moving] * np.uint64(MULTIPLIER) + np.uint64(1)
        draw = (state[moving] >> np.uint64(33)).astype(np.float64) + 1.0
        ahead[moving] = ((at[moving] + 1) * (float(1 << 31) / draw)).astype(np.int64)
        moving = moving[ahead[moving] < shards]
    return at


def stable_key(id: Column) -> Column:
    """60-bit key of an id, the same on every cluster; null ids share the key of the empty string."""
    digest = F.md5(F.coalesce(id.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def shard_of(key: Column, shards: int) -> Column:
    """Column of the shard (0 to ``shards`` - 1) of a 64-bit key."""

    @F.arrow_udf("int")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(jump(batch.to_numpy(zero_copy_only=False).astype(np.int64), shards), pa.int32())

    return of(key)


def assign(docs: DataFrame, shards: int, id: str = "doc_id", text: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with ``size``, ``text_crc32``, ``law`` ("key"), ``shard``, ``slot`` and ``grown_shard``.

    The id and the number of shards decide on the shard; ``grown_shard`` is the one among
    ``shards + 1``, equal or the new one. ``slot`` numbers a shard's rows from 0 without gaps, by
    id, size and checksum. ``size`` is the UTF-8 bytes of the text plus 8.

    Null ids go to one shard, null and empty texts have size 8 and checksum 0. Rows with the same
    id share a shard and have a slot each. An empty table gives an empty table. Input columns with
    the names of the results are replaced, others carried along (``text`` only with ``keep_text``).
    A shard's rows are numbered over many tasks.
    """
    carried = Carried(docs)
    value, key = carried.column(text), stable_key(carried.column(id))
    known = carried.flat.withColumns(
        {
            "_size": (F.coalesce(F.octet_length(value), F.lit(0)) + 8).cast("bigint"),
            "_crc": F.crc32(F.coalesce(value, F.lit("")).cast("binary")),
            "_shard": shard_of(key, shards),
            "_grown": shard_of(key, shards + 1),
            "_one": F.lit(1).cast("bigint"),
        }
    )
    if not keep_text:
        known = known.drop(carried.key(text))
    staged, _ = stage(known, "shards")
    slotted = sum_before(staged, "_shard", [carried.column(id), F.col("_size"), F.col("_crc")], "_one", "_slot")
    if not keep_text:
        carried.forget(text)
    return carried.named(
        slotted,
        added={
            "size": F.col("_size"),
            "text_crc32": F.col("_crc"),
            "law": F.lit("key"),
            "shard": F.col("_shard"),
            "slot": F.col("_slot"),
            "grown_shard": F.col("_grown"),
        },
    )


def write_shards(docs: DataFrame, path: str, shards: int, id: str = "doc_id", files: int = 1) -> None:
    """Write ``docs`` as Parquet folders ``shard=0`` and so on, by the law of ``assign``.

    Each shard is dealt over ``files`` tasks by the hash of the row's id, so the size of a shard
    does not bound the job. A column named ``shard`` is replaced.
    """
    carried = Carried(docs)
    sharded = carried.named(carried.flat, added={"shard": shard_of(stable_key(carried.column(id)), shards)})
    spread = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(files))
    sharded.repartition(shards * files, "shard", spread).write.partitionBy("shard").parquet(path)
