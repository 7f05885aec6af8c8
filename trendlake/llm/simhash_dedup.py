"""Near-duplicates by SimHash, found with multi-index hashing."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendlake.llm._components import components
from trendlake.llm._frames import Carried
from trendlake.llm._simhash_bits import fingerprint
from trendlake.llm._stage import discard, stage

#: The fingerprint is cut into so many segments of so many bits.
SEGMENTS, SEGMENT_BITS = 4, 16


def simhash(text: Column, shingle: int = 3) -> Column:
    """Column of the signed 64-bit fingerprint of whole texts; null counts as empty (zero)."""

    @F.arrow_udf("bigint")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            raw = pc.cast(batch, pa.binary())
            yield pa.array((fingerprint(raw[i].as_py() or b"", shingle) for i in range(len(raw))), pa.int64(), size=len(raw))

    return of(text)


def links(prints: DataFrame, max_distance: int) -> DataFrame:
    """Pairs (a, b) of different fingerprints with at most ``max_distance`` (0 to 2) differing bits.

    ``prints`` has one row for each distinct fingerprint ``fp``. There is one table for each
    segment left out, keyed by the three others, so a bucket has 2^16 fingerprints at most
    however many near copies a text has, and few in practice. Of two differing bits, either both
    lie in one segment: the table without it matches as it is. Or they lie in two: a ball of
    radius one in the first of these, looked up in the table without the second, matches. The
    ball only sets bits that are zero; for every pair one side has the zero. Every match
    is verified by the distance of the whole fingerprints.
    """
    if not 0 <= max_distance <= 2:
        raise ValueError("max_distance is 0, 1 or 2")
    if max_distance == 0:
        return prints.select(F.col("fp").alias("a"), F.col("fp").alias("b")).where("false")
    masks = [_signed(~(((1 << SEGMENT_BITS) - 1) << (SEGMENT_BITS * s))) for s in range(SEGMENTS)]
    fp = F.col("fp")
    tables = F.array(*(F.struct(F.lit(s).alias("without"), fp.bitwiseAND(F.lit(m)).alias("key")) for s, m in enumerate(masks)))
    table = prints.select(fp.alias("b"), F.explode(tables).alias("t")).select("t.without", "t.key", "b")
    probes = [F.struct(F.lit(s).alias("without"), fp.bitwiseAND(F.lit(m)).alias("key"), F.lit(False).alias("ball")) for s, m in enumerate(masks)]
    if max_distance == 2:
        for s in range(SEGMENTS):
            for bit in range(SEGMENT_BITS * s, SEGMENT_BITS * (s + 1)):
                one = F.lit(_signed(1 << bit))
                for t in range(s + 1, SEGMENTS):
                    value = F.struct(F.lit(t).alias("without"), fp.bitwiseOR(one).bitwiseAND(F.lit(masks[t])).alias("key"), F.lit(True).alias("ball"))
                    probes.append(F.when(fp.bitwiseAND(one) == 0, value))
    probe = prints.select(fp.alias("a"), F.explode(F.array_compact(F.array(*probes))).alias("p")).select("p.*", "a")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_distance
    return probe.join(table, ["without", "key"]).where((F.col("ball") | (F.col("a") < F.col("b"))) & (F.col("a") != F.col("b")) & near).select("a", "b")


def _signed(value: int) -> int:
    value &= (1 << 64) - 1
    return value - (1 << 64) if value >> 63 else value


@dataclass
class Groups:
    """Staged rows with their fingerprint, and the first row of every fingerprint's group."""

    carried: Carried
    rows: DataFrame
    classes: DataFrame


def _group(docs: DataFrame, id: str, text: str, shingle: int, max_distance: int, keep_text: bool) -> Groups:
    spark = docs.sparkSession
    carried = Carried(docs)
    narrow = carried.flat.withColumn("_fp", simhash(carried.column(text), shingle)).withColumn("_row", F.monotonically_increasing_id())
    rows, _ = stage(narrow if keep_text else narrow.drop(carried.key(text)), "simhash")
    # The order in which a group's first row is chosen: known ids first, then the smallest.
    first = F.min(F.struct(carried.column(id).isNull().alias("unknown"), carried.column(id).alias("id"), F.col("_row").alias("row")))
    prints, held = stage(rows.groupBy(F.col("_fp").alias("fp")).agg(first.alias("first")), "prints")
    roots, folder = components(links(prints.select("fp"), max_distance))
    joined = prints.join(roots, F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("root", "fp").alias("root"), "first")
    least = joined.groupBy("root").agg(F.min("first").alias("least"))
    classes, _ = stage(joined.join(least, "root").select("fp", "least"), "classes")
    discard(spark, held, folder)
    return Groups(carried, rows, classes)


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 3, max_distance: int = 2) -> DataFrame:
    """``docs`` without ``text``, with ``fingerprint`` (16 hex digits) and ``component_id``.

    Two rows are linked if their fingerprints differ in at most ``max_distance`` bits;
    ``component_id`` is the smallest id that can be reached over links. Equal fingerprints are
    one node, so copies are never paired with each other.

    Null texts count as empty; empty texts have fingerprint zero and are linked like others. Null
    ids are passed over in the minimum (a component without any id has null). Repeated rows are
    all kept, an empty table gives an empty table, and input columns with the names of the results
    are replaced. The fingerprints are staged in the shared folder.
    """
    groups = _group(docs, id, text, shingle, max_distance, keep_text=False)
    out = groups.rows.join(groups.classes, F.col("_fp") == F.col("fp"))
    carried = groups.carried
    left = [(n, k) for n, k in zip(carried.names, carried.flat.columns, strict=True) if k != carried.key(text) and n.lower() not in ("fingerprint", "component_id")]
    return out.select(
        *(F.col(k).alias(n) for n, k in left),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("least.id").alias("component_id"),
    )


def keep_first(docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 3, max_distance: int = 2) -> DataFrame:
    """One row of each group of ``near_duplicates``: the one with the smallest id, columns as they were.

    Of rows with the same id one is kept; rows without id are kept only if their group has no
    other. All columns are staged once; the kept rows are found by their row number.
    """
    groups = _group(docs, id, text, shingle, max_distance, keep_text=True)
    kept = groups.classes.select(F.col("least.row").alias("_kept")).distinct()
    return groups.carried.named(groups.rows.join(kept, F.col("_row") == F.col("_kept"), "left_semi"))
