"""Exact top-k search by inner product, with bounds of blocks."""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendlake.llm import _topk
from trendlake.llm._frames import pick
from trendlake.llm._stage import discard, stage

#: Queries scored together.
CHUNK = 512
#: Chunks and packs whose bounds one task makes at a time: a few MB of each.
TILE_CHUNKS, TILE_PACKS = 16, 256


def quantised(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component as a long; null for a vector that takes no part."""
    usable = ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(vector.isNotNull() & usable, F.transform(vector, lambda x: F.floor(x.cast("double") * scale)))


def _packs(rows: DataFrame, size: int, label: str) -> tuple[DataFrame, str]:
    """Neighbours by id as one row for each pack, staged."""
    placed = rows.repartitionByRange(F.col("id").asc_nulls_last(), F.col("copies")).sortWithinPartitions(F.col("id").asc_nulls_last(), "copies", "vector")
    placed = placed.withColumn("slice", F.spark_partition_id().cast("bigint"))
    return stage(placed.mapInArrow(partial(_topk.pack, rows=size), _topk.PACK), label)


def _scored(wanted: DataFrame, chunks: DataFrame, packs: DataFrame, k: int) -> DataFrame:
    """Score the wanted (chunk, pack, places, least); one row of all their data at a time."""
    data = wanted.join(chunks, "chunk").join(packs.select("pack", *(F.col(c).alias(f"pack_{c}") for c in ("n", "dim", "ids", "copies", "flat", "high", "low"))), "pack")
    return data.mapInArrow(partial(_topk.score, k=k), _topk.HITS)


def _bounds(chunks: DataFrame, extremes: DataFrame) -> DataFrame:
    """Every chunk's bounds in every pack: the stated query set against all rows, tile by tile.

    Chunks and packs are dealt into tiles by hash. A tile of both meets in one task through its number, so nothing is
    broadcast, and each side is shuffled once for each tile of the other.
    """
    tiles = {"q": -(-chunks.count() // TILE_CHUNKS) or 1, "p": -(-extremes.count() // TILE_PACKS) or 1}
    every = lambda side: F.explode(F.sequence(F.lit(0), F.lit(tiles[side] - 1)))
    of = lambda name, side: F.pmod(F.xxhash64(name), F.lit(tiles[side])).cast("int")
    left = chunks.withColumn("q", of("chunk", "q")).withColumn("p", every("p"))
    right = extremes.withColumn("p", of("pack", "p")).withColumn("q", every("q"))
    return left.groupBy("q", "p").cogroup(right.groupBy("q", "p")).applyInArrow(_topk.bounds, _topk.BOUNDS)


def search(vectors: DataFrame, is_query: Column, k: int = 5, id: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """The ``k`` best other rows of every query row: (query_id, rank, vec_id, score).

    ``is_query`` is a condition on a column named ``id``. Components are floor(``scale`` * x), the
    score is the integer inner product; ties go to the smaller id.

    Rows are packed by id range; a pack is sixteen blocks, each with the greatest and least of
    every component. A first pass bounds each query in each pack (one row of sums for a pack and a
    chunk of queries) and scores each query's most promising pack. A second one scores
    the packs whose bound reaches the k-th score found so far, block by block in falling order
    of the bounds, until they fall below it. Every row is a candidate, nothing is approximated.

    Vectors that are null or hold null or non-finite components take no part; missing components
    of shorter vectors count zero. Rows that are alike each are a query and a candidate of their
    own; a query's own row, and only that, is left out. Null ids are never queries and come last
    among ties. Fewer candidates than ``k`` are all returned, an empty table gives an
    empty table. Other columns are left out. Scores beyond a long are held at its ends.
    """
    spark = vectors.sparkSession
    usable = pick(vectors, id=id, vector=vector).withColumn("vector", quantised(F.col("vector"), scale)).where("vector IS NOT NULL")
    unlike, own = stage(usable.groupBy("id", "vector").agg(F.count(F.lit(1)).alias("copies")), "vectors")
    # No result shows more than k copies of a row beside the query itself.
    shown = F.explode(F.sequence(F.lit(1).cast("bigint"), F.least(F.col("copies"), F.lit(k + 1))))
    packs, packed = _packs(unlike.select("id", shown.alias("copies"), "vector"), _topk.PACK_ROWS, "packs")
    chunks, chunked = _packs(unlike.where(is_query), CHUNK, "queries")
    chunks = chunks.select(F.col("pack").alias("chunk"), "n", "dim", "ids", "copies", "flat")
    extremes = packs.select("pack", F.col("dim").alias("pack_dim"), F.col("high").alias("pack_high"), F.col("low").alias("pack_low"))
    limits, limited = stage(_bounds(chunks.select("chunk", "n", "dim", "flat"), extremes), "bounds")
    each = limits.select("chunk", "pack", F.posexplode("bound").alias("place", "bound"))
    first = each.groupBy("chunk", "place").agg(F.max(F.struct("bound", "pack")).getField("pack").alias("pack"))
    lowest = F.lit(-(1 << 63)).cast("bigint")
    seeds, seeded = stage(_scored(_wanted(first.withColumn("least", lowest)), chunks, packs, k), "seeds")
    reached = seeds.groupBy("chunk", "place").agg(F.min("score").alias("kth"), F.count(F.lit(1)).alias("have"))
    reached = reached.where(F.col("have") >= k).select("chunk", "place", "kth")
    rest = each.join(first.withColumnRenamed("pack", "done"), ["chunk", "place"]).where("pack <> done")
    rest = rest.join(reached, ["chunk", "place"], "left").where("kth IS NULL OR bound >= kth")
    more, scored = stage(_scored(_wanted(rest.withColumn("least", F.coalesce("kth", lowest))), chunks, packs, k), "more")
    best = Window.partitionBy("chunk", "place").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    ranked = seeds.unionByName(more).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    queries = chunks.select("chunk", F.posexplode(F.arrays_zip("ids", "copies")).alias("place", "q"))
    out = ranked.join(queries, ["chunk", "place"])
    out = out.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("q.copies"))))
    out, _ = stage(out.select(F.col("q.ids").alias("query_id"), "rank", "vec_id", "score"), "top")
    discard(spark, own, packed, chunked, limited, seeded, scored)
    return out


def _wanted(pairs: DataFrame) -> DataFrame:
    """Pairs of a query and a pack, gathered by chunk: at most a chunk's queries in one row."""
    rows = F.array_sort(F.collect_list(F.struct("place", "least")))
    return pairs.groupBy("chunk", "pack").agg(rows.alias("r")).select("chunk", "pack", F.col("r.place").alias("places"), F.col("r.least").alias("least"))
