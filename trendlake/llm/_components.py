"""Connected components of a graph given as links, without gathering a component."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlake.llm._stage import discard, stage


def components(links: DataFrame) -> tuple[DataFrame, str]:
    """Rows (node, root) for every node of ``links`` (a, b: bigint); root is the smallest node reached.

    Large-star and small-star steps in turn (Kiveris et al. 2014): every node hands its
    neighbours to the smallest one, until nothing changes. A step is a minimum and a join on the
    node, so a node with very many links is no task of its own. Each round is written to the
    shared folder and the one before removed; the driver sees one checksum a round. No links
    give no rows. Returns the rows and the folder that holds them.
    """
    spark = links.sparkSession
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    edges, folder = stage(edges, "links")
    before = _checksum(edges)
    while True:
        step, new = stage(_small_star(_large_star(edges)), "links")
        discard(spark, folder)
        edges, folder = step, new
        now = _checksum(edges)
        if now == before:
            break
        before = now
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()), folder


def _large_star(edges: DataFrame) -> DataFrame:
    """Link the larger neighbours of every node to the smallest of its neighbours and itself."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link every node and its smaller neighbours to the smallest of them. Edges have u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def _checksum(edges: DataFrame) -> tuple:
    """Count and order-free digest of the links."""
    digest = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count(F.lit(1)), digest).first())
