"""Mixing sources to target weights by budgets in tokens."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendlake.llm._frames import Carried
from trendlake.llm._running import sum_before
from trendlake.llm._stage import discard, stage


@dataclass(frozen=True)
class Mix:
    """Weights dealt to the sources in order of their names, repeating, and the most repeats.

    ``most`` bounds a source's target in times of its own size. With ``whole`` a document that
    lies across its source's budget counts as inside if its larger half is; without, the words
    up to the budget count, and the budget is met exactly.
    """

    weights: tuple[int, ...] = (5, 2, 1)
    most: int = 3
    whole: bool = False


def words(text: Column) -> Column:
    """Number of runs without 0x20 and 0x09 to 0x0D; zero for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def shuffle_key(id: Column, text: Column) -> Column:
    """A number that looks random and depends on the document alone."""
    seed = F.concat_ws(":", F.coalesce(id.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit("")).cast("binary")))
    return F.conv(F.substring(F.md5(seed.cast("binary")), 1, 15), 16, 10).cast("bigint")


def targets(sources: DataFrame, mix: Mix) -> DataFrame:
    """Rows (source, source_size, target) for staged rows (source, source_size).

    The sources are numbered by code point, null last, with the running sum of ones. The whole
    size is shared by weight; a source at its most leaves its excess to the others. That
    share per weight grows until no further source is above its most; every step is one
    aggregate over the sources, of which one row reaches the driver.
    """
    ones = sources.withColumns({"_all": F.lit(0), "_one": F.lit(1).cast("bigint")})
    numbered = sum_before(ones, "_all", [F.col("source").asc_nulls_last()], "_one", "_at")
    weight = F.element_at(F.array(*map(F.lit, mix.weights)), (F.col("_at") % len(mix.weights) + 1).cast("int"))
    weighed, _ = stage(numbered.select("source", "source_size", weight.cast("bigint").alias("weight")), "weights")
    most = F.col("source_size") * mix.most
    share, full = 0.0, -1
    while True:
        above = most < F.lit(share) * F.col("weight")
        total, held, free, count = weighed.agg(
            F.sum("source_size"),
            F.coalesce(F.sum(F.when(above, most)), F.lit(0)),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)),
            F.count(F.when(above, True)),
        ).first()
        if count == full or not free:
            break
        share, full = (total - held) / free, count
    target = F.least(most.cast("double"), F.lit(share) * F.col("weight"))
    return weighed.select("source", "source_size", target.alias("target"))


def cuts(placed: DataFrame, goals: DataFrame, order: list[str]) -> DataFrame:
    """Of each source its budget in whole epochs, and where the last one ends.

    Returns (_source, source_size, target, _epochs, _cut, _rest): the place in the order of the row that the budget
    ends in, and how many of its words are inside. One row a source, whatever its size.
    """
    epochs = F.when(F.col("source_size") > 0, F.floor(F.floor(F.col("target") + 0.5) / F.col("source_size"))).otherwise(0).cast("bigint")
    goals = goals.withColumnRenamed("source", "_source").withColumn("_epochs", epochs)
    left = F.floor(F.col("target") + 0.5) - F.col("_epochs") * F.col("source_size") - F.col("_before")
    inside = placed.join(goals, F.col("source").eqNullSafe(F.col("_source"))).withColumn("_rest", left.cast("bigint"))
    found = inside.where("_rest >= 0 AND _rest < _size").select(F.col("source").alias("_of"), F.struct(*order).alias("_cut"), "_rest")
    return goals.join(found, F.col("_source").eqNullSafe(F.col("_of")), "left").drop("_of")


def taken(size: Column, place: Column, whole: bool) -> Column:
    """Words of a document inside its source's budget: whole epochs, then up to the cut."""
    rest = F.when(F.col("_rest") * 2 > size, size).otherwise(0) if whole else F.col("_rest")
    last = F.when(place < F.col("_cut"), size).when(place == F.col("_cut"), rest).otherwise(0)
    return (F.col("_epochs") * size + last).cast("bigint")


def mix_sources(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", mix: Mix = Mix(), keep_text: bool = True) -> DataFrame:
    """``docs`` with ``size`` (words), ``source_size``, ``target`` (its source's) and ``taken`` (words).

    Every document gets a random-looking key from its id and text. Each source is range-sorted by
    it, a distributed prefix sum gives the words before each document, and the source is cut
    at its budget; a source with a larger target than size starts again, at most ``mix.most``
    times. Reruns give the same.

    Null sources are one source, after all others; null ids and texts have a key too; null and
    empty texts have size zero and nothing taken. Rows alike in id and text are ordered by a hash of all
    columns (but maps), so reruns agree on which of them is cut; rows alike in all of them in any way, which gives the same rows. A
    very long text is one document and may be cut. An empty table gives an empty table. Input columns with the names of the
    results are replaced, others carried along (``text`` only with ``keep_text``).

    Rows are staged once and a narrow copy of them is sorted. A source is cut in one row: its
    place in the order is joined to the staged rows, a row a source, and every row decides for itself, so that texts stay where they are.
    """
    carried = Carried(docs)
    value, key = carried.column(text), carried.key
    hashed = [f.name for f in carried.flat.schema.fields if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
    sized = carried.flat.withColumns({"_size": words(value), "_key": shuffle_key(carried.column(id), value), "_all": F.xxhash64(*hashed)})
    sized = sized.withColumn("_row", F.monotonically_increasing_id())
    staged, _ = stage(sized if keep_text else sized.drop(key(text)), "mix")
    # Only what the sums need is sorted; texts stay in the staged rows.
    order = ["_key", key(id), "_size", "_all", "_row"]
    narrow = staged.select(*order, F.col(key(source)).alias("source"))
    sizes, held = stage(narrow.groupBy("source").agg(F.sum("_size").alias("source_size")), "source-sizes")
    goals, aimed = stage(targets(sizes, mix), "targets")
    discard(docs.sparkSession, held)
    placed = sum_before(narrow, "source", [F.col(name) for name in order], "_size", "_before")
    goals, _ = stage(cuts(placed, goals, order), "cuts")
    discard(docs.sparkSession, aimed)
    joined = staged.join(goals, F.col(key(source)).eqNullSafe(F.col("_source")))
    amount = taken(F.col("_size"), F.struct(*order), mix.whole)
    if not keep_text:
        carried.forget(text)
    return carried.named(
        joined,
        added={"size": F.col("_size"), "source_size": F.col("source_size"), "target": F.col("target"), "taken": amount},
    )


def mixed_rows(docs: DataFrame, mix: Mix = Mix(whole=True), **names: str) -> DataFrame:
    """The mix itself: every document as often as it is taken, columns as they were.

    Documents are taken whole. Those without a word hold no budget and are left out.
    """
    carried = Carried(docs)
    at = {k: carried.key(names.get(k, v)) for k, v in {"id": "doc_id", "text": "text", "source": "source"}.items()}
    mixed = mix_sources(carried.flat, mix=mix, **at).where("taken > 0")
    times = (F.col("taken") / F.col("size")).cast("int")
    return carried.named(mixed.withColumn("_copy", F.explode(F.sequence(F.lit(1), times))))
