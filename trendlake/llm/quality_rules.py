"""Quality rules whose thresholds follow each language and source."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendlake.llm._frames import Carried
from trendlake.llm._stage import discard, stage
from trendlake.llm._stats_column import stats

#: Counts the operator adds to a document.
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


#: The rates held against fences: the first has a fence on both sides; the others are zero for most documents.
METRICS = ("chars_per_word", "symbols_per_word", "dup_lines_per_line", "repeated_per_word")
#: The counts behind these, whose usual least is known as well.
COUNTED = {"symbols_per_word": "symbols", "dup_lines_per_line": "dup_lines", "repeated_per_word": "repeated"}
SKETCHED = (*METRICS, *COUNTED.values())
#: The bucket of zero.
ZERO = -(1 << 62)


@dataclass(frozen=True)
class Rules:
    """Parameters of the adaptive thresholds.

    ``accuracy`` is the relative error of a sketch's quantiles. ``reach`` is how many times its spread a
    fence lies beyond the quartiles, or how many times its usual size a rate may be; ``few`` is how many times the
    least that documents with any have (their lowest tenth) is nothing to go by, whatever its rate. Every group's sketch
    is pooled with that of its parent (source with language, language with all documents), which counts as much as
    ``prior_docs`` documents. Short texts vary more: fences are widened by ``1 + short / n_words``.
    """

    accuracy: float = 0.01
    reach: float = 3.0
    few: float = 2.0
    prior_docs: int = 50
    short: float = 20.0

    @property
    def gamma(self) -> float:
        return (1 + self.accuracy) / (1 - self.accuracy)

    @property
    def log_gamma(self) -> float:
        return math.log(self.gamma)


def metrics() -> dict[str, Column]:
    """The rates that are held against thresholds, and their counts; null where a text has no word."""
    words = F.when(F.col("_s.n_words") > 0, F.col("_s.n_words"))
    return {
        "chars_per_word": F.col("_s.word_chars") / words,
        "symbols_per_word": F.col("_s.n_symbols") / words,
        "dup_lines_per_line": F.col("_s.n_dup_lines") / F.when(F.col("_s.n_lines") > 0, F.col("_s.n_lines")),
        "repeated_per_word": F.col("_s.n_repeat_words") / words,
        "symbols": F.when(words.isNotNull(), F.col("_s.n_symbols").cast("double")),
        "dup_lines": F.when(words.isNotNull(), F.col("_s.n_dup_lines").cast("double")),
        "repeated": F.when(words.isNotNull(), F.col("_s.n_repeat_words").cast("double")),
    }


def bucket(value: Column, gamma: float) -> Column:
    """Number of the sketch's bucket: values up to a power of ``gamma``; the lowest long for zero."""
    power = F.ceil(F.log(value) / F.lit(math.log(gamma))).cast("bigint")
    return F.when(value > 0, power).otherwise(F.lit(ZERO))


def sketches(rates: DataFrame, gamma: float) -> DataFrame:
    """Quantile sketches as rows (lang, source, metric, bucket, n).

    Buckets grow by the factor ``gamma``, so a quantile read from them is off by the accuracy at
    most, and two sketches are merged by adding the counts of equal buckets: partial sums on the
    map side, then by language, then over all. The result does not depend on the order of rows.
    """
    cells = F.array(*(F.struct(F.lit(n).alias("metric"), bucket(F.col(n), gamma).alias("bucket"), F.col(n).isNotNull().alias("seen")) for n in SKETCHED))
    long = rates.select("lang", "source", F.explode(cells).alias("c")).where("c.seen")
    return long.groupBy("lang", "source", "c.metric", "c.bucket").agg(F.count(F.lit(1)).alias("n"))


def merged(sketch: DataFrame, group: list[str]) -> DataFrame:
    """The sketches of larger groups; counts are decimals, as pooling multiplies them."""
    return sketch.groupBy(*group, "metric", "bucket").agg(F.sum("n").cast("decimal(38,0)").alias("n"))


def _beside(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on keys that may be null, with the other columns of ``right``."""
    named = right.withColumnsRenamed({k: f"_{k}" for k in keys})
    same = F.lit(True)
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"_{k}"))
    return left.join(named, same).drop(*(f"_{k}" for k in keys))


def pooled(sketch: DataFrame, parent: DataFrame, group: list[str], above: list[str], weight: int) -> DataFrame:
    """The sketches of ``group`` with that of their parent, which counts as much as ``weight`` documents.

    Nothing is divided, so the counts stay whole: a group's own times the documents of the parent, and the
    parent's times the weight.
    """
    keys = [*above, "metric"]
    total = parent.groupBy(*keys).agg(F.sum("n").alias("_of"))
    own = _beside(sketch, total, keys).select(*group, "metric", "bucket", (F.col("n") * F.col("_of")).cast("decimal(38,0)").alias("n"))
    lent = _beside(sketch.select(*group, "metric").distinct(), parent, keys)
    lent = lent.select(*group, "metric", "bucket", (F.col("n") * weight).cast("decimal(38,0)").alias("n"))
    return merged(own.unionByName(lent), group)


def fences(sketch: DataFrame, group: list[str], rules: Rules) -> DataFrame:
    """``low`` and ``high`` of each group and metric, from quantiles of its sketch alone.

    Characters: the quartiles and ``reach`` times their distance. The other rates are zero for most: the median of those
    that are not, times the root of their share, times ``reach``. So a rate that few documents have at all is
    narrowly fenced, whatever the few hold, and one that all have may reach a multiple of its median. Their counts: ``few`` times the
    lowest tenth of those that are not zero, what a single repeated passage gives, say.

    A sketch has some hundred buckets whatever the number of documents, so the window over a
    group's buckets is small.
    """
    over = Window.partitionBy(*group, "metric")
    upto = over.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = sketch.withColumn("upto", F.sum("n").over(upto)).withColumn("docs", F.sum("n").over(over))
    placed = placed.withColumn("zero", F.sum(F.when(F.col("bucket") == ZERO, F.col("n")).otherwise(0)).over(over))
    value = F.when(F.col("bucket") == ZERO, 0.0).otherwise(F.pow(F.lit(rules.gamma), F.col("bucket")) * (2 / (1 + rules.gamma)))
    at = lambda reached: F.min(F.when(reached, F.struct("bucket", value.alias("value")))).getField("value")
    others = F.col("docs") - F.col("zero")
    above = lambda tenths: (F.col("bucket") > ZERO) & (10 * (F.col("upto") - F.col("zero")) >= tenths * others)
    found = placed.groupBy(*group, "metric").agg(
        at(4 * F.col("upto") >= F.col("docs")).alias("q1"),
        at(4 * F.col("upto") >= 3 * F.col("docs")).alias("q3"),
        at(above(5)).alias("usual"),
        at(above(1)).alias("little"),
        ((F.max("docs") - F.max("zero")).cast("double") / F.max("docs").cast("double")).alias("share"),
    )
    spread = (F.col("q3") - F.col("q1")) * rules.reach
    both = F.col("metric") == METRICS[0]
    return found.select(
        *group,
        "metric",
        F.when(both, F.col("q1") - spread).alias("low"),
        F.when(both, F.col("q3") + spread)
        .when(F.col("metric").isin(list(COUNTED)), F.col("usual") * F.sqrt("share") * rules.reach)
        .otherwise(F.col("little") * rules.few)
        .alias("high"),
    )


def thresholds(sketch: DataFrame, rules: Rules) -> DataFrame:
    """One row for each language and source: the fences of every metric that hold there.

    A source's fence is nowhere beyond its language's, and a rate's nowhere beyond that of all documents: a group
    that is full of junk does not set its own standard.
    """
    every = merged(sketch, [])
    by_lang = pooled(merged(sketch, ["lang"]), every, ["lang"], [], rules.prior_docs)
    own = pooled(merged(sketch, ["lang", "source"]), by_lang, ["lang", "source"], ["lang"], rules.prior_docs)
    named = lambda df, p: df.withColumnsRenamed({"low": f"{p}_low", "high": f"{p}_high"})
    joined = _beside(fences(own, ["lang", "source"], rules), named(fences(by_lang, ["lang"], rules), "lang"), ["lang", "metric"])
    joined = _beside(joined, named(fences(every, [], rules), "all"), ["metric"])
    both = F.col("metric") == METRICS[0]
    high = F.when(both, F.least("high", "lang_high")).otherwise(F.least("high", "lang_high", "all_high"))
    used = F.struct(F.greatest("low", "lang_low").alias("low"), high.alias("high"))
    return joined.groupBy("lang", "source").agg(*(F.max(F.when(F.col("metric") == n, used)).alias(f"t_{n}") for n in SKETCHED))


def within(rules: Rules) -> Column:
    """Is every rate inside its fences? Null rates and missing thresholds are."""
    wide = 1 + rules.short / F.greatest(F.col("_s.n_words"), F.lit(1))
    passed = F.lit(True)
    for name in METRICS:
        low, high = F.col(f"t_{name}.low"), F.col(f"t_{name}.high")
        if name == METRICS[0]:
            middle, half = (low + high) / 2, (high - low) / 2 * wide
            inside = (F.col(name) <= middle + half) & (F.col(name) >= middle - half)
        else:
            count = COUNTED[name]
            inside = (F.col(name) <= high * wide) | (F.col(count) <= F.col(f"t_{count}.high"))
        passed = passed & F.coalesce(inside, F.lit(True))
    return passed


def judge(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", rules: Rules = Rules(), keep_text: bool = True) -> DataFrame:
    """``docs`` with the counts of ``COUNTS``, ``base_failed`` and ``kept``.

    ``base_failed``: fewer than 10 words, or more than a fifth of the words in repeated windows.
    ``kept``: not failed, and characters, symbols, repeated lines and repeated words per word or
    line lie within the fences of the text's language and source. Those come from quantiles of
    mergeable sketches over all documents, joined back to every document; small groups lean on their
    language, and languages on all documents, without any switch by size.

    Null texts count as empty: no words, ``base_failed``, not kept. Null languages and sources are
    groups of their own. Repeated rows are all kept apart, a very long text is counted whole, an empty table gives an empty table;
    input columns with the names of the results are replaced, others carried along (``text`` only
    with ``keep_text``). Counts are made once and staged in the shared folder.
    """
    carried = Carried(docs)
    counted = carried.flat.withColumn("_s", stats(carried.column(text)))
    if not keep_text:
        counted = counted.drop(carried.key(text))
    staged, _ = stage(counted, "quality-counts")
    rated = staged.select("*", *(value.alias(name) for name, value in metrics().items()))
    place = rated.withColumns({"lang": carried.column(lang), "source": carried.column(source)})
    sketch, sketched = stage(sketches(place, rules.gamma), "quality-sketches")
    limits, _ = stage(thresholds(sketch, rules), "quality-thresholds")
    discard(docs.sparkSession, sketched)
    limits = limits.withColumnsRenamed({"lang": "_lang", "source": "_source"})
    same = carried.column(lang).eqNullSafe(F.col("_lang")) & carried.column(source).eqNullSafe(F.col("_source"))
    judged = rated.join(limits, same, "left")
    words, repeated = F.col("_s.n_words"), F.col("_s.n_repeat_words")
    judged = judged.withColumn("_failed", (words < 10) | (100 * repeated > 20 * words))
    added = {name: F.col(f"_s.{name}") for name in COUNTS}
    added |= {"base_failed": F.col("_failed"), "kept": ~F.col("_failed") & within(rules)}
    if not keep_text:
        carried.forget(text)
    return carried.named(judged, added=added)


def keep_good(docs: DataFrame, rules: Rules = Rules(), **names: str) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with their columns as they were."""
    carried = Carried(docs)
    at = {k: carried.key(v) for k, v in ({"text": "text", "lang": "lang", "source": "source"} | names).items()}
    return carried.named(judge(carried.flat, rules=rules, **at).where("kept"))
