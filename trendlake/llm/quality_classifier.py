"""Quality classifier: the evidence of a text beside what is known of its host and path."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendlake.llm._frames import Carried, pick
from trendlake.llm._stage import stage
from trendlake.llm._stats_column import stats

#: Shares are summed as whole millionths, so sums do not depend on the order of rows.
_UNIT = 1_000_000


@dataclass(frozen=True)
class Fit:
    """Parameters of the classifier.

    It is fitted on ``sample`` labelled rows at most, those with the smallest hash of the id;
    everything else covers all documents. ``ridge`` bounds the weights, ``reach`` the evidence
    (in log-odds) of one text. ``reject_below`` is the probability under which a document goes.
    """

    sample: int = 20_000
    ridge: float = 1.0
    steps: int = 25
    reach: float = 12.0
    reject_below: float = 0.5


@dataclass(frozen=True)
class Model:
    """Standardised logistic regression; ``prior`` is the log-odds of good among the labels."""

    mean: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]
    bias: float
    prior: float


def features() -> list[Column]:
    """Surface rates of a text, from the struct ``_s`` of ``text_stats``."""
    s = lambda name: F.col(f"_s.{name}").cast("double")
    words, chars = F.greatest(s("n_words"), F.lit(1.0)), F.greatest(s("word_chars"), F.lit(1.0))
    return [
        F.log1p(s("n_words")),
        s("word_chars") / words,
        s("n_symbols") / words,
        F.sqrt(s("n_symbols") / chars),
        s("n_upper") / chars,
        F.sqrt(s("n_marks") / words),
        s("n_dup_lines") / F.greatest(s("n_lines"), F.lit(1.0)),
        F.sqrt(s("n_repeat_words") / words),
        F.log1p(s("n_words")) - F.log1p(s("n_distinct_words")),
    ]


def labelled_sample(docs: DataFrame, labels: DataFrame, fit: Fit) -> np.ndarray:
    """Features and label (last column) of the bounded sample; docs (id, text), labels (id, label).

    Labels that are null or neither 0 nor 1 don't count; an id labelled both ways counts as bad. The
    chosen labels are broadcast: there are ``fit.sample`` of them at most, so no text is shuffled.
    """
    chosen = labels.where("id IS NOT NULL AND label IN (0, 1)").groupBy("id").agg(F.min("label").alias("label"))
    chosen = chosen.orderBy(F.xxhash64("id"), "id").limit(fit.sample)
    rows = docs.join(F.broadcast(chosen), "id").withColumn("_s", stats(F.col("text")))
    rows = rows.select(F.xxhash64("id").alias("h"), "id", F.array(*features(), F.col("label").cast("double")).alias("x"))
    kept = rows.orderBy("h", "id", "x").limit(fit.sample).select("x").collect()
    return np.array([r.x for r in kept], float).reshape(len(kept), len(features()) + 1)


def train(rows: np.ndarray, fit: Fit) -> Model:
    """Ridge logistic regression by Newton steps. Without both classes all evidence is zero."""
    x, y = rows[:, :-1], rows[:, -1]
    width = x.shape[1]
    good = (y.sum() + 1) / (len(y) + 2)
    prior = float(np.log(good / (1 - good)))
    if len(np.unique(y)) < 2:
        return Model((0.0,) * width, (1.0,) * width, (0.0,) * width, prior, prior)
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
    z = np.c_[(x - mean) / scale, np.ones(len(x))]
    w = np.zeros(width + 1)
    w[-1] = prior
    penalty = np.full(width + 1, fit.ridge)
    penalty[-1] = 1e-6
    for _ in range(fit.steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        slope = z.T @ (y - p) - penalty * w
        bend = (z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty)
        step = np.linalg.solve(bend, slope)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return Model(tuple(map(float, mean)), tuple(map(float, scale)), tuple(map(float, w[:-1])), float(w[-1]), prior)


def evidence(model: Model, fit: Fit) -> Column:
    """Log-odds that the text alone speaks for good, without the prior of the labels."""
    odds = F.lit(model.bias - model.prior)
    for x, m, s, w in zip(features(), model.mean, model.scale, model.weights, strict=True):
        odds = odds + (x - F.lit(m)) / F.lit(s) * F.lit(w)
    return F.greatest(F.lit(-fit.reach), F.least(F.lit(fit.reach), odds))


def _share(odds: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))


def _odds(share: Column) -> Column:
    safe = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), share))
    return F.log(safe / (F.lit(1.0) - safe))


def sites(scored: DataFrame) -> DataFrame:
    """Documents and good share of every path, its host and all: (host, path, n, k, host_n, host_k).

    Counted in two steps, rows to paths and paths to hosts, with partial sums before each
    shuffle. ``k`` is in millionths of a document.
    """
    paths = scored.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("k").alias("k"))
    hosts = paths.groupBy(F.col("host").alias("h")).agg(F.sum("n").alias("host_n"), F.sum("k").alias("host_k"))
    return paths.join(hosts, F.col("host").eqNullSafe(F.col("h"))).drop("h")


def strength(groups: DataFrame, n: str, k: str) -> tuple[float, float]:
    """Mean share and prior strength (in documents) of a level of groups, by the method of moments.

    The spread of the groups' shares beyond what their sizes explain sets the strength: alike
    groups make a strong prior, different ones a weak one. One row of sums reaches the driver.
    """
    share = F.col(k) / _UNIT / F.col(n)
    total, good, n_groups, square = groups.agg(
        F.sum(n), F.sum(k), F.count(F.lit(1)), F.sum((F.col(n) * F.col(n)).cast("decimal(38,0)")).cast("double")
    ).first()
    if not total:
        return 0.5, 1.0
    mean = min(max(good / _UNIT / total, 1e-6), 1 - 1e-6)
    # Rounded to whole billionths before the sum, so the order of rows has no say.
    off = F.round(F.col(n) * (share - mean) * (share - mean) * 1e9).cast("decimal(38,0)")
    spread = float(groups.agg(F.sum(off)).first()[0]) / 1e9
    within = mean * (1 - mean)
    room = total - square / total
    between = (spread - (n_groups - 1) * within) / room if room > 0 else 0.0
    most = within * 0.999
    between = min(max(between, within / 10_000), most)
    return mean, max(within / between - 1, 1e-3)


def classify(
    docs: DataFrame,
    labels: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    host: str = "source",
    path: str = "lang",
    label: str = "quality",
    fit: Fit = Fit(),
    keep_text: bool = True,
) -> DataFrame:
    """``docs`` with ``evidence``, ``host_share``, ``path_share``, ``quality`` (probability) and ``kept``.

    A logistic regression on surface rates, fitted on a bounded labelled sample, gives each text's
    evidence. Over all documents the expected good ones are summed by path (host and path) and by
    host. A host's share is shrunk to the global one, a path's to its host's, as strongly as
    method-of-moments priors say: a sparse site says little of its own. A document's probability is
    its evidence on top of its path's share, in which the document itself is left out.

    Null and empty texts have the rates of an empty text. Null hosts and paths are sites of their
    own; null ids can't be labelled. Repeated rows are all kept and counted, an empty table
    gives an empty table, no usable labels give no evidence (everything is kept at an even prior
    or better). Input columns with the names of the results are replaced; others are carried
    along (``text`` only with ``keep_text``). Evidence is computed once and staged.
    """
    carried = Carried(docs)
    model = train(labelled_sample(pick(docs, id=id, text=text), pick(labels, id=id, label=label), fit), fit)
    known = carried.flat.withColumn("_s", stats(carried.column(text)))
    known = known.withColumn("_evidence", evidence(model, fit)).drop("_s")
    known = known.withColumn("_k", F.round(_share(F.col("_evidence") + model.prior) * _UNIT).cast("bigint"))
    if not keep_text:
        known = known.drop(carried.key(text))
    scored, _ = stage(known, "evidence")
    site, _ = stage(sites(scored.select(carried.column(host).alias("host"), carried.column(path).alias("path"), F.col("_k").alias("k"))), "sites")
    hosts = site.groupBy("host").agg(F.max("host_n").alias("n"), F.max("host_k").alias("k"))
    mean, host_weight = strength(hosts, "n", "k")
    _, path_weight = strength(site, "n", "k")
    joined = scored.join(
        site, carried.column(host).eqNullSafe(F.col("host")) & carried.column(path).eqNullSafe(F.col("path"))
    )
    own = F.col("_k") / _UNIT
    host_share = (F.col("host_k") / _UNIT - own + host_weight * mean) / (F.col("host_n") - 1 + host_weight)
    path_share = (F.col("k") / _UNIT - own + path_weight * F.col("_host_share")) / (F.col("n") - 1 + path_weight)
    joined = joined.withColumn("_host_share", host_share).withColumn("_path_share", path_share)
    joined = joined.withColumn("_quality", _share(F.col("_evidence") + _odds(F.col("_path_share"))))
    if not keep_text:
        carried.forget(text)
    return carried.named(
        joined,
        added={
            "evidence": F.col("_evidence"),
            "host_share": F.col("_host_share"),
            "path_share": F.col("_path_share"),
            "quality": F.col("_quality"),
            "kept": F.col("_quality") >= fit.reject_below,
        },
    )


def keep_good(docs: DataFrame, labels: DataFrame, fit: Fit = Fit(), **names: str) -> DataFrame:
    """The rows of ``docs`` that ``classify`` keeps, with their columns as they were."""
    carried = Carried(docs)
    labels = pick(labels, id=names.get("id", "doc_id"), label=names.get("label", "quality"))
    at = {k: carried.key(names.get(k, v)) for k, v in {"id": "doc_id", "text": "text", "host": "source", "path": "lang"}.items()}
    labels = labels.withColumnRenamed("id", at["id"])
    return carried.named(classify(carried.flat, labels, label="label", fit=fit, **at).where("kept"))
