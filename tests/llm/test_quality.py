import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
from llm.cases import ODD_ROWS, rows
from pyspark.sql import functions as F

from trendlake.llm import oracles, quality_classifier, quality_rules
from trendlake.llm._text_stats import NAMES, text_stats
from trendlake.llm.quality_classifier import Fit, classify, keep_good
from trendlake.llm.quality_rules import Rules, judge


def plain_stats(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {p for i in range(len(w) - 4) if windows[tuple(w[i : i + 5])] > 1 for p in range(i, i + 5)}
    return (
        len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines), len(lines) - len(set(lines)),
        len(covered), sum("A" <= c <= "Z" for c in text), sum(c in "!?" for c in text), len(set(w)),
    )


def test_counts_of_whole_texts():
    random.seed(2)
    pool = ["a", "b", "é ", " ", "\n", "\x0b", "#", "A!", "\x1c", "\xa0", " c ", "\r\n"]
    texts = ["".join(random.choice(pool) for _ in range(random.randint(0, 90))) for _ in range(1500)]
    texts += [t for _, t, _, _ in ODD_ROWS] + ["a b c d e " * 300]
    got = text_stats(pa.array(texts).slice(2))
    assert list(zip(*(got[n].tolist() for n in NAMES), strict=True)) == [plain_stats(t) for t in texts[2:]]
    assert all(len(v) == 0 for v in text_stats(pa.array([], pa.string())).values())


def corpus(spark, seed=3):
    random.seed(seed)
    words = ["alpha", "be", "gamma", "delta", "epsilon", "of", "zeta"]
    out = []
    for i in range(400):
        lang, source = random.choice(["en", "de", None]), random.choice(["a"] * 8 + ["b", "c", None])
        text = " ".join(random.choice(words) + random.choice(["", "", ".", "\n"]) for _ in range(random.randint(1, 80)))
        if i % 9 == 0:
            text = " ".join(w.upper() + "###" for w in text.split())
        if i % 17 == 0:
            text = "same words over and over again " * 9
        out.append((i, random.choice([text, text, text, text, None]) if i % 50 == 0 else text, lang, source))
    return spark.createDataFrame(out, "doc_id bigint, text string, lang string, source string")


def test_rules_as_in_sql(spark, tmp_path):
    for rules in (Rules(), Rules(prior_docs=5, reach=1.0, short=1.0)):
        df = corpus(spark)
        got = judge(df.repartition(5), rules=rules).select("doc_id", *quality_rules.COUNTS, "base_failed", "kept")
        db = duckdb.connect()
        path = str(tmp_path / f"docs{rules.prior_docs}")
        df.coalesce(1).write.parquet(path)
        db.sql(f"CREATE VIEW documents AS SELECT * FROM '{path}/*.parquet'")
        want = db.sql(oracles.rules_sql(rules)).fetchall()
        assert rows(got) == sorted(map(tuple, want), key=repr)
        verdicts = {r.kept for r in got.collect()}
        assert verdicts == {True, False}


def test_fences_come_from_the_quantiles_of_sketches(spark):
    rules = Rules()
    rng = np.random.default_rng(4)
    values = np.sort(np.r_[rng.lognormal(size=3000), np.zeros(700)])
    frame = spark.createDataFrame([(str(i % 3), str(i % 7), float(v)) for i, v in enumerate(values)], "lang string, source string, x double")
    rates = frame.select("lang", "source", *(F.col("x").alias(n) for n in quality_rules.SKETCHED))
    sketch = quality_rules.sketches(rates, rules.gamma)
    found = {r.metric: r for r in quality_rules.fences(quality_rules.merged(sketch, []), [], rules).collect()}
    at = lambda share, v: v[int(np.ceil(share * len(v))) - 1]
    q1, q3, usual = at(0.25, values), at(0.75, values), at(0.5, values[700:])
    near = lambda a, b: abs(a - b) <= 0.03 * (abs(b) + q3)
    assert near(found["chars_per_word"].high, q3 + 3 * (q3 - q1)) and near(found["chars_per_word"].low, q1 - 3 * (q3 - q1))
    assert near(found["symbols_per_word"].high, 3 * usual * (3000 / 3700) ** 0.5) and found["symbols_per_word"].low is None


def rated(spark, rate):
    """A sketch of documents of two sources; ``rate`` gives the rate of the i-th of a source."""
    rows_ = [("en", source, rate(source, i)) for source in "ab" for i in range(400)]
    frame = spark.createDataFrame(rows_, "lang string, source string, x double")
    return quality_rules.sketches(frame.select("lang", "source", *(F.col("x").alias(n) for n in quality_rules.SKETCHED)), Rules().gamma)


def test_fences_follow_their_group_and_stay_within_the_parent(spark):
    fence = lambda rate: {r.source: r.t_symbols_per_word.high for r in quality_rules.thresholds(rated(spark, rate), Rules()).collect()}
    usual = fence(lambda s, i: 0.02 + i / 4000 if i % 4 == 0 else 0.0)
    doubled = fence(lambda s, i: (2 if s == "a" else 1) * (0.02 + i / 4000) if i % 4 == 0 else 0.0)
    halved = fence(lambda s, i: (0.5 if s == "a" else 1) * (0.02 + i / 4000) if i % 4 == 0 else 0.0)
    assert halved["a"] < 0.7 * usual["a"] and doubled["a"] > usual["a"]
    # Half of a source is junk: its fence stays below the junk, though its own quantiles lie in it.
    junk = fence(lambda s, i: 2.0 + i / 400 if s == "a" and i % 2 else 0.02 + i / 4000 if i % 4 == 0 else 0.0)
    assert junk["a"] < 2.0 and junk["b"] < 0.5


def test_a_source_half_full_of_junk_is_cut(spark):
    random.seed(5)
    words = ["alpha", "be", "gamma", "delta", "epsilon", "of", "zeta", "eta", "theta", "iota", "kappa", "nu", "xi", "pi", "rho"]
    text = lambda: " ".join(random.choices(words, k=60))
    out = [(i, text(), "en", f"s{i % 6}") for i in range(1200)]
    junk = {i for i, _, _, source in out if source == "s0" and i % 4 == 0}
    out = [(i, " ".join(w + "##" for w in t.split()) if i in junk else t, lang, source) for i, t, lang, source in out]
    kept = {r.doc_id for r in judge(spark.createDataFrame(out, "doc_id bigint, text string, lang string, source string")).where("kept").collect()}
    assert not kept & junk and len(kept) > 0.97 * (1200 - len(junk))


def test_one_document_more_changes_a_fence_only_a_little(spark):
    def of(n):
        rows_ = [("en", "a", 0.1 + i % 7 / 100) for i in range(n)] + [("en", "b", 0.4 + i % 9 / 100) for i in range(500)]
        frame = spark.createDataFrame(rows_, "lang string, source string, x double")
        sketch = quality_rules.sketches(frame.select("lang", "source", *(F.col("x").alias(m) for m in quality_rules.SKETCHED)), Rules().gamma)
        (row,) = quality_rules.thresholds(sketch, Rules()).where("source = 'a'").collect()
        return row.t_repeated_per_word.high

    assert abs(of(49) - of(50)) < 0.05 * of(49) and abs(of(200) / of(49) - 1) < 3


def test_two_metrics_decide_on_the_test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    judged = judge(docs).where("NOT base_failed AND NOT kept")
    metrics = {"symbols": judged.where("n_symbols > 0"), "characters": judged.where("n_symbols = 0 AND n_dup_lines = 0 AND n_repeat_words = 0")}
    assert all(frame.count() > 0 for frame in metrics.values())


def test_good_documents_of_a_cleaned_table_stay(spark):
    """The fences of a table without junk leave a single repeated line or passage alone."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    good = keep_good(docs, labels).join(labels.where("quality = 1").select("doc_id"), "doc_id", "left_semi")
    judged = judge(good).where("NOT base_failed")
    assert judged.where("kept").count() >= 0.98 * judged.count()


def test_rules_on_odd_rows(spark, odd, empty, clashing):
    got = judge(clashing(odd, "kept", "n_words", "lang_", "metric"))
    want = [(i, *(plain_stats(t)[NAMES.index(c)] for c in quality_rules.COUNTS)) for i, t, _, _ in ODD_ROWS]
    assert rows(got, "doc_id", *quality_rules.COUNTS) == sorted(want, key=repr)
    assert not any(kept for text, kept in rows(got, "text", "kept") if not text)
    assert judge(empty).collect() == [] and quality_rules.keep_good(empty).collect() == []
    kept = quality_rules.keep_good(clashing(odd, "kept"))
    assert kept.columns == clashing(odd, "kept").columns


def labels_of(df):
    bad = F.col("text").contains("###") | F.col("text").startswith("same words over")
    return df.select("doc_id", (~F.coalesce(bad, F.lit(True))).cast("int").alias("quality"))


def test_classifier_learns_and_shrinks_sites(spark):
    train, held = corpus(spark, 5), corpus(spark, 6)
    judged = classify(train, labels_of(train)).join(labels_of(train).withColumnRenamed("quality", "label"), "doc_id")
    wrong = judged.where((F.col("label") == 1) != F.col("kept")).count()
    assert wrong <= 8
    shifted = held.withColumn("doc_id", F.col("doc_id") + 1000)
    both = classify(train.unionByName(shifted), labels_of(train)).where("doc_id >= 1000")
    truth = labels_of(shifted).withColumnRenamed("quality", "label")
    assert both.join(truth, "doc_id").where((F.col("label") == 1) == F.col("kept")).count() > 380


def test_site_posteriors_against_plain_loops(spark):
    df = corpus(spark, 7)
    got = classify(df.repartition(4), labels_of(df)).collect()
    fit = Fit()
    rows_ = quality_classifier.labelled_sample(df.select(F.col("doc_id").alias("id"), "text"), labels_of(df).toDF("id", "label"), fit)
    prior = quality_classifier.train(rows_, fit).prior
    k = {r.doc_id: round(1e6 / (1 + np.exp(-(r.evidence + prior)))) for r in got}
    hosts, paths = {}, {}
    for r in got:
        for group, at in ((hosts, r.source), (paths, (r.source, r.lang))):
            n, good = group.get(at, (0, 0))
            group[at] = (n + 1, good + k[r.doc_id])

    def strength(groups):
        total, good = sum(n for n, _ in groups.values()), sum(g for _, g in groups.values())
        mean = good / 1e6 / total
        spread = sum(n * (g / 1e6 / n - mean) ** 2 for n, g in groups.values())
        within = mean * (1 - mean)
        between = (spread - (len(groups) - 1) * within) / (total - sum(n * n for n, _ in groups.values()) / total)
        return mean, max(within / min(max(between, within / 10_000), within * 0.999) - 1, 1e-3)

    mean, a = strength(hosts)
    _, b = strength(paths)
    for r in got:
        own = k[r.doc_id] / 1e6
        n, g = hosts[r.source]
        host = (g / 1e6 - own + a * mean) / (n - 1 + a)
        n, g = paths[r.source, r.lang]
        path = (g / 1e6 - own + b * host) / (n - 1 + b)
        quality = 1 / (1 + np.exp(-(r.evidence + np.log(path / (1 - path)))))
        assert np.allclose([host, path, quality], [r.host_share, r.path_share, r.quality], rtol=1e-4)
        assert r.kept == (r.quality >= 0.5)


def test_sample_is_bounded_and_does_not_depend_on_order(spark):
    df = corpus(spark, 8)
    docs, labels = df.select(F.col("doc_id").alias("id"), "text"), labels_of(df).toDF("id", "label")
    twice = docs.unionByName(docs)
    a = quality_classifier.labelled_sample(twice, labels, Fit(sample=50))
    b = quality_classifier.labelled_sample(twice.repartition(7), labels.repartition(3), Fit(sample=50))
    assert len(a) == 50 and (a == b).all()


def test_classifier_on_odd_rows(spark, odd, empty, clashing):
    labels = spark.createDataFrame([(1, 1), (3, 0), (3, 1), (None, 0), (5, None), (6, 7)], "doc_id bigint, quality int")
    more = clashing(odd, "kept", "evidence", "host", "path", "n", "k")
    got = classify(more, labels)
    assert len(got.collect()) == len(ODD_ROWS) and not [r for r in rows(got, "quality", "kept") if None in r]
    assert classify(empty, labels).collect() == [] and keep_good(empty, labels).collect() == []
    unlabelled = classify(odd, labels.where("false"))
    assert {r.evidence for r in unlabelled.collect()} == {0.0} and all(r.kept for r in unlabelled.collect())
    assert keep_good(more, labels.select("*", F.lit(1).alias("label"))).columns == more.columns
