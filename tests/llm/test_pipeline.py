from collections import Counter

import corpus_pipeline
import duckdb
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from llm.test_mixing import brute as plain_mix
from llm.test_simhash_dedup import plain_components, plain_fingerprint
from tokenizers import Tokenizer

from trendlake.llm import oracles, quality_classifier, quality_rules
from trendlake.llm._stage import discard, recorded
from trendlake.llm.mixing import Mix
from trendlake.llm.queries import QUERIES
from trendlake.staging import list_folders, shared_dir

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    """The rows that every stage got and gave, staged as run() does."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for _, function in corpus_pipeline.STAGES:
        made = function(spark, docs, SF)
        kept = spark.createDataFrame(made.collect(), made.schema)
        out.append((docs, kept))
        docs = kept
    return out


def plain(df):
    return Counter(tuple(r) for r in df.collect())


def test_columns_and_names(spark, steps):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "quality rules", "simhash near-dedup", "mixing", "bpe encoding"]
    for docs, kept in steps[:-1]:
        assert kept.columns == docs.columns


def test_classifier_stage(spark, steps):
    docs, kept = steps[0]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    judged = quality_classifier.classify(docs, labels)
    assert plain(kept) == plain(judged.where("kept").select(docs.columns))
    truth = {r.doc_id: r.quality for r in labels.collect()}
    ids = {r.doc_id for r in kept.collect()}
    good = [i for i, q in truth.items() if q]
    assert sum(i in ids for i in good) >= 0.98 * len(good)
    bad = [i for i, q in truth.items() if not q]
    assert sum(i in ids for i in bad) <= 0.2 * len(bad)


def test_rules_stage(steps, tmp_path):
    docs, kept = steps[1]
    docs.coalesce(1).write.parquet(str(tmp_path / "d"))
    db = duckdb.connect()
    db.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/d/*.parquet'")
    want = [r[0] for r in db.sql(f"SELECT doc_id FROM ({oracles.rules_sql(quality_rules.Rules())}) WHERE kept").fetchall()]
    assert sorted(r.doc_id for r in kept.collect()) == sorted(want)
    assert plain(kept) == plain(docs.where(F.col("doc_id").isin(want)))


def test_dedup_stage(steps):
    docs, kept = steps[2]
    given = docs.collect()
    ids = [r.doc_id for r in given]
    groups = plain_components(ids, [plain_fingerprint(r.text) for r in given], 2)
    assert plain(kept) == Counter(tuple(r) for r in given if r.doc_id in set(groups))


def test_mixing_stage(steps):
    docs, kept = steps[3]
    want = plain_mix([(r.doc_id, r.text, r.source) for r in docs.collect()], Mix(whole=True))
    times = Counter({i: taken // size for i, size, _, _, taken in want if taken})
    assert Counter(r.doc_id for r in kept.collect()) == times
    assert set(plain(kept)) <= set(plain(docs))


def test_encoding_stage(steps):
    docs, kept = steps[4]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter((r.doc_id, r.text, tuple(library.encode(r.text, add_special_tokens=False).ids)) for r in docs.collect())
    assert Counter((r.doc_id, r.text, tuple(r.token_ids)) for r in kept.collect()) == want


def test_run_is_the_stages_one_after_the_other(spark, steps):
    got = corpus_pipeline.run(spark, SF)
    assert Counter((r.doc_id, tuple(r.token_ids)) for r in got.collect()) == Counter((r.doc_id, tuple(r.token_ids)) for r in steps[-1][1].collect())


def test_stages_take_odd_and_empty_tables(spark, odd, empty):
    for docs in (odd.withColumn("n_chars", F.length("text")), empty.withColumn("n_chars", F.length("text"))):
        for _, function in corpus_pipeline.STAGES:
            made = function(spark, docs, SF)
            docs = spark.createDataFrame(made.collect(), made.schema)


def staged(spark):
    return set(list_folders(spark, f"{shared_dir(spark)}/trendlake"))


def test_runs_side_by_side_keep_their_tables(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    halves = [docs.where("doc_id < 100"), docs.where("doc_id >= 100")]
    want = [plain(corpus_pipeline.apply_rules(spark, half, SF)) for half in halves]
    first, second = (corpus_pipeline.apply_rules(spark, half, SF) for half in halves)
    assert [plain(first), plain(second)] == want
    first.write.parquet(f"{tmp_path}/first")
    reread = spark.read.parquet(f"{tmp_path}/first")
    before = staged(spark)
    later = corpus_pipeline.drop_near_duplicates(spark, reread, SF)
    gone = before - staged(spark)
    assert gone and all("quality" in folder for folder in gone)  # those of the first half alone
    assert plain(second) == want[1] and len(later.collect()) <= sum(want[0].values())
    # A result that is handed on without being written keeps what it reads.
    direct = corpus_pipeline.drop_near_duplicates(spark, second, SF)
    assert plain(second) == want[1] and len(direct.collect()) <= sum(want[1].values())


def test_a_run_leaves_its_result_only(spark):
    before = staged(spark)
    out = corpus_pipeline.run(spark, SF)
    left = staged(spark) - before
    assert len(left) == 1 and out.count() > 0


def test_what_a_query_stages_is_removed_by_one_call(spark):
    for name in ("op2_quality_classifier", "op3_simhash_dedup", "op7_mixing", "op8_quality_rules", "op11_lexical_search", "op12_line_dedup"):
        before, folders = staged(spark), []
        with recorded(folders):
            QUERIES[name](spark, SF).collect()
        discard(spark, *folders)
        assert staged(spark) <= before, name
