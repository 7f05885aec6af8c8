"""The training-data pipeline: documents judged, deduplicated, mixed and tokenised.

Each stage takes what the one before kept, written as Parquet in the shared folder and read again.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from trendlake.llm import bpe_codec, mixing, quality_classifier, quality_rules, simhash_dedup
from trendlake.llm._ship import prepare
from trendlake.llm._stage import discard, read_roots, recorded, stage

#: Tokenizer file of the last stage.
TOKENIZER = "byte_bpe_50k.json"

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Name in the metadata of a result's first column of the folders that were staged for it.
STAGED = "trendlake.staged"


def pipeline_stage(function: Stage) -> Stage:
    """Get the session ready, and remove what was staged for the result that ``docs`` was written from.

    A result names the folders it reads in the metadata of its first column, which goes into Parquet
    and comes back with the rows. So a stage knows from its input alone what is done with, and runs
    side by side never touch each other's folders. A result that was not written, and is read by ``docs`` itself,
    keeps its folders.
    """

    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        prepare(spark)
        done = docs.schema.fields[0].metadata.get(STAGED, []) if docs.columns else []
        if done and not {folder.rsplit("/", 1)[-1] for folder in done} & {root.rsplit("/", 1)[-1] for root in read_roots(docs)}:
            discard(spark, *done)
        folders: list[str] = []
        with recorded(folders):
            out = function(spark, docs, sf_dir)
        names = [name.lower() for name in out.columns]
        plain = names and names.count(names[0]) == 1 and not set(names[0]) & set(".`")
        return out.withMetadata(out.columns[0], {STAGED: folders}) if plain else out

    return run_stage


@pipeline_stage
def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text, beside its source and language, is more likely good than not.

    Null texts count as empty, null sources and languages are groups of their own, repeated rows are judged
    alike, a text of any length is read whole. Without labels the sites' means decide; an empty table gives an empty table.
    All columns are kept, whatever their names.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_classifier.keep_good(docs, labels)


@pipeline_stage
def apply_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents inside the fences of their language and source.

    Null and empty texts have no words and go; null sources and languages are groups of their own, repeated
    rows are judged alike, a text of any length is read whole; an empty table gives an empty table. All columns are kept.
    """
    return quality_rules.keep_good(docs)


@pipeline_stage
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: three-word shingles, two bits at most.

    Null and empty texts are one group. The smallest id stays; of repeated rows, and of rows without an id in a
    group that has none, one. A text of any length is read whole; an empty table gives an empty table. All columns are kept.
    """
    return simhash_dedup.keep_first(docs, shingle=3, max_distance=2)


@pipeline_stage
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target takes it.

    Null sources are one source, the last; null and empty texts have no words and are never taken. Repeated rows are
    documents of their own. An empty table gives an empty table. All columns are kept.
    """
    return mixing.mixed_rows(docs, mixing.Mix(whole=True))


@pipeline_stage
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the token ids of their whole text, of any length.

    Null texts count as empty and have no ids; repeated rows are all encoded; an empty table gives an empty table. A
    column named ``token_ids`` is replaced, others are kept.
    """
    return bpe_codec.encode(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality classifier", classify),
    ("quality rules", apply_rules),
    ("simhash near-dedup", drop_near_duplicates),
    ("mixing", mix),
    ("bpe encoding", encode),
]

#: A fitted classifier and XXH64 fingerprints are beyond SQL; the tests hold the rows against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to the table ``documents``.

    A run removes what its stages have staged as soon as their result is written; the table of the last one stays.
    """
    docs, done = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, function in STAGES:
        made: list[str] = []
        with recorded(made):
            out = function(spark, docs, sf_dir)
        docs, folder = stage(out, name.replace(" ", "-"))
        discard(spark, *made, *done)
        done = [folder]
    return docs
