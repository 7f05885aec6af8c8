"""Ranked lexical search: bounds from hashed max-sketches, exact scores where they reach the best."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendlake.llm import _max_sketch
from trendlake.llm._frames import pick
from trendlake.llm._stage import discard, stage

#: A batch of queries has at most so many (query, term) pairs, and results in all, one query at least.
BATCH_PAIRS, BATCH_RESULTS = 200_000, 100_000


@dataclass(frozen=True)
class Index:
    """Documents with their sketches, document counts of all terms, documents with a term, and terms in all."""

    rows: DataFrame
    terms: DataFrame
    n_docs: int
    n_terms: int
    folders: tuple[str, ...]


def build_index(docs: DataFrame, id: str = "doc_id", text: str = "text") -> Index:
    """Read every text once: sketches beside the texts, and the document count of every term.

    A task adds its document counts up before they are shuffled. Nothing depends on queries. The staged tables
    (the texts among them) stay until ``folders`` are discarded.
    """
    given = pick(docs, id=id, text=text)
    schema = T.StructType([given.schema["id"], *T._parse_datatype_string(_max_sketch.INDEX).fields])
    told, folder = stage(given.mapInArrow(_max_sketch.index, schema), "sketches")
    rows = told.where("term IS NULL").drop("term", "df")
    counts, counted = stage(told.where("term IS NOT NULL").groupBy("term").agg(F.sum("df").alias("df")), "terms")
    total = rows.where("n > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    return Index(rows, counts, total[0], total[1], (folder, counted))


def _terms(text: Column) -> Column:
    """The different terms of a text."""

    @F.arrow_udf("array<binary>")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([sorted(set(_max_sketch.terms_of(t))) for t in batch.cast(pa.binary()).to_pylist()], pa.list_(pa.binary()))

    return of(text)


def _batches(queries: DataFrame, k: int) -> Iterator[list[tuple[int, list[tuple[bytes, int]]]]]:
    """The queries, some at a time: no more than a batch is on the driver."""
    held, pairs = [], 0
    for row in queries.toLocalIterator():
        if held and (pairs + len(row.terms) > BATCH_PAIRS or (len(held) + 1) * k > BATCH_RESULTS):
            yield held
            held, pairs = [], 0
        held.append((row.row, [(bytes(t.term), t.df) for t in row.terms]))
        pairs += len(row.terms)
    if held:
        yield held


def _top(hits: DataFrame, k: int, first: str = "rank") -> DataFrame:
    order = Window.partitionBy("row").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return hits.withColumn(first, F.row_number().over(order)).where(F.col(first) <= k)


def search_index(index: Index, items: DataFrame, k: int = 50, item_id: str = "item_id", text: str = "text", doc_name: str = "doc_id") -> DataFrame:
    """The ``k`` best documents of an index for every row of ``items``: (item_id, rank, doc_id, score).

    Queries go over the documents in batches of a bounded size, which are broadcast: the stated
    query set against all rows, in blocks. Each task looks a batch's terms up in its documents'
    sketches, and scores documents exactly in falling order of the bounds until they fall below the
    k-th score. A first pass finds only so many documents a task that ``4 k`` come together;
    their k-th score is one that the true results reach, and lets the second pass leave out what is below it
    in every task.
    """
    spark = items.sparkSession
    asked, given = stage(pick(items, item_id=item_id, text=text).withColumn("row", F.monotonically_increasing_id()), "items")
    pairs = asked.select("row", F.explode(_terms(F.col("text"))).alias("term")).join(index.terms, "term")
    queries, weighed = stage(pairs.groupBy("row").agg(F.collect_list(F.struct("term", "df")).alias("terms")), "queries")
    hits = T.StructType([T.StructField("row", T.LongType()), index.rows.schema["id"], T.StructField("score", T.LongType())])
    few = max(1, -(-4 * k // max(1, index.rows.rdd.getNumPartitions())))
    found = [spark.createDataFrame([], hits)]
    done = [given, weighed]
    for some in _batches(queries, k):
        batch = _max_sketch.Batch(some, index.n_docs, index.n_terms)
        for least in (few, k):
            sent = spark.sparkContext.broadcast(batch)
            passed, folder = stage(index.rows.mapInArrow(partial(_max_sketch.best, batch=sent, k=least), hits), "hits")
            done.append(folder)
            sent.unpersist()
            if least == few and few < k:
                reached = {r.row: r.score for r in _top(passed, k).where(F.col("rank") == k).collect()}
                batch = _max_sketch.Batch(some, index.n_docs, index.n_terms)
                batch.least[:] = [reached.get(row, 0) for row in batch.rows]
            else:
                break
        found.append(passed)
    every = found[0]
    for part in found[1:]:
        every = every.unionByName(part)
    ranked = _top(every, k).join(asked.select("row", "item_id"), "row")
    out, _ = stage(ranked.select("item_id", "rank", F.col("id").alias(doc_name), "score"), "ranked")
    discard(spark, *done)
    return out


def search(docs: DataFrame, items: DataFrame, k: int = 50, id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The ``k`` best documents of every item: (item_id, rank from 1, doc_id, score), highest first.

    A term is a run of ASCII letters, digits and characters beyond ASCII, A-Z in lower case. With N
    documents that hold a term, L terms in all, n terms in a document, df documents with the
    term, tf its count in one, the weight w is floor(1000 ln((2N+2)/(2df+1))), m is
    50 + 50 n N div L, and the score is the sum of w * (10^9 tf div (1000 tf + 20 m)) over
    the item's different terms. Only scores above 0 count; ties go to the smaller id, null ids last.

    The sketch of a document has a coordinate for each hash value of a term and holds the greatest
    impact folded into it, so that the sum at an item's coordinates is never below its score. All
    documents are searched, nothing is approximated.

    Null and empty texts have no terms: such documents are never found, such items find nothing. Repeated
    rows are documents and queries of their own; a very long text is handled whole in one task. An empty table
    on either side gives an empty table. Other columns are left out, whatever their names.
    """
    index = build_index(docs, id, text)
    out = search_index(index, items, k, item_id, item_text, doc_name=id)
    discard(docs.sparkSession, *index.folders)
    return out
