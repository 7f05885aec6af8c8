import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.cases import LONG, rows
from pyspark.sql import functions as F

from trendlake.llm.line_dedup import EDGE, GOES, OPEN, keep_bitmaps, kept_lines, shared

SPACE = " \t\n\x0b\x0c\r"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, least, min_chars=1):
    split = [(i, (text or "").split("\n")) for i, text in docs]
    key = lambda line: line.strip(SPACE).translate(UPPER)
    holders: dict[str, set[int]] = {}
    for n, (_, lines) in enumerate(split):
        for line in lines:
            holders.setdefault(key(line), set()).add(n)
    gone = {k for k, who in holders.items() if len(k) >= min_chars and len(who) >= least}
    out = []
    for i, lines in split:
        kept = [line for line in lines if key(line) not in gone]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def found(df, **options):
    marked = keep_bitmaps(df, keep_text=True, **options)
    return rows(marked.withColumn("kept", kept_lines(F.col("text"), F.col("keep"))), "doc_id", "n_lines", "n_dropped", "kept")


DOCS = [(i, "Menu \nown line %d\n\n  menu\nÉtat\nabc" % i if i % 3 else "état\n\tABC\r\n") for i in range(40)]
DOCS += [(100, None), (101, ""), (102, "\n\n"), (103, " \n x"), (None, "menu\nx\nx\nx"), (104, "MENU"), (104, "MENU"), (105, LONG + "\nabc\n" + LONG)]
DOCS += [(200 + i, "copy\nof one text\nmenu") for i in range(12)]


def test_against_brute_force(spark):
    df = spark.createDataFrame(DOCS, "doc_id bigint, text string")
    for options in ({"min_docs": 10}, {"min_docs": 3, "min_chars": 4}, {"min_docs": 1}, {"min_docs": 1000}):
        assert found(df, **options) == brute(DOCS, options["min_docs"], options.get("min_chars", 1))
    assert found(df.where("false")) == []


def test_many_tasks_share_a_key(spark):
    """With as many range partitions as rows every key goes over the edge of a task."""
    df = spark.createDataFrame(DOCS, "doc_id bigint, text string").repartition(7)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "61")
    try:
        assert found(df, min_docs=10) == brute(DOCS, 10)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_odd_rows_and_clashing_names(spark, odd, empty, clashing):
    given_rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert found(odd, min_docs=3) == brute(given_rows, 3)
    more = clashing(odd, "n_lines", "Keep", "n_dropped", "_t1", "t1", "_marks", "lines")
    marked = keep_bitmaps(more, min_docs=3)
    assert marked.columns == ["doc_id", "lang", "source", "_t1", "t1", "_marks", "lines", "TEXT", "_row", "a.b", "Doc_Id", "n_lines", "n_dropped", "keep"]
    assert rows(marked, "doc_id", "n_lines", "n_dropped") == sorted((r[:3] for r in brute(given_rows, 3)), key=repr)
    assert keep_bitmaps(empty).collect() == []


def test_bitmaps_are_small_and_say_which_lines_stay(spark):
    texts = [(i, "\n".join(["shared"] * 5000 + [f"own {i}"])) for i in range(10)]
    got = keep_bitmaps(spark.createDataFrame(texts, "doc_id bigint, text string")).collect()
    for row in got:
        bits = np.unpackbits(np.frombuffer(zlib.decompress(row.keep), np.uint8), count=row.n_lines)
        assert (row.n_lines, row.n_dropped, len(row.keep) < 40, bits.nonzero()[0].tolist()) == (5001, 5000, True, [5000])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 4)), max_size=30), st.integers(1, 4), st.randoms())
def test_streams_cut_anywhere_count_alike(pairs, least, chance: random.Random):
    """Cutting the sorted rows into tasks and batches never changes which keys go."""
    ordered = sorted(pairs)
    kinds = {"h1": pa.int64(), "h2": pa.int64(), "t1": pa.int64(), "t2": pa.int64(), "first": pa.int32(), "more": pa.binary()}

    def cut(rows):
        ends = sorted(chance.choices(range(len(rows) + 1), k=3))
        return [rows[a:b] for a, b in zip([0, *ends], [*ends, len(rows)], strict=True)]

    told = []
    for task in cut(ordered):
        batches = [pa.RecordBatch.from_pylist([{"h1": h, "h2": -h, "t1": t, "t2": t, "first": 0, "more": None} for h, t in some], pa.schema(kinds.items())) for some in cut(task)]
        told += [row for batch in shared(iter(batches), least) for row in batch.to_pylist()]
    totals: dict[int, int] = {}
    for row in told:
        if row["kind"] == EDGE:
            totals[row["h1"]] = totals.get(row["h1"], 0) + row["n"]
    gone = {(r["h1"], r["t1"]) for r in told if r["kind"] == GOES or r["kind"] == OPEN and totals[r["h1"]] >= least}
    counts = {h: sum(p[0] == h for p in pairs) for h, _ in pairs}
    assert gone == {p for p in pairs if counts[p[0]] >= least}


def test_query_digest(spark):
    df = spark.createDataFrame([(i, "a\nb%d" % i) for i in range(10)], "doc_id bigint, text string")
    digest = F.sha2(kept_lines(F.col("text"), F.col("keep")), 256)
    got = keep_bitmaps(df, keep_text=True).select("doc_id", digest).collect()
    assert sorted(map(tuple, got)) == [(i, hashlib.sha256(b"b%d" % i).hexdigest()) for i in range(10)]
