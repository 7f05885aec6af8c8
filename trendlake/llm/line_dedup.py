"""Line dedup: lines that many documents share, found in one sorted stream and dropped by bitmaps."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendlake.llm._frames import Carried, parts
from trendlake.llm._stage import discard, stage

#: What is stripped at both ends of a line.
SPACE = b" \t\n\x0b\x0c\r"

_LINE = "struct<h1: bigint, h2: bigint, first: int, more: binary>"
#: Rows of the sorted stream: a key that goes in a text, one whose count is open, a count at an edge.
GOES, OPEN, EDGE = 0, 1, 2
_FOUND = "kind int, h1 bigint, h2 bigint, t1 bigint, t2 bigint, first int, more binary, n int"


def line_keys(text: bytes, min_chars: int) -> dict[bytes, list[int]]:
    """The places (from 0) of every key of ``min_chars`` code points or more in a text."""
    places: dict[bytes, list[int]] = {}
    for i, line in enumerate(text.split(b"\n")):
        places.setdefault(line.strip(SPACE).lower(), []).append(i)
    return {k: p for k, p in places.items() if len(k) >= 4 * min_chars or len(k.decode(errors="replace")) >= min_chars}


def _pack(places: list[int]) -> bytes | None:
    """The places after the first as compressed distances."""
    return zlib.compress(np.diff(places).astype("<u4").tobytes(), 1) if len(places) > 1 else None


def _places(first: int, more: bytes | None) -> np.ndarray:
    steps = np.frombuffer(zlib.decompress(more), "<u4") if more else np.empty(0, "<u4")
    return np.r_[first, first + np.cumsum(steps, dtype=np.int64)]


def hashed_lines(text: Column, min_chars: int = 1) -> Column:
    """Column of one struct for each different key of a text: 128-bit hash and places."""

    @F.arrow_udf(f"array<{_LINE}>")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            made = [_hashed(part, min_chars) for part in parts(batch)]
            yield pa.concat_arrays(made) if made else _hashed(batch, min_chars)

    return of(text)


def _hashed(texts: pa.Array, min_chars: int) -> pa.Array:
    ends, digests, firsts, more = [0], [], [], []
    for raw in texts.cast(pa.binary()).to_pylist():
        for key, places in line_keys(raw or b"", min_chars).items():
            digests.append(xxhash.xxh3_128_digest(key))
            firsts.append(places[0])
            more.append(_pack(places))
        ends.append(len(firsts))
    halves = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
    columns = [pa.array(halves[:, 0]), pa.array(halves[:, 1]), pa.array(firsts, pa.int32()), pa.array(more, pa.binary())]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(columns, ["h1", "h2", "first", "more"]))


def shared(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Keys with ``least`` documents or more, from rows sorted by key and text; a row is a document.

    A run of equal keys is counted as it streams by and at most ``least`` of its rows are held
    back. The first and the last run of a task may go on in the tasks beside it: their counts are
    told as EDGE rows, and their rows as OPEN ones as long as this task alone does not decide.
    """
    run = None
    edge = True
    for batch in batches:
        if not batch.num_rows:
            continue
        h1, h2 = batch.column("h1").to_numpy(), batch.column("h2").to_numpy()
        new = np.flatnonzero((h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])) + 1
        cuts = np.r_[0, new, len(h1)]
        key = (h1[0], h2[0])
        if run is not None and run.key != key:
            yield from run.close()
            run, edge = None, False
        run = run or _Run(key, edge, least)
        yield from run.add(batch.slice(0, int(cuts[1])))
        if len(cuts) == 2:
            continue
        yield from run.close()
        edge, last = False, int(cuts[-2])
        if len(cuts) > 3:
            inside = batch.slice(int(cuts[1]), last - int(cuts[1]))
            counts = np.diff(cuts[1:-1])
            yield from _told(inside.filter(pa.array(np.repeat(counts >= least, counts))), GOES)
        run = _Run((h1[-1], h2[-1]), False, least)
        yield from run.add(batch.slice(last))
    if run is not None:
        run.edge = True
        yield from run.close()


class _Run:
    """Rows of one key, as many as needed to decide."""

    def __init__(self, key: tuple[int, int], edge: bool, least: int) -> None:
        self.key, self.edge, self.least = key, edge, least
        self.n, self.held = 0, []

    def add(self, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        self.n += rows.num_rows
        self.held.append(rows)
        if self.n >= self.least:
            for held in self.held:
                yield from _told(held, GOES)
            self.held = []

    def close(self) -> Iterator[pa.RecordBatch]:
        if self.edge:
            for held in self.held:
                yield from _told(held, OPEN)
            row = {"kind": EDGE, "h1": int(self.key[0]), "h2": int(self.key[1]), "n": min(self.n, self.least)}
            yield pa.RecordBatch.from_pylist([row], _ARROW)
        self.held = []


_ARROW = pa.schema([("kind", pa.int32()), *((c, pa.int64()) for c in ("h1", "h2", "t1", "t2")), ("first", pa.int32()), ("more", pa.binary()), ("n", pa.int32())])


def _told(rows: pa.RecordBatch, kind: int) -> Iterator[pa.RecordBatch]:
    """``rows`` as results, a text once: its copies are alike."""
    if not rows.num_rows:
        return
    keys = np.stack([rows.column(c).to_numpy() for c in ("h1", "h2", "t1", "t2")])
    if kind == GOES:
        rows = rows.filter(pa.array(np.r_[True, (keys[:, 1:] != keys[:, :-1]).any(axis=0)]))
    n = rows.num_rows
    columns = [pa.array(np.full(n, kind, np.int32)), *(rows.column(c) for c in ("h1", "h2", "t1", "t2", "first", "more")), pa.nulls(n, pa.int32())]
    yield pa.RecordBatch.from_arrays(columns, schema=_ARROW)


def _bitmap(n_lines: int, marks: list[dict]) -> tuple[int, bytes]:
    keep = np.ones(n_lines, bool)
    for mark in marks:
        keep[_places(mark["first"], mark["more"])] = False
    return int(n_lines - keep.sum()), zlib.compress(np.packbits(keep).tobytes(), 6)


def _bitmaps(n_lines: Column, marks: Column) -> Column:
    @F.arrow_udf("struct<n_dropped: bigint, keep: binary>")
    def of(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for lines, marked in batches:
            made = [(0, None) if m is None else _bitmap(n, m) for n, m in zip(lines.to_pylist(), marked.to_pylist(), strict=True)]
            yield pa.StructArray.from_arrays([pa.array([n for n, _ in made], pa.int64()), pa.array([k for _, k in made], pa.binary())], ["n_dropped", "keep"])

    return of(n_lines, marks)


def kept_lines(text: Column, keep: Column) -> Column:
    """``text`` without the lines whose bit in ``keep`` is zero; whole where ``keep`` is null.

    A null text counts as empty.
    """

    @F.arrow_udf("string")
    def cut(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, kept in batches:
            yield pa.array((t if k is None else _cut(t, k) for t, k in zip(texts, kept.to_pylist(), strict=True)), pa.string(), size=len(texts))

    whole = F.coalesce(text, F.lit(""))
    return F.when(keep.isNull(), whole).otherwise(cut(F.when(keep.isNotNull(), whole), keep))


def _cut(text: pa.StringScalar, keep: bytes) -> str:
    lines = (text.as_py() or "").split("\n")
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), count=len(lines))
    return "\n".join(line for line, bit in zip(lines, bits.tolist(), strict=True) if bit)


def keep_bitmaps(docs: DataFrame, text: str = "text", min_docs: int = 10, min_chars: int = 1, keep_text: bool = False) -> DataFrame:
    """``docs`` with ``n_lines``, ``n_dropped`` and ``keep``: a compressed bitmap of the lines that stay.

    A line's key is the line without white space at its ends, with A-Z in lower case. Keys of at
    least ``min_chars`` code points that are found in at least ``min_docs`` documents lose all
    their lines in every document. ``keep`` (zlib, most significant bit first, a bit a line) is
    null where all lines stay; ``kept_lines`` applies it. Without ``keep_text`` the text column is
    left out, so that no text is moved.

    A document tells each of its keys once, with all its places, as a 128-bit hash. These rows are
    range-partitioned and sorted by key and text, so that a key that nearly every document has
    is spread over many tasks, and counted as they stream by; what a key has in the tasks at whose edges
    it lies is added up. Texts are known by a 128-bit hash, so that copies, each a document of its own when
    counted, take their bitmap from one row.

    Lines end at a line feed; a null or empty text is one empty line, whose key never counts with
    ``min_chars`` 1 or more. Repeated rows are documents of their own, an empty table gives an
    empty table, a text of any length is handled whole in one task. Input columns with the names
    of the results are replaced; others are kept, whatever their names.
    """
    spark = docs.sparkSession
    carried = Carried(docs)
    value = F.coalesce(carried.column(text), F.lit(""))
    known = {"t1": F.xxhash64(value), "t2": F.xxhash64(F.lit(1), value)}
    told = carried.flat.select(hashed_lines(value, min_chars).alias("lines"), *(c.alias(k) for k, c in known.items()))
    lines, listed = stage(told.select("t1", "t2", F.inline("lines")), "lines")
    order = ["h1", "h2", "t1", "t2", "first"]
    placed = lines.repartitionByRange(*order).sortWithinPartitions(*order)
    found, told_in = stage(placed.mapInArrow(partial(shared, least=min_docs), _FOUND), "shared")
    discard(spark, listed)
    edges = found.where(F.col("kind") == EDGE).groupBy("h1", "h2").agg(F.sum("n").alias("docs")).where(F.col("docs") >= min_docs)
    late = found.where(F.col("kind") == OPEN).join(edges, ["h1", "h2"], "left_semi")
    gone = found.where(F.col("kind") == GOES).unionByName(late)
    # Staged, so that the join below is of plain shuffles: only then are the copies of one text, all with one
    # hash, split over tasks.
    marks, _ = stage(gone.groupBy("t1", "t2").agg(F.collect_set(F.struct("first", "more")).alias("_marks")), "line-marks")
    discard(spark, told_in)
    n_lines = F.length(value) - F.length(F.replace(value, F.lit("\n"), F.lit(""))) + 1
    rows = carried.flat.withColumns({f"_{k}": c for k, c in known.items()} | {"_n_lines": n_lines.cast("bigint")})
    if not keep_text:
        carried.forget(text)
    marked = rows.join(marks, (F.col("_t1") == F.col("t1")) & (F.col("_t2") == F.col("t2")), "left")
    made = marked.withColumn("_made", _bitmaps(F.col("_n_lines"), F.col("_marks")))
    return carried.named(made, added={"n_lines": F.col("_n_lines"), "n_dropped": F.col("_made.n_dropped"), "keep": F.col("_made.keep")})
