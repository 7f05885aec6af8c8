"""Hashed max-sketches of documents, the bounds they give for queries, and exact scores."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash

from trendlake.llm._frames import parts

#: Bytes that end a term become a space, A-Z lower case.
TRANSLATION = bytes(b if b >= 128 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 32 for b in range(256))

#: Coordinates of a sketch for each different term of the document, least and most bits of a coordinate.
ROOM, LEAST_BITS, MOST_BITS = 8, 6, 16
#: Different terms whose document counts a task holds, cells of a matrix of bounds, and documents scored together.
HELD_TERMS, CELLS, TOGETHER = 500_000, 1 << 21, 128


def terms_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(TRANSLATION).split()


def term_hash(term: bytes) -> int:
    return xxhash.xxh3_64_intdigest(term)


def _binaries(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """One binary value for each slice of ``values``."""
    offsets = np.r_[0, ends].astype(np.int64) * values.itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(values.tobytes())]).cast(pa.binary())


def fold(texts: list[bytes | None]) -> tuple[dict[str, pa.Array], list[bytes], np.ndarray]:
    """Sketches of some texts; their different terms, and how many of the texts hold each.

    A term's coordinate is its hash modulo the width, a power of two by the number of different
    terms. The coordinate holds the greatest count of the terms that share it: a document's
    impact of a term grows with its count, so this is the greatest impact as well, whatever the
    corpus' mean length turns out to be.
    """
    words = [terms_of(t) for t in texts]
    n = np.array([len(w) for w in words], np.int64)
    coded = pa.array([x for w in words for x in w], pa.binary()).dictionary_encode()
    terms = coded.dictionary.to_pylist()
    hashes = np.array([term_hash(t) for t in terms], np.uint64)
    doc = np.repeat(np.arange(len(texts)), n)
    pairs, tf = np.unique(doc * max(1, len(terms)) + coded.indices.to_numpy(), return_counts=True)
    doc, term = np.divmod(pairs, max(1, len(terms)))
    different = np.bincount(doc, minlength=len(texts))
    bits = np.clip(np.ceil(np.log2(np.maximum(1, different) * ROOM)), LEAST_BITS, MOST_BITS).astype(np.int32)
    place = (hashes[term] & ((np.uint64(1) << bits[doc].astype(np.uint64)) - np.uint64(1))).astype(np.int64)
    order = np.lexsort((tf, place, doc))
    doc, place, most = doc[order], place[order], tf[order]
    last = np.r_[(doc[1:] != doc[:-1]) | (place[1:] != place[:-1]), np.ones(min(1, len(doc)), bool)]
    doc, place, most = doc[last], place[last], most[last]
    ends = np.cumsum(np.bincount(doc, minlength=len(texts)))
    sketch = {"n": pa.array(n), "bits": pa.array(bits), "places": _binaries(place.astype("<u2"), ends), "most": _binaries(most.astype("<u4"), ends)}
    return sketch, terms, np.bincount(term, minlength=len(terms))


INDEX = "text string, n bigint, bits int, places binary, most binary, term binary, df bigint"


def index(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, text) with their sketches; then rows that hold only a term and its document count."""
    held: Counter[bytes] = Counter()
    id_type = None
    for batch in batches:
        id_type = batch.schema.field("id").type
        at = 0
        for part in parts(batch.column("text")):
            sketch, terms, df = fold(part.cast(pa.binary()).to_pylist())
            for term, count in zip(terms, df.tolist(), strict=True):
                held[term] += count
            blank = [pa.nulls(len(part), pa.binary()), pa.nulls(len(part), pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column("id").slice(at, len(part)), part, *sketch.values(), *blank], ["id", "text", *sketch, "term", "df"])
            at += len(part)
            if len(held) > HELD_TERMS:
                yield from _counted(held, id_type)
                held.clear()
    if held:
        yield from _counted(held, id_type)


def _counted(held: Counter[bytes], id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    terms = list(held)
    for start in range(0, len(terms), 50_000):
        some = terms[start : start + 50_000]
        kinds = {"id": id_type, "text": pa.string(), "n": pa.int64(), "bits": pa.int32(), "places": pa.binary(), "most": pa.binary()}
        columns = [pa.nulls(len(some), kind) for kind in kinds.values()]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(some, pa.binary()), pa.array([held[t] for t in some], pa.int64())], [*kinds, "term", "df"])


class Postings:
    """For every key from 0 the (query, weight) pairs below it."""

    def __init__(self, keys: np.ndarray, queries: np.ndarray, weights: np.ndarray, n_keys: int) -> None:
        order = np.argsort(keys, kind="stable")
        self.queries, self.weights = queries[order], weights[order]
        self.lengths = np.bincount(keys, minlength=n_keys)
        self.starts = np.cumsum(self.lengths) - self.lengths

    def scores(self, doc: np.ndarray, keys: np.ndarray, impacts: np.ndarray, shape: tuple[int, int], exact: bool) -> np.ndarray:
        """Sums of weight times impact for each document and query (bigint)."""
        met = self.lengths[keys] > 0
        doc, keys, impacts = doc[met], keys[met], impacts[met]
        n = self.lengths[keys]
        each = np.repeat(np.arange(len(keys)), n)
        at = np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n) + self.starts[keys][each]
        cells, values = doc[each] * shape[1] + self.queries[at], self.weights[at] * impacts[each]
        if exact:  # below 2^53 a double holds every sum
            return np.bincount(cells, values, shape[0] * shape[1]).astype(np.int64).reshape(shape)
        sums = np.zeros(shape[0] * shape[1], np.int64)
        np.add.at(sums, cells, values)
        return sums.reshape(shape)


class Batch:
    """Some queries with the document counts of their terms, and what the corpus has in all."""

    def __init__(self, queries: list[tuple[int, list[tuple[bytes, int]]]], n_docs: int, n_terms: int) -> None:
        self.rows = [row for row, _ in queries]
        self.n_docs, self.n_terms = n_docs, n_terms
        self.terms: dict[bytes, int] = {}
        pairs = [(self.terms.setdefault(t, len(self.terms)), q, self.weight(df)) for q, (_, terms) in enumerate(queries) for t, df in terms]
        self.term, self.query, self.weights = np.array(pairs, np.int64).reshape(-1, 3).T
        most = np.bincount(self.query, self.weights, len(queries)).max(initial=0)
        self.exact = most * 1_000_000 < 1 << 53
        self.least = np.zeros(len(queries), np.int64)
        self._by_bits: dict[int, Postings] = {}

    def weight(self, df: int) -> int:
        return math.floor(1000 * math.log((2 * self.n_docs + 2) / (2 * df + 1)))

    @cached_property
    def by_term(self) -> Postings:
        return Postings(self.term, self.query, self.weights, len(self.terms))

    @cached_property
    def hashes(self) -> np.ndarray:
        return np.array([term_hash(t) for t in self.terms], np.uint64)

    def by_place(self, bits: int) -> Postings:
        if bits not in self._by_bits:
            places = (self.hashes & np.uint64((1 << bits) - 1)).astype(np.int64)
            self._by_bits[bits] = Postings(places[self.term], self.query, self.weights, 1 << bits)
        return self._by_bits[bits]

    def lengths(self, n: list[int]) -> np.ndarray:
        """m of documents with ``n`` terms."""
        return np.array([50 + 50 * x * self.n_docs // max(1, self.n_terms) for x in n], np.int64)

    def bounds(self, rows: pa.RecordBatch) -> np.ndarray:
        """No document scores more for a query than its sketch says here."""
        out = np.zeros((rows.num_rows, len(self.rows)), np.int64)
        m, bits = self.lengths(rows.column("n").to_pylist()), rows.column("bits").to_numpy()
        for b in np.unique(bits):
            of = np.flatnonzero(bits == b)
            places, lengths = _flat(rows.column("places"), of, "<u2")
            most, _ = _flat(rows.column("most"), of, "<u4")
            doc = np.repeat(np.arange(len(of)), lengths)
            out[of] = self.by_place(int(b)).scores(doc, places, impact(most, m[of][doc]), (len(of), len(self.rows)), self.exact)
        return out

    def scores(self, texts: list[bytes | None], n: list[int]) -> np.ndarray:
        """The exact scores, from the texts."""
        known, doc, term, tf = self.terms, [], [], []
        for i, text in enumerate(texts):
            for t, count in Counter(filter(known.__contains__, terms_of(text))).items():
                doc.append(i)
                term.append(known[t])
                tf.append(count)
        doc = np.array(doc, np.int64)
        return self.by_term.scores(doc, np.array(term, np.int64), impact(np.array(tf, np.int64), self.lengths(n)[doc]), (len(texts), len(self.rows)), self.exact)


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    tf = tf.astype(np.int64)
    return 1_000_000_000 * tf // (1000 * tf + 20 * m)


def _flat(column: pa.Array, of: np.ndarray, kind: str) -> tuple[np.ndarray, np.ndarray]:
    raw = column.take(pa.array(of)).to_pylist()
    size = np.dtype(kind).itemsize
    return np.frombuffer(b"".join(raw), kind).astype(np.int64), np.array([len(r) // size for r in raw], np.int64)


class _Best:
    """The best ``k`` documents of each query so far, and the score that a further one must reach."""

    def __init__(self, least: np.ndarray, k: int) -> None:
        self.k, self.least, self.table = k, np.maximum(least, 1), None

    def take(self, ids: pa.Array, scores: np.ndarray) -> None:
        doc, query = np.nonzero(scores >= self.least)
        if not len(doc):
            return
        new = pa.table({"query": pa.array(query), "id": ids.take(pa.array(doc)), "score": pa.array(scores[doc, query])})
        both = new if self.table is None else pa.concat_tables([self.table, new])
        order = both.sort_by([("query", "ascending"), ("score", "descending"), ("id", "ascending")])
        of = order.column("query").to_numpy()
        start = np.r_[0, np.flatnonzero(of[1:] != of[:-1]) + 1]
        place = np.arange(len(of)) - np.repeat(start, np.diff(np.r_[start, len(of)]))
        self.table = order.filter(pa.array(place < self.k)).combine_chunks()
        full = place == self.k - 1
        kth = of[full], order.column("score").to_numpy()[full]
        self.least[kth[0]] = np.maximum(self.least[kth[0]], kth[1])


def best(batches: Iterator[pa.RecordBatch], batch, k: int) -> Iterator[pa.RecordBatch]:
    """The ``k`` best documents of this task for every query of the broadcast ``batch``.

    Bounds come first. Documents are scored exactly from their texts in falling order of their
    bounds, until no bound reaches the score of a query's k-th best document so far, or the score
    that the query is known to reach elsewhere.
    """
    queries: Batch = batch.value
    found = _Best(queries.least.copy(), k)
    size = max(1, CELLS // max(1, len(queries.rows)))
    for rows in batches:
        for start in range(0, rows.num_rows, size):
            _search(rows.slice(start, size), queries, found)
    if found.table is not None:
        row = pa.array(np.array(queries.rows, np.int64)[found.table.column("query").to_numpy()])
        out = pa.table({"row": row, "id": found.table.column("id"), "score": found.table.column("score")})
        yield from out.to_batches(max_chunksize=50_000)


def _search(rows: pa.RecordBatch, queries: Batch, found: _Best) -> None:
    bounds = queries.bounds(rows)
    able = np.flatnonzero((bounds >= found.least).any(axis=1))
    bounds = bounds[able]
    falling = np.argsort(-bounds, axis=0, kind="stable")
    rank = np.empty_like(falling)
    np.put_along_axis(rank, falling, np.arange(len(able))[:, None], axis=0)
    # A query's documents come in falling order of its bounds, those of all queries by turns.
    order = np.argsort(np.where(bounds >= found.least, rank, len(able)).min(axis=1, initial=len(able)), kind="stable")
    for start in range(0, len(order), TOGETHER):
        some = order[start : start + TOGETHER]
        some = some[(bounds[some] >= found.least).any(axis=1)]
        if len(some):
            at = pa.array(able[some])
            texts = rows.column("text").take(at).cast(pa.binary()).to_pylist()
            found.take(rows.column("id").take(at), queries.scores(texts, rows.column("n").take(at).to_pylist()))
