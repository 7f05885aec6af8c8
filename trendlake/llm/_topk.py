"""Packing vectors into blocks, bounds of blocks, and scoring block by block."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: A pack holds PACK_ROWS vectors or PACK_VALUES components at most (one vector at least) and is
#: read as BLOCKS blocks of neighbouring rows.
PACK_ROWS, PACK_VALUES, BLOCKS = 8192, 1 << 19, 16
_NO_ID = np.iinfo(np.int64).max
_LONG = np.iinfo(np.int64)

PACK = "pack bigint, n int, dim int, ids array<bigint>, copies array<bigint>, flat array<bigint>, high array<bigint>, low array<bigint>"
BOUNDS = "chunk bigint, pack bigint, bound array<double>"
HITS = "chunk bigint, place int, vec_id bigint, score bigint"


def pack(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Rows (slice, id, copies, vector) of a sorted partition as packs of neighbours.

    ``high`` and ``low`` are the greatest and least of every component in each block, one block
    after the other. Shorter vectors are filled up with zeros.
    """
    held, values, made = [], 0, 0
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("slice", "id", "copies", "vector")), strict=True):
            held.append(row)
            values += len(row[3])
            if len(held) >= rows or values >= PACK_VALUES:
                yield _packed(held, made)
                held, values, made = [], 0, made + 1
    if held:
        yield _packed(held, made)


def _packed(rows: list[tuple], number: int) -> pa.RecordBatch:
    dim = max(len(r[3]) for r in rows)
    flat = np.zeros((len(rows), dim), np.int64)
    for i, r in enumerate(rows):
        flat[i, : len(r[3])] = r[3]
    blocks = [flat[a:b] for a, b in _blocks(len(rows))]
    lists = {
        "ids": [r[1] for r in rows],
        "copies": [r[2] for r in rows],
        "flat": flat.ravel(),
        "high": np.concatenate([b.max(axis=0) for b in blocks]),
        "low": np.concatenate([b.min(axis=0) for b in blocks]),
    }
    columns = [
        pa.array([(rows[0][0] << 32) | number], pa.int64()),
        pa.array([len(rows)], pa.int32()),
        pa.array([dim], pa.int32()),
        *(pa.array([v], pa.list_(pa.int64())) for v in lists.values()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["pack", "n", "dim", *lists])


def _blocks(n: int) -> list[tuple[int, int]]:
    size = -(-n // BLOCKS)
    return [(a, min(a + size, n)) for a in range(0, n, size)]


def dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two integer matrices.

    Doubles are used only where no partial sum can pass 2^53, else Python integers; products
    beyond a long are held at its ends.
    """
    dim = min(a.shape[1], b.shape[1])
    a, b = a[:, :dim], b[:, :dim]
    if not dim or not len(a) or not len(b):
        return np.zeros((len(a), len(b)), np.int64)
    if float(np.abs(a.astype(float)).max()) * float(np.abs(b.astype(float)).max()) * dim < 2.0**53:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    return np.clip(a.astype(object) @ b.astype(object).T, _LONG.min, _LONG.max).astype(np.int64)


def bound(queries: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Greatest score that each query can have in each block: summed over the components."""
    dim = queries.shape[1]
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    # A component that the block lacks, or the query, counts zero on both sides.
    high, low = _wide(high, dim), _wide(low, dim)
    return np.nextafter(dot(up, high).astype(float) + dot(down, low).astype(float), np.inf)


def _wide(m: np.ndarray, dim: int) -> np.ndarray:
    return np.pad(m, ((0, 0), (0, max(0, dim - m.shape[1]))))


def _numbers(row: dict, name: str, width: int | None = None) -> np.ndarray:
    values = np.asarray(row[name].values.fill_null(_NO_ID) if name in ("ids", "vec_ids") else row[name].values, np.int64)
    return values if width is None else values.reshape(-1, width) if width else np.zeros((row["n"].as_py(), 0), np.int64)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(name)[i] for name in batch.schema.names}


def bounds(chunks: pa.Table, packs: pa.Table) -> pa.Table:
    """For every chunk of queries and every pack of a tile: each query's bound there."""
    matrices = [(row["chunk"].as_py(), _numbers(row, "flat", row["dim"].as_py())) for row in _rows(chunks.to_batches())]
    made: list[tuple[int, int, np.ndarray]] = []
    for row in _rows(packs.to_batches()):
        width = row["pack_dim"].as_py()
        high = row["pack_high"].values.to_numpy().reshape(-1, width).max(axis=0, keepdims=True) if width else np.zeros((1, 0), np.int64)
        low = row["pack_low"].values.to_numpy().reshape(-1, width).min(axis=0, keepdims=True) if width else np.zeros((1, 0), np.int64)
        made += [(chunk, row["pack"].as_py(), bound(queries, high, low)[:, 0]) for chunk, queries in matrices]
    ends = np.cumsum([0, *(len(found) for _, _, found in made)])
    flat = pa.array(np.concatenate([np.empty(0), *(found for _, _, found in made)]))
    columns = [pa.array([m[0] for m in made], pa.int64()), pa.array([m[1] for m in made], pa.int64())]
    return pa.table([*columns, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)], ["chunk", "pack", "bound"])


def score(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """The best ``k`` of a pack for the queries of a chunk named by ``places``.

    ``least`` is a score that each of these queries already has ``k`` times elsewhere.
    """
    for row in _rows(batches):
        places = row["places"].values.to_numpy()
        queries = _numbers(row, "flat", row["dim"].as_py())[places]
        own = _numbers(row, "ids")[places]
        least = np.asarray(row["least"].values, np.int64)
        vectors = _numbers({"p": row["pack_flat"], "n": row["pack_n"]}, "p", row["pack_dim"].as_py())
        ids = row["pack_ids"].values
        width = row["pack_dim"].as_py()
        extremes = [row[c].values.to_numpy().reshape(-1, width) if width else np.zeros((len(_blocks(len(vectors))), 0), np.int64) for c in ("pack_high", "pack_low")]
        who, at, value = best(queries, own, least, vectors, np.asarray(ids.fill_null(_NO_ID), np.int64), np.asarray(row["pack_copies"].values, np.int64), *extremes, k)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(who), row["chunk"].as_py()), pa.int64()), pa.array(places[who], pa.int32()), ids.take(pa.array(at)), pa.array(value, pa.int64())],
            ["chunk", "place", "vec_id", "score"],
        )


def best(queries, own, least, vectors, ids, copies, high, low, k):
    """Block-at-a-time search: (query, row, score) of the best ``k`` of each query.

    Every query goes through the blocks in falling order of its bounds and stops when the next
    bound is below its k-th score. Queries that have the same block next are scored together.
    ``copies`` numbers the copies of a row from 1: number 1 of a query's own row is left out.
    """
    limits = bound(queries, high, low)
    order = np.argsort(-limits, axis=1, kind="stable")
    spans = _blocks(len(vectors))
    kept = [np.empty(0, np.int64)] * 3
    kth, going = least.copy(), np.arange(len(queries))
    for step in range(len(spans)):
        going = going[limits[going, order[going, step]] >= kth[going]]
        if not len(going):
            break
        found = [kept]
        for block in np.unique(order[going, step]):
            a, b = spans[block]
            group = going[order[going, step] == block]
            scores = dot(queries[group], vectors[a:b])
            open_ = scores >= kth[group][:, None]
            who, where = np.nonzero(open_)
            where = where + a
            mine = (ids[where] == own[group[who]]) & (copies[where] == 1)
            mine[mine] = [_equal(queries[group[q]], vectors[w]) for q, w in zip(who[mine], where[mine], strict=True)]
            found.append([group[who][~mine], where[~mine], scores[open_][~mine]])
        who, where, value = (np.concatenate(c) for c in zip(*found, strict=True))
        rank = np.lexsort((where, ids[where], -value.astype(float), who)) if np.abs(value).max(initial=0) < 2**53 else np.lexsort((where, ids[where], ~value, who))
        who, where, value = who[rank], where[rank], value[rank]
        start = np.maximum.accumulate(np.where(np.r_[True, who[1:] != who[:-1]], np.arange(len(who)), 0)) if len(who) else who
        nth = np.arange(len(who)) - start
        kept = [c[nth < k] for c in (who, where, value)]
        last = nth == k - 1
        kth[who[last]] = np.maximum(kth[who[last]], value[last])
    return kept


def _equal(a: np.ndarray, b: np.ndarray) -> bool:
    dim = min(len(a), len(b))
    return bool((a[:dim] == b[:dim]).all() and not a[dim:].any() and not b[dim:].any())
