"""BPE encoding and decoding by batched numpy merge rounds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendlake.llm._bpe import BpeTable, WordCache
from trendlake.llm._frames import Carried, parts
from trendlake.llm._pretokens import splitter

#: Fixed value: the pattern that splits text before byte-level merges. No other choice begins as a
#: word of letters does, so that stands first.
PATTERN = r" ?\p{L}+|'s|'t|'re|'ve|'m|'ll|'d| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Most ids that are turned to bytes at a time.
_IDS_AT_ONCE = 1 << 20


def encode_texts(table: BpeTable, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of many texts as one flat array, and the number of ids of each text."""
    words_of = splitter(PATTERN)
    special = regex.compile("(" + "|".join(map(regex.escape, sorted(table.special, key=len, reverse=True))) + ")") if table.special else None
    split: list[list[list[str] | str]] = []
    for text in texts:
        pieces = special.split(text) if special else [text]
        # Every second piece is a special token, which stands for one id.
        split.append([words_of(p) if i % 2 == 0 else p for i, p in enumerate(pieces)])
    cache = WordCache.of(table, "bytes", _id_bytes)
    known = cache.look_up([p for pieces in split for p in pieces if isinstance(p, list)])
    own = {token: np.int32(i).tobytes() for token, i in table.special.items()}
    out = [
        b"".join(own[p] if isinstance(p, str) else b"".join(map(known.__getitem__, p)) for p in pieces)
        for pieces in split
    ]
    counts = np.fromiter((len(o) // 4 for o in out), np.int64, len(out))
    return np.frombuffer(b"".join(out), "<i4"), counts


def _id_bytes(ids: np.ndarray, lengths: np.ndarray) -> list[bytes]:
    """The ids of every word as bytes, four an id."""
    data, ends = ids.astype("<i4").tobytes(), np.cumsum(lengths) * 4
    return [data[a:b] for a, b in zip((ends - lengths * 4).tolist(), ends.tolist(), strict=True)]


def decode_ids(table: BpeTable, ids: np.ndarray) -> str:
    """Text of one row of ids. Bytes that are no UTF-8 become U+FFFD; unknown ids give nothing."""
    ids = ids[(ids >= 0) & (ids < table.base)]
    some = (ids[i : i + _IDS_AT_ONCE] for i in range(0, len(ids), _IDS_AT_ONCE))
    return b"".join(b"".join(table.pieces[s]) for s in some).decode("utf-8", "replace")


def token_ids(text: Column, table) -> Column:
    """Column of ``array<int>``: the token ids of ``text``; ``table`` is a broadcast ``BpeTable``.

    A null text counts as empty and gives an empty array, as an empty text does.
    """

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            flat, counts = [], []
            for part in parts(batch):
                ids, n = encode_texts(table.value, [t or "" for t in part.to_pylist()])
                flat.append(ids)
                counts.append(n)
            ends = np.cumsum(np.concatenate([[0], *counts]))
            yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.empty(0, "<i4"), *flat]), pa.int32()))

    return encode(text)


def text_of_ids(ids: Column, table) -> Column:
    """Column of the text that ``ids`` stand for; null ids give null, null elements nothing."""

    @F.arrow_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([_decoded(table.value, batch, i) for i in range(len(batch))], pa.string())

    return decode(ids)


def _decoded(table: BpeTable, batch: pa.Array, i: int) -> str | None:
    row = batch[i]
    if not row.is_valid:
        return None
    return decode_ids(table, row.values.drop_null().to_numpy(zero_copy_only=False))


def encode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``token_ids`` (``array<int>``), the ids of the whole of every text.

    ``path`` names a tokenizers file of a byte-level BPE model. It is read on the driver; its
    arrays (a few MB, bounded by the vocabulary) are broadcast. Special tokens inside a text keep
    their own ids; none are added.

    Null and empty texts give an empty array. Repeated rows are all kept, order does not matter,
    an empty table gives an empty table. An input column named ``token_ids`` is replaced; other
    columns are kept, whatever their names. One text has to fit in memory, one task holds about
    4 MB of texts at a time beside the Arrow batch.
    """
    table = docs.sparkSession.sparkContext.broadcast(BpeTable.load(path))
    carried = Carried(docs)
    return carried.named(carried.flat, added={"token_ids": token_ids(carried.column(text), table)})


def decode(docs: DataFrame, path: str, ids: str = "token_ids") -> DataFrame:
    """``docs`` with ``decoded``, the text of ``token_ids``. See ``encode`` and ``text_of_ids``."""
    table = docs.sparkSession.sparkContext.broadcast(BpeTable.load(path))
    carried = Carried(docs)
    return carried.named(carried.flat, added={"decoded": text_of_ids(carried.column(ids), table)})
