"""Token counts with a shortcut for words that are one token."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from itertools import filterfalse

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import normalizers

from trendlake.llm._bpe import BpeTable, WordCache
from trendlake.llm._frames import Carried, parts
from trendlake.llm._pretokens import known_classes, splitter

#: Fixed value: the words of the normalised text. No other choice begins with a letter, so words of
#: letters stand first.
PATTERN = r"[\p{L}]+|'s|'t|'re|'ve|'m|'ll|'d|[\p{N}]|[^\s\p{L}\p{N}]+"


def whole_tokens(path: str, table: BpeTable) -> frozenset[str]:
    """The strings of the vocabulary that the merges alone turn into exactly one token.

    Every token that can end a word is taken back to its bytes and merged as a word of its own;
    it is proved whole if a single id is left. Strings that are no UTF-8 or hold more than one
    word of ``PATTERN`` can't be met in a text and are left out.
    """
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    end = model.get("end_of_word_suffix") or ""
    words = []
    for token, i in model["vocab"].items():
        if token.endswith(end):
            try:
                word = table.pieces[i].decode()
            except UnicodeDecodeError:
                continue
            if regex.fullmatch(known_classes(PATTERN), word, regex.V1):
                words.append(word)
    _, lengths = table.word_ids(words)
    return frozenset(w for w, n in zip(words, lengths.tolist(), strict=True) if n == 1)


#: Composing leaves these as they are, and none but single letters change in lower case.
_PLAIN = re.compile("[\x00-\u02ff]*").fullmatch
_COMPOSE, _LOWER = normalizers.NFC(), normalizers.Lowercase()


def normalised(text: str) -> str:
    """Composed (NFC) and lower case letter by letter. White space is left: no word holds any.

    Which marks compose and which letters have a lower case depends on the version of Unicode, and the
    model's words on what the tokenizers library knows. So texts beyond the Latin letters are
    composed by that library's tables, not by Python's.
    """
    if text.isascii() or _PLAIN(text):
        return text.lower()
    return _LOWER.normalize_str(_COMPOSE.normalize_str(text))


def count_texts(table: BpeTable, whole: frozenset[str], texts: list[str]) -> list[int]:
    """Number of tokens of each text: one for each whole word, merges for the rest."""
    words_of = splitter(PATTERN)
    special = regex.compile("|".join(map(regex.escape, sorted(table.special, key=len, reverse=True)))) if table.special else None
    counts, rest = [], []
    for text in texts:
        pieces = special.split(text) if special else [text]
        words = [w for p in pieces for w in words_of(normalised(p))]
        left = list(filterfalse(whole.__contains__, words))
        counts.append(len(pieces) - 1 + len(words) - len(left))
        rest.append(left)
    known = WordCache.of(table, "count", lambda _, lengths: lengths.tolist()).look_up(rest)
    return [n + sum(map(known.__getitem__, left)) for n, left in zip(counts, rest, strict=True)]


def n_tokens(text: Column, tables) -> Column:
    """Column of the number of tokens of ``text``; ``tables`` is the broadcast table and word set."""

    @F.arrow_udf("bigint")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table, whole = tables.value
        for batch in batches:
            counts = [count_texts(table, whole, [t or "" for t in part.to_pylist()]) for part in parts(batch)]
            yield pa.array(np.array([n for c in counts for n in c], np.int64))

    return count(text)


def count_tokens(docs: DataFrame, path: str, text: str = "text", limit: int = 2048) -> DataFrame:
    """``docs`` with ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens).

    ``path`` names a tokenizers file of a byte-level BPE model with word ends, lower case and NFC.
    The proof of the whole tokens runs once on the driver; the set is bounded by the vocabulary
    and broadcast. No special tokens are added; those inside a text count one each.

    Null texts count as empty: zero bytes, zero tokens, not over the limit. A very long text is counted whole, a very
    long word in n log n. Repeated rows are all
    kept, an empty table gives an empty table. Input columns with the names of the results are
    replaced; others are kept, whatever their names.
    """
    table = BpeTable.load(path)
    tables = docs.sparkSession.sparkContext.broadcast((table, whole_tokens(path, table)))
    carried = Carried(docs)
    value = carried.column(text)
    counted = carried.flat.withColumn("_n_tokens", n_tokens(value, tables))
    return carried.named(
        counted,
        added={
            "n_bytes": F.coalesce(F.octet_length(value), F.lit(0)).cast("bigint"),
            "n_tokens": F.col("_n_tokens"),
            "over_limit": F.col("_n_tokens") > limit,
        },
    )
