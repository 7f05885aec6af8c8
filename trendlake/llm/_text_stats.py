"""Counts over whole texts, for many texts of an Arrow array at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Characters that count as symbols, and the words of a window.
SYMBOLS, WINDOW = "#*$%&|<>", 5
NAMES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper", "n_marks", "n_distinct_words")


def text_stats(texts: pa.Array) -> dict[str, np.ndarray]:
    """Counts of every text (null: empty), by the names in ``NAMES``.

    Words are runs without the bytes 0x20 and 0x09 to 0x0D; lines are split at line feeds and
    count only if they hold a word. A word is repeated if it lies in a window of five words that
    stands twice or more in its text. ``n_upper`` counts A-Z, ``n_marks`` exclamation and question marks.
    """
    texts = pc.fill_null(texts, "")
    n = len(texts)
    owner, words = _items(pc.ascii_split_whitespace(texts))
    filled = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    owner, words = owner[filled], words.filter(pa.array(filled))
    codes, n_codes = _codes(words)
    line_owner, lines = _items(pc.split_pattern(texts, "\n"))
    with_word = pc.match_substring_regex(lines, r"[^\x20\x09-\x0D]").to_numpy(zero_copy_only=False)
    line_owner, lines = line_owner[with_word], lines.filter(pa.array(with_word))
    line_codes, n_line_codes = _codes(lines)
    n_lines = np.bincount(line_owner, minlength=n)
    return {
        "n_words": np.bincount(owner, minlength=n),
        "word_chars": np.bincount(owner, pc.utf8_length(words).to_numpy(), minlength=n).astype(np.int64),
        "n_symbols": _bytes_in(texts, SYMBOLS.encode()),
        "n_lines": n_lines,
        "n_dup_lines": n_lines - _distinct(line_owner, line_codes, n_line_codes, n),
        "n_repeat_words": _repeated(owner, codes, n_codes, n),
        "n_upper": _bytes_in(texts, bytes(range(ord("A"), ord("Z") + 1))),
        "n_marks": _bytes_in(texts, b"!?"),
        "n_distinct_words": _distinct(owner, codes, n_codes, n),
    }


def _items(lists: pa.ListArray) -> tuple[np.ndarray, pa.Array]:
    """The items of all lists, and which list each is of."""
    sizes = np.diff(lists.offsets.to_numpy())
    return np.repeat(np.arange(len(lists)), sizes), lists.flatten()


def _codes(items: pa.Array) -> tuple[np.ndarray, int]:
    coded = items.dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), max(len(coded.dictionary), 1)


def _distinct(owner: np.ndarray, codes: np.ndarray, n_codes: int, n: int) -> np.ndarray:
    return np.bincount(np.unique(owner * n_codes + codes) // n_codes, minlength=n)


def _bytes_in(texts: pa.Array, wanted: bytes) -> np.ndarray:
    """How many bytes of each text are among ``wanted``."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    is_wanted = np.zeros(256, bool)
    is_wanted[list(wanted)] = True
    if not len(offsets) or texts.buffers()[2] is None:
        return np.zeros(len(texts), np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    places = np.flatnonzero(is_wanted[data]) + offsets[0]
    return np.diff(np.searchsorted(places, offsets))


def _repeated(owner: np.ndarray, codes: np.ndarray, n_codes: int, n: int) -> np.ndarray:
    """Words of each text that lie in a window standing there twice or more.

    Windows get dense numbers step by step (two words, four, five), so equal numbers mean equal
    words, without hashing.
    """
    if len(codes) < WINDOW:
        return np.zeros(n, np.int64)
    two, n_two = _dense(codes[:-1] * n_codes + codes[1:])
    four, _ = _dense(two[:-2] * n_two + two[2:])
    five, n_five = _dense(four[:-1] * n_codes + codes[4:])
    inside = np.flatnonzero(owner[: len(five)] == owner[WINDOW - 1 :])
    _, back, counts = np.unique(owner[inside] * n_five + five[inside], return_inverse=True, return_counts=True)
    twice = inside[counts[back] > 1]
    step = np.bincount(twice, minlength=len(codes) + 1) - np.bincount(twice + WINDOW, minlength=len(codes) + 1)
    return np.bincount(owner[np.cumsum(step[:-1]) > 0], minlength=n)


def _dense(keys: np.ndarray) -> tuple[np.ndarray, int]:
    values, back = np.unique(keys, return_inverse=True)
    return back.astype(np.int64), len(values)
