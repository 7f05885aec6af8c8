"""Byte-pair merges for many words at once, and the tables of a tokenizer file."""

from __future__ import annotations

import heapq
import json
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np

_NONE = np.iinfo(np.int64).max

#: Symbols of a word from which on its merges are taken from a heap: a round reads the whole word, and a
#: long one needs many.
LONG_WORD = 256


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary.

    Printable Latin-1 bytes stand for themselves, the others for the code points from 256 on.
    """
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


@dataclass
class BpeTable:
    """A vocabulary with its merges as sorted arrays. A few MB, bounded by the vocabulary.

    ``pair_keys`` holds left * base + right of every merge in rising order; ``pair_ranks`` and
    ``pair_ids`` hold the rank of that merge and the symbol it makes.
    """

    pieces: np.ndarray
    special: dict[str, int]
    base: int
    pair_keys: np.ndarray
    pair_ranks: np.ndarray
    pair_ids: np.ndarray
    pair_early: np.ndarray
    inner: np.ndarray
    last: np.ndarray
    key: tuple = field(default=())

    @classmethod
    def load(cls, path: str) -> BpeTable:
        """Read a tokenizers file of a byte-level BPE model.

        Settings that would change the ids and are not handled here (dropout, fallbacks, prefixes,
        special tokens that strip or need word bounds) raise ``ValueError``.
        """
        with open(path, encoding="utf-8") as file:
            whole = json.load(file)
        model = whole["model"]
        unhandled = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges") if model.get(k)]
        flags = ("single_word", "lstrip", "rstrip", "normalized")
        unhandled += [t["content"] for t in whole["added_tokens"] if any(t[f] for f in flags)]
        if unhandled or model["type"] != "BPE":
            raise ValueError(f"not handled in {path}: {unhandled or model['type']}")
        vocab, end = model["vocab"], model.get("end_of_word_suffix") or ""
        special = {t["content"]: t["id"] for t in whole["added_tokens"]}
        base = max([*vocab.values(), *special.values()]) + 1
        letters = byte_letters()
        to_byte = {letter: b for b, letter in enumerate(letters)}
        pieces = np.full(base, b"", object)
        for token, i in vocab.items():
            inside = token.removesuffix(end) if end else token
            known = all(c in to_byte for c in inside)
            pieces[i] = bytes(to_byte[c] for c in inside) if known else token.encode()
        for token, i in special.items():
            pieces[i] = token.encode()
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in merges], np.int64)
        right = np.array([vocab[b] for _, b in merges], np.int64)
        made = np.array([vocab[a.removesuffix(end) + b if end else a + b] for a, b in merges], np.int64)
        keys = left * base + right
        # A pair may be listed twice: the later place counts, as in a dictionary.
        order = np.lexsort((-np.arange(len(keys)), keys))
        order = order[np.r_[True, np.diff(keys[order]) != 0]] if len(order) else order
        # Does a merge with a lower rank start from what this one makes? Then it goes one by one.
        first_use = np.full(base, _NONE)
        ranks = np.arange(len(keys))
        np.minimum.at(first_use, left, ranks)
        np.minimum.at(first_use, right, ranks)
        early = first_use[made] < ranks
        return cls(
            pieces=pieces,
            special=special,
            base=base,
            pair_keys=keys[order],
            pair_ranks=ranks[order],
            pair_ids=made[order],
            pair_early=early[order],
            inner=np.array([vocab[c] for c in letters], np.int64),
            last=np.array([vocab[c + end] for c in letters], np.int64),
            key=(path, len(vocab), len(merges), end),
        )

    def word_ids(self, words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of the words, which are not empty, in one array, and how many each has."""
        raw = [w.encode() for w in words]
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        data = np.frombuffer(b"".join(raw), np.uint8)
        symbols = self.inner[data]
        ends = np.cumsum(lengths)
        if len(ends):
            symbols[ends - 1] = self.last[data[ends - 1]]
        return self.merge(symbols, lengths)

    def merge(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Apply the merges to many words, given and returned as one flat array and lengths.

        Every round finds the rank of every neighbouring pair by binary search and merges the
        pairs of the lowest rank of each word, from left to right. Words without a pair left are
        set aside. Where a merge can open a merge of a lower rank, only its first place in the
        word is merged in a round, so the order is that of merging one pair at a time. Very long words
        are merged by ``merge_long``.
        """
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        owner, words = np.arange(len(lengths)), len(lengths)
        if (lengths > LONG_WORD).any():
            ends = np.cumsum(lengths)
            for i in np.flatnonzero(lengths > LONG_WORD):
                merged = self.merge_long(symbols[ends[i] - lengths[i] : ends[i]])
                done.append((np.array([i]), np.array([len(merged)]), merged))
            symbols = symbols[np.repeat(lengths <= LONG_WORD, lengths)]
            owner = np.flatnonzero(lengths <= LONG_WORD)
            lengths = lengths[owner]
        while len(owner):
            starts = np.cumsum(lengths) - lengths
            word = np.repeat(np.arange(len(owner)), lengths)
            hit, made = self._round(symbols, word, starts)
            busy = np.zeros(len(owner), bool)
            busy[word[:-1][hit]] = True
            still = busy[word]
            done.append((owner[~busy], lengths[~busy], symbols[~still]))
            symbols = symbols.copy()
            symbols[:-1][hit] = made[hit]
            still[1:][hit] = False
            symbols, lengths = symbols[still], np.bincount(word[still], minlength=len(owner))[busy]
            owner = owner[busy]
        return _in_order(done, words)

    @cached_property
    def merges(self) -> dict[int, tuple[int, int]]:
        """Rank and made symbol by pair."""
        return dict(zip(self.pair_keys.tolist(), zip(self.pair_ranks.tolist(), self.pair_ids.tolist(), strict=True), strict=True))

    def merge_long(self, symbols: np.ndarray) -> np.ndarray:
        """The merges of one word, in n log n: pairs in a heap by rank and place, over linked neighbours."""
        n, merges, base = len(symbols), self.merges, self.base
        known = [merges.get(pair) for pair in (symbols[:-1] * base + symbols[1:]).tolist()]
        heap = sorted(hit[0] * n + i for i, hit in enumerate(known) if hit)
        now, after, before = symbols.tolist(), list(range(1, n + 1)), list(range(-1, n - 1))
        while heap:
            rank, i = divmod(heapq.heappop(heap), n)
            right = after[i]
            if now[i] < 0 or right >= n:
                continue
            hit = merges.get(now[i] * base + now[right])
            if not hit or hit[0] != rank:  # one of the two was merged meanwhile
                continue
            now[i], now[right] = hit[1], -1
            after[i] = following = after[right]
            if following < n:
                before[following] = i
                if new := merges.get(now[i] * base + now[following]):
                    heapq.heappush(heap, new[0] * n + i)
            if (left := before[i]) >= 0 and (new := merges.get(now[left] * base + now[i])):
                heapq.heappush(heap, new[0] * n + left)
        return np.array([s for s in now if s >= 0], np.int64)

    def _round(self, symbols: np.ndarray, word: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which pairs to merge now, and the symbol each would make."""
        n = len(symbols) - 1
        if n < 1 or not len(self.pair_keys):
            return np.zeros(max(n, 0), bool), np.zeros(max(n, 0), np.int64)
        pair = symbols[:-1] * self.base + symbols[1:]
        at = np.minimum(np.searchsorted(self.pair_keys, pair), len(self.pair_keys) - 1)
        known = (self.pair_keys[at] == pair) & (word[:-1] == word[1:])
        rank = np.where(known, self.pair_ranks[at], _NONE)
        lowest = np.minimum.reduceat(np.append(rank, _NONE), starts)
        hit = known & (rank == lowest[word[:-1]])
        places = np.flatnonzero(hit)
        # In a run of overlapping places (aaa) every second one is merged, from the left.
        joined = np.r_[False, (np.diff(places) == 1) & (word[places[1:]] == word[places[:-1]])] if len(places) else np.zeros(0, bool)
        start = np.maximum.accumulate(np.where(joined, 0, np.arange(len(places))))
        drop = (np.arange(len(places)) - start) % 2 == 1
        owner = word[places]
        first = np.r_[True, owner[1:] != owner[:-1]] if len(places) else np.zeros(0, bool)
        drop |= self.pair_early[at[places]] & ~first
        hit[places[drop]] = False
        return hit, self.pair_ids[at]


def _in_order(done: list[tuple[np.ndarray, np.ndarray, np.ndarray]], words: int) -> tuple[np.ndarray, np.ndarray]:
    """Groups of finished words (numbers, lengths, symbols) as one array in the order of numbers."""
    lengths = np.zeros(words, np.int64)
    for owner, own, _ in done:
        lengths[owner] = own
    starts = np.cumsum(lengths) - lengths
    flat = np.empty(int(lengths.sum()), np.int64)
    for owner, own, symbols in done:
        flat[np.repeat(starts[owner] - np.cumsum(own) + own, own) + np.arange(len(symbols))] = symbols
    return flat, lengths


class WordCache:
    """What the ids of words already merged in this worker give; emptied when it grows large.

    ``values`` makes a list, one value a word, of the flat ids and lengths of new words.
    """

    ENTRIES, LONGEST = 300_000, 64
    _of: dict[tuple, WordCache] = {}

    def __init__(self, table: BpeTable, values) -> None:
        self.table, self.values, self.found = table, values, {}

    @classmethod
    def of(cls, table: BpeTable, kind: str, values) -> WordCache:
        """The cache of this Python worker for a table and a kind of value."""
        return cls._of.setdefault((*table.key, kind), cls(table, values))

    def look_up(self, words: list[list[str]]) -> dict[str, object]:
        """A dictionary that has the value of every word in ``words``."""
        new = list(set().union(*words).difference(self.found))
        self.found.update(zip(new, self.values(*self.table.word_ids(new)), strict=True))
        now = self.found
        if len(now) > self.ENTRIES:
            self.found = {}
        elif long := [w for w in new if len(w) > self.LONGEST]:
            self.found = dict(now)
            for w in long:
                del self.found[w]
        return now
