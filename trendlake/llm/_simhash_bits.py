"""SimHash fingerprints of whole texts."""

from __future__ import annotations

import re

import numpy as np
import xxhash

#: Bytes of a text and shingles looked at together; longer texts go on from where the last part ended.
_PART, _SHINGLES = 1 << 20, 1 << 14
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """Signed 64-bit SimHash of ``text`` (UTF-8).

    A-Z are lower-cased; words are runs without the bytes 0x20 and 0x09 to 0x0D. Every run of
    ``shingle`` words, joined by spaces, counts as often as it stands there. A text with fewer
    words is one shingle; a text without words has fingerprint zero.
    """
    votes, total, held, start = np.zeros(64, np.int64), 0, [], 0
    while start < len(text):
        end = start + _PART
        if end < len(text):
            found = _SPACE.search(text, end)
            end = found.start() if found else len(text)
        # bytes.lower and bytes.split know ASCII only: A-Z and the six bytes named above.
        words = held + text[start:end].lower().split()
        start = end
        if len(words) >= shingle:
            total += _vote(words, shingle, seed, votes)
            held = words[len(words) - shingle + 1 :]
        else:
            held = words
    if not total and held:
        total = _vote(held, len(held), seed, votes)
    bits = votes * 2 > total
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def _vote(words: list[bytes], shingle: int, seed: int, votes: np.ndarray) -> int:
    """Add to ``votes`` how many shingles have each bit set; returns the number of shingles."""
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - shingle + 1].tolist()
    ends = ends[shingle - 1 :].tolist()
    for i in range(0, len(starts), _SHINGLES):
        spans = zip(starts[i : i + _SHINGLES], ends[i : i + _SHINGLES], strict=True)
        hashes = np.array([digest(joined[a:b], seed) for a, b in spans], "<u8")
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return len(starts)
