"""Splitting texts into the words that merges work on."""

from __future__ import annotations

import re
from collections.abc import Callable

import regex

#: Fixed value: letters without marks of their own kind up to U+024F. In a text of these and ASCII
#: only, the Unicode classes of the patterns are plain ranges, and the faster ``re`` does.
LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
#: First and last code point of letters and numbers that the tokenizers library does not know as
#: such yet, while newer tables do.
LATER_LETTERS = (
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC), (0x208F, 0x208F), (0x209D, 0x209F), (0xA7CE, 0xA7CF),
    (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4), (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2), (0xA7F1, 0xA7F1), (0xAB6C, 0xAB6D), (0x107BB, 0x107BF),
    (0x10940, 0x10959), (0x10EC5, 0x10EC7), (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A), (0x11DB0, 0x11DDB), (0x11DF1, 0x11DF1), (0x16EA0, 0x16EB8),
    (0x16EBB, 0x16ED3), (0x16FF2, 0x16FF3), (0x187F8, 0x187FF), (0x18CD6, 0x18CDA), (0x18D09, 0x18D20), (0x18D80, 0x18DF2), (0x18E00, 0x19191),
    (0x191A0, 0x191D2), (0x1B123, 0x1B128), (0x1B168, 0x1B168), (0x1D6A6, 0x1D6A6), (0x1DF1F, 0x1DF24), (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96),
    (0x1DFCD, 0x1DFFF), (0x1E6C0, 0x1E6DE), (0x1E6E0, 0x1E6E2), (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4), (0x1E6FE, 0x1E6FF),
    (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479), (0x3D000, 0x3FC3F),
)
LATER_NUMBERS = ((0x11DE0, 0x11DE9), (0x1246F, 0x1246F), (0x12475, 0x1247F), (0x12550, 0x12686), (0x16FF4, 0x16FF6))
_LATIN = re.compile(f"[\x00-\x7f{LETTERS}]*").fullmatch


def _without(name: str, ranges: tuple[tuple[int, int], ...]) -> str:
    return rf"[\p{{{name}}}--[" + "".join(f"\\U{a:08X}-\\U{b:08X}" for a, b in ranges) + "]]"


def known_classes(pattern: str) -> str:
    """``pattern`` with the letters and numbers of the tokenizers library, whatever this Python's tables hold."""
    return pattern.replace(r"\p{L}", _without("L", LATER_LETTERS)).replace(r"\p{N}", _without("N", LATER_NUMBERS))


def splitter(pattern: str) -> Callable[[str], list[str]]:
    """The words of a text by ``pattern``, in which letters and numbers are ``\\p{L}`` and ``\\p{N}``.

    Both expressions give the same words of a Latin text; others take the general one.
    """
    general = regex.compile(known_classes(pattern), regex.V1).findall
    ranges = pattern.replace(r"[\p{L}]", f"[{LETTERS}]").replace(r"[\p{N}]", "[0-9]")
    ranges = ranges.replace(r"[^\s\p{L}\p{N}]", rf"[^\s{LETTERS}0-9]")
    ranges = ranges.replace(r"\p{L}", f"[{LETTERS}]").replace(r"\p{N}", "[0-9]")
    latin = re.compile(ranges, re.ASCII).findall
    return lambda text: latin(text) if _LATIN(text) else general(text)
