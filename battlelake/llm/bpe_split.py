"""Splitting texts into the pieces that byte-level BPE merges separately, over whole arrays of code points.

``public_tokenizers.PATTERN`` reads a text from the left: a contraction, a run of letters, digits or other signs
with at most one space before it, or white space of which the last character is left for what follows. So the
pieces follow from the class of each character and of its neighbours, without a regex match per piece. Classes are
asked of a library once per distinct character.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

import numpy as np

LETTER, DIGIT, SPACE, OTHER = 1, 2, 3, 4


class Classes:
    """Character classes, filled in as characters turn up."""

    def __init__(self, classify: Callable[[str], int]):
        self.classify, self.table = classify, np.zeros(0x110000, np.uint8)

    def of(self, codes: np.ndarray) -> np.ndarray:
        found = self.table[codes]
        if not found.all():
            for code in np.unique(codes[found == 0]):
                self.table[code] = self.classify(chr(code))
            found = self.table[codes]
        return found


def by_regex(char: str) -> int:
    import regex

    for kind, pattern in ((LETTER, r"\p{L}"), (DIGIT, r"\p{N}"), (SPACE, r"\s")):
        if regex.match(pattern, char):
            return kind
    return OTHER


def piece_starts(codes: np.ndarray, offsets: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Positions at which pieces begin; ``offsets`` are the texts' bounds in ``codes``."""
    n = len(codes)
    if not n:
        return np.zeros(0, np.int64)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    blank = codes == 0x20
    run = edge[:-1].copy()
    run[1:] |= kinds[1:] != kinds[:-1]
    run_ends = np.append(run[1:], True)
    # The character before, unless that belongs to another text.
    after_blank = np.zeros(n, bool)
    after_blank[1:] = blank[:-1] & ~edge[1:-1]
    space = kinds == SPACE
    starts = run & ~(after_blank & ~space)
    # The last white space before something else stands alone, or with what follows if it's a blank.
    starts |= space & run_ends & ~edge[1:]
    quotes = np.flatnonzero((codes == 0x27) & run & run_ends & ~after_blank & ~edge[1:])
    if len(quotes):
        ahead = np.append(codes, [0, 0])
        inside = np.append(edge, [True, True])
        one, two = ahead[quotes + 1], np.where(inside[quotes + 2], 0, ahead[quotes + 2])
        length = np.zeros(len(quotes), np.int64)
        length[np.isin(one, [ord(c) for c in "stmd"])] = 1
        for pair in ("re", "ve", "ll"):
            length[(one == ord(pair[0])) & (two == ord(pair[1]))] = 2
        quotes, length = quotes[length > 0], length[length > 0]
        starts[quotes + 1] = False
        rest = quotes + 1 + length
        inner = rest < n
        starts[rest[inner]] = True
    return np.flatnonzero(starts)


class Pieces(NamedTuple):
    """Pieces of several texts: all bytes, where pieces begin and end in them, and the first piece of each text."""

    data: bytes
    bounds: np.ndarray
    first: np.ndarray

    def taken(self, which: np.ndarray) -> list[bytes]:
        data, bounds = self.data, self.bounds
        return [data[a:b] for a, b in zip(bounds[which].tolist(), bounds[which + 1].tolist(), strict=True)]


def split(texts: list[str], classes: Classes) -> Pieces:
    joined = "".join(texts)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=offsets[1:])
    starts = piece_starts(codes, offsets, classes.of(codes))
    places = np.zeros(len(codes) + 1, np.int64)
    np.cumsum(1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000), out=places[1:])
    return Pieces(joined.encode("utf-8", "surrogatepass"), places[np.append(starts, len(codes))], np.searchsorted(starts, offsets))
