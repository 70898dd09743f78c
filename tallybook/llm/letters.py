"""Character n-grams of whole texts as hashes, vectorised over runs of documents."""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa

from tallybook.llm.text import scramble

_BASE = 0x9E3779B97F4A7C15
#: Text whose n-grams are taken at once: they need some 70 bytes a character.
SLICE_BYTES = 1 << 18


@functools.cache
def _letter_table() -> np.ndarray:
    """Whether each code point is a letter; built from Python's own character data."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


class Grams:
    """The n-grams of a run of texts, lower-cased, with everything but letters as a blank.

    There is one n-gram for each letter: the character before it, the letter, and those after it.
    `hashes` and `owner` (the text's number) have one entry per n-gram; `letters` has the number
    of letters, and so of n-grams, of each text.
    """

    def __init__(self, texts: pa.Array, width: int) -> None:
        parts = [(t or "").lower() for t in texts.to_pylist()]
        points = np.frombuffer("".join(p + " " * width for p in parts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        ends = np.cumsum([len(p) + width for p in parts])
        letter = _letter_table()[points]
        value = np.where(letter, points, 0).astype(np.uint64)
        before = np.zeros_like(value)
        before[1:] = value[:-1]
        total, factor = before, _BASE
        for step in range(width - 1):
            total[: len(value) - step] += value[step:] * np.uint64(factor)
            factor = factor * _BASE % (1 << 64)
        at = np.flatnonzero(letter)
        self.hashes = scramble(total[at])
        self.owner = np.searchsorted(ends, at, side="right")
        self.letters = np.bincount(self.owner, minlength=len(parts))
