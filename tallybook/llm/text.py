"""Vectorised word hashing over Arrow text columns.

Words are maximal runs of bytes other than 0x20 and 0x09-0x0D, which UTF-8 uses for those
characters only, so text is handled as bytes throughout. A word is hashed eight bytes at a time,
each step mixing all bits. The hash of a range of words is a polynomial of their hashes modulo
2^64, taken from prefix sums and then scrambled; equal ranges have equal hashes wherever they
stand. Polynomials of single bytes would not do: long words of two letters can be made to collide
whatever the base is.
"""

from __future__ import annotations

import ctypes
import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Text handled at once; arrays of eight bytes per byte of text stay small then.
SLICE_BYTES = 1 << 20

_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: Words longer than this are hashed one by one.
LONG_WORD = 256
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)
#: Bases for two independent hashes over words.
WORD_BASES = (0xD1342543DE82EF95 | 1, 0xAF251AF3B0F025B5 | 1)
_MASK = (1 << 64) - 1
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(base: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64 for i below at least `length`."""
    held = _powers.get(base)
    if held is None or len(held[0]) < length:
        # A slice has a word for every second byte at most.
        size = max(length, SLICE_BYTES // 2 + 2)
        inverse = pow(base, -1, 1 << 64)
        tables = []
        for factor in (base, inverse):
            steps = np.full(size, factor, dtype=np.uint64)
            steps[0] = 1
            tables.append(np.multiply.accumulate(steps))
        held = (tables[0], tables[1])
        if size <= 4 * SLICE_BYTES:  # tables for a single huge text are not kept
            _powers[base] = held
    return held


def scramble(x: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit values, so that order and low bits look random."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(buffer: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each word."""
    length = end - start
    out = scramble(length.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x632BE59BD9B4E019))
    eights = np.lib.stride_tricks.sliding_window_view(np.concatenate([buffer, np.zeros(8, np.uint8)]), 8)
    longest = int(length.max(initial=0))
    for step in range(-(-min(longest, LONG_WORD) // 8)):
        active = np.flatnonzero((length > 8 * step) & (length <= LONG_WORD)) if longest > 8 * step else np.zeros(0, np.int64)
        chunk = np.ascontiguousarray(eights[start[active] + 8 * step]).view("<u8").ravel()
        chunk &= _MASKS[np.minimum(length[active] - 8 * step, 8)]
        out[active] = scramble((out[active] ^ chunk) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(step))
    for i in np.flatnonzero(length > LONG_WORD):
        digest = hashlib.blake2b(buffer[start[i] : end[i]].tobytes(), digest_size=8).digest()
        out[i] = int.from_bytes(digest, "little")
    return out


class RangeHash:
    """Hashes of ranges [start, end) of a sequence of integers."""

    def __init__(self, values: np.ndarray, base: int) -> None:
        self._powers, self._inverse = _power_tables(base, len(values) + 1)
        self._sums = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(values * self._powers[: len(values)], dtype=np.uint64, out=self._sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = (self._sums[end] - self._sums[start]) * self._inverse[start]
        return scramble(raw + (end - start).astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D))


class Words:
    """The words of a run of documents.

    `hashes` has one value per word, `start`/`end` its bytes in `buffer`, and `first` the number
    of words before each document, with the total at the end.
    """

    def __init__(self, buffer: np.ndarray, offsets: np.ndarray, lower: bool = False) -> None:
        self.buffer = _LOWER[buffer] if lower else buffer
        inside = ~_SEPARATOR[buffer]
        edge = np.zeros(len(buffer) + 1, dtype=bool)
        edge[offsets] = True
        before = np.empty_like(inside)
        after = np.empty_like(inside)
        if len(inside):
            before[0], before[1:] = False, inside[:-1]
            after[-1], after[:-1] = False, inside[1:]
        self.start = np.flatnonzero(inside & (~before | edge[:-1]))
        self.end = np.flatnonzero(inside & (~after | edge[1:])) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.hashes = word_hashes(self.buffer, self.start, self.end)

    def windows(self, width: int) -> np.ndarray:
        """Number of the first word of each run of `width` words inside one document."""
        index = np.arange(max(0, len(self.start) - width + 1))
        limit = np.repeat(self.first[1:], np.diff(self.first))[: len(index)]
        return index[index + width <= limit]


def releasing(work):
    """The same work over batches, giving unused memory back to the system when a task ends: a
    worker is used again by other stages, which have needs of their own."""

    @functools.wraps(work)
    def run(batches):
        try:
            yield from work(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return run


def slices(batch: pa.RecordBatch, column: str = "text", size: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Split a batch into runs of rows of about `size` bytes of text.

    Yields the rows, their text as one byte array, and the offset of each text in it. A null text
    counts as empty; a text over the limit forms a run of its own.
    """
    text = batch.column(column)
    if text.null_count:
        text = text.fill_null("")
    if text.type != pa.large_string():
        text = text.cast(pa.large_string())
    if not len(text):
        return
    offsets = np.frombuffer(text.buffers()[1], dtype=np.int64)[text.offset : text.offset + len(text) + 1]
    data = text.buffers()[2]
    buffer = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    begin = 0
    while begin < len(text):
        end = int(np.searchsorted(offsets, offsets[begin] + size, side="right")) - 1
        end = min(len(text), max(begin + 1, end))
        piece = buffer[offsets[begin] : offsets[end]]
        yield batch.slice(begin, end - begin), piece, offsets[begin : end + 1] - offsets[begin]
        begin = end
