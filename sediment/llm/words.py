"""Words of an Arrow text column as numpy arrays: boundaries and 64-bit hashes, without Python objects.

A word is a run of bytes other than space and the control characters 9 to 13; in UTF-8 these bytes
never occur inside a longer character.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BASE = 0x9E3779B97F4A7C15
CHUNK_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse modulo 2**64."""
    ups = np.full(size, BASE, np.uint64)
    downs = np.full(size, pow(BASE, -1, 1 << 64), np.uint64)
    ups[0] = downs[0] = 1
    return np.multiply.accumulate(ups), np.multiply.accumulate(downs)


@dataclass
class Words:
    """Words of consecutive texts: ``bounds[i]:bounds[i + 1]`` are the words of text ``i``."""

    hashes: np.ndarray
    bounds: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def ends(self) -> np.ndarray:
        """For each word the index after the last word of its text."""
        return np.repeat(self.bounds[1:], self.counts)

    def texts(self) -> np.ndarray:
        """For each word the number of its text."""
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)

    def ngrams(self, n: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the ``n`` words from each word on, and whether they are all in one text."""
        total = len(self.hashes)
        out = np.full(total, seed, np.uint64)
        reach = max(total - n + 1, 0)
        for i in range(n):
            out[:reach] = out[:reach] * np.uint64(BASE) + self.hashes[i : reach + i]
        return mix(out), np.arange(total) + n <= self.ends()


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    if column.null_count:
        column = pc.fill_null(column, "" if pa.types.is_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if not len(column) or column.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def slices(column: pa.Array, most: int = CHUNK_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """Runs of whole texts of about ``most`` bytes (one longer text is a run of its own)."""
    _, offsets = raw(column)
    begin = 0
    while begin < len(column):
        end = int(np.searchsorted(offsets, offsets[begin] + most, "right")) - 1
        end = min(max(end, begin + 1), len(column))
        yield begin, column.slice(begin, end - begin)
        begin = end


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and byte after the last one of each word."""
    inside = ~SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cuts = offsets[(offsets > 0) & (offsets < len(data))]
    first[cuts] |= inside[cuts]
    last[cuts - 1] |= inside[cuts - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def words(column: pa.Array, lower: bool = False) -> Words:
    """The hashed words of a text column (of a slice of it: the work arrays take 40 bytes a byte)."""
    data, offsets = raw(column)
    if not len(data):
        return Words(np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64))
    starts, stops = word_spans(data, offsets)
    # One table serves all chunks; only a longer single text gets one of its own, which is not kept.
    ups, downs = _powers(CHUNK_BYTES + 1) if len(data) <= CHUNK_BYTES else _powers.__wrapped__(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((LOWER[data] if lower else data).astype(np.uint64) * ups[: len(data)] + ups[: len(data)], out=total[1:])
    hashes = mix((total[stops] - total[starts]) * downs[starts])
    return Words(hashes, np.searchsorted(starts, offsets))
