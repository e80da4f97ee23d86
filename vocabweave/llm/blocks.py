"""Words and hashes of many texts at once, as numpy arrays over their UTF-8 bytes.

Tasks read Arrow batches and work on blocks of a few megabytes, so a task's memory depends on
the block size and on the longest single text, not on the size of its partition.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCK_BYTES = 2 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Words are runs of bytes other than ASCII white space.
SPACED = np.ones(256, bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False
#: Words are runs of digits, lower-case letters and bytes beyond ASCII.
PLAIN = np.zeros(256, bool)
PLAIN[0x30:0x3A] = PLAIN[0x61:0x7B] = PLAIN[0x80:] = True

_BASE = np.uint64(0x9E3779B97F4A7C15 | 5)


def free_name(name: str, taken: Iterable[str]) -> str:
    """``name``, with as many underscores before it as set it apart from ``taken`` in any case."""
    used = {t.lower() for t in taken}
    while name.lower() in used:
        name = f"_{name}"
    return name


def mix(x: np.ndarray) -> np.ndarray:
    """Well spread 64-bit values of 64-bit values, one to one."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)


class _Powers:
    """Powers of a base modulo 2**64, from two small tables."""

    def __init__(self, base: int):
        self.low = np.multiply.accumulate(np.r_[np.uint64(1), np.full(4095, base, np.uint64)])
        self.step = np.uint64(pow(base, 4096, 1 << 64))

    def _high(self, n: int) -> np.ndarray:
        return np.multiply.accumulate(np.r_[np.uint64(1), np.full(n >> 12, self.step)])

    def first(self, n: int) -> np.ndarray:
        return (self._high(n)[:, None] * self.low).ravel()[:n]

    def at(self, places: np.ndarray) -> np.ndarray:
        if not len(places):
            return np.zeros(0, np.uint64)
        return self._high(int(places.max()))[places >> 12] * self.low[places & 4095]


_UP, _DOWN = _Powers(int(_BASE)), _Powers(pow(int(_BASE), -1, 1 << 64))


class Hashes:
    """Hashes of any byte ranges of ``data``, from one running sum over it."""

    def __init__(self, data: np.ndarray):
        value = _BYTES[data]
        value *= _UP.first(len(data))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(value, out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        out = self.sums[ends]
        out -= self.sums[starts]
        out *= _DOWN.at(starts)
        return mix(out)

    def grams(self, size: int) -> np.ndarray:
        """Hash of each run of ``size`` bytes, by its first place."""
        out = self.sums[size:] - self.sums[:-size]
        out *= _DOWN.first(len(out))
        return mix(out)


def text_blocks(column: pa.Array, block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows of about ``block_bytes``; null is empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = pc.fill_null(column, b"")
    if len(column) == 0:
        return
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + block_bytes, "right")) - 1)
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def words(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, bounds): byte ranges of the words and, per text, where its words begin."""
    inside = kind[data]
    border = np.zeros(len(data) + 1, bool)
    border[offsets] = True
    before = np.concatenate([[False], inside[:-1]]) if len(data) else inside
    after = np.concatenate([inside[1:], [False]]) if len(data) else inside
    starts = np.flatnonzero(inside & (border[:-1] | ~before))
    ends = np.flatnonzero(inside & (border[1:] | ~after)) + 1
    return starts, ends, np.searchsorted(starts, offsets)


_STEP = np.uint64(0xD6E8FEB86659FD93)


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` values, by its first position."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:n].copy()
    for k in range(1, size):
        out *= _STEP
        out += hashes[k : k + n]
    return mix(out + np.uint64(size))


def owners(bounds: np.ndarray) -> np.ndarray:
    """The text of each element, where ``bounds`` has the first element of each text and the end."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... of each range, one range after the other."""
    total = int(lengths.sum())
    shift = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
    return np.arange(total) + shift


def fold(id_column: str, folds: int) -> Column:
    """crc32 of the id as text modulo ``folds``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit(""))) % folds
