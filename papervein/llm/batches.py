"""Whole texts of an Arrow batch as one byte array, for vectorised work inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Texts are handled in slices of about this size, so that work arrays stay small.
SLICE_BYTES = 1 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

# Word bytes of the benchmark comparison: digits, lower-case letters, all of non-ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True

_MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The column's UTF-8 bytes end to end, and the offsets of its rows; null is empty."""
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) else "")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes; a longer text is a range of its own."""
    start, rows = 0, len(offsets) - 1
    while start < rows:
        end = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        end = min(rows, max(start + 1, end))
        yield start, end
        start = end


def text_slices(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets within them) of each slice of a column."""
    data, offsets = text_bytes(column)
    for start, end in slices(offsets):
        own = offsets[start : end + 1]
        yield start, end, data[own[0] : own[-1]], own - own[0]


def words(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of runs of word bytes, and the index of each row's first word.

    ``inside`` marks the word bytes; no word crosses from one row into the next.
    """
    size = len(inside)
    before, after = np.empty(size, bool), np.empty(size, bool)
    if size:
        before[0], after[-1] = False, False
        before[1:], after[:-1] = inside[:-1], inside[1:]
        cuts = offsets[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < size)]
        before[cuts] = False
        after[cuts - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


class _Powers:
    """Powers of the multiplier and of its inverse, grown as needed."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) <= n:
            size = max(n + 1, SLICE_BYTES * 3 // 2)
            up, down = np.full(size, _MULTIPLIER, np.uint64), np.full(size, _INVERSE, np.uint64)
            up[0] = down[0] = 1
            self.up, self.down = np.multiply.accumulate(up), np.multiply.accumulate(down)
        return self.up, self.down


_POWERS = _Powers()


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


_BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_MULTIPLIER))


class Fingerprints:
    """64-bit fingerprints of any byte ranges of an array, from one prefix sum."""

    def __init__(self, data: np.ndarray):
        up, self.down = _POWERS.upto(len(data))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        terms = _BYTE_CODES[data]
        terms *= up[: len(data)]
        np.cumsum(terms, out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.down[starts])

    def width(self, size: int) -> np.ndarray:
        """Of every range of ``size`` bytes, by its start."""
        count = max(0, len(self.sums) - size)
        return mix((self.sums[size:] - self.sums[:count]) * self.down[:count])


def codes_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit fingerprints of ascending byte ranges, a slice of the bytes at a time."""
    out = np.empty(len(starts), np.uint64)
    for i, j in slices(np.append(starts, ends[-1:])):
        base, stop = starts[i], ends[j - 1]
        out[i:j] = Fingerprints(data[base:stop]).of(starts[i:j] - base, ends[i:j] - base)
    return out


def totals(marks: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``marks`` in each row."""
    sums = np.zeros(len(marks) + 1, np.int64)
    np.cumsum(marks, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def window_codes(codes: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit code of every ``size`` consecutive word codes, by the first word."""
    count = max(0, len(codes) - size + 1)
    out = np.zeros(count, np.uint64)
    for k in range(size):
        odd = np.uint64((_MULTIPLIER * (2 * k + 3) * (2 * k + 7)) % (1 << 64) | 1)
        out += (codes[k : k + count] ^ (codes[k : k + count] >> np.uint64(29))) * odd
    return mix(out)
