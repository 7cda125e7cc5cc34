"""Which terms of a sorted list occur in texts: a batch of texts is searched at once.

All terms that a text holds at one place are beginnings of each other, and of the last term
that sorts not behind the text from there on.  So that term is sought, eight bytes at a time;
how much of it the text holds tells which of its beginnings among the terms occur.  The cost
of a place is a search in the sorted list, however many terms are alike.  A place whose first
bytes lie outside the list costs a comparison, so a long list is best cut into ranges.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Texts are searched in slices of about this many bytes, so that work arrays stay small.
SLICE_BYTES = 1 << 20


@dataclass(frozen=True)
class TermIndex:
    """Distinct terms in the order of their bytes."""

    words: np.ndarray   # bytes of the terms, eight to a number, zeros behind
    first: np.ndarray   # a term's first number, and where the last one ends
    length: np.ndarray  # bytes of a term
    parent: np.ndarray  # the longest other term that it begins with, or -1
    number: np.ndarray  # the caller's number of a term
    times: np.ndarray
    heads: np.ndarray   # distinct first numbers
    start: np.ndarray   # the first term of each, and the number of terms
    upper: np.uint64    # a text whose first number is above this begins with no term

    def word(self, term: np.ndarray, k: int) -> np.ndarray:
        at = self.first[term] + k
        inside = at < self.first[term + 1]
        return np.where(inside, self.words[np.where(inside, at, 0)], np.uint64(0))


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes end to end and the offsets of the rows; null is empty."""
    column = pc.fill_null(column, "").cast(pa.large_binary())
    _, offsets, data = column.buffers()
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def build(terms: pa.Array, number: np.ndarray, times: np.ndarray) -> TermIndex:
    """The index of distinct terms of at least one byte, in the order of their bytes."""
    data, offsets = _bytes(terms)
    length = np.diff(offsets)
    first = np.zeros(len(length) + 1, np.int64)
    np.cumsum(-(-length // 8), out=first[1:])
    padded = np.zeros(first[-1] * 8, np.uint8)
    padded[np.arange(len(data)) + np.repeat(first[:-1] * 8 - offsets[:-1], length)] = data
    words = padded.view(">u8").astype(np.uint64)
    heads, start = np.unique(words[first[:-1]], return_index=True)
    parent, above, flat = np.full(len(length), -1, np.int32), [], data.tobytes()
    for t, (low, high) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        term = flat[low:high]
        while above and not term.startswith(above[-1][1]):
            above.pop()
        if above:
            parent[t] = above[-1][0]
        above.append((t, term))
    return TermIndex(
        words, first, length.astype(np.int32), parent, number, times, heads, np.append(start, len(length)), _upper(words, first, length, parent)
    )


def _upper(words: np.ndarray, first: np.ndarray, length: np.ndarray, parent: np.ndarray) -> np.uint64:
    """The greatest first number of a text that begins with a term: with the last one, or the shortest that it begins with."""
    if not len(length):
        return np.uint64(0)
    term = len(length) - 1
    while parent[term] >= 0:
        term = parent[term]
    spare = 8 * max(0, 8 - int(length[term]))
    return words[first[term]] | np.uint64((1 << spare) - 1)


def _distinct(codes: np.ndarray) -> np.ndarray:
    """Sorted and once each; a sort is several times faster here than ``np.unique``."""
    codes = np.sort(codes)
    return codes[np.append(True, codes[1:] != codes[:-1])] if len(codes) else codes


def _bound(index: TermIndex, k: int, low: np.ndarray, high: np.ndarray, x: np.ndarray, after: bool) -> np.ndarray:
    """The first term of each range whose k-th number is above ``x``, or not below it."""
    low, high = low.copy(), high.copy()
    todo = np.flatnonzero(low < high)
    while len(todo):
        middle = (low[todo] + high[todo]) >> 1
        word = index.word(middle, k)
        right = word <= x[todo] if after else word < x[todo]
        low[todo[right]] = middle[right] + 1
        high[todo[~right]] = middle[~right]
        todo = todo[low[todo] < high[todo]]
    return low


def _last_not_behind(index: TermIndex, at_byte: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, term) of the places that have a term not behind them in the order of bytes."""
    if not len(index.heads):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    x = at_byte[:size]
    place = np.flatnonzero((x >= index.heads[0]) & (x <= index.upper))
    group = np.searchsorted(index.heads, x[place], side="right") - 1
    term = index.start[group + 1] - 1
    deeper = (index.heads[group] == at_byte[place]) & (index.first[term + 1] - index.first[term] > 1)
    own = np.flatnonzero(deeper)
    low, high, k = index.start[group[own]], index.start[group[own] + 1], 1
    while len(own):
        x = at_byte[np.minimum(place[own] + 8 * k, size)]
        upper = _bound(index, k, low, high, x, True)
        term[own] = upper - 1
        last = np.maximum(upper - 1, 0)
        more = (upper > low) & (index.first[last + 1] - index.first[last] > k + 1)
        more[more] = index.word(last[more], k) == x[more]
        own, low, high, x = own[more], low[more], upper[more], x[more]
        low = _bound(index, k, low, high, x, False)
        k += 1
    kept = term >= 0
    return place[kept], term[kept]


def _held(index: TermIndex, at_byte: np.ndarray, size: int, place: np.ndarray, term: np.ndarray) -> np.ndarray:
    """How many bytes of the term the text has at the place."""
    same = np.zeros(len(place), np.int64)
    todo, k = np.arange(len(place)), 0
    while len(todo):
        differ = index.word(term[todo], k) ^ at_byte[np.minimum(place[todo] + 8 * k, size)]
        equal = np.zeros(len(todo), np.int64)
        for bits in range(0, 64, 8):
            equal += differ < np.uint64(1 << bits)
        same[todo] += equal
        todo = todo[equal == 8]
        k += 1
        todo = todo[index.first[term[todo] + 1] - index.first[term[todo]] > k]
    return same


def _found(index: TermIndex, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, term), once each, of all terms that the rows' bytes hold."""
    size, n = len(data), len(index.length)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    at_byte = np.ndarray(size + 1, ">u8", padded, strides=(1,)).astype(np.uint64)
    place, term = _last_not_behind(index, at_byte, size)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[place]
    most = np.minimum(_held(index, at_byte, size, place, term), offsets[row + 1] - place)
    over = np.arange(len(term))
    while len(over):
        over = over[index.length[term[over]] > most[over]]
        term[over] = index.parent[term[over]]
        over = over[term[over] >= 0]
    here = term >= 0
    codes = _distinct(row[here] * n + term[here])
    every = [codes]
    while len(codes):
        text, term = np.divmod(codes, n)
        above = index.parent[term]
        codes = _distinct((text * n + above)[above >= 0])
        every.append(codes)
    return np.divmod(_distinct(np.concatenate(every)), max(n, 1))


def found(index: TermIndex, texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, row, term) of each slice; a longer text is a slice of its own."""
    data, offsets = _bytes(texts)
    start = 0
    while start < len(texts):
        end = int(np.searchsorted(offsets, offsets[start] + SLICE_BYTES, side="right")) - 1
        end = min(len(texts), max(start + 1, end))
        own = offsets[start : end + 1]
        yield start, end, *_found(index, data[own[0] : own[-1]], own - own[0])
        start = end
