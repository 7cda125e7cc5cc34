"""Suffix sorting by the difference cover modulo three, to a limited depth.

Positions 1 and 2 modulo 3 are the sample: their triples of symbols are sorted and named,
and where names repeat, the string of names is sorted in the same way.  The remaining
suffixes are ordered by their first symbol and the rank of the sample suffix behind it, and
merged into the sample: two suffixes compare by one or two symbols and then by two ranks.
Sorting stops where names cover the depth that is asked for.
"""

from __future__ import annotations

import numpy as np

# Names below this fit three to a 64-bit key.
_PACKED = 1 << 21


def _names(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, int]:
    """Rank of each triple among the distinct triples, from 1, and their number."""
    if max(a.max(), b.max(), c.max()) < _PACKED:
        key = (a << 42) | (b << 21) | c
        order = np.argsort(key, kind="stable")
        key = key[order]
        new = key[1:] != key[:-1]
    else:
        order = np.lexsort((c, b, a))
        new = np.zeros(len(a) - 1, bool)
        for part in (a, b, c):
            new |= part[order][1:] != part[order][:-1]
    names = np.empty(len(a), np.int64)
    names[order] = np.concatenate([[1], 1 + np.cumsum(new)])
    return names, int(names[order[-1]])


def suffix_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """All positions, ordered by the ``depth`` symbols from there on (at the end: fewer).

    Symbols are integers from 1.  Suffixes with equal prefixes of that depth are adjacent, in
    any order.
    """
    n = len(symbols)
    if n < 3:
        return np.array(sorted(range(n), key=lambda p: symbols[p:].tolist()), np.int64)
    s = np.concatenate([symbols, np.zeros(4, np.int64)])
    # If the last position is 0 modulo 3, the sample gets an empty suffix behind it, so that
    # the names of the positions 1 modulo 3 end with a triple that holds the end.
    sample = np.concatenate([np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)])
    names, distinct = _names(s[sample], s[sample + 1], s[sample + 2])
    rank = np.zeros(n + 4, np.int64)
    if distinct == len(sample) or depth <= 3:
        rank[sample] = names
        ordered = sample[np.argsort(names, kind="stable")]
    else:
        ordered = sample[suffix_order(names, -(-depth // 3))]
        rank[ordered] = np.arange(1, len(ordered) + 1)
    ordered = ordered[ordered < n]
    # The remaining suffixes, by first symbol and the rank behind it.
    rest = np.arange(0, n, 3)
    rest = rest[np.lexsort((rank[rest + 1], s[rest]))]
    return _merge(s, rank, ordered, rest)


def _merge(s: np.ndarray, rank: np.ndarray, ordered: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """One order from that of the sample suffixes and that of the rest, by binary search."""
    low = np.zeros(len(rest), np.int64)
    high = np.full(len(rest), len(ordered))
    active = np.arange(len(rest))
    while len(active):
        middle = (low[active] + high[active]) // 2
        p, q = rest[active], ordered[middle]
        one = q % 3 == 1
        p1, q1 = s[p], s[q]
        # Against a position 1 modulo 3 the ranks behind one symbol decide, else behind two.
        p2, q2 = np.where(one, rank[p + 1], s[p + 1]), np.where(one, rank[q + 1], s[q + 1])
        p3, q3 = np.where(one, 0, rank[p + 2]), np.where(one, 0, rank[q + 2])
        after = (q1 < p1) | ((q1 == p1) & ((q2 < p2) | ((q2 == p2) & (q3 < p3))))
        low[active[after]] = middle[after] + 1
        high[active[~after]] = middle[~after]
        active = active[low[active] < high[active]]
    key = np.concatenate([2 * low, 2 * np.arange(len(ordered)) + 1])
    return np.concatenate([rest, ordered])[np.argsort(key, kind="stable")]
