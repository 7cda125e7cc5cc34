"""Gradient-boosted trees on a bounded table of numbers, scored from flat node arrays.

Fitting is for a bounded sample of labelled rows that the caller has gathered; scoring runs
inside tasks on any number of rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Forest:
    """All trees in one set of arrays; a leaf points to itself.

    A row goes left where its feature is at most the threshold.
    """

    base: float
    depth: int
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        rows = np.arange(len(x))
        total = np.full(len(x), self.base)
        for root in self.roots:
            at = np.full(len(x), root)
            for _ in range(self.depth):
                low = x[rows, self.feature[at]] <= self.threshold[at]
                at = np.where(low, self.left[at], self.right[at])
            total += self.value[at]
        return total

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))


def _cuts(column: np.ndarray, bins: int) -> np.ndarray:
    values = np.unique(column)
    if len(values) > bins:
        values = np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1], method="nearest"))
        return values
    return (values[:-1] + values[1:]) / 2


def fit(
    x: np.ndarray,
    y: np.ndarray,
    monotone: dict[int, int] | None = None,
    trees: int = 40,
    depth: int = 4,
    rate: float = 0.2,
    bins: int = 64,
    smallest: int = 20,
    penalty: float = 1.0,
) -> Forest:
    """Boosted trees for logistic loss, grown on binned features.

    ``monotone`` maps a feature to +1 or -1: the probability never falls (rises) as the
    feature grows, all else equal.  A split that would break this is not taken, and each side
    keeps the mean of the two values as a bound for everything below it.  With one class or
    no rows the forest is a constant.  Ties go to the first feature and lowest cut.
    """
    monotone = monotone or {}
    rows = len(x)
    mean = (y.sum() + 0.5) / (rows + 1) if rows else 0.5
    base = float(np.log(mean / (1 - mean)))
    feature, threshold, left, right, value, roots = [], [], [], [], [], []

    def leaf(weight: float) -> int:
        at = len(value)
        feature.append(0)
        threshold.append(np.inf)
        left.append(at)
        right.append(at)
        value.append(weight)
        return at

    cuts = [_cuts(x[:, f], bins) for f in range(x.shape[1])] if rows else []
    binned = np.stack([np.searchsorted(c, x[:, f]) for f, c in enumerate(cuts)], 1) if cuts else None
    margin = np.full(rows, base)
    one_class = rows == 0 or y.min() == y.max()

    def grow(members: np.ndarray, g: np.ndarray, h: np.ndarray, low: float, high: float, level: int) -> int:
        total_g, total_h = g[members].sum(), h[members].sum()
        weight = float(np.clip(-total_g / (total_h + penalty), low, high))
        best = (1e-6, None)
        if level < depth and len(members) >= 2 * smallest:
            parent = total_g**2 / (total_h + penalty)
            for f, own in enumerate(cuts):
                if not len(own):
                    continue
                b = binned[members, f]
                sums_g = np.cumsum(np.bincount(b, g[members], len(own) + 1))[:-1]
                sums_h = np.cumsum(np.bincount(b, h[members], len(own) + 1))[:-1]
                count = np.cumsum(np.bincount(b, minlength=len(own) + 1))[:-1]
                gain = (
                    sums_g**2 / (sums_h + penalty)
                    + (total_g - sums_g) ** 2 / (total_h - sums_h + penalty)
                    - parent
                )
                allowed = (count >= smallest) & (len(members) - count >= smallest)
                if f in monotone:
                    lows = np.clip(-sums_g / (sums_h + penalty), low, high)
                    highs = np.clip(-(total_g - sums_g) / (total_h - sums_h + penalty), low, high)
                    allowed &= monotone[f] * (highs - lows) >= 0
                gain = np.where(allowed, gain, -np.inf)
                k = int(np.argmax(gain))
                if gain[k] > best[0]:
                    best = (gain[k], (f, k))
        if best[1] is None:
            return leaf(rate * weight)
        f, k = best[1]
        goes_left = binned[members, f] <= k
        parts = members[goes_left], members[~goes_left]
        bounds = [(low, high), (low, high)]
        if f in monotone:
            sides = [float(np.clip(-g[p].sum() / (h[p].sum() + penalty), low, high)) for p in parts]
            middle = sum(sides) / 2
            bounds = [(low, middle), (middle, high)] if monotone[f] > 0 else [(middle, high), (low, middle)]
        at = leaf(0.0)
        feature[at], threshold[at] = f, float(cuts[f][k])
        left[at] = grow(parts[0], g, h, *bounds[0], level + 1)
        right[at] = grow(parts[1], g, h, *bounds[1], level + 1)
        return at

    for _ in range(0 if one_class else trees):
        p = 1 / (1 + np.exp(-margin))
        roots.append(grow(np.arange(rows), p - y, p * (1 - p), -np.inf, np.inf, 0))
        tree = Forest(0.0, depth, np.array(roots[-1:]), *map(np.array, (feature, threshold, left, right, value)))
        margin += tree.margin(x)
    return Forest(
        base, depth, np.array(roots, np.int64), np.array(feature, np.int64), np.array(threshold, float),
        np.array(left, np.int64), np.array(right, np.int64), np.array(value, float),
    )
