"""Sparse unit vectors and their decomposition, against dense arithmetic."""

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pytest

from papervein.operators import vectors


def dense(rows):
    units = sorted({r["unit_id"] for r in rows})
    columns = sorted({r["index"] for r in rows})
    matrix = np.zeros((len(units), len(columns)))
    at = {u: i for i, u in enumerate(units)}, {c: j for j, c in enumerate(columns)}
    for r in rows:
        matrix[at[0][r["unit_id"]], at[1][r["index"]]] = r["weight"]
    return matrix, units, columns


def test_weights_by_hand(spark):
    texts = {"a": "Iron loss iron", "b": "loss of steel; Ärger", "c": "", "d": None, "e": "iron 12 STEEL", "f": "x"}
    units = spark.createDataFrame(list(texts.items()), "unit_id STRING, text STRING")
    for dims in (1 << 18, 7):
        def place(term):
            return int(hashlib.md5(term.encode()).hexdigest()[:8], 16) % dims

        counts = {u: Counter(place(w) for w in re.findall(r"\w{2,}", (t or "").lower())) for u, t in texts.items()}
        f = Counter(i for c in counts.values() for i in c)
        want = {}
        for u, c in counts.items():
            raw = {i: n * math.log(7 / (f[i] + 1)) for i, n in c.items()}
            length = math.sqrt(sum(x * x for x in raw.values()))
            want |= {(u, i): x / length for i, x in raw.items() if x}
        got = {(r["unit_id"], r["index"]): r["weight"] for r in vectors.unit_weights(units, dims).collect()}
        assert got == pytest.approx(want)


@pytest.fixture(scope="module")
def weights(spark):
    """Units about a few subjects, in thousands of dimensions."""
    rng = np.random.default_rng(3)
    rows = []
    for i in range(240):
        subject = i % 4
        words = [f"s{subject}w{rng.integers(40)}" for _ in range(25)] + [f"any{rng.integers(1500)}" for _ in range(10)]
        rows.append((f"u{i}", " ".join(words)))
    units = spark.createDataFrame(rows, "unit_id STRING, text STRING")
    return vectors.unit_weights(units).checkpoint()


@pytest.fixture(scope="module")
def decomposed(weights):
    return vectors.decompose(weights, 5)


def test_singular_values_and_vectors(weights, decomposed):
    matrix, units, columns = dense(weights.collect())
    u, s, v = np.linalg.svd(matrix, full_matrices=False)
    got = decomposed
    assert np.allclose(got.values, s[:5], rtol=0.01)
    reduced = {r["unit_id"]: r["reduced"] for r in got.reduced.collect()}
    components = {r["index"]: r["v"] for r in got.components.collect()}
    # The four subjects stand apart from the rest, so their space is found exactly.
    mine = np.array([reduced[x] for x in units])[:, :4]
    theirs = (u * s)[:, :4]
    assert np.allclose(mine @ mine.T, theirs @ theirs.T, atol=0.02)
    axes = np.array([components[c] for c in columns])
    assert np.allclose(axes.T @ axes, np.eye(5), atol=1e-8)
    assert np.allclose(matrix @ axes, [reduced[x] for x in units], atol=1e-8)


def test_subjects_stay_apart(decomposed):
    reduced = {r["unit_id"]: np.array(r["reduced"])[:4] for r in decomposed.reduced.collect()}
    unit = {x: v / np.linalg.norm(v) for x, v in reduced.items()}
    same = [unit[f"u{i}"] @ unit[f"u{i + 4}"] for i in range(0, 200)]
    other = [unit[f"u{i}"] @ unit[f"u{i + 1}"] for i in range(0, 200)]
    assert np.mean(same) > 0.9 and np.mean(other) < 0.3


def test_fewer_ranks_than_asked(spark):
    rows = [("a", 1, 3.0), ("b", 1, 4.0), ("c", 2, 2.0)]
    weights = spark.createDataFrame(rows, "unit_id STRING, index LONG, weight DOUBLE")
    got = vectors.decompose(weights, 3, passes=2)
    assert got.values == pytest.approx([5.0, 2.0, 0.0], abs=1e-6)
    assert len(got.reduced.collect()) == 3
    empty = vectors.decompose(weights.limit(0), 2, passes=1)
    assert empty.values == [0.0, 0.0] and empty.reduced.count() == 0
