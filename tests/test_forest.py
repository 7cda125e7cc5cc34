"""The spanning forest against Kruskal's way, and its cut against a walk."""

import random

import pytest

from papervein.operators import density, forest, neighbours
from papervein.operators.checkpoints import written


def kruskal(edges):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    kept = set()
    for w, u, v in sorted((w, u, v) for u, v, w in edges):
        a, b = root(u), root(v)
        if a != b:
            parent[a] = b
            kept.add((u, v, w))
    return kept


@pytest.mark.parametrize("seed, nodes, count", [(1, 60, 120), (3, 5, 4)])
def test_minimum_forest(spark, seed, nodes, count):
    """Few distinct weights, so that ties matter, and several components."""
    rng = random.Random(seed)
    pairs = {tuple(sorted(rng.sample(range(nodes), 2))) for _ in range(count)}
    edges = [(u, v, rng.randrange(9) / 4) for u, v in pairs]
    df = spark.createDataFrame(edges, "u LONG, v LONG, w DOUBLE")
    assert {tuple(r) for r in forest.minimum_forest(df).collect()} == kruskal(edges)


def test_mutual_edges(spark):
    edges = [(1, 2, 0.98), (1, 3, 0.5), (2, 1, 0.98), (2, 3, 0.6), (3, 2, 0.6), (3, 4, -1.0), (4, 3, -1.0)]
    df = spark.createDataFrame(edges, "id LONG, neighbour LONG, similarity DOUBLE")

    def far(s):
        return round((2 - 2 * s) ** 0.5, 9)

    core = {1: far(0.5), 2: far(0.6), 3: far(-1.0), 4: far(-1.0)}
    got = {(r["u"], r["v"]): r["w"] for r in forest.mutual_edges(df, 2).collect()}
    want = {(1, 2): far(0.98), (1, 3): far(0.5), (2, 3): far(0.6), (3, 4): far(-1.0)}
    assert got == {(a, b): max(d, core[a], core[b]) for (a, b), d in want.items()}


def sides(edges, factor):
    """The rule for one edge at a time, by walking two steps on each side."""
    near = {}
    for u, v, w in edges:
        near.setdefault(u, {})[v] = w
        near.setdefault(v, {})[u] = w
    kept = set()
    for u, v, w in edges:
        scales = []
        for here, there in ((u, v), (v, u)):
            found = [x for y, x in near[here].items() if y != there]
            found += [x for y in near[here] if y != there for z, x in near[y].items() if z != here]
            if found:
                scales.append(sum(found) / len(found))
        if not scales or w <= factor * max(scales):
            kept.add((u, v, w))
    return kept


def test_cut(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(i), i, rng.choice((1.0, 1.5, 2.0, 6.0))) for i in range(1, 120)] + [(500, 501, 9.0)]
    df = spark.createDataFrame(edges, "u LONG, v LONG, w DOUBLE")
    for factor in (1.3, 2.2):
        assert {tuple(r) for r in forest.kept_edges(df, factor).collect()} == sides(edges, factor)


def test_no_points(spark):
    edges = spark.createDataFrame([], neighbours.EDGES)
    points = spark.createDataFrame([(1,), (2,)], "id LONG")
    assert {r["topic"] for r in forest.topics(points, edges).collect()} == {-1}
    assert forest.topics(points.limit(0), edges).count() == 0


def test_no_round_has_the_driver_hold_a_table(spark, monkeypatch):
    """Tables that are small on disk would be broadcast, every one through the driver."""
    plans = []
    monkeypatch.setattr(forest, "written", lambda df: plans.append(df) or written(df))
    monkeypatch.setattr(density, "written", lambda df: plans.append(df) or written(df))
    edges = [(i, i + 1, float(i % 7)) for i in range(200)]
    df = spark.createDataFrame(edges, "u LONG, v LONG, w DOUBLE")
    found = forest.kept_edges(forest.minimum_forest(df), 1.5)
    texts = [p._jdf.queryExecution().executedPlan().toString() for p in (*plans, found)]
    assert len(texts) > 10 and not any("Broadcast" in text for text in texts)
