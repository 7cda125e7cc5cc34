"""Density topics against all pairs of points."""

from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from papervein.config import Config
from papervein.operators import density

NOISE = density.NOISE


def plain(points, radius, min_points, min_topic_size):
    """Topic of every point by all distances, numbered as the operator does."""
    n = len(points)
    far = np.zeros((n, n))
    for d in range(points.shape[1]):
        gap = points[:, None, d] - points[None, :, d]
        far = far + gap * gap
    near = far <= radius * radius
    core = near.sum(1) >= min_points
    group = np.full(n, -1)
    for i in range(n):
        if core[i] and group[i] < 0:
            todo = [i]
            group[i] = i
            while todo:
                a = todo.pop()
                for b in np.flatnonzero(near[a] & core & (group < 0)):
                    group[b] = i
                    todo.append(b)
    members = defaultdict(list)
    for i in range(n):
        if group[i] >= 0:
            members[group[i]].append(i)
    kept = [g for g in members if len(members[g]) >= min_topic_size]
    kept.sort(key=lambda g: (-len(members[g]), min(map(tuple, points[members[g]]))))
    number = {g: k for k, g in enumerate(kept)}
    return [number.get(g, NOISE) for g in group]


def topics_of(spark, points, radius, min_points, min_topic_size=2, few=64):
    rows = [(i, [float(c) for c in p]) for i, p in enumerate(points)]
    df = spark.createDataFrame(rows, "id INT, position ARRAY<DOUBLE>").repartition(4)
    tagged = density.density_topics(df, "position", len(points[0]), radius, min_points, min_topic_size, few)
    return [r["topic"] for r in tagged.orderBy("id").select("topic").collect()]


def test_a_blob_is_one_topic_wherever_it_lies(spark):
    """Blobs at corners, on faces and inside of cells, however the grid may lie."""
    cfg = Config()
    rng = np.random.default_rng(1)
    places = [0.0, 0.5, 0.25, -7.75, 1e6 + 0.1, 3 / 7, 100 * 0.5 / 5**0.5]
    sizes = [300 - 10 * k for k in range(len(places))]
    blobs = [place + 50 * k + rng.uniform(-0.02, 0.02, (n, cfg.reduced_dims)) for k, (place, n) in enumerate(zip(places, sizes))]
    got = topics_of(spark, np.concatenate(blobs), cfg.radius, cfg.min_points, cfg.min_topic_size)
    assert got == [k for k, n in enumerate(sizes) for _ in range(n)]


def scattered(rng, dims, n):
    """Groups of different size and width, a few copies of one point, and noise."""
    parts = [rng.uniform(-3, 3, (n // 4, dims))]
    for _ in range(4):
        parts.append(rng.uniform(-2, 2, dims) + rng.normal(scale=rng.uniform(0.05, 0.4), size=(n // 6, dims)))
    parts.append(np.repeat(rng.uniform(-2, 2, (1, dims)), n // 12, axis=0))
    return np.round(np.concatenate(parts), 3)


@pytest.mark.parametrize("dims, seed, few", [(1, 1, 64), (2, 3, 1), (3, 4, 2), (5, 5, 64)])
def test_all_pairs(spark, dims, seed, few):
    """``few`` = 1 opens every box to the end."""
    rng = np.random.default_rng(seed)
    points = scattered(rng, dims, 360)
    radius = {1: 0.05, 2: 0.25, 3: 0.4, 5: 0.8}[dims]
    assert topics_of(spark, points, radius, 6, 8, few) == plain(points, radius, 6, 8)


def test_distances_at_the_radius_itself(spark):
    """A lattice whose steps are the radius, on coordinates that are exact."""
    points = np.array([(x, y) for x in range(8) for y in range(8) if (x + y) % 7]) * 0.5
    for min_points in (3, 5):
        assert topics_of(spark, points, 0.5, min_points, 1, 1) == plain(points, 0.5, min_points, 1)


def test_full_cells_that_only_opening_can_tell_apart(spark):
    """Two dense rings around two dense centres, a little nearer and further than the radius."""
    rng = np.random.default_rng(9)
    angle = rng.uniform(0, 2 * np.pi, 400)
    for gap in (0.98, 1.02):
        ring = np.stack([np.cos(angle), np.sin(angle)], 1) * gap
        points = np.concatenate([rng.normal(scale=1e-4, size=(60, 2)), ring])
        assert topics_of(spark, points, 1.0, 5, 2, 1) == plain(points, 1.0, 5, 2)


def test_a_hot_position_and_points_around_it(spark):
    """Copies of one point are one position: pairs are never made of them."""
    points = np.concatenate([np.zeros((20_000, 2)), [[0.9, 0.0], [1.1, 0.0], [3.0, 3.0]]])
    got = topics_of(spark, points, 1.0, 5)
    assert got == [0] * 20_001 + [NOISE, NOISE]


def test_points_that_are_no_points(spark):
    rows = [(i, [0.1, 0.2]) for i in range(6)] + [
        (6, None), (7, [0.1, None]), (8, [0.1, float("nan")]), (9, [0.1]), (10, [float("inf"), 0.0]), (11, []),
    ]
    df = spark.createDataFrame(rows, "id INT, position ARRAY<DOUBLE>").withColumn("topic_name", F.lit("kept"))
    tagged = density.density_topics(df, "position", 2, 0.5, 3, 2)
    assert {r["id"]: r["topic"] for r in tagged.collect()} == {i: 0 if i < 6 else NOISE for i in range(12)}
    assert "topic_name" in tagged.columns
    assert density.density_topics(df.limit(0), "position", 2, 0.5, 3, 2).count() == 0


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(0, 400) if i % 100 != 99] + [(900, 901)]
    df = spark.createDataFrame([(a, b) for a, b in edges] + [(b, a) for a, b in edges], "a INT, b INT")
    nodes = spark.createDataFrame([(i,) for i in [*range(401), 900, 901, 950]], "id INT")
    got = {r["id"]: r["component"] for r in density.components(nodes, df).collect()}
    assert got == {i: i // 100 * 100 for i in range(401)} | {900: 900, 901: 900, 950: 950}
