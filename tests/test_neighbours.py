"""The neighbour table against all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from papervein.operators import neighbours


def frame(spark, matrix):
    rows = [(i, [float(x) for x in row]) for i, row in enumerate(matrix)]
    return spark.createDataFrame(rows, "id LONG, vector ARRAY<DOUBLE>").repartition(4)


def exact(matrix, k):
    unit = matrix / np.linalg.norm(matrix, axis=1, keepdims=True)
    alike = unit @ unit.T
    np.fill_diagonal(alike, -np.inf)
    return np.argsort(-alike, axis=1, kind="stable")[:, :k], alike


def recall(edges, matrix, k):
    """Of the k nearest of all points, the share that is in the table, equal distances counting alike."""
    _, alike = exact(matrix, k)
    bar = -np.sort(-alike, axis=1)[:, k - 1]
    return sum(alike[r["id"], r["neighbour"]] >= bar[r["id"]] - 1e-9 for r in edges) / (k * len(matrix))


@pytest.mark.parametrize("kind", ["groups", "uniform"])
def test_recall_against_all_pairs(spark, kind):
    rng = np.random.default_rng(2)
    if kind == "groups":
        centres = rng.normal(size=(30, 24))
        matrix = centres[rng.integers(30, size=3000)] + rng.normal(scale=0.4, size=(3000, 24))
    else:
        matrix = rng.normal(size=(3000, 16))
    distinct, _ = neighbours.points(frame(spark, matrix))
    edges = neighbours.nearest(distinct, 15, bucket=128).collect()
    found = recall(edges, matrix, 15)
    print(kind, found)
    assert found >= 0.9
    _, alike = exact(matrix, 15)
    assert all(abs(alike[r["id"], r["neighbour"]] - r["similarity"]) < 1e-9 for r in edges)
    assert len({(r["id"], r["neighbour"]) for r in edges}) == len(edges) == 15 * 3000


def test_the_given_embeddings(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").orderBy("vec_id").collect()
    matrix = np.array([r["embedding"] for r in rows], float)
    distinct, _ = neighbours.points(frame(spark, matrix))
    edges = neighbours.nearest(distinct, 15, bucket=64).collect()
    assert recall(edges, matrix, 15) >= 0.9


def test_no_bucket_is_left_large(spark):
    """A third of all vectors nearly the same, and many exactly so."""
    rng = np.random.default_rng(4)
    near = np.ones((400, 8)) + rng.normal(scale=1e-9, size=(400, 8))
    matrix = np.concatenate([rng.normal(size=(500, 8)), near, np.ones((300, 8)) * 2])
    distinct, members = neighbours.points(frame(spark, matrix))
    assert members.count() == 1200 and distinct.count() <= 901
    sides = neighbours._sides(distinct, 8, 3, 1)
    sizes = neighbours.buckets(sides, distinct.count(), 50).groupBy("group").count().collect()
    assert sum(r["count"] for r in sizes) == 3 * distinct.count()
    # What planes cannot part is dealt by hash, evenly but not exactly.
    assert max(r["count"] for r in sizes) <= 100


def test_graph_of_copies_and_vectors_that_are_none(spark):
    rows = [
        (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.9, 0.1]), (4, [0.0, 1.0]), (5, None), (6, [0.0, 0.0]),
        (7, [float("nan"), 1.0]), (8, []), (9, [None, 1.0]), (10, [1.0, 0.0]),
    ]
    df = spark.createDataFrame(rows, "id LONG, vector ARRAY<DOUBLE>").withColumn("rank", F.lit("clash"))
    got = neighbours.neighbour_graph(df, 2).orderBy("id", "rank").collect()
    assert [(r["id"], r["point"], r["rank"], r["neighbour"]) for r in got] == [
        (1, 1, 1, 3), (1, 1, 2, 4), (2, 1, 1, 3), (2, 1, 2, 4), (3, 3, 1, 1), (3, 3, 2, 4), (4, 4, 1, 3), (4, 4, 2, 1),
        (10, 1, 1, 3), (10, 1, 2, 4),
    ]
    assert neighbours.neighbour_graph(df.limit(0), 2).count() == 0
    assert neighbours.neighbour_graph(df.where("id = 4"), 2).count() == 0
