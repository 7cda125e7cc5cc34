"""Approximate nearest neighbours of all vectors by cosine: a table of edges.

Vectors are dealt into buckets by several trees of random hyperplanes; a bucket of more than
``bucket`` vectors is split by further planes until none is larger, so no task holds more.
Within a bucket all are compared at once and each keeps its ``k`` nearest.  The trees' lists
are merged, and neighbours of neighbours are tried a few times, which finds most of what the
planes have parted.

Equal vectors are one point with several ids, so copies neither fill buckets nor crowd out
other neighbours.  What planes cannot split in ``DEEPEST`` steps is dealt by hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papervein.operators.checkpoints import cut_lineage, written
from papervein.operators.joins import first_rows

# Planes a tree can cut by; a step of a split uses this many.
DEEPEST, STEP = 40, 6
EDGES = "id long, neighbour long, similarity double"


def points(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(id, v)`` of distinct vectors scaled to length 1, and ``(member, id)`` of all.

    Null, empty and zero vectors, and those with a null, NaN or infinite part, have no point.
    """
    # Generated columns: the expressions behind the vector and its length are evaluated once.
    v = F.col("vector").cast("array<double>")
    given = vectors.select(F.col("id").cast("long").alias("member"), F.inline(F.array(F.struct(v.alias("vector")))))
    squares = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x)
    measured = given.select("member", "vector", F.inline(F.array(F.struct(F.sqrt(squares).alias("_length")))))
    usable = measured.where((F.col("_length") > 0) & ~F.isnan("_length") & (F.col("_length") < float("inf")))
    scaled = usable.select("member", F.transform("vector", lambda x: x / F.col("_length")).alias("v"))
    distinct = cut_lineage(scaled.groupBy("v").agg(F.min("member").alias("id")).select("id", "v"))
    return distinct, scaled.join(distinct.hint("merge"), "v").select("member", "id")


def _planes(width: int, trees: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).normal(size=(width, trees * DEEPEST))


def _sides(distinct: DataFrame, width: int, trees: int, seed: int) -> DataFrame:
    """``(tree, id, sides)``: on which side of each of a tree's planes a vector lies, as bits."""

    def sided(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes, powers = _planes(width, trees, seed), 1 << np.arange(DEEPEST, dtype=np.int64)
        for batch in batches:
            ids = batch.column(0)
            matrix = _matrix(batch.column(1), width)
            bits = (matrix @ planes > 0).reshape(len(ids), trees, DEEPEST) @ powers
            for tree in range(trees):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(ids), tree)), ids, pa.array(bits[:, tree])], names=["tree", "id", "sides"]
                )

    return distinct.select("id", "v").mapInArrow(sided, "tree long, id long, sides long")


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def buckets(sides: DataFrame, count: int, bucket: int) -> DataFrame:
    """``(group, id)``: every vector once a tree, in a group of at most about ``bucket``."""
    first = max(0, int(np.ceil(np.log2(max(1, count / bucket)))))
    done, rest, depth = None, sides, min(first, DEEPEST)
    while True:
        prefix = F.col("sides").bitwiseAND(F.lit((1 << depth) - 1))
        dealt = rest.withColumn("_group", F.xxhash64("tree", F.lit(depth), prefix))
        sizes = dealt.groupBy("_group").agg(F.count(F.lit(1)).alias("_n"))
        dealt = written(dealt.join(sizes, "_group"))
        small = dealt.where(F.col("_n") <= bucket).select(F.col("_group").alias("group"), "id")
        large = dealt.where(F.col("_n") > bucket)
        if large.isEmpty():
            return small if done is None else done.union(small)
        if depth >= DEEPEST:
            parts = F.ceil(F.col("_n") / bucket)
            hashed = large.select(F.xxhash64("_group", F.pmod(F.xxhash64("id", "_group"), parts)).alias("group"), "id")
            return small.union(hashed) if done is None else done.union(small).union(hashed)
        done = small if done is None else done.union(small)
        rest, depth = large.select("tree", "id", "sides"), min(depth + STEP, DEEPEST)


def _nearest_in_buckets(grouped: DataFrame, distinct: DataFrame, width: int, k: int) -> DataFrame:
    def compared(rows: pd.DataFrame) -> pd.DataFrame:
        ids, matrix = rows["id"].to_numpy(), np.stack(rows["v"].to_numpy())
        alike = matrix @ matrix.T
        np.fill_diagonal(alike, -np.inf)
        kept = min(k, len(ids) - 1)
        best = np.argpartition(-alike, kept - 1, axis=1)[:, :kept] if kept else np.empty((len(ids), 0), int)
        return pd.DataFrame({
            "id": np.repeat(ids, kept), "neighbour": ids[best].ravel(),
            "similarity": np.take_along_axis(alike, best, 1).ravel(),
        })

    return grouped.join(distinct.hint("merge"), "id").groupBy("group").applyInPandas(compared, EDGES)


def _best(edges: DataFrame, k: int) -> DataFrame:
    """The k nearest of every id; ties by the smaller neighbour."""
    once = edges.groupBy("id", "neighbour").agg(F.max("similarity").alias("similarity"))
    return first_rows(once, "id", k, F.desc("similarity"), F.asc("neighbour"))


def _further(edges: DataFrame, distinct: DataFrame, width: int) -> DataFrame:
    """Edges to neighbours of neighbours that are not neighbours yet."""
    via = edges.select(F.col("id").alias("neighbour"), F.col("neighbour").alias("further"))
    back = edges.select(F.col("neighbour").alias("id"), F.col("id").alias("further"))
    steps = edges.select("id", "neighbour").join(via.hint("merge"), "neighbour").select("id", "further").union(back)
    known = edges.select("id", F.col("neighbour").alias("further"))
    fresh = steps.where("id <> further").distinct().join(known.hint("merge"), ["id", "further"], "left_anti")

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            alike = np.einsum("ij,ij->i", _matrix(batch.column(2), width), _matrix(batch.column(3), width))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(alike)], names=["id", "neighbour", "similarity"]
            )

    own = distinct.select("id", F.col("v").alias("_own"))
    other = distinct.select(F.col("id").alias("further"), F.col("v").alias("_other"))
    paired = fresh.join(own.hint("merge"), "id").join(other.hint("merge"), "further").select("id", "further", "_own", "_other")
    return paired.mapInArrow(measured, EDGES)


def nearest(
    distinct: DataFrame, k: int = 15, trees: int = 6, bucket: int = 256, rounds: int = 2, seed: int = 42
) -> DataFrame:
    """``(id, neighbour, similarity)``: about the k nearest of each of the distinct points.

    ``distinct`` comes from :func:`points`.
    """
    facts = distinct.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("width")).first()
    if not facts["n"]:
        return distinct.sparkSession.createDataFrame([], EDGES)
    width = facts["width"]
    grouped = buckets(cut_lineage(_sides(distinct, width, trees, seed)), facts["n"], bucket)
    edges = written(_best(_nearest_in_buckets(grouped, distinct, width, k), k))
    if facts["n"] <= bucket:  # one bucket held all: the edges are exact
        return edges
    for _ in range(rounds):
        edges = written(_best(edges.union(_further(edges, distinct, width)), k))
    return edges


def neighbour_graph(vectors: DataFrame, k: int = 15, **parameters: int) -> DataFrame:
    """``(id, point, rank, neighbour, similarity)`` of vectors ``(id, vector)``.

    ``point`` is the smallest id with the same vector, whose edges all its copies share;
    neighbours are points, too.
    """
    distinct, members = points(vectors)
    edges = nearest(distinct, k, **parameters)
    ranked = edges.groupBy("id").agg(F.sort_array(F.collect_list(F.struct(
        F.negative("similarity").alias("_far"), "neighbour"
    ))).alias("_all")).select("id", F.posexplode("_all").alias("rank", "_e"))
    named = members.join(ranked, "id").select(
        F.col("member").alias("id"), F.col("id").alias("point"), (F.col("rank") + 1).alias("rank"),
        F.col("_e.neighbour").alias("neighbour"), F.negative("_e._far").alias("similarity"),
    )
    return named
