"""Topics of varying density: a minimum spanning forest of the neighbour table, cut where an
edge is long for its surroundings.

Edges weigh as much as the distance at which both ends are dense: the greater of their
distance and of each end's distance to its ``min_points``-th neighbour.  The forest is found
in Boruvka's rounds: every component takes its cheapest edge to another one, and what is
joined becomes one component, so rounds grow with the logarithm of the points.  Tables of all
points or edges are joined by merging, so the driver holds none of them.

An edge is cut if it is more than ``factor`` times as long as the forest's edges within two
steps of it, on both of its sides (Zahn, 1971).  The measure is taken from the place itself,
so a dense group and a sparse one come apart by the same rule.  Parts of fewer than
``min_topic_size`` points are noise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from papervein.operators.checkpoints import written
from papervein.operators.density import NOISE, components
from papervein.operators.joins import numbered_rows

# Weights are rounded, so that no order hangs on the last bits of a sum.
DIGITS = 9


def mutual_edges(edges: DataFrame, min_points: int = 5) -> DataFrame:
    """``(u, v, w)`` with u < v, once each, of ``(id, neighbour, similarity)`` between unit vectors."""
    far = F.sqrt(F.greatest(F.lit(0.0), 2.0 - 2.0 * F.col("similarity")))
    apart = edges.select("id", "neighbour", F.round(far, DIGITS).alias("d"))
    nearest = F.row_number().over(Window.partitionBy("id").orderBy("d", "neighbour"))
    dense = apart.withColumn("_r", nearest).where(F.col("_r") <= min_points).groupBy("id").agg(F.max("d").alias("core"))
    ends = apart.join(dense.hint("merge"), "id").join(
        dense.select(F.col("id").alias("neighbour"), F.col("core").alias("_other")).hint("merge"), "neighbour", "left"
    )
    weighed = ends.select(
        F.least("id", "neighbour").alias("u"), F.greatest("id", "neighbour").alias("v"),
        F.greatest("d", "core", F.coalesce("_other", "core")).alias("w"),
    )
    return weighed.groupBy("u", "v").agg(F.min("w").alias("w"))


def minimum_forest(edges: DataFrame) -> DataFrame:
    """The edges ``(u, v, w)`` of the minimum spanning forest; equal weights in order of the ends."""
    current = written(edges.where("u <> v").select("u", "v", "w", F.col("u").alias("a"), F.col("v").alias("b")))
    forest = None
    while True:
        out = current.select(F.col("a").alias("c"), F.struct("w", "u", "v", F.col("b").alias("other")).alias("e")).union(
            current.select(F.col("b").alias("c"), F.struct("w", "u", "v", F.col("a").alias("other")).alias("e"))
        )
        best = written(out.groupBy("c").agg(F.min("e").alias("e")))
        chosen = best.select("e.u", "e.v", "e.w").distinct()
        forest = written(chosen if forest is None else forest.union(chosen))
        links = best.select(F.col("c").alias("a"), F.col("e.other").alias("b"))
        merged = written(components(best.select(F.col("c").alias("id")), links.union(links.select("b", "a"))))
        first = merged.select(F.col("id").alias("a"), F.col("component").alias("_a"))
        second = merged.select(F.col("id").alias("b"), F.col("component").alias("_b"))
        current = written(
            current.join(first.hint("merge"), "a").join(second.hint("merge"), "b").where("_a <> _b")
            .select("u", "v", "w", F.col("_a").alias("a"), F.col("_b").alias("b"))
        )
        if current.isEmpty():
            return forest


def kept_edges(forest: DataFrame, factor: float) -> DataFrame:
    """The forest's edges that are not long for their surroundings."""
    both = forest.select(F.col("u").alias("x"), F.col("v").alias("y"), "w").union(forest.select("v", "u", "w"))
    around = written(both.groupBy("x").agg(F.sum("w").alias("sum"), F.count(F.lit(1)).alias("n")))
    other = around.select(F.col("x").alias("y"), F.col("sum").alias("_s"), F.col("n").alias("_n"))
    # What lies one step further, through each neighbour, without the edge that leads there.
    further = both.join(other.hint("merge"), "y").groupBy("x").agg(
        F.sum(F.col("_s") - F.col("w")).alias("far_sum"), F.sum(F.col("_n") - 1).alias("far_n")
    )
    near = written(around.join(further.hint("merge"), "x"))
    u = near.select(*[F.col(c).alias(a) for c, a in zip(near.columns, ("u", "u_sum", "u_n", "u_far", "u_far_n"))])
    v = near.select(*[F.col(c).alias(a) for c, a in zip(near.columns, ("v", "v_sum", "v_n", "v_far", "v_far_n"))])
    # A side without the edge itself and without what lies beyond it.
    u_scale = F.try_divide(F.col("u_sum") + F.col("u_far") - F.col("v_sum"), F.col("u_n") + F.col("u_far_n") - F.col("v_n"))
    v_scale = F.try_divide(F.col("v_sum") + F.col("v_far") - F.col("u_sum"), F.col("v_n") + F.col("v_far_n") - F.col("u_n"))
    measured = forest.join(u.hint("merge"), "u").join(v.hint("merge"), "v").withColumn("scale", F.greatest(u_scale, v_scale))
    return measured.where(F.col("scale").isNull() | (F.col("w") <= factor * F.col("scale"))).select("u", "v", "w")


def topics(points: DataFrame, edges: DataFrame, min_points: int = 5, factor: float = 2.0, min_topic_size: int = 10) -> DataFrame:
    """``(id, topic)`` of ``points (id)`` from their neighbours; noise is -1.

    Topics are numbered by size, then by their smallest id.
    """
    forest = minimum_forest(mutual_edges(edges, min_points))
    return cut_topics(points, forest, factor, min_topic_size)


def cut_topics(points: DataFrame, forest: DataFrame, factor: float, min_topic_size: int) -> DataFrame:
    kept = kept_edges(forest, factor)
    links = kept.select(F.col("u").alias("a"), F.col("v").alias("b"))
    placed = components(points.select("id"), links.union(links.select("b", "a")))
    sizes = placed.groupBy("component").agg(F.count(F.lit(1)).alias("n"))
    numbered = numbered_rows(sizes.where(F.col("n") >= min_topic_size), "topic", F.desc("n"), F.asc("component"))
    topic = F.coalesce(F.col("topic").cast("int"), F.lit(NOISE))
    return placed.join(numbered.select("component", "topic"), "component", "left").select("id", topic.alias("topic"))
