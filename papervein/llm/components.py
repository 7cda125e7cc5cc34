"""Connected components by alternating large and small stars.

Every round replaces edges by edges towards smaller ids; grouping is only ever by minimum,
so a hub costs no more than its number of edges, spread over tasks by the partial
aggregation.  The state is written to the shared folder after each round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papervein.llm.shared import Tables, gathered


def _large_star(edges: DataFrame) -> DataFrame:
    """Connect every larger neighbour of an id to the smallest id around it."""
    both = edges.union(edges.select("v", "u"))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Connect every smaller neighbour of an id, and the id, to the smallest of them.

    Dealt by the larger end once; the result may repeat edges, which the next round drops.
    """
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v")
    down = down.repartition("u").distinct()
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    joined = down.join(low, "u")
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", "m")).where("u > v")


def _stars(state: DataFrame, rows: int) -> bool:
    """Whether every edge ends at the root of a star, and no id has two."""
    ends = state.select("u", F.col("v").alias("low"), F.col("v").alias("high"), F.lit(False).alias("root"))
    roots = state.select(F.col("v").alias("u"), F.lit(None).alias("low"), F.lit(None).alias("high"), F.lit(True).alias("root"))
    around = ends.union(roots).groupBy("u").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.max("root").alias("root"))
    return gathered(around, 2 * rows).where("low IS NOT NULL AND (root OR low <> high)").isEmpty()


def connected(tables: Tables, edges: DataFrame) -> DataFrame:
    """(id, label): the smallest id of its component, for every id above the smallest.

    ``edges`` are pairs (u, v) of longs without nulls; loops and repeats do no harm.
    """
    edges = edges.select("u", "v").where("u <> v")
    rows = edges.count()
    state = tables.write(gathered(_small_star(edges), 2 * rows), "stars")
    while not _stars(state, 2 * rows):
        following = tables.write(gathered(_small_star(_large_star(state)), 2 * rows), "stars")
        tables.drop(state)
        state = following
    labels = tables.write(gathered(state.distinct(), rows).select(F.col("u").alias("id"), F.col("v").alias("label")), "labels")
    tables.drop(state)
    return labels
