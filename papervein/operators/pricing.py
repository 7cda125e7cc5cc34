"""From grade mentions to sheet thickness, relative prices and their sensitivity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from papervein import config
from papervein.config import Config
from papervein.functions import prices as px
from papervein.operators.joins import literal_table

BRIDGE_COLUMNS = (
    "doc_id", "entity_text", "label", "value_numeric", "unit", "scope_tag",
    "resolved_property", "cost_role", "thickness_mm", "relative_price_eur_kg",
)


def default_roles(spark: SparkSession) -> DataFrame:
    return literal_table(spark, "label STRING,cost_role STRING", list(config.COST_ROLES.items()))


def cost_bridge(
    mentions: DataFrame, roles: DataFrame, cfg: Config, keep: Sequence[str] = ()
) -> DataFrame:
    """Mentions with a role in a cost model; grades get a thickness and a price.

    The ten bridge columns as far as the mentions have them, and any others to ``keep``.
    """
    with_role = mentions.join(roles, "label")
    priced = F.col("label").isin(*cfg.priced_labels)
    thick = with_role.withColumn(
        "thickness_mm", F.when(priced, px.thickness_mm(F.col("entity_text")))
    )
    bridge = thick.withColumn(
        "relative_price_eur_kg", px.relative_price(F.col("thickness_mm"), cfg.price_constant)
    )
    return bridge.select(*[c for c in (*BRIDGE_COLUMNS, *keep) if c in bridge.columns])


def parsed(bridge: DataFrame) -> DataFrame:
    return bridge.where(F.col("thickness_mm").isNotNull())


def role_counts(bridge: DataFrame) -> DataFrame:
    return bridge.groupBy("cost_role").agg(F.count(F.lit(1)).alias("n"))


def thickness_recall(bridge: DataFrame, cfg: Config) -> DataFrame:
    grades = bridge.where(F.col("label").isin(*cfg.priced_labels))
    counts = grades.agg(
        F.count("thickness_mm").alias("parsed"), F.count(F.lit(1)).alias("total")
    )
    return counts.withColumn("recall", F.round(F.try_divide("parsed", "total"), 6))


def unparsed_grades(bridge: DataFrame, cfg: Config) -> DataFrame:
    grades = bridge.where(F.col("label").isin(*cfg.priced_labels) & F.col("thickness_mm").isNull())
    return grades.select("entity_text").distinct()


def grade_prices(bridge: DataFrame) -> DataFrame:
    """Distinct parsed grades, thinnest first."""
    distinct = parsed(bridge).select("entity_text", "thickness_mm", "relative_price_eur_kg").distinct()
    return distinct.orderBy("thickness_mm", "entity_text")


def thickness_groups(bridge: DataFrame) -> DataFrame:
    """Per thickness: mentions, the first one as an example, the price."""
    return parsed(bridge).groupBy("thickness_mm").agg(
        F.count(F.lit(1)).alias("n_grades"),
        F.min_by("entity_text", F.struct("doc_id", "start_char")).alias("example"),
        F.min("relative_price_eur_kg").alias("price"),
    )


def thickness_histogram(bridge: DataFrame) -> DataFrame:
    counts = parsed(bridge).groupBy("thickness_mm").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy("thickness_mm")


def price_stats(bridge: DataFrame) -> DataFrame:
    """Statistics over all parsed mentions, from one row per thickness and its weight.

    A name gives two digits of thickness, so at most a hundred rows meet in the last step.
    """
    price, n = F.col("price"), F.col("n")
    weighted = parsed(bridge).groupBy("thickness_mm").agg(
        F.count(F.lit(1)).alias("n"), F.min("relative_price_eur_kg").alias("price")
    )
    sums = weighted.agg(
        F.sum("n").alias("n"),
        F.count("thickness_mm").alias("n_thickness"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        F.sum(F.when(price.isNotNull(), n)).alias("_n"),
        F.sum(price * n).alias("_sum"),
        F.percentile("price", 0.5, n).alias("median_price"),
        F.collect_list(F.when(price.isNotNull(), F.struct("price", "n"))).alias("_each"),
    ).withColumn("_mean", F.try_divide("_sum", "_n"))
    squares = F.aggregate(
        "_each",
        F.lit(0.0),
        lambda total, x: total + x["n"] * F.pow(x["price"] - F.col("_mean"), F.lit(2)),
    )
    return sums.select(
        "n", "n_thickness", "min_price", "max_price",
        F.round("_mean", 6).alias("mean_price"),
        F.round("median_price", 6).alias("median_price"),
        F.round(F.sqrt(F.try_divide(squares, F.col("_n") - 1)), 6).alias("std_price"),
    )


def price_curve(bridge: DataFrame, cfg: Config, points: int = 200) -> DataFrame:
    """The price law at evenly spaced thicknesses around the parsed range."""
    ends = parsed(bridge).agg(
        (F.min("thickness_mm") * 0.9).alias("low"), (F.max("thickness_mm") * 1.1).alias("high")
    )
    step = (F.col("high") - F.col("low")) / F.lit(float(points - 1))
    steps = ends.where(F.col("low").isNotNull()).select(
        "low", "high", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point")
    )
    placed = steps.select("point", (F.col("low") + F.col("point") * step).alias("thickness_mm"))
    return placed.withColumn("price", F.lit(cfg.price_constant) / F.col("thickness_mm"))


def price_sensitivity(
    bridge: DataFrame, cfg: Config, deltas: Sequence[tuple[str, float]] = (("plus10", 1.10), ("minus10", 0.90))
) -> DataFrame:
    """Price of each distinct grade, and its change if the thickness is off by a factor."""
    table = parsed(bridge).select("entity_text", "thickness_mm").distinct()
    table = table.withColumn("price_baseline", F.lit(cfg.price_constant) / F.col("thickness_mm"))
    for name, factor in deltas:
        table = table.withColumn(f"thick_{name}", F.col("thickness_mm") * F.lit(factor))
        table = table.withColumn(f"price_{name}", F.lit(cfg.price_constant) / F.col(f"thick_{name}"))
        table = table.withColumn(
            f"pct_change_{name}", (F.col(f"price_{name}") / F.col("price_baseline") - 1) * 100
        )
    return table
