"""Values, units, properties and names of mentions in one normal form."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from papervein import config
from papervein.config import Config
from papervein.functions import values as vx
from papervein.operators.joins import literal_table


def default_aliases(spark: SparkSession) -> DataFrame:
    """``(label, surface, canonical)``, surfaces in lower case and unique per label."""
    rows = [("COMPETING_MATERIAL", *pair) for pair in config.COMPETITOR_ALIASES.items()]
    rows += [("APPLICATION", *pair) for pair in config.APPLICATION_ALIASES.items()]
    return literal_table(spark, "label STRING,surface STRING,canonical STRING", rows)


def default_bounds(spark: SparkSession) -> DataFrame:
    """``(resolved_property, low, high)``, both ends allowed."""
    rows = [(name, *bounds) for name, bounds in config.PROPERTY_BOUNDS.items()]
    return literal_table(spark, "resolved_property STRING,low DOUBLE,high DOUBLE", rows)


def domain_mentions(entities: DataFrame, cfg: Config) -> DataFrame:
    return entities.where(F.col("label").isin(*cfg.domain_labels))


def with_values(entities: DataFrame, cfg: Config) -> DataFrame:
    """Append ``value_numeric``, ``unit`` and ``canonical_form``."""
    text, label = F.col("entity_text"), F.col("label")
    valued = entities.withColumn("value_numeric", vx.numeric_value(text, label, cfg.units))
    united = valued.withColumn("unit", vx.unit(text, label, F.col("value_numeric"), cfg.units))
    return united.withColumn(
        "canonical_form", vx.canonical_form(text, F.col("value_numeric"), F.col("unit"))
    )


def with_property(entities: DataFrame) -> DataFrame:
    return entities.withColumn(
        "resolved_property", vx.resolved_property(F.col("context"), F.col("label"))
    )


def with_review_flag(valued: DataFrame, bounds: DataFrame) -> DataFrame:
    """Flag values outside their property's bounds.

    Look-up tables carry no hint: Spark broadcasts them while their known size allows.
    """
    joined = valued.join(bounds, "resolved_property", "left")
    outside = ~F.col("value_numeric").between(F.col("low"), F.col("high"))
    return joined.withColumn("review_flag", F.when(outside, "out_of_range")).drop("low", "high")


def with_canonical_entity(entities: DataFrame, aliases: DataFrame) -> DataFrame:
    """Replace a known name by its canonical one; others stay as written."""
    named = aliases.select(
        F.col("label").alias("_label"), F.col("surface").alias("_surface"),
        F.col("canonical").alias("_canonical"),
    )
    matched = (F.col("label") == F.col("_label")) & (
        vx.surface_key(F.col("entity_text")) == F.col("_surface")
    )
    return (
        entities.join(named, matched, "left")
        .withColumn("canonical_entity", F.coalesce("_canonical", "entity_text"))
        .drop("_label", "_surface", "_canonical")
    )


def with_subtype(entities: DataFrame, cfg: Config) -> DataFrame:
    return entities.withColumn(
        "subtype", vx.subtype(F.col("canonical_entity"), F.col("label"), cfg.component_terms)
    )


def normalise(entities: DataFrame, cfg: Config, aliases: DataFrame, bounds: DataFrame) -> DataFrame:
    """The whole chain: domain labels, values, property, flag, names, subtype."""
    valued = with_property(with_values(domain_mentions(entities, cfg), cfg))
    named = with_canonical_entity(with_review_flag(valued, bounds), aliases)
    return with_subtype(named, cfg).select(
        *entities.columns, "value_numeric", "unit", "canonical_form", "resolved_property",
        "review_flag", "canonical_entity", "subtype",
    )


def alias_pairs(normalised: DataFrame) -> DataFrame:
    named = normalised.where(F.col("label").isin("COMPETING_MATERIAL", "APPLICATION"))
    return named.select("label", "entity_text", "canonical_entity").distinct()


def subtype_members(normalised: DataFrame) -> DataFrame:
    applications = normalised.where(F.col("label") == "APPLICATION")
    return applications.select("subtype", "canonical_entity").distinct()
