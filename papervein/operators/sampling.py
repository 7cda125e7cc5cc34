"""Reproducible samples for scoring by hand, and the precision scored from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from papervein.config import Config
from papervein.operators.joins import first_rows

SAMPLE_COLUMNS = ("doc_id", "entity_text", "label", "context", "start_char", "end_char")
SCOPE_COLUMNS = (
    "group", "entity_text", "label", "scope_tag", "context", "start_char", "end_char",
)


def sample_order(seed: int) -> list[Column]:
    """A fixed pseudo-random order of mentions that does not depend on partitioning."""
    key = F.concat_ws("|", F.lit(str(seed)), F.col("doc_id"), F.col("start_char"))
    return [F.md5(key), F.col("doc_id"), F.col("start_char")]


def stratified(entities: DataFrame, cfg: Config, per_label: int = 25) -> DataFrame:
    """At most ``per_label`` mentions of each domain label."""
    known = entities.where(F.col("label").isin(*cfg.domain_labels))
    picked = first_rows(known, "label", per_label, *sample_order(cfg.seed))
    return picked.select(*[c for c in SAMPLE_COLUMNS if c in entities.columns])


def scope_groups(entities: DataFrame, cfg: Config, per_group: int = 30) -> DataFrame:
    """Unspecified against resolved scopes, with an empty column to annotate."""
    group = F.when(F.col("scope_tag") == "UNSPECIFIED", "UNSPECIFIED").otherwise("RESOLVED")
    tagged = entities.where(F.col("scope_tag").isNotNull()).withColumn("group", group)
    picked = first_rows(tagged, "group", per_group, *sample_order(cfg.seed))
    kept = [c for c in SCOPE_COLUMNS if c in picked.columns]
    return picked.select(*kept, F.lit(None).cast("string").alias("table_or_prose"))


def precision(annotated: DataFrame, *by: str) -> DataFrame:
    """Share of Y among the rows marked Y or N; other marks are counted apart."""
    counts = annotated.groupBy(*by).agg(
        F.count_if(F.col("mark") == "Y").alias("correct"),
        F.count_if(F.col("mark") == "N").alias("wrong"),
        F.count_if(~F.coalesce(F.col("mark"), F.lit("")).isin("Y", "N")).alias("not_scored"),
    )
    share = F.try_divide(F.col("correct"), F.col("correct") + F.col("wrong"))
    return counts.withColumn("precision", F.round(share, 6))


def label_samples(entities: DataFrame, n: int = 2) -> DataFrame:
    """The first n mentions of each label, in document order."""
    picked = first_rows(entities, "label", n, F.col("doc_id"), F.col("start_char"))
    return picked.select("doc_id", "start_char", "label", "entity_text", "canonical_form")


def unit_preview(chunks: DataFrame, n: int = 2) -> DataFrame:
    """The first n chunks in document order."""
    return chunks.orderBy("doc_id", "chunk_start").limit(n).select("unit_id", "text")


def price_preview(grades: DataFrame, n: int = 5) -> DataFrame:
    """The first n distinct grades with thickness and price."""
    return grades.orderBy("entity_text").limit(n)


def sensitivity_preview(table: DataFrame, n: int = 10) -> DataFrame:
    """The first n grades of the sensitivity table."""
    return table.orderBy("entity_text").limit(n)


def value_preview(normalised: DataFrame, n: int = 10) -> DataFrame:
    valued = normalised.where(F.col("value_numeric").isNotNull())
    ordered = valued.orderBy("doc_id", "start_char").limit(n)
    return ordered.select("doc_id", "start_char", "entity_text", "label", "value_numeric", "unit")
