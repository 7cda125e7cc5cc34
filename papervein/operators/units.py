"""Documents cut into the units that are clustered."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papervein.config import Config


def document_units(documents: DataFrame) -> DataFrame:
    texts = documents.where(F.col("text").isNotNull())
    return texts.select("doc_id", F.col("doc_id").cast("string").alias("unit_id"), "text")


def chunk_units(documents: DataFrame, cfg: Config) -> DataFrame:
    """Fixed-size chunks without overlap; one shorter than the minimum is dropped.

    One regular-expression pass cuts the text, so a document costs time linear in its
    length; taking each chunk by ``substring`` would count from the start every time.
    """
    size = cfg.chunk_chars
    cut = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
    chunks = documents.select(
        "doc_id", F.posexplode_outer(cut).alias("_pos", "text")
    )
    start = (F.col("_pos") * size).cast("long")
    return chunks.where(F.length("text") >= cfg.chunk_min_chars).select(
        "doc_id",
        start.alias("chunk_start"),
        F.concat(F.col("doc_id").cast("string"), F.lit("_chunk_"), start.cast("string")).alias("unit_id"),
        "text",
    )


def units(documents: DataFrame, cfg: Config) -> DataFrame:
    if cfg.cluster_unit == "document":
        return document_units(documents)
    if cfg.cluster_unit == "chunk":
        return chunk_units(documents, cfg).drop("chunk_start")
    raise ValueError(f"cluster_unit must be 'document' or 'chunk', not {cfg.cluster_unit!r}")


def unit_summary(unit_table: DataFrame) -> DataFrame:
    """Documents and units: counted per document first, so no document is held whole."""
    per_document = unit_table.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    return per_document.agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n").alias("n_units"))
