"""Counts of categories over fixed-width periods."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from papervein.config import Config
from papervein.functions import periods as px

MODES = ("docs", "mentions")


def with_period(rows: DataFrame, documents: DataFrame, cfg: Config) -> DataFrame:
    """Add year, bucket and label; rows of documents without a year are dropped."""
    years = documents.where(F.col("year").isNotNull()).select("doc_id", "year")
    return _add_period(rows.join(years, "doc_id"), cfg)


def _add_period(dated: DataFrame, cfg: Config) -> DataFrame:
    started = dated.withColumn("bucket", px.period_start(F.col("year"), cfg))
    return started.withColumn("bucket_label", px.period_label(F.col("bucket"), cfg))


def period_spine(spark: SparkSession, cfg: Config) -> DataFrame:
    """Every period of the run, in order, with the mark of an unfinished one."""
    starts = F.sequence(F.lit(cfg.start_year), F.lit(cfg.end_year), F.lit(cfg.period_years))
    spine = spark.range(1).select(F.explode(starts).alias("bucket"))
    return spine.select(
        "bucket",
        px.period_label(F.col("bucket"), cfg).alias("bucket_label"),
        px.is_partial(F.col("bucket"), cfg).alias("is_partial"),
    )


def documents_per_period(documents: DataFrame, cfg: Config) -> DataFrame:
    dated = _add_period(documents.where(F.col("year").isNotNull()), cfg)
    return dated.groupBy("bucket", "bucket_label").agg(F.count_distinct("doc_id").alias("n_docs"))


def prevalence_both(
    rows: DataFrame, documents: DataFrame, category: str, cfg: Config
) -> DataFrame:
    """``(bucket, bucket_label, <category>, docs, mentions)``: distinct documents, and rows.

    Rows are first counted per document and category, so what meets the year table and
    the final count is one row per pair, however often a document repeats itself.
    """
    pairs = rows.groupBy("doc_id", category).agg(F.count(F.lit(1)).alias("_rows"))
    dated = with_period(pairs, documents, cfg)
    return dated.groupBy("bucket", "bucket_label", category).agg(
        F.count(F.lit(1)).alias("docs"), F.sum("_rows").alias("mentions")
    )


def prevalence(
    rows: DataFrame, documents: DataFrame, category: str, cfg: Config, mode: str = "docs"
) -> DataFrame:
    """``(bucket, bucket_label, <category>, n)`` in one of the two modes."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    counts = prevalence_both(rows, documents, category, cfg)
    return counts.select("bucket", "bucket_label", category, F.col(mode).alias("n"))


def trend_matrix(counts: DataFrame, category: str, cfg: Config, value: str = "n") -> DataFrame:
    """One row per category, one column per period, 0 where nothing was counted.

    Periods off the spine are dropped; a category seen only there keeps a row of zeros.
    """
    wide = counts.groupBy(category).pivot("bucket_label", cfg.period_labels).agg(F.sum(value))
    return wide.na.fill(0, cfg.period_labels)


def period_matrix(
    counts: DataFrame, category: str, categories: Sequence[str], cfg: Config
) -> DataFrame:
    """One row per period of the spine, one column per given category, zeros filled in."""
    wide = counts.groupBy("bucket").pivot(category, list(categories)).agg(F.sum("n"))
    spine = period_spine(counts.sparkSession, cfg).select("bucket", "bucket_label")
    return spine.join(wide, "bucket", "left").na.fill(0, list(categories)).drop("bucket")


def top_categories(counts: DataFrame, category: str, cfg: Config, n: int) -> DataFrame:
    """Matrix rows of the n categories with the largest totals, ties by category."""
    matrix = trend_matrix(counts, category, cfg)
    total = sum((F.col(f"`{label}`") for label in cfg.period_labels), F.lit(0))
    ranked = matrix.withColumn("total", total.cast("long"))
    return ranked.orderBy(F.desc("total"), F.asc(category)).limit(n)


def period_shares(
    counts: DataFrame, per_period: DataFrame, category: str, cfg: Config
) -> DataFrame:
    """Share of each category in its period's total, and where its bar begins.

    Works on counts, so a window holds at most one row per category.
    """
    on_spine = counts.where(F.col("bucket_label").isin(cfg.period_labels))
    period = Window.partitionBy("bucket")
    below = period.orderBy(category).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = F.sum("n").over(period)
    share = F.col("n") / F.col("total") * 100
    stacked = on_spine.select(
        "bucket", "bucket_label", category, "n",
        total.alias("total"), (F.sum("n").over(below) - F.col("n")).alias("offset"),
    )
    return stacked.join(per_period.select("bucket", "n_docs"), "bucket", "left").select(
        "bucket_label", category, "n", "total", "offset", "n_docs",
        F.when(share >= 1, F.bround(share, 0).cast("int")).alias("pct"),
    )


def top_shares(
    counts: DataFrame, per_period: DataFrame, category: str, cfg: Config, n: int = 8
) -> DataFrame:
    """Shares of the n categories with the largest totals, among those n only."""
    best = top_categories(counts, category, cfg, n).select(category)
    return period_shares(counts.join(F.broadcast(best), category, "left_semi"), per_period, category, cfg)


def unitisation_comparison(
    rows: DataFrame, documents: DataFrame, category: str, cfg: Config
) -> DataFrame:
    """Documents and mentions per period side by side, one row per category."""
    counts = prevalence_both(rows, documents, category, cfg)
    wide = counts.groupBy(category).pivot("bucket_label", cfg.period_labels).agg(
        *[F.sum(mode).alias(mode) for mode in MODES]
    )
    names = [f"{label}_{mode}" for mode in MODES for label in cfg.period_labels]
    return wide.na.fill(0, names).select(category, *[F.col(f"`{name}`") for name in names])
