"""Corpus assembly: canonical rows, publication years, corpus statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from papervein import config
from papervein.functions import text as tx
from papervein.operators.joins import sized

# Added to the ordinals of manual years, so that they come after every listed one.
MANUAL_AFTER = 1 << 62


def canonical_rows(pages: DataFrame, ingest_date: str) -> DataFrame:
    """One row per document from ``(source_path, pages ARRAY<STRING>)``.

    NULL pages mean the document could not be read: its text is NULL and the run goes on.
    The id is the hash of the path, so it is the same in every run.
    """
    return pages.select(
        F.md5("source_path").alias("doc_id"),
        "source_path",
        tx.clean_whitespace(F.array_join("pages", " ")).alias("text"),
        F.lit(config.SOURCE_TYPE).alias("source_type"),
        F.lit(config.TEXT_SOURCE).alias("text_source"),
        F.lit(config.ORIGIN).alias("origin"),
        F.lit(None).cast("string").alias("title"),
        F.lit(None).cast("string").alias("doi"),
        F.to_date(F.lit(ingest_date)).alias("ingest_date"),
    )


def year_table(bibliography: DataFrame, manual: DataFrame) -> DataFrame:
    """``(stem, year)``: one year per file name without its extension.

    ``bibliography(ordinal, attachment, year)`` rows need both values;
    ``manual(ordinal, filename, year)`` overrides it; in each, the last row wins.
    """
    listed = bibliography.dropna(subset=["attachment", "year"]).select(
        tx.stem(tx.basename(F.col("attachment"))).alias("stem"),
        F.col("ordinal").cast("long").alias("at"),
        _whole_year(F.col("year")).alias("year"),
    )
    corrected = manual.select(
        tx.stem(F.col("filename")).alias("stem"),
        (F.col("ordinal").cast("long") + F.lit(MANUAL_AFTER)).alias("at"),
        _whole_year(F.col("year")).alias("year"),
    )
    rows = listed.unionByName(corrected)
    return rows.groupBy("stem").agg(F.max_by("year", "at").alias("year"))


def _whole_year(year: Column) -> Column:
    """The year as a whole number; NULL for what is no number, not finite, or out of range."""
    number = year.cast("string").try_cast("double")
    return F.when(F.abs(number) < 1e9, F.floor(number)).cast("int")


def attach_year(documents: DataFrame, years: DataFrame) -> DataFrame:
    """Left join on the file name without extension; no entry gives a NULL year.

    Pass described documents: texts would be shuffled with a year table too large to broadcast.
    """
    named = documents.withColumn("filename", tx.basename(F.col("source_path")))
    stemmed = named.withColumn("stem", tx.stem(F.col("filename")))
    return stemmed.join(sized(years), "stem", "left").drop("stem")


def described(documents: DataFrame) -> DataFrame:
    """Everything about a document but its text: what joins and reports work on."""
    return documents.select(
        "doc_id", "source_path",
        F.col("text").isNotNull().alias("extracted"),
        tx.word_count(F.col("text")).alias("token_count"),
    )


def missing_years(documents: DataFrame) -> DataFrame:
    return documents.where(F.col("year").isNull()).select("filename")


def ingest_summary(documents: DataFrame) -> DataFrame:
    """Counts over described documents with their years."""
    return documents.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("extracted").alias("extracted"),
        F.count_if(~F.col("extracted")).alias("failed"),
        F.count_if(F.col("year").isNull()).alias("missing_years"),
    )


def bibliography_gaps(documents: DataFrame, bibliography: DataFrame) -> DataFrame:
    """Files without a bibliography entry, and entries without a file, extensions aside."""
    listed = bibliography.where(F.col("attachment").isNotNull())
    files, entries = (
        table.select(tx.basename(F.col(path)).alias("filename")).distinct()
        .withColumn("stem", tx.stem(F.col("filename")))
        for table, path in ((documents, "source_path"), (listed, "attachment"))
    )
    unlisted = files.join(entries, "stem", "left_anti")
    absent = entries.join(files, "stem", "left_anti")
    return unlisted.select("filename", F.lit("not_in_bibliography").alias("gap")).unionByName(
        absent.select("filename", F.lit("file_absent").alias("gap"))
    )


def token_counts(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", tx.word_count(F.col("text")).alias("token_count"))


def token_summary(counts: DataFrame) -> DataFrame:
    return counts.agg(
        F.sum("token_count").alias("total_tokens"),
        F.round(F.avg("token_count"), 6).alias("mean_tokens"),
        F.min("token_count").alias("min_tokens"),
        F.max("token_count").alias("max_tokens"),
    )
