"""Inputs of the registered queries, derived from the given tables."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from papervein.config import Config
from papervein.functions import text as tx
from papervein.operators import topics
from papervein.operators.joins import literal_table, spread
from papervein.operators.units import chunk_units
from papervein.plans import fixtures

INGEST_DATE = "2026-01-01"
RADIUS = 0.3
MIN_POINTS = 8
NEIGHBOURS, CORE_NEIGHBOURS, CUT_FACTOR = 15, 5, 1.2
BUCKET = 1024  # a table of at most so many vectors is compared in full, so its neighbours are exact


SCHEMAS = {
    "pages": "page_id LONG, url STRING, html STRING",
    "documents": "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG",
    "embeddings": "vec_id LONG, embedding ARRAY<FLOAT>, label INT",
    "labels": "doc_id LONG, quality INT, toxic INT",
    "benchmark": "item_id LONG, text STRING",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spread(table(spark, folder, "documents"))


def lexicon(spark: SparkSession) -> DataFrame:
    return literal_table(spark, "label STRING,term STRING", fixtures.LEXICON)


def _pick(sentences: tuple[str, ...]) -> F.Column:
    position = (F.col("doc_id") % len(sentences) + 1).cast("int")
    return F.element_at(F.array(*[F.lit(s) for s in sentences]), position)


def _measured_table() -> F.Column:
    """A table run together, as extraction leaves them: no full stops, line breaks inside,
    units with and without a space, numbers that differ from document to document."""
    n = F.col("doc_id")

    def number(low: int, range_: int) -> F.Column:
        return (F.lit(low) + n % range_).cast("string")

    return F.concat(
        F.lit("Sheet strength "), number(10, 85), F.lit("MPa\n"), number(180, 700), F.lit("MPa |\t"),
        number(200, 500), F.lit("\nMPa loss "), number(1, 97), F.lit("W/kg "), number(2, 7), F.lit("."), number(0, 10),
        F.lit(" W/kg at 1."), number(0, 10), F.lit("T and 15T code 50A"), number(210, 790), F.lit("\n"),
        number(0, 7), F.lit("."), number(0, 10), F.lit(" % Si"),
    )


def literature(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's whole text with four subject sentences, a table and a year."""
    text = F.concat_ws(
        " ", "text", _pick(fixtures.GRADE_SENTENCES), _pick(fixtures.USE_SENTENCES),
        _pick(fixtures.STRENGTH_SENTENCES), _pick(fixtures.SUBJECT_SENTENCES), _measured_table(),
    )
    year = F.when(F.col("lang") != "es", (F.lit(1985) + F.col("doc_id") % 41).cast("int"))
    return documents(spark, folder).select(
        "doc_id", _path().alias("source_path"), year.alias("year"),
        tx.clean_whitespace(text).alias("text"),
    )


def abbreviated_literature(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's whole text between sentences with abbreviations."""
    text = F.concat_ws(" ", _pick(fixtures.ABBREVIATED_SENTENCES), "text", _pick(fixtures.ABBREVIATED_SENTENCES[1:]))
    return documents(spark, folder).select("doc_id", tx.clean_whitespace(text).alias("text"))


def line_heads(spark: SparkSession, folder: str) -> DataFrame:
    """A long list of terms: the first word, and the first two, of every line there is."""
    lines = documents(spark, folder).select(F.explode(F.split("text", "\n", -1)).alias("_line"))
    heads = lines.select(F.explode(F.array(
        F.regexp_extract("_line", "^([^ ]+)", 1), F.regexp_extract("_line", "^([^ ]+ [^ ]+)", 1)
    )).alias("term"))
    return heads.where(F.trim("term") != "").distinct()


def mixed_literature(spark: SparkSession, folder: str) -> DataFrame:
    """Literature in which every fifth document has its own text only."""
    plain = documents(spark, folder).where(F.col("doc_id") % 5 == 0).select(
        "doc_id", tx.clean_whitespace(F.col("text")).alias("text")
    )
    return literature(spark, folder).where(F.col("doc_id") % 5 != 0).select("doc_id", "text").unionByName(plain)


def _path(extension: F.Column | None = None) -> F.Column:
    """A name as people give them, with spaces and signs."""
    return F.concat(
        F.lit("/corpus/"), F.col("source"), F.lit("/"), F.col("doc_id").cast("string"),
        F.lit(" - 50% a+b"), F.lit(".txt") if extension is None else extension,
    )


def _attachment() -> F.Column:
    return _path(F.when(F.col("doc_id") % 2 == 0, ".pdf").otherwise(".txt"))


def raw_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as page lists, one page per line, and a file that could not be read for
    every benchmark item."""
    read = documents(spark, folder).select(
        _path().alias("source_path"), F.split("text", "\n", -1).alias("pages")
    )
    unread = table(spark, folder, "benchmark").select(
        F.concat(F.lit("/corpus/unread/u"), F.col("item_id").cast("string"), F.lit(".txt")).alias("source_path"),
        F.lit(None).cast("array<string>").alias("pages"),
    )
    return read.unionByName(unread)


def page_files(spark: SparkSession, folder: str) -> DataFrame:
    """Raw pages as files, and an empty one for every labelled toxic document."""
    files = table(spark, folder, "pages").select(
        F.concat(F.lit("/web/"), "page_id", F.lit(".html")).alias("source_path"), F.encode("html", "UTF-8").alias("content")
    )
    empty = table(spark, folder, "labels").where("toxic = 1").select(
        F.concat(F.lit("/web/none/"), "doc_id", F.lit(".html")).alias("source_path"), F.lit(None).cast("binary").alias("content")
    )
    return files.unionByName(empty)


def paragraphs(content: bytes) -> list[str]:
    """A decoder of web pages: the beginnings of the paragraphs, of pages that end as they should."""
    text = content.decode()
    if not text.endswith("</html>"):
        raise ValueError("the page is cut off")
    return re.findall("<p>([^<]*)", text)


def bibliography(spark: SparkSession, folder: str) -> DataFrame:
    """Two rows per labelled document, the later one with another year or none."""
    known = table(spark, folder, "documents").select("doc_id", "source").join(
        table(spark, folder, "labels"), "doc_id"
    )
    first = known.select(
        F.col("doc_id").alias("ordinal"), _attachment().alias("attachment"),
        F.format_string("%d.0", F.lit(1985) + F.col("doc_id") % 41).alias("year"),
    )
    later = known.select(
        (F.col("doc_id") + 1_000_000_000).alias("ordinal"), _attachment().alias("attachment"),
        F.when(F.col("quality") == 1, F.format_string("%d", F.lit(1986) + F.col("doc_id") % 41)).alias("year"),
    )
    absent = table(spark, folder, "benchmark").select(
        F.col("item_id").alias("ordinal"),
        F.concat(F.lit("/corpus/bench/b"), F.col("item_id").cast("string"), F.lit(".txt")).alias("attachment"),
        F.lit("2001").alias("year"),
    )
    return first.unionByName(later).unionByName(absent)


def manual_years(spark: SparkSession, folder: str) -> DataFrame:
    toxic = table(spark, folder, "labels").where("toxic = 1")
    return toxic.select(
        F.col("doc_id").alias("ordinal"),
        F.concat(F.col("doc_id").cast("string"), F.lit(" - 50% a+b.PDF")).alias("filename"),
        F.format_string("%d", F.lit(1990) + F.col("doc_id") % 30).alias("year"),
    )


def lexicon_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Every line of every document, as if its source were a lexicon file."""
    return documents(spark, folder).select(
        F.concat("source", F.lit(".txt")).alias("file"),
        F.explode(F.split("text", "\n", -1)).alias("line"),
    )


def line_file_labels(spark: SparkSession) -> DataFrame:
    rows = [(f"src{i}.txt", label) for i, label in enumerate(
        ("APPLICATION", "COMPETING_MATERIAL", "PRODUCER", "PROCESSING", "STANDARD")
    )]
    return literal_table(spark, "file STRING,label STRING", rows)


def assigned_topics(spark: SparkSession, folder: str, cfg: Config) -> DataFrame:
    """Chunks of the documents with a given topic from -1 (noise) to 9."""
    texts = documents(spark, folder).select("doc_id", tx.clean_whitespace(F.col("text")).alias("text"))
    number = (F.col("doc_id") + F.floor(F.col("chunk_start") / cfg.chunk_chars)) % 11 - 1
    return chunk_units(texts, cfg).withColumn("topic", number.cast("int"))


def planted_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Embeddings pushed towards the axis of their label, one in ten left as noise."""
    planted = F.col("vec_id") % 10 != 0
    pushed = F.transform(
        "embedding",
        lambda x, i: x.cast("double") + F.when(planted & (i == F.col("label")), 2.0).otherwise(0.0),
    )
    rows = table(spark, folder, "embeddings").select("vec_id", "label", pushed.alias("_pushed"))
    return rows.select("vec_id", "label", topics.normalise_vector(F.col("_pushed")).alias("vector"))


def hashed_vectors(spark: SparkSession, folder: str, cfg: Config) -> DataFrame:
    sums = topics.signed_sums(F.col("vector"), 64, cfg.reduced_dims)
    return planted_vectors(spark, folder).withColumn("position", F.array(*sums))
