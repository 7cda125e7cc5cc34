"""Reading documents, page texts, bibliographies and lexicons, with declared schemas."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from papervein.config import LEXICON_FILES
from papervein.functions import text as tx
from papervein.operators.joins import literal_table

PAGE_BREAK = "\f"


def read_text_documents(spark: SparkSession, folder: str, glob: str = "*.txt") -> DataFrame:
    """``(source_path, pages)`` of a folder of extracted texts, pages parted by form feeds.

    Paths are as they are on disk.  A file that cannot be read (a damaged archive, say) has
    NULL pages; the others are read all the same.
    """
    named = spark.read.option("pathGlobFilter", glob)
    texts = named.option("ignoreCorruptFiles", True).text(folder, wholetext=True).select(
        file_path(F.col("_metadata.file_path")).alias("source_path"),
        F.split("value", PAGE_BREAK, -1).alias("pages"),
    )
    files = named.format("binaryFile").load(folder).select(
        file_path(F.col("_metadata.file_path")).alias("source_path")
    )
    unread = files.join(texts.select("source_path"), "source_path", "left_anti")
    return texts.unionByName(unread.withColumn("pages", F.lit(None).cast("array<string>")))


def decode_documents(files: DataFrame, decode: Callable[[bytes], list[str]]) -> DataFrame:
    """``(source_path, pages, error)`` of files ``(source_path, content)``, by a caller's decoder.

    ``decode`` turns the bytes of one file into its page texts and is the one piece of Python
    here: it runs in the tasks, a file at a time.  Where it raises, the row gets NULL pages and
    the error's name and text, and the run goes on; so does a file without content.
    """

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                content, pages, error = batch.column(1)[row].as_py(), None, None
                try:
                    if content is None:
                        raise ValueError("no content")
                    pages = [None if page is None else str(page) for page in decode(content)]
                except Exception as problem:  # whatever a decoder may raise concerns its file only
                    error = f"{type(problem).__name__}: {problem}"
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, 1), pa.array([pages], pa.list_(pa.string())), pa.array([error], pa.string())],
                    names=["source_path", "pages", "error"],
                )

    return files.select("source_path", F.col("content").cast("binary").alias("content")).mapInArrow(
        decoded, "source_path string, pages array<string>, error string"
    )


def read_decoded(
    spark: SparkSession, folder: str, decode: Callable[[bytes], list[str]], glob: str = "*"
) -> DataFrame:
    """``(source_path, pages, error)`` of a folder of files of any format.

    Files of no bytes are passed over, as all of Spark's file readers do.
    """
    files = spark.read.option("pathGlobFilter", glob).format("binaryFile").load(folder)
    return decode_documents(files.select(file_path(F.col("_metadata.file_path")).alias("source_path"), "content"), decode)


def decode_summary(decoded: DataFrame) -> DataFrame:
    """Files, how many were read, and how many failed with each error."""
    return decoded.groupBy("error").agg(F.count(F.lit(1)).alias("n"))


def file_path(encoded: Column) -> Column:
    """The path behind Spark's URL-encoded one; a plus sign stands for itself there."""
    return F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B")))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """``(source_path, pages)`` from Parquet rows ``(source_path, page, text)``.

    A document whose every page text is NULL could not be read and gets NULL pages.
    """
    rows = spark.read.parquet(path)
    ordered = F.sort_array(F.collect_list(F.struct("page", "text")))
    found = rows.groupBy("source_path").agg(ordered.alias("_p"), F.count("text").alias("_n"))
    return found.select(
        "source_path", F.when(F.col("_n") > 0, F.col("_p.text")).alias("pages")
    )


def read_bibliography(spark: SparkSession, path: str) -> DataFrame:
    """``(ordinal, attachment, year)`` from a reference manager's CSV export."""
    wanted = {"File Attachments": "attachment", "Publication Year": "year"}
    return _csv_with_order(spark, path, wanted)


def read_manual_years(spark: SparkSession, path: str) -> DataFrame:
    """``(ordinal, filename, year)`` from a hand-kept CSV."""
    return _csv_with_order(spark, path, {"filename": "filename", "year": "year"})


def _csv_with_order(spark: SparkSession, path: str, wanted: dict[str, str]) -> DataFrame:
    rows = spark.read.csv(path, header=True, multiLine=True, escape='"')
    # A quoted field may hold line breaks, so each file is one split and its rows keep order.
    return rows.select(
        F.monotonically_increasing_id().alias("ordinal"),
        *[F.col(f"`{source}`").alias(name) for source, name in wanted.items()],
    )


def lexicon_from_lines(lines: DataFrame, file_labels: DataFrame) -> DataFrame:
    """``(label, term)`` from ``(file, line)``: trimmed, blanks skipped, labelled by file."""
    terms = lines.select("file", tx.clean_whitespace(F.col("line")).alias("term"))
    return terms.where(F.col("term") != "").join(file_labels, "file").select("label", "term")


def read_lexicon(
    spark: SparkSession, folder: str, file_labels: dict[str, str] | None = None
) -> DataFrame:
    """Lexicon files of a folder, one term per line; files missing there are skipped."""
    labels = file_labels or LEXICON_FILES
    lines = spark.read.option("pathGlobFilter", "*.txt").text(folder).select(
        tx.basename(file_path(F.col("_metadata.file_path"))).alias("file"), F.col("value").alias("line")
    )
    return lexicon_from_lines(lines, file_label_table(spark, labels))


def read_terms(spark: SparkSession, path: str) -> DataFrame:
    """``(term)``: one a line, trimmed, blanks skipped, each once."""
    lines = spark.read.text(path).select(tx.clean_whitespace(F.col("value")).alias("term"))
    return lines.where(F.col("term") != "").distinct()


def file_label_table(spark: SparkSession, file_labels: dict[str, str] | None = None) -> DataFrame:
    return literal_table(spark, "file STRING,label STRING", list((file_labels or LEXICON_FILES).items()))


def lexicon_report(
    spark: SparkSession, folder: str, file_labels: dict[str, str] | None = None
) -> DataFrame:
    """``(file, label, n_terms, missing)`` of every expected lexicon file."""
    lines = spark.read.option("pathGlobFilter", "*.txt").text(folder).select(
        tx.basename(file_path(F.col("_metadata.file_path"))).alias("file"),
        tx.clean_whitespace(F.col("value")).alias("term"),
    )
    terms = lines.groupBy("file").agg(F.count_if(F.col("term") != "").alias("n_terms"))
    found = file_label_table(spark, file_labels).join(terms, "file", "left")
    return found.select(
        "file", "label", F.coalesce("n_terms", F.lit(0)).alias("n_terms"),
        F.col("n_terms").isNull().alias("missing"),
    )


def missing_lexicon_files(lines: DataFrame, file_labels: DataFrame) -> DataFrame:
    """Files that were expected and are not there: a warning, not an error."""
    return file_labels.join(lines.select("file").distinct(), "file", "left_anti")


def lexicon_counts(lexicon: DataFrame) -> DataFrame:
    return lexicon.groupBy("label").agg(F.count(F.lit(1)).alias("n_terms"))
