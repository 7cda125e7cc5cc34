"""Token counts through a cache of content digests.

The cache is a Parquet table of (tokenizer, digest, n_tokens).  A text is looked up by the
SHA-256 of its UTF-8 bytes and the digest of the tokenizer's file and library version.
Only distinct texts that the cache lacks are encoded; their counts are appended to it.

A null text counts as empty and has no tokens.  Repeated rows each get a row.  A cache that
was appended to twice for one text still gives one count.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from papervein.llm import tokens
from papervein.llm.shared import Tables

CACHE = "tokenizer string, digest binary, n_tokens long"


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    """The stored counts; none before the first append."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.read.schema(CACHE).parquet(path)
    return spark.createDataFrame([], CACHE)


def count_once(encoder: tokens.Encoder, parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of (digest, text) rows; of rows with one digest the first is encoded."""
    done: set[bytes] = set()
    for batch in parts:
        digests, counts = [], []
        for digest, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            if digest not in done:
                done.add(digest)
                digests.append(digest)
                counts.append(len(encoder.ids(text.as_py())) // 4)
        yield pa.RecordBatch.from_arrays(
            [pa.array(digests, pa.binary()), pa.array(counts, pa.int64())], names=["digest", "n_tokens"]
        )


def count_tokens(docs: DataFrame, tokenizer: str, cache_path: str) -> DataFrame:
    """doc_id, n_bytes and n_tokens of every document."""
    spark = docs.sparkSession
    version = tokens.version_digest(tokenizer)
    tables = Tables(spark, "token-counts")
    content = F.coalesce(F.col("text"), F.lit("")).alias("text")
    texts = docs.select("doc_id", content).withColumn("digest", F.unhex(F.sha2(F.encode("text", "UTF-8"), 256)))
    # Tells rows apart without their text; equal for repeated rows.
    texts = texts.withColumn("row_key", F.coalesce("doc_id", F.xxhash64("digest")))
    keys = tables.write(
        texts.select("doc_id", "row_key", "digest", F.octet_length("text").cast("long").alias("n_bytes")), "keys"
    )
    stored = read_cache(spark, cache_path).where(F.col("tokenizer") == version)
    missing = (
        keys.groupBy("digest").agg(F.min("row_key").alias("row_key"))
        .join(stored.select("digest").distinct(), "digest", "left_anti")
    )
    # The rows of one text that are chosen have one key, so they are in one partition.
    chosen = texts.select("row_key", "digest", "text").join(
        missing.hint("shuffle_hash"), ["row_key", "digest"], "left_semi"
    )

    def counted(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return count_once(tokens.encoder(tokenizer), parts)

    fresh = (
        chosen.select("digest", "text").mapInArrow(counted, "digest binary, n_tokens long")
        .groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    )
    fresh.select(F.lit(version).alias("tokenizer"), "digest", "n_tokens").write.mode("append").parquet(cache_path)
    counts = (
        spark.read.schema(CACHE).parquet(cache_path).where(F.col("tokenizer") == version)
        .groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    )
    return keys.join(counts, "digest").select("doc_id", "n_bytes", "n_tokens")
