"""A training-corpus pipeline: documents in, packed token pieces out.

Each stage takes (spark, docs, sf_dir), reads only what its predecessor kept, and returns a
DataFrame; ``run`` writes each result as Parquet in the shared folder and reads it again as
the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from papervein.llm import decontaminate, near_dup, packing, quality, suffix_dedup
from papervein.llm.queries import table, tokenizer_path
from papervein.llm.shared import Tables


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the trees reject go."""
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays."""
    return near_dup.keep_first(docs)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 200 bytes that occur again are cut out of the texts."""
    return suffix_dedup.remove(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents' pieces with their ids and places in sequences of 1024 tokens."""
    packed = packing.pack(docs, tokenizer_path())
    return packed.select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset", "ids"
    )


STAGES = [
    ("quality rules", quality_rules),
    ("minhash near-dedup", minhash_near_dedup),
    ("suffix-array dedup", suffix_array_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("best-fit packing", best_fit_packing),
]

# Boosted trees, groups of near-duplicates and token ids are beyond SQL; the tests compare
# every stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    tables = Tables(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = tables.write(stage(spark, docs, sf_dir), f"stage{number}")
    return docs
