"""The registered queries: each operator over its whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from papervein.llm import (
    chat, conversation_repair, decontaminate, lm_score, near_dup, packing, pieces, quality, spelling, suffix_dedup,
    token_counts, url_filter, warc,
)
from papervein.llm.shared import shared_folder

TOKENIZER = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


URL_RULES = (
    url_filter.Rule("allow", "org", "/"),
    url_filter.Rule("block", "example.org", "/es/"),
    url_filter.Rule("block", "example.org", "/en/1"),
    url_filter.Rule("allow", "com", "/fr/"),
    url_filter.Rule("block", "com", "/de/"),
)


def op1_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    return chat.render(chat.parse(table(spark, folder, "conversations")))


def op2_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dup.classify(table(spark, folder, "documents"))


def op3_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge(table(spark, folder, "pages"), URL_RULES)


def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    forest = quality.train(docs, table(spark, folder, "labels"))
    return quality.score(docs, forest)


def op5_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.digest(table(spark, folder, "documents"))


def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return decontaminate.digest(found)


def op7_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(table(spark, folder, "pages"))


def op8_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    scores = lm_score.score(table(spark, folder, "documents"))
    return scores.withColumn("log_score", F.round("log_score", 3))


def op9_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """The ids as their checksum."""
    packed = packing.pack(table(spark, folder, "documents"), tokenizer_path())
    return packed.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Starts from an empty cache, so every distinct text is encoded."""
    cache = f"{shared_folder(spark)}/token-cache-{uuid.uuid4().hex}"
    counts = token_counts.count_tokens(table(spark, folder, "documents"), tokenizer_path(), cache)
    return counts.withColumn("over_limit", F.col("n_tokens") > 512)


def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(table(spark, folder, "documents"))


def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    """The rows are damaged first, so that there is something to repair."""
    conversations = table(spark, folder, "conversations")
    repaired = conversation_repair.repair(conversation_repair.damage(conversations))
    return conversation_repair.digest(conversations, repaired)


def op13_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of whole texts, and the texts that these give again."""
    model = tokenizer_path(PIECES)
    return pieces.digest(pieces.encode(table(spark, folder, "documents"), model, with_text=True))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_chat_formatting, op2_minhash_near_dedup, op3_url_filter, op4_quality_rules, op5_suffix_array_dedup,
        op6_decontamination, op7_warc, op8_lm_scoring, op9_best_fit_packing, op10_token_counts, op11_spelling_variants,
        op12_conversation_repair, op13_sentencepiece,
    )
}
