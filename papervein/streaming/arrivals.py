"""Mining documents as they arrive, with the same operators as in batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from papervein.config import Config
from papervein.functions import text as tx
from papervein.operators import extraction, relevance

DOCUMENT_SCHEMA = "doc_id STRING, text STRING, year INT"


def mine_arrivals(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    cfg: Config,
    lexicon: DataFrame,
    schema: str = DOCUMENT_SCHEMA,
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Append the mentions of new relevant documents; ends when all files are read.

    Texts are cleaned first; offsets are places in the cleaned text.  Extraction needs one document at a time, so no state is kept between batches.  Each
    batch overwrites its own folder, so a batch repeated after a failure counts once.
    """
    arrivals = (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        cleaned = batch.withColumn("text", tx.clean_whitespace(F.col("text")))
        entities = extraction.entity_table(relevance.relevant(cleaned, cfg), cfg, lexicon)
        entities.write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")

    return (
        arrivals.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
