"""A long lexicon that is made from a table: the table is read a fixed number of times."""

from pyspark.sql import functions as F

from papervein.config import Config
from papervein.operators import extraction


def test_a_long_lexicon_is_made_once_for_all_its_uses(spark):
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    rows = spark.range(200).select(F.lit("X").alias("label"), F.concat(F.lit("w"), "id", F.lit(" steel")).alias("term"))
    lexicon = rows.mapInArrow(count, "label string, term string")
    docs = spark.createDataFrame([(1, "A w7 steel and w8 iron."), (2, "w199 steel")], "doc_id INT, text STRING")
    found = extraction.candidates(docs, Config(patterns=()), lexicon)
    assert sorted((r["doc_id"], r["entity_text"]) for r in found.collect()) == [(1, "w7 steel"), (2, "w199 steel")]
    assert made.value <= 2 * 200
