"""A lexicon beyond the broadcast bound: spans are found where the text is read."""

import random

import pytest
from pyspark.sql import functions as F

from papervein.config import GRADE_PATTERNS, Config
from papervein.operators import extraction

WORDS = ["iron", "Loss", "core", "a", "50A470", "of", "steel", "M300-35A", "é", "x_1", "7"]


def rows(spark, seed):
    rng = random.Random(seed)

    def some(least, most):
        return " ".join(rng.choice(WORDS) for _ in range(rng.randrange(least, most)))

    texts = [(rng.randrange(30), some(0, 30) + rng.choice((".", ". Then ", " - ")) + some(0, 30)) for _ in range(60)]
    terms = [(rng.choice(("X", "Y", None)), some(1, 7)) for _ in range(150)] + [("X", None), (None, "iron core"), ("Z", " ")]
    docs = spark.createDataFrame([*texts, (None, "iron core"), (31, None)], "doc_id INT, text STRING")
    return docs, spark.createDataFrame(terms, "label STRING, term STRING")


@pytest.mark.parametrize("patterns", [(), GRADE_PATTERNS])
@pytest.mark.parametrize("slots, words", [(1 << 21, 1 << 22), (1, 1)])
def test_the_same_spans_as_with_a_broadcast(spark, monkeypatch, patterns, slots, words):
    """With tables of one word nearly all spans pass, and those of no phrase are left out by their codes."""
    docs, lexicon = rows(spark, 5)
    want = sorted(map(str, extraction.candidates(docs, Config(patterns=patterns), lexicon).collect()))
    monkeypatch.setattr(extraction, "MAX_FIRST_SLOTS", slots)
    monkeypatch.setattr(extraction, "MAX_PHRASE_WORDS", words)
    for bound in (0, 3000):
        got = extraction.candidates(docs, Config(patterns=patterns), lexicon, max_broadcast_bytes=bound)
        assert sorted(map(str, got.collect())) == want and len(want) > 100


def test_many_labels_and_lengths_give_the_same(spark, monkeypatch):
    docs, lexicon = rows(spark, 6)
    want = sorted(map(str, extraction.candidates(docs, Config(patterns=()), lexicon).collect()))
    monkeypatch.setattr(extraction, "MAX_KINDS", 2)
    got = extraction.candidates(docs, Config(patterns=()), lexicon, max_broadcast_bytes=0)
    assert sorted(map(str, got.collect())) == want


def test_no_text_is_shuffled(spark):
    """Before, every token that begins a phrase was shuffled with its whole sentence."""
    docs = spark.createDataFrame([(i, f"Some w{i} steel and w{i + 1} iron w{i + 2} steel.") for i in range(50)], "doc_id INT, text STRING")
    lexicon = spark.range(2000).select(F.lit("X").alias("label"), F.concat(F.lit("w"), "id", F.lit(" steel")).alias("term"))
    found = extraction.candidates(docs, Config(patterns=()), lexicon, max_broadcast_bytes=10_000)
    assert found.count() == 100
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan
