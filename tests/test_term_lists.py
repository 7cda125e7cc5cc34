"""Term lists of any size: every term by every text, and the plan that avoids that."""

import random

import pytest
from pyspark.sql import functions as F

from papervein.config import Config
from papervein.operators import relevance


def texts(rng, n):
    words = ["iron", "Loss", "NGO", "fe-si", "ß", "Ärger", "a", "of", "core loss", "x" * 40, "中文字", "tab\there"]
    return [None, "", "a", "AB"] + [
        "".join(rng.choice(words) + rng.choice((" ", "", "\n", "  ")) for _ in range(rng.randrange(120))) for _ in range(n)
    ]


def term_list(rng, rows):
    """Pieces of the texts themselves, of every length, and terms that occur nowhere."""
    found = ["iron", "IRON", "Iron", " ", "", "a", "ab", "ß", "中文", "no such term", "x" * 40, "x" * 41, "ärger", "loss\n"]
    for text in rows:
        for _ in range(6):
            if text and len(text) > 3:
                at = rng.randrange(len(text) - 1)
                found.append(text[at : at + rng.choice((1, 2, 3, 4, 9, 30, 300))])
    return found


def plain(rows, terms):
    return {i: sum(t.lower() in (text or "").lower() for t in terms if t.strip(" ")) if text is not None else 0 for i, text in enumerate(rows)}


@pytest.mark.parametrize("seed, bound", [(1, 1 << 26), (2, 1 << 26), (3, 4000)])
def test_every_term_by_every_text(spark, seed, bound):
    """The small bound takes the list in many parts."""
    rng = random.Random(seed)
    rows = texts(rng, 40)
    terms = term_list(rng, rows)
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id INT, text STRING").withColumn("term", F.lit("clash"))
    listed = spark.createDataFrame([(t,) for t in terms] + [(None,)], "term STRING")
    got = relevance.hits_of_list(docs, listed, bound)
    assert {r["doc_id"]: r["domain_term_hits"] for r in got.collect()} == plain(rows, terms)


def test_the_built_in_terms_count_alike(spark):
    rows = [(1, "NGO electrical steel and core loss of a motor"), (2, "Permeability, hysteresis: eddy current"), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id INT, text STRING")
    cfg = Config(relevance_threshold=3)
    listed = spark.createDataFrame([(t,) for t in cfg.domain_terms], "term STRING")
    want = relevance.tag(docs, cfg).select("doc_id", "domain_term_hits", "is_relevant").collect()
    assert sorted(relevance.tag_by_list(docs, listed, cfg).collect()) == sorted(want)


def test_empty_lists_and_tables(spark):
    docs = spark.createDataFrame([(1, "iron")], "doc_id INT, text STRING")
    none = spark.createDataFrame([], "term STRING")
    assert relevance.hits_of_list(docs, none).collect() == [(1, 0)]
    assert relevance.hits_of_list(docs, spark.createDataFrame([(" ",), (None,)], "term STRING")).collect() == [(1, 0)]
    assert relevance.hits_of_list(docs.limit(0), spark.createDataFrame([("iron",)], "term STRING")).count() == 0


def test_plan_has_no_expression_for_each_term(spark):
    docs = spark.createDataFrame([(1, "iron")], "doc_id INT, text STRING")
    listed = spark.range(10_000).select(F.concat(F.lit("term number "), "id").alias("term"))
    plan = relevance.listed_terms(docs, listed)._jdf.queryExecution().executedPlan().toString()
    assert len(plan) < 20_000 and "BroadcastHashJoin" in plan and "NestedLoop" not in plan and "Cartesian" not in plan
    # Texts and blocks stay in the scan's stage: what is shuffled has neither.
    assert all("_block" not in line for line in plan.splitlines() if "Exchange hashpartitioning" in line)
