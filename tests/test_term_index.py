"""The index of a term list against plain search, and what hits of a list shuffle."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from papervein.operators import relevance, term_index


@pytest.mark.parametrize("alphabet, seed", [("ab", 1), ("ab\0", 2), ("aé中😀 ", 3), ("a", 4)])
def test_all_terms_of_all_texts(alphabet, seed):
    """Terms that begin each other, share many bytes, or hold zeros; some end with a text."""
    rng = random.Random(seed)

    def strings(n, most):
        return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(most))) for _ in range(n)]

    texts = [*strings(60, 60), None, "", alphabet * 9]
    terms = sorted({t for t in strings(200, 30) + [alphabet * 7, alphabet * 8] if t}, key=str.encode)
    index = term_index.build(pa.array(terms), np.arange(len(terms)), np.ones(len(terms), np.int64))
    got = {(int(r) + start, int(t)) for start, _, row, term in term_index.found(index, pa.array(texts)) for r, t in zip(row, term)}
    assert got == {(i, k) for i, text in enumerate(texts) for k, term in enumerate(terms) if term in (text or "")}


def test_only_counts_are_shuffled(spark):
    docs = spark.createDataFrame([(1, "iron losses"), (2, "steel"), (3, None), (None, "iron")], "doc_id INT, text STRING")
    listed = spark.createDataFrame([("iron",), ("Iron",), ("iron l",), ("loss",), ("gold",)], "term STRING")
    hits = relevance.hits_of_list(docs, listed)
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in plan.splitlines() if "Exchange" in line and ("term" in line.split("Exchange")[1].split("[plan_id")[0] or "times" in line)]
    assert {(r["doc_id"], r["domain_term_hits"]) for r in hits.collect()} == {(1, 4), (2, 0), (3, 0), (None, 0)}


def test_rows_that_share_an_id_are_one_document(spark):
    docs = spark.createDataFrame([(1, "iron"), (1, "iron loss"), (2, "loss"), (3, "loss"), (3, "loss")], "doc_id INT, text STRING")
    listed = spark.createDataFrame([("iron",), ("loss",)], "term STRING").withColumn("term", F.upper("term"))
    got = relevance.hits_of_list(docs, listed).collect()
    assert sorted((r["doc_id"], r["domain_term_hits"]) for r in got) == [(1, 2), (1, 2), (2, 1), (3, 1), (3, 1)]
