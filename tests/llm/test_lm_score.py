import math
from collections import Counter

import pytest

from papervein.llm import lm_score
from tests.llm import brute


def expected_of(texts, alpha=0.4, order=2):
    """Counts of all n-grams by hand; each word by the longest context that another text has."""
    words = [tuple(brute.SPACED.findall(brute.lower(t))) for t in texts]

    def grams(w):
        return Counter(w[i : i + n] for n in range(1, order + 1) for i in range(len(w) - n + 1))

    every = sum(map(grams, words), Counter())
    total, out = sum(map(len, words)), []
    for w in words:
        own, others = grams(w), max(1, total - len(w))
        score, backoff = 0.0, 0
        for i in range(len(w)):
            most = min(order, i + 1)
            for n in range(most, 0, -1):
                gram = w[i - n + 1 : i + 1]
                seen = every[gram] - own[gram]
                if seen and n > 1:
                    score += math.log(alpha ** (most - n) * seen / (every[gram[:-1]] - own[gram[:-1]]))
                elif n == 1:
                    score += math.log(alpha ** (most - 1) * (seen or alpha) / others)
                if seen or n == 1:
                    backoff += n < most
                    break
        out.append((len(w), backoff, round(score, 6)))
    return out


def rows_of(docs, **options):
    return sorted((str(r.doc_id), r.n_words, r.n_backoff, round(r.log_score, 6) + 0.0) for r in lm_score.score(docs, **options).collect())


def alike(got, expected):
    assert [g[:3] for g in got] == [e[:3] for e in expected]
    assert all(abs(g[3] - e[3]) < 1e-5 for g, e in zip(got, expected))


@pytest.mark.parametrize("order,rounds", [(1, 1), (2, 1), (2, 3), (3, 2), (4, 1)])
def test_odd_documents(spark, odd_documents, no_documents, order, rounds):
    own = odd_documents.select("doc_id", "text").collect()
    expected = sorted((str(r.doc_id), *e) for r, e in zip(own, expected_of([r.text for r in own], order=order)))
    alike(rows_of(odd_documents.repartition(3), order=order, rounds=rounds), expected)
    assert rows_of(no_documents, order=order, rounds=rounds) == []


@pytest.mark.parametrize("order", [2, 3])
def test_against_plain_scores(spark, order):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    own = docs.select("doc_id", "text").collect()
    expected = sorted((str(r.doc_id), *e) for r, e in zip(own, expected_of([r.text for r in own], order=order)))
    alike(rows_of(docs.repartition(5), order=order), expected)


def test_repeated_rows_know_each_other(spark):
    text = "one two three two one"
    docs = spark.createDataFrame([(1, text)] * 5 + [(2, text), (None, text), (None, text), (3, "four")], "doc_id long, text string")
    own = docs.collect()
    expected = sorted((str(r.doc_id), *e) for r, e in zip(own, expected_of([r.text for r in own])))
    alike(rows_of(docs.repartition(4)), expected)


def test_each_round_reads_the_texts_once(spark, monkeypatch):
    """The n-grams of a round are made for the join alone; the counts they meet are a written table."""
    made = []
    scored = lm_score._scored

    def plan_of(*given):
        out = scored(*given)
        made.append(out._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow"))
        return out

    monkeypatch.setattr(lm_score, "_scored", plan_of)
    docs = spark.createDataFrame([(1, "one two three"), (2, "one two four"), (3, "")], "doc_id long, text string")
    own = docs.collect()
    expected = sorted((str(r.doc_id), *e) for r, e in zip(own, expected_of([r.text for r in own])))
    alike(rows_of(docs, rounds=2), expected)
    assert made == [1, 1]


def test_only_words_left_meet_the_table_of_words(spark, monkeypatch):
    """What a longer n-gram scores is not shuffled again, also where the words do not fit a broadcast."""
    left = []
    summed = lm_score._summed

    def rows_in(scored, *given):
        left.extend((r.logs is None, r.w is None) for r in scored.collect())
        return summed(scored, *given)

    monkeypatch.setattr(lm_score, "_summed", rows_in)
    monkeypatch.setattr(lm_score, "fits_broadcast", lambda table: False)
    docs = spark.createDataFrame([(1, "a b c d"), (2, "a b e"), (3, "a b c f"), (None, "b c")], "doc_id long, text string")
    expected = sorted((str(r.doc_id), *e) for r, e in zip(docs.collect(), expected_of([r.text for r in docs.collect()])))
    alike(rows_of(docs, rounds=2), expected)
    assert sorted(left) == [(False, True)] * 6 + [(True, False)] * 7


def test_a_document_is_in_one_round(spark, monkeypatch):
    """Every text is cut into the n-grams to be scored once, whatever the number of rounds."""
    ids = []
    asked = lm_score._asked

    def asked_of(keyed, *given):
        ids.extend(r.doc_id for r in keyed.collect())
        return asked(keyed, *given)

    monkeypatch.setattr(lm_score, "_asked", asked_of)
    docs = spark.createDataFrame([(i, f"one two {i}") for i in range(9)] + [(None, None)], "doc_id long, text string")
    lm_score.score(docs, rounds=3)
    assert sorted(ids, key=str) == [*range(9), None]
