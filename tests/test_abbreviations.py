"""Sentence bounds learnt from a corpus."""

import math
import re

import pytest

from pyspark.sql import functions as F

from papervein.config import Config
from papervein.operators import abbreviations, extraction
from papervein.operators.joins import literal_table
from papervein.plans import fixtures

PROBE = "The loss fell in Fig. 3 at approx. 20 MPa as Smith et al. 2020 report."


def corpus(spark, n=60):
    rows = []
    for i in range(n):
        rows.append((i, (
            f"The sheet {i} was cut. The loss fell in Fig. {i} at approx. {i} MPa. We saw it in Smith et al. 2020 again. "
            f"It holds for all of them. The core is thin (cf. Tab. 4). The end came fast. Is it so? The test, e.g. Number {i}, says it is. "
            f"They cut them again so fast that it is MPa after MPa, {i}."
        )))
    rows.append((1000, PROBE))
    return spark.createDataFrame(rows, "doc_id LONG, text STRING")


@pytest.fixture(scope="module")
def bounds(spark):
    return abbreviations.learn(corpus(spark))


def test_what_is_learnt(spark, bounds):
    found = {r[0] for r in bounds.abbreviations.collect()}
    assert {"fig", "approx", "al", "cf", "tab", "e.g"} <= found
    assert not {"cut", "mpa", "again", "them", "fast", "is"} & found
    starts = {r[0] for r in bounds.openers.collect()}
    assert "the" in starts and not {"fig", "smith"} & starts


def test_one_sentence_of_the_probe(spark, bounds):
    docs = corpus(spark).where("doc_id = 1000")
    assert extraction.sentences(docs).count() > 3
    assert [r["sentence"] for r in extraction.sentences(docs, bounds).collect()] == [PROBE]


def test_sentences_join_back_and_an_opener_ends_one(spark, bounds):
    docs = corpus(spark)
    rows = extraction.sentences(docs, bounds).orderBy("doc_id", "sent_id").collect()
    for doc in docs.collect():
        own = [r for r in rows if r["doc_id"] == doc["doc_id"]]
        assert "".join(r["sentence"] for r in own) == doc["text"]
        at = 0
        for r in own:
            assert r["sent_start"] == at
            at += len(r["sentence"])
    text = spark.createDataFrame([(1, "So did Smith et al. The rest did not."), (2, None), (3, ""), (4, "Fig. 3"), (5, "Fig.")], "doc_id INT, text STRING")
    got = {}
    for r in extraction.sentences(text, bounds).orderBy("doc_id", "sent_id").collect():
        got.setdefault(r["doc_id"], []).append(r["sentence"])
    assert got == {1: ["So did Smith et al. ", "The rest did not."], 4: ["Fig. 3"], 5: ["Fig."]}


def test_scores_by_hand(spark):
    """The published formulas on the plain counts of a small corpus."""
    docs = corpus(spark)
    piece = re.compile(r"""^[(\["']*([^\W\d_][^\W\d_]*(?:[.'-][^\W\d_]+)*)(\.?)[,;:)\]"'!?]*$""")
    stop, plain = {}, {}
    for row in docs.collect():
        for p in row["text"].split(" "):
            m = piece.match(p)
            if m:
                which = stop if m[2] else plain
                which[m[1].lower()] = which.get(m[1].lower(), 0) + 1
    n = sum(stop.values()) + sum(plain.values())
    share = sum(stop.values()) / n
    want = {}
    for w, a in stop.items():
        b = plain.get(w, 0)
        if a < 5:
            continue
        letters = len(w.replace(".", ""))
        ratio = -2 * (a * math.log(share) + b * math.log(1 - share) - a * math.log(0.99) - b * math.log(0.01))
        score = ratio * math.exp(-letters) * (w.count(".") + 1) * letters ** -float(b)
        if score >= 0.3:
            want[w] = score
    got = {r["word"]: r["score"] for r in abbreviations.abbreviations(abbreviations.word_counts(docs)).collect()}
    assert got == pytest.approx(want, abs=1e-5) and want


def test_mentions_keep_their_sentence(spark, bounds):
    lexicon = literal_table(spark, "label STRING,term STRING", fixtures.LEXICON)
    docs = corpus(spark).where("doc_id = 1000")
    found = extraction.entity_table(docs, Config(), lexicon, bounds=bounds).collect()
    strength = next(r for r in found if r["label"] == "MPA_VALUE")
    assert strength["context"] == PROBE and PROBE[strength["start_char"] : strength["end_char"]] == "20 MPa"


def test_nothing_to_learn_from(spark):
    none = spark.createDataFrame([], "doc_id INT, text STRING")
    learnt = abbreviations.learn(none)
    assert learnt.abbreviations.count() == 0 and learnt.openers.count() == 0
    plain = spark.createDataFrame([(1, "One. Two."), (2, None)], "doc_id INT, text STRING")
    same = [tuple(r) for r in extraction.sentences(plain, learnt).collect()]
    assert same == [tuple(r) for r in extraction.sentences(plain).collect()]


def test_lists_beyond_the_bound_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(abbreviations, "LIST_BYTES", 10)
    with pytest.raises(ValueError, match="min_count"):
        abbreviations.learn(corpus(spark))


def test_counting_takes_each_distinct_piece_apart_once(spark):
    """Texts that come often are counted as often, and the expressions see every piece once."""
    text = "Cf. the plot. The (Dr. Li) plot! The end."
    docs = spark.createDataFrame([(i, text) for i in range(40)] + [(40, None), (41, "")], "doc_id LONG, text STRING")
    counts = abbreviations.word_counts(docs)
    got = {r["word"]: (r["n_stop"], r["n_plain"], r["n_open"]) for r in counts.collect()}
    assert got == {
        "cf": (40, 0, 0), "the": (0, 120, 80), "plot": (40, 40, 0), "dr": (40, 0, 0), "li": (0, 40, 40), "end": (40, 0, 0),
    }
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") == 2  # pieces first, then words


def test_the_last_word_is_found_behind_brackets_and_quotes(spark):
    words = spark.createDataFrame([("fig",), ("dr",), ("e.g",)], "word STRING")
    none = spark.createDataFrame([], "word STRING")
    text = "See (Fig. 3 here. Now \"Dr. Li came. X [e.g. This. Dr. Who"
    docs = spark.createDataFrame([(1, text)], "doc_id LONG, text STRING")
    parts = abbreviations.sentence_parts(F.col("text"), abbreviations.Bounds(words, none), docs).first()["_parts"]
    assert parts == ["See (Fig. 3 here. ", "Now \"Dr. Li came. ", "X [e.g. This. ", "Dr. Who", ""]
