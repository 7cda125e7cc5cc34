"""Patterns, phrases, offsets, overlaps and scopes on small texts."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from papervein.config import Config
from papervein.functions import text as tx
from papervein.operators import extraction

CFG = Config()
LEXICON = [
    ("COMPETING_MATERIAL", "grain-oriented electrical steel"),
    ("COMPETING_MATERIAL", "ferrite"),
    ("APPLICATION", "stator core"),
    ("APPLICATION", "core stack press"),
    ("PROCESSING", "press line"),
    ("OOS_GRADE", "6.5% Si steel"),
    ("GRADE_BRAND", "35H series"),
]
# The five code families, each with the code as it must be found.
GRADE_CODES = (
    "35A210", "35A300", "50A470", "50A700", "50A1000", "50A1300",
    "M300-35A", "M300-35A5",
    "35H250", "50H270", "50H310", "50H600", "15HTH1000", "20HTH1200", "20HTH1500",
    "20HTH1800", "15HST780Y", "20HST570Y", "20HST780Y", "35HXT680T",
    "50JNE300",
    "NO20", "NO30-1600",
)


def docs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING")


def lexicon(spark):
    return spark.createDataFrame(LEXICON, "label STRING, term STRING")


def mine(spark, *texts, **options):
    table = extraction.entity_table(docs(spark, *texts), CFG, lexicon(spark), **options)
    return [r.asDict() for r in table.orderBy("doc_id", "start_char").collect()]


def found(spark, *texts):
    return [(r["label"], r["entity_text"]) for r in mine(spark, *texts)]


def test_every_grade_code_is_found_whole(spark):
    rows = mine(spark, *[f"The sheet {code} was used." for code in GRADE_CODES])
    assert [(r["label"], r["entity_text"]) for r in rows] == [("GRADE", c) for c in GRADE_CODES]


@pytest.mark.parametrize(
    ("sentence", "expected"),
    [
        ("Loss W15/50 is low.", [("CORE_LOSS", "W15/50")]),
        ("Loss W1.5/50k is low.", [("CORE_LOSS", "W1.5/50k")]),
        ("It has 2.3 W/kg here.", [("CORE_LOSS", "2.3 W/kg")]),
        ("It has 2.3 W/KG here.", []),
        ("With 3.2% Si and 6 wt% silicon.", [("SI_CONTENT", "3.2% Si"), ("SI_CONTENT", "6 wt% silicon")]),
        ("With 7.5% Si inside.", []),
        ("Up to 690 MPa and 690MPa.", [("MPA_VALUE", "690 MPa"), ("MPA_VALUE", "690MPa")]),
        ("Up to 45MPa and 15T.", [("MPA_VALUE", "45MPa")]),
        ("At 1.7 T or B50 but not B7.", [("FLUX_DENSITY", "1.7 T"), ("FLUX_DENSITY", "B50")]),
        ("At 3 T nothing.", []),
    ],
)
def test_measurements(spark, sentence, expected):
    assert found(spark, sentence) == expected


def test_phrases_are_case_sensitive_and_whole_tokens(spark):
    assert found(spark, "Ferrite, ferrites and ferrite.") == [("COMPETING_MATERIAL", "ferrite")]


def test_longest_span_wins_then_later_free_span_survives(spark):
    # "stator core" (2) and "core stack press" (3) and "press line" (2) form a chain.
    assert found(spark, "A stator core stack press line.") == [("APPLICATION", "core stack press")]
    assert found(spark, "A stator core and a press line.") == [
        ("APPLICATION", "stator core"), ("PROCESSING", "press line"),
    ]


def test_longer_phrase_beats_the_pattern_inside(spark):
    assert found(spark, "Use 6.5% Si steel.") == [("OOS_GRADE", "6.5% Si steel")]


def test_scope_of_four_sentences(spark):
    rows = mine(
        spark,
        "A non-oriented sheet 35A300 was cut. Then ferrite and 50A470 came. "
        "Here NGO grade NO20 met ferrite. Only 1.5 T remained. The ngos had 2 T left.",
    )
    scopes = {r["entity_text"]: r["scope_tag"] for r in rows}
    assert scopes == {
        "35A300": "NGO", "ferrite": None, "50A470": "COMPETITOR", "NO20": "AMBIGUOUS",
        "1.5 T": "UNSPECIFIED", "2 T": "UNSPECIFIED",
    }


def test_competitor_found_inside_a_hyphenated_trigger(spark):
    rows = mine(spark, "The non-grain-oriented electrical steel 50A470.")
    assert [r["scope_tag"] for r in rows if r["label"] == "GRADE"] == ["AMBIGUOUS"]


TEXTS = (
    "Élan vital 35A300. Is it 2.3 W/kg? Yes! 50A470 and ferrite ☃ 690 MPa",
    "no break.here and no. break either. But here: 1.7 T 🙂🙂 B50. 3 ends",
    "",
    "word",
    " ".join(f"W{i}/50 filler" for i in range(300)),
)


def test_offsets_cut_the_text_and_spans_do_not_overlap(spark):
    rows = mine(spark, *TEXTS)
    assert len(rows) > 300
    last = {}
    for r in rows:
        assert TEXTS[r["doc_id"]][r["start_char"]:r["end_char"]] == r["entity_text"]
        assert r["entity_text"] in r["context"]
        assert r["start_char"] >= last.get(r["doc_id"], 0)
        last[r["doc_id"]] = r["end_char"]


def test_tokens_and_sentences_against_a_regex_scan(spark):
    grammar = re.compile(tx.TOKEN.replace(r"\p{L}\p{N}_", r"\w").replace(r"\p{L}", r"[^\W\d_]"))
    rows = extraction.tokens(docs(spark, *TEXTS)).orderBy("doc_id", "start_char").collect()
    got = [(r["doc_id"], r["token"], r["start_char"], r["end_char"]) for r in rows]
    want = [(i, m.group(), *m.span()) for i, t in enumerate(TEXTS) for m in grammar.finditer(t)]
    assert got == want
    parts = extraction.sentences(docs(spark, *TEXTS)).orderBy("doc_id", "sent_id").collect()
    for i, t in enumerate(TEXTS):
        mine_ = [p for p in parts if p["doc_id"] == i]
        assert "".join(p["sentence"] for p in mine_) == t
        assert all(t[p["sent_start"]:].startswith(p["sentence"]) for p in mine_)
    assert [p["sentence"] for p in parts if p["doc_id"] == 1] == [
        "no break.here and no. break either. ", "But here: 1.7 T 🙂🙂 B50. ", "3 ends",
    ]


def test_large_lexicon_path_gives_the_same_mentions(spark):
    assert mine(spark, *TEXTS, max_broadcast_bytes=0) == mine(spark, *TEXTS)
    only = Config(patterns=())
    for size in (0, 1 << 20):
        table = extraction.entity_table(docs(spark, *TEXTS), only, lexicon(spark), size)
        assert [r["entity_text"] for r in table.collect()] == ["ferrite"]


def plain_resolution(spans):
    """Longest first, then start, then label; none that overlaps a kept one."""
    kept = []
    for n, start, label, end, text in sorted({(-n, s, l, e, t) for n, s, e, l, t in spans}):
        if all(end <= s or e <= start for _, s, _, e, _ in kept):
            kept.append((n, start, label, end, text))
    return sorted((start, end, label) for _, start, label, end, _ in kept)


@pytest.mark.parametrize("seed", range(3))
def test_resolution_of_random_spans(spark, seed):
    rng = random.Random(seed)
    rows, want = [], {}
    for sent in range(30):
        spans = []
        for _ in range(rng.randrange(1, 40)):
            start, length = rng.randrange(60), rng.randrange(1, 8)
            spans.append((rng.randrange(1, 5), start, start + length, rng.choice("ABC"), "x" * length))
        want[sent] = plain_resolution(spans)
        rows += [(0, sent, "s", l, n, s, e, t) for n, s, e, l, t in spans]
    table = spark.createDataFrame(rows, "doc_id INT, sent_id INT, sentence STRING, label STRING, n_tokens INT, start_char INT, end_char INT, entity_text STRING")
    got = {
        r["sent_id"]: sorted((k["start_char"], k["end_char"], k["label"]) for k in r["kept"])
        for r in extraction.resolved_sentences(table).collect()
    }
    assert got == want


def test_a_sentence_of_many_mentions(spark):
    """A table without full stops, with ten thousand mentions, takes seconds."""
    count = 3400
    text = " ".join(f"W{i}/50 ferrite 690 MPa" for i in range(count))
    began = time.perf_counter()
    # Without the context: that is the whole sentence for every mention.
    table = extraction.entity_table(docs(spark, text), CFG, lexicon(spark))
    rows = table.select("entity_text", "start_char", "end_char").collect()
    assert len(rows) == 3 * count
    assert all(text[r["start_char"]:r["end_char"]] == r["entity_text"] for r in rows)
    assert time.perf_counter() - began < 120


def test_units_part_from_their_numbers(spark):
    rows = mine(spark, "Found 45MPa, 690MPa, 690 MPa, 12W/kg, 2.3W/kg, 15T no, 1.5T and 1.5 T in 50A470 or M300-35A.")
    assert sorted(r["entity_text"] for r in rows) == sorted([
        "45MPa", "690MPa", "690 MPa", "12W/kg", "2.3W/kg", "1.5T", "1.5 T", "50A470", "M300-35A",
    ])


def test_many_phrases_with_one_first_word(spark):
    """A first word that all phrases share opens one candidate a length, not one a phrase."""
    shared = [("PRODUCER", f"the maker{i}") for i in range(3000)] + [("PRODUCER", "the big maker7")]
    table = spark.createDataFrame(shared, "label STRING, term STRING")
    text = "Both the maker5 and the big maker7 but not the other."
    for size in (0, 200, 64 << 20):
        found = extraction.entity_table(docs(spark, text), Config(patterns=()), table, size).collect()
        assert sorted(r["entity_text"] for r in found) == ["the big maker7", "the maker5"]
    opened = extraction.candidates(docs(spark, text), Config(patterns=()), table)
    assert "BroadcastHashJoin" in opened._jdf.queryExecution().executedPlan().toString()


def test_running_starts(spark):
    rows = spark.createDataFrame([([],), ([3],), ([1, 2, 3, 4, 5, 6, 7],)], "a ARRAY<INT>")
    got = [r[0] for r in rows.select(tx.running_starts(F.col("a"))).collect()]
    assert got == [[], [0], [0, 1, 3, 6, 10, 15, 21]]


def test_reports(spark):
    documents = docs(spark, "Sheet 35A300 and 35A300.", "Nothing.", "Loss of 2 W/kg.")
    entities = extraction.entity_table(documents, CFG, lexicon(spark)).cache()
    assert {r[0]: r[1] for r in extraction.per_document(entities).collect()} == {0: 2, 2: 1}
    assert [r[0] for r in extraction.without_mentions(documents, entities).collect()] == [1]
    assert {r[0]: r[1] for r in extraction.label_counts(entities).collect()} == {"GRADE": 2, "CORE_LOSS": 1}
    assert {r[0]: r[1] for r in extraction.scope_counts(entities).collect()} == {"UNSPECIFIED": 3}
    assert [tuple(r) for r in extraction.distinct_measures(entities, CFG).collect()] == [("CORE_LOSS", "2 W/kg")]


def test_no_matcher_is_an_error(spark):
    with pytest.raises(ValueError):
        extraction.candidates(docs(spark, "x"), Config(patterns=()))


def test_large_lexicons_are_tested_by_bitmap(spark, monkeypatch):
    """The same mentions whichever way first words are looked up, and however large the lexicon."""
    want = mine(spark, *TEXTS)
    monkeypatch.setattr(extraction, "MAX_FIRST_WORDS", 0)
    assert mine(spark, *TEXTS) == want
    assert mine(spark, *TEXTS, max_broadcast_bytes=0) == want
    monkeypatch.setattr(extraction, "MAX_BITS", 1)  # the smallest bitmap: many tokens pass in vain
    assert mine(spark, *TEXTS, max_broadcast_bytes=0) == want


def test_a_million_terms(spark):
    """No token that begins nothing is shuffled, and what is found is what is there."""
    docs = spark.createDataFrame(
        [(i, f"Plain words here and term{i} of line{i} in it. Other words only, none of them known.") for i in range(200)],
        "doc_id LONG, text STRING",
    )
    lexicon = spark.range(1_000_000).select(
        F.lit("TERM").alias("label"), F.concat(F.lit("term"), "id", F.lit(" of line"), "id").alias("term")
    )
    found = extraction.candidates(docs, Config(patterns=()), lexicon, max_broadcast_bytes=0)
    assert {(r["doc_id"], r["entity_text"]) for r in found.collect()} == {(i, f"term{i} of line{i}") for i in range(200)}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("getbit") >= 2 and "BroadcastHashJoin" not in plan.split("Subquery")[0]


@pytest.mark.parametrize("first_words", [0, 40])
def test_a_phrase_at_the_end_of_a_sentence_counts_once(spark, monkeypatch, first_words):
    """A longer phrase with the same first word does not open it a second time."""
    monkeypatch.setattr(extraction, "MAX_FIRST_WORDS", first_words)
    terms = spark.createDataFrame([("X", "motor core"), ("X", "motor core of great size"), ("X", "motor  core")], "label STRING, term STRING")
    found = extraction.candidates(docs(spark, "It is a motor core", "A motor core of great"), Config(patterns=()), terms)
    assert [(r["entity_text"], r["n_tokens"]) for r in found.collect()] == [("motor core", 2)] * 2
