import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from papervein.llm import suffix_dedup
from papervein.llm.suffix_order import suffix_order
from tests.llm import brute

SF = "/root/testdata/sf0.001"


@settings(max_examples=120, deadline=None)
@given(st.lists(st.integers(1, 3), max_size=120), st.sampled_from([1, 2, 3, 5, 9, 20, 500]))
def test_suffix_order(symbols, depth):
    order = suffix_order(np.array(symbols, np.int64), depth)
    assert sorted(order.tolist()) == list(range(len(symbols)))
    prefixes = [symbols[p : p + depth] for p in order]
    assert prefixes == sorted(prefixes)


def test_suffix_order_of_many_names():
    rng = np.random.default_rng(1)
    symbols = rng.integers(1, 1 << 40, 3000)
    symbols[1000:2000] = symbols[2000:3000]
    order = suffix_order(symbols, 50)
    prefixes = [symbols[p : p + 50].tolist() for p in order]
    assert prefixes == sorted(prefixes) and len(set(order.tolist())) == 3000


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(min_size=12, max_size=60).map(lambda b: bytes(c % 2 for c in b)), min_size=1, max_size=8))
def test_repeated_windows(contexts):
    windows = [len(c) - 11 for c in contexts]
    masks = suffix_dedup.repeated_windows(contexts, windows, 12)
    times = Counter(c[p : p + 12] for c, n in zip(contexts, windows) for p in range(n))
    for c, n, mask in zip(contexts, windows, masks):
        assert mask.tolist() == [times[c[p : p + 12]] > 1 for p in range(n)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab", max_size=60), max_size=6), st.integers(2, 8))
def test_equal_windows_have_equal_seeds(texts, gram):
    import pyarrow as pa

    length, seeds, again = 9, {}, {}
    for row, first, windows, seed, _, more in suffix_dedup._all_runs(pa.array(texts, pa.string()), length, min(gram, 9)):
        for r, f, w, s, m in zip(row, first, windows, seed, more):
            for p in range(f, f + w):
                seeds.setdefault(texts[r][p : p + length], set()).add(s)
                again.setdefault(texts[r][p : p + length], []).append(((r, f), m))
    assert sum(map(len, again.values())) == sum(max(0, len(t) - length + 1) for t in texts)
    assert all(len(s) == 1 for s in seeds.values())
    for places in again.values():
        runs = {run for run, _ in places}
        if len(places) > 1 and len(runs) == 1:
            assert places[0][1]  # repeats within one run are announced


def rows_of(docs, **options):
    return sorted(tuple(r) for r in suffix_dedup.digest(docs, **options).collect())


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randrange(1, 7)))
    passage = " ".join(word() for _ in range(30))
    texts = [None, "", "short", "z" * 300, "ab" * 150, "same old words " * 20]
    for _ in range(25):
        base = [word() for _ in range(rng.randrange(5, 120))]
        for _ in range(rng.choice([1, 1, 2, 4])):
            own = list(base)
            for _ in range(rng.randrange(3)):
                own[rng.randrange(len(own))] = word()
            texts.append(" ".join(own))
    texts += [word() * 3 + " " + passage + " " + " ".join(word() for _ in range(20)) for _ in range(30)]
    texts += [texts[10]] * 5
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("length,gram,task", [(40, 16, 1 << 18), (40, 16, 300), (25, 25, 1 << 18)])
def test_against_all_windows(spark, monkeypatch, length, gram, task):
    monkeypatch.setattr(suffix_dedup, "TASK_BYTES", task)
    texts = list(enumerate(corpus(length + gram + task)))
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    expected = brute.repeated_spans(texts, length)
    assert rows_of(docs, length=length, gram=gram) == sorted((i, *expected[i]) for i, _ in texts)


def test_long_texts_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE_BYTES", 64)
    texts = list(enumerate(corpus(5)))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    found = []
    import pyarrow as pa

    for row, first, windows, *_ in suffix_dedup._all_runs(pa.array([t for _, t in texts], pa.string()), 40, 16):
        found += [(int(r), int(p)) for r, f, w in zip(row, first, windows) for p in range(f, f + w)]
    expected = [(r, p) for r, t in texts for p in range(len((t or "").encode()) - 39)]
    assert sorted(found) == expected


def test_query(spark):
    from papervein.llm.queries import op5_suffix_array_dedup

    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    expected = brute.repeated_spans(texts, 200)
    rows = sorted(tuple(r) for r in op5_suffix_array_dedup(spark, SF).collect())
    assert rows == sorted((i, *expected[i]) for i, _ in texts)
    assert any(r[2] for r in rows)


def test_odd_documents(spark, odd_documents, no_documents):
    rows = odd_documents.select("doc_id", "text").collect()
    expected = brute.repeated_spans([(k, r.text) for k, r in enumerate(rows)], 30)
    got = suffix_dedup.digest(odd_documents, 30, 10).collect()
    assert sorted((str(r.doc_id), *tuple(r)[1:]) for r in got) == sorted(
        (str(r.doc_id), *expected[k]) for k, r in enumerate(rows)
    )
    left = suffix_dedup.remove(odd_documents, 30, 10)
    assert left.columns == odd_documents.columns
    assert suffix_dedup.digest(no_documents).count() == 0
    assert suffix_dedup.remove(no_documents).count() == 0


def test_remove_keeps_characters_whole(spark):
    # The repeated bytes begin within a character: é is C3 A9, ũ is C5 A9.
    tail = "-" * 5 + "0123456789" * 2
    texts = [(1, "start é" + tail), (2, "other ũ" + tail), (3, "alone and unlike anything else"), (4, tail)]
    docs = spark.createDataFrame([(i, t, len(t)) for i, t in texts], "doc_id long, text string, n_chars long")
    rows = {r.doc_id: (r.text, r.n_chars) for r in suffix_dedup.remove(docs, 20, 8).collect()}
    assert rows[3] == (texts[2][1], 30)
    assert rows[1] == ("start ", 6) and rows[2] == ("other ", 6) and 4 not in rows


def test_remove_leaves_columns_named_like_helpers(spark, odd_documents):
    own = odd_documents.selectExpr("*", "concat('n', hits) AS _id", "1.5D AS _Text_key", "array(doc_id) AS _intervals", "true AS __id")
    left = suffix_dedup.remove(own, 30, 10)
    assert left.schema == own.schema
    plain = suffix_dedup.remove(odd_documents, 30, 10).collect()
    assert sorted(map(repr, plain)) == sorted(repr(r) for r in left.select(*odd_documents.columns).collect())
    assert {(r._id, r._Text_key, r["__id"]) for r in left.collect()} == {("nx", 1.5, True)}
    assert all(r._intervals == [r.doc_id] for r in left.collect())
