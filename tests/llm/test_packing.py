import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from papervein.llm import packing, tokens
from papervein.llm.queries import tokenizer_path
from tests.llm import brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def test_ids_are_the_librarys(odd_texts, library):
    encoder = tokens.Encoder(tokenizer_path())
    for text in odd_texts:
        expected = library.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(encoder.ids(text or ""), "<u4").tolist() == expected


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet="aBé7 ½²中_-'s\n\t.\x1c …“ǅ²🙂d", max_size=40))
def test_ids_of_random_texts(text):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path())
    encoder = tokens.encoder(tokenizer_path())
    assert np.frombuffer(encoder.ids(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def check_layout(rows, capacity):
    """No overlap, no gap, nothing beyond the capacity."""
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in by.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= capacity
    return len(by)


def test_query(spark, library):
    from papervein.llm.queries import op9_best_fit_packing

    rows = op9_best_fit_packing(spark, SF).collect()
    expected = []
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        expected += [(r.doc_id, k, *p) for k, p in enumerate(brute.pieces(ids, 1024))]
    assert sorted(tuple(r)[:5] for r in rows) == sorted(expected)
    sequences = check_layout(rows, 1024)
    assert sequences <= 1.02 * -(-sum(r.length for r in rows) // 1024) + 1


def test_odd_documents(spark, odd_documents, no_documents):
    rows = packing.pack(odd_documents, tokenizer_path(), 16).collect()
    check_layout(rows, 16)
    assert {r.doc_id for r in rows} == {r.doc_id for r in odd_documents.collect()}
    assert packing.pack(no_documents, tokenizer_path()).count() == 0


def test_many_blocks(spark, odd_documents, monkeypatch):
    """Ranks run through many partitions, also if the partitions' counts are joined by a shuffle."""
    monkeypatch.setattr(packing, "OFFSETS_BROADCAST_BYTES", 0)
    odd_documents = odd_documents.repartition(7)
    rows = packing.pack(odd_documents, tokenizer_path(), 16).collect()
    check_layout(rows, 16)


def fewest(lengths, capacity):
    """The least number of sequences, by trying everything."""
    lengths = sorted(lengths, reverse=True)
    best = [len(lengths)]

    def go(k, rooms):
        if len(rooms) >= best[0]:
            return
        if k == len(lengths):
            best[0] = len(rooms)
            return
        tried = set()
        for n, room in enumerate(rooms):
            if room >= lengths[k] and room not in tried:
                tried.add(room)
                go(k + 1, rooms[:n] + [room - lengths[k]] + rooms[n + 1 :])
        go(k + 1, [*rooms, capacity - lengths[k]])

    go(0, [])
    return best[0]


def unpacked(runs):
    out = {}
    for r in runs:
        for k in range(r.bins * r.each):
            out.setdefault(r.sequence + k // r.each, []).append((r.offset + k % r.each * r.length, r.length))
    return out


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=9))
def test_reduction_keeps_the_optimum(lengths):
    counts = np.bincount(lengths, minlength=21)
    plan = packing._Plan(counts, 20)
    fixed = packing.reduce(plan)
    rest = [x for x, n in enumerate(plan.left) for _ in range(n)]
    assert fixed + fewest(rest, 20) == fewest(lengths, 20)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 50), st.integers(1, 30)), max_size=30))
def test_plan_places_everything_once(pairs):
    counts = np.zeros(51, np.int64)
    for length, n in pairs:
        counts[length] += n
    runs, sequences = packing.make_plan(counts, 50)
    bins = unpacked(runs)
    assert len(bins) == sequences
    placed = np.zeros(51, np.int64)
    for own in bins.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
            placed[length] += 1
        assert end <= 50
    assert (placed == counts).all()
    ranks = {}
    for r in runs:
        ranks.setdefault(r.length, []).append((r.first, r.bins * r.each))
    for own in ranks.values():
        end = 0
        for first, n in sorted(own):
            assert first == end
            end += n


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=60))
def test_best_fit_is_the_plain_one(lengths):
    plan = packing._Plan(np.bincount(lengths, minlength=31), 30)
    packing.best_fit(plan)
    rooms = []
    for length in sorted(lengths, reverse=True):
        fitting = [k for k, room in enumerate(rooms) if room >= length]
        if fitting:
            rooms[min(fitting, key=lambda k: rooms[k])] -= length
        else:
            rooms.append(30 - length)
    got = sorted(30 - sum(n for _, n in own) for own in unpacked(plan.runs).values())
    assert got == sorted(rooms)


def test_ids_are_packed_whole(spark, odd_documents, library):
    docs = odd_documents.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    packed = packing.pack(docs, tokenizer_path(), 16)
    rows = packed.collect()
    by = {}
    for r in sorted(rows, key=lambda r: (r.doc_id, r.piece)):
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length and len(by.setdefault(r.doc_id, [])) == r.start
        by[r.doc_id] += ids
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    assert by == {i: [*library.encode(t, add_special_tokens=False).ids, 2] for i, t in texts.items()}
    whole = {r.sequence_id: bytes(r.ids) for r in packing.sequences(packed).collect()}
    assert len(whole) == len({r.sequence_id for r in rows})
    assert sum(map(len, whole.values())) == 4 * sum(r.length for r in rows)
    # Pieces of equal length may change places between two runs, so the ids are compared in all.
    assert sorted(x for w in whole.values() for x in np.frombuffer(w, "<u4")) == sorted(x for own in by.values() for x in own)


def test_pipeline_returns_the_ids(spark, odd_documents):
    import zlib

    import corpus_pipeline

    rows = corpus_pipeline.best_fit_packing(spark, odd_documents, SF).collect()
    assert rows and all(len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32 for r in rows)


def test_ids_of_two_and_four_bytes(spark):
    """A vocabulary beyond 65,536 ids keeps four bytes; the packed ids are the same."""
    docs = spark.createDataFrame([(1, "some text"), (2, None), (3, "more text " * 900)], "doc_id long, text string")
    narrow = packing.pack(docs, tokenizer_path()).collect()
    assert packing.id_type(tokenizer_path(), 2) == "<u2"
    assert packing.id_type(tokenizer_path(), 70_000) == "<u4"
    wide = packing.pack(docs, tokenizer_path(), end_id=70_000).collect()
    for a, b in zip(sorted(narrow), sorted(wide)):
        x, y = np.frombuffer(a.ids, "<u4"), np.frombuffer(b.ids, "<u4")
        assert len(x) == len(y) == a.length and (x[:-1] == y[:-1]).all() and (x[-1] == y[-1] or (x[-1], y[-1]) == (2, 70_000))


def test_no_shuffle_of_ids(spark):
    docs = spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    plan = packing.pack(docs, tokenizer_path())._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and all("ids" not in line for line in plan.splitlines() if "Exchange hash" in line)
