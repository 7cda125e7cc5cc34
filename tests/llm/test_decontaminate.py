from hypothesis import given, settings
from hypothesis import strategies as st
import pyarrow as pa

from papervein.llm import decontaminate
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def rows_of(spark, docs, items, size=10):
    bench = spark.createDataFrame(items, "item_id long, text string")
    return decontaminate.digest(decontaminate.search(docs, bench, size))


def test_query(spark):
    from papervein.llm.queries import op6_decontamination

    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = op6_decontamination(spark, SF).collect()
    assert {r.doc_id: tuple(r)[1:] for r in rows} == {i: brute.benchmark_hits(t, items) for i, t in docs.items()}
    assert any(r.contaminated for r in rows)


ITEMS = [
    (1, "one"), (2, "Two words"), (3, None), (4, ""), (5, "a b c d e a b c d e a"), (6, "one"),
    (None, "twelve"), (7, "lower cased here, twelve words in all"), (10, "### !!!"),
    (8, "mixed case words are lower cased here twelve words in all"), (-9, "e a b c d e a b c d"),
]


def test_odd_documents(spark, odd_documents, no_documents):
    expected = sorted(
        ((r.doc_id is None, r.doc_id or 0), brute.benchmark_hits(r.text, [i for i in ITEMS if i[0] is not None]))
        for r in odd_documents.collect()
    )
    rows = rows_of(spark, odd_documents, ITEMS).collect()
    assert sorted(((r.doc_id is None, r.doc_id or 0), tuple(r)[1:]) for r in rows) == expected
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    clean = decontaminate.keep_clean(odd_documents, bench)
    assert clean.columns == odd_documents.columns
    assert clean.count() == sum(not r.contaminated for r in rows)
    assert rows_of(spark, no_documents, ITEMS).count() == 0
    assert rows_of(spark, odd_documents, []).where("contaminated").count() == 0


def test_blocks_of_items(spark, odd_documents, monkeypatch):
    whole = sorted(map(str, rows_of(spark, odd_documents, ITEMS).collect()))
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    clean = decontaminate.keep_clean(odd_documents, bench).count()
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 80)
    assert len(list(decontaminate._blocks(bench))) > 2
    assert sorted(map(str, rows_of(spark, odd_documents, ITEMS).collect())) == whole
    assert decontaminate.keep_clean(odd_documents, bench).count() == clean


text = st.lists(st.sampled_from(["a", "b", "cc", "é", "7"]), max_size=40).map(" ".join)


@settings(max_examples=40, deadline=None)
@given(st.lists(text, max_size=6), st.lists(text, max_size=5), st.integers(1, 4))
def test_random(docs, items, size):
    items = list(enumerate(items))
    patterns = decontaminate.compile_patterns(items, size)
    got = [
        (n, int(mask.sum()), found)
        for n, mask, found in decontaminate._matches(patterns, pa.array(docs, pa.string()))
    ]
    for (n, hit, found), doc in zip(got, docs):
        expected = brute.benchmark_hits(doc, items, size)
        assert (n, hit, len(found)) == expected[:3]
    assert len(got) == len(docs)


def test_items_without_id(spark):
    """Their windows count as hits and contaminate; only the list of items leaves them out."""
    words = "one two three four five six seven eight nine ten eleven twelve"
    docs = spark.createDataFrame([(1, f"before {words} after"), (2, "clean text"), (3, f"{words} and more of item five")], "doc_id long, text string")
    items = [(None, words), (None, None), (5, "more of item five"), (None, "")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: tuple(r)[1:] for r in decontaminate.digest(decontaminate.search(docs, benchmark)).collect()}
    assert got == {r.doc_id: brute.benchmark_hits(r.text, items) for r in docs.collect()}
    assert got[1][1:3] == (12, 0) and got[1][4]
    assert [r.doc_id for r in decontaminate.keep_clean(docs, benchmark).collect()] == [2]
