"""The pipeline against plain versions of its stages, one after the other."""

import duckdb
import numpy as np

import corpus_pipeline
from papervein.llm import quality
from papervein.llm.queries import tokenizer_path
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def cut(texts, size):
    """Texts without repeated strings; a character that loses a byte goes whole."""
    data = {i: t.encode() for i, t in texts.items()}
    times = {}
    for b in data.values():
        for p in range(len(b) - size + 1):
            times[b[p : p + size]] = times.get(b[p : p + size], 0) + 1
    out = {}
    for i, t in texts.items():
        b, gone = data[i], set()
        for p in range(len(b) - size + 1):
            if times[b[p : p + size]] > 1:
                gone.update(range(p, p + size))
        left, at = [], 0
        for c in t:
            width = len(c.encode())
            if not gone.intersection(range(at, at + width)):
                left.append(c)
            at += width
        if "".join(left).strip(" \t\n\r\x0b\x0c"):
            out[i] = "".join(left)
    return out


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
    kept = {r.doc_id for r in quality.score(docs, quality.train(docs, labels)).where("kept").collect()}
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id in kept}
    components = brute.components({i: brute.shingles(t) for i, t in texts.items()})
    texts = cut({i: t for i, t in texts.items() if components[i] == i}, 200)
    texts = {i: t for i, t in texts.items() if not brute.benchmark_hits(t, items)[4]}

    frame = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = stage(spark, frame, SF)
        assert frame.columns == docs.columns, name
    rows = frame.collect()
    assert {r.doc_id: r.text for r in rows} == texts
    assert all(r.n_chars == len(r.text) for r in rows)

    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path())
    expected = sorted(
        (i, k, *p) for i, t in texts.items()
        for k, p in enumerate(brute.pieces(library.encode(t, add_special_tokens=False).ids, 1024))
    )
    packed = corpus_pipeline.run(spark, SF).collect()
    assert sorted(tuple(r)[:5] for r in packed) == expected
    ends = {}
    for r in sorted(packed, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= 1024 and np.mean(list(ends.values())) > 900


def test_empty_and_odd_documents(spark, odd_documents, no_documents):
    shaped = odd_documents.selectExpr("doc_id", "text", "lang", "hits AS source", "cast(length AS long) AS n_chars")
    for frame in (shaped, shaped.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            before, frame = frame, stage(spark, frame, SF)
        assert frame.count() >= 0
        assert before.columns == shaped.columns
