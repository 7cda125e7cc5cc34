import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from papervein.llm import boosting, quality
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def measured(texts):
    stats = quality.measure(pa.array(texts, pa.string()))
    return [tuple(int(stats[n][i]) for n in quality.COUNTS) for i in range(len(texts))]


def test_counts_of_odd_texts(odd_texts):
    assert measured(odd_texts) == [brute.quality_counts(t) for t in odd_texts]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet="ab é#\n\t中", max_size=80), max_size=12))
def test_counts_of_random_texts(texts):
    assert measured(texts) == [brute.quality_counts(t) for t in texts]


def test_slices_do_not_change_counts(odd_texts, monkeypatch):
    from papervein.llm import batches

    monkeypatch.setattr(batches.slices, "__defaults__", (64,))
    assert measured(odd_texts) == [brute.quality_counts(t) for t in odd_texts]


def test_query_counts(spark):
    from papervein.llm.queries import op4_quality_rules

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op4_quality_rules(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        counts = brute.quality_counts(texts[r.doc_id])
        assert tuple(r[1:6]) == counts
        assert r.base_failed == (counts[0] < 10 or 100 * counts[4] > 20 * counts[0])
        assert not (r.base_failed and r.kept)
    # The verdict of the trees, walked node by node.
    forest = quality.train(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    ids = sorted(texts)
    features = quality.matrix(quality.measure(pa.array([texts[i] for i in ids], pa.string())))
    walked = {i: brute.walked(forest, row) for i, row in zip(ids, features)}
    for r in rows:
        assert abs(walked[r.doc_id] - r.quality_score) < 1e-9
        assert r.kept == (not r.base_failed and walked[r.doc_id] >= quality.Rules().keep_from)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    x, y = quality.labelled_sample(docs, labels)
    held = np.arange(len(x)) % 3 == 0
    p = quality.fit(x[~held], y[~held]).probability(x[held])
    assert ((p >= 0.5) == (y[held] == 1)).mean() > 0.95
    assert (p[y[held] == 1] >= 0.5).mean() > 0.98


def test_odd_documents(spark, odd_documents, no_documents, odd_texts):
    labels = spark.createDataFrame([(3, 1), (None, 0), (5, None), (7, 0)], "doc_id long, quality int")
    forest = quality.train(odd_documents, labels)
    rows = quality.score(odd_documents, forest).collect()
    assert len(rows) == len(odd_texts) + 2
    assert all(r.base_failed and not r.kept for r in rows if r.n_words < 10)
    kept = quality.keep_good(odd_documents, forest)
    assert kept.columns == odd_documents.columns
    assert kept.count() == sum(r.kept for r in rows)
    empty = quality.train(no_documents, labels.limit(0))
    assert quality.score(no_documents, empty).count() == 0
    assert quality.keep_good(no_documents, empty).count() == 0


def test_sample_bound(spark):
    docs = spark.range(100).selectExpr("id AS doc_id", "repeat('w ', 20) AS text")
    labels = spark.range(100).selectExpr("id AS doc_id", "cast(id % 2 AS int) AS quality")
    x, y = quality.labelled_sample(docs, labels, quality.Rules(sample_rows=30))
    assert x.shape == (30, len(quality.FEATURES)) and len(y) == 30


@pytest.mark.parametrize("sign", [1, -1])
def test_monotone(sign):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(2000, 3))
    y = (sign * x[:, 0] + np.sin(6 * x[:, 1]) + rng.normal(size=2000) * 0.7 > 0).astype(float)
    free = boosting.fit(x, y)
    forest = boosting.fit(x, y, monotone={0: sign})
    grid = np.linspace(-3, 3, 200)
    for other in rng.normal(size=(20, 2)):
        line = np.column_stack([grid, np.tile(other, (200, 1))])
        assert (sign * np.diff(forest.margin(line)) >= -1e-12).all()
    accuracy = ((forest.probability(x) > 0.5) == y).mean()
    assert accuracy > 0.8 and accuracy > ((free.probability(x) > 0.5) == y).mean() - 0.08


def test_forest_matches_walk():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(500, 2))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    f = boosting.fit(x, y, trees=5)
    for row in x[:50]:
        total = f.base
        for at in f.roots:
            while f.left[at] != at:
                at = f.left[at] if row[f.feature[at]] <= f.threshold[at] else f.right[at]
            total += f.value[at]
        assert np.isclose(total, f.margin(row[None])[0])
