"""Prevalence, shares, samples, topics; hot groups and brute-force checks."""

import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from papervein.config import Config
from papervein.operators import joins, sampling, topics, trends
from papervein.operators.checkpoints import checkpoint_dir

CFG = Config()


@pytest.fixture(scope="module")
def mentions(spark):
    rng = random.Random(7)
    # A third of all rows are one category of one document.
    rows = [(0, "hot")] * 500 + [(rng.randrange(60), rng.choice("abcde")) for _ in range(1000)]
    years = [(d, None if d % 9 == 8 else 1985 + d % 45) for d in range(60)]
    return (
        rows, dict(years),
        spark.createDataFrame(rows, "doc_id LONG, category STRING"),
        spark.createDataFrame(years, "doc_id LONG, year INT"),
    )


def bucket_label(year):
    start = 1990 + (year - 1990) // 5 * 5
    return f"{start}-{start + 4}"


@pytest.mark.parametrize("mode", trends.MODES)
def test_prevalence_and_matrix(mentions, mode):
    rows, years, table, documents = mentions
    used = set(rows) if mode == "docs" else rows
    want = Counter((bucket_label(years[d]), c) for d, c in used if years[d])
    counts = trends.prevalence(table, documents, "category", CFG, mode)
    assert {(r["bucket_label"], r["category"]): r["n"] for r in counts.collect()} == dict(want)
    matrix = trends.trend_matrix(counts, "category", CFG)
    assert matrix.columns == ["category", *CFG.period_labels]
    for row in matrix.collect():
        for label in CFG.period_labels:
            assert row[label] == want[(label, row["category"])]
    totals = Counter()
    for (label, category), n in want.items():
        totals[category] += n if label in CFG.period_labels else 0
    top = trends.top_categories(counts, "category", CFG, 3).collect()
    assert [(r["category"], r["total"]) for r in top] == sorted(totals.items(), key=lambda x: (-x[1], x[0]))[:3]


def test_unknown_mode(mentions):
    with pytest.raises(ValueError):
        trends.prevalence(mentions[2], mentions[3], "category", CFG, "tokens")


def test_docs_never_exceed_mentions(mentions):
    _, _, table, documents = mentions
    both = trends.unitisation_comparison(table, documents, "category", CFG)
    for row in both.collect():
        for label in CFG.period_labels:
            assert row[f"{label}_docs"] <= row[f"{label}_mentions"]


def test_shares(mentions):
    _, _, table, documents = mentions
    counts = trends.prevalence(table, documents, "category", CFG, "mentions")
    per_period = trends.documents_per_period(documents, CFG)
    rows = trends.period_shares(counts, per_period, "category", CFG).collect()
    for label, group in itertools.groupby(sorted(rows, key=lambda r: (r["bucket_label"], r["category"])), lambda r: r["bucket_label"]):
        seen = 0
        for r in group:
            assert r["offset"] == seen
            seen += r["n"]
            share = r["n"] / r["total"] * 100
            assert r["pct"] == (round(share) if share >= 1 else None)
        assert seen == r["total"]


def test_spine(spark):
    rows = trends.period_spine(spark, CFG).orderBy("bucket").collect()
    assert [r["bucket_label"] for r in rows] == CFG.period_labels
    assert [r["is_partial"] for r in rows] == [False] * 7 + [True]


def test_samples(spark):
    rows = [(i, f"t{i}", "GRADE" if i % 3 else "STANDARD", "NGO" if i % 2 else "UNSPECIFIED", "c", i, i + 1) for i in range(300)]
    rows += [(1000 + i, "p", "PRODUCER", None, "c", i, i + 1) for i in range(4)] + [(5000, "g", "GPE", None, "c", 1, 2)]
    table = spark.createDataFrame(rows, "doc_id LONG, entity_text STRING, label STRING, scope_tag STRING, context STRING, start_char INT, end_char INT")
    sample = sampling.stratified(table, CFG).collect()
    assert Counter(r["label"] for r in sample) == {"GRADE": 25, "STANDARD": 25, "PRODUCER": 4}
    again = sampling.stratified(table.repartition(5), CFG).collect()
    assert sorted(map(str, again)) == sorted(map(str, sample))
    groups = sampling.scope_groups(table, CFG).collect()
    assert Counter(r["group"] for r in groups) == {"UNSPECIFIED": 30, "RESOLVED": 30}
    marks = spark.createDataFrame([("a", "Y")] * 25 + [("a", "N"), ("a", "n/a"), ("b", None)], "label STRING, mark STRING")
    scored = {r["label"]: r for r in sampling.precision(marks, "label").collect()}
    assert tuple(scored["a"]) == ("a", 25, 1, 1, round(25 / 26, 6))
    assert scored["b"]["precision"] is None and scored["b"]["not_scored"] == 1


def test_keyword_weights(spark):
    texts = [(0, "Iron iron loss a"), (0, "loss of iron"), (1, "price of iron"), (-1, "12 price")]
    weights = topics.keyword_weights(spark.createDataFrame(texts, "topic INT, text STRING")).collect()
    counts = Counter((t, w) for t, s in texts for w in s.lower().split() if len(w) > 1)
    total = Counter()
    for (_, w), n in counts.items():
        total[w] += n
    mean = sum(counts.values()) / 3
    want = {k: round(n * math.log(1 + mean / total[k[1]]), 6) for k, n in counts.items()}
    assert {(r["topic"], r["term"]): r["weight"] for r in weights} == pytest.approx(want, abs=2e-6)
    names = {r["topic"]: r["name"] for r in topics.topic_names(spark.createDataFrame(texts, "topic INT, text STRING"), 2).collect()}
    assert names[-1] == "-1_12_price" and names[0].startswith("0_")


def test_numbered_rows(spark):
    rows = [(i * 7919 % 1000, i) for i in range(1000)]
    df = spark.createDataFrame(rows, "a INT, b INT").repartition(6)
    got = joins.numbered_rows(df, "n", F.desc("a"), F.asc("b")).collect()
    assert [(r["a"], r["b"]) for r in sorted(got, key=lambda r: r["n"])] == sorted(rows, key=lambda r: (-r[0], r[1]))
    assert sorted(r["n"] for r in got) == list(range(1000))
    assert joins.numbered_rows(df.limit(0), "n", F.asc("a")).count() == 0


def test_vectors(spark):
    rows = [(i, ("iron loss steel " if i % 2 else "market price demand ") * 3 + str(i)) for i in range(60)]
    units = spark.createDataFrame(rows, "doc_id LONG, text STRING")
    vectors = topics.unit_vectors(units, 64)
    for r in vectors.collect():
        assert sum(x * x for x in r["vector"].toArray()) == pytest.approx(1.0)
    reduced = topics.reduce_by_pca(vectors, 2).collect()
    assert {len(r["reduced"]) for r in reduced} == {2}
    labels = {(r["doc_id"] % 2, r["topic"]) for r in topics.kmeans_topics(vectors, 2, CFG).collect()}
    assert len(labels) == 2
    unit = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "v ARRAY<DOUBLE>")
    assert [r[0] for r in unit.select(topics.normalise_vector(F.col("v"))).collect()] == [[0.6, 0.8], [0.0, 0.0]]


def test_unit_vectors_by_hand(spark):
    from pyspark.ml.feature import HashingTF

    texts = ["iron loss iron", "loss of steel", "Market price, price!", "a", "iron 12 steel"]
    words = [[w for w in re.findall(r"\w{2,}", t.lower())] for t in texts]
    place = HashingTF(numFeatures=32).indexOf
    docs_with = Counter(p for w in words for p in {place(x) for x in w})
    want = {}
    for i, w in enumerate(words):
        raw = np.zeros(32)
        for x in w:
            raw[place(x)] += math.log((len(texts) + 1) / (docs_with[place(x)] + 1))
        want[i] = raw / (np.linalg.norm(raw) or 1)
    units = spark.createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING")
    for r in topics.unit_vectors(units, 32).collect():
        assert np.allclose(r["vector"].toArray(), want[r["doc_id"]])


def planted(spark, centres, each, width=8):
    rng = np.random.default_rng(5)
    rows = []
    for c in range(centres):
        for _ in range(each):
            v = rng.normal(scale=0.05, size=width)
            v[c] += 1
            rows.append((len(rows), c, Vectors.dense(v / np.linalg.norm(v))))
    return spark.createDataFrame(rows, ["vec_id", "planted", "vector"])


def purity(rows):
    found = Counter((r["topic"], r["planted"]) for r in rows)
    best = {t: max(n for (u, _), n in found.items() if u == t) for t, _ in found}
    return sum(best.values()) / sum(found.values())


def test_principal_components_up_to_sign(spark):
    vectors = planted(spark, 4, 30)
    rows = vectors.orderBy("vec_id").collect()
    x = np.array([r["vector"].toArray() for r in rows])
    _, axes = np.linalg.eigh(np.cov(x.T))
    want = np.abs(x @ axes[:, ::-1][:, :3])
    got = np.abs([r["reduced"] for r in topics.reduce_by_pca(vectors, 3).orderBy("vec_id").collect()])
    assert np.allclose(got, want, atol=1e-6)


def test_kmeans_finds_planted_groups(spark):
    assert purity(topics.kmeans_topics(planted(spark, 4, 40), 4, CFG).collect()) > 0.95


def test_planted_subjects_from_callers_vectors(spark):
    """Groups planted in given vectors come out as topics, with few units left as noise."""
    units = planted(spark, 3, 120).selectExpr(
        "vec_id AS doc_id", "concat(vec_id, '_0') AS unit_id", "concat('subject', planted, ' text') AS text", "planted", "vector"
    ).cache()
    cfg = Config(reduced_dims=2, radius=0.3, min_points=4)
    rows = topics.cluster(units, cfg).join(units.select("unit_id", "planted"), "unit_id").collect()
    real = [r for r in rows if r["topic"] != topics.NOISE]
    assert len(rows) == 360 and len(real) > 0.7 * 360
    assert purity(real) > 0.95 and len({r["topic"] for r in real}) == 3
    assert all("subject" in r["topic_name"] for r in real)


def test_largest_topics(spark):
    units = spark.createDataFrame([(t,) for t in [-1] * 9 + [0] * 5 + [1] * 5 + [2]], "topic INT")
    rows = topics.largest(units, 2, (1,)).collect()
    assert [tuple(r) for r in rows] == [(0, 5, False), (1, 5, True)]


def test_checkpoint_folder_comes_from_the_session(spark):
    assert checkpoint_dir(spark) == checkpoint_dir(spark)
    assert spark.sparkContext.getCheckpointDir()
