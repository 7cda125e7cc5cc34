import random

import numpy as np
import pytest

from papervein.llm import components, near_dup
from papervein.llm.shared import Tables
from tests.llm import brute


def expected_of(texts):
    sets = {i: brute.shingles(t) for i, t in texts.items()}
    comps = brute.components(sets)
    return sorted((i, len(sets[i]), comps[i], comps[i] == i) for i in texts)


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001"])
def test_query(spark, folder):
    from papervein.llm.queries import op2_minhash_near_dedup

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = sorted(tuple(r) for r in op2_minhash_near_dedup(spark, folder).collect())
    assert rows == expected_of(texts)
    assert any(not r[3] for r in rows)


def varied(rng, words, changes):
    words = list(words)
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"v{rng.randrange(10**6)}"
    return " ".join(words)


def corpus(seed):
    """Groups of copies of many sizes and strengths, a passage that many share, odd texts."""
    rng = random.Random(seed)
    passage = [f"p{k}" for k in range(40)]
    texts = []
    for group in range(25):
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.randrange(3, 160))]
        if group % 3 == 0:
            base = base[:60] + passage
        for _ in range(rng.choice([1, 2, 3, 8])):
            texts.append(varied(rng, base, rng.randrange(0, 5)))
    base = [f"b{k}" for k in range(150)]
    texts += [varied(rng, base, rng.randrange(0, 7)) for _ in range(60)]
    texts += [" ".join(passage + [f"q{rng.randrange(10**6)}" for _ in range(30)]) for _ in range(50)]
    texts += [None, "", "  ", "one", "ONE", "one two", "a b c d", "a b c d", "a b c d e", "x " * 500]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("small,depth", [(16, 3), (4, 1)])
def test_against_all_pairs(spark, small, depth):
    texts = dict(enumerate(corpus(small * 10 + depth)))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    found = near_dup.classify(docs, near_dup.Search(small=small, depth=depth))
    assert sorted(tuple(r) for r in found.collect()) == expected_of(texts)


def test_odd_documents(spark, odd_documents, no_documents):
    rows = near_dup.classify(odd_documents).collect()
    texts = {r.doc_id: r.text for r in odd_documents.collect()}
    loose = [r for r in rows if r.doc_id is None]
    assert len(loose) == 1 and loose[0].component_id is None and loose[0].kept
    texts.pop(None)
    assert sorted({tuple(r) for r in rows if r.doc_id is not None}) == expected_of(texts)
    assert len(rows) == odd_documents.count()
    kept = near_dup.keep_first(odd_documents)
    assert kept.columns == odd_documents.columns
    assert kept.where("doc_id IS NOT NULL").count() == sum(r[3] for r in expected_of(texts))
    assert near_dup.classify(no_documents).count() == 0
    assert near_dup.keep_first(no_documents).count() == 0


@pytest.mark.parametrize("edges", [
    [], [(1, 1)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(50)],
    [(random.Random(9).randrange(60) * k % 97, k) for k in range(97)],
])
def test_components(spark, edges):
    df = spark.createDataFrame(edges, "u long, v long")
    got = {r.id: r.label for r in components.connected(Tables(spark, "test"), df).collect()}
    parent = {}

    def root(i):
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i

    for a, b in edges:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    assert got == {i: root(i) for i in list(parent) if root(i) != i}


def test_one_id_with_two_texts(spark):
    rng = random.Random(6)
    base = [[f"{g}{k}" for k in range(80)] for g in "abcd"]
    texts = [" ".join(b) for b in base]
    rows = [
        (5, texts[0]), (5, texts[1]), (5, texts[1]),  # one id, two texts, one of them repeated
        (3, varied(rng, base[0], 1)),                 # near the first only
        (9, texts[2]), (9, varied(rng, base[2], 1)),  # one id, two near texts
        (7, texts[3]), (None, texts[0]), (8, ""), (8, texts[3].upper()),
    ]
    docs = spark.createDataFrame([(*r, n) for n, r in enumerate(rows)], "doc_id long, text string, row int").repartition(3)
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in near_dup.classify(docs).collect())
    assert len(got) == len(rows)
    assert sorted(g[2:] for g in got if g[0] == "5") == [("3", False), ("5", True), ("5", True)]
    assert sorted(g[3] for g in got if g[0] == "9") == [False, True]
    kept = near_dup.keep_first(docs)
    assert kept.schema == docs.schema
    out = kept.collect()
    assert sorted((str(r.doc_id), r.text) for r in out if r.doc_id != 9) == sorted(
        [("3", rows[3][1]), ("5", texts[1]), ("7", texts[3]), ("8", ""), ("None", texts[0])]
    )
    assert [r.text in (rows[4][1], rows[5][1]) for r in out if r.doc_id == 9] == [True]


def test_intersections():
    rng = np.random.default_rng(3)
    for count, most in ((1, 5), (7, 0), (40, 30), (60, 9000)):
        sets = [np.unique(rng.integers(0, 12_000, rng.integers(0, most + 1)).astype(np.uint64)) for _ in range(count)]
        sizes, common = near_dup._intersections(sets)
        assert sizes.tolist() == [len(s) for s in sets]
        for i in range(count):
            for j in range(count):
                assert common[i, j] == len(np.intersect1d(sets[i], sets[j]))


def test_a_hub_and_its_copies(spark):
    """Copies near to one text, but not to each other, of which there are more than a node takes."""
    rng = random.Random(11)
    base = [f"h{k}" for k in range(200)]
    texts = {0: " ".join(base)} | {i: varied(rng, base, 4) for i in range(1, 120)}
    texts |= {i: varied(rng, base, 60) for i in range(120, 200)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    found = near_dup.classify(docs, near_dup.Search(small=16, depth=5))
    assert sorted(tuple(r) for r in found.collect()) == expected_of(texts)


def test_one_id_repeated_by_many_rows(spark):
    text = " ".join(f"w{k}" for k in range(60))
    rows = [(4, text)] * 300 + [(2, text + " more"), (9, "something else altogether, of its own")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = near_dup.classify(docs).collect()
    assert len(got) == 302 and {(r.doc_id, r.component_id) for r in got} == {(4, 2), (2, 2), (9, 9)}
    assert near_dup.keep_first(docs).select("doc_id").distinct().count() == 2


def test_recall_at_the_threshold(spark):
    """Pairs of texts just above 0.75 that have no other link: 0.9 and more are to be found."""
    rng = random.Random(12)
    texts, linked = {}, set()
    for g in range(150):
        base = [f"g{g}w{k}" for k in range(110)]
        texts[2 * g], texts[2 * g + 1] = " ".join(base), varied(rng, base, 3)
        a, b = brute.shingles(texts[2 * g]), brute.shingles(texts[2 * g + 1])
        if 75 * len(a | b) <= 100 * len(a & b):
            linked.add(2 * g + 1)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    found = {r.doc_id for r in near_dup.classify(docs).collect() if not r.kept}
    assert found == linked and len(linked) > 100


def test_verdicts_of_halves():
    """What 32 bits cannot tell is never called sure, and nothing that is linked is missed."""
    rng = np.random.default_rng(8)
    for _ in range(300):
        union, share = int(rng.integers(4, 400)), rng.uniform(0.7, 0.8)
        common = min(union, round(share * union))
        a = common + int(rng.integers(0, union - common + 1))
        b = union - a + common
        sure, may = near_dup._verdicts(common, a, b, a, b, 75)
        linked = 100 * common >= 75 * union
        assert may >= linked >= sure
        # Halves that are shared within a set hide common shingles; chance repeats feign some.
        sure, may = near_dup._verdicts(common - 1, a, b, a - 1, b - 2, 75)
        assert may >= linked >= sure
        sure, _ = near_dup._verdicts(common + 2, a, b, a, b, 75)
        assert linked >= sure


def test_large_nodes_with_few_outsiders(spark):
    """A group that is one component but for some texts, and these among themselves."""
    rng = random.Random(13)
    base = [f"h{k}" for k in range(120)]
    texts = {i: varied(rng, base, rng.randrange(3)) for i in range(90)}
    texts |= {i: varied(rng, base, 14) for i in range(90, 100)}
    texts |= {i: texts[95] + f" x{i}" for i in range(100, 104)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    found = near_dup.classify(docs, near_dup.Search(small=20, depth=3))
    assert sorted(tuple(r) for r in found.collect()) == expected_of(texts)


def test_small_tables_are_not_spread_over_all_partitions(spark):
    """However many shuffle partitions there are, few labels are written by few tasks."""
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    before = [spark.conf.get(n) for n in names]
    try:
        for name, value in zip(names, ("150", "false")):
            spark.conf.set(name, value)
        edges = spark.createDataFrame([(k // 2, k) for k in range(1, 400)], "u long, v long")
        labels = components.connected(Tables(spark, "test"), edges)
        assert {(r.id, r.label) for r in labels.collect()} == {(k, 0) for k in range(1, 400)}
        assert len(labels.inputFiles()) <= spark.sparkContext.defaultParallelism
    finally:
        for name, value in zip(names, before):
            spark.conf.set(name, value)


def test_no_shuffle_files_stay_and_tokens_are_written_once(spark):
    """A written table's shuffle files go at once, and the minwise tokens are kept with the sets alone."""
    import time

    tables = Tables(spark, "test-shuffles")
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        files = blocks.getAllFiles()
        return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}

    before = shuffled()
    tables.write(spark.range(1000).repartition(7).groupBy("id").count())
    end = time.time() + 20
    while shuffled() - before and time.time() < end:
        time.sleep(0.2)
    assert not shuffled() - before

    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f"), (3, "g")], "doc_id long, text string")
    found = tables.write(near_dup.profiles(docs), "profiles")
    rows = near_dup._classified(found, docs, tables, near_dup.Search())
    assert sorted(tuple(r) for r in rows.collect()) == [(1, 2, 1, True), (2, 2, 1, False), (3, 1, 3, True)]
    path = spark._jvm.org.apache.hadoop.fs.Path(found.shared_path)
    assert not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
