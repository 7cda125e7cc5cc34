import random

import pytest

from papervein.llm import spelling
from papervein.llm.queries import op11_spelling_variants
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[0])


def test_query_against_all_pairs(spark):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert rows_of(op11_spelling_variants(spark, SF)) == brute.spelling_variants(brute.damaged_words(texts))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_dense_words(spark, seed):
    """Few letters and short words, so that nearly everything is near something."""
    rng = random.Random(seed)
    words = {"".join(rng.choice("abÿ") for _ in range(rng.randrange(5, 9))): rng.randrange(3, 40) for _ in range(300)}
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    got = sorted(tuple(r) for r in spelling.near_pairs(table).select("a", "b").collect())
    assert len(got) == len(set(got))
    want = {frozenset((a, b)) for a in words for b in words if brute.one_edit(a, b)}
    assert {frozenset(p) for p in got} == want and len(got) == len(want)


def test_every_edit_of_long_and_short_words(spark):
    words = set()
    for word in ("abcde", "abcdef", "hörgerät", "x" * 3000, "mississippi"):
        words.add(word)
        for k in range(0, len(word), max(1, len(word) // 12)):
            words |= {word[:k] + word[k + 1 :], word[:k] + "q" + word[k + 1 :], word[:k] + "q" + word[k:], word + "q"}
    table = spark.createDataFrame([(w, 3) for w in words], "word string, n long")
    got = {frozenset(tuple(r)) for r in spelling.near_pairs(table).select("a", "b").collect()}
    assert got == {frozenset((a, b)) for a in words for b in words if brute.one_edit(a, b)}


def test_chains_and_ties(spark):
    counts = {"colour": 40, "color": 9, "colors": 4, "colours": 3, "tolour": 40, "colouf": 20, "alone": 5}
    docs = [(None, " ".join(w.upper() if k % 2 else w for k in range(n))) for w, n in counts.items()]
    words = brute.damaged_words(docs)
    got = rows_of(spelling.variants(spark.createDataFrame(docs, "doc_id long, text string")))
    assert got == brute.spelling_variants(words)
    by_word = {r[0]: r for r in got}
    # Of two forms of one count the smaller in code-point order; chains end at the last form.
    assert by_word["color"][1:3] == ("colour", "colour") and by_word["alone"][1:3] == (None, "alone")
    assert by_word["colors"][1:3] in {("color", "colour"), ("color", "color"), ("colours", "colours")}


def test_long_chains(spark):
    """Forms that follow one another over many steps."""
    word, rows = "abcdefghijkl", []
    for k in range(11):
        rows.append((word, 3 * 2**k))
        word = word[:k] + "z" + word[k + 1 :]
    table = spark.createDataFrame(rows, "word string, n long")
    from papervein.llm.shared import Tables

    formed = spelling.forms(table, spelling.near_pairs(table))
    roots = {r.root for r in spelling.with_roots(Tables(spark, "roots"), formed).collect()}
    assert roots == {rows[-1][0]}


def test_odd_documents(spark, odd_documents):
    texts = [(r.doc_id, r.text) for r in odd_documents.select("doc_id", "text").collect()]
    assert rows_of(spelling.variants(odd_documents)) == brute.spelling_variants(brute.damaged_words(texts))


def test_empty(spark, no_documents):
    assert spelling.variants(no_documents).count() == 0


def test_no_python_in_the_plan(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    words = spelling.vocabulary(spelling.damaged_runs(docs))
    plan = spelling.forms(words, spelling.near_pairs(words))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
