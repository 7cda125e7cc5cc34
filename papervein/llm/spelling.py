"""Spelling variants grouped by asymmetric chunks.

Words are counted over all texts.  Two words are near if one code point inserted, deleted or
replaced turns one into the other.  To find such pairs, the longer word (or either of two
equally long ones) of L code points contributes two disjoint chunks of L div 2 code points;
one edit leaves one of them whole.  The other word contributes its positional grams of that
size.  A chunk and a gram meet on their content, the chunk's number and L, and only within
the shift that one edit allows: none for equal lengths, at most one to the left for a word
that is one shorter.  So of all grams only those within one place of a chunk are written,
five a word at most, however long the word.  Candidates are then verified exactly.

Everything is DataFrame functions: there is no Python code in the tasks.

Defined cases: a null text has no words; a null id counts as an empty one in the check sum;
repeated rows count again; equal counts fall to the smallest word in code-point order.  A
word without near words is its own root.  No documents give no words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from papervein.llm.shared import Tables

RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def damaged_runs(docs: DataFrame, one_in: int = 97) -> DataFrame:
    """``word``: every lower-cased run of letters, one in ``one_in`` short of a code point.

    Which runs lose which code point follows from the CRC-32 of ``<doc_id>:<run>``.
    """
    lowered = F.translate(F.coalesce(F.col("text"), F.lit("")), UPPER, LOWER)
    runs = docs.select(
        F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":")).alias("_id"),
        F.explode(F.regexp_extract_all(lowered, F.lit(RUN), F.lit(0))).alias("_run"),
    )
    code = F.crc32(F.encode(F.concat("_id", "_run"), "UTF-8"))
    place = (code % F.length("_run")).cast("int")
    shorter = F.concat(
        F.substring("_run", F.lit(1), place), F.substring("_run", place + 2, F.length("_run"))
    )
    return runs.select(F.when(code % one_in == 0, shorter).otherwise(F.col("_run")).alias("word"))


def vocabulary(occurrences: DataFrame, min_length: int = 5, min_count: int = 3) -> DataFrame:
    """``(word, n)`` of every word that is long and frequent enough, n over all occurrences."""
    counted = occurrences.where(F.length("word") >= min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= min_count)


def _key(length: Column, chunk: int, content: Column) -> Column:
    return F.xxhash64(length, F.lit(chunk), content)


def _letters(word: Column) -> Column:
    """A set of the word's code points, hashed to 64 bits; one edit changes at most two of them."""
    return F.aggregate(
        F.split(word, ""), F.lit(0).cast("long"),
        lambda seen, c: seen.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.ascii(c) % 64)),
    )


def near_pairs(words: DataFrame) -> DataFrame:
    """``(a, a_n, b, b_n)``: every pair of words one edit apart, once; ``a`` is not the shorter."""
    sized = words.select("word", "n", F.length("word").alias("_length"), _letters(F.col("word")).alias("_letters"))
    half = F.floor(F.col("_length") / 2).cast("int")
    chunks = sized.select(
        F.explode(F.array(*[
            _key(F.col("_length"), c, F.substring("word", half * c + 1, half)) for c in (0, 1)
        ])).alias("key"),
        F.col("word").alias("a"), F.col("n").alias("a_n"), F.col("_length").alias("a_length"),
        F.col("_letters").alias("a_letters"),
    )
    grams = []
    for longer in (0, 1):
        other = F.col("_length") + longer
        size = F.floor(other / 2).cast("int")
        for c in (0, 1):
            for shift in range(-longer, 1):
                at = size * c + shift
                inside = (at >= 0) & (at + size <= F.col("_length"))
                grams.append(F.when(inside, _key(other, c, F.substring("word", at + 1, size))))
    grammed = sized.select(
        F.explode(F.array_distinct(F.array_compact(F.array(*grams)))).alias("key"),
        F.col("word").alias("b"), F.col("n").alias("b_n"), F.col("_length").alias("b_length"),
        F.col("_letters").alias("b_letters"),
    )
    candidate = (
        ((F.col("a_length") > F.col("b_length")) | (F.col("a") < F.col("b")))
        & (F.bit_count(F.col("a_letters").bitwiseXOR(F.col("b_letters"))) <= 2)
    )
    met = chunks.join(grammed, "key").where(candidate).where(F.levenshtein("a", "b", 1) == 1)
    return met.select("a", "a_n", "b", "b_n").distinct()


def forms(words: DataFrame, pairs: DataFrame, ratio: int = 2) -> DataFrame:
    """``(word, n, n_near, form, form_n)`` of every word.

    A word's form is its most frequent near word, if at least ``ratio`` times as frequent.
    """
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("b_n").alias("other_n")).union(
        pairs.select("b", "a", "a_n")
    )
    best = both.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("_n"), "other")).alias("_best")
    )
    joined = words.join(best, "word", "left")
    enough = -F.col("_best._n") >= ratio * F.col("n")
    return joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(enough, F.col("_best.other")).alias("form"), F.when(enough, -F.col("_best._n")).alias("form_n"),
    )


def with_roots(tables: Tables, formed: DataFrame) -> DataFrame:
    """Add ``root``: the last of the forms that follow one another from the word.

    Counts at least double from form to form, so there is no circle.  Each round replaces the
    root by the root's root; rounds grow with the logarithm of the longest way.
    """
    state = tables.write(formed.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots")
    while True:
        further = state.select(F.col("word").alias("root"), F.col("root").alias("_further"))
        moved = tables.write(state.join(further, "root", "left").select(
            "word", F.coalesce("_further", "root").alias("root"), F.col("_further").isNotNull().alias("moved")
        ), "roots")
        tables.drop(state)
        state = moved.select("word", "root")
        state.shared_path = moved.shared_path
        if moved.where("moved").isEmpty():
            break
    return formed.join(state, "word", "left").withColumn("root", F.coalesce("root", "word"))


def variants(docs: DataFrame) -> DataFrame:
    """Every word of the documents with its form, its root and their counts."""
    tables = Tables(docs.sparkSession, "spelling")
    words = tables.write(vocabulary(damaged_runs(docs)), "words")
    formed = tables.write(forms(words, near_pairs(words)), "forms")
    tables.drop(words)
    return with_roots(tables, formed).select("word", "form", "root", "n", "n_near", "form_n")
