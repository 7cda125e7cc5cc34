"""Sentence bounds learnt from the corpus: which words end in a stop without ending a sentence.

The statistics are those of Kiss and Strunk, "Unsupervised Multilingual Sentence Boundary
Detection" (2006): a word is an abbreviation if a log-likelihood ratio says that it comes
with a stop, weighed by its length, its inner stops and how often it comes without.  After an
abbreviation a sentence only ends if the next word is one that often begins sentences.

One grouping of all words counts everything; the two lists it gives are small and are used as
sets inside each row, so the texts are neither joined nor shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from papervein.functions import text as tx
from papervein.operators.checkpoints import cut_lineage
from papervein.operators.joins import fits_broadcast

# ---- fixed values: the thresholds of the published method ----
ABBREVIATION_SCORE, OPENER_SCORE, OPENER_COUNT = 0.3, 30.0, 5
# ---- end of fixed values ----
# An abbreviation must be seen this often with its stop.
MIN_COUNT = 5
# Both lists are held by every task.
LIST_BYTES = 8 * 1024 * 1024

# A piece between spaces: brackets and quotes, the word, its stop, closing signs.
PIECE = r"""^[(\["']*(\p{L}[\p{L}.'-]*?)(\.?)[,;:)\]"'!?]*$"""
OPENING = r"[.!?] (\p{Lu}[\p{L}-]*)"
LAST_WORD = r"""(?:^|[ (\["'])(\p{L}[\p{L}.'-]*)\. $"""
FIRST_WORD = r"^(\p{Lu}[\p{L}-]*)"
# Stands between sentences that are kept apart; cleaned text holds no control characters.
MARK = "\x1e"


def word_counts(documents: DataFrame) -> DataFrame:
    """``(word, n_stop, n_plain, n_open)`` of every lower-cased word.

    With a stop behind it, without one, and as a capitalised word behind a possible break.
    """
    # Equal pieces are counted before the expressions that take them apart see them.
    pieces = F.transform(F.split("text", " "), lambda p: F.struct(p.alias("piece"), F.lit(False).alias("opens")))
    opening = F.transform(
        F.regexp_extract_all("text", F.lit(OPENING), F.lit(1)),
        lambda w: F.struct(w.alias("piece"), F.lit(True).alias("opens")),
    )
    counted = documents.select(F.inline_outer(F.concat(pieces, opening))).groupBy("piece", "opens").agg(F.count(F.lit(1)).alias("n"))
    words = counted.select(
        F.lower(F.when(F.col("opens"), F.col("piece")).otherwise(F.regexp_extract("piece", PIECE, 1))).alias("word"),
        F.when(F.col("opens"), 2).when(F.regexp_extract("piece", PIECE, 2) == ".", 1).otherwise(0).alias("kind"), "n",
    ).where(F.col("word") != "")

    def total(kind: int) -> Column:
        return F.sum(F.when(F.col("kind") == kind, F.col("n")).otherwise(0))

    return words.groupBy("word").agg(
        total(1).alias("n_stop"), total(0).alias("n_plain"), total(2).alias("n_open"),
    )


def _times_log(n: Column, p: Column) -> Column:
    """n ln p, and 0 where n is 0."""
    return F.when(n == 0, F.lit(0.0)).otherwise(n * F.log(p))


def abbreviations(counts: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """``(word, n_stop, n_plain, score)`` of the words whose stop belongs to them."""
    totals = counts.agg(F.sum("n_stop").cast("double").alias("s"), F.sum(F.col("n_stop") + F.col("n_plain")).cast("double").alias("n"))
    share = totals.select(F.col("s") / F.col("n")).scalar()
    stop, plain = F.col("n_stop").cast("double"), F.col("n_plain").cast("double")
    by_chance = _times_log(stop, share) + _times_log(plain, 1 - share)
    bound = _times_log(stop, F.lit(0.99)) + _times_log(plain, 1 - F.lit(0.99))
    letters = F.length(F.replace("word", F.lit("."))).cast("double")
    inner = F.length("word") - letters + 1
    weight = F.exp(-letters) * inner * F.pow(letters, -plain)
    scored = counts.where(F.col("n_stop") >= min_count).select(
        "word", "n_stop", "n_plain", F.round(-2.0 * (by_chance - bound) * weight, 6).alias("score")
    )
    return scored.where(F.col("score") >= ABBREVIATION_SCORE)


def openers(counts: DataFrame) -> DataFrame:
    """``(word, n_open, n, score)`` of the words that begin sentences more often than by chance."""
    totals = counts.agg(F.sum("n_open").cast("double").alias("a"), F.sum(F.col("n_stop") + F.col("n_plain")).cast("double").alias("n"))
    a, n = totals.select("a").scalar(), totals.select("n").scalar()
    both, own = F.col("n_open").cast("double"), (F.col("n_stop") + F.col("n_plain")).cast("double")
    p, p1, p2 = own / n, both / a, (own - both) / (n - a)
    by_chance = _times_log(both, p) + _times_log(a - both, 1 - p) + _times_log(own - both, p) + _times_log(n - a - own + both, 1 - p)
    bound = _times_log(both, p1) + _times_log(a - both, 1 - p1) + _times_log(own - both, p2) + _times_log(n - a - own + both, 1 - p2)
    usable = (F.col("n_open") >= OPENER_COUNT) & (both <= own) & (own < n) & (n > a) & (n / a > own / both)
    scored = counts.where(usable).select(
        "word", "n_open", own.cast("long").alias("n"), F.round(-2.0 * (by_chance - bound), 4).alias("score")
    )
    return scored.where(F.col("score") >= OPENER_SCORE)


@dataclass(frozen=True)
class Bounds:
    """What was learnt: two lists of lower-cased words."""

    abbreviations: DataFrame
    openers: DataFrame


def learn(documents: DataFrame, min_count: int = MIN_COUNT) -> Bounds:
    """Both lists from cleaned texts, written once.

    They are held by every task; a corpus whose lists exceed ``LIST_BYTES`` needs a higher
    ``min_count``, which is an error here rather than a silent cut.
    """
    counts = cut_lineage(word_counts(documents))
    lists = Bounds(
        cut_lineage(abbreviations(counts, min_count).select("word")), cut_lineage(openers(counts).select("word"))
    )
    if not all(fits_broadcast(words, LIST_BYTES) for words in (lists.abbreviations, lists.openers)):
        raise ValueError(f"more than {LIST_BYTES} bytes of abbreviations or openers: raise min_count")
    return lists


def sentence_parts(text: Column, bounds: Bounds, documents: DataFrame) -> DataFrame:
    """``(doc_id, _parts ARRAY<STRING>)``: the texts cut at the breaks that hold."""
    cut = documents.select("doc_id", F.split(text, tx.SENTENCE_BREAK, -1).alias("_cut"))
    worded = cut.select(
        "doc_id", "_cut",
        # The last word and its stop lie behind the last space but one.
        F.transform("_cut", lambda s: F.lower(F.regexp_extract(F.substring_index(s, " ", -2), LAST_WORD, 1))).alias("_last"),
        F.transform("_cut", lambda s: F.lower(F.regexp_extract(s, FIRST_WORD, 1))).alias("_first"),
    )
    # A generated row: what a lambda looks into is computed once a text, not once a sentence.
    known = F.array_intersect(_as_set(bounds.abbreviations), "_last")
    opening = F.array_intersect(_as_set(bounds.openers), "_first")
    following = F.concat(F.slice("_first", F.lit(2), F.size("_first")), F.array(F.lit("")))
    zipped = F.arrays_zip("_cut", "_last", "_next")
    row = F.struct(zipped.alias("_zipped"), known.alias("_known"), opening.alias("_opening"))
    placed = worded.withColumn("_next", following).select("doc_id", F.inline_outer(F.array(row)))
    marked = F.transform("_zipped", lambda z: F.when(
        F.array_contains("_known", z["_last"]) & ~F.array_contains("_opening", z["_next"]), z["_cut"]
    ).otherwise(F.concat(z["_cut"], F.lit(MARK))))
    return placed.select("doc_id", F.split(F.array_join(marked, ""), MARK, -1).alias("_parts"))


def _as_set(words: DataFrame) -> Column:
    return words.agg(F.sort_array(F.collect_set("word"))).scalar()
