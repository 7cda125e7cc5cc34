"""Stupid-backoff scores of documents under the language model of all other documents.

A word scores count(context, word) / count(context) for the longest context of at most
``order`` - 1 words with which another document has it; each word by which the context is
shortened costs a factor ``alpha``.  A word no other document has counts ``alpha`` times.  Words
at a document's beginning start with what context there is.  Counts and totals leave the
document itself out.  The document's score is the sum of the logarithms.

The work is relational.  Count tables sum the n-grams of each order, which are a context and a
word; n-grams that occur once in all are left out, since no other document has them.  To each of
the rest its context's count is joined once.  Documents are exploded into
n-grams: a row for every distinct n-gram of a document with the number of times it is there.
These are joined to the count table of their order; only those not found go on to the
next lower one, and the logarithms are summed for
each document.  Everything is partitioned by the hash of the n-gram, but that a table of words
which fits a broadcast goes to the rows.  The documents are scored in ``rounds`` parts by the hash
of their rows, so that only a part of the n-grams, by far the most rows, is shuffled at a time; a
text is cut into words for one part only, and a round's few documents are summed where their rows
are found.

Words are runs of non-space characters, A-Z in lower case.  A null or wordless text scores 0
over no words.  Repeated rows are separate documents, so each knows the other's n-grams.
Ids may be null or repeated.  Codes have 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papervein.llm import batches as B
from papervein.llm.shared import Tables, sweep
from papervein.operators.joins import fits_broadcast

ALPHA, ORDER, ROUNDS = 0.4, 2, 4
HELD = 1 << 22  # n-grams summed in a task before they are rows


def _keyed(docs: DataFrame) -> DataFrame:
    """(r, doc_id, text): ``r`` names a row by its id and text; rows equal in both share it."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.xxhash64("doc_id", F.sha2(F.encode(text, "UTF-8"), 256)).alias("r"), "doc_id", text.alias("text"))


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of all words, the row of each, and the place of each in its row."""
    data = B.LOWER[data]
    starts, ends, first = B.words(~B.SPACE[data], offsets)
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    return B.codes_of(data, starts, ends), owner, np.arange(len(starts)) - first[owner]


def _grams(codes: np.ndarray, order: int) -> np.ndarray:
    """The code of the ``order`` words that end at each word; meaningless where a row has fewer before."""
    out = np.zeros(len(codes), np.uint64)
    if len(codes) >= order:
        salt = B.mix(np.array([order], np.uint64))[0] if order > 1 else np.uint64(0)
        out[order - 1 :] = (B.window_codes(codes, order) if order > 1 else codes) ^ salt
    return out


def _times(owner: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each element, how often its row has its code; and the first element of each (row, code)."""
    keys = B.mix(owner.astype(np.uint64) + np.uint64(1)) ^ codes
    order = np.argsort(keys)
    keys = keys[order]
    new = np.ones(len(order), bool)
    new[1:] = keys[1:] != keys[:-1]
    group = np.cumsum(new) - 1
    out = np.empty(len(order), np.int64)
    out[order] = np.bincount(group)[group] if len(order) else 0
    return out, order[new]


def _exploded(docs: DataFrame, order: int) -> DataFrame:
    """(code, context, times) of the n-grams of all orders, summed over many texts at a time; a
    word alone has no context."""

    def summed(codes: list[np.ndarray], contexts: list[np.ndarray]) -> pa.RecordBatch:
        flat = np.concatenate(codes)
        by = np.argsort(flat)
        flat = flat[by]
        new = np.ones(len(flat), bool)
        new[1:] = flat[1:] != flat[:-1]
        cut = np.flatnonzero(new)
        times = np.diff(np.append(cut, len(flat)))
        columns = [pa.array(flat[cut].view(np.int64)), pa.nulls(len(cut), pa.int64()), pa.array(times)]
        if contexts:
            context = np.concatenate(contexts)[by[cut]].view(np.int64)
            near = np.argsort(context)  # equal ones side by side take less room
            columns = [pa.array(c[near]) for c in (flat[cut].view(np.int64), context, times)]
        return pa.RecordBatch.from_arrays(columns, names=["code", "context", "times"])

    def released(codes: dict[int, list], contexts: dict[int, list]) -> Iterator[pa.RecordBatch]:
        for n in codes:
            if codes[n]:
                yield summed(codes[n], contexts[n])
                codes[n].clear()
                contexts[n].clear()

    def exploded(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes: dict[int, list] = {n: [] for n in range(1, order + 1)}
        contexts: dict[int, list] = {n: [] for n in range(1, order + 1)}
        size = 0
        for batch in parts:
            for _, _, data, offsets in B.text_slices(batch.column(0)):
                words, _, place = _words(data, offsets)
                grams = _grams(words, 1)
                codes[1].append(grams)
                for n in range(2, order + 1):
                    at = np.flatnonzero(place >= n - 1)
                    before, grams = grams, _grams(words, n)
                    codes[n].append(grams[at])
                    contexts[n].append(before[at - 1])
                size += len(words)
                # One row for so many n-grams: the first step of the sum.
                if size > HELD:
                    yield from released(codes, contexts)
                    size = 0
        yield from released(codes, contexts)

    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(exploded, "code long, context long, times long")


def _counts(grams: DataFrame) -> DataFrame:
    """(code, context, total) of the n-grams that occur more than once.  Each comes once from many
    texts, so there is little to sum before they are dealt by code."""
    dealt = grams.repartition("code").groupBy("code")
    return dealt.agg(F.first("context").alias("context"), F.sum("times").alias("total")).where("total > 1")


def _met(table: DataFrame) -> DataFrame:
    """A look-up table: of few rows, it goes to the others; a larger one is met by a shuffle."""
    return F.broadcast(table) if fits_broadcast(table) else table.hint("shuffle_hash")


def _tabled(docs: DataFrame, order: int, tables: Tables) -> tuple[DataFrame, DataFrame]:
    """The written count tables: (code, total) of words, and (code, total, whole) of longer n-grams,
    where ``whole`` is the total of the context."""
    grams = tables.write(_counts(_exploded(docs, order)), "grams")
    words = tables.write(grams.where("context IS NULL").select("code", "total"), "words")
    longer = grams.where("context IS NOT NULL")
    # Words alone are contexts of pairs; of longer n-grams, others of those counted are.
    contexts = words if order < 3 else grams
    whole = contexts.select(F.col("code").alias("context"), F.col("total").alias("whole"))
    counts = tables.write(longer.join(_met(whole), "context").select("code", "total", "whole"), "counts")
    tables.drop(grams)
    return words, counts


def _columns(order: int) -> list[str]:
    """Of each order n above the lowest: the n-gram g, its own count o, its context's own count p."""
    return [f"{name}{n}" for n in range(order, 1, -1) for name in "gop"]


def _asked(keyed: DataFrame, order: int) -> DataFrame:
    """A row for every distinct n-gram of the highest order that a place in a document allows:
    (r, the word w and its own count o1, and the codes and own counts of all that the scores
    may need).  An n-gram of the highest order is there as often as its own count, those that
    begin a document once."""
    names = _columns(order)

    def asked(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            keys = batch.column(0).to_numpy()
            for first, _, data, offsets in B.text_slices(batch.column(2)):
                words, owner, place = _words(data, offsets)
                grams = {n: _grams(words, n) for n in range(1, order + 1)}
                own, some = {}, {}
                for n in range(1, order + 1):
                    at = np.flatnonzero(place >= n - 1)
                    own[n] = np.zeros(len(words), np.int64)
                    own[n][at], head = _times(owner[at], grams[n][at])
                    some[n] = at[head]
                for m in range(1, order + 1):
                    # Below the highest order only the places that have no more words before them.
                    at = some[m] if m == order else np.flatnonzero(place == m - 1)
                    columns = [pa.array(v) for v in (keys[first + owner[at]], words[at].view(np.int64), own[1][at])]
                    for name in names:
                        kind, n = name[0], int(name[1:])
                        if n > m:
                            columns.append(pa.nulls(len(at), pa.int64()))
                        elif kind == "g":
                            columns.append(pa.array(grams[n][at].view(np.int64)))
                        else:  # the context: the n - 1 words before
                            columns.append(pa.array(own[n][at] if kind == "o" else own[n - 1][at - 1]))
                    yield pa.RecordBatch.from_arrays(columns, names=["r", "w", "o1", *names])

    return keyed.mapInArrow(asked, ", ".join(f"{c} long" for c in ("r", "w", "o1", *names)))


def _scored(rows: DataFrame, counts: DataFrame, order: int, alpha: float) -> DataFrame:
    """(r, k, cut, logs, w, o1): ``logs`` of the k places of each row where an n-gram longer than
    a word scores them, else the word that is left to score them, and how often their context
    has been shortened."""
    # What follows from the other columns is added after the first join, so it is not shuffled.
    begun = {
        "k": F.coalesce(f"o{order}", F.lit(1).cast("long")) if order > 1 else F.col("o1"),
        "cut": F.lit(0), "logs": F.lit(None).cast("double"),
    }
    state = rows if order > 1 else rows.withColumns(begun)
    known = counts.withColumnRenamed("code", "key").hint("shuffle_hash")
    for n in range(order, 1, -1):
        # A row that is scored, or whose highest order is lower, looks up what no n-gram is.
        key = F.coalesce(f"g{n}", "r")
        if n < order:
            key = F.when(F.col("logs").isNull(), key).otherwise(F.col("r"))
        joined = state.withColumn("key", key).drop(f"g{n}").join(known, "key", "left")
        if n == order:
            joined = joined.withColumns(begun)
        active = F.col("logs").isNull() & F.col(f"o{n}").isNotNull()
        seen = active & F.coalesce(F.col("total") > F.col(f"o{n}"), F.lit(False))
        log = F.log((F.col("total") - F.col(f"o{n}")) / (F.col("whole") - F.col(f"p{n}"))) + F.col("cut") * F.log(F.lit(alpha))
        lower = [c for c in _columns(order) if int(c[1:]) < n]
        state = joined.select(
            "r", "w", "o1", *lower, "k", F.coalesce("logs", F.when(seen, F.col("k") * log)).alias("logs"),
            (F.col("cut") + F.when(active & ~seen, 1).otherwise(0)).alias("cut"),
        )
    left = F.col("logs").isNull()
    return state.select("r", "k", "cut", "logs", F.when(left, F.col("w")).alias("w"), F.when(left, F.col("o1")).alias("o1"))


def _summed(scored: DataFrame, words: DataFrame, alpha: float) -> DataFrame:
    """(r, n, logs, single, backoff): per document its words, the sum of logarithms but for the total
    of words, how many words are divided by that total, and how many had their context shortened."""
    backoff = F.when(F.col("cut") > 0, F.col("k")).otherwise(0).alias("backoff")
    longer = scored.where("logs IS NOT NULL").select("r", "k", "logs", F.lit(0).cast("long").alias("single"), backoff)
    joined = scored.where("logs IS NULL").join(words.withColumnRenamed("code", "w"), "w", "left")
    other = F.coalesce(F.col("total") - F.col("o1"), F.lit(0)).cast("double")
    log = F.log(F.when(other > 0, other).otherwise(F.lit(alpha))) + F.col("cut") * F.log(F.lit(alpha))
    alone = joined.select("r", "k", (F.col("k") * log).alias("logs"), F.col("k").alias("single"), backoff)
    sums = [F.sum(c).alias(c) for c in ("logs", "single", "backoff")]
    return longer.union(alone).groupBy("r").agg(F.sum("k").alias("n"), *sums)


def score(docs: DataFrame, alpha: float = ALPHA, order: int = ORDER, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, n_words, n_backoff and log_score of every document."""
    tables = Tables(docs.sparkSession, "lm-score")
    rows = tables.write(_keyed(docs).select("r", "doc_id"), "rows")
    words, counts = _tabled(docs, order, tables)
    sweep(docs.sparkSession)
    met = _met(words)
    sums = []
    for part in range(rounds):
        own = docs.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(rounds)) == part)
        scored = tables.write(_scored(_asked(_keyed(own), order), counts, order, alpha), "scored")
        sums.append(tables.write(_summed(scored, met, alpha), "sums"))
        tables.drop(scored)
        sweep(docs.sparkSession)
    every = sums[0]
    for more in sums[1:]:
        every = every.union(more)
    corpus = every.agg(F.sum("n")).first()[0] or 0
    # Rows that share id and text have been summed together and are equal: each gets its share.
    copies = rows.groupBy("r").agg(F.count(F.lit(1)).alias("copies"))
    whole = every.groupBy("r").agg(*(F.sum(c).alias(c) for c in ("n", "logs", "single", "backoff")))
    joined = rows.join(copies, "r").join(whole, "r", "left")
    joined = joined.withColumn("n_words", F.coalesce((F.col("n") / F.col("copies")).cast("long"), F.lit(0).cast("long")))
    others = F.greatest(F.lit(corpus) - F.col("n_words"), F.lit(1)).cast("double")
    logs = (F.col("logs") - F.col("single") * F.log(others)) / F.col("copies")
    return joined.select(
        "doc_id", "n_words", F.coalesce((F.col("backoff") / F.col("copies")).cast("long"), F.lit(0).cast("long")).alias("n_backoff"),
        F.coalesce(logs, F.lit(0.0)).alias("log_score"),
    )
