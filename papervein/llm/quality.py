"""Quality rules: base rules on word statistics, then boosted trees on document statistics.

The trees are fitted on a bounded sample of labelled documents (``Rules.sample_rows``, taken
in hash order of the id, so the same rows on every run), flattened into node arrays and
sent to the tasks, where each batch of texts is measured and scored at once.  More repeated
lines, repeated words or symbols never raise a score (monotonic constraints).

Null and empty texts have zero counts and fail the base rules.  Repeated rows are judged each
by itself.  Without labels, or with one class, the trees reject nothing.  A document id that
is null is judged like any other; labels with null ids or labels are not used; of several
labels of one id the lowest counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papervein.llm import batches as B
from papervein.llm import boosting

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RATIOS = (
    "word_length", "symbol_share", "dup_line_share", "repeat_share", "distinct_share",
    "upper_share", "digit_share", "punctuation_share", "line_words", "alpha_start_share",
)
FEATURES = COUNTS[:1] + RATIOS
# Features that never raise the score as they grow.
FALLING = ("symbol_share", "dup_line_share", "repeat_share")

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[list(b"!?.,;:()[]{}-_/\\'\"=+@^~`")] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True


@dataclass(frozen=True)
class Rules:
    window: int = 5
    min_words: int = 10
    max_repeat_percent: int = 20
    sample_rows: int = 20_000  # labelled documents the trees are fitted on, at most
    keep_from: float = 0.5     # lowest probability of good quality that is kept


def measure(column: pa.Array, rules: Rules = Rules()) -> dict[str, np.ndarray]:
    """Counts and ratios of every whole text in an Arrow column."""
    rows = len(column)
    out = {name: np.zeros(rows, np.int64) for name in COUNTS} | {name: np.zeros(rows) for name in RATIOS}
    for first, end, data, offsets in B.text_slices(column):
        part = _measure(data, offsets, rules.window)
        for name, values in part.items():
            out[name][first:end] = values
    return out


def _repeated(keys: np.ndarray) -> np.ndarray:
    """Marks the keys that occur twice or more."""
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    marks = np.zeros(len(keys), bool)
    marks[order[1:]] = same
    marks[order[:-1]] |= same
    return marks


def _distinct(keys: np.ndarray, owner: np.ndarray, rows: int) -> np.ndarray:
    """Number of distinct keys of each owner."""
    salted = keys ^ B.mix(owner.astype(np.uint64) + np.uint64(1))
    order = np.argsort(salted)
    new = np.ones(len(keys), bool)
    new[1:] = salted[order][1:] != salted[order][:-1]
    return np.bincount(owner[order][new], minlength=rows)


def _measure(data: np.ndarray, offsets: np.ndarray, window: int) -> dict[str, np.ndarray]:
    rows = len(offsets) - 1
    inside = ~B.SPACE[data]
    starts, ends, first = B.words(inside, offsets)
    n_words = np.diff(first)
    owner = np.repeat(np.arange(rows), n_words)
    points = inside & ((data & 0xC0) != 0x80)
    codes = B.codes_of(data, starts, ends)

    # Windows of words that occur twice or more within their own text.
    windows = B.window_codes(codes, window)
    whole = owner[: len(windows)] == owner[window - 1 :][: len(windows)]
    at = np.flatnonzero(whole)
    salt = B.mix(owner.astype(np.uint64) + np.uint64(1))
    twice = np.zeros(len(starts), bool)
    twice[at] = _repeated(windows[at] ^ salt[at])
    covered = twice.copy()
    for k in range(1, min(window, len(twice))):
        covered[k:] |= twice[: len(twice) - k]

    # Lines with a word, up to the next break or the end of their text.
    breaks = np.flatnonzero(data == 10)
    line_start = np.unique(np.concatenate([offsets[:-1], breaks + 1]))
    line_start = line_start[line_start < len(data)]
    line_owner = np.searchsorted(offsets, line_start, side="right") - 1
    line_end = np.append(breaks, len(data))[np.searchsorted(breaks, line_start)]
    line_end = np.minimum(line_end, offsets[line_owner + 1])
    full = np.searchsorted(starts, line_start) < np.searchsorted(starts, line_end)
    line_start, line_end, line_owner = line_start[full], line_end[full], line_owner[full]
    n_lines = np.bincount(line_owner, minlength=rows)
    distinct_lines = _distinct(B.codes_of(data, line_start, line_end), line_owner, rows)

    word_chars = B.totals(points, offsets)
    symbols = B.totals(_SYMBOL[data], offsets)
    n_repeat = np.bincount(owner[covered], minlength=rows)
    starts_alpha = np.bincount(owner[_LETTER[data[starts]]], minlength=rows)
    per = np.maximum(n_words, 1)
    chars = np.maximum(word_chars, 1)
    return {
        "n_words": n_words, "word_chars": word_chars, "n_symbols": symbols,
        "n_dup_lines": n_lines - distinct_lines, "n_repeat_words": n_repeat,
        "word_length": word_chars / per, "symbol_share": symbols / chars,
        "dup_line_share": (n_lines - distinct_lines) / np.maximum(n_lines, 1),
        "repeat_share": n_repeat / per, "distinct_share": _distinct(codes, owner, rows) / per,
        "upper_share": B.totals(_UPPER[data], offsets) / chars,
        "digit_share": B.totals(_DIGIT[data], offsets) / chars,
        "punctuation_share": B.totals(_PUNCTUATION[data], offsets) / chars,
        "line_words": n_words / np.maximum(n_lines, 1), "alpha_start_share": starts_alpha / per,
    }


def matrix(stats: dict[str, np.ndarray]) -> np.ndarray:
    return np.stack([stats[name].astype(float) for name in FEATURES], 1)


def judge(stats: dict[str, np.ndarray], forest: boosting.Forest, rules: Rules) -> dict[str, np.ndarray]:
    """The base verdict, the trees' probability of good quality, and the joint verdict."""
    words, repeats = stats["n_words"], stats["n_repeat_words"]
    failed = (words < rules.min_words) | (100 * repeats > rules.max_repeat_percent * words)
    score = forest.probability(matrix(stats))
    return {"base_failed": failed, "quality_score": score, "kept": ~failed & (score >= rules.keep_from)}


def labelled_sample(docs: DataFrame, labels: DataFrame, rules: Rules = Rules()) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of at most ``rules.sample_rows`` documents, in hash order of the id."""
    chosen = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy("doc_id").agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rules.sample_rows)
    )
    # The sample is bounded, so this side may be broadcast at any size of the corpus.
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    def features(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            x = matrix(measure(batch.column(1), rules))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2).cast(pa.int32()), *(pa.array(c) for c in x.T)],
                names=["doc_id", "quality", *FEATURES],
            )

    schema = "doc_id long, quality int, " + ", ".join(f"{name} double" for name in FEATURES)
    measured = texts.mapInArrow(features, schema)
    # One row for an id, so that the bound holds with repeated rows too.
    rows = (
        measured.groupBy("doc_id").agg(F.min(F.struct("quality", *FEATURES)).alias("s"))
        .select("doc_id", "s.*").toPandas().sort_values("doc_id")
    )
    return rows[list(FEATURES)].to_numpy(float), rows["quality"].to_numpy(float)


def train(docs: DataFrame, labels: DataFrame, rules: Rules = Rules()) -> boosting.Forest:
    x, y = labelled_sample(docs, labels, rules)
    return fit(x, y)


def fit(x: np.ndarray, y: np.ndarray) -> boosting.Forest:
    return boosting.fit(x, y, monotone={FEATURES.index(name): -1 for name in FALLING})


def score(docs: DataFrame, forest: boosting.Forest, rules: Rules = Rules()) -> DataFrame:
    """Counts, scores and verdict of every document, without its text."""

    def scored(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            stats = measure(batch.column(1), rules)
            verdict = judge(stats, forest, rules)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(stats[n]) for n in COUNTS), *(pa.array(v) for v in verdict.values())],
                names=["doc_id", *COUNTS, *verdict],
            )

    schema = (
        "doc_id long, " + ", ".join(f"{n} long" for n in COUNTS)
        + ", base_failed boolean, quality_score double, kept boolean"
    )
    return docs.select("doc_id", "text").mapInArrow(scored, schema)


def keep_good(docs: DataFrame, forest: boosting.Forest, rules: Rules = Rules()) -> DataFrame:
    """The rows whose text is kept, with all their columns."""
    text = docs.columns.index("text")

    def kept(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            mask = judge(measure(batch.column(text), rules), forest, rules)["kept"]
            yield batch.filter(pa.array(mask))

    return docs.mapInArrow(kept, docs.schema)
