"""Removal of byte strings that occur more than once: grouping by fingerprints, then sorting.

Every byte covered by a string of ``length`` bytes that also starts anywhere else goes.

1. Each window of ``length`` bytes has a seed: its ``gram``-byte piece with the least hash.
   Equal windows have equal seeds, so only runs of windows whose seed occurs again need a
   comparison, and only with runs of the same seed.
2. A run's context (the bytes its windows cover) that occurs unchanged elsewhere is marked by
   its fingerprint alone.  It is sorted, once, only if its seed has other contexts, too.
3. The contexts go to tasks by seed, each task sorts the suffixes of its contexts with the
   difference cover (``suffix_order``), and adjacent suffixes are compared over ``length``
   bytes.
4. A seed whose contexts are too many for one task is split by longer pieces of its windows,
   at last by whole windows, where all windows of a group are equal by fingerprint.

Shuffled are fingerprints, the contexts, and each text twice (to cut out contexts, and to
cut out what is removed).  Fingerprints have 64 bits; contexts are equal if those of seed and
context both are.

A null text is empty.  Rows that repeat a text are separate documents, so each repeats the
other; texts shorter than ``length`` have nothing to remove.  Ids may be null or repeated.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papervein.llm import batches as B
from papervein.llm.shared import Tables, sweep
from papervein.llm.suffix_order import suffix_order

LENGTH = 200
GRAM = 64
TASK_BYTES = 1 << 18   # of contexts that one task sorts at a time, about
PIECE_BYTES = 1 << 18  # of texts that are worked on at once
_POSITION = np.uint64((1 << 24) - 1)


def _runs(data: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """Runs of windows with one seed: (row, first window, windows, seed, context, again).

    ``again``: the seed's piece occurs more than once within the run, so that its windows may
    repeat each other.
    """
    count = len(data) - length + 1
    if count < 1:
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),) * 2 + (np.empty(0, bool),)
    prints = B.Fingerprints(data)
    grams = prints.width(gram)
    width = length - gram + 1
    # Least hash, of equal ones the last; the position is kept in the low bits.
    key = (grams & ~_POSITION) | (_POSITION - np.arange(len(grams), dtype=np.uint64))
    padded = np.concatenate([key, np.full(-len(key) % width, ~np.uint64(0))]).reshape(-1, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[:count], ahead[width - 1 : width - 1 + count])
    at = (_POSITION - (least & _POSITION)).astype(np.int64)
    seed = grams[at]
    # Windows within one text.
    cuts = offsets[1:-1]
    crossing = np.zeros(count + 1, np.int64)
    np.add.at(crossing, np.clip(cuts - length + 1, 0, count), 1)
    np.add.at(crossing, np.clip(cuts, 0, count), -1)
    whole = np.cumsum(crossing[:-1]) == 0
    joined = np.zeros(count + 1, bool)
    joined[1:-1] = (seed[1:] == seed[:-1]) & whole[:-1] & whole[1:]
    first = np.flatnonzero(whole & ~joined[:-1])
    last = np.flatnonzero(whole & ~joined[1:])
    moves = np.concatenate([[0], np.cumsum(at[1:] != at[:-1])])
    row = np.searchsorted(offsets, first, side="right") - 1
    return (
        row, first - offsets[row], last - first + 1, seed[first],
        prints.of(first, last + length), moves[last] > moves[first],
    )


def _all_runs(column: pa.Array, length: int, gram: int):
    """The runs of every text, of very long ones piece by piece."""
    data, offsets = B.text_bytes(column)
    for start, end in B.slices(offsets, PIECE_BYTES):
        own = offsets[start : end + 1] - offsets[start]
        part = data[offsets[start] : offsets[end]]
        if len(part) <= PIECE_BYTES:
            row, *rest = _runs(part, own, length, gram)
            yield row + start, *rest
            continue
        for at in range(0, len(part) - length + 1, PIECE_BYTES):
            piece = part[at : at + PIECE_BYTES + length - 1]
            row, first, *rest = _runs(piece, np.array([0, len(piece)]), length, gram)
            yield row + start, first + at, *rest


def _bits(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _keyed(docs: DataFrame) -> DataFrame:
    """(id, text_key, text): two keys that tell different rows apart."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.coalesce("doc_id", F.xxhash64(text)).alias("id"), F.xxhash64(text).alias("text_key"), text.alias("text")
    )


def _document_runs(docs: DataFrame, length: int, gram: int) -> DataFrame:
    def found(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for row, first, windows, seed, context, again in _all_runs(batch.column(2), length, gram):
                rows = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(first.astype(np.int32)),
                     pa.array(windows.astype(np.int32)), _bits(seed), _bits(context), pa.array(again)],
                    names=["id", "text_key", "first", "windows", "seed", "context", "again"],
                )

    return _keyed(docs).mapInArrow(
        found, "id long, text_key long, first int, windows int, seed long, context long, again boolean"
    )


CONTEXTS = "seed long, context long, n long, windows int, again boolean, data binary"
INTERVALS = "seed long, context long, low int, high int"


def _cut_contexts(docs: DataFrame, classes: DataFrame, length: int) -> DataFrame:
    """The bytes of each class, from the text it was first seen in."""

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            data, offsets = B.text_bytes(batch.column(0))
            out: list[tuple] = []
            for row, wanted in enumerate(batch.column(1).to_pylist()):
                text = data[offsets[row] : offsets[row + 1]]
                for c in wanted:
                    own = text[c["first"] : c["first"] + c["windows"] + length - 1].tobytes()
                    out.append((c["seed"], c["context"], c["n"], c["windows"], c["again"], own))
                if len(out) > 20_000:
                    yield _context_batch(out)
                    out = []
            yield _context_batch(out)

    per_text = (
        classes.select("rep.id", "rep.text_key", F.struct("rep.first", "seed", "context", "n", "windows", "again").alias("c"))
        .groupBy("id", "text_key").agg(F.collect_list("c").alias("wanted"))
    )
    joined = _keyed(docs).join(per_text.hint("shuffle_hash"), ["id", "text_key"]).select("text", "wanted")
    return joined.mapInArrow(cut, CONTEXTS)


def _context_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.binary())
    columns = list(zip(*rows)) or [()] * 6
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types)], names=["seed", "context", "n", "windows", "again", "data"]
    )


def _equal(data: np.ndarray, x: np.ndarray, y: np.ndarray, length: int) -> np.ndarray:
    """Whether the strings of ``length`` bytes at x and y are equal, pair by pair."""
    step = 8 if length >= 8 else 1
    values = data
    if step == 8:
        values = np.lib.stride_tricks.sliding_window_view(data, 8).copy().view(np.uint64).ravel()
    left = np.arange(len(x))
    for k in [*range(0, length - step + 1, step), length - step]:
        left = left[values[x[left] + k] == values[y[left] + k]]
    out = np.zeros(len(x), bool)
    out[left] = True
    return out


def repeated_windows(contexts: list[bytes], windows: list[int], length: int) -> list[np.ndarray]:
    """Per context, a mask of its windows that are equal to any other window of the contexts."""
    data = np.frombuffer(b"".join(contexts), np.uint8)
    base = np.concatenate([[0], np.cumsum([len(c) for c in contexts])])
    order = suffix_order(data.astype(np.int64) + 1, length)
    starts = np.zeros(len(data), bool)
    for at, count in zip(base, windows):
        starts[at : at + count] = True
    order = order[starts[order]]
    same = _equal(data, order[:-1], order[1:], length)
    marks = np.zeros(len(data), bool)
    marks[order[:-1][same]] = True
    marks[order[1:][same]] = True
    return [marks[at : at + count] for at, count in zip(base, windows)]


def _spans(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of every run of true values."""
    edges = np.diff(np.concatenate([[0], mask.view(np.int8), [0]]))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1) - 1


def _sorted_groups(contexts: DataFrame, total: int, length: int) -> DataFrame:
    """Intervals of repeated windows of contexts whose seeds are small enough for one task."""
    buckets = int(total // TASK_BYTES) + 1

    def sort(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop_duplicates(["seed", "context"])  # cut from rows that repeat a text
        masks = repeated_windows(list(rows["data"]), list(rows["windows"]), length)
        out = []
        for seed, context, n, mask in zip(rows["seed"], rows["context"], rows["n"], masks):
            if n == 1:  # contexts with copies are repeated throughout
                out += [(seed, context, low, high) for low, high in zip(*_spans(mask))]
        return pd.DataFrame(out, columns=["seed", "context", "low", "high"])

    return (
        contexts.withColumn("bucket", F.pmod(F.xxhash64("seed"), F.lit(buckets)))
        .groupBy("bucket").applyInPandas(sort, INTERVALS)
    )


def _split_runs(contexts: DataFrame, length: int, gram: int) -> DataFrame:
    """Runs of the contexts' windows by a longer seed, with their bytes."""

    def found(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            texts = batch.column(5).to_pylist()
            parent = batch.column(0).to_numpy().view(np.uint64)
            for row, first, windows, seed, context, again in _all_runs(batch.column(5), length, gram):
                rows = pa.array(row)
                own = [texts[r][f : f + w + length - 1] for r, f, w in zip(row, first, windows)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(rows), batch.column(1).take(rows), batch.column(2).take(rows),
                     pa.array(first.astype(np.int32)), pa.array(windows.astype(np.int32)),
                     _bits(B.mix(parent[row] ^ seed)), _bits(context), pa.array(again), pa.array(own, pa.binary())],
                    names=["parent_seed", "parent_context", "n", "first", "windows", "seed", "context", "again", "data"],
                )

    return contexts.mapInArrow(
        found,
        "parent_seed long, parent_context long, n long, first int, windows int, seed long, context long, "
        "again boolean, data binary",
    )


def _all(classes: DataFrame) -> DataFrame:
    return classes.select("seed", "context", F.lit(0).alias("low"), (F.col("windows") - 1).alias("high"))


def _undecided(classes: DataFrame) -> DataFrame:
    """Classes with other contexts of the same seed, or that may repeat themselves."""
    many = classes.groupBy("seed").agg(F.count("*").alias("contexts"), F.max("again").alias("any_again"))
    return classes.join(many.where("contexts > 1 OR any_again"), "seed").where("contexts > 1 OR n = 1")


def _solve(contexts: DataFrame, tables: Tables, length: int, gram: int) -> DataFrame:
    """Intervals of repeated windows (low to high) of every context with n = 1."""
    groups = tables.write(contexts.groupBy("seed").agg(F.sum(F.length("data")).alias("bytes")), "groups")
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    hot = groups.where(F.col("bytes") > TASK_BYTES).select("seed")
    if hot.isEmpty():
        return _sorted_groups(contexts, total, length)
    cold = _sorted_groups(contexts.join(hot, "seed", "left_anti"), total, length)
    gram = min(length, gram + max(1, (length - gram + 1) // 2))
    large = contexts.join(hot, "seed", "left_semi").dropDuplicates(["seed", "context"])
    runs = tables.write(_split_runs(large, length, gram), "split")
    classes = runs.groupBy("seed", "context").agg(
        F.sum("n").alias("n"), F.max("windows").alias("windows"), F.max("again").alias("again"), F.first("data").alias("data")
    )
    classes = tables.write(classes.select(*[c.split()[0] for c in CONTEXTS.split(", ")]), "classes")
    if gram == length:  # all windows of a seed are equal
        inside = _all(classes.join(
            classes.groupBy("seed").agg(F.sum("n").alias("total"), F.max("again").alias("any_again"))
            .where("total > 1 OR any_again").select("seed"), "seed", "left_semi",
        ))
    else:
        open_ones = _undecided(classes).select(*classes.columns)
        inside = _all(classes.where("n > 1")).union(_solve(open_ones, tables, length, gram))
    back = (
        runs.where("n = 1").join(inside, ["seed", "context"])
        .select(F.col("parent_seed").alias("seed"), F.col("parent_context").alias("context"),
                (F.col("first") + F.col("low")).alias("low"), (F.col("first") + F.col("high")).alias("high"))
    )
    return cold.union(back)


def repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(id, text_key, intervals): the repeated windows of each text that has any."""
    tables = Tables(docs.sparkSession, "suffix-dedup")
    runs = tables.write(_document_runs(docs, length, gram), "runs")
    again = runs.groupBy("seed").agg(F.count("*").alias("n"), F.max("again").alias("again")).where("n > 1 OR again")
    found = tables.write(runs.join(again.select("seed"), "seed", "left_semi"), "candidates")
    tables.drop(runs)
    sweep(docs.sparkSession)
    classes = tables.write(
        found.groupBy("seed", "context").agg(
            F.count("*").alias("n"), F.max("windows").alias("windows"), F.max("again").alias("again"),
            F.min(F.struct("id", "text_key", "first")).alias("rep"),
        ),
        "classes",
    )
    contexts = tables.write(_cut_contexts(docs, _undecided(classes), length), "contexts")
    sweep(docs.sparkSession)
    intervals = tables.write(_all(classes.where("n > 1")).union(_solve(contexts, tables, length, gram)), "intervals")
    marked = found.join(intervals, ["seed", "context"]).select(
        "id", "text_key", F.struct((F.col("first") + F.col("low")).alias("low"), (F.col("first") + F.col("high")).alias("high")).alias("i")
    )
    marks = tables.write(marked.groupBy("id", "text_key").agg(F.collect_list("i").alias("intervals")), "marks")
    tables.drop(found)
    tables.drop(contexts)
    sweep(docs.sparkSession)
    return marks


def _gone(size: int, intervals: list[dict] | None, length: int) -> np.ndarray:
    """Mask of the bytes that repeated windows cover."""
    if not intervals:
        return np.zeros(size, bool)
    edges = np.zeros(size + 1, np.int64)
    np.add.at(edges, [i["low"] for i in intervals], 1)
    np.add.at(edges, [i["high"] + length for i in intervals], -1)
    return np.cumsum(edges[:-1]) > 0


def _with_marks(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """The documents with their intervals as the last column, null where nothing is repeated."""
    # Names that no column of the documents has, in any case.
    prefix = "_"
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix += "_"
    key, text_key, found = f"{prefix}id", f"{prefix}text_key", f"{prefix}intervals"
    marks = repeats(docs, length, gram).select(
        F.col("id").alias(key), F.col("text_key").alias(text_key), F.col("intervals").alias(found)
    )
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.withColumns({key: F.coalesce("doc_id", F.xxhash64(text)), text_key: F.xxhash64(text)})
    return keyed.join(marks.hint("shuffle_hash"), [key, text_key], "left").select(*docs.columns, found)


def digest(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Sizes, removed bytes and runs, and the digest of what remains, of every document."""

    def digested(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            data, offsets = B.text_bytes(batch.column(1))
            rows = []
            for row, intervals in enumerate(batch.column(2).to_pylist()):
                text = data[offsets[row] : offsets[row + 1]]
                gone = _gone(len(text), intervals, length)
                rows.append((
                    len(text), int(gone.sum()), len(_spans(gone)[0]), hashlib.sha256(text[~gone].tobytes()).hexdigest()
                ))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array([r[k] for r in rows], pa.int64()) for k in range(3)),
                 pa.array([r[3] for r in rows], pa.string())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    return _with_marks(docs.select("doc_id", "text"), length, gram).mapInArrow(
        digested, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )


def remove(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """The documents without repeated strings, with all their columns.

    A character that loses a byte goes whole.  ``n_chars``, if there, is counted anew.
    Documents of which nothing but white space is left go.
    """
    at = docs.columns.index("text")

    def removed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            data, offsets = B.text_bytes(batch.column(at))
            texts = []
            for row, intervals in enumerate(batch.column(len(batch.columns) - 1).to_pylist()):
                text = data[offsets[row] : offsets[row + 1]]
                if not intervals:
                    texts.append(batch.column(at)[row].as_py())
                    continue
                character = np.cumsum((text & 0xC0) != 0x80) - 1
                gone = np.bincount(character, _gone(len(text), intervals, length)) > 0
                texts.append(text[~gone[character]].tobytes().decode())
            columns = list(batch.columns[:-1])
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])

    cut = _with_marks(docs, length, gram).mapInArrow(removed, docs.schema)
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return cut.where("text RLIKE '[^\\\\s]'")
