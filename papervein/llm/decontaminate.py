"""Benchmark decontamination: Wu-Manber search for word windows of benchmark items.

An item's windows of ``size`` consecutive words (an item of fewer words is one window) are
the patterns, and words are the alphabet.  Patterns of one length are searched together: a
shift table over blocks of two words tells how far a search position can jump, positions
whose block ends a pattern look into that block's bucket, and the words themselves are then
compared.  Each batch of texts is searched along many lanes at once, a lane being a stretch
of one text.

The patterns are sent to the tasks in blocks of at most ``BLOCK_BYTES`` of item text.  With
more than one block the texts pass once for each, hits being carried along.

A null text has no words and no hits; a null or wordless item has no window.  Repeated rows
are judged each by itself.  Items with equal texts all count.  The windows of an item without
id are searched like any other; only the list of items found leaves it out.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papervein.llm import batches as B
from papervein.llm.shared import Tables

BLOCK_BYTES = 4 << 20
LANE_WORDS = 256
_TABLE_BITS = 18


@dataclass(frozen=True)
class Patterns:
    """Patterns of one length in words, in the order of their last block's code."""

    length: int
    shift: np.ndarray    # by the low bits of a block's code
    block: np.ndarray    # code of each pattern's last block
    prefix: np.ndarray   # code of each pattern's first block
    text: list[bytes]    # words joined by a space
    items: list[list[int]]


def _block_codes(codes: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """Codes of the blocks of ``width`` words that end at the given words."""
    if width == 1:
        return codes[at]
    return B.mix(codes[at - 1] * np.uint64(0xD6E8FEB86659FD93) + codes[at])


def _split(text: str | None) -> list[bytes]:
    data = B.LOWER[np.frombuffer((text or "").encode(), np.uint8)]
    starts, ends, _ = B.words(B.ALNUM[data], np.array([0, len(data)]))
    return [data[s:e].tobytes() for s, e in zip(starts, ends)]


def compile_patterns(items: list[tuple[int | None, str | None]], size: int = 10) -> list[Patterns]:
    windows: dict[tuple[bytes, ...], set[int]] = defaultdict(set)
    for item, text in items:
        found = _split(text)
        if found:
            for k in range(max(1, len(found) - size + 1)):
                windows[tuple(found[k : k + size])].update(() if item is None else (item,))
    by_length = defaultdict(list)
    for window in windows:
        by_length[len(window)].append(window)
    out = []
    for length, own in sorted(by_length.items()):
        width = min(2, length)
        flat = b" ".join(w for window in own for w in window)
        data = np.frombuffer(flat, np.uint8)
        starts, ends, _ = B.words(data != 32, np.array([0, len(data)]))
        codes = B.codes_of(data, starts, ends)
        ends_at = np.arange(len(own)) * length + length - 1
        shift = np.full(1 << _TABLE_BITS, length - width + 1, np.int64)
        for back in range(length - width + 1):
            blocks = _block_codes(codes, ends_at - back, width)
            np.minimum.at(shift, (blocks & np.uint64(len(shift) - 1)).astype(np.int64), back)
        last = _block_codes(codes, ends_at, width)
        first = _block_codes(codes, ends_at - length + width, width)
        order = np.argsort(last, kind="stable")
        out.append(Patterns(
            length, shift, last[order], first[order],
            [b" ".join(own[k]) for k in order], [sorted(windows[own[k]]) for k in order],
        ))
    return out


def _search(p: Patterns, data, starts, ends, codes, first) -> tuple[np.ndarray, list[int]]:
    """First words of all occurrences in one slice of texts, and their patterns."""
    width, length = min(2, p.length), p.length
    low, high = first[:-1] + length - 1, first[1:]
    count = -(-np.maximum(high - low, 0) // LANE_WORDS)
    lane = np.repeat(np.arange(len(low)), count)
    step = np.arange(len(lane)) - np.repeat(np.cumsum(count) - count, count)
    lane_start = low[lane] + step * LANE_WORDS
    lane_end = np.minimum(lane_start + LANE_WORDS, high[lane])
    at, stop, hits = lane_start, lane_end, []
    mask = np.uint64(len(p.shift) - 1)
    while len(at):
        jump = p.shift[(_block_codes(codes, at, width) & mask).astype(np.int64)]
        zero = jump == 0
        if zero.any():
            hits.append(at[zero])
        at = at + np.maximum(jump, 1)
        active = at < stop
        at, stop = at[active], stop[active]
    if not hits:
        return np.empty(0, np.int64), []
    at = np.concatenate(hits)
    block = _block_codes(codes, at, width)
    lo, hi = np.searchsorted(p.block, block, "left"), np.searchsorted(p.block, block, "right")
    count = hi - lo
    where = np.repeat(at, count)
    which = np.repeat(lo - np.cumsum(count) + count, count) + np.arange(count.sum())
    same = _block_codes(codes, where - length + width, width) == p.prefix[which]
    where, which = where[same] - length + 1, which[same]
    sure = np.zeros(len(where), bool)
    # Few positions come this far: those whose first and last blocks fit a pattern.
    for k, (w, q) in enumerate(zip(where.tolist(), which.tolist())):
        own = p.text[q]
        if ends[w + length - 1] - starts[w] >= len(own):
            sure[k] = b" ".join(data[starts[v] : ends[v]].tobytes() for v in range(w, w + length)) == own
    return where[sure], which[sure].tolist()


def _matches(patterns: list[Patterns], column: pa.Array) -> Iterator[tuple[int, np.ndarray, set[int]]]:
    """(number of words, mask of hit words, items) of every text."""
    for _, _, data, offsets in B.text_slices(column):
        data = B.LOWER[data]
        starts, ends, first = B.words(B.ALNUM[data], offsets)
        codes = B.codes_of(data, starts, ends)
        edges = np.zeros(len(starts) + 1, np.int64)
        items: dict[int, set[int]] = defaultdict(set)
        for p in patterns:
            where, which = _search(p, data, starts, ends, codes, first)
            np.add.at(edges, where, 1)
            np.add.at(edges, where + p.length, -1)
            rows = np.searchsorted(first, where, side="right") - 1
            for row, q in set(zip(rows.tolist(), which)):
                items[row].update(p.items[q])
        hit = np.cumsum(edges[:-1]) > 0
        for row in range(len(offsets) - 1):
            yield int(first[row + 1] - first[row]), hit[first[row] : first[row + 1]], items.get(row, set())


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int | None, str]]]:
    """The items in blocks of about ``BLOCK_BYTES``, each small enough for the driver."""
    items = benchmark.select("item_id", "text").where("text IS NOT NULL")
    size = items.agg(F.sum(F.octet_length("text") + 16).alias("s")).first()["s"] or 0
    blocks = int(size // BLOCK_BYTES) + 1
    for k in range(blocks):
        part = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        yield [tuple(row) for row in part.collect()]


def _pass(docs: DataFrame, block: list[tuple[int | None, str]], size: int, last: bool) -> DataFrame:
    """Search one block of items; columns: doc_id, text, hits and items so far."""
    shared = docs.sparkSession.sparkContext.broadcast(compile_patterns(block, size))

    def searched(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            counts, hits, items = [], [], []
            before = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            for row, (count, mask, found) in enumerate(_matches(shared.value, batch.column(1))):
                if before[0][row]:
                    mask = mask | np.unpackbits(np.frombuffer(before[0][row], np.uint8), count=count).astype(bool)
                    found = found.union(before[1][row])
                counts.append(count)
                hits.append(np.packbits(mask).tobytes() if mask.any() else None)
                items.append(sorted(found))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *([] if last else [batch.column(1)]), pa.array(hits, pa.binary()),
                 pa.array(items, pa.list_(pa.int64())), pa.array(counts, pa.int64())],
                names=["doc_id", *([] if last else ["text"]), "hits", "items", "n_words"],
            )

    text = "" if last else "text string, "
    return docs.mapInArrow(searched, f"doc_id long, {text}hits binary, items array<long>, n_words long")


def search(docs: DataFrame, benchmark: DataFrame, size: int = 10) -> DataFrame:
    """doc_id, n_words, the ids of the items found, and a bit mask of the hit words."""
    tables = Tables(docs.sparkSession, "decontaminate")
    nothing = (F.lit(None).cast("binary").alias("hits"), F.array().cast("array<long>").alias("items"))
    state = docs.select("doc_id", "text", *nothing)
    before = None
    for block in _blocks(benchmark):
        if before is not None:
            state = tables.write(_pass(state, before, size, False), "hits").drop("n_words")
        before = block
    return _pass(state, before, size, True).select("doc_id", "n_words", "items", "hits")


def digest(found: DataFrame) -> DataFrame:
    """Counts and the digest of the item ids, from the result of ``search``."""

    def digested(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            n_hit = [int(np.unpackbits(np.frombuffer(h, np.uint8)).sum()) if h else 0 for h in batch.column(3).to_pylist()]
            items = batch.column(2).to_pylist()
            shas = [hashlib.sha256(",".join(sorted(map(str, i))).encode()).hexdigest() for i in items]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n_hit, pa.int64()),
                 pa.array(list(map(len, items)), pa.int64()), pa.array(shas), pa.array([n > 0 for n in n_hit])],
                names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
            )

    return found.mapInArrow(
        digested,
        "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean",
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame, size: int = 10) -> DataFrame:
    """The documents without any benchmark window, with all their columns."""
    text = docs.columns.index("text")
    for block in _blocks(benchmark):
        docs = _without(docs, text, block, size)
    return docs


def _without(docs: DataFrame, text: int, block: list[tuple[int | None, str]], size: int) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(compile_patterns(block, size))

    def clean(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            mask = [not hit.any() for _, hit, _ in _matches(shared.value, batch.column(text))]
            yield batch.filter(pa.array(mask, pa.bool_()))

    return docs.mapInArrow(clean, docs.schema)
