"""Best-fit packing of token pieces into sequences, after a dominance reduction.

Documents become pieces of at most ``capacity`` tokens (only longer ones are cut; the first
piece takes the remainder).  How many pieces have each length is all the packing depends on:
a histogram of at most ``capacity`` rows, so the plan is made on the driver at any size of
the corpus, and each piece finds its place by its rank among the pieces of its length.  A piece is
ranked within its partition while it is cut; the partitions' counts by length, a small table,
turn that into its rank among all, so the ids are written once and not shuffled while that
table fits ``OFFSETS_BROADCAST_BYTES``.  They are stored in two bytes where the vocabulary
allows.

``reduce`` fixes sets of one, two or three pieces that dominate every other set with the
largest of them (Martello and Toth); ``best_fit`` places what is left, longest first.

A null text is a document of the end token alone.  Repeated rows are packed each by itself;
which of equal pieces takes which place is arbitrary.  No documents: no sequences.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from papervein.llm import batches as B
from papervein.llm import tokens
from papervein.llm.shared import Tables, release
from papervein.operators.joins import sized

PIECES = "doc_id long, piece int, start long, length long, ids binary"  # ids: 4 bytes each, little-endian
CUT = f"{PIECES}, part long, rank long"  # here the ids have ``id_type``
BATCH_BYTES = 1 << 22  # of ids in one batch, about
OFFSETS_BROADCAST_BYTES = 32 << 20


@dataclass(frozen=True)
class Run:
    """Pieces of one length with ranks from ``first`` on: ``bins`` sequences get ``each``."""

    length: int
    first: int
    bins: int
    each: int
    sequence: int
    offset: int


def _piece_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 7
    types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types)],
        names=["doc_id", "piece", "start", "length", "ids", "part", "rank"],
    )


def id_type(tokenizer: str, end_id: int) -> str:
    """Two bytes an id if every id of the vocabulary fits, else four."""
    return "<u2" if max(tokens.encoder(tokenizer).size() - 1, end_id) < 1 << 16 else "<u4"


def pieces(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2) -> DataFrame:
    """The pieces of every document with their ids, and the rank of each among those of its
    partition that are as long."""
    kind = id_type(tokenizer, end_id)

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        encoder = tokens.encoder(tokenizer)
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in parts:
            rows, size = [], 0
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.append(np.frombuffer(encoder.ids(text.as_py() or ""), "<u4"), np.uint32(end_id)).astype(kind)
                count = len(ids)
                stop = (count - 1) % capacity + 1
                start = piece = 0
                while start < count:
                    length = stop - start
                    rows.append((doc, piece, start, length, ids[start:stop].tobytes(), part, int(seen[length])))
                    seen[length] += 1
                    size += 4 * length
                    start, stop, piece = stop, stop + capacity, piece + 1
                    if size > BATCH_BYTES:
                        yield _piece_batch(rows)
                        rows, size = [], 0
            yield _piece_batch(rows)

    return docs.select("doc_id", "text").mapInArrow(cut, CUT)


class _Plan:
    def __init__(self, counts: np.ndarray, capacity: int):
        self.left = counts.astype(np.int64).copy()  # by length; index 0 is unused
        self.used = np.zeros_like(self.left)
        self.capacity = capacity
        self.sequences = 0
        self.runs: list[Run] = []

    def take(self, length: int, bins: int, each: int, sequence: int, offset: int) -> None:
        if bins and each:
            self.runs.append(Run(length, int(self.used[length]), bins, each, sequence, offset))
            self.used[length] += bins * each
            self.left[length] -= bins * each

    def fix(self, lengths: list[int], times: int) -> None:
        """``times`` sequences, each with one piece of each length."""
        offset = 0
        for length in lengths:
            self.take(length, times, 1, self.sequences, offset)
            offset += length
        self.sequences += times


def _times(left: np.ndarray, lengths: list[int]) -> int:
    return int(min(left[x] // lengths.count(x) for x in lengths))


def _largest(left: np.ndarray, most: int) -> int:
    """The largest length of at most ``most`` with pieces left, or 0."""
    fits = np.flatnonzero(left[1 : max(most, 0) + 1])
    return int(fits[-1]) + 1 if len(fits) else 0


def _dominating(left: np.ndarray, j: int, capacity: int) -> list[int] | None:
    """A set with ``j`` that dominates all sets with it, if one is found.

    A set dominates another if the other's pieces can be exchanged for its own, each of its
    pieces taking the room of pieces that are together no longer.  ``left`` excludes this j.
    """
    room = capacity - j
    largest = _largest(left, room)
    if not largest:
        return [j]  # nothing fits beside it
    if largest == room:
        return [j, largest]  # a full sequence: any other company is together no longer
    lengths = np.flatnonzero(left)
    smallest = np.repeat(lengths, np.minimum(left[lengths], 3))[:3]
    if len(smallest) < 2 or smallest[:2].sum() > room:
        return [j, largest]  # only single companions fit, and this is the longest
    if len(smallest) == 3 and smallest.sum() <= room:
        return None
    # At most two companions fit: the best pair against the best single one.
    a = lengths[lengths <= room]
    best, pair = 0, None
    for x in a[::-1]:
        left[x] -= 1
        y = _largest(left, min(x, room - x))
        left[x] += 1
        if y and x + y > best:
            best, pair = x + y, (int(x), y)
    if pair is None or largest >= best:
        return [j, largest]
    x, y = pair
    longer = lengths[lengths > y]
    two = np.repeat(longer, np.minimum(left[longer], 2))[:2]
    # The longest single companion is in the pair, and no two companions longer than the
    # pair's second fit: so any other pair fits into this one piece by piece.
    if x == largest and (len(two) < 2 or two.sum() > room):
        return [j, x, y]
    return None


def reduce(plan: _Plan) -> int:
    """Fix dominating sets, from the longest piece down; the number of sequences fixed."""
    for j in range(plan.capacity, 0, -1):
        while plan.left[j]:
            plan.left[j] -= 1
            found = _dominating(plan.left, j, plan.capacity)
            plan.left[j] += 1
            if found is None:
                break
            # The condition stays true while all of the set's lengths have pieces left:
            # taking pieces away only leaves fewer alternatives.
            plan.fix(found, _times(plan.left, found))
    return plan.sequences


def best_fit(plan: _Plan) -> None:
    """Each piece, longest first, into the fullest sequence that has room for it.

    Sequences of equal room are handled as one group: a best fit keeps filling the sequence
    it has begun while the same length still fits.
    """
    groups: dict[int, list[tuple[int, int]]] = {}  # room: (first sequence, number)
    for length in range(plan.capacity, 0, -1):
        for room in sorted(r for r in groups if r >= length):
            if not plan.left[length]:
                break
            kept = []
            for first, number in groups.pop(room):
                each = room // length
                full = int(min(number, plan.left[length] // each))
                plan.take(length, full, each, first, plan.capacity - room)
                if full:
                    groups.setdefault(room - each * length, []).append((first, full))
                rest = int(plan.left[length])
                if full < number and rest:
                    plan.take(length, 1, rest, first + full, plan.capacity - room)
                    groups.setdefault(room - rest * length, []).append((first + full, 1))
                    full += 1
                if full < number:
                    kept.append((first + full, number - full))
            if kept:
                groups.setdefault(room, []).extend(kept)
        if plan.left[length]:
            each = plan.capacity // length
            full, rest = divmod(int(plan.left[length]), each)
            for bins, per in ((full, each), (1, rest)):
                if bins and per:
                    plan.take(length, bins, per, plan.sequences, 0)
                    groups.setdefault(plan.capacity - per * length, []).append((plan.sequences, bins))
                    plan.sequences += bins


def make_plan(counts: np.ndarray, capacity: int = 1024) -> tuple[list[Run], int]:
    """Where the pieces of each length go (``counts`` by length), and how many sequences."""
    plan = _Plan(counts, capacity)
    reduce(plan)
    best_fit(plan)
    return plan.runs, plan.sequences


def place(found: DataFrame, capacity: int = 1024, kind: str = "<u4") -> DataFrame:
    """Sequence and offset of every piece.  ``found`` is read twice: pass a written table."""
    held = found.groupBy("part", "length").count()
    counts = np.zeros(capacity + 1, np.int64)
    for length, count in held.groupBy("length").agg(F.sum("count")).collect():  # at most ``capacity`` rows
        counts[length] = count
    runs, _ = make_plan(counts, capacity)
    runs.sort(key=lambda r: (r.length, r.first))
    shift = 40
    keys = np.array([(r.length << shift) + r.first for r in runs], np.int64)
    table = np.array([(r.first, r.each, r.sequence, r.offset) for r in runs], np.int64).reshape(-1, 4)

    # Pieces of one length are counted through the partitions in their order.
    before = held.withColumn("_after", F.sum("count").over(
        Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )).select("part", "length", (F.col("_after") - F.col("count")).alias("before"))
    ranked = found.join(sized(before, OFFSETS_BROADCAST_BYTES), ["part", "length"]).select(
        "doc_id", "piece", "start", "length", "ids", (F.col("rank") + F.col("before")).alias("rank")
    )

    def placed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            length = batch.column(3).to_numpy()
            rank = batch.column(5).to_numpy()
            first, each, sequence, offset = table[np.searchsorted(keys, (length << shift) + rank, side="right") - 1].T
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], _widened(batch.column(4), kind), pa.array(sequence + (rank - first) // each),
                 pa.array(offset + (rank - first) % each * length)],
                names=["doc_id", "piece", "start", "length", "ids", "sequence_id", "offset"],
            )

    return ranked.mapInArrow(placed, f"{PIECES}, sequence_id long, offset long")


def _widened(ids: pa.Array, kind: str) -> pa.Array:
    """Ids in four bytes each."""
    if kind == "<u4":
        return ids
    data, offsets = B.text_bytes(ids)
    wide = data.view(kind).astype("<u4")
    return pa.Array.from_buffers(
        pa.binary(), len(ids), [None, pa.py_buffer((offsets * 2).astype(np.int32)), pa.py_buffer(wide)]
    )


def pack(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2) -> DataFrame:
    """Every piece with its ids, its sequence and its offset there."""
    tables = Tables(docs.sparkSession, "packing")
    found = tables.write(pieces(docs, tokenizer, capacity, end_id), "pieces")
    return place(found, capacity, id_type(tokenizer, end_id))


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the ids of each sequence's pieces in their order."""
    own = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("own"))
    return own.select("sequence_id", F.aggregate("own", F.lit(bytearray()), lambda a, x: F.concat(a, x["ids"])).alias("ids"))
