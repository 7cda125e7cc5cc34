"""Near-duplicates by chosen-path set similarity join.

A document's set is its distinct shingles of five words (fewer words: the whole sequence);
documents with at least ``percent`` Jaccard similarity are linked, and groups of linked
documents share the smallest id.  Documents with equal sets are one class from the start.

Search: ``trees`` independent trees branch the classes.  A node chooses minwise coordinates at
random; a class goes to the child that its own minwise tokens there name.  The first ``first``
levels have one branch, so that the nodes that are formed at all are small already: two sets
of similarity s stay together through them with probability s^first.  A node of at most
``small`` classes is compared exhaustively.  A larger one, while its classes are not yet one
component, is compared with its hub and branches on, each class into ``branches`` children by
``step`` tokens at a time.  With four branches of three tokens a pair at 0.75 is together in
some child with probability 0.81 or more at any depth, so with 28 trees it is lost in all with
1e-5, while classes below 0.63 are spread over ever fewer nodes.

The hub is the class that agrees most with the node's consensus, the commonest token of each
coordinate in a sample of the node: of a text and its many copies that have little but the
text in common, it is the text.

Comparison: pairs whose sketches (a byte of each of 128 minwise tokens) agree far below the
threshold are dropped (a linked pair is lost with probability under 1e-5); all others are
confirmed on the full sets, which are made once for every class that shares a node.  Sets travel
with 32 bits a shingle; a pair whose verdict could hang on two sets' chance repeats is confirmed
again on 64.  Pairs within a component already found need no confirmation, so a small node first
offers a spanning forest of its best pairs; at the end, the members that still have a
promising partner in another component are compared in full, the sizes of all intersections
of a node being one product of matrices.  A large node with few classes outside its largest
component is left to that, too: these few are set against the others block by block.  What is still large at ``depth`` levels is compared
that way, too, block by block.

Nulls and texts without words have an empty set and are linked with nothing.  A row without
id is linked with nothing, has a null component and is kept.  Rows that repeat an id and its
text are one document; each repetition gets a row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from papervein.llm import batches as B
from papervein.llm import components
from papervein.llm.shared import ROWS_A_TASK, Tables, forget, gathered
from papervein.operators.joins import first_rows, fits_broadcast, sized

MINWISE = 128
PIVOT_BLOCK = 256  # sets confirmed against one copy of a pivot's set
IDS_BROADCAST_BYTES = 8 << 20
SETS_A_TASK = 4096     # compared in one task, about
MATRIX_COLUMNS = 4096  # of a node's shingles multiplied at once
CONSENSUS_ROWS = 128   # of a large node's classes that its consensus is taken from


@dataclass(frozen=True)
class Search:
    shingle: int = 5
    percent: int = 75
    trees: int = 28
    first: int = 3
    step: int = 3
    branches: int = 4
    small: int = 256
    depth: int = 15
    sketch_agreement: int = 72  # of 128; 96 expected at the threshold, 5 deviations less


def _numbers(count: int, salt: int) -> np.ndarray:
    return B.mix(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(salt))


_TIMES, _PLUS = _numbers(MINWISE, 1) | np.uint64(1), _numbers(MINWISE, 2)


def _shingles(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all shingles and the row of each, in the order of the rows."""
    data = B.LOWER[data]
    starts, ends, first = B.words(~B.SPACE[data], offsets)
    codes = B.codes_of(data, starts, ends)
    counts = np.diff(first)
    owner = np.repeat(np.arange(len(counts)), counts)
    windows = B.window_codes(codes, size)
    out, valid = np.zeros(len(starts), np.uint64), np.zeros(len(starts), bool)
    out[: len(windows)] = windows
    valid[: len(windows)] = owner[: len(windows)] == owner[size - 1 :][: len(windows)]
    for length in range(1, size):
        at = first[:-1][counts == length]
        out[at] = B.window_codes(codes, length)[at] ^ _numbers(size, 3)[length]
        valid[at] = True
    return out[valid], owner[valid]


def _distinct(codes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes of each row, sorted within the row."""
    order = np.lexsort((codes, owner))
    codes, owner = codes[order], owner[order]
    new = np.ones(len(codes), bool)
    new[1:] = (codes[1:] != codes[:-1]) | (owner[1:] != owner[:-1])
    return codes[new], owner[new]


def _profile(data: np.ndarray, offsets: np.ndarray, size: int):
    """Set size, set code (two longs) and minwise tokens of each row."""
    rows = len(offsets) - 1
    codes, owner = _shingles(data, offsets, size)
    n = np.zeros(rows, np.int64)
    sums = np.zeros((rows, 2), np.uint64)
    tokens = np.zeros((rows, MINWISE), np.uint32)
    if len(codes):
        unique, of = _distinct(codes, owner)
        n = np.bincount(of, minlength=rows)
        full = np.flatnonzero(n)
        at = np.searchsorted(of, full)
        for k in range(2):
            sums[full, k] = np.add.reduceat(B.mix(unique ^ _numbers(2, 4)[k]), at)
        work, narrow = np.empty_like(unique), np.empty(len(unique), np.uint32)
        for i in range(MINWISE):
            np.multiply(unique, _TIMES[i], out=work)
            work += _PLUS[i]
            work >>= np.uint64(32)
            narrow[:] = work
            tokens[full, i] = np.minimum.reduceat(narrow, at)
    return n, sums.view(np.int64), tokens


def profiles(docs: DataFrame, search: Search = Search()) -> DataFrame:
    """doc_id, n_shingles, the set's code, its minwise tokens and their sketch."""

    def profiled(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in parts:
            for first, end, data, offsets in B.text_slices(batch.column(1)):
                n, code, tokens = _profile(data, offsets, search.shingle)
                sketch = (tokens & 255).astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, end - first), pa.array(n), pa.array(code[:, 0]), pa.array(code[:, 1]),
                     pa.array([r.tobytes() for r in sketch], pa.binary()),
                     pa.array([r.tobytes() for r in tokens], pa.binary())],
                    names=["doc_id", "n_shingles", "code1", "code2", "sketch", "tokens"],
                )

    return docs.select("doc_id", "text").mapInArrow(
        profiled, "doc_id long, n_shingles long, code1 long, code2 long, sketch binary, tokens binary"
    )


def _descend(node: np.ndarray, tokens: np.ndarray, levels: int, branch: int = 0) -> np.ndarray:
    """The node each row comes to after some levels, by the tokens that the nodes on the way choose."""
    rows = np.arange(len(node))
    for level in range(levels):
        chosen = B.mix(node + np.uint64(0x632BE59BD9B4E019 + (branch if level == 0 else 0)))
        coordinate = (chosen % np.uint64(MINWISE)).astype(np.int64)
        node = B.mix(chosen ^ (tokens[rows, coordinate].astype(np.uint64) + np.uint64(1)))
    return node


def _start(sets: DataFrame, search: Search) -> DataFrame:
    """(node, id) of every class after the ``first`` levels of each tree."""
    roots = _numbers(search.trees, 5)

    def started(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            if not len(batch):
                continue
            tokens = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32).reshape(-1, MINWISE)
            for root in roots:
                node = _descend(np.full(len(batch), root), tokens, search.first)
                yield pa.RecordBatch.from_arrays([pa.array(node.view(np.int64)), batch.column(0)], names=["node", "id"])

    return sets.select("id", "tokens").mapInArrow(started, "node long, id long")


def _sized_nodes(members: DataFrame) -> DataFrame:
    """The members of nodes of two classes and more, with the node's size."""
    nodes = members.groupBy("node").agg(F.count("*").alias("size")).where("size > 1")
    return members.join(nodes, "node")


def _branch(members: DataFrame, search: Search) -> DataFrame:
    """(node, id, tokens) to (child, id)."""

    def branched(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            if not len(batch):
                continue
            node = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            tokens = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint32).reshape(-1, MINWISE)
            for branch in range(search.branches):
                child = _descend(node, tokens, search.step, branch)
                yield pa.RecordBatch.from_arrays([pa.array(child.view(np.int64)), batch.column(1)], names=["node", "id"])

    return members.select("node", "id", "tokens").mapInArrow(branched, "node long, id long")


def _hubs(members: DataFrame, rows: int, narrow: DataFrame, tables: Tables) -> DataFrame:
    """(node, pivot, pivot_n, pivot_sketch): the member of each large node that agrees most with
    its consensus; ``members``: (node, id, n, sketch), written.

    There are ``small`` times fewer nodes than members, so members meet their node's row by a
    broadcast and need not be shuffled for it, as long as these rows fit one.
    """

    def consensus(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            common = []
            for rows in batch.column(1):
                matrix = np.frombuffer(b"".join(rows.as_py()), np.uint8).reshape(-1, MINWISE)
                flat = matrix.astype(np.int64) + 256 * np.arange(MINWISE)
                times = np.bincount(flat.ravel(), minlength=256 * MINWISE).reshape(MINWISE, 256)
                common.append(times.argmax(1).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(common, pa.binary())], names=["node", "consensus"])

    def agreeing(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            left, right = (B.text_bytes(batch.column(k))[0].reshape(-1, MINWISE) for k in (2, 3))
            agree = (left == right).sum(1).astype(np.int32) if len(batch) else np.empty(0, np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(agree, pa.int32())], names=["node", "id", "agree"]
            )

    some = first_rows(members.select("node", "id", "sketch"), "node", CONSENSUS_ROWS, F.xxhash64("id"), F.asc("id"))
    sampled = gathered(some.groupBy("node").agg(F.collect_list("sketch").alias("rows")), rows)
    common = tables.write(
        sampled.mapInArrow(consensus, "node long, consensus binary"),
        "consensus",
    )
    few = F.broadcast if fits_broadcast(common) else (lambda df: df)
    scored = members.join(few(common), "node").select("node", "id", "sketch", "consensus").mapInArrow(agreeing, "node long, id long, agree int")
    best = scored.groupBy("node").agg(F.max(F.struct("agree", F.negative("id").alias("id"))).alias("best"))
    hubs = tables.write(gathered(best, rows).select("node", F.negative("best.id").alias("pivot")), "hubs")
    other = narrow.select(F.col("id").alias("pivot"), F.col("n").alias("pivot_n"), F.col("sketch").alias("pivot_sketch"))
    return few(other.join(few(hubs), "pivot"))


def _agreeing(ids, n, labels, sketch, search: Search) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of a node's rows, across labels, that may be linked: larger row, smaller row, agreement."""
    left, right, agreement = [], [], []
    for k in range(1, len(ids)):
        agree = (sketch[:k] == sketch[k]).sum(1)
        low, high = np.minimum(n[:k], n[k]), np.maximum(n[:k], n[k])
        good = (agree >= search.sketch_agreement) & (100 * low >= search.percent * high) & (labels[:k] != labels[k])
        found = np.flatnonzero(good & (ids[:k] != ids[k]))
        left.append(np.full(len(found), k))
        right.append(found)
        agreement.append(agree[found])
    left, right, agreement = (np.concatenate(x or [np.empty(0, np.int64)]) for x in (left, right, agreement))
    return left, right, agreement


def _forest(ids, labels, left, right, agreement) -> list[int]:
    """Of a node's pairs a spanning forest of the best, one pair fewer than rows at most."""
    _, group = np.unique(labels, return_inverse=True)
    chosen = []
    for p in np.lexsort((ids[right], ids[left], -agreement)):
        x, y = group[left[p]], group[right[p]]
        if x != y:
            group[group == x] = y
            chosen.append(p)
    return chosen


PAIRS = "a long, b long, agree int"


def _nodes_of(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(group, ids, sizes, labels, sketches) of each collected node, by id."""
    rows = batch.column(1)
    cut = rows.offsets.to_numpy() - rows.offsets[0].as_py()
    ids, n, sketches, labels = rows.flatten().flatten()
    ids, n, labels = (x.to_numpy(zero_copy_only=False) for x in (ids, n, labels))
    sketch = B.text_bytes(sketches)[0].reshape(-1, MINWISE)
    for group, i, j in zip(batch.column(0).to_pylist(), cut, cut[1:]):
        order = i + np.argsort(ids[i:j], kind="stable")
        yield group, ids[order], n[order], labels[order], sketch[order]


def _collected(members: DataFrame, rows: int) -> DataFrame:
    """Nodes of bounded size as one row each; ``members``: (group, id, n, sketch, label)."""
    grouped = members.groupBy("group").agg(F.collect_list(F.struct("id", "n", "sketch", "label")).alias("rows"))
    return gathered(grouped, rows).where(F.size("rows") > 1).select("group", "rows")


def _small_pairs(members: DataFrame, rows: int, search: Search) -> DataFrame:
    """The best spanning forest of each small node's promising pairs."""

    def compared(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            found = []
            for _, ids, n, labels, sketch in _nodes_of(batch):
                left, right, agreement = _agreeing(ids, n, labels, sketch, search)
                chosen = _forest(ids, labels, left, right, agreement)
                found.append((ids[left[chosen]], ids[right[chosen]], agreement[chosen]))
            columns = [np.concatenate([f[k] for f in found] or [np.empty(0, np.int64)]) for k in range(3)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int32()))], names=["a", "b", "agree"]
            )

    return _collected(members, rows).mapInArrow(compared, PAIRS)


def _undecided(members: DataFrame, rows: int, search: Search) -> DataFrame:
    """(group, id, label) of the members with any promising partner across components."""

    def promising(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            out: list[tuple[np.ndarray, ...]] = []
            for group, ids, n, labels, sketch in _nodes_of(batch):
                left, right, _ = _agreeing(ids, n, labels, sketch, search)
                some = np.union1d(left, right).astype(np.int64)
                out.append((np.full(len(some), group), ids[some], labels[some]))
            columns = [np.concatenate([o[k] for o in out] or [np.empty(0, np.int64)]) for k in range(3)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["group", "id", "label"])

    return _collected(members, rows).mapInArrow(promising, "group long, id long, label long")


def _intersections(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sizes of the sets of distinct codes, and of all their intersections."""
    sizes = np.array([len(x) for x in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    flat = np.concatenate(sets)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    new = np.ones(len(flat), bool)
    new[1:] = flat[1:] != flat[:-1]
    column = np.cumsum(new) - 1
    shared = np.bincount(column)[column] > 1 if len(column) else np.zeros(0, bool)
    owner, column = owner[shared], column[shared]
    common = np.diag(sizes).astype(np.float64)
    np.fill_diagonal(common, 0)
    if len(column):
        column = np.cumsum(np.append(True, column[1:] != column[:-1])) - 1
        for low in range(0, int(column[-1]) + 1, MATRIX_COLUMNS):
            i, j = np.searchsorted(column, (low, low + MATRIX_COLUMNS))
            matrix = np.zeros((len(sets), min(MATRIX_COLUMNS, int(column[-1]) + 1 - low)), np.float32)
            matrix[owner[i:j], column[i:j] - low] = 1
            common += matrix @ matrix.T
    np.fill_diagonal(common, sizes)
    return sizes, np.rint(common).astype(np.int64)


def _exhaustive(members: DataFrame, count: int, sets: DataFrame, search: Search) -> DataFrame:
    """Links (u, v) across components of small nodes, by comparing all their full sets.

    ``members``: (group, id, label).  Sets of a node stream in one after the other; of the
    links only a spanning forest is given.
    """

    def links(ids: list, labels: list, sizes: list, packed: list) -> Iterator[tuple[int, int, bool]]:
        if len(ids) < 2:
            return
        brief, common = _intersections([np.frombuffer(p, "<u4") for p in packed])
        n = np.array(sizes)
        sure, may = _verdicts(common, n[:, None], n[None, :], brief[:, None], brief[None, :], search.percent)
        _, group = np.unique(labels, return_inverse=True)
        across = np.tril(may & (group[:, None] != group[None, :]), -1)
        for k, j in np.argwhere(across & sure):
            if group[j] != group[k]:
                group[group == group[j]] = group[k]
                yield ids[k], ids[j], True
        for k, j in np.argwhere(across & ~sure):
            if group[j] != group[k]:
                yield ids[k], ids[j], False

    def compared(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, ([], [], [], [])
        for batch in parts:
            found: list[tuple[int, int, bool]] = []
            for group, *row in zip(*(batch.column(k).to_pylist() for k in range(5))):
                if group != current:
                    found += links(*held)
                    current, held = group, ([], [], [], [])
                for column, value in zip(held, row):
                    column.append(value)
            yield _link_batch(found)
        yield _link_batch(list(links(*held)))

    rows = members.join(sets.select("id", "n", "brief"), "id").select("group", "id", "label", "n", "brief")
    dealt = gathered(rows.repartition("group"), count, SETS_A_TASK)
    return dealt.sortWithinPartitions("group", "id").mapInArrow(compared, LINKS)


def _link_batch(found: list[tuple[int, int, bool]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([p[k] for p in found], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.bool_()))],
        names=["u", "v", "sure"],
    )


def _hub_pairs(members: DataFrame, rows: int, narrow: DataFrame, tables: Tables, search: Search) -> DataFrame:
    """Candidate pairs of large nodes: every member with the node's hub."""

    def compared(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            if not len(batch):
                continue
            left, right = (
                np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(-1, MINWISE) for k in (2, 3)
            )
            agree = (left == right).sum(1).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(agree)], names=["a", "b", "agree"]
            ).filter(pa.array(agree >= search.sketch_agreement))

    return (
        members.join(_hubs(members, rows, narrow, tables), "node")
        .where(F.col("id") != F.col("pivot"))
        .where(100 * F.least("n", "pivot_n") >= search.percent * F.greatest("n", "pivot_n"))
        .select("id", "pivot", "sketch", "pivot_sketch")
        .mapInArrow(compared, PAIRS)
    )


def _block_pairs(members: DataFrame, search: Search) -> DataFrame:
    """Nodes that stay large, cut for a comparison in full: all pairs of blocks of members.

    ``members``: (node, id, n, sketch, label, size).  A block holds about ``small`` members.
    """
    blocks = F.ceil(F.col("size") / search.small).cast("long")
    cut = members.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("id", "node"), "blocks"))
    paired = cut.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    group = F.xxhash64("node", F.least("block", "other"), F.greatest("block", "other"))
    return paired.withColumn("group", group).select("group", "id", "n", "sketch", "label")


def _full_sets(docs: DataFrame, ids: DataFrame, search: Search) -> DataFrame:
    """(id, n, packed, brief) of the documents with the given ids, once a task: the set's size,
    its sorted codes of 64 bits, and the distinct upper halves of these.

    Rows that repeat an id hold the same text.
    """

    def packed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in parts:
            ids = batch.column(0).to_pylist()
            new = [i not in seen and not seen.add(i) for i in ids]
            batch = batch.filter(pa.array(new, pa.bool_()))
            for first, end, data, offsets in B.text_slices(batch.column(1)):
                codes, owner = _shingles(data, offsets, search.shingle)
                codes, owner = _distinct(codes, owner)
                cut = np.searchsorted(owner, np.arange(end - first + 1))
                own = [codes[cut[k] : cut[k + 1]] for k in range(end - first)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, end - first), pa.array(np.diff(cut)),
                     pa.array([c.astype("<u8").tobytes() for c in own], pa.binary()),
                     pa.array([np.unique(c >> np.uint64(32)).astype("<u4").tobytes() for c in own], pa.binary())],
                    names=["id", "n", "packed", "brief"],
                )

    chosen = docs.select("doc_id", "text").join(
        sized(ids.select(F.col("id").alias("doc_id")), IDS_BROADCAST_BYTES), "doc_id", "left_semi"
    )
    return chosen.mapInArrow(packed, "id long, n long, packed binary, brief binary")


def _verdicts(common, n, other, brief, other_brief, percent: int):
    """Whether sets of ``n`` and ``other`` shingles are linked for sure, and whether they may be.

    ``common`` counts equal upper halves.  Shingles of one set that share a half are known by
    number; chance repeats across two sets are few: two, and far more than are to be expected.
    """
    chance = brief * (other_brief / 2.0**32)
    least = common - (2 + 2 * chance + 8 * np.sqrt(chance))
    most = common + np.maximum(n - brief, other - other_brief)
    return 100 * least >= percent * (n + other - least), 100 * most >= percent * (n + other - most)


LINKS = "u long, v long, sure boolean"


def _confirmed(pairs: DataFrame, rows: int, sets: DataFrame, search: Search, brief: bool = True) -> DataFrame:
    """The pairs (a, b) that are linked on their full sets, for sure or perhaps.

    All a's of one b are confirmed against it in blocks of about ``PIVOT_BLOCK``: each block
    gets one copy of b's set ahead of the sets of its a's, which stream past it.
    """
    many = pairs.groupBy("b").agg(F.ceil(F.count("*") / PIVOT_BLOCK).cast("long").alias("blocks"))
    # One b in as many pairs has more than one block, so these are few.
    wide = F.broadcast(many.where("blocks > 1"))
    own = F.pmod(F.xxhash64("a"), F.coalesce("blocks", F.lit(1).cast("long")))
    held = sets.select("id", "n", F.col("brief" if brief else "packed").alias("codes"))
    asked = pairs.join(wide, "b", "left").select(F.col("a").alias("id"), "b", F.xxhash64("b", own).alias("block"), F.lit(1).alias("turn"))
    ahead = (
        many.select("b", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("own"))
        .select(F.col("b").alias("id"), "b", F.xxhash64("b", "own").alias("block"), F.lit(0).alias("turn"))
    )
    kind = "<u4" if brief else "<u8"

    def checked(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, pivot, pivot_n = None, None, 0
        for batch in parts:
            found = []
            rows = zip(*(batch.column(k).to_pylist() for k in range(6)))
            for block, b, a, n, packed, turn in rows:
                codes = np.frombuffer(packed, kind)
                if turn == 0:
                    current, pivot, pivot_n = (block, b), codes, n
                    continue
                assert current == (block, b)
                common = len(np.intersect1d(pivot, codes, assume_unique=True))
                if brief:
                    sure, may = _verdicts(common, n, pivot_n, len(codes), len(pivot), search.percent)
                else:
                    sure = may = 100 * common >= search.percent * (n + pivot_n - common)
                if may:
                    found.append((a, b, bool(sure)))
            yield _link_batch(found)

    met = asked.union(ahead).join(held, "id").select("block", "b", F.col("id").alias("a"), "n", "codes", "turn")
    dealt = gathered(met.repartition("block"), 2 * rows, SETS_A_TASK)
    return dealt.sortWithinPartitions("block", "b", "turn").mapInArrow(checked, LINKS)


def _settled(found: DataFrame, sets: DataFrame, groups: _Groups, tables: Tables, search: Search) -> None:
    """Take over links that are sure, and of the others those that 64 bits confirm."""
    links = tables.write(found, "links")
    unsure = links.where("NOT sure").select(F.col("u").alias("a"), F.col("v").alias("b")).distinct()
    rows = unsure.count()
    if rows:
        links = tables.write(links.where("sure").union(_confirmed(unsure, rows, sets, search, brief=False)), "links")
    if not links.isEmpty():
        groups.link(links.select("u", "v"))


class _Groups:
    """The components found so far, of set classes."""

    def __init__(self, spark: SparkSession, tables: Tables):
        self.tables = tables
        self.labels = self.known = spark.createDataFrame([], "id long, label long")

    def label(self, df: DataFrame, name: str) -> DataFrame:
        """The label of a column of ids, as ``<name>_label``."""
        own = self.known.select(F.col("id").alias(name), F.col("label").alias("_label"))
        return df.join(own, name, "left").withColumn(f"{name}_label", F.coalesce("_label", name)).drop("_label")

    def link(self, links: DataFrame) -> None:
        stars = self.labels.select(F.col("id").alias("u"), F.col("label").alias("v"))
        self.labels = components.connected(self.tables, links.union(stars))
        self.known = sized(self.labels)


def _settle(pairs: DataFrame, most: int, sets: DataFrame, groups: _Groups, tables: Tables, search: Search) -> None:
    """Confirm or refute candidate pairs, each once however many nodes offer it."""
    pairs = tables.write(gathered(pairs.select("a", "b").distinct(), most), "pairs")
    rows = pairs.count()
    if not rows:
        return
    _settled(_confirmed(pairs, rows, sets, search), sets, groups, tables, search)
    tables.drop(pairs)


def _link_classes(sets: DataFrame, docs: DataFrame, tables: Tables, search: Search) -> DataFrame:
    """Labels (id, label) of linked classes; ``sets``: (id, n, sketch, tokens)."""
    groups = _Groups(docs.sparkSession, tables)
    start = tables.write(_start(sets, search), "start")
    inside = tables.write(gathered(_sized_nodes(start), start.count(), 8 * ROWS_A_TASK), "inside")
    tables.drop(start)
    if inside.isEmpty():
        return groups.labels
    narrow = sets.select("id", "n", "sketch")
    full = tables.write(_full_sets(docs, inside.select("id").distinct(), search), "full")
    if not full.groupBy("id").count().where("count > 1").isEmpty():
        full = tables.write(full.dropDuplicates(["id"]), "full")
    levels: list[DataFrame] = []
    current, depth = inside.withColumn("id_label", F.col("id")), search.first
    while True:
        small = current.where(F.col("size") <= search.small)
        large = current.where(F.col("size") > search.small)
        levels.append(small)
        some_large = not large.isEmpty()
        rows = current.count()
        pairs = _small_pairs(_ready(small, narrow).withColumnRenamed("node", "group"), rows, search)
        if some_large:
            ready = tables.write(gathered(_ready(large, narrow), rows), "ready")
            pairs = pairs.union(_hub_pairs(ready, rows, narrow, tables, search))
        _settle(pairs, rows, full, groups, tables, search)
        if not some_large:
            break
        tables.drop(ready)
        told = _told(large, rows, groups, tables)
        levels.append(_lopsided(told, search))
        large = told.where(F.col("few") > search.small).select("node", "id", "size", "id_label")
        if large.isEmpty():
            break
        if depth + search.step > search.depth:
            _compare_fully(_block_pairs(_ready(large, narrow), search), rows * rows // search.small, full, groups, tables, search)
            break
        grown = _branch(large.select("node", "id").join(sets.select("id", "tokens"), "id"), search)
        current = tables.write(gathered(_open(grown, groups), search.branches * rows), "inside")
        depth += search.step
    # All that the small nodes of all levels still leave across components.
    left = reduce(DataFrame.union, (level.select("node", "id") for level in levels))
    rows = left.count()
    _compare_fully(_ready(_open(left, groups), narrow).withColumnRenamed("node", "group"), rows, full, groups, tables, search)
    tables.drop(full)
    return groups.labels


def _told(large: DataFrame, rows: int, groups: _Groups, tables: Tables) -> DataFrame:
    """The members of large nodes that are not yet one component, with their labels, the node's
    largest component ``top (n, label)`` and the ``few`` classes outside it."""
    labelled = groups.label(large.drop("id_label"), "id")
    parts = labelled.groupBy("node", "id_label").agg(F.count("*").alias("n"))
    tops = parts.groupBy("node").agg(F.max(F.struct("n", F.col("id_label").alias("label"))).alias("top"), F.sum("n").alias("all"))
    tops = tops.select("node", "top", (F.col("all") - F.col("top.n")).alias("few")).where("few > 0")
    return tables.write(labelled.join(sized(tables.write(gathered(tops, rows), "tops")), "node"), "large")


def _lopsided(told: DataFrame, search: Search) -> DataFrame:
    """Of open large nodes those with at most ``small`` classes outside their largest component,
    as nodes of these few and a block of the others each."""
    blocks = F.ceil(F.col("top.n") / search.small).cast("long")
    own = F.pmod(F.xxhash64("id", "node"), blocks)
    block = F.when(F.col("id_label") == F.col("top.label"), F.array(own)).otherwise(F.sequence(F.lit(0).cast("long"), blocks - 1))
    few = told.where(F.col("few") <= search.small).withColumn("block", F.explode(block))
    return few.select(F.xxhash64("node", "block").alias("node"), "id", "size", "id_label")


def _ready(members: DataFrame, narrow: DataFrame) -> DataFrame:
    """Labelled members with size and sketch of their sets."""
    return members.join(narrow, "id").withColumnRenamed("id_label", "label")


def _compare_fully(members: DataFrame, most: int, sets: DataFrame, groups: _Groups, tables: Tables, search: Search) -> None:
    """Link what the members of each group link across components; (group, id, n, sketch, label)."""
    members = tables.write(_undecided(members, most, search), "undecided")
    rows = members.count()
    if not rows:
        return
    _settled(_exhaustive(members, rows, sets, search), sets, groups, tables, search)


def _open(members: DataFrame, groups: _Groups) -> DataFrame:
    """The members (node, id) of nodes whose classes are in more than one component, with their
    labels and the node's size."""
    labelled = groups.label(members, "id")
    nodes = (
        labelled.groupBy("node")
        .agg(F.count("*").alias("size"), F.min("id_label").alias("low"), F.max("id_label").alias("high"))
        .where("low <> high").select("node", "size")
    )
    return labelled.join(nodes, "node")


def _classified(found: DataFrame, docs: DataFrame, tables: Tables, search: Search) -> DataFrame:
    """doc_id, n_shingles, component_id and kept; ``found``: the written profiles of documents
    with own ids, which is dropped."""
    sets = tables.write(
        found.where("doc_id IS NOT NULL AND n_shingles > 0").groupBy("code1", "code2")
        .agg(F.min("doc_id").alias("id"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch"),
             F.first("tokens").alias("tokens")),
        "sets",
    )
    # The minwise tokens, by far the most of the profiles, are in the sets now.
    own = tables.write(found.select("doc_id", "n_shingles", "code1", "code2"), "codes")
    tables.drop(found)
    labels = _link_classes(sets, docs, tables, search)
    classes = (
        sets.select("code1", "code2", "id").join(labels, "id", "left")
        .select("code1", "code2", F.coalesce("label", "id").alias("class_id"))
    )
    own = own.join(classes, ["code1", "code2"], "left")
    component = F.when(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), F.col("class_id")).otherwise(F.col("doc_id"))
    return own.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def _of_two_texts(found: DataFrame, tables: Tables) -> DataFrame | None:
    """The ids that rows with different sets of shingles share; None if there are none."""
    code = F.struct("code1", "code2")
    sets = found.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(code).alias("low"), F.max(code).alias("high"))
    shared = tables.write(sets.where("low <> high").select("doc_id"), "shared")
    return None if shared.isEmpty() else shared


def _own_ids(docs: DataFrame, shared: DataFrame) -> DataFrame:
    """(doc_id, text, given, row): another id for each text of a shared id, the given id, the row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").alias("given"), "text", F.struct(*docs.columns).alias("row"))
    marks = shared.select(F.col("doc_id").alias("given"), F.lit(True).alias("mark"))
    own = F.when(F.col("mark"), F.xxhash64("given", text)).otherwise(F.col("given"))
    return rows.join(marks, "given", "left").select(own.alias("doc_id"), "text", "given", "row")


def _decided(docs: DataFrame, search: Search) -> tuple[DataFrame, DataFrame | None]:
    """The classified documents; where ids are shared, also their rows by own ids.

    Then doc_id, component_id and kept are by own ids, and ``given`` and ``first`` are the
    given ids of the document and of its component.
    """
    tables = Tables(docs.sparkSession, "near-dup")
    found = tables.write(profiles(docs, search), "profiles")
    shared = _of_two_texts(found, tables)
    if shared is None:
        return _classified(found, docs, tables, search), None
    own = _own_ids(docs, shared)
    found = tables.write(profiles(own, search), "profiles")
    rows = tables.write(_classified(found, own.select("doc_id", "text"), tables, search), "classified")
    # The first of a component is the document with the smallest given id.
    given = own.select("doc_id", "given").where("doc_id IS NOT NULL").distinct()
    named = rows.join(given, "doc_id", "left")
    first = (
        named.where("component_id IS NOT NULL").groupBy("component_id")
        .agg(F.min(F.struct("given", "doc_id")).alias("first"))
    )
    rows = named.join(first, "component_id", "left").select(
        "doc_id", "given", "n_shingles", F.col("first.given").alias("first"),
        F.coalesce(F.col("doc_id") == F.col("first.doc_id"), F.lit(True)).alias("kept"),
    )
    return rows, own


def classify(docs: DataFrame, search: Search = Search()) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document.

    Different texts under one id are documents of their own; a component is named by the
    smallest id in it, so two components can have one name.
    """
    rows, own = _decided(docs, search)
    if own is None:
        return rows
    return rows.select(F.col("given").alias("doc_id"), "n_shingles", F.col("first").alias("component_id"), "kept")


def keep_first(docs: DataFrame, search: Search = Search()) -> DataFrame:
    """One document of each group, with all its columns.

    Of rows that repeat both id and text one stays.
    """
    rows, own = _decided(docs, search)
    kept = Tables(docs.sparkSession, "near-dup-kept").write(rows.where("kept").select("doc_id"), "kept")
    ids = kept.where("doc_id IS NOT NULL")
    if own is None:
        out = docs.join(ids.distinct().hint("shuffle_hash"), "doc_id", "left_semi")
    else:
        out = own.join(ids.distinct().hint("shuffle_hash"), "doc_id", "left_semi")
    if not ids.groupBy("doc_id").count().where("count > 1").isEmpty():
        out = out.dropDuplicates(["doc_id"])
    if own is not None:
        out = out.select("row.*")
    return out.select(*docs.columns).union(docs.where("doc_id IS NULL").select(*docs.columns))
