"""Density topics by neighbours: points are counted within a radius, wherever the grid lies.

A point is a core point if at least ``min_points`` points, itself included, lie within
``radius`` of it.  Core points within the radius of each other share a topic; all other
points are noise.  The answer depends on distances only.  The grid merely says which
distances need no looking at:

- A cell's diagonal is the radius, so all points of a cell are neighbours.  A cell of
  ``min_points`` points has core points only, and its points are one node, however many.
- Space is dealt into blocks of cells, each with the cells around it that are in reach.  A task
  measures a block's points against a few positions of every cell there, which decides what
  lies in sparse cells and most of the rest.
- What only a full cell's other positions can decide is opened box by box: a box wholly within
  the radius counts as a whole, one wholly outside not at all, and only boxes that the sphere
  cuts are opened further, until few positions are left to measure.  Of two cells of core points
  one close pair suffices, so pairs that are connected anyway are left alone.

So no two points of a full cell are ever compared, equal points are one position with a
count, and work grows with the number of points.  Distances are summed in the order of the
dimensions, so they are the same on every engine.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from papervein.operators.checkpoints import cut_lineage, written
from papervein.operators.joins import first_rows, numbered_rows, sized

NOISE = -1
# A box is cut into this many parts along each dimension when it is opened.
PARTS = 4
# Beyond this depth, boxes are finer than any coordinate needs: what is left is measured.
DEEPEST = 12
# Sums of squares are trusted to this relative error; what is closer to the radius is measured.
SLACK = 1e-9
# Blocks are so many cells wide, the widest that hold at most so many of the positions measured,
# in at most so many dimensions.
WIDTHS, BLOCK_POSITIONS, BLOCK_DIMS = (64, 32, 16, 10, 7, 5), 16384, 5
# A task measures so many positions at once against so many others.
ROWS, COLUMNS = 128, 8192


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``(id, component)``: the smallest id reachable; ``edges (a, b)`` hold both directions.

    Each round takes the smallest label among the neighbours, then the label's own label,
    so long chains close in few rounds.  Rounds are written, so that no plan grows with them,
    and merged: tables that look small on disk would each be held by the driver.
    """
    edges = written(edges.select("a", "b").distinct())
    labels = nodes.select("id", F.col("id").alias("component"))
    while True:
        seen = labels.select(F.col("id").alias("b"), F.col("component").alias("_seen"))
        best = edges.join(seen.hint("merge"), "b").groupBy("a").agg(F.min("_seen").alias("_best"))
        stepped = labels.join(best.hint("merge"), labels["id"] == best["a"], "left").select(
            "id", F.col("component").alias("_old"),
            F.least("component", F.coalesce("_best", "component")).alias("component"),
        )
        jump = stepped.select(F.col("id").alias("component"), F.col("component").alias("_jump"))
        moved = written(stepped.join(jump.hint("merge"), "component").select(
            "id", "_old", F.col("_jump").alias("component")
        ))
        labels = moved.select("id", "component")
        if moved.where(F.col("component") != F.col("_old")).isEmpty():
            return labels


def _sum(terms: Column) -> Column:
    return F.aggregate(terms, F.lit(0.0), lambda total, t: total + t)


def squared_distance(x: Column, y: Column) -> Column:
    return _sum(F.zip_with(x, y, lambda a, b: (a - b) * (a - b)))


def _boxes_apart(a: Column, b: Column, side: float) -> tuple[Column, Column]:
    """Least and greatest squared distance of points of two boxes of a side length."""
    gaps = F.zip_with(a, b, lambda p, q: F.greatest(F.abs(p - q) - 1, F.lit(0)).cast("double"))
    spans = F.zip_with(a, b, lambda p, q: (F.abs(p - q) + 1).cast("double"))
    return (
        _sum(F.transform(gaps, lambda g: g * g)) * (side * side),
        _sum(F.transform(spans, lambda s: s * s)) * (side * side),
    )


def _box_from(x: Column, box: Column, side: float) -> tuple[Column, Column]:
    """Least and greatest squared distance of a point to points of a box."""
    before = F.zip_with(x, box, lambda c, p: p * side - c)
    behind = F.zip_with(x, box, lambda c, p: c - (p + 1) * side)
    least = F.zip_with(before, behind, lambda a, b: F.greatest(a, b, F.lit(0.0)))
    greatest = F.zip_with(before, behind, lambda a, b: F.greatest(F.abs(a), F.abs(b)))
    return _sum(F.transform(least, lambda g: g * g)), _sum(F.transform(greatest, lambda g: g * g))


def _matrix(table: pa.Table, name: str, dims: int) -> np.ndarray:
    return table[name].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _lists(matrix: np.ndarray) -> pa.Array:
    ends = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(matrix.ravel()))


def _close_pairs(x: np.ndarray, y: np.ndarray, radius: float, limit: float, labels=None) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """(rows of x, rows of y, which are close), so many at a time; rows of y are those around the rows of x.

    ``labels()`` gives the labels of both; others of the one label that the rows of x have are left out.
    """
    order = np.argsort(y[:, 0], kind="stable")
    y = y[order]
    slack = radius * 1e-6 + 8 * np.spacing(max(np.abs(x).max(initial=0), np.abs(y).max(initial=0)))
    for start in range(0, len(x), ROWS):
        rows = slice(start, min(len(x), start + ROWS))
        low, high = x[rows].min(0) - radius - slack, x[rows].max(0) + radius + slack
        begin, end = np.searchsorted(y[:, 0], low[0], "left"), np.searchsorted(y[:, 0], high[0], "right")
        there = ((y[begin:end, 1:] >= low[1:]) & (y[begin:end, 1:] <= high[1:])).all(1)
        if labels is not None:
            own, other = labels()
            if (own[rows] == own[start]).all():
                there &= other[order[begin:end]] != own[start]
        there = np.flatnonzero(there) + begin
        for first in range(0, len(there), COLUMNS):
            some = there[first : first + COLUMNS]
            far = np.zeros((rows.stop - start, len(some)))
            for d in range(x.shape[1]):
                gap = x[rows, d, None] - y[some, d]
                far += gap * gap
            yield rows, order[some], far <= limit


def _merged(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels, each the least index of its group, after the groups of a and b have been joined."""
    while True:
        low, high = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
        apart = low < high
        if not apart.any():
            return label
        a, b = low[apart], high[apart]
        label = label.copy()
        np.minimum.at(label, b, a)
        while (label[label] != label).any():
            label = label[label]


class Density:
    """Core points and their connections, of ``positions (x, n, cell)`` in a number of dimensions.

    ``few`` positions of a box are measured one by one.
    """

    def __init__(self, dims: int, radius: float, min_points: int, few: int = 64):
        self.dims, self.radius, self.min_points, self.few = dims, radius, min_points, few
        # A little less than the radius over the root of the dimensions, so that rounding
        # never puts two points of a cell further apart than the radius.
        self.side = radius / math.sqrt(dims) * (1 - 1e-6)
        self.limit = radius * radius

    def box(self, x: Column, depth: int = 0) -> Column:
        side = self.side / PARTS**depth
        return F.transform(x, lambda c: F.floor(c / F.lit(side)))

    def placed(self, points: DataFrame, position: str, name: str) -> DataFrame:
        """Add the position as doubles; NULL if it is null, incomplete or not finite.

        A generated column: the expression behind ``position`` is evaluated once a point.
        """
        x = F.col(position).cast("array<double>")
        given = points.select("*", F.inline(F.array(F.struct(x.alias("_given")))))
        usable = (F.size("_given") == self.dims) & ~F.exists(
            "_given", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == math.inf)
        )
        return given.withColumn(name, F.when(usable, F.col("_given"))).drop("_given")

    def positions(self, points: DataFrame, position: str) -> DataFrame:
        """Distinct positions with their number of points; incomplete ones are left out."""
        whole = self.placed(points.select(position), position, "x").where("x IS NOT NULL").select("x")
        counted = whole.groupBy("x").agg(F.count(F.lit(1)).alias("n"))
        return cut_lineage(counted.withColumn("cell", self.box(F.col("x"))))

    def _blocks(self, rows: DataFrame, most: int) -> int:
        """The width of the blocks for ``rows (cell, k)``, of which ``most`` of a cell are measured."""
        for width in WIDTHS:
            sums = rows.groupBy(*self._home(width)).agg(F.sum(F.least("k", F.lit(most))).alias("_n"))
            if width == WIDTHS[-1] or (sums.agg(F.max("_n")).first()[0] or 0) <= BLOCK_POSITIONS:
                return width

    def _home(self, width: int) -> list[Column]:
        return [F.floor(F.get("cell", F.lit(d)) / width) for d in range(min(self.dims, BLOCK_DIMS))]

    def _dealt(self, rows: DataFrame, width: int, once: bool) -> DataFrame:
        """Rows with ``block`` and ``own``, in their own block and in all that have them in reach.

        With ``once``, of two blocks only the first in order gets the other one's rows.
        """
        reach = 1 + math.isqrt(self.dims)
        names = [f"_b{d}" for d in range(min(self.dims, BLOCK_DIMS))]
        dealt = rows
        for d, name in enumerate(names):
            at = F.get("cell", F.lit(d))
            dealt = dealt.withColumn(name, F.explode(F.sequence(F.floor((at - reach) / width), F.floor((at + reach) / width))))
        block, home = F.array(*names), F.array(*self._home(width))
        if once:
            dealt = dealt.where(block <= home)
        return dealt.withColumn("own", block == home).withColumn("block", F.xxhash64(block)).drop(*names)

    def _grouped(self, dealt: DataFrame):
        tasks = int(dealt.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        return dealt.repartition(tasks, "block").groupBy("block")

    def _opened(self, positions: DataFrame, boxes: DataFrame, depth: int) -> DataFrame:
        """``(box, part, n, k)``: the parts of boxes one step deeper, with points and positions."""
        parts = positions.select("n", self.box(F.col("x"), depth).alias("box"), self.box(F.col("x"), depth + 1).alias("part"))
        wanted = parts.join(boxes.select("box").distinct(), "box", "left_semi")
        return wanted.groupBy("box", "part").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"))

    def core(self, positions: DataFrame) -> DataFrame:
        """``(x, n, cell, dense)``: the positions of core points."""
        cells = cut_lineage(positions.groupBy("cell").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k")))
        dense = F.col("n") >= self.min_points
        most = 2 * self.min_points
        width = self._blocks(cells, most)
        offered = first_rows(positions, "cell", most, F.asc("x")).join(
            cells.select("cell", "k", (~dense).alias("asks")), "cell"
        )
        asked = cells.where(~dense).select(F.xxhash64(F.array(*self._home(width))).alias("block")).distinct()
        dealt = self._dealt(offered, width, False).join(sized(asked), "block", "left_semi")
        counted = cut_lineage(self._grouped(dealt.select("block", "own", "asks", "cell", "x", "n", "k")).applyInArrow(
            self._count_task(most), "x array<double>, cell array<bigint>, n long, sure long, near array<array<bigint>>"
        ))
        near_enough = counted.where(F.col("n") >= self.min_points).select("x")
        # Only what full cells' other positions may decide goes on.
        undecided = counted.where((F.col("n") < self.min_points) & (F.size("near") > 0))
        if not undecided.isEmpty():
            pairs = undecided.select("x", F.explode("near").alias("cell")).join(cells, "cell").select(
                "x", F.col("cell").alias("box"), "n", "k"
            )
            near_enough = near_enough.union(self._core_by_opening(positions, pairs, undecided.select("x", F.col("sure").alias("n"))))
        found = near_enough.join(positions, "x").select("x", "n", "cell")
        full = positions.join(cells.where(dense).select("cell"), "cell", "left_semi")
        return cut_lineage(
            found.withColumn("dense", F.lit(False)).unionByName(full.select("x", "n", "cell").withColumn("dense", F.lit(True)))
        )

    def _count_task(self, most: int):
        """Of a block's sparse positions: the points in reach, those outside cut cells, and cut cells in reach."""
        dims, radius, side, limit, min_points = self.dims, self.radius, self.side, self.limit, self.min_points

        def task(table: pa.Table) -> pa.Table:
            cell, x = _matrix(table, "cell", dims), _matrix(table, "x", dims)
            n, k = table["n"].to_numpy().astype(float), table["k"].to_numpy()
            asked = np.flatnonzero(table["own"].to_numpy() & table["asks"].to_numpy())
            asked = asked[np.lexsort(cell[asked].T[::-1])]
            whole = np.where(k > most, 0.0, n)
            total, sure = np.zeros(len(asked)), np.zeros(len(asked))
            for rows, others, close in _close_pairs(x[asked], x, radius, limit):
                total[rows] += close @ n[others]
                sure[rows] += close @ whole[others]
            near = [[] for _ in asked]
            cut = np.unique(cell[k > most], axis=0)
            if len(cut):
                for i in np.flatnonzero(total < min_points).tolist():
                    p = x[asked[i]]
                    gaps = np.maximum(np.maximum(cut * side - p, p - (cut + 1) * side), 0)
                    near[i] = cut[(gaps * gaps).sum(1) <= limit * (1 + SLACK)].tolist()
            return pa.table({
                "x": table["x"].take(pa.array(asked)), "cell": table["cell"].take(pa.array(asked)),
                "n": total.astype(np.int64), "sure": sure.astype(np.int64), "near": pa.array(near, pa.list_(pa.list_(pa.int64()))),
            })

        return task

    def _core_by_opening(self, positions: DataFrame, pairs: DataFrame, sure: DataFrame) -> DataFrame:
        """``(x)`` of core points: ``pairs (x, box, n, k)`` are opened until the counts, from ``sure`` on, decide."""
        for depth in range(DEEPEST + 1):
            least, greatest = _box_from(F.col("x"), F.col("box"), self.side / PARTS**depth)
            judged = pairs.select("x", "box", "n", "k", least.alias("_least"), greatest.alias("_greatest")).where(
                F.col("_least") <= self.limit * (1 + SLACK)
            )
            judged = cut_lineage(judged)
            inside = F.col("_greatest") <= self.limit * (1 - SLACK)
            measured = ~inside & (F.lit(depth == DEEPEST) | (F.col("k") <= self.few))
            there = positions.select(self.box(F.col("x"), depth).alias("box"), F.col("x").alias("_y"), F.col("n").alias("_n"))
            close = judged.where(measured).select("x", "box").join(there, "box").where(
                squared_distance(F.col("x"), F.col("_y")) <= self.limit
            )
            added = sure.union(judged.where(inside).select("x", "n")).union(close.select("x", "_n"))
            sure = cut_lineage(added.groupBy("x").agg(F.sum("n").alias("n")))
            cut = judged.where(~inside & ~measured).select("x", "box").join(
                sure.where(F.col("n") < self.min_points).select("x"), "x", "left_semi"
            )
            if depth == DEEPEST or cut.isEmpty():
                break
            parts = self._opened(positions, cut, depth)
            pairs = cut.join(parts, "box").select("x", F.col("part").alias("box"), "n", "k")
        return sure.where(F.col("n") >= self.min_points).select("x")

    def _join_task(self, most: int):
        """Cells of a block that belong together, and pairs of cells that only other positions can tell."""
        dims, radius, side, limit = self.dims, self.radius, self.side, self.limit

        def task(table: pa.Table) -> pa.Table:
            cell, x, own = _matrix(table, "cell", dims), _matrix(table, "x", dims), table["own"].to_numpy()
            cells, of = np.unique(cell, axis=0, return_inverse=True)
            of = of.reshape(-1)
            inside, cut = np.zeros(len(cells), bool), np.zeros(len(cells), bool)
            inside[of[own]] = True
            cut[of[table["k"].to_numpy() > most]] = True
            label = np.arange(len(cells))
            # One position of each cell joins most; then only cells that are still apart are compared.
            gaps = x - (cell + 0.5) * side
            order = np.lexsort(((gaps * gaps).sum(1), of))
            one = order[np.unique(of[order], return_index=True)[1]]
            mine = np.flatnonzero(inside)
            for rows, others, close in _close_pairs(x[one[mine]], x[one], radius, limit):
                i, j = np.nonzero(close)
                label = _merged(label, mine[rows][i], others[j])
            points = np.flatnonzero(own)
            points = points[np.lexsort((of[points], label[of[points]]))]
            for rows, others, close in _close_pairs(x[points], x, radius, limit, lambda: (label[of[points]], label[of])):
                i, j = np.nonzero(close)
                label = _merged(label, of[points[rows][i]], of[others[j]])
            joined = np.flatnonzero(label != np.arange(len(cells)))
            first, second = [cells[joined]], [cells[label[joined]]]
            told = [np.ones(len(joined), bool)]
            for a in mine if cut.any() else ():
                apart = np.flatnonzero((label != label[a]) & (cut | cut[a]))
                steps = np.maximum(np.abs(cells[apart] - cells[a]) - 1, 0)
                apart = apart[(steps * steps).sum(1) <= dims]
                first.append(np.repeat(cells[a : a + 1], len(apart), 0))
                second.append(cells[apart])
                told.append(np.zeros(len(apart), bool))
            return pa.table({"cell": _lists(np.concatenate(first)), "near": _lists(np.concatenate(second)), "told": np.concatenate(told)})

        return task

    def _by_opening(self, core: DataFrame, near: DataFrame) -> DataFrame:
        """The same, exactly: boxes of both cells are opened until a pair of points decides."""
        held = core.groupBy("cell").agg(F.count(F.lit(1)).alias("k"))
        pairs = near.join(held.select("cell", F.col("k").alias("ka")), "cell").join(
            held.select(F.col("cell").alias("near"), F.col("k").alias("kb")), "near"
        ).select("cell", "near", F.col("cell").alias("a"), "ka", F.col("near").alias("b"), "kb")
        found = None
        for depth in range(DEEPEST + 1):
            least, greatest = _boxes_apart(F.col("a"), F.col("b"), self.side / PARTS**depth)
            judged = cut_lineage(pairs.select("*", least.alias("_least"), greatest.alias("_greatest")).where(
                F.col("_least") <= self.limit * (1 + SLACK)
            ))
            inside = F.col("_greatest") <= self.limit * (1 - SLACK)
            measured = ~inside & (F.lit(depth == DEEPEST) | (F.col("ka") * F.col("kb") <= self.few * self.few))
            boxed = core.select(self.box(F.col("x"), depth).alias("_box"), "x")
            close = judged.where(measured).select("cell", "near", "a", "b").join(
                boxed.select(F.col("_box").alias("a"), "x"), "a"
            ).join(boxed.select(F.col("_box").alias("b"), F.col("x").alias("_y")), "b").where(
                squared_distance(F.col("x"), F.col("_y")) <= self.limit
            )
            connected = judged.where(inside).select("cell", "near").union(close.select("cell", "near"))
            found = cut_lineage((connected if found is None else found.union(connected)).distinct())
            cut = judged.where(~inside & ~measured).select("cell", "near", "a", "b").join(
                found, ["cell", "near"], "left_anti"
            )
            if depth == DEEPEST or cut.isEmpty():
                return found
            boxes = cut.select(F.col("a").alias("box")).union(cut.select("b"))
            parts = cut_lineage(self._opened(core, boxes, depth))
            pairs = cut.join(parts.select(F.col("box").alias("a"), F.col("part").alias("_a"), F.col("k").alias("ka")), "a").join(
                parts.select(F.col("box").alias("b"), F.col("part").alias("_b"), F.col("k").alias("kb")), "b"
            ).select("cell", "near", F.col("_a").alias("a"), "ka", F.col("_b").alias("b"), "kb")
        return found

    def connected(self, core: DataFrame) -> DataFrame:
        """``(cell, component)`` of the cells of core points."""
        nodes = cut_lineage(core.select(F.col("cell").alias("id")).distinct())
        held = core.groupBy("cell").agg(F.count(F.lit(1)).alias("k"))
        most = 2 * self.min_points
        offered = first_rows(core.select("cell", "x"), "cell", most, F.asc("x")).join(held, "cell")
        dealt = self._dealt(offered, self._blocks(held, most), True).select("block", "own", "cell", "x", "k")
        pairs = cut_lineage(self._grouped(dealt).applyInArrow(
            self._join_task(most), "cell array<bigint>, near array<bigint>, told boolean"
        ))
        first = components(nodes, _both(pairs.where("told").select("cell", "near")))
        named = first.select(F.col("id").alias("cell"), F.col("component").alias("_own"))
        other = first.select(F.col("id").alias("near"), F.col("component").alias("_other"))
        untold = pairs.where(~F.col("told")).select(F.least("cell", "near").alias("cell"), F.greatest("cell", "near").alias("near"))
        open_pairs = cut_lineage(
            untold.distinct().join(named, "cell").join(other, "near").where("_own <> _other").select("cell", "near", "_own", "_other")
        )
        if open_pairs.isEmpty():
            return first.select(F.col("id").alias("cell"), "component")
        more = self._by_opening(core, open_pairs.select("cell", "near"))
        joins = open_pairs.join(more, ["cell", "near"], "left_semi").select(F.col("_own").alias("a"), F.col("_other").alias("b"))
        roots = first.select(F.col("component").alias("id")).distinct()
        merged = components(roots, joins.union(joins.select("b", "a")))
        return first.select(F.col("id").alias("cell"), F.col("component").alias("id")).join(merged, "id").select("cell", "component")

    def topics(self, positions: DataFrame, min_topic_size: int) -> tuple[DataFrame, DataFrame]:
        """``(cell, topic, whole)`` of cells with a topic, and ``(x)``: core positions of the others.

        In a cell that is ``whole`` all points are core points.  Topics are numbered by their
        core points, then by their smallest position.
        """
        core = self.core(positions)
        placed = cut_lineage(self.connected(core))
        held = core.groupBy("cell").agg(
            F.sum("n").alias("n"), F.min("x").alias("_first"), F.bool_and("dense").alias("whole")
        )
        cells = cut_lineage(held.join(placed, "cell"))
        sizes = cells.groupBy("component").agg(F.sum("n").alias("size"), F.min("_first").alias("first"))
        numbered = numbered_rows(sizes.where(F.col("size") >= min_topic_size), "topic", F.desc("size"), F.asc("first"))
        named = cells.join(numbered.select("component", F.col("topic").cast("int").alias("topic")), "component")
        return named.select("cell", "topic", "whole"), core.where(~F.col("dense")).select("x")


def _both(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("cell").alias("a"), F.col("near").alias("b")).union(pairs.select("near", "cell"))


def attach_topics(points: DataFrame, position: str, density: Density, cells: DataFrame, alone: DataFrame) -> DataFrame:
    """Add ``topic`` to points, from the tables that :meth:`Density.topics` gives."""
    placed = density.placed(points, position, "_x").withColumn("_cell", density.box(F.col("_x")))
    by_cell = cells.select(F.col("cell").alias("_cell"), F.col("topic").alias("_topic"), F.col("whole").alias("_whole"))
    by_position = alone.select(F.col("x").alias("_x"), F.lit(True).alias("_core"))
    tagged = placed.join(sized(by_cell), "_cell", "left").join(sized(by_position), "_x", "left")
    member = F.coalesce("_whole", F.lit(False)) | F.coalesce("_core", F.lit(False))
    topic = F.coalesce(F.when(member, F.col("_topic")), F.lit(NOISE))
    return tagged.withColumn("topic", topic).drop("_x", "_cell", "_topic", "_whole", "_core")


def density_topics(
    points: DataFrame, position: str, dims: int, radius: float, min_points: int, min_topic_size: int, few: int = 64
) -> DataFrame:
    """Add ``topic`` by the density around ``position ARRAY<DOUBLE>``; noise is -1.

    Null, incomplete or infinite positions are noise.  Repeated points each count.
    """
    density = Density(dims, radius, min_points, few)
    cells, alone = density.topics(density.positions(points, position), min_topic_size)
    return attach_topics(points, position, density, cut_lineage(cells), cut_lineage(alone))
