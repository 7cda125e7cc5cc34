"""Repair of a conversation's structure at the least cost.

The roles of a repaired conversation read: perhaps a system turn, then user and assistant in
turn, at least once; or nothing at all.  Edits of a row are Keep (0), Rerole to user or
assistant (1) and Delete (2); Insert (5) adds an empty user or assistant turn anywhere.  A
blank row or one that repeats an earlier row's role and text must go; a truncated row that
stays costs 5 more.  Of equally cheap edits those whose initials are least in ASCII count.

Rows are dealt by conversation and sorted by turn.  One pass carries the four states of the
dynamic programme (nothing yet, after system, after user, after assistant) across Arrow
batches: for each its cost and the rank of its edits among the four, so no path is kept.
What a row adds are back pointers of 20 bits.  A conversation of at most ``bound`` rows is
traced back at its end.  A longer one is spilled: its rows go out with their pointers to a
table in the shared folder, and a second pass reads them from the last to the first with
nothing but one state in hand.  So memory does not grow with a conversation's length.

Defined cases: a null role or text counts as one space; null turns come first; rows of one
turn are ordered by role, then text; rows without a conversation id are one conversation.
Only the initial of a role counts for its place.  An empty text is blank.  Other columns
of the input are not read.  No rows give none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from papervein.llm.shared import Tables

SPACES = " \t\n\x0b\x0c\r"
START, SYSTEM, USER, ASSISTANT = range(4)
# The state after a row that stays with its role, by state and initial; other rows must change.
KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
# The state after a turn that may be chosen, and its role.
NEXT = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
# Edits of one row in the order of their initials.  An insertion before a deletion is never
# written: after it, it costs the same and comes first.
EDITS = ("D", "IK", "IR", "K", "R")
INSERT, TRUNCATED = 5, 5
NEVER = 1 << 60
# Rows of a finished part before it is handed on, and their characters.
OUT_ROWS, OUT_CHARS = 2048, 1 << 22

ROW = "conv string, place long, turn string, role string, text string, fault string"
TRACED = f"{ROW}, edits string, inserted string, new_role string"
SPILLED = f"{TRACED}, pointers int, final int"


def damage(conversations: DataFrame) -> DataFrame:
    """Rows with known faults: by the CRC-32 of ``conv_id:turn``, modulo 20.

    0 drops the row, 1 empties its text, 2 takes out its ``.!?``, 3 repeats it, 4 makes it the
    user's.  Nulls count as one space, in the key, too; the columns ``conv_id`` and ``turn``
    stay null.
    """
    def filled(name: str):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.encode(F.concat(filled("conv_id"), F.lit(":"), filled("turn")), "UTF-8")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(filled("text"), "[.!?]", "")).otherwise(filled("text"))
    rows = conversations.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(filled("role")).alias("role"), text.alias("text"),
        F.when(kind == 3, 2).when(kind == 0, 0).otherwise(1).alias("_times"),
    )
    return rows.select("conv_id", "turn", "role", "text", F.explode(F.array_repeat(F.lit(0), F.col("_times"))).alias("_")).drop("_")


def with_faults(rows: DataFrame) -> DataFrame:
    """``conv, turn, role, text, fault``, dealt by conversation and sorted by turn.

    Repeats are found by sorting within the partitions, not by a set in memory.
    """
    filled = rows.select(
        F.col("conv_id").cast("string").alias("conv"), "turn",
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
    )
    dealt = filled.withColumn("_digest", F.sha2(F.encode("text", "UTF-8"), 256)).repartition("conv")
    same = Window.partitionBy("conv", "role", "_digest").orderBy(F.asc_nulls_first("turn"))
    shown = F.rtrim("text", F.lit(SPACES))
    fault = (
        F.when(shown == "", "blank").when(F.col("_nth") > 1, "duplicate")
        .when(~F.right(shown, F.lit(1)).isin(".", "!", "?"), "truncated")
    )
    marked = dealt.withColumn("_nth", F.row_number().over(same)).select("conv", "turn", "role", "text", fault.alias("fault"), "_nth")
    # Of equal rows the first to count is the first in order, and the others repeat it.
    return marked.sortWithinPartitions("conv", F.asc_nulls_first("turn"), "role", "text", "_nth").drop("_nth")


class Programme:
    """The forward pass over one conversation."""

    def __init__(self):
        self.cost = [0, NEVER, NEVER, NEVER]
        self.rank = [0, 1, 2, 3]

    def read(self, initial: str, fault: str | None) -> int:
        """Take in one row; its back pointers, five bits a state: 5 x state before + edit."""
        best: list[tuple[int, int, int, int] | None] = [None] * 4
        stays = fault not in ("blank", "duplicate")
        extra = TRUNCATED if fault == "truncated" else 0

        def offer(after: int, cost: int, before: int, edit: int) -> None:
            mine = (cost, self.rank[before], edit, before)
            if best[after] is None or mine < best[after]:
                best[after] = mine

        for before in range(4):
            cost = self.cost[before]
            if cost >= NEVER:
                continue
            offer(before, cost + 2, before, 0)
            if not stays:
                continue
            inserted = NEXT[before]
            for state, base, keep in ((before, cost + extra, 3), (inserted, cost + extra + INSERT, 1)):
                kept = KEPT.get((state, initial))
                if kept is not None:
                    offer(kept, base, before, keep)
                offer(NEXT[state], base + 1, before, keep + 1)
        order = sorted((b[1], b[2], state) for state, b in enumerate(best) if b)
        self.rank = [4] * 4
        pointers = 0
        for rank, (_, edit, state) in enumerate(order):
            self.rank[state] = rank
            pointers |= (best[state][3] * 5 + edit) << (5 * state)
        self.cost = [b[0] if b else NEVER for b in best]
        return pointers

    def final(self) -> int:
        """The best last state; after a user's turn an assistant's is still inserted."""
        ends = [(self.cost[s] + (INSERT if s == USER else 0), self.rank[s], s) for s in (START, USER, ASSISTANT)]
        return min(ends)[2]


def before(pointers: int, after: int) -> tuple[str, int]:
    """The row's edits on the best way to a state, and the state before the row."""
    state, edit = divmod(pointers >> (5 * after) & 31, 5)
    return EDITS[edit], state


def traced(role: str, edits: str, state: int, after: int) -> tuple[str, str | None, str | None]:
    """Edits, the role of the turn inserted before the row, and the row's role, if it stays."""
    inserted = ROLE[NEXT[state]] if "I" in edits else None
    new_role = None if edits == "D" else ROLE[after] if "R" in edits else role
    return edits, inserted, new_role


class _Out:
    """Rows collected for the next data frame."""

    def __init__(self, schema: str):
        self.names = [column.split()[0] for column in schema.split(", ")]
        self.rows: list[tuple] = []
        self.chars = 0

    def add(self, row: tuple, chars: int) -> None:
        self.rows.append(row)
        self.chars += chars

    def full(self) -> bool:
        return len(self.rows) >= OUT_ROWS or self.chars >= OUT_CHARS

    def frame(self) -> pd.DataFrame:
        frame = pd.DataFrame(self.rows, columns=self.names)
        self.rows, self.chars = [], 0
        return frame


def _end(conv: str | None, place: int, state: int) -> list[tuple]:
    """The row that stands for a turn inserted at the end."""
    return [(conv, place, None, None, None, None, "I", ROLE[ASSISTANT], None)] if state == USER else []


def _forward(bound: int, bound_chars: int):
    def forward(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = _Out(SPILLED)
        conv, begun, spilled, place = None, False, False, 0
        programme, held, chars = Programme(), [], 0

        def spill(last: bool) -> None:
            """Rows with pointers; the last of a conversation waits, since it names the final state."""
            keep = [] if last else held[-1:]
            rows = held if last else held[:-1]
            for k, (at, row, pointers) in enumerate(rows):
                final = programme.final() if last and k == len(rows) - 1 else -1
                out.add((conv, at, *row, None, None, None, pointers, final), len(row[2]))
            held[:] = keep

        def finish() -> None:
            if spilled:
                spill(True)
                return
            after = state = programme.final()
            back = []
            for at, row, pointers in reversed(held):
                edits, earlier = before(pointers, after)
                back.append((conv, at, *row, *traced(row[1], edits, earlier, after), 0, -1))
                after = earlier
            for row in reversed(back):
                out.add(row, len(row[4]))
            for row in _end(conv, place, state):
                out.add((*row, 0, -1), 0)
            held.clear()

        for frame in frames:
            for own, turn, role, text, fault in frame.itertuples(index=False, name=None):
                if not begun or own != conv:
                    if begun:
                        finish()
                    conv, begun, spilled, place = own, True, False, 0
                    programme, chars = Programme(), 0
                held.append((place, (turn, role, text, fault), programme.read(role[:1], fault)))
                place += 1
                chars += len(text)
                if spilled or place > bound or chars > bound_chars:
                    spilled = True
                    spill(False)
                if out.full():
                    yield out.frame()
        if begun:
            finish()
        yield out.frame()

    return forward


def _backward(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    out, after = _Out(TRACED), START
    for frame in frames:
        for conv, place, turn, role, text, fault, pointers, final in frame.itertuples(index=False, name=None):
            if final >= 0:
                after = final
                for row in _end(conv, place + 1, final):
                    out.add(row, 0)
            edits, earlier = before(pointers, after)
            out.add((conv, place, turn, role, text, fault, *traced(role, edits, earlier, after)), len(text))
            after = earlier
            if out.full():
                yield out.frame()
    yield out.frame()


def repair(rows: DataFrame, bound: int = 4096, bound_chars: int = 1 << 24) -> DataFrame:
    """One row for each row of the input, and one for a turn inserted at an end.

    ``conv`` is the conversation's id as a string, ``place`` the row's place in it; ``edits``
    are initials, ``inserted`` is the role of the empty turn before the row, ``new_role`` the
    row's role if it stays.
    """
    tables = Tables(rows.sparkSession, "conversation-repair")
    sorted_rows = with_faults(rows).select("conv", F.col("turn").cast("string").alias("turn"), "role", "text", "fault")
    passed = tables.write(sorted_rows.mapInPandas(_forward(bound, bound_chars), SPILLED), "forward")
    names = [column.split()[0] for column in TRACED.split(", ")]
    spilled = passed.where("edits IS NULL").select(
        "conv", "place", "turn", "role", "text", "fault", "pointers", "final"
    ).repartition("conv").sortWithinPartitions("conv", F.desc("place"))
    return passed.where("edits IS NOT NULL").select(*names).union(spilled.mapInPandas(_backward, TRACED))


def turns(repaired: DataFrame) -> DataFrame:
    """``(conv, place, part, role, text)``: the turns of the repaired conversations."""
    both = F.array_compact(F.array(
        F.when(F.col("inserted").isNotNull(), F.struct(F.lit(0).alias("part"), F.col("inserted").alias("role"), F.lit("").alias("text"))),
        F.when(F.col("new_role").isNotNull(), F.struct(F.lit(1).alias("part"), F.col("new_role").alias("role"), F.col("text").alias("text"))),
    ))
    return repaired.select("conv", "place", F.inline(both))


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
DIGEST = "conv string, " + ", ".join(f"{c} long" for c in COUNTS) + ", audit string, repaired_sha256 string"
_COSTS = {"K": 0, "R": 1, "D": 2, "I": INSERT}
_LEGAL = {"su", "ua", "au"}


class _Sums:
    """Counts and running digest of one conversation."""

    def __init__(self):
        self.faults = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        self.first = self.last = self.turn = None
        self.distinct = self.illegal = self.cost = 0
        self.initial: str | None = None
        self.audit: list[str] = []
        self.hash, self.begun = hashlib.sha256(), False

    def write(self, role: str, text: str) -> None:
        self.hash.update((("\n" if self.begun else "") + f"{role}:{text}").encode())
        self.begun = True

    def read(self, turn, role, text, fault, edits, inserted, new_role) -> None:
        self.audit.append(edits)
        self.cost += sum(_COSTS[e] for e in edits)
        if inserted is not None:
            self.write(inserted, "")
        if role is None:
            return
        if fault is not None:
            self.faults[fault] += 1
            self.cost += TRUNCATED if fault == "truncated" and edits != "D" else 0
        if new_role is not None:
            self.write(new_role, text)
        if self.initial is not None and self.initial + role[:1] not in _LEGAL:
            self.illegal += 1
        self.initial = role[:1]
        if turn is not None and turn != self.turn:
            self.turn, self.last, self.distinct = turn, int(turn), self.distinct + 1
            self.first = self.last if self.first is None else self.first

    def row(self, conv: str | None) -> tuple:
        gaps = self.last - self.first + 1 - self.distinct if self.distinct else 0
        return (conv, gaps, *self.faults.values(), self.illegal, self.cost, "".join(self.audit), self.hash.hexdigest())


def _digest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    out = _Out(DIGEST)
    conv, sums = None, None
    for frame in frames:
        for own, *row in frame.itertuples(index=False, name=None):
            if sums is None or own != conv:
                if sums is not None:
                    done = sums.row(conv)
                    out.add(done, len(done[-2]))
                conv, sums = own, _Sums()
            sums.read(*row)
            if out.full():
                yield out.frame()
    if sums is not None:
        out.add(sums.row(conv), 0)
    yield out.frame()


def digest(conversations: DataFrame, repaired: DataFrame) -> DataFrame:
    """One row for each conversation of the input, also for those of which no row was left.

    Faults and costs are counted and the turns hashed in one pass in their order.
    """
    ordered = repaired.repartition("conv").sortWithinPartitions("conv", "place").drop("place")
    sums = ordered.mapInPandas(_digest, DIGEST)
    ids = conversations.select("conv_id").distinct()
    joined = ids.join(sums, F.col("conv_id").cast("string").eqNullSafe(F.col("conv")), "left")
    return joined.select(
        "conv_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in COUNTS],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(b""), 256)).alias("repaired_sha256"),
    )
