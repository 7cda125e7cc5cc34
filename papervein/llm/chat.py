"""Chat formatting: a hidden Markov model recovers who speaks, then turns are rendered alike.

The lines of a conversation, in the order of its rows, are the observations, the roles the
hidden states.  A line shows its row's role, if that is known, a name at its start or none
(``Human:``, ``**Assistant**:``, ``<|user|>``), whether it asks, how long it is, and whether it
is an item or code.  Turns begin at rows; speakers change there with high probability and
hardly elsewhere.  Emissions of the line features are counted over all lines whose row names a
known role; a role is believed in most cases, so a missing or unknown one is filled in from
its neighbours and its lines.

A name may mark a turn or belong to the text (``A: Paris`` in a list); texts hold words such
as ``Answer:`` often, speakers' names seldom and tokens in brackets hardly ever.  Whether a
turn begins there is part of the path: likely in a row of unknown role, unlikely in one whose
role is known, until a first turn has begun within it.  From there on the row's role says no
more and its names alone tell who speaks, so each role has a second state for such lines.  A
name is cut off only where the path begins a turn of the role it names; others stay.

Conversations are decoded along a range partitioning by conversation and turn.  One that
crosses partitions, however long, is joined by the scores of the best paths through each
partition (a matrix of a few numbers), so no task needs more than its partition.

A null role or text is an unknown marker or an empty line.  Rows of one turn number follow
each other by role and text; repeated rows are turns of their own.  Rows without a
conversation id form one conversation.  Lines end at ``\\n``.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from papervein.llm.shared import Tables

ROLES = ("system", "user", "assistant")
NAMES = {
    "system": "system", "instruction": "system", "instructions": "system",
    "user": "user", "human": "user", "prompter": "user", "customer": "user", "question": "user", "q": "user",
    "assistant": "assistant", "ai": "assistant", "bot": "assistant", "gpt": "assistant", "model": "assistant",
    "chatgpt": "assistant", "answer": "assistant", "a": "assistant",
}
_NAME = "(" + "|".join(sorted(NAMES, key=len, reverse=True)) + ")"
# A name with a colon, perhaps emphasised, or in brackets of its own.
_MARKER = re.compile(rf"\s*(?:(?:\*\*|#+\s*)?{_NAME}(?:\*\*)?\s*:(?:\*\*)?|<\|{_NAME}\|>:?|\[{_NAME}\]:?)\s?", re.IGNORECASE)
_ITEM = re.compile(r"\s*(?:[-*•]\s|\d+[.)]\s|```|    \S)")
_LENGTHS = np.array([1, 21, 81, 201])
_BUCKETS = (2, 5, 2)  # asks, length, item

# Chances that do not depend on the data: who begins, who follows whom where a turn begins,
# and how often a marker is right.
_START = np.append(np.log([0.3, 0.6, 0.1]), np.full(3, -np.inf))  # second states: no row begins there
_NEXT = np.log([[0.05, 0.85, 0.10], [0.02, 0.08, 0.90], [0.02, 0.88, 0.10]])
_WITHIN = np.log(np.full((3, 3), 0.005) + np.eye(3) * 0.985)
_RIGHT, _WRONG = np.log(0.97), np.log(0.015)
# Words that texts begin lines with, too, and how often a name of each kind is one of the
# text: such words, other names, tokens in brackets.
_WORDS = {"instruction", "instructions", "customer", "question", "q", "model", "answer", "a"}
_AS_TEXT = (0.8, 0.05, 0.001)
# How often a name marks a turn: within and at the start of a row of known role, elsewhere.
_INNER, _FIRST, _FREE = 0.02, 0.5, 0.9


@dataclass(frozen=True)
class Model:
    features: tuple[np.ndarray, ...]  # log chances by role and bucket


@dataclass(frozen=True)
class Line:
    text: str  # without the name
    begins: bool  # a row
    marker: int  # index of the role that the name stands for, or -1
    buckets: tuple[int, int, int]
    tie: int = 0
    name: str = ""  # as written
    kind: int = 1  # of the name: index into _AS_TEXT
    given: int = -1  # index of the row's role, or -1


def name_of(role: str | None) -> int:
    """The index of the role that a name stands for, or -1."""
    found = NAMES.get((role or "").strip().lower())
    return ROLES.index(found) if found else -1


def lines_of(role: str | None, text: str | None, turn: object = None) -> list[Line]:
    """The lines of a row; a name at a line's start is kept beside the rest."""
    out = []
    given = name_of(role)
    for k, line in enumerate((text or "").split("\n")):
        marker, kind, name = -1, 1, ""
        named = _MARKER.match(line)
        if named:
            word = named[named.lastindex].lower()
            marker, kind = ROLES.index(NAMES[word]), 2 if named.lastindex > 1 else int(word not in _WORDS)
            name, line = named[0], line[named.end() :]
        length = int(np.searchsorted(_LENGTHS, len(line), side="right"))
        buckets = (int(line.rstrip().endswith("?")), length, int(bool(_ITEM.match(line))))
        out.append(Line(line, k == 0, marker, buckets, zlib.crc32(f"{turn} {k}".encode()), name, kind, given))
    return out


def fit(rows: DataFrame) -> Model:
    """Count the line features of each role over all rows with a known role."""
    sizes = [len(ROLES) * b for b in _BUCKETS]

    def counted(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros(s, np.int64) for s in sizes]
        for batch in parts:
            for role, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                state = name_of(role)
                for line in lines_of(None, text) if state >= 0 else ():
                    for f, bucket in enumerate(line.buckets):
                        counts[f][state * _BUCKETS[f] + bucket] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(range(3), sizes)), pa.array(np.concatenate([np.arange(s) for s in sizes])),
             pa.array(np.concatenate(counts))], names=["feature", "cell", "n"],
        )

    found = rows.select("role", "text").mapInArrow(counted, "feature long, cell long, n long")
    counts = [np.ones(s) for s in sizes]
    for feature, cell, n in found.groupBy("feature", "cell").agg(F.sum("n")).collect():  # 27 rows
        counts[feature][cell] += n
    tables = [c.reshape(len(ROLES), -1) for c in counts]
    return Model(tuple(np.log(t / t.sum(1, keepdims=True)) for t in tables))


_ROLE = np.arange(len(ROLES))
_TIES = np.arange(3, 3 + len(_START))


@lru_cache(None)
def _first(marker: int, kind: int, known: bool) -> np.ndarray:
    """Log chance of a name at a row's start, as marker or text, by role."""
    marks = _FIRST if known else _FREE
    return np.maximum(np.log(marks) + np.where(_ROLE == marker, _RIGHT, _WRONG), np.log((1 - marks) * _AS_TEXT[kind]))


def _emission(model: Model, line: Line) -> np.ndarray:
    role = sum(table[:, bucket] for table, bucket in zip(model.features, line.buckets))
    later = role
    if line.given >= 0:
        # After a turn begun within the row, names alone tell who speaks.
        later = np.full(len(ROLES), role[line.given])
        role = role + np.where(_ROLE == line.given, 0, _WRONG - _RIGHT)
    if line.begins and line.marker >= 0:
        role = role + _first(line.marker, line.kind, line.given >= 0)
    # A trace of the turn's number settles ties between paths alike, wherever partitions begin.
    return np.concatenate([role, later]) + line.tie * _TIES % 1009 * 1e-9


@lru_cache(None)
def _options(begins: bool, marker: int, kind: int, known: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log chances from each state to each where the turn goes on, where one begins, and the larger."""
    on, new = np.full((2, 2, len(ROLES), 2, len(ROLES)), -np.inf)
    if begins:
        new[:, :, 0] = _NEXT
    else:
        on[0, :, 0] = on[1, :, 1] = _WITHIN
        if marker >= 0:
            named = _NEXT + np.where(_ROLE == marker, _RIGHT, _WRONG)
            for later, marks in enumerate((_INNER if known else _FREE, _FREE)):
                on[later, :, later] += np.log((1 - marks) * _AS_TEXT[kind])
                new[later, :, int(known or later)] = np.log(marks) + named
    on, new = on.reshape(len(_START), -1), new.reshape(len(_START), -1)
    return on, new, np.maximum(on, new)


def _step(line: Line) -> np.ndarray:
    return _options(line.begins, line.marker, line.kind, line.given >= 0)[2]


def starts(line: Line, before: int, state: int) -> bool:
    """Whether the best way from one state to the other begins a turn at the line."""
    on, new, _ = _options(line.begins, line.marker, line.kind, line.given >= 0)
    return bool(new[before, state] > on[before, state])


def pieces(row: list[Line], states: list[int]) -> list[tuple[int, str]]:
    """The turns of a row: role and text, without the names that mark a turn's beginning."""
    out: list[tuple[int, list[str]]] = []
    for k, (line, state) in enumerate(zip(row, states)):
        role = state % len(ROLES)
        new = k == 0 or starts(line, states[k - 1], state)
        if new or out[-1][0] != role:
            out.append((role, []))
        out[-1][1].append(line.text if new and role == line.marker else line.name + line.text)
    return [(role, "\n".join(lines)) for role, lines in out]


def through(model: Model, lines: list[Line]) -> np.ndarray:
    """Best score through the lines from each state before them to each state at their end."""
    best = np.where(np.eye(len(_START)) > 0, 0.0, -np.inf)
    for line in lines:
        best = (best[:, :, None] + _step(line)).max(1) + _emission(model, line)
    return best


def decode(model: Model, lines: list[Line], before: int | None = None, end: int | None = None) -> list[int]:
    """The best states of the lines, between given states before and at their end."""
    back = []
    score = None
    for line in lines:
        if score is None:
            score = (_START if before is None else _step(line)[before]) + _emission(model, line)
            continue
        options = score[:, None] + _step(line)
        back.append(options.argmax(0))
        score = options.max(0) + _emission(model, line)
    state = int(score.argmax()) if end is None else end
    states = [state]
    for choice in reversed(back):
        state = int(choice[state])
        states.append(state)
    return states[::-1]


def _conversations(rows: pd.DataFrame) -> Iterator[tuple[pd.DataFrame, list[list[Line]]]]:
    """The stretches of one conversation in a partition, in order, with the lines of each row."""
    rows = rows.sort_values("position")
    ids = rows["conv_id"].tolist()
    same = [a == b for a, b in zip(ids[1:], ids[:-1])]
    starts = [0, *(k + 1 for k, s in enumerate(same) if not s), len(ids)]
    for low, high in zip(starts, starts[1:]):
        part = rows.iloc[low:high]
        yield part, [
            lines_of(r, t, n) for r, t, n in zip(part["role"], part["text"], part["turn"])
        ]


def _ordered(rows: DataFrame, tables: Tables) -> DataFrame:
    """The rows in order of conversation and turn, with their partition and position there.

    The two numbers are written as strings, which pandas keeps exact beside nulls.
    """

    def numbered(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = 0
        for batch in parts:
            place = np.arange(at, at + len(batch))
            at += len(batch)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(batch), TaskContext.get().partitionId())), pa.array(place),
                 batch.column(0).cast(pa.string()), batch.column(1).cast(pa.string()), *batch.columns[2:4]],
                names=["part", "position", "conv_id", "turn", "role", "text"],
            )

    # The last key shares rows that are equal in all others among partitions.
    keys = ["conv_id", "turn", "role", "text", "tie"]
    own = rows.select("conv_id", "turn", "role", "text").withColumn("tie", F.monotonically_increasing_id())
    ranged = own.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("tie")
    return tables.write(
        ranged.mapInArrow(numbered, "part long, position long, conv_id string, turn string, role string, text string"), "ordered"
    )


_SUMMARY = "part long, first_id string, last_id string, alone boolean, head array<double>, tail array<double>"


def from_start(model: Model, lines: list[Line]) -> np.ndarray:
    """Best score from a conversation's beginning to each state at the lines' end."""
    score = _START + _emission(model, lines[0])
    for line in lines[1:]:
        score = (score[:, None] + _step(line)).max(0) + _emission(model, line)
    return score


def _summaries(ordered: DataFrame, model: Model) -> list:
    """Per partition the best scores through its first conversation and to the end of its last.

    One row for each partition of the range partitioning reaches the driver.
    """

    def summary(rows: pd.DataFrame) -> pd.DataFrame:
        stretches = [(part["conv_id"].iloc[0], [x for own in lines for x in own]) for part, lines in _conversations(rows)]
        head, tail = through(model, stretches[0][1]).ravel().tolist(), from_start(model, stretches[-1][1]).tolist()
        return pd.DataFrame({
            "part": [rows["part"].iloc[0]], "first_id": [stretches[0][0]], "last_id": [stretches[-1][0]], "alone": [len(stretches) == 1], "head": [head], "tail": [tail],
        })

    return sorted(ordered.groupBy("part").applyInPandas(summary, _SUMMARY).collect(), key=lambda r: r.part)


def _joints(summaries: list) -> dict[int, tuple[int | None, int | None]]:
    """For each partition the state before its first line and that at its last, where fixed.

    Runs along conversations that cross partitions: the best state at each border.
    """
    out: dict[int, list[int | None]] = {s.part: [None, None] for s in summaries}
    k = 0
    while k < len(summaries):
        chain = [summaries[k]]
        while k + 1 < len(summaries) and summaries[k + 1].first_id == chain[-1].last_id:
            k += 1
            chain.append(summaries[k])
            if not summaries[k].alone:
                break
        score, back = np.array(chain[0].tail), []
        for link in chain[1:]:
            options = score[:, None] + np.array(link.head).reshape(len(_START), -1)
            back.append(options.argmax(0))
            score = options.max(0)
        state = int(score.argmax())
        for at in range(len(chain) - 1, 0, -1):
            state = int(back[at - 1][state])  # at the border between this link and the one before
            out[chain[at].part][0] = state
            out[chain[at - 1].part][1] = state
        if len(chain) == 1 or chain[-1].alone:
            k += 1
    return {p: (a, b) for p, (a, b) in out.items()}


def _number(text: str | None) -> int | None:
    return None if text is None else int(text)


TURNS = "conv_id long, turn long, piece int, given_role string, role string, content string"


def parse(rows: DataFrame) -> DataFrame:
    """The turns of every conversation with their recovered roles; ``rows``: conversations."""
    tables = Tables(rows.sparkSession, "chat")
    model = fit(rows)
    ordered = _ordered(rows, tables)
    joints = _joints(_summaries(ordered, model))

    def turns(part: pd.DataFrame) -> pd.DataFrame:
        stretches = list(_conversations(part))
        before, end = joints[int(part["part"].iloc[0])]
        out = []
        for k, (own, lines) in enumerate(stretches):
            flat = [x for row in lines for x in row]
            states = iter(decode(
                model, flat, before if k == 0 else None, end if k == len(stretches) - 1 else None
            ))
            for conv, turn, given, row in zip(own["conv_id"], own["turn"], own["role"], lines):
                own_states = [next(states) for _ in row]
                out += [(_number(conv), _number(turn), n, given, ROLES[s], x) for n, (s, x) in enumerate(pieces(row, own_states))]
        columns = dict(zip(("conv_id", "turn", "piece", "given_role", "role", "content"), zip(*out)))
        return pd.DataFrame(columns | {n: pd.array(columns[n], "Int64") for n in ("conv_id", "turn")})

    return ordered.groupBy("part").applyInPandas(turns, TURNS)


def escaped(content: Column) -> Column:
    """Text in which a turn mark gets a backslash, so that no reader takes it for one.

    ``<|im_end|>`` becomes ``<\\|im_end|>``; a mark that has backslashes already gets one more,
    so taking one away from each gives the text again.
    """
    return F.regexp_replace(content, r"<(\\*)\|im_(start|end)\|>", r"<$1\\|im_$2|>")


def render(turns: DataFrame) -> DataFrame:
    """Each turn in one canonical form; turn marks inside its text are escaped."""
    chat = F.concat(F.lit("<|im_start|>"), "role", F.lit("\n"), F.trim(escaped(F.col("content"))), F.lit("<|im_end|>\n"))
    return turns.withColumn("chat", chat)
