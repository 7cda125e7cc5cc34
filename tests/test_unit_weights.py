"""Weights of units where their text is read, against the way by rows."""

import pytest

from papervein.operators import vectors

TEXTS = [("a", "Iron loss iron"), ("b", "loss of steel; Ärger"), ("c", ""), ("d", None), ("e", "iron 12 STEEL 中文"), ("f", "x")]
TWICE = [("b", "iron of wire"), ("b", "loss of steel; Ärger"), (None, "steel"), (None, "steel wire"), (None, None)]


def by_id(weights):
    return sorted(((r["unit_id"] or "", r["index"], r["weight"]) for r in weights.collect()))


@pytest.mark.parametrize("rows", [TEXTS, TEXTS + TWICE[2:3], TEXTS + TWICE, []])
@pytest.mark.parametrize("dims", [1 << 18, 7])
def test_both_ways_give_the_same(spark, monkeypatch, rows, dims):
    units = spark.createDataFrame(rows, "unit_id STRING, text STRING")
    got = by_id(vectors.unit_weights(units, dims))
    monkeypatch.setattr(vectors, "SLICE_WORDS", 2)
    assert by_id(vectors.unit_weights(units, dims)) == got
    monkeypatch.setattr(vectors, "MAX_SENT_DIMS", 1)
    want = by_id(vectors.unit_weights(units, dims))
    assert [r[:2] for r in got] == [r[:2] for r in want] and bool(got) == bool(rows)
    assert [r[2] for r in got] == pytest.approx([r[2] for r in want])


def test_no_weight_is_shuffled(spark):
    """Before, every unit's words were shuffled twice and written once."""
    units = spark.createDataFrame(TEXTS, "unit_id STRING, text STRING")
    plan = vectors.unit_weights(units)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan
