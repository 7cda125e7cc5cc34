"""Normal forms, thickness and prices against known values."""

import pytest
from pyspark.sql import functions as F

from papervein.config import Config
from papervein.functions import periods, prices, values
from papervein.operators import normalise, pricing

CFG = Config()
# Parsed grades with thickness, price and a reader's mark.
PARSED = (
    ("15HTH1000", 0.15, 2.333, "Y"), ("15HST780Y", 0.15, 2.333, "Y"), ("17A319", 0.17, 2.059, "Y"),
    ("17A338", 0.17, 2.059, "Y"), ("20HTH1500", 0.2, 1.75, "Y"), ("20HTH1800", 0.2, 1.75, "Y"),
    ("20HTH1200", 0.2, 1.75, "Y"), ("NO20", 0.2, 1.75, "N"), ("20HST570Y", 0.2, 1.75, "Y"),
    ("20HST780Y", 0.2, 1.75, "Y"), ("35A210", 0.35, 1.0, "Y"), ("M270-35A", 0.35, 1.0, "Y"),
    ("35H series", 0.35, 1.0, "N\\A"), ("35H250", 0.35, 1.0, "Y"), ("35A300", 0.35, 1.0, "Y"),
    ("35HXT680", 0.35, 1.0, "Y"), ("M300-35A", 0.35, 1.0, "Y"), ("M235-35A", 0.35, 1.0, "Y"),
    ("50H600", 0.5, 0.7, "Y"), ("50A470", 0.5, 0.7, "Y"), ("50H270", 0.5, 0.7, "Y"),
    ("50H310", 0.5, 0.7, "Y"), ("50A1300", 0.5, 0.7, "Y"), ("M270-50A", 0.5, 0.7, "Y"),
    ("50A1000", 0.5, 0.7, "Y"), ("50A700", 0.5, 0.7, "Y"), ("50JNE300", 0.5, 0.7, "Y"),
)
UNPARSED = ("DINAMO", "ELMAG", "PERMAG FP", "PERMAG SP", "NKB-CORE", "JNE-Core")
# Price, +10 % and -10 % thickness, for four thicknesses.
SENSITIVITY = {
    0.35: (1.0, 0.385, 0.9090909090909091, -9.090909090909093, 0.315, 1.111111111111111, 11.111111111111093),
    0.5: (0.7, 0.55, 0.6363636363636362, -9.090909090909104, 0.45, 0.7777777777777777, 11.111111111111093),
    0.17: (2.0588235294117645, 0.18700000000000003, 1.871657754010695, -9.090909090909093,
           0.15300000000000002, 2.2875816993464047, 11.111111111111093),
    0.2: (1.7499999999999998, 0.22000000000000003, 1.5909090909090906, -9.090909090909093,
          0.18000000000000002, 1.9444444444444442, 11.111111111111116),
}


def bridge(spark):
    rows = [(i, "GRADE", g, i * 10) for i, (g, *_) in enumerate(PARSED)]
    rows += [(100 + i, "GRADE_BRAND", g, i) for i, g in enumerate(UNPARSED)]
    rows += [(200, "STANDARD", "EN 10106", 0), (201, "CORE_LOSS", "2 W/kg", 0)]
    mentions = spark.createDataFrame(rows, "doc_id LONG, label STRING, entity_text STRING, start_char INT")
    return pricing.cost_bridge(mentions, pricing.default_roles(spark), CFG, keep=("start_char",))


def test_thickness_and_price(spark):
    rows = {r["entity_text"]: r for r in pricing.grade_prices(bridge(spark)).collect()}
    assert {g: (r["thickness_mm"], r["relative_price_eur_kg"]) for g, r in rows.items()} == {
        g: (t, p) for g, t, p, _ in PARSED
    }
    unparsed = [r[0] for r in pricing.unparsed_grades(bridge(spark), CFG).collect()]
    assert sorted(unparsed) == sorted(UNPARSED)


def test_sensitivity(spark):
    rows = pricing.price_sensitivity(bridge(spark), CFG).collect()
    assert len(rows) == len(PARSED)
    for r in rows:
        if r["thickness_mm"] in SENSITIVITY:
            assert tuple(r)[2:] == SENSITIVITY[r["thickness_mm"]]


def test_bridge_reports(spark):
    table = bridge(spark)
    assert {r[0]: r[1] for r in pricing.role_counts(table).collect()} == {
        "material_cost_input": 33, "loss_cost_input": 1,
    }
    recall = pricing.thickness_recall(table, CFG).first()
    assert (recall["parsed"], recall["total"]) == (27, 33)
    stats = pricing.price_stats(table).first()
    series = sorted(p for _, _, p, _ in PARSED)
    mean = sum(series) / 27
    assert stats["n"] == 27 and stats["n_thickness"] == 5
    assert (stats["min_price"], stats["max_price"], stats["median_price"]) == (0.7, 2.333, 1.0)
    assert stats["mean_price"] == round(mean, 6)
    assert stats["std_price"] == round((sum((p - mean) ** 2 for p in series) / 26) ** 0.5, 6)
    groups = {r["thickness_mm"]: (r["n_grades"], r["example"]) for r in pricing.thickness_groups(table).collect()}
    assert groups[0.17] == (2, "17A319") and groups[0.5] == (9, "50H600")
    assert [r[0] for r in pricing.thickness_histogram(table).collect()] == sorted(groups)
    curve = pricing.price_curve(table, CFG).orderBy("point").collect()
    assert len(curve) == 200
    assert curve[0]["thickness_mm"] == pytest.approx(0.135)
    assert curve[-1]["thickness_mm"] == pytest.approx(0.55)


def test_no_parsed_grade(spark):
    empty = bridge(spark).where("label = 'STANDARD'")
    assert pricing.price_stats(empty).first()["n"] is None
    assert pricing.price_curve(empty, CFG).count() == 0
    assert pricing.thickness_recall(empty, CFG).first()["recall"] is None


@pytest.mark.parametrize(
    ("text", "label", "value", "unit", "form"),
    [
        ("2.3 W/kg", "CORE_LOSS", 2.3, "W/kg", "2.3 W/kg"),
        ("W15/50", "CORE_LOSS", None, "notation", "W15/50"),
        ("B50", "FLUX_DENSITY", None, "notation", "B50"),
        ("690 MPa", "MPA_VALUE", 690.0, "MPa", "690.0 MPa"),
        ("12345678 MPa", "MPA_VALUE", 12345678.0, "MPa", "12345678.0 MPa"),
        ("0.0005 MPa", "MPA_VALUE", 0.0005, "MPa", "0.0005 MPa"),
        ("3.% Si", "SI_CONTENT", 3.0, "%", "3.0 %"),
        ("1.2.3 T", "FLUX_DENSITY", None, None, "1.2.3 T"),
        ("35A300", "GRADE", None, None, "35A300"),
    ],
)
def test_values(spark, text, label, value, unit, form):
    row = spark.createDataFrame([(text, label)], "entity_text STRING, label STRING")
    got = normalise.with_values(row, CFG).first()
    assert (got["value_numeric"], got["unit"], got["canonical_form"]) == (value, unit, form)


def test_property_ladder_and_bounds(spark):
    cases = [
        ("The YIELD point at 120 MPa", 120.0, "yield_strength", "out_of_range"),
        ("yield of 180 MPa", 180.0, "yield_strength", None),
        ("tensile strength of 960 MPa", 960.0, "tensile_strength", "out_of_range"),
        ("a tensile stress of 60 MPa", 60.0, "applied_stress", None),
        ("residual stress of 401 MPa", 401.0, "applied_stress", "out_of_range"),
        ("in compression at 5 MPa", 5.0, "applied_stress", None),
        ("strength 9999 MPa", 9999.0, "unspecified", None),
        ("9999 MPa", 9999.0, "unspecified", None),
        (None, 1.0, "unspecified", None),
    ]
    rows = [(i, c, "MPA_VALUE", v) for i, (c, v, _, _) in enumerate(cases)] + [(99, "yield", "GRADE", 1.0)]
    table = spark.createDataFrame(rows, "i INT, context STRING, label STRING, value_numeric DOUBLE")
    done = normalise.with_review_flag(normalise.with_property(table), normalise.default_bounds(spark))
    got = {r["i"]: (r["resolved_property"], r["review_flag"]) for r in done.collect()}
    assert got == {**{i: c[2:] for i, c in enumerate(cases)}, 99: (None, None)}


def test_names_and_subtypes(spark):
    cases = [
        ("COMPETING_MATERIAL", "Amorphous Metal ", "amorphous", None),
        ("COMPETING_MATERIAL", "cobalt-iron", "cobalt-iron", None),
        ("APPLICATION", "IPM", "rotor", "component"),
        ("APPLICATION", "HEV", "hybrid electric vehicle", "application"),
        ("APPLICATION", "Rotor", "Rotor", "component"),
        ("PRODUCER", "EV", "EV", None),
    ]
    rows = spark.createDataFrame([c[:2] for c in cases], "label STRING, entity_text STRING")
    named = normalise.with_canonical_entity(rows, normalise.default_aliases(spark))
    got = {(r["label"], r["entity_text"]): (r["canonical_entity"], r["subtype"])
           for r in normalise.with_subtype(named, CFG).collect()}
    assert got == {c[:2]: c[2:] for c in cases}


def test_periods(spark):
    years = spark.createDataFrame([(y,) for y in (1987, 1990, 1994, 1995, 2024, 2025)], "year INT")
    start = periods.period_start(F.col("year"), CFG)
    rows = years.select(start, periods.period_label(start, CFG), periods.is_partial(start, CFG)).collect()
    assert [tuple(r) for r in rows] == [
        (1985, "1985-1989", False), (1990, "1990-1994", False), (1990, "1990-1994", False),
        (1995, "1995-1999", False), (2020, "2020-2024", False), (2025, "2025-2029", True),
    ]
    assert CFG.period_labels[0] == "1990-1994" and CFG.period_labels[-1] == "2025-2029"
    assert len(CFG.period_labels) == 8


def test_number_formats(spark):
    numbers = [0.0, 1e-4, 123456789.25, 1e15, 0.00123]
    rows = spark.createDataFrame([(x,) for x in numbers], "x DOUBLE")
    assert [r[0] for r in rows.select(values.plain_number(F.col("x"))).collect()] == [repr(x) for x in numbers]


def test_price_needs_a_thickness(spark):
    rows = spark.createDataFrame([("NO00",), ("XX",), (None,)], "g STRING")
    thick = prices.thickness_mm(F.col("g"))
    got = rows.select(thick, prices.relative_price(thick, 0.35)).collect()
    assert [tuple(r) for r in got] == [(0.0, None), (None, None), (None, None)]
