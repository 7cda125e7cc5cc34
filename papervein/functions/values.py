"""Column expressions that normalise one mention."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def label_lookup(label: Column, table: dict[str, str]) -> Column:
    """Value for a label from a small fixed table; NULL when it has none."""
    found = F.lit(None).cast("string")
    for key, value in table.items():
        found = F.when(label == key, F.lit(value)).otherwise(found)
    return found


def is_notation(text: Column) -> Column:
    """W15/50 or B50: the name of a test condition, not a number with a unit."""
    return text.rlike(r"^[WB]\d")


def numeric_value(text: Column, label: Column, units: dict[str, str]) -> Column:
    """Leading number of a measured value; NULL if there is none or it is malformed."""
    number = F.regexp_extract(text, r"^([\d.]+)", 1).try_cast("double")
    return F.when(label.isin(*units) & ~is_notation(text), number)


def unit(text: Column, label: Column, value: Column, units: dict[str, str]) -> Column:
    return F.when(
        label.isin(*units),
        F.when(is_notation(text), F.lit("notation")).when(
            value.isNotNull(), label_lookup(label, units)
        ),
    )


def plain_number(value: Column) -> Column:
    """A double as digits, without an exponent from 0.0001 up to 10^16."""
    text = value.cast("string")
    digits = F.regexp_replace(text.try_cast("decimal(38,18)").cast("string"), r"0+$", "")
    whole = F.when(digits.endswith("."), F.concat(digits, F.lit("0"))).otherwise(digits)
    needs_digits = text.contains("E") & (F.abs(value) >= 1e-4) & (F.abs(value) < 1e16)
    return F.when(needs_digits, whole).otherwise(text)


def canonical_form(text: Column, value: Column, unit_name: Column) -> Column:
    has_value = value.isNotNull() & unit_name.isNotNull() & (unit_name != "notation")
    return F.when(has_value, F.concat_ws(" ", plain_number(value), unit_name)).otherwise(text)


def resolved_property(context: Column, label: Column, property_label: str = "MPA_VALUE") -> Column:
    """Which strength or stress a pressure value states, judged by its sentence."""
    sentence = F.lower(context)

    def says(*words: str) -> Column:
        found = F.lit(False)
        for word in words:
            found = found | sentence.contains(word)
        return found

    ladder = (
        F.when(context.isNull(), F.lit("unspecified"))
        .when(says("yield"), F.lit("yield_strength"))
        .when(says("tensile") & says("strength"), F.lit("tensile_strength"))
        .when(
            says("applied", "residual", "compressive", "tensile") & says("stress"),
            F.lit("applied_stress"),
        )
        .when(says("tension", "compression", "compressive"), F.lit("applied_stress"))
        .otherwise(F.lit("unspecified"))
    )
    return F.when(label == property_label, ladder)


def surface_key(text: Column) -> Column:
    """Form under which names are looked up."""
    return F.lower(F.trim(text))


def subtype(canonical: Column, label: Column, components: tuple[str, ...]) -> Column:
    is_component = surface_key(canonical).isin(*components)
    return F.when(
        label == "APPLICATION",
        F.when(is_component, F.lit("component")).otherwise(F.lit("application")),
    )
