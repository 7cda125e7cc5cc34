"""Column expressions from a grade name to a sheet thickness and a relative price."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The three places a grade name states its thickness, tried in this order.
THICKNESS_PATTERNS = (r"M\d{3}-(\d{2})A", r"^NO(\d{2})", r"^(\d{2})[A-Z]")


def thickness_mm(grade: Column) -> Column:
    """Thickness in mm from the two digits of the name, or NULL."""
    name = F.upper(F.trim(grade))
    digits = F.coalesce(
        *[F.nullif(F.regexp_extract(name, p, 1), F.lit("")) for p in THICKNESS_PATTERNS]
    )
    return digits.try_cast("double") / F.lit(100.0)


def relative_price(thickness: Column, constant: float) -> Column:
    """Price per kg relative to a 0.35 mm sheet; NULL without a positive thickness."""
    return F.when(thickness > 0, F.round(F.lit(constant) / thickness, 3))
