"""Column expressions for fixed-width periods of years."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from papervein.config import Config


def period_start(year: Column, cfg: Config) -> Column:
    """First year of the period, also right for years before the first period."""
    steps = F.floor((year - F.lit(cfg.start_year)) / F.lit(float(cfg.period_years)))
    return (F.lit(cfg.start_year) + steps * F.lit(cfg.period_years)).cast("int")


def period_label(start: Column, cfg: Config) -> Column:
    last = start + F.lit(cfg.period_years - 1)
    return F.concat_ws("-", start.cast("string"), last.cast("string"))


def is_partial(start: Column, cfg: Config) -> Column:
    return start + F.lit(cfg.period_years - 1) > F.lit(cfg.end_year)
