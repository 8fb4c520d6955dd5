"""Aggregate building blocks.

Money sums are taken as decimals: an exact sum does not depend on the order
rows arrive in, so a rounded total is the same on every run, on every
engine, and after a lost partition is recomputed.  The scale is the
caller's: 6 decimals hold money and its products with quantities; lengths of
time are summed as whole microseconds (``intervals.total_hours``).  A NaN
among the values makes the sum NaN, as a sum of doubles would.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY_SCALE = 6


def _c(x):
    return F.col(x) if isinstance(x, str) else x


def exact_sum(x, scale: int = MONEY_SCALE) -> Column:
    """Σ x computed exactly at ``scale`` decimals and returned as double."""
    v = _c(x).cast("double")
    nan = F.isnan(v)
    total = F.sum(F.when(~nan, v).cast(f"decimal(38,{scale})")).cast("double")
    return F.when(F.coalesce(F.bool_or(nan), F.lit(False)), F.lit(float("nan"))).otherwise(total)


def exact_parts(x, name: str, scale: int = MONEY_SCALE) -> list[Column]:
    """``exact_sum`` of a group in parts that sum up again: ``name``, the decimal, and ``name_nan``."""
    v = _c(x).cast("double")
    nan = F.isnan(v)
    return [F.sum(F.when(~nan, v).cast(f"decimal(38,{scale})")).alias(name), F.coalesce(F.bool_or(nan), F.lit(False)).alias(f"{name}_nan")]


def exact_value(name: str) -> Column:
    """The double that the parts of one group stand for."""
    return F.when(F.col(f"{name}_nan"), F.lit(float("nan"))).otherwise(F.col(name).cast("double"))


def exact_total(name: str) -> Column:
    """``exact_sum`` over the rows of several groups, of their parts."""
    return F.when(F.bool_or(f"{name}_nan"), F.lit(float("nan"))).otherwise(F.sum(name).cast("double"))


def exact_avg(x) -> Column:
    """exact Σ x / count(x) (null when there are no values)."""
    return exact_sum(x) / F.count(_c(x))


def weighted_average(value, weight) -> Column:
    """Σ(v·w) / Σw, null when Σw = 0 or there are no rows."""
    num = exact_sum(_c(value) * _c(weight))
    den = exact_sum(_c(weight))
    return F.try_divide(num, F.when(den != 0, den))
