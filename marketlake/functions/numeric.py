"""Rounding and sums that give the same answer however the rows are partitioned.

Adding doubles depends on the order in which partitions arrive. Amounts and
scores are therefore added as whole numbers of 1/10,000 in a bigint (the sum
stays inside whole-stage codegen and the hash aggregate) and divided once.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNIT = 10_000


def _nearest(x: Column, scale: float) -> Column:
    """The nearest whole number of 1/scale, halves away from zero; null for null and NaN."""
    up = F.floor(F.abs(x) * F.lit(scale) + F.lit(0.5))
    return F.when(F.isnan(x), F.lit(None)).when(x < 0, -up).otherwise(up)


def round_half_up(x: Column, dp: int = 2) -> Column:
    scale = float(10**dp)
    return _nearest(x, scale) / F.lit(scale)


def units(x: Column) -> Column:
    """A double as a bigint count of 1/10,000: further decimals are rounded, NaN is null."""
    return _nearest(x, float(UNIT))


def exact_sum(x: Column) -> Column:
    return F.sum(units(x)) / F.lit(float(UNIT))


def exact_avg(x: Column) -> Column:
    return F.sum(units(x)) / F.count(x) / F.lit(float(UNIT))


def ratio(num: Column, den: Column) -> Column:
    """Division that is null, not an error, when the divisor is 0 or null."""
    return num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))


def count_when(cond: Column) -> Column:
    return F.count(F.when(cond, F.lit(1)))


def finite(x: Column) -> Column:
    """The number, or null for NaN and the infinities."""
    bad = F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    return F.when(~bad, x)
