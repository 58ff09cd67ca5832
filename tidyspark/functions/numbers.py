"""Column expressions over numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_even(value: Column, digits: int) -> Column:
    """Round a double half to even by scaling, as array libraries do.

    ``rint`` is one machine instruction; ``bround`` goes through a decimal.
    """
    scale = float(10**digits)
    return F.rint(value * F.lit(scale)) / F.lit(scale)


def percent(part: Column, whole: Column) -> Column:
    """``part / whole * 100`` as a double, 0 for an empty whole."""
    return F.when(whole > 0, part.cast("double") / whole.cast("double") * 100.0).otherwise(F.lit(0.0))


def finite(value: Column) -> Column:
    """NULL for NaN and both infinities."""
    bad = F.isnan(value) | value.isin(float("inf"), float("-inf"))
    return F.when(~bad, value)


def not_nan(value: Column) -> Column:
    return F.when(~F.isnan(value), value)
