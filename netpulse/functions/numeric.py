"""Rounding and ratios that give the same digits on any engine and any task layout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EXACT = "decimal(28,12)"


def round_half_up(value: Column, digits: int) -> Column:
    """Round a double half away from zero, returned as double.

    The value first becomes a decimal with 12 places, which removes the last-bit noise that the
    order of a distributed sum leaves behind. Values no such decimal can hold (huge, NaN) take the
    plain double rounding instead of failing the query.
    """
    value = value.cast("double")
    exact = F.round(value.try_cast(_EXACT), digits).cast("double")
    return F.coalesce(exact, F.round(value, digits))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double; null where the denominator is zero or null."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def percent(part: Column, whole: Column, digits: int) -> Column:
    return round_half_up(ratio(part, whole) * F.lit(100.0), digits)
