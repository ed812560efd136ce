"""Numeric column helpers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F


def clean(column: Column) -> Column:
    """Double with NaN mapped to NULL, so that only NULL means missing."""
    value = column.cast("double")
    return F.when(~F.isnan(value), value)


def half_even(column: Column, digits: int) -> Column:
    return F.bround(column, digits)


def ratio(numerator: Column, denominator: Column, default: float | None = 0.0) -> Column:
    """``numerator / denominator`` as double; ``default`` where the denominator is not positive."""
    value = F.when(denominator > 0, numerator.cast("double") / denominator.cast("double"))
    return value if default is None else value.otherwise(F.lit(float(default)))


def clamp(column: Column, low: float = 0.0, high: float = 1.0) -> Column:
    """Limit to ``[low, high]``; missing stays missing."""
    return F.when(column.isNotNull(), F.least(F.greatest(column, F.lit(low)), F.lit(high)))


def total(columns) -> Column:
    """Sum of columns; missing when any part is missing."""
    return reduce(lambda a, b: a + b, columns)


def count_where(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def exact_sum(value: Column) -> Column:
    """Sum of numbers between -1 and 1, each rounded to 52 binary digits: the same whatever the order of additions.

    The total must stay below 2048 in magnitude.
    """
    return F.sum(F.rint(value * F.lit(float(1 << 52))).cast("bigint")) / F.lit(float(1 << 52))
