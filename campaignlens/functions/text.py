"""Number formatting and parameter-name helpers for report tables."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def fixed(column: Column, digits: int) -> Column:
    """Fixed decimals without thousands separators."""
    return F.regexp_replace(F.format_number(column, digits), ",", "")


def thousands(column: Column, digits: int = 0) -> Column:
    return F.format_number(column, digits)


def money(column: Column, digits: int = 2) -> Column:
    """``$1,234.50``, with the sign kept in front of the digits."""
    return F.concat(F.lit("$"), F.format_number(column, digits))


def percent(share: Column, digits: int = 1) -> Column:
    return F.concat(F.format_number(share * 100, digits), F.lit("%"))


def counts_text(*columns: Column) -> Column:
    """``374 / 7 / 49 / 18``."""
    return F.concat_ws(" / ", *[c.cast("string") for c in columns])


def mean_with_deviation(mean: Column, deviation: Column, digits: int = 4) -> Column:
    return F.concat(fixed(mean, digits), F.lit(" ± "), fixed(deviation, digits))


def strip_step_prefix(parameters: Column, prefix: str = "classifier__") -> Column:
    """Drop the pipeline-step prefix from the names of a parameter map."""
    return F.transform_keys(parameters, lambda k, _: F.replace(k, F.lit(prefix), F.lit("")))
