"""Decision expressions over one response probability."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from campaignlens.functions.numeric import clamp
from campaignlens.settings import COST_PER_CONTACT, PROFIT_PER_RESPONDER

WILL_RESPOND = "WILL RESPOND"
WILL_NOT_RESPOND = "WILL NOT RESPOND"


def predicted(p: Column, threshold) -> Column:
    """Inclusive decision on the unrounded score."""
    return p >= (threshold if isinstance(threshold, Column) else F.lit(float(threshold)))


def label(p: Column, threshold) -> Column:
    return F.when(predicted(p, threshold), F.lit(WILL_RESPOND)).otherwise(F.lit(WILL_NOT_RESPOND))


def expected_value(p: Column, cost: float = COST_PER_CONTACT, profit: float = PROFIT_PER_RESPONDER) -> Column:
    return p * F.lit(float(profit)) - F.lit(float(cost))


def value_class(value: Column) -> Column:
    return F.when(value > 0, F.lit("Profitable Contact")).otherwise(F.lit("Negative Expected Return"))


def progress(p: Column) -> Column:
    return clamp(p)


def recommendation(p: Column, threshold, cost: float = COST_PER_CONTACT, profit: float = PROFIT_PER_RESPONDER) -> Column:
    value = expected_value(p, cost, profit)
    target = F.format_string(
        "Target prospect: likelihood %.1f%%, expected net contribution $%+.2f", p * 100, value
    )
    suppress = F.format_string(
        "Suppress outreach: likelihood %.1f%%, expected deficit -$%.2f per contact", p * 100, F.abs(value)
    )
    return F.when(predicted(p, threshold), target).otherwise(suppress)


def break_even(cost: float = COST_PER_CONTACT, profit: float = PROFIT_PER_RESPONDER) -> float:
    return cost / profit
