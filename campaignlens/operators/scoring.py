"""Batch scoring of customer tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from campaignlens.functions.decisions import expected_value, label, predicted, recommendation, value_class
from campaignlens.functions.numeric import count_where, half_even, ratio
from campaignlens.operators.checks import require_rows, require_schema
from campaignlens.operators.features import conform
from campaignlens.settings import AGE_GROUPS, COST_PER_CONTACT

PROBABILITY_DIGITS = 4
CUSTOM_RANGE = (0.05, 0.90)


def resolve_threshold(choice: str | float, f1_threshold: float, profit_threshold: float) -> float:
    """``default``, ``f1``, ``profit`` or a custom number in the allowed range."""
    named = {"default": 0.50, "f1": f1_threshold, "profit": profit_threshold}
    if isinstance(choice, str):
        return named[choice]
    low, high = CUSTOM_RANGE
    if not low <= choice <= high:
        raise ValueError(f"custom threshold must lie between {low} and {high}")
    return float(choice)


def model_probability(model) -> Callable[[DataFrame], DataFrame]:
    """Append ``p`` = probability of class 1 by a fitted pipeline."""
    def score(rows: DataFrame) -> DataFrame:
        kept = rows.columns
        return model.transform(rows).select(*kept, vector_to_array("probability")[1].alias("p"))

    return score


def decide(scored: DataFrame, threshold: float | Column) -> DataFrame:
    """Four-digit probability and text label; the label uses the unrounded score."""
    return scored.withColumns(
        {
            "Response_Probability": half_even(F.col("p"), PROBABILITY_DIGITS),
            "Prediction": label(F.col("p"), threshold),
        }
    )


def score_batch(score: Callable[[DataFrame], DataFrame], rows: DataFrame, threshold: float) -> DataFrame:
    """Validate, score and label a table; input columns are kept. One narrow stage."""
    require_schema(rows)
    require_rows(rows)
    return decide(score(conform(rows)), threshold).drop("p")


def batch_summary(scored: DataFrame, threshold: float, cost: float = COST_PER_CONTACT) -> DataFrame:
    """Rows, targeted rows and share, spend, and rows with an unknown age group."""
    targeted = count_where(predicted(F.col("p"), threshold))
    return scored.agg(
        F.count(F.lit(1)).alias("prospects"),
        targeted.alias("targeted"),
        count_where(~F.col("age_group").isin(*AGE_GROUPS)).alias("unknown_age_group"),
    ).withColumns(
        {
            "targeted_pct": ratio(F.col("targeted"), F.col("prospects")) * 100,
            "spend": F.col("targeted") * F.lit(float(cost)),
        }
    )


def contact_advice(scored: DataFrame, threshold: float) -> DataFrame:
    """Expected value per contact, its class and the recommendation text."""
    value = expected_value(F.col("p"))
    return scored.withColumns(
        {
            "expected_value": value,
            "value_class": value_class(value),
            "recommendation": recommendation(F.col("p"), threshold),
        }
    )
