"""A fixed-coefficient logistic score: a deterministic model that needs no fitting."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, functions as F

# Fixed values of the demonstration scorecard.
INTERCEPT = -2.2
WEIGHTS = {
    "income": 0.000008,
    "previous_purchases": 0.02,
    "purchase_frequency": -0.15,
    "previous_campaign_response": 0.45,
    "website_visits": 0.03,
    "email_engagement": 2.4,
    "discount_usage": -0.35,
}
OLDEST_GROUP_WEIGHT = 0.1
SCORE_DIGITS = 4


def score_terms(features: dict[str, Column] | None = None) -> dict[str, Column]:
    """What every feature by itself adds to the intercept, in the order of addition; missing values count as zero."""
    features = features or {}
    terms = {
        name: F.lit(weight) * F.coalesce(features.get(name, F.col(name)).cast("double"), F.lit(0.0)) for name, weight in WEIGHTS.items()
    }
    oldest = features.get("age_group", F.col("age_group")) == "56+"
    return terms | {"age_group": F.when(oldest, F.lit(OLDEST_GROUP_WEIGHT)).otherwise(F.lit(0.0))}


def score_curve(z: np.ndarray) -> np.ndarray:
    """Probability of the terms' sum, rounded half-even to four decimals."""
    unit = 10.0**SCORE_DIGITS
    return np.rint(1.0 / (1.0 + np.exp(-z)) * unit) / unit


def scorecard(features: dict[str, Column] | None = None) -> Column:
    """Probability rounded half-even to four decimals; missing values count as zero.

    ``features`` replaces single feature columns, which is how variants of a row are scored.
    """
    z = F.lit(INTERCEPT)
    for term in score_terms(features).values():
        z = z + term
    return F.bround(F.lit(1.0) / (F.lit(1.0) + F.exp(-z)), SCORE_DIGITS)
