"""Fixed values and column lists of the campaign model."""

from __future__ import annotations

from pyspark.sql import types as T

# They must equal the published ones for results to agree.
COST_PER_CONTACT = 5.0
PROFIT_PER_RESPONDER = 50.0
REFERENCE_YEAR = 2014
REFERENCE_DATE = "2014-12-31"
DAYS_PER_MONTH = 30.4375
SEED = 42
AGE_UPPER_BOUNDS = (25, 35, 45, 55)
AGE_GROUPS = ("18-25", "26-35", "36-45", "46-55", "56+")

TARGET = "target"
NUMERIC_FEATURES = (
    "income",
    "previous_purchases",
    "purchase_frequency",
    "previous_campaign_response",
    "website_visits",
    "email_engagement",
    "discount_usage",
)
FEATURES = (
    "age_group",
    "income",
    "previous_purchases",
    "purchase_frequency",
    "previous_campaign_response",
    "website_visits",
    "email_engagement",
    "discount_usage",
)
DUMMIES = tuple(f"age_group_{g}" for g in AGE_GROUPS[1:])
TRANSFORMED_FEATURES = NUMERIC_FEATURES + DUMMIES

# Input limits of the scoring form; reported, never used to reject rows.
INPUT_BOUNDS = {
    "income": (0.0, 1_000_000.0),
    "previous_purchases": (0.0, 100.0),
    "purchase_frequency": (0.0, 10.0),
    "previous_campaign_response": (0.0, 1.0),
    "website_visits": (0.0, 50.0),
    "email_engagement": (0.0, 1.0),
    "discount_usage": (0.0, 1.0),
}

CAMPAIGN_COLUMNS = tuple(f"AcceptedCmp{k}" for k in range(1, 6))

RAW_SCHEMA = T.StructType(
    [
        T.StructField("ID", T.LongType(), False),
        T.StructField("Year_Birth", T.IntegerType()),
        T.StructField("Income", T.DoubleType()),
        T.StructField("Dt_Customer", T.StringType()),
        T.StructField("NumWebPurchases", T.IntegerType()),
        T.StructField("NumCatalogPurchases", T.IntegerType()),
        T.StructField("NumStorePurchases", T.IntegerType()),
        T.StructField("NumDealsPurchases", T.IntegerType()),
        T.StructField("NumWebVisitsMonth", T.IntegerType()),
        *[T.StructField(c, T.IntegerType()) for c in CAMPAIGN_COLUMNS],
        T.StructField("Response", T.IntegerType()),
    ]
)

FEATURE_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("age_group", T.StringType()),
        T.StructField("income", T.DoubleType()),
        T.StructField("previous_purchases", T.DoubleType()),
        T.StructField("purchase_frequency", T.DoubleType()),
        T.StructField("previous_campaign_response", T.IntegerType()),
        T.StructField("website_visits", T.DoubleType()),
        T.StructField("email_engagement", T.DoubleType()),
        T.StructField("discount_usage", T.DoubleType()),
        T.StructField(TARGET, T.IntegerType()),
    ]
)


def linear_grid(start: float = 0.05, stop: float = 0.95, points: int = 91) -> list[float]:
    """Evenly spaced thresholds, each computed as ``start + i * step``."""
    if points == 1:
        return [start]
    step = (stop - start) / (points - 1)
    values = [start + i * step for i in range(points)]
    values[-1] = stop
    return values
