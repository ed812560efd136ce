"""Leakage-free behavioural features: one narrow projection, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from campaignlens.functions.numeric import clamp, clean, half_even, total
from campaignlens.settings import (
    AGE_GROUPS,
    AGE_UPPER_BOUNDS,
    CAMPAIGN_COLUMNS,
    DAYS_PER_MONTH,
    FEATURE_SCHEMA,
    FEATURES,
    NUMERIC_FEATURES,
    REFERENCE_DATE,
    REFERENCE_YEAR,
    TARGET,
)


def age_group(age: Column) -> Column:
    """Right-closed bins; the first one is open below. A missing age stays missing."""
    binned = F.when(age <= AGE_UPPER_BOUNDS[0], F.lit(AGE_GROUPS[0]))
    for upper, name in zip(AGE_UPPER_BOUNDS[1:], AGE_GROUPS[1:]):
        binned = binned.when(age <= upper, F.lit(name))
    return binned.when(age.isNotNull(), F.lit(AGE_GROUPS[-1]))


def age_group_position(group: Column) -> Column:
    """Bin order, for sorting by age."""
    return F.array_position(F.array(*[F.lit(g) for g in AGE_GROUPS]), group)


def tenure_months(first_seen: Column, reference_date: str, tolerant: bool = False) -> Column:
    text = first_seen
    parsed = F.try_to_timestamp(text, F.lit("dd-MM-yyyy")).cast("date") if tolerant else F.to_date(text, "dd-MM-yyyy")
    return F.datediff(F.lit(reference_date).cast("date"), parsed) / F.lit(DAYS_PER_MONTH)


def purchase_frequency(purchases: Column, months: Column) -> Column:
    """Purchases per month, with tenure floored at one month."""
    floored = F.when(months.isNotNull(), F.greatest(months, F.lit(1.0)))
    return half_even(purchases / floored, 4)


def discount_usage(deals: Column, purchases: Column) -> Column:
    """Share of purchases made with a deal; zero purchases give zero."""
    return half_even(clamp(F.when(purchases > 0, deals / purchases).otherwise(F.lit(0.0))), 4)


def engineer_features(
    raw: DataFrame,
    reference_year: int = REFERENCE_YEAR,
    reference_date: str = REFERENCE_DATE,
    tolerant_dates: bool = False,
) -> DataFrame:
    """Eight features and the target, keyed by ``id``. ``Response`` feeds the target only."""
    purchases = total([F.col(c) for c in ("NumWebPurchases", "NumCatalogPurchases", "NumStorePurchases")]).cast("double")
    prior = total([F.col(c) for c in CAMPAIGN_COLUMNS])
    return raw.select(
        F.col("ID").cast("bigint").alias("id"),
        age_group(F.lit(reference_year) - F.col("Year_Birth")).alias("age_group"),
        clean(F.col("Income")).alias("income"),
        purchases.alias("previous_purchases"),
        purchase_frequency(purchases, tenure_months(F.col("Dt_Customer"), reference_date, tolerant_dates)).alias(
            "purchase_frequency"
        ),
        F.when(prior >= 1, 1).otherwise(0).alias("previous_campaign_response"),
        F.col("NumWebVisitsMonth").cast("double").alias("website_visits"),
        half_even(prior / F.lit(5.0), 4).alias("email_engagement"),
        discount_usage(F.col("NumDealsPurchases").cast("double"), purchases).alias("discount_usage"),
        F.col("Response").cast("int").alias(TARGET),
    )


def feature_columns(rows: DataFrame, with_target: bool = True) -> DataFrame:
    """The model columns in their fixed order."""
    return rows.select("id", *FEATURES, *([TARGET] if with_target else []))


def available_numeric(rows: DataFrame) -> list[str]:
    """Known numeric features that are present, else every numeric column."""
    known = [c for c in NUMERIC_FEATURES if c in rows.columns]
    if known:
        return known
    numeric = {"tinyint", "smallint", "int", "bigint", "float", "double"}
    return [name for name, kind in rows.dtypes if kind in numeric or kind.startswith("decimal")]


def conform(rows: DataFrame) -> DataFrame:
    """Cast an uploaded table to the feature types, NaN to NULL, extra columns kept."""
    casts = {}
    for field in FEATURE_SCHEMA.fields:
        if field.name in rows.columns:
            column = F.col(field.name).cast(field.dataType)
            casts[field.name] = F.when(~F.isnan(column), column) if field.dataType.typeName() == "double" else column
    return rows.withColumns(casts)
