"""Customer profiles by actual and by predicted status."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from campaignlens.functions.decisions import predicted
from campaignlens.functions.numeric import clean
from campaignlens.operators.features import available_numeric
from campaignlens.operators.quantiles import medians_wide

DIGITS = 2


def customer_profiles(
    rows: DataFrame, threshold: float | str, score: str = "p", label: str = "y", columns: Sequence[str] | None = None
) -> DataFrame:
    """Mean and median of the numeric features per segment, half-even to two decimals.

    ``threshold`` is a number or the name of a column. Each row belongs to one actual and one
    predicted segment; both are aggregated in the same job.
    """
    columns = list(columns or available_numeric(rows))
    hit = predicted(F.col(score), F.col(threshold) if isinstance(threshold, str) else threshold)
    segments = F.array(
        F.when(F.col(label) == 1, F.lit("Actual Responder")).otherwise(F.lit("Actual Non-Responder")),
        F.when(hit, F.lit("Predicted Responder")).otherwise(F.lit("Predicted Non-Responder")),
    )
    tall = rows.select(F.explode(segments).alias("segment"), *columns)
    means = tall.groupBy("segment").agg(
        F.count(F.lit(1)).alias("customers"), *[F.avg(clean(F.col(c))).alias(f"{c}_avg") for c in columns]
    )
    medians = medians_wide(tall, columns, ["segment"], suffix="_mid")
    joined = means.join(medians, "segment", "left")
    return joined.select(
        "segment",
        "customers",
        *[
            F.bround(f"{c}_{source}", DIGITS).alias(f"{c}_{name}")
            for c in columns
            for source, name in (("avg", "mean"), ("mid", "median"))
        ],
    )
