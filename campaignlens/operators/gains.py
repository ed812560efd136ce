"""Cumulative gains, deciles and lift."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from campaignlens.functions.numeric import ratio
from campaignlens.operators.ranking import positions_by_score, ranked_by_score

DECILES = 10


def decile_end(decile: int, n: Column) -> Column:
    """Last 1-based position of a decile: equal-count bins by interpolated position quantiles."""
    return (F.floor(F.lit(decile) * (n - 1) / F.lit(float(DECILES))) + 1).cast("bigint")


def decile_of(position: Column, n: Column) -> Column:
    """Decile of a 1-based position; decile 1 holds the highest scores."""
    zero_based = position - 1
    return F.when(n > 1, F.greatest(F.lit(1), F.ceil(zero_based * F.lit(DECILES) / (n - 1)))).otherwise(F.lit(1)).cast("int")


def gains_curve(scored: DataFrame, keys: Sequence[str] = ("model",), digits: int | None = None) -> DataFrame:
    """Every row with its position, decile and cumulative shares."""
    ranked = ranked_by_score(scored, keys, digits)
    n, position = F.col("all_n"), F.col("run_n")
    return ranked.select(
        *keys,
        "id",
        "p",
        "y",
        position.alias("position"),
        decile_of(position, n).alias("decile"),
        F.col("run_pos").alias("cum_responders"),
        (ratio(F.col("run_pos"), F.col("all_pos")) * 100).alias("cum_pct_responders"),
        (ratio(position, n) * 100).alias("cum_pct_customers"),
    )


def decile_lift(scored: DataFrame, keys: Sequence[str] = ("model",), digits: int | None = None) -> DataFrame:
    """Size, responders, response rate and lift per decile, without ranking all rows.

    Only the ten boundary positions are located; differences of the running counts at these
    positions give the deciles.
    """
    ends = positions_by_score(
        scored, lambda n: [decile_end(d, n) for d in range(1, DECILES + 1)], keys, digits
    )
    order = Window.partitionBy(*keys).orderBy("run_n")
    size = F.col("run_n") - F.lag("run_n", 1, 0).over(order)
    responders = F.col("run_pos") - F.lag("run_pos", 1, 0).over(order)
    rates = ends.select(
        *keys,
        decile_of(F.col("run_n"), F.col("all_n")).alias("decile"),
        size.cast("bigint").alias("customers"),
        responders.cast("bigint").alias("responders"),
        (ratio(F.col("all_pos"), F.col("all_n")) * 100).alias("base_rate"),
    )
    rate = ratio(F.col("responders"), F.col("customers")) * 100
    return rates.withColumn("response_rate", rate).withColumn("lift", ratio(F.col("response_rate"), F.col("base_rate")))


def gains_at(
    scored: DataFrame, percents: Sequence[float] = (20, 30), keys: Sequence[str] = ("model",), digits: int | None = None
) -> DataFrame:
    """Share of responders reached at some customer shares; needs at least ``100/percent`` rows."""
    def cut(n: Column, pct: float) -> Column:
        return F.floor(n * F.lit(pct / 100.0)).cast("bigint")

    at = positions_by_score(scored, lambda n: [cut(n, pct) for pct in percents], keys, digits)
    options = F.array(
        *[F.when(F.col("run_n") == cut(F.col("all_n"), pct), F.lit(float(pct))) for pct in percents]
    )
    return (
        at.withColumn("pct_customers", F.explode(F.array_compact(options)))
        .select(
            *keys,
            "pct_customers",
            F.col("run_n").alias("position"),
            F.col("run_pos").alias("cum_responders"),
            (ratio(F.col("run_pos"), F.col("all_pos")) * 100).alias("cum_pct_responders"),
        )
    )
