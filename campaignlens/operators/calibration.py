"""Probability calibration: Brier score, reliability table, sigmoid calibration, deployment rule."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from campaignlens.functions.numeric import count_where
from campaignlens.operators.logistic import fit_logits
from campaignlens.operators.sampling import stratified_folds
from campaignlens.sources.store import durable

RELIABILITY_BINS = 10


def brier(scored: DataFrame, keys: Sequence[str] = ("model",)) -> DataFrame:
    gap = F.col("p") - F.col("y")
    return scored.groupBy(*keys).agg(F.avg(gap * gap).alias("brier"))


def reliability_bin(p: Column, bins: int = RELIABILITY_BINS) -> Column:
    """Equal-width bin; a score on an inner edge belongs to the lower bin."""
    edges = F.array(*[F.lit(i * (1.0 / bins)) for i in range(1, bins)])
    return F.size(F.filter(edges, lambda edge: edge < p))


def reliability_table(scored: DataFrame, keys: Sequence[str] = ("model",), bins: int = RELIABILITY_BINS) -> DataFrame:
    """Mean score and observed rate per bin; empty bins are absent."""
    return scored.groupBy(*keys, reliability_bin(F.col("p"), bins).alias("bin")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg("p").alias("mean_score"),
        F.avg("y").alias("observed_rate"),
    )


def _cells(scored: DataFrame, fit: Column) -> DataFrame:
    """``(fit, p, n, y)``: rows of equal score in every fit, ``y`` their mean smoothed target."""
    counts = scored.withColumn("fit", fit).groupBy("fit", "p").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("n1"))
    sizes = counts.groupBy("fit").agg(F.sum("n1").alias("pos"), F.sum(F.col("n") - F.col("n1")).alias("neg"))  # one row per fit
    high, low = (F.col("pos") + 1.0) / (F.col("pos") + 2.0), F.lit(1.0) / (F.col("neg") + 2.0)
    target = (F.col("n1") * high + (F.col("n") - F.col("n1")) * low) / F.col("n")
    return counts.join(sizes, "fit").select("fit", "p", "n", target.alias("y"))


def fit_sigmoids(scored: DataFrame, fit: Column) -> dict[int, tuple[float, float]]:
    """Slope and intercept of a logistic curve through ``(p, y)`` with smoothed targets, for every value of ``fit``."""
    curves = fit_logits(durable(_cells(scored, fit)), ["p"], weight="n", fit="fit")
    return {c.fit: (c.coefficients[0], c.intercept) for c in curves}


def fit_sigmoid(scored: DataFrame) -> tuple[float, float]:
    """Slope and intercept over all rows."""
    return fit_sigmoids(scored, F.lit(0))[0]


def sigmoid(p: Column, slope: float, intercept: float) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-(p * F.lit(slope) + F.lit(intercept))))


def out_of_fold_calibrated(scored: DataFrame, k: int = 5) -> DataFrame:
    """``(id, y, p, calibrated)``: every row calibrated by a curve fitted on the other folds."""
    folded = durable(stratified_folds(scored, k, stratum="y", tag="calibration", output="cal_fold"))
    others = F.filter(F.array(*[F.lit(f) for f in range(k)]), lambda f: f != F.col("cal_fold"))
    value = F.lit(None).cast("double")
    for f, (slope, intercept) in fit_sigmoids(folded, F.explode(others)).items():
        value = F.when(F.col("cal_fold") == f, sigmoid(F.col("p"), slope, intercept)).otherwise(value)
    return folded.withColumn("calibrated", value)


def calibration_check(validation: DataFrame, test: DataFrame, k: int = 5) -> dict[str, object]:
    """Brier scores before and after calibration on validation (out of fold) and test rows.

    Both inputs are ``(id, y, p)`` scored by the same model fitted on neither of them.
    """
    gap = lambda c: (F.col(c) - F.col("y")) * (F.col(c) - F.col("y"))
    val = out_of_fold_calibrated(validation, k).agg(F.avg(gap("p")).alias("raw"), F.avg(gap("calibrated")).alias("cal")).first()
    slope, intercept = fit_sigmoid(validation)
    tested = test.withColumn("calibrated", sigmoid(F.col("p"), slope, intercept))
    tst = tested.agg(F.avg(gap("p")).alias("raw"), F.avg(gap("calibrated")).alias("cal")).first()
    return {
        "validation_uncalibrated": val["raw"],
        "validation_calibrated": val["cal"],
        "test_uncalibrated": tst["raw"],
        "test_calibrated": tst["cal"],
        "validation_improved": validation_improved(val["raw"], val["cal"]),
        "slope": slope,
        "intercept": intercept,
    }


def validation_improved(raw: float, calibrated: float) -> bool:
    """Deploy the calibrated model only if its validation score is strictly lower."""
    return bool(calibrated < raw)
