"""Gaussian naive Bayes with variance smoothing, fitted and applied as plain aggregation."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from campaignlens.settings import TARGET, TRANSFORMED_FEATURES


def fit_gaussian_nb(
    train: DataFrame,
    keys: Sequence[str] = (),
    smoothing: float = 1e-9,
    columns: Sequence[str] = TRANSFORMED_FEATURES,
    label: str = TARGET,
) -> DataFrame:
    """One row per key with class priors, means and smoothed variances of both classes.

    One pass over the rows. The smoothing term is ``smoothing`` times the largest variance over
    all rows, which follows from the class moments.
    """
    keys = list(keys)
    per_class = train.groupBy(*keys, label).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(F.col(f"`{c}`")).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.var_pop(F.col(f"`{c}`")).alias(f"v{i}") for i, c in enumerate(columns)],
    )
    wide = per_class.groupBy(*keys).agg(
        *[
            F.max(F.when(F.col(label) == cls, F.col(name))).alias(f"{name}_{cls}")
            for cls in (0, 1)
            for name in ["n", *[f"m{i}" for i in range(len(columns))], *[f"v{i}" for i in range(len(columns))]]
        ]
    )
    n0, n1 = F.coalesce(F.col("n_0"), F.lit(0)), F.coalesce(F.col("n_1"), F.lit(0))
    overall = []
    for i in range(len(columns)):
        m0, m1 = (F.coalesce(F.col(f"m{i}_{c}"), F.lit(0.0)) for c in (0, 1))
        v0, v1 = (F.coalesce(F.col(f"v{i}_{c}"), F.lit(0.0)) for c in (0, 1))
        mean = (n0 * m0 + n1 * m1) / (n0 + n1)
        overall.append((n0 * (v0 + F.pow(m0 - mean, 2)) + n1 * (v1 + F.pow(m1 - mean, 2))) / (n0 + n1))
    epsilon = F.greatest(*overall) * F.lit(float(smoothing))
    wide = wide.withColumn("epsilon", epsilon)
    smoothed = [
        (F.col(f"v{i}_{cls}") + F.col("epsilon")).alias(f"v{i}_{cls}") for cls in (0, 1) for i in range(len(columns))
    ]
    means = [F.col(f"m{i}_{cls}") for cls in (0, 1) for i in range(len(columns))]
    priors = [(F.col(f"n_{cls}") / (n0 + n1)).alias(f"prior_{cls}") for cls in (0, 1)]
    return wide.select(*keys, "epsilon", *priors, *means, *smoothed)


def nb_parameters_long(parameters: DataFrame, keys: Sequence[str] = (), columns: Sequence[str] = TRANSFORMED_FEATURES) -> DataFrame:
    """``(keys, class, feature, prior, mean, variance)``: at most 22 rows per fit."""
    cells = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(cls).alias("class"),
                    F.lit(c).alias("feature"),
                    F.col(f"prior_{cls}").alias("prior"),
                    F.col(f"m{i}_{cls}").alias("mean"),
                    F.col(f"v{i}_{cls}").alias("variance"),
                )
                for cls in (0, 1)
                for i, c in enumerate(columns)
            ]
        )
    )
    return parameters.select(*keys, cells.alias("cell")).select(*keys, "cell.*")


def _log_likelihood(cls: int, columns: Sequence[str]) -> Column:
    terms = F.ln(F.col(f"prior_{cls}"))
    for i, c in enumerate(columns):
        gap = F.col(f"`{c}`") - F.col(f"m{i}_{cls}")
        v = F.col(f"v{i}_{cls}")
        terms = terms - F.lit(0.5) * F.ln(F.lit(2 * math.pi) * v) - gap * gap / (F.lit(2.0) * v)
    return terms


def score_gaussian_nb(
    rows: DataFrame,
    parameters: DataFrame,
    keys: Sequence[str] = (),
    columns: Sequence[str] = TRANSFORMED_FEATURES,
    output: str = "p",
) -> DataFrame:
    """Probability of class 1; ``parameters`` has one row per fit."""
    if not keys:
        one = F.lit(0)
        return score_gaussian_nb(
            rows.withColumn("_fit", one), parameters.withColumn("_fit", one), ["_fit"], columns, output
        ).drop("_fit")
    keys = list(keys)
    joined = rows.join(F.broadcast(parameters), keys)
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(_log_likelihood(0, columns) - _log_likelihood(1, columns)))
    return joined.withColumn(output, p).drop(*[c for c in parameters.columns if c not in keys])
