"""Preprocessing fitted on training rows only: impute, standardize, encode.

The library stages are not used because they differ: their imputer does not interpolate the
median, their scaler divides by the sample deviation, their encoder drops the last category.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, functions as F

from campaignlens.functions.numeric import clean
from campaignlens.operators.quantiles import quantiles_of_counts, value_counts
from campaignlens.settings import AGE_GROUPS, DUMMIES, NUMERIC_FEATURES, TRANSFORMED_FEATURES


def _fold_summaries(train: DataFrame, by: Sequence[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Row-level work of a fit: value counts, moments and group sizes per ``by``."""
    observed = []
    for c in NUMERIC_FEATURES:
        value = f"CASE WHEN NOT isnan(CAST({c} AS DOUBLE)) THEN CAST({c} AS DOUBLE) END"
        observed += [
            F.expr(f"count({value}) AS {c}_seen"),
            F.expr(f"coalesce(avg({value}), 0D) AS {c}_avg"),
            F.expr(f"coalesce(var_pop({value}), 0D) AS {c}_var"),
        ]
    counts = value_counts(train, NUMERIC_FEATURES, by)
    moments = train.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), *observed)
    groups = train.where(F.col("age_group").isNotNull()).groupBy(*by, "age_group").agg(F.count(F.lit(1)).alias("size"))
    return counts, moments, groups


def _statistics(counts: DataFrame, moments: DataFrame, groups: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Statistics per key from summaries that may hold several rows per key.

    Mean and deviation after imputation follow from the observed values and the median.
    """
    keys = list(keys)
    medians = quantiles_of_counts(counts, {"q": 0.5}, keys)
    medians = medians.groupBy(*keys).agg(
        *[F.expr(f"max(CASE WHEN column = '{c}' THEN q END) AS {c}_median") for c in NUMERIC_FEATURES]
    )
    common = (
        groups.groupBy(*keys, "age_group")
        .agg(F.sum("size").alias("size"))
        .groupBy(*keys)
        .agg(F.min_by("age_group", F.struct(-F.col("size"), F.col("age_group"))).alias("age_group_mode"))
    )
    # A handful of rows per key, so the window holds only summaries.
    same = "OVER (PARTITION BY " + ", ".join(keys) + ")"
    centred = moments.selectExpr(
        "*",
        *[f"try_divide(sum({c}_seen * {c}_avg) {same}, sum({c}_seen) {same}) AS {c}_all" for c in NUMERIC_FEATURES],
    )
    pooled = centred.groupBy(*keys).agg(
        F.sum("rows").alias("rows"),
        *[
            F.expr(part)
            for c in NUMERIC_FEATURES
            for part in (
                f"sum({c}_seen) AS {c}_seen",
                f"max({c}_all) AS {c}_avg",
                f"try_divide(sum({c}_seen * ({c}_var + pow({c}_avg - {c}_all, 2))), sum({c}_seen)) AS {c}_var",
            )
        ],
    )
    joined = pooled.join(medians, keys, "left").join(common, keys, "left")
    means = joined.selectExpr(
        "*",
        *[
            f"({c}_seen * {c}_avg + (rows - {c}_seen) * coalesce({c}_median, 0D)) / rows AS {c}_mean"
            for c in NUMERIC_FEATURES
        ],
    )
    final = [
        cell
        for c in NUMERIC_FEATURES
        for cell in (
            f"{c}_median",
            f"{c}_mean",
            f"sqrt(({c}_seen * ({c}_var + pow({c}_avg - {c}_mean, 2))"
            f" + (rows - {c}_seen) * pow(coalesce({c}_median, 0D) - {c}_mean, 2)) / rows) AS {c}_std",
        )
    ]
    return means.selectExpr(*keys, "rows", *final, "age_group_mode")


def prep_statistics(train: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """One row per key: median, mean and population deviation after imputation, most frequent group."""
    if not keys:
        return prep_statistics(train.withColumn("_fit", F.lit(0)), ["_fit"]).drop("_fit")
    return _statistics(*_fold_summaries(train, keys), keys)


def fold_statistics(train: DataFrame, fits: Sequence[int]) -> DataFrame:
    """Statistics of many fits, keyed by ``fit``, where fit ``f`` uses all rows outside fold ``f``.

    Rows are summarized once per fold; only the summaries are repeated per fit. A number in
    ``fits`` that is no fold stands for a fit on all rows.
    """
    wanted = F.filter(F.array(*[F.lit(f) for f in fits]), lambda f: f != F.col("fold"))
    spread = lambda rows: rows.withColumn("fit", F.explode(wanted)).drop("fold")
    counts, moments, groups = _fold_summaries(train, ["fold"])
    merged = spread(counts).groupBy("fit", "column", "value").agg(F.sum("n").alias("n"))
    return _statistics(merged, spread(moments), spread(groups), ["fit"])


def _scaled(c: str, median: Column, mean: Column, std: Column) -> Column:
    """Imputed and standardized value; zero for a constant column or one without any value."""
    filled = F.coalesce(clean(F.col(c)), median)
    return F.when(std > 0, (filled - mean) / std).otherwise(F.lit(0.0))


def transformed(rows: DataFrame, statistics: DataFrame, keys: Sequence[str] = (), carry: Sequence[str] = ()) -> DataFrame:
    """The 11 model columns from fitted statistics; an unknown age group encodes to zeros.

    A carried ``age_group`` is the imputed one, the same that the indicators encode.

    ``statistics`` has one row per fit (a handful of folds), which bounds the broadcast.
    """
    if not keys:
        one = F.lit(0)
        return transformed(
            rows.withColumn("_fit", one), statistics.withColumn("_fit", one), ["_fit"], carry
        ).drop("_fit")
    keys = list(keys)
    joined = rows.join(F.broadcast(statistics), keys)
    columns = [
        _scaled(c, F.col(f"{c}_median"), F.col(f"{c}_mean"), F.col(f"{c}_std")).alias(c) for c in NUMERIC_FEATURES
    ]
    group = F.coalesce(F.col("age_group"), F.col("age_group_mode"))
    columns += [
        F.coalesce((group == F.lit(name)).cast("double"), F.lit(0.0)).alias(dummy)
        for name, dummy in zip(AGE_GROUPS[1:], DUMMIES)
    ]
    kept = [group.alias(c) if c == "age_group" else F.col(c) for c in dict.fromkeys([*keys, "id", *carry])]
    return joined.select(*kept, *columns)


class _PrepParams(Params):
    outputCol = Param(Params._dummy(), "outputCol", "vector column", TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(outputCol="features")

    def getOutputCol(self) -> str:
        return self.getOrDefault(self.outputCol)


class CampaignPreprocessor(Estimator, _PrepParams, DefaultParamsReadable, DefaultParamsWritable):
    """Pipeline stage around ``prep_statistics``; appends a vector and leaves all columns in place."""

    @keyword_only
    def __init__(self, *, outputCol: str = "features"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "CampaignPreprocessorModel":
        row = prep_statistics(dataset).first()
        model = CampaignPreprocessorModel()
        number = lambda v: 0.0 if v is None else float(v)
        model._set(
            outputCol=self.getOutputCol(),
            medians=[number(row[f"{c}_median"]) for c in NUMERIC_FEATURES],
            means=[number(row[f"{c}_mean"]) for c in NUMERIC_FEATURES],
            deviations=[number(row[f"{c}_std"]) for c in NUMERIC_FEATURES],
            mostFrequent=row["age_group_mode"] or AGE_GROUPS[0],
        )
        return model


class CampaignPreprocessorModel(Model, _PrepParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fitted statistics as parameters, so the stage saves and loads like any other."""

    medians = Param(Params._dummy(), "medians", "imputation values", TypeConverters.toListFloat)
    means = Param(Params._dummy(), "means", "means after imputation", TypeConverters.toListFloat)
    deviations = Param(Params._dummy(), "deviations", "population deviations", TypeConverters.toListFloat)
    mostFrequent = Param(Params._dummy(), "mostFrequent", "most frequent age group", TypeConverters.toString)

    feature_names = TRANSFORMED_FEATURES

    def _transform(self, dataset: DataFrame) -> DataFrame:
        cells = [
            _scaled(c, F.lit(med), F.lit(mean), F.lit(std))
            for c, med, mean, std in zip(
                NUMERIC_FEATURES,
                self.getOrDefault(self.medians),
                self.getOrDefault(self.means),
                self.getOrDefault(self.deviations),
            )
        ]
        group = F.coalesce(F.col("age_group"), F.lit(self.getOrDefault(self.mostFrequent)))
        cells += [(group == F.lit(name)).cast("double") for name in AGE_GROUPS[1:]]
        return dataset.withColumn(self.getOutputCol(), array_to_vector(F.array(*cells)))
