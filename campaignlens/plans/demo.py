"""Tables shared by the registered queries, derived by Spark from the warehouse tables.

raw customers -> features -> split and folds -> fitted preprocessing -> two models' scores
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from campaignlens.operators.features import engineer_features
from campaignlens.operators.naive_bayes import fit_gaussian_nb, score_gaussian_nb
from campaignlens.operators.prep import fold_statistics, transformed
from campaignlens.operators.sampling import stratified_folds, stratified_split
from campaignlens.operators.scorecard import SCORE_DIGITS, scorecard
from campaignlens.settings import TARGET
from campaignlens.sources.store import session_table
from campaignlens.sources.warehouse import WAREHOUSE_REFERENCE_DATE, WAREHOUSE_REFERENCE_YEAR, raw_customers

FOLDS = 5
FULL_FIT = -1
NAIVE_BAYES = "Naive Bayes"
SCORECARD = "Scorecard"


def build_features(spark: SparkSession, directory: str) -> DataFrame:
    return engineer_features(raw_customers(spark, directory), WAREHOUSE_REFERENCE_YEAR, WAREHOUSE_REFERENCE_DATE)


def features(spark: SparkSession, directory: str) -> DataFrame:
    """Feature table, built once per application."""
    return session_table(spark, f"features:{directory}", lambda: build_features(spark, directory))


def assign(rows: DataFrame, k: int = FOLDS) -> DataFrame:
    """Add ``split`` and, for training rows, ``fold`` (test rows carry the full-fit marker)."""
    split = stratified_split(rows)
    train = stratified_folds(split.where("split = 'train'"), k)
    test = split.where("split = 'test'").withColumn("fold", F.lit(FULL_FIT))
    return train.unionByName(test)


def assigned(spark: SparkSession, directory: str) -> DataFrame:
    return session_table(spark, f"assigned:{directory}", lambda: assign(features(spark, directory)))


def fit_rows(rows: DataFrame, k: int = FOLDS) -> DataFrame:
    """Training rows repeated once per fit: every fold's fit leaves that fold out, one fit uses all.

    A narrow explode, so all fits of a model run as one keyed job.
    """
    fits = F.filter(F.array(*[F.lit(f) for f in [FULL_FIT, *range(k)]]), lambda f: f != F.col("fold"))
    return rows.where("split = 'train'").withColumn("fit", F.explode(fits))


def statistics(spark: SparkSession, directory: str) -> DataFrame:
    """Preprocessing statistics per fit: ``FOLDS + 1`` rows."""
    return session_table(
        spark,
        f"statistics:{directory}",
        lambda: fold_statistics(assigned(spark, directory).where("split = 'train'"), [FULL_FIT, *range(FOLDS)]),
    )


def fit_features(spark: SparkSession, directory: str) -> DataFrame:
    """Transformed training rows of every fit."""
    return transformed(
        fit_rows(assigned(spark, directory)), statistics(spark, directory), ["fit"], ["split", "fold", TARGET]
    )


def held_out_features(spark: SparkSession, directory: str) -> DataFrame:
    """Every row once, transformed by the fit that has not seen it."""
    rows = assigned(spark, directory).withColumn("fit", F.col("fold"))
    return transformed(rows, statistics(spark, directory), ["fit"], ["split", "fold", TARGET])


def nb_parameters(spark: SparkSession, directory: str) -> DataFrame:
    return session_table(
        spark, f"nb:{directory}", lambda: fit_gaussian_nb(fit_features(spark, directory), ["fit"])
    )


def nb_scores(spark: SparkSession, directory: str) -> DataFrame:
    """``(id, y, split, fold, p)`` by the fit that has not seen the row, four decimals."""
    scored = score_gaussian_nb(held_out_features(spark, directory), nb_parameters(spark, directory), ["fit"])
    return scored.select("id", F.col(TARGET).alias("y"), "split", "fold", F.bround("p", SCORE_DIGITS).alias("p"))


def scorecard_scores(spark: SparkSession, directory: str) -> DataFrame:
    return assigned(spark, directory).select("id", F.col(TARGET).alias("y"), "split", "fold", scorecard().alias("p"))


def build_scored(spark: SparkSession, directory: str) -> DataFrame:
    nb = nb_scores(spark, directory).select(F.lit(NAIVE_BAYES).alias("model"), "*")
    card = scorecard_scores(spark, directory).select(F.lit(SCORECARD).alias("model"), "*")
    return nb.unionByName(card)


def scored(spark: SparkSession, directory: str) -> DataFrame:
    """Long scored table ``(model, id, y, split, fold, p)``; training rows carry out-of-fold scores."""
    return session_table(
        spark, f"scored:{directory}", lambda: build_scored(spark, directory), partition_by=["split"]
    ).select("model", "id", "y", "split", "fold", "p")


def test_scores(spark: SparkSession, directory: str) -> DataFrame:
    return scored(spark, directory).where("split = 'test'").select("model", "id", "y", "p")


def oof_scores(spark: SparkSession, directory: str) -> DataFrame:
    return scored(spark, directory).where("split = 'train'").select("model", "fold", "id", "y", "p")
