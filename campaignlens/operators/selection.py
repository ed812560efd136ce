"""Fold metrics, development leaderboard, model selection and the test card."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from campaignlens.functions.numeric import exact_sum
from campaignlens.operators.curves import fpr_at_recall, ranking_metrics, top_capture
from campaignlens.operators.thresholds import (
    DEFAULT_THRESHOLD,
    best_thresholds,
    confusion,
    confusion_at,
    threshold_sweep,
    with_ratios,
)

TREE_MODELS = ("Random Forest", "Gradient Boosting", "Decision Tree")


def fold_metrics(oof: DataFrame, keys: Sequence[str] = ("model",), digits: int | None = None) -> DataFrame:
    """AUC and average precision per fold, from the stored out-of-fold scores: no refit."""
    return ranking_metrics(oof, [*keys, "fold"], digits)


def fold_summary(folds: DataFrame, keys: Sequence[str] = ("model",)) -> DataFrame:
    """Mean and population deviation of the fold scores; means don't depend on the order of additions, so equal settings tie."""
    mean = lambda c: exact_sum(F.col(c)) / F.count(c)
    return folds.groupBy(*keys).agg(
        mean("pr_auc").alias("cv_pr_auc_mean"),
        F.stddev_pop("pr_auc").alias("cv_pr_auc_std"),
        mean("roc_auc").alias("cv_roc_auc_mean"),
        F.stddev_pop("roc_auc").alias("cv_roc_auc_std"),
    )


def dev_leaderboard(oof: DataFrame, digits: int | None = None) -> DataFrame:
    """One row per model from training scores only: fold means, pooled metrics, own threshold."""
    summary = fold_summary(fold_metrics(oof, digits=digits))
    pooled = ranking_metrics(oof, digits=digits).withColumnsRenamed({"roc_auc": "oof_roc_auc", "pr_auc": "oof_pr_auc"})
    fixed = fpr_at_recall(oof, digits=digits).withColumnRenamed("fpr_at_recall", "oof_fpr_at_recall")
    best = best_thresholds(threshold_sweep(oof)).select(
        "model", F.col("f1_threshold").alias("oof_threshold"), F.col("best_f1").alias("oof_f1")
    )
    return summary.join(pooled, "model").join(fixed, "model").join(best, "model")


def select_model(leaderboard: DataFrame) -> DataFrame:
    """The selected model and the reason, as one row.

    Order by mean fold average precision. If the lead over the second is smaller than the
    leader's fold deviation, the lower pooled false-positive rate at fixed recall decides, and
    an equal rate keeps the leader.
    """
    # A leaderboard has one row per model; its order is a report-sized window.
    order = Window.orderBy(F.col("cv_pr_auc_mean").desc(), F.col("model"))
    ranked = leaderboard.withColumn("place", F.row_number().over(order)).where("place <= 2")
    pick = lambda place, name: F.max(F.when(F.col("place") == place, F.col(name)))
    top = ranked.agg(
        *[
            pick(place, name).alias(f"{name}_{place}")
            for place in (1, 2)
            for name in ("model", "cv_pr_auc_mean", "cv_pr_auc_std", "oof_fpr_at_recall")
        ]
    )
    lead = F.col("cv_pr_auc_mean_1") - F.col("cv_pr_auc_mean_2")
    close = F.coalesce(lead < F.col("cv_pr_auc_std_1"), F.lit(False))
    keep = F.col("oof_fpr_at_recall_1") <= F.col("oof_fpr_at_recall_2")
    winner = F.when(close & ~keep, F.col("model_2")).otherwise(F.col("model_1"))
    return top.select(
        winner.alias("selected"),
        F.col("model_1").alias("leader"),
        F.col("model_2").alias("runner_up"),
        lead.alias("lead"),
        F.col("cv_pr_auc_std_1").alias("leader_std"),
        close.alias("tie_break"),
        _justification(close, winner, lead).alias("justification"),
    )


def _justification(close: Column, winner: Column, lead: Column) -> Column:
    other = F.when(winner == F.col("model_1"), F.col("model_2")).otherwise(F.col("model_1"))
    own_rate = F.when(winner == F.col("model_1"), F.col("oof_fpr_at_recall_1")).otherwise(F.col("oof_fpr_at_recall_2"))
    other_rate = F.when(winner == F.col("model_1"), F.col("oof_fpr_at_recall_2")).otherwise(F.col("oof_fpr_at_recall_1"))
    kind = (
        F.when(winner == "Logistic Regression", F.lit("It gives direct odds ratios."))
        .when(winner.isin(*TREE_MODELS), F.lit("It captures interactions and gives feature importances."))
        .otherwise(F.lit("It separates the classes without an explicit linear form."))
    )
    tie = F.format_string(
        "The lead of %.4f over %s is below the fold deviation %.4f; %s has a false-positive rate of %.4f against %.4f at fixed recall. %s",
        lead, other, F.col("cv_pr_auc_std_1"), winner, own_rate, other_rate, kind,
    )
    clear = F.format_string(
        "%s leads with a mean fold average precision of %.4f, ahead of %s by %.4f. %s",
        winner, F.col("cv_pr_auc_mean_1"), other, lead, kind,
    )
    return F.when(close, tie).otherwise(clear)


def model_card(
    test: DataFrame, leaderboard: DataFrame, digits: int | None = None, percent: float = 20.0,
    parameters: Mapping[str, Mapping[str, object]] | None = None,
) -> DataFrame:
    """Test metrics of every model next to its development figures, best development score first.

    ``parameters`` adds every model's chosen settings as text in ``best_params``.
    """
    at_default = with_ratios(confusion(test, DEFAULT_THRESHOLD)).drop("threshold")
    own = leaderboard.select("model", F.col("oof_threshold").alias("threshold"))
    tuned = with_ratios(confusion_at(test, own)).select(
        "model",
        F.col("threshold").alias("tuned_threshold"),
        F.col("precision").alias("tuned_precision"),
        F.col("recall").alias("tuned_recall"),
        F.col("f1").alias("tuned_f1"),
    )
    capture = top_capture(test, percent, digits=digits).select(
        "model", "capture_rate", "responders_captured", "total_responders"
    )
    card = (
        at_default.join(ranking_metrics(test, digits=digits), "model")
        .join(fpr_at_recall(test, digits=digits), "model")
        .join(capture, "model")
        .join(tuned, "model")
        .join(
            leaderboard.select(
                "model", "cv_pr_auc_mean", "cv_pr_auc_std", "cv_roc_auc_mean", "cv_roc_auc_std", "oof_fpr_at_recall"
            ),
            "model",
        )
    )
    if parameters is not None:
        chosen = F.lit(None).cast("string")
        for model, settings in parameters.items():
            chosen = F.when(F.col("model") == model, F.lit(", ".join(f"{k}={v}" for k, v in settings.items()))).otherwise(chosen)
        card = card.withColumn("best_params", chosen)
    return card.orderBy(F.col("cv_pr_auc_mean").desc(), F.col("cv_roc_auc_mean").desc(), "model")


def metrics_long(card: DataFrame, metrics: Sequence[str] = ("accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc")) -> DataFrame:
    """``(model, metric, score)``."""
    return card.select("model", *metrics).unpivot(["model"], list(metrics), "metric", "score")
