"""ROC and precision-recall curves and the ranking metrics read from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from campaignlens.functions.numeric import exact_sum, ratio
from campaignlens.operators.ranking import SMALL_DOMAIN_DIGITS, positions_by_score, running_sums, score_groups, unit_levels

TARGET_RECALL = 0.70


def _small(digits: int | None) -> bool:
    return digits is not None and digits <= SMALL_DOMAIN_DIGITS


def _with_next(groups: DataFrame, keys: Sequence[str], digits: int | None) -> DataFrame:
    """Add the counts of the next lower score and the place of the row in its curve."""
    keys = list(keys)
    if _small(digits):
        order = Window.partitionBy(*keys).orderBy(F.col("p").desc())
        return groups.withColumns(
            {
                "place": F.row_number().over(order),
                "next_pos": F.lead("pos").over(order),
                "next_neg": F.lead("neg").over(order),
            }
        )
    columns, levels = unit_levels(F.col("p"), "_p", descending=True)
    numbered = running_sums(
        groups.withColumns(columns).withColumn("_one", F.lit(1).cast("bigint")),
        keys,
        levels,
        [F.col("p").desc()],
        {"n": "_one"},
    ).withColumnRenamed("run_n", "place").drop("_one", "all_n", *columns)
    following = numbered.select(
        *keys, (F.col("place") - 1).alias("place"), F.col("pos").alias("next_pos"), F.col("neg").alias("next_neg")
    )
    return numbered.join(following, [*keys, "place"], "left")


def _kept(reduced: bool) -> Column:
    """Curve points that remain: all, or all but inner points on a straight stretch."""
    if not reduced:
        return F.lit(True)
    straight = (F.col("pos") == F.col("next_pos")) & (F.col("neg") == F.col("next_neg"))
    return (F.col("place") == 1) | F.col("next_pos").isNull() | ~straight


def roc_points(
    scored: DataFrame, keys: Sequence[str] = ("model",), digits: int | None = None, reduced: bool = True
) -> DataFrame:
    """``(keys, threshold, fpr, tpr)`` from the origin on; the origin's threshold is infinite."""
    groups = _with_next(score_groups(scored, keys, digits), keys, digits)
    points = groups.where(_kept(reduced)).select(
        *keys,
        F.col("p").alias("threshold"),
        ratio(F.col("run_neg"), F.col("all_neg")).alias("fpr"),
        ratio(F.col("run_pos"), F.col("all_pos")).alias("tpr"),
    )
    origin = (
        scored.select(*keys)
        .distinct()
        .select(*keys, F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    )
    return points.unionByName(origin)


def pr_points(scored: DataFrame, keys: Sequence[str] = ("model",), digits: int | None = None) -> DataFrame:
    """``(keys, threshold, precision, recall)`` per distinct score, plus the end point (1, 0)."""
    groups = score_groups(scored, keys, digits)
    points = groups.select(
        *keys,
        F.col("p").alias("threshold"),
        ratio(F.col("run_pos"), F.col("run_pos") + F.col("run_neg")).alias("precision"),
        ratio(F.col("run_pos"), F.col("all_pos"), default=1.0).alias("recall"),
    )
    end = (
        scored.select(*keys)
        .distinct()
        .select(*keys, F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    )
    return points.unionByName(end)


def auc_column() -> Column:
    """Share of correctly ordered pairs, ties counting half; one class only gives 0.5."""
    positives, negatives = F.max("all_pos"), F.max("all_neg")
    below = F.col("all_neg") - F.col("run_neg")
    pairs = F.sum(F.col("pos") * (below + F.col("neg") / 2.0))
    return F.when((positives > 0) & (negatives > 0), pairs / (positives.cast("double") * negatives)).otherwise(F.lit(0.5))


def average_precision_column() -> Column:
    """Step-wise average precision; without positives it is the prevalence, zero. Independent of the order of additions."""
    steps = exact_sum(
        ratio(F.col("pos"), F.col("all_pos")) * ratio(F.col("run_pos"), F.col("run_pos") + F.col("run_neg"))
    )
    return F.when(F.max("all_pos") > 0, steps).otherwise(F.lit(0.0))


def ranking_metrics(scored: DataFrame, keys: Sequence[str] = ("model",), digits: int | None = None) -> DataFrame:
    """ROC AUC and average precision of every key in one job."""
    return (
        score_groups(scored, keys, digits)
        .groupBy(*keys)
        .agg(auc_column().alias("roc_auc"), average_precision_column().alias("pr_auc"))
    )


def fpr_at_recall(
    scored: DataFrame,
    keys: Sequence[str] = ("model",),
    target_recall: float = TARGET_RECALL,
    digits: int | None = None,
    reduced: bool = True,
) -> DataFrame:
    """False-positive rate at the first curve point that reaches the recall; none gives 1."""
    groups = _with_next(score_groups(scored, keys, digits), keys, digits)
    reached = _kept(reduced) & (ratio(F.col("run_pos"), F.col("all_pos")) >= F.lit(float(target_recall)))
    rate = F.min(F.when(reached, ratio(F.col("run_neg"), F.col("all_neg"))))
    return groups.groupBy(*keys).agg(F.coalesce(rate, F.lit(1.0)).alias("fpr_at_recall"))


def top_share_size(n: Column, percent: float) -> Column:
    return F.greatest(F.lit(1), F.least(F.floor(n * F.lit(percent / 100.0)), n)).cast("bigint")


def top_capture(
    scored: DataFrame, percent: float = 20.0, keys: Sequence[str] = ("model",), digits: int | None = None
) -> DataFrame:
    """Responders among the best-scored ``percent`` of the rows, by exact rank.

    Only the bucket that contains the cut is sorted.
    """
    at = positions_by_score(scored, lambda n: [top_share_size(n, percent)], keys, digits)
    any_positive = F.col("all_pos") > 0
    return at.select(
        *keys,
        F.lit(float(percent)).alias("k_percent"),
        F.when(any_positive, F.col("run_n")).otherwise(F.lit(0)).cast("bigint").alias("n_targeted"),
        F.when(any_positive, F.col("run_pos")).otherwise(F.lit(0)).cast("bigint").alias("responders_captured"),
        F.col("all_pos").alias("total_responders"),
        ratio(F.col("run_pos"), F.col("all_pos")).alias("capture_rate"),
    )
