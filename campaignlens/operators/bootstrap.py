"""Bootstrap confidence intervals without materializing resamples."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from campaignlens.functions.hashing import keyed_hash, poisson_weight
from campaignlens.functions.numeric import ratio
from campaignlens.operators.curves import auc_column, average_precision_column
from campaignlens.operators.quantiles import exact_quantiles
from campaignlens.operators.ranking import score_groups
from campaignlens.settings import SEED

METRICS = ("roc_auc", "pr_auc", "f1")
REPLICATES_PER_GROUP = 50
ROWS_PER_CHUNK = 50_000
BOUNDS = {"ci_lower": 0.025, "ci_upper": 0.975}


def row_weights(scored: DataFrame, replicates: int, seed: int = SEED, tag: str = "boot") -> DataFrame:
    """Rows with a Poisson(1) weight per replicate; zero weights are dropped.

    Repeatable in any engine, meant for moderate ``rows * replicates``.
    """
    tall = scored.withColumn("replicate", F.explode(F.sequence(F.lit(0), F.lit(replicates - 1))))
    draw = poisson_weight(keyed_hash(F.col("id"), F.col("replicate"), tag=tag, seed=seed))
    return tall.withColumn("w", draw).where("w > 0")


def _sums_of_draws(
    w: np.ndarray, positive: np.ndarray, hit: np.ndarray, before: np.ndarray, totals: np.ndarray
) -> dict[str, np.ndarray]:
    """What a run of cells adds to the metrics of each replicate (a row of ``w``).

    Cells come in pairs per score, falling: first the positives, then the negatives. ``before`` and
    ``totals`` hold the replicate's positives and negatives above the run and overall.
    """
    pos, neg = w[:, positive], w[:, ~positive]
    run_pos = pos.cumsum(axis=1) + before[:, :1]
    run_neg = neg.cumsum(axis=1) + before[:, 1:]
    wins = (pos * (totals[:, 1:] - run_neg + neg / 2)).sum(axis=1)
    precision = run_pos / np.maximum(run_pos + run_neg, 1)
    return {
        "wins": wins, "precisions": (pos * precision).sum(axis=1), "tp": pos[:, hit].sum(axis=1), "fp": neg[:, hit].sum(axis=1),
    }


def _metrics_of_draws(w: np.ndarray, positive: np.ndarray, hit: np.ndarray) -> dict[str, np.ndarray]:
    """Metrics of weight rows over all cells of a key."""
    totals = np.stack([w[:, positive].sum(axis=1), w[:, ~positive].sum(axis=1)], axis=1)
    sums = _sums_of_draws(w, positive, hit, np.zeros_like(totals), totals)
    p_all, n_all = totals[:, 0].astype(float), totals[:, 1].astype(float)
    with np.errstate(divide="ignore", invalid="ignore"):
        auc, ap = sums["wins"] / (p_all * n_all), sums["precisions"] / p_all
    f1 = 2 * sums["tp"] / np.maximum(sums["tp"] + sums["fp"] + p_all, 1)
    return {"roc_auc": auc, "pr_auc": ap, "f1": f1, "usable": (p_all > 0) & (n_all > 0)}


def _draws(cells: pd.DataFrame, replicates: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Replicate numbers, weights of each and labels of the cells of one chunk; the same in every pass."""
    pos = cells["pos"].to_numpy()
    sizes = np.stack([pos, cells["neg"].to_numpy()], axis=1).reshape(-1)
    first = int(cells["range"].iloc[0]) * REPLICATES_PER_GROUP
    numbers = np.arange(first, min(first + REPLICATES_PER_GROUP, replicates))
    base = int(cells["chunk_hash"].iloc[0]) & 0xFFFFFFFFFFFFFFFF
    w = np.stack([np.random.Generator(np.random.Philox(key=[base, int(r)])).poisson(sizes) for r in numbers])
    return numbers, w, np.tile([True, False], len(cells))


def grouped_replicates(
    scored: DataFrame,
    threshold: float,
    replicates: int,
    keys: Sequence[str],
    digits: int | None = None,
    seed: int = SEED,
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Metrics per replicate from resampled counts per distinct score and label.

    The sum of Poisson(1) weights over n equal rows is Poisson(n), so a resample of any number of
    rows needs one draw per distinct (score, label) cell. The order of scores is cut into chunks of at most
    ``rows_per_chunk`` rows, unless one score alone has more; each chunk and range of replicates is a task group. A first
    pass adds up every chunk's draws, which tells each chunk what lies above it; the second pass draws
    the same numbers again and adds up the metrics. Scores are exact unless ``digits`` rounds them.
    """
    keys = list(keys)
    cells = score_groups(scored.where(F.col("p").isNotNull()), keys, digits)
    chunk = F.floor((F.col("run_pos") + F.col("run_neg") - 1) / rows_per_chunk).cast("bigint")
    ranges = F.sequence(F.lit(0), F.lit((replicates - 1) // REPLICATES_PER_GROUP))
    spread = cells.select(*keys, "p", "pos", "neg", chunk.alias("chunk"), F.explode(ranges).alias("range"))
    spread = spread.withColumn("chunk_hash", F.xxhash64(F.lit(seed), F.col("chunk"), *keys))
    kinds = dict(scored.dtypes)
    key_fields = "".join(f"`{k}` {kinds[k]}, " for k in keys)
    group = [*keys, "range", "chunk"]

    def labelled(out: pd.DataFrame, cells: pd.DataFrame) -> pd.DataFrame:
        for k in keys:
            out[k] = cells[k].iloc[0]
        return out

    def add_up(cells: pd.DataFrame) -> pd.DataFrame:
        cells = cells.sort_values("p", ascending=False)
        numbers, w, positive = _draws(cells, replicates)
        out = pd.DataFrame({"replicate": numbers.astype("int32"), "pos": w[:, positive].sum(axis=1), "neg": w[:, ~positive].sum(axis=1)})
        out["range"], out["chunk"] = cells["range"].iloc[0], cells["chunk"].iloc[0]
        return labelled(out, cells)[[*keys, "range", "chunk", "replicate", "pos", "neg"]]

    def measure(cells: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        cells = cells.sort_values("p", ascending=False)
        numbers, w, positive = _draws(cells, replicates)
        above = above.sort_values("replicate")
        sums = _sums_of_draws(
            w, positive, cells["p"].to_numpy() >= threshold,
            above[["pos_before", "neg_before"]].to_numpy(), above[["pos_all", "neg_all"]].to_numpy(),
        )
        out = pd.DataFrame({"replicate": numbers.astype("int32"), "pos_all": above["pos_all"].to_numpy(), "neg_all": above["neg_all"].to_numpy(), **sums})
        return labelled(out, cells)[[*keys, "replicate", "pos_all", "neg_all", *sums]]

    added = spread.groupBy(*group).applyInPandas(
        add_up, key_fields + "`range` int, chunk bigint, replicate int, pos bigint, neg bigint"
    )
    whole = Window.partitionBy(*keys, "replicate")
    before = whole.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    above = added.select(
        *group, "replicate",
        *[F.coalesce(F.sum(c).over(before), zero).alias(f"{c}_before") for c in ("pos", "neg")],
        *[F.sum(c).over(whole).alias(f"{c}_all") for c in ("pos", "neg")],
    )
    measured = spread.groupBy(*group).cogroup(above.groupBy(*group)).applyInPandas(
        measure, key_fields + "replicate int, pos_all bigint, neg_all bigint, wins double, precisions double, tp bigint, fp bigint"
    )
    total = measured.groupBy(*keys, "replicate", "pos_all", "neg_all").agg(
        *[F.sum(c).alias(c) for c in ("wins", "precisions", "tp", "fp")]
    )
    return total.where("pos_all > 0 and neg_all > 0").select(
        *keys, "replicate",
        (F.col("wins") / (F.col("pos_all").cast("double") * F.col("neg_all"))).alias("roc_auc"),
        (F.col("precisions") / F.col("pos_all")).alias("pr_auc"),
        ratio(2 * F.col("tp"), F.col("tp") + F.col("fp") + F.col("pos_all")).alias("f1"),
    )


def replicate_metrics(
    weighted: DataFrame, threshold: float, keys: Sequence[str] = ("model",), digits: int | None = None
) -> DataFrame:
    """ROC AUC, average precision and F1 per replicate; one-class replicates are skipped."""
    by = [*keys, "replicate"]
    t = F.lit(float(threshold))
    groups = score_groups(weighted, by, digits, weight=F.col("w"))
    hit = F.col("p") >= t
    zero = F.lit(0).cast("bigint")
    tp = F.sum(F.when(hit, F.col("pos")).otherwise(zero))
    fp = F.sum(F.when(hit, F.col("neg")).otherwise(zero))
    positives, negatives = F.max("all_pos"), F.max("all_neg")
    return (
        groups.groupBy(*by)
        .agg(
            auc_column().alias("roc_auc"),
            average_precision_column().alias("pr_auc"),
            ratio(2 * tp, tp + fp + positives).alias("f1"),
            positives.alias("positives"),
            negatives.alias("negatives"),
        )
        .where("positives > 0 and negatives > 0")
        .drop("positives", "negatives")
    )


def interval_table(metrics: DataFrame, keys: Sequence[str] = ("model",)) -> DataFrame:
    """``(keys, metric, ci_lower, ci_upper, std, replicates)`` with population deviation."""
    long = metrics.unpivot([*keys, "replicate"], list(METRICS), "metric", "value")
    spread = long.groupBy(*keys, "metric").agg(
        F.stddev_pop("value").alias("std"), F.count(F.lit(1)).alias("replicates")
    )
    bounds = exact_quantiles(metrics, METRICS, BOUNDS, list(keys)).withColumnRenamed("column", "metric")
    return bounds.join(spread, [*keys, "metric"])


def bootstrap_ci(
    scored: DataFrame,
    threshold: float,
    replicates: int = 1000,
    keys: Sequence[str] = ("model",),
    digits: int | None = None,
    method: str = "grouped",
    seed: int = SEED,
) -> DataFrame:
    """95% intervals of ROC AUC, average precision and F1.

    ``method="grouped"`` costs replicates times distinct scores, however many rows share one;
    ``method="rows"`` weights every row by a portable keyed hash.
    """
    if method == "rows":
        metrics = replicate_metrics(row_weights(scored, replicates, seed), threshold, keys, digits)
    elif method == "grouped":
        metrics = grouped_replicates(scored, threshold, replicates, keys, digits, seed)
    else:
        raise ValueError(f"unknown bootstrap method {method!r}")
    return interval_table(metrics, keys)
