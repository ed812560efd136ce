"""Decision thresholds: confusion counts, ratios, sweeps, optimal thresholds, campaign economics.

Every operator first reduces the scored rows to counts per threshold bucket or per distinct
score, so no model's rows meet in one task and no row is joined with a threshold table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from campaignlens.functions.numeric import count_where, ratio
from campaignlens.settings import COST_PER_CONTACT, PROFIT_PER_RESPONDER, linear_grid

DEFAULT_THRESHOLD = 0.50

SALTS = 16


def confusion_columns(threshold: Column) -> list[Column]:
    """``tn, fp, fn, tp`` over scored rows."""
    hit, positive = F.col("p") >= threshold, F.col("y") == 1
    return [
        count_where(~hit & ~positive).alias("tn"),
        count_where(hit & ~positive).alias("fp"),
        count_where(~hit & positive).alias("fn"),
        count_where(hit & positive).alias("tp"),
    ]


def confusion(scored: DataFrame, threshold: float | Mapping[str, float] = DEFAULT_THRESHOLD, keys: Sequence[str] = ("model",)) -> DataFrame:
    """Confusion counts at one threshold, or at each model's own threshold from a mapping."""
    if isinstance(threshold, Mapping):
        t = F.lit(DEFAULT_THRESHOLD)
        for name, value in threshold.items():
            t = F.when(F.col("model") == name, F.lit(float(value))).otherwise(t)
        grouped = scored.groupBy(*keys, t.alias("threshold"))
        return grouped.agg(*confusion_columns(t))
    t = F.lit(float(threshold))
    return scored.groupBy(*keys).agg(*confusion_columns(t)).withColumn("threshold", t)


def with_ratios(counts: DataFrame) -> DataFrame:
    """Accuracy, precision, recall, F1 and false-positive rate; an empty denominator gives zero."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return counts.withColumns(
        {
            "accuracy": ratio(tp + tn, tp + tn + fp + fn),
            "precision": ratio(tp, tp + fp),
            "recall": ratio(tp, tp + fn),
            "f1": ratio(2 * tp, 2 * tp + fp + fn),
            "fpr": ratio(fp, fp + tn),
        }
    )


def confusion_at(
    scored: DataFrame, thresholds: DataFrame, keys: Sequence[str] = ("model",), carry: Sequence[str] = ()
) -> DataFrame:
    """Confusion counts for every row of a threshold table ``(keys, threshold, carry…)``.

    Scored rows are reduced to distinct scores before the join, and the scores of a key are spread over
    salts, so one key's scores never meet in one task.
    """
    groups = scored.groupBy(*keys, "p").agg(
        count_where(F.col("y") == 1).alias("pos"), count_where(F.coalesce(F.col("y") != 1, F.lit(True))).alias("neg")
    )
    groups = groups.withColumn("_salt", F.pmod(F.xxhash64("p"), F.lit(SALTS)).cast("int"))
    salted = thresholds.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    hit = F.col("p") >= F.col("threshold")
    zero = F.lit(0).cast("bigint")
    return (
        groups.join(salted, [*keys, "_salt"])
        .groupBy(*keys, "threshold", *carry)
        .agg(
            F.sum(F.when(~hit, F.col("neg")).otherwise(zero)).alias("tn"),
            F.sum(F.when(hit, F.col("neg")).otherwise(zero)).alias("fp"),
            F.sum(F.when(~hit, F.col("pos")).otherwise(zero)).alias("fn"),
            F.sum(F.when(hit, F.col("pos")).otherwise(zero)).alias("tp"),
        )
    )


def grid_bucket(p: Column, grid: Sequence[float]) -> Column:
    """Number of grid values that are at most ``p``, for an evenly spaced grid.

    The position is guessed by arithmetic and corrected by comparing with the real grid values,
    so a score that equals a threshold always counts as reached.
    """
    step = (grid[-1] - grid[0]) / max(len(grid) - 1, 1) or 1.0
    values = F.array(*[F.lit(float(t)) for t in grid])
    guess = F.floor((p - F.lit(float(grid[0]))) / F.lit(step))
    guess = F.greatest(F.least(guess, F.lit(len(grid) - 1)), F.lit(-1)).cast("int")
    above, here = F.get(values, guess + 1), F.get(values, guess)
    shift = F.when(above <= p, 1).when(here > p, -1).otherwise(0)
    return guess + 1 + shift


def threshold_sweep(
    scored: DataFrame,
    keys: Sequence[str] = ("model",),
    grid: Sequence[float] | None = None,
    cost: float = COST_PER_CONTACT,
    profit: float = PROFIT_PER_RESPONDER,
) -> DataFrame:
    """Counts, ratios and net profit at every grid threshold, from one pass over the scores."""
    grid = list(grid or linear_grid())
    buckets = (
        scored.groupBy(*keys, grid_bucket(F.col("p"), grid).alias("bucket"))
        .agg(count_where(F.col("y") == 1).alias("pos"), F.count(F.lit(1)).alias("rows"))
        .withColumn("neg", F.col("rows") - F.col("pos"))
    )
    # At most len(grid) + 1 rows per key; each is spread over the thresholds it is counted at.
    spread = buckets.withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(len(grid) - 1))))
    hit = F.col("step") < F.col("bucket")
    zero = F.lit(0).cast("bigint")
    counts = spread.groupBy(*keys, "step").agg(
        F.sum(F.when(~hit, F.col("neg")).otherwise(zero)).alias("tn"),
        F.sum(F.when(hit, F.col("neg")).otherwise(zero)).alias("fp"),
        F.sum(F.when(~hit, F.col("pos")).otherwise(zero)).alias("fn"),
        F.sum(F.when(hit, F.col("pos")).otherwise(zero)).alias("tp"),
    )
    values = F.array(*[F.lit(float(t)) for t in grid])
    net = F.col("tp") * F.lit(float(profit)) - (F.col("tp") + F.col("fp")) * F.lit(float(cost))
    return with_ratios(counts.withColumn("threshold", F.get(values, F.col("step"))).withColumn("net_profit", net))


def sweep_long(sweep: DataFrame, keys: Sequence[str] = ("model",)) -> DataFrame:
    """The trade-off curves as ``(keys, threshold, metric, value)``."""
    metrics = ["precision", "recall", "f1", "fpr", "net_profit"]
    return sweep.select(*keys, "threshold", *metrics).unpivot([*keys, "threshold"], metrics, "metric", "value")


def best_thresholds(sweep: DataFrame, keys: Sequence[str] = ("model",)) -> DataFrame:
    """F1-optimal and profit-optimal thresholds; the lowest threshold wins a tie."""
    t = F.col("threshold")
    return sweep.groupBy(*keys).agg(
        F.min_by(t, F.struct(-F.col("f1"), t)).alias("f1_threshold"),
        F.max("f1").alias("best_f1"),
        F.min_by(t, F.struct(-F.col("net_profit"), t)).alias("profit_threshold"),
        F.max("net_profit").alias("best_net_profit"),
    )


def best_thresholds_ranked(sweep: DataFrame, keys: Sequence[str] = ("model",)) -> DataFrame:
    """The same optimum per metric in long form, by ranking the (small) sweep table."""
    long = sweep_long(sweep, keys).where(F.col("metric").isin("f1", "net_profit"))
    order = Window.partitionBy(*keys, "metric").orderBy(F.col("value").desc(), F.col("threshold"))
    return long.withColumn("rank", F.row_number().over(order)).where("rank = 1").drop("rank")


def strategies(best: DataFrame, keys: Sequence[str] = ("model",)) -> DataFrame:
    """Four outreach policies per key as ``(keys, position, strategy, threshold)``."""
    def named(text: str, t: Column) -> Column:
        return F.format_string(f"{text} (Threshold %.2f)", t)

    options = F.array(
        *[
            F.struct(F.lit(i).alias("position"), name.alias("strategy"), t.alias("threshold"))
            for i, (name, t) in enumerate(
                [
                    (F.lit("Strategy 1: Contact Everyone"), F.lit(0.0)),
                    (F.lit("Strategy 2: Default ML (Threshold 0.50)"), F.lit(DEFAULT_THRESHOLD)),
                    (named("Strategy 3: F1-Optimal", F.col("f1_threshold")), F.col("f1_threshold")),
                    (named("Strategy 4: Profit-Optimal", F.col("profit_threshold")), F.col("profit_threshold")),
                ],
                start=1,
            )
        ]
    )
    return best.select(*keys, F.explode(options).alias("option")).select(*keys, "option.*")


def economics(
    counts: DataFrame,
    cost: float = COST_PER_CONTACT,
    profit: float = PROFIT_PER_RESPONDER,
    customers: int | None = None,
) -> DataFrame:
    """Contacts, cost, responders, waste, revenue, net profit, return and saving from confusion counts.

    ``customers`` fixes the size of the full campaign used in the saving; by default it is the
    number of rows behind the counts.
    """
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    everyone = (tn + fp + fn + tp if customers is None else F.lit(customers)) * F.lit(float(cost))
    out = counts.withColumns(
        {
            "contacts": tp + fp,
            "total_cost": (tp + fp) * F.lit(float(cost)),
            "responders_reached": tp,
            "wasted_contacts": fp,
            "gross_revenue": tp * F.lit(float(profit)),
        }
    ).withColumn("net_profit", F.col("gross_revenue") - F.col("total_cost"))
    return out.withColumns(
        {
            "roi_pct": ratio(F.col("net_profit"), F.col("total_cost")) * 100,
            "cost_saved_pct": ratio(everyone - F.col("total_cost"), everyone) * 100,
        }
    )


def strategy_table(
    scored: DataFrame,
    best: DataFrame,
    keys: Sequence[str] = ("model",),
    cost: float = COST_PER_CONTACT,
    profit: float = PROFIT_PER_RESPONDER,
    round_thresholds: int | None = None,
    customers: int | None = None,
) -> DataFrame:
    """Economics of the four policies on scored rows, thresholds taken from ``best``."""
    policies = strategies(best, keys)
    if round_thresholds is not None:
        policies = policies.withColumn("threshold", F.bround("threshold", round_thresholds))
    counts = confusion_at(scored, policies, keys, ["position", "strategy"])
    return economics(counts, cost, profit, customers).select(
        *keys,
        "position",
        "strategy",
        "threshold",
        "contacts",
        "total_cost",
        "responders_reached",
        "wasted_contacts",
        "gross_revenue",
        "net_profit",
        "roi_pct",
        "cost_saved_pct",
    )


def normalized_confusion(counts: DataFrame, keys: Sequence[str] = ("model",)) -> DataFrame:
    """Four cells per key with their share of the actual class (zero for an empty class)."""
    cells = [
        ("Non-Responder", "Non-Responder", "tn", "fp"),
        ("Non-Responder", "Responder", "fp", "tn"),
        ("Responder", "Non-Responder", "fn", "tp"),
        ("Responder", "Responder", "tp", "fn"),
    ]
    options = F.array(
        *[
            F.struct(
                F.lit(actual).alias("actual"),
                F.lit(guess).alias("predicted"),
                F.col(own).alias("rows"),
                ratio(F.col(own), F.col(own) + F.col(other)).alias("share"),
            )
            for actual, guess, own, other in cells
        ]
    )
    return counts.select(*keys, "threshold", F.explode(options).alias("cell")).select(*keys, "threshold", "cell.*")
