"""Report tables: headline figures, formatted tables, key figures, the nested metrics document."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from campaignlens.functions import text
from campaignlens.functions.numeric import ratio
from campaignlens.settings import NUMERIC_FEATURES

SEGMENTS = ("Actual Non-Responder", "Actual Responder", "Predicted Non-Responder", "Predicted Responder")


def row_by_model(rows: DataFrame, model: str) -> DataFrame:
    return rows.where(F.col("model") == model)


def strategy_containing(strategies: DataFrame, word: str) -> DataFrame:
    """First policy per model whose name contains a word."""
    found = strategies.where(F.col("strategy").contains(word))
    return found.groupBy("model").agg(F.min_by(F.struct("*"), "position").alias("row")).select("row.*")


def segments_in_order(profiles: DataFrame, segments: Sequence[str] = SEGMENTS) -> DataFrame:
    """The wanted segments that exist, in the given order."""
    place = F.array_position(F.array(*[F.lit(s) for s in segments]), F.col("segment"))
    return profiles.withColumn("place", place).where(F.col("place") > 0).orderBy("place").drop("place")


def headline_figures(strategies: DataFrame) -> DataFrame:
    """Comparison of the profit-optimal policy with the others, ``(section, metric, model, value)``.

    A policy table has four rows per model; the policies are lined up in one aggregate.
    """
    def of(position: int, name: str) -> Column:
        return F.max(F.when(F.col("position") == position, F.col(name)))

    wide = strategies.groupBy("model").agg(
        *[
            of(i, name).alias(f"{name}_{i}")
            for i in (1, 2, 3, 4)
            for name in ("contacts", "responders_reached", "wasted_contacts", "total_cost", "net_profit", "roi_pct", "cost_saved_pct")
        ]
    )
    c = F.col
    figures = {
        ("profit", "net_profit_everyone"): c("net_profit_1"),
        ("profit", "net_profit_optimal"): c("net_profit_4"),
        ("profit", "gain_over_everyone"): c("net_profit_4") - c("net_profit_1"),
        ("profit", "gain_over_everyone_pct"): ratio(c("net_profit_4") - c("net_profit_1"), F.abs(c("net_profit_1"))) * 100,
        ("profit", "gain_over_default"): c("net_profit_4") - c("net_profit_2"),
        ("profit", "gain_over_f1"): c("net_profit_4") - c("net_profit_3"),
        ("contacts", "contacts_optimal"): c("contacts_4").cast("double"),
        ("contacts", "contacts_avoided"): (c("contacts_1") - c("contacts_4")).cast("double"),
        ("contacts", "wasted_avoided_pct"): ratio(c("wasted_contacts_1") - c("wasted_contacts_4"), c("wasted_contacts_1")) * 100,
        ("cost", "cost_saved"): c("total_cost_1") - c("total_cost_4"),
        ("cost", "cost_saved_pct"): c("cost_saved_pct_4"),
        ("reach", "responders_kept_pct"): ratio(c("responders_reached_4"), c("responders_reached_1")) * 100,
        ("return", "roi_optimal_pct"): c("roi_pct_4"),
    }
    cells = F.array(
        *[
            F.struct(F.lit(s).alias("section"), F.lit(m).alias("metric"), v.cast("double").alias("value"))
            for (s, m), v in figures.items()
        ]
    )
    return wide.select("model", F.explode(cells).alias("f")).select("f.section", "f.metric", "model", "f.value")


def formatted_card(card: DataFrame) -> DataFrame:
    """The model card as report text."""
    return card.select(
        "model",
        text.fixed(F.col("accuracy"), 3).alias("accuracy"),
        *[text.fixed(F.col(c), 4).alias(c) for c in ("precision", "recall", "f1", "roc_auc", "pr_auc", "fpr")],
        text.counts_text(*[F.col(c) for c in ("tn", "fp", "fn", "tp")]).alias("confusion"),
        text.fixed(F.col("tuned_threshold"), 2).alias("tuned_threshold"),
        text.fixed(F.col("tuned_f1"), 4).alias("tuned_f1"),
        text.fixed(F.col("fpr_at_recall"), 4).alias("fpr_at_recall"),
        text.percent(F.col("capture_rate")).alias("capture"),
        text.mean_with_deviation(F.col("cv_pr_auc_mean"), F.col("cv_pr_auc_std")).alias("cv_pr_auc"),
        text.mean_with_deviation(F.col("cv_roc_auc_mean"), F.col("cv_roc_auc_std")).alias("cv_roc_auc"),
    )


def formatted_strategies(strategies: DataFrame) -> DataFrame:
    return strategies.select(
        "model",
        "strategy",
        text.fixed(F.col("threshold"), 2).alias("threshold"),
        F.col("contacts").cast("string").alias("contacts"),
        text.money(F.col("total_cost")).alias("total_cost"),
        F.col("responders_reached").cast("string").alias("responders_reached"),
        F.col("wasted_contacts").cast("string").alias("wasted_contacts"),
        text.money(F.col("gross_revenue")).alias("gross_revenue"),
        text.money(F.col("net_profit")).alias("net_profit"),
        text.percent(F.col("roi_pct") / 100).alias("roi"),
        text.percent(F.col("cost_saved_pct") / 100).alias("cost_saved"),
    )


def formatted_imbalance(study: DataFrame) -> DataFrame:
    return study.select(
        "treatment",
        text.mean_with_deviation(F.col("cv_pr_auc_mean"), F.col("cv_pr_auc_std")).alias("cv_pr_auc"),
        text.mean_with_deviation(F.col("cv_roc_auc_mean"), F.col("cv_roc_auc_std")).alias("cv_roc_auc"),
        *[text.fixed(F.col(c), 4).alias(c) for c in ("test_pr_auc", "test_roc_auc", "test_f1")],
    )


def formatted_profiles(profiles: DataFrame, columns: Sequence[str] = NUMERIC_FEATURES) -> DataFrame:
    return segments_in_order(profiles).select(
        "segment",
        *[
            F.concat(text.fixed(F.col(f"{c}_mean"), 2), F.lit(" (med "), text.fixed(F.col(f"{c}_median"), 1), F.lit(")")).alias(c)
            for c in columns
        ],
    )


def key_figures(card: DataFrame, strategies: DataFrame, best: DataFrame, model: str) -> DataFrame:
    """``(label, value)`` texts that every published document must contain."""
    def one(rows: DataFrame, cells: dict[str, Column]) -> DataFrame:
        pairs = F.array(*[F.struct(F.lit(n).alias("label"), v.alias("value")) for n, v in cells.items()])
        return row_by_model(rows, model).select(F.explode(pairs).alias("c")).select("c.*")

    c = F.col
    policy = lambda i: strategies.where(c("position") == i)
    return (
        one(card, {
            "Model": c("model"),
            "CV PR-AUC": text.fixed(c("cv_pr_auc_mean"), 4),
            "CV ROC-AUC": text.fixed(c("cv_roc_auc_mean"), 4),
            "FPR at recall": text.fixed(c("fpr_at_recall"), 4),
        })
        .unionByName(one(best, {
            "F1 threshold": text.fixed(c("f1_threshold"), 2),
            "Profit threshold": text.fixed(c("profit_threshold"), 2),
        }))
        .unionByName(one(policy(4), {
            "Optimal net profit": text.money(c("net_profit")),
            "Optimal contacts": c("contacts").cast("string"),
            "Optimal responders": c("responders_reached").cast("string"),
            "Optimal cost": text.money(c("total_cost")),
            "Optimal cost saved": text.percent(c("cost_saved_pct") / 100),
        }))
        .unionByName(one(policy(1), {"Everyone net profit": text.money(c("net_profit"))}))
    )


def metrics_document(
    selected: DataFrame,
    best: DataFrame,
    leaderboard: DataFrame,
    strategies: DataFrame,
    intervals: DataFrame,
    odds: DataFrame | None,
    brier_scores: dict[str, object],
    cost: float,
    profit: float,
    parameters: dict[str, object],
    card: DataFrame | None = None,
    deployed_name: str | None = None,
    per_model: dict[str, dict[str, object]] | None = None,
) -> DataFrame:
    """All published results as one nested row: structs, arrays of records and maps by name.

    ``card`` adds the selected model's test figures, ``per_model`` every model's best parameters. Without
    logistic regression the odds ratios are missing.
    """
    def as_map(rows: DataFrame, key: str, value: Column) -> Column:
        entries = F.sort_array(F.collect_list(F.struct(F.col(key), value.alias("v"))))
        return rows.agg(F.map_from_entries(entries)).scalar()

    board = [c for c in leaderboard.columns if c != "model"]
    records = F.sort_array(
        F.collect_list(F.struct("position", *[c for c in strategies.columns if c != "position"]))
    )
    # Every part is a single value, fetched as a scalar subquery.
    document = selected.select(
        "selected",
        "justification",
        best.select("f1_threshold").scalar().alias("f1_optimal_threshold"),
        best.select("profit_threshold").scalar().alias("profit_optimal_threshold"),
        as_map(leaderboard, "model", F.struct(*board)).alias("cv_metrics"),
        strategies.agg(records).scalar().alias("business_simulation"),
        as_map(intervals, "metric", F.struct("ci_lower", "ci_upper", "std")).alias("bootstrap_confidence_intervals"),
        (
            F.lit(None).cast("map<string,double>") if odds is None else as_map(odds, "feature", F.col("odds_ratio"))
        ).alias("logistic_regression_odds_ratios"),
    )
    economics = F.struct(
        F.lit(cost).alias("cost_per_contact"), F.lit(profit).alias("profit_per_responder"), F.lit(cost / profit).alias("break_even_probability")
    )
    scores = F.struct(*[F.lit(v).alias(k) for k, v in brier_scores.items()])
    names = F.create_map(*[cell for k, v in parameters.items() for cell in (F.lit(f"classifier__{k}"), F.lit(str(v)))])
    if card is not None:
        figures = [c for c in card.columns if c != "model"]
        document = document.withColumn("test_metrics", F.element_at(as_map(card, "model", F.struct(*figures)), F.col("selected")))
    named = F.create_map(*[x for m, p in (per_model or {}).items() for x in (F.lit(m), F.lit(", ".join(f"{k}={v}" for k, v in p.items())))])
    document = document.withColumns({
        "deployed_name": F.coalesce(F.lit(deployed_name), F.col("selected")), "default_threshold": F.lit(0.5),
        "best_params_per_model": named.cast("map<string,string>"),
    })
    return document.withColumns(
        {"economic_parameters": economics, "brier_scores": scores, "best_params": text.strip_step_prefix(names)}
    )
