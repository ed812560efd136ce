"""The complete analysis: explore, split, tune, select, study, calibrate, test once, explain, store."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from campaignlens.operators import calibration, explain, reporting, selection, thresholds
from campaignlens.operators.bootstrap import bootstrap_ci
from campaignlens.operators.classifiers import GRIDS, Candidate
from campaignlens.operators.profiles import customer_profiles
from campaignlens.operators.sampling import stratified_folds, stratified_split
from campaignlens.plans.tuning import FittedModel, imbalance_study, tune
from campaignlens.settings import COST_PER_CONTACT, NUMERIC_FEATURES, PROFIT_PER_RESPONDER, TARGET
from campaignlens.sources.files import feature_list_document, write_csv, write_document, write_profiles
from campaignlens.sources.store import durable


@dataclass
class Analysis:
    """Result tables of one run; all small except ``test_scores``."""

    selected: str
    deployed_name: str
    candidates: Mapping[str, Candidate]
    grid_results: DataFrame
    leaderboard: DataFrame
    selection: DataFrame
    best_thresholds: DataFrame
    imbalance: DataFrame | None
    brier_scores: Mapping[str, object]
    model_card: DataFrame
    strategies: DataFrame
    intervals: DataFrame
    profiles: DataFrame
    permutation_importance: DataFrame
    importances: DataFrame | None
    odds_ratios: DataFrame | None
    test_scores: DataFrame
    document: DataFrame
    deployed_model: FittedModel


def calibrate(candidate: Candidate, train: DataFrame, test: DataFrame) -> dict[str, object]:
    """Brier scores of a model fitted on three quarters of the training rows, raw and calibrated."""
    parts = durable(
        stratified_split(train.drop("split", "fold"), 0.25, tag="calibration-split", names=("subtrain", "validation"), output="part")
    )
    model = FittedModel(candidate, parts.where("part = 'subtrain'").drop("part"))
    scored = lambda rows: model.score(rows).select("id", F.col(TARGET).alias("y"), "p")
    return calibration.calibration_check(durable(scored(parts.where("part = 'validation'").drop("part"))), durable(scored(test)))


def run_analysis(
    features: DataFrame,
    models: tuple[str, ...] = tuple(GRIDS),
    grids: Mapping[str, Mapping[str, list]] | None = None,
    with_imbalance: bool = True,
    replicates: int = 1000,
    k: int = 5,
    parallelism: int = 2,
    cost: float = COST_PER_CONTACT,
    profit: float = PROFIT_PER_RESPONDER,
) -> Analysis:
    """Everything up to the test set uses training rows only; the test rows are scored once."""
    split = durable(stratified_split(features))
    train = durable(stratified_folds(split.where("split = 'train'"), k))
    test = split.where("split = 'test'")

    candidates, oof, results = tune(train, models, grids, k, parallelism)
    board = durable(selection.dev_leaderboard(oof))
    chosen = durable(selection.select_model(board))
    winner = chosen.first()["selected"]

    sweep = thresholds.threshold_sweep(oof.where(F.col("model") == winner), cost=cost, profit=profit)
    best = durable(thresholds.best_thresholds(sweep))
    limits = best.first()

    study = None
    if with_imbalance:
        study = durable(imbalance_study(candidates[winner], train, test, k, parallelism))
    briers = calibrate(candidates[winner], train, test)

    fitted = {m: FittedModel(c, train.drop("split", "fold")) for m, c in candidates.items()}
    scored = None
    for name, model in fitted.items():
        part = model.score(test.drop("split")).select(F.lit(name).alias("model"), "id", F.col(TARGET).alias("y"), "p")
        scored = part if scored is None else scored.unionByName(part)
    scored = durable(scored)
    deployed = scored.where(F.col("model") == winner)
    deployed_name, deployed_model = winner, fitted[winner]
    if briers["validation_improved"]:
        slope, intercept = calibration.fit_sigmoid(fitted[winner].score(train.drop("split", "fold")).select("id", F.col(TARGET).alias("y"), "p"))
        deployed = deployed.withColumn("p", calibration.sigmoid(F.col("p"), slope, intercept))
        deployed_name = f"{winner} (Calibrated)"
        deployed_model = deployed_model.calibrated(slope, intercept)

    card = durable(selection.model_card(scored, board, parameters={m: c.parameters for m, c in candidates.items()}))
    policies = durable(thresholds.strategy_table(deployed, best, cost=cost, profit=profit))
    intervals = durable(bootstrap_ci(deployed, limits["profit_threshold"], replicates))
    segments = durable(
        customer_profiles(
            test.join(deployed.select("id", "y", "p"), "id"), limits["profit_threshold"], columns=NUMERIC_FEATURES
        )
    )

    tree = next((m for m in ("Random Forest", "Gradient Boosting", "Decision Tree") if m in fitted), None)
    importance_model = fitted[tree or winner]
    permutation = durable(explain.permutation_importance(importance_model.score, test.drop("split")))
    importances = explain.tree_importances(fitted[tree].pipeline) if tree else None
    odds = explain.odds_ratios(fitted["Logistic Regression"].pipeline) if "Logistic Regression" in fitted else None
    document = reporting.metrics_document(
        chosen, best, board, policies, intervals, odds, briers, cost, profit, dict(candidates[winner].parameters),
        card, deployed_name, {m: dict(c.parameters) for m, c in candidates.items()},
    )
    return Analysis(
        winner, deployed_name, candidates, results, board, chosen, best, study, briers, card, policies, intervals,
        segments, permutation, importances, odds, scored, document, deployed_model,
    )


def store_analysis(analysis: Analysis, location: str) -> None:
    """Result tables as CSV, documents as JSON, scores partitioned by model, the fitted pipeline."""
    write_csv(analysis.model_card, f"{location}/results_comparison")
    write_csv(analysis.strategies, f"{location}/business_simulation")
    for name in ("importances", "permutation_importance", "odds_ratios"):
        if getattr(analysis, name) is not None:
            write_csv(getattr(analysis, name), f"{location}/{name}")
    if analysis.imbalance is not None:
        write_csv(analysis.imbalance, f"{location}/imbalance_handling_comparison")
    write_profiles(analysis.profiles, f"{location}/customer_profiles")
    write_document(analysis.document, f"{location}/metrics")
    write_document(feature_list_document(analysis.model_card.sparkSession), f"{location}/feature_list")
    analysis.test_scores.write.mode("overwrite").partitionBy("model").parquet(f"{location}/test_scores")
    analysis.deployed_model.save(f"{location}/model")
