"""Classifier templates and grids on Spark ML, with preprocessing inside the pipeline."""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from campaignlens.operators.prep import CampaignPreprocessor
from campaignlens.settings import SEED, TARGET

DEEPEST_TREE = 30  # the library's limit, used where depth is unlimited
TREE_BINS = 64
LABEL = "label"
WEIGHT = "weight"

# The published hyper-parameter grids.
GRIDS: dict[str, dict[str, list]] = {
    "Logistic Regression": {"C": [0.01, 0.1, 1.0, 5.0, 10.0]},
    "K-Nearest Neighbors": {"n_neighbors": [5, 9, 15, 21], "weights": ["uniform", "distance"]},
    "Decision Tree": {"max_depth": [3, 5, 8], "min_samples_split": [2, 5, 10], "criterion": ["gini", "entropy"]},
    "Random Forest": {"n_estimators": [50, 100, 150], "max_depth": [4, 6, 8, None], "min_samples_split": [2, 5]},
    "Naive Bayes": {"var_smoothing": [1e-9, 1e-8, 1e-7, 1e-6]},
    "Gradient Boosting": {"n_estimators": [50, 100, 150], "learning_rate": [0.05, 0.1, 0.2], "max_depth": [3, 5]},
}
SUPPORTS_CLASS_WEIGHT = ("Logistic Regression", "Decision Tree", "Random Forest")


def grid(model: str, overrides: Mapping[str, list] | None = None) -> Iterator[dict]:
    """Parameter combinations in grid order."""
    axes = dict(GRIDS[model], **(overrides or {}))
    for values in itertools.product(*axes.values()):
        yield dict(zip(axes, values))


def balanced_weights(train: DataFrame, label: str = TARGET) -> DataFrame:
    """``(label, n, weight)`` with weight ``rows / (2 * n)``: two rows."""
    counts = train.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    whole = counts.groupBy().agg(
        F.sum("n").alias("total"), F.collect_list(F.struct(F.col(label), F.col("n"))).alias("classes")
    )
    return whole.select("total", F.explode("classes").alias("c")).select(
        F.col(f"c.{label}").alias(label), F.col("c.n").alias("n"), (F.col("total") / (2.0 * F.col("c.n"))).alias("weight")
    )


def with_balanced_weights(train: DataFrame, label: str = TARGET, output: str = WEIGHT) -> DataFrame:
    """Attach the class weight through two literals."""
    weights = {row[label]: row["weight"] for row in balanced_weights(train, label).collect()}  # two rows
    chosen = F.lit(1.0)
    for cls, weight in weights.items():
        chosen = F.when(F.col(label) == cls, F.lit(float(weight))).otherwise(chosen)
    return train.withColumn(output, chosen)


def min_rows_per_leaf(min_samples_split: int) -> int:
    """The library limits leaf size instead of split size: half a split, rounded up."""
    return max(1, math.ceil(min_samples_split / 2))


@dataclass(frozen=True)
class Candidate:
    """One model with one parameter combination."""

    model: str
    parameters: Mapping[str, object] = field(default_factory=dict)

    def classifier(self, total_weight: float, weighted: bool = False, features: str = "features"):
        common = {"featuresCol": features, "labelCol": LABEL}
        if weighted:
            common["weightCol"] = WEIGHT
        p = self.parameters
        if self.model == "Logistic Regression":
            # The penalty of the C form is 1 / C per row sum; here it is per row average.
            return LogisticRegression(
                regParam=1.0 / (float(p["C"]) * total_weight),
                elasticNetParam=0.0,
                standardization=False,
                maxIter=1000,
                **common,
            )
        if self.model == "Decision Tree":
            return DecisionTreeClassifier(
                maxDepth=p["max_depth"],
                impurity=p.get("criterion", "gini"),
                minInstancesPerNode=min_rows_per_leaf(p.get("min_samples_split", 2)),
                maxBins=TREE_BINS,
                seed=SEED,
                **common,
            )
        if self.model == "Random Forest":
            return RandomForestClassifier(
                numTrees=p["n_estimators"],
                maxDepth=DEEPEST_TREE if p.get("max_depth") is None else p["max_depth"],
                minInstancesPerNode=min_rows_per_leaf(p.get("min_samples_split", 2)),
                featureSubsetStrategy="sqrt",
                maxBins=TREE_BINS,
                seed=SEED,
                **common,
            )
        if self.model == "Gradient Boosting":
            return GBTClassifier(
                maxIter=p["n_estimators"],
                stepSize=p["learning_rate"],
                maxDepth=p["max_depth"],
                maxBins=TREE_BINS,
                seed=SEED,
                **common,
            )
        raise ValueError(f"{self.model} is not fitted by Spark ML")


def fit_pipeline(candidate: Candidate, train: DataFrame, weighted: bool = False) -> PipelineModel:
    """Fit preprocessing and classifier on training rows only."""
    rows = train.withColumn(LABEL, F.col(TARGET).cast("double"))
    if weighted:
        rows = with_balanced_weights(rows)
    # Balanced weights sum to the number of rows, so the count serves both cases.
    total = float(rows.count()) if candidate.model == "Logistic Regression" else 0.0
    return Pipeline(stages=[CampaignPreprocessor(), candidate.classifier(total, weighted)]).fit(rows)


def probability_of_response(model: PipelineModel, rows: DataFrame, carry=("id", TARGET)) -> DataFrame:
    """``(carry…, p)``: probability of class 1 for any rows."""
    return model.transform(rows).select(*carry, vector_to_array("probability")[1].alias("p"))
