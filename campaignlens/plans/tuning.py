"""Cross-validation, grid search and out-of-fold scores for all six models."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from campaignlens.operators.classifiers import (
    GRIDS,
    LABEL,
    SUPPORTS_CLASS_WEIGHT,
    Candidate,
    fit_pipeline,
    grid,
    with_balanced_weights,
)
from campaignlens.operators import boosting, trees
from campaignlens.operators.calibration import sigmoid
from campaignlens.operators.curves import ranking_metrics
from campaignlens.operators.logistic import fit_logits, logit_probability
from campaignlens.operators.naive_bayes import fit_gaussian_nb, score_gaussian_nb
from campaignlens.operators.neighbours import nearest_neighbours, neighbour_vote
from campaignlens.operators.oversampling import encode_group, oversample
from campaignlens.operators.prep import fold_statistics, prep_statistics, transformed
from campaignlens.operators.selection import fold_summary
from campaignlens.operators.thresholds import confusion, with_ratios
from campaignlens.settings import TARGET, TRANSFORMED_FEATURES
from campaignlens.sources.store import durable, durable_parts, load_pipeline, save_pipeline

#: Models fitted as keyed tables instead of Spark ML stages.
KEYED_MODELS = ("Naive Bayes", "K-Nearest Neighbors")

def run_parallel(tasks: Sequence[Callable[[], object]], parallelism: int) -> list:
    """Run driver-side job launches side by side; every task starts its own Spark jobs."""
    if parallelism <= 1 or len(tasks) <= 1:
        return [task() for task in tasks]
    spark = SparkSession.active()
    pool = ThreadPool(min(parallelism, len(tasks)))
    try:
        return pool.map(lambda task: inheritable_thread_target(spark)(task)(), tasks)
    finally:
        pool.close()


class FoldData:
    """Training rows stored once by fold, and the preprocessing statistics of every fold's fit.

    A fit reads the other folds' files and scales them on the way; nothing is stored once per fit.
    """

    def __init__(self, train: DataFrame, k: int = 5):
        self.k = k
        self.statistics = durable(fold_statistics(train, range(k)))
        self.rows = durable(train, ["fold"])
        counts = {r["fold"]: r["count"] for r in self.rows.groupBy("fold").count().collect()}  # k rows
        self.sizes = {f: float(sum(n for g, n in counts.items() if g != f)) for f in range(k)}

    def _shaped(self, rows: DataFrame) -> DataFrame:
        packed = array_to_vector(F.array(*[F.col(f"`{c}`") for c in TRANSFORMED_FEATURES]))
        carry = ["fold", TARGET, "age_group"]
        shaped = transformed(rows, self.statistics, ["fit"], carry).withColumn("features", packed)
        return shaped.withColumn(LABEL, F.col(TARGET).cast("double"))

    @property
    def fits(self) -> DataFrame:
        """Every row under every fit that learns from it, for models fitted as one keyed job."""
        others = F.filter(F.array(*[F.lit(f) for f in range(self.k)]), lambda f: f != F.col("fold"))
        return self._shaped(self.rows.withColumn("fit", F.explode(others)))

    @property
    def held(self) -> DataFrame:
        """Every row once, in the scale of the fit that has not seen it."""
        return self._shaped(self.rows.withColumn("fit", F.col("fold")))

    def train(self, fold: int) -> DataFrame:
        return self._shaped(self.rows.where(F.col("fold") != fold).withColumn("fit", F.lit(fold)))

    def rest(self, fold: int) -> DataFrame:
        return self._shaped(self.rows.where(F.col("fold") == fold).withColumn("fit", F.col("fold")))


def _name(parameters: Mapping[str, object]) -> str:
    return ", ".join(f"{k}={v}" for k, v in parameters.items())


def _tag(rows: DataFrame, candidate: Candidate, position: int) -> DataFrame:
    return rows.select(
        F.lit(candidate.model).alias("model"),
        F.lit(position).alias("position"),
        F.lit(_name(candidate.parameters)).alias("parameters"),
        "fold",
        "id",
        F.col(TARGET).alias("y"),
        "p",
    )


def _settings_scored(scores: DataFrame, candidates: Sequence[Candidate]) -> DataFrame:
    """Scores of many settings by ``position`` with the settings' names."""
    names = F.array(*[F.lit(_name(c.parameters)) for c in candidates])
    return scores.select(
        F.lit(candidates[0].model).alias("model"), "position", F.element_at(names, F.col("position") + 1).alias("parameters"), "fold", "id", "y", "p"
    )


def _logit_scores(data: FoldData, candidates: Sequence[Candidate]) -> DataFrame:
    """``(position, fold, id, y, p)``: all strengths and folds of the logistic model are fitted in the same steps."""
    strengths = [float(c.parameters["C"]) for c in candidates]
    rows = durable(data.fits.select("fit", TARGET, *[F.col(f"`{c}`") for c in TRANSFORMED_FEATURES]))
    logits = fit_logits(rows, TRANSFORMED_FEATURES, strengths, label=TARGET, fit="fit")
    settings = F.array(*[
        F.struct(F.lit(i).alias("position"), logit_probability([m for m in logits if m.strength == c], TRANSFORMED_FEATURES, "fit").alias("p"))
        for i, c in enumerate(strengths)
    ])
    scored = data.held.withColumn("s", F.explode(settings))
    return scored.select("s.position", "fold", "id", F.col(TARGET).alias("y"), "s.p")


def candidate_scores(
    data: FoldData, models: Sequence[str], grids: Mapping[str, Mapping[str, list]], parallelism: int = 2
) -> DataFrame:
    """Out-of-fold scores of every parameter set of every model: ``(model, position, parameters, fold, id, y, p)``."""
    parts: list[Callable[[], DataFrame]] = []
    labels = data.held.select("fold", "id", TARGET)
    for model in models:
        candidates = [Candidate(model, p) for p in grid(model, grids.get(model))]
        if model == "Naive Bayes":
            for i, c in enumerate(candidates):
                fitted = fit_gaussian_nb(data.fits, ["fit"], c.parameters["var_smoothing"])
                parts.append(lambda c=c, i=i, fitted=fitted: _tag(score_gaussian_nb(data.held, fitted, ["fit"]), c, i))
        elif model == "K-Nearest Neighbors":
            # One neighbour search serves the whole grid.
            most = max(c.parameters["n_neighbors"] for c in candidates)
            near = durable(
                nearest_neighbours(data.held, data.fits.withColumn("y", F.col(TARGET)), most, keys=["fit"])
            )
            for i, c in enumerate(candidates):
                votes = neighbour_vote(near, c.parameters["n_neighbors"], c.parameters["weights"], ["fit"])
                parts.append(lambda c=c, i=i, votes=votes: _tag(votes.drop("fit").join(labels, "id"), c, i))
        elif model == "Logistic Regression":
            parts.append(lambda cs=candidates: _settings_scored(_logit_scores(data, cs), cs))
        elif model in ("Decision Tree", "Random Forest"):
            # One tree per criterion, or one forest, serves every depth, split size and number of trees.
            scored = trees.tree_grid_scores if model == "Decision Tree" else trees.forest_grid_scores
            settings = [c.parameters for c in candidates]
            parts.append(lambda scored=scored, settings=settings, cs=candidates: _settings_scored(scored(data.fits, data.held, settings), cs))
        elif model == "Gradient Boosting":
            settings = [c.parameters for c in candidates]
            parts.append(lambda settings=settings, cs=candidates: _settings_scored(boosting.grid_scores(data.rows, data.statistics, settings, data.k), cs))
        else:
            raise ValueError(f"no such model: {model}")
    return durable_parts(parts, lambda tasks: run_parallel(tasks, parallelism))


def grid_results(scores: DataFrame, digits: int | None = None) -> DataFrame:
    """Mean and deviation of the fold scores per parameter set, one job for all of them; exact scores unless rounded."""
    by = ["model", "position", "parameters"]
    return fold_summary(ranking_metrics(scores, [*by, "fold"], digits), by)


def best_candidates(results: DataFrame) -> DataFrame:
    """Per model the parameter set with the highest mean average precision; the first one wins a tie."""
    order = F.struct(-F.col("cv_pr_auc_mean"), F.col("position"))
    return results.groupBy("model").agg(
        F.min_by("position", order).alias("position"), F.min_by("parameters", order).alias("parameters")
    )


def tune(
    train: DataFrame,
    models: Sequence[str] = tuple(GRIDS),
    grids: Mapping[str, Mapping[str, list]] | None = None,
    k: int = 5,
    parallelism: int = 2,
) -> tuple[dict[str, Candidate], DataFrame, DataFrame]:
    """Best candidate per model, its out-of-fold scores, and all grid results.

    Searches the published grids unless others are given. Uses training rows only; there is no argument through
    which test rows could enter.
    """
    grids = GRIDS if grids is None else grids
    scores = candidate_scores(FoldData(train, k), models, grids, parallelism)
    results = durable(grid_results(scores))
    best = best_candidates(results)
    chosen = {row["model"]: row["position"] for row in best.collect()}  # one row per model
    candidates = {m: Candidate(m, list(grid(m, grids.get(m)))[chosen[m]]) for m in models}
    wanted = F.lit(False)
    for model, position in chosen.items():
        wanted = wanted | ((F.col("model") == model) & (F.col("position") == position))
    return candidates, scores.where(wanted).select("model", "fold", "id", "y", "p"), results


class FittedModel:
    """Any of the six models behind one method: append ``p`` to rows with the raw features."""

    def __init__(self, candidate: Candidate, train: DataFrame | None, weighted: bool = False):
        self.candidate = candidate
        self.pipeline: PipelineModel | None = None
        self.calibration: tuple[float, float] | None = None
        self._tables: dict[str, DataFrame] = {}
        if train is None:
            return
        if candidate.model in KEYED_MODELS:
            self._tables["statistics"] = durable(prep_statistics(train))
            rows = durable(transformed(train, self._tables["statistics"], carry=[TARGET]))
            if candidate.model == "Naive Bayes":
                self._tables["parameters"] = durable(fit_gaussian_nb(rows, smoothing=candidate.parameters["var_smoothing"]))
            else:
                self._tables["rows"] = rows
        else:
            self.pipeline = fit_pipeline(candidate, train, weighted)

    def calibrated(self, slope: float, intercept: float) -> "FittedModel":
        """The same model with its scores passed through a sigmoid."""
        model = FittedModel(self.candidate, None)
        model.pipeline, model._tables, model.calibration = self.pipeline, self._tables, (slope, intercept)
        return model

    def score(self, rows: DataFrame) -> DataFrame:
        """Rows with ``p`` added; ``id`` must be unique."""
        if self.pipeline is not None:
            scored = self.pipeline.transform(rows).select(*rows.columns, vector_to_array("probability")[1].alias("p"))
        else:
            x = transformed(rows, self._tables["statistics"])
            p = self.candidate.parameters
            if self.candidate.model == "Naive Bayes":
                found = score_gaussian_nb(x, self._tables["parameters"]).select("id", "p")
            else:
                near = nearest_neighbours(x, self._tables["rows"].withColumn("y", F.col(TARGET)), p["n_neighbors"])
                found = neighbour_vote(near, p["n_neighbors"], p["weights"])
            scored = rows.join(found, "id")
        if self.calibration is not None:
            scored = scored.withColumn("p", sigmoid(F.col("p"), *self.calibration))
        return scored

    def save(self, location: str) -> None:
        """Everything that ``load`` needs, whatever the model: fitted stages or tables, parameters, calibration."""
        spark = SparkSession.active()
        document = {"model": self.candidate.model, "parameters": dict(self.candidate.parameters), "calibration": self.calibration}
        stored = spark.createDataFrame([(json.dumps(document),)], "document string")
        stored.coalesce(1).write.mode("overwrite").text(f"{location}/candidate")
        if self.pipeline is not None:
            save_pipeline(self.pipeline, f"{location}/pipeline")
        for name, table in self._tables.items():
            table.write.mode("overwrite").parquet(f"{location}/{name}")

    @classmethod
    def load(cls, spark: SparkSession, location: str) -> "FittedModel":
        document = json.loads(spark.read.text(f"{location}/candidate").first()[0])
        model = cls(Candidate(document["model"], document["parameters"]), None)
        model.calibration = tuple(document["calibration"]) if document["calibration"] else None
        if document["model"] in KEYED_MODELS:
            names = ("statistics", "parameters" if document["model"] == "Naive Bayes" else "rows")
            model._tables = {n: spark.read.parquet(f"{location}/{n}") for n in names}
        else:
            model.pipeline = load_pipeline(f"{location}/pipeline")
        return model


# --- class imbalance ---------------------------------------------------------------------------

# The published names of the treatments.
UNTREATED = "None (Unweighted Baseline)"
BALANCED = "class_weight='balanced'"
UNSUPPORTED = "class_weight='balanced' (Not supported for estimator)"
OVERSAMPLED = "SMOTENC (Categorical-aware Oversampling)"


def _scored_treated(candidate: Candidate, rows: DataFrame, score_on: DataFrame, treatment: str) -> DataFrame:
    """``(id, target, p)`` of ``score_on`` after a fit on transformed training rows under one treatment."""
    packed = array_to_vector(F.array(*[F.col(f"`{c}`") for c in TRANSFORMED_FEATURES]))
    if treatment == OVERSAMPLED:
        grown = encode_group(oversample(rows)).withColumns({"features": packed, LABEL: F.col(TARGET).cast("double")})
        rows = durable(grown.select("id", *[F.col(f"`{c}`") for c in TRANSFORMED_FEATURES], "features", LABEL, TARGET))
    elif treatment == BALANCED:
        rows = with_balanced_weights(rows)
    p = candidate.parameters
    if candidate.model == "Naive Bayes":
        found = score_gaussian_nb(score_on, fit_gaussian_nb(rows, smoothing=p["var_smoothing"]))
        return found.select("id", TARGET, "p")
    if candidate.model == "K-Nearest Neighbors":
        near = nearest_neighbours(score_on, rows.withColumn("y", F.col(TARGET)), p["n_neighbors"])
        return neighbour_vote(near, p["n_neighbors"], p["weights"]).join(score_on.select("id", TARGET), "id").select("id", TARGET, "p")
    total = float(rows.count()) if candidate.model == "Logistic Regression" else 0.0
    model = candidate.classifier(total, weighted=treatment == BALANCED).fit(rows)
    return model.transform(score_on).select("id", TARGET, vector_to_array("probability")[1].alias("p"))


def imbalance_study(candidate: Candidate, train: DataFrame, test: DataFrame, k: int = 5, parallelism: int = 2) -> DataFrame:
    """Three treatments of class imbalance for one model: fold scores and test scores side by side.

    Oversampling and weights see the training part of each fold only.
    """
    spark = train.sparkSession
    supported = candidate.model in SUPPORTS_CLASS_WEIGHT
    treatments = [UNTREATED, *([BALANCED] if supported else []), OVERSAMPLED]
    data = FoldData(train, k)
    statistics = durable(prep_statistics(train))
    packed = array_to_vector(F.array(*[F.col(f"`{c}`") for c in TRANSFORMED_FEATURES]))
    whole = durable(
        transformed(train, statistics, carry=[TARGET, "age_group"])
        .withColumns({"features": packed, LABEL: F.col(TARGET).cast("double")})
    )
    held_out = durable(transformed(test, statistics, carry=[TARGET]).withColumn("features", packed))

    def scored(treatment: str, fold: int) -> DataFrame:
        fit_on, score_on = (data.train(fold), data.rest(fold)) if fold >= 0 else (whole, held_out)
        return _scored_treated(candidate, fit_on, score_on, treatment).select(
            F.lit(treatment).alias("model"), F.lit(fold).alias("fold"), "id", F.col(TARGET).alias("y"), "p"
        )

    parts = [lambda t=t, f=f: scored(t, f) for t in treatments for f in [-1, *range(k)]]
    everything = durable_parts(parts, lambda tasks: run_parallel(tasks, parallelism))
    cv = fold_summary(ranking_metrics(everything.where("fold >= 0"), ["model", "fold"]))
    tested = everything.where("fold = -1")
    final = ranking_metrics(tested).withColumnsRenamed({"roc_auc": "test_roc_auc", "pr_auc": "test_pr_auc"})
    f1 = with_ratios(confusion(tested)).select("model", F.col("f1").alias("test_f1"))
    columns = ["cv_pr_auc_mean", "cv_pr_auc_std", "cv_roc_auc_mean", "cv_roc_auc_std", "test_pr_auc", "test_roc_auc", "test_f1"]
    table = cv.join(final, "model").join(f1, "model").select(F.col("model").alias("treatment"), *columns)
    if not supported:
        schema = "treatment string, " + ", ".join(f"{c} double" for c in columns)
        table = table.unionByName(spark.createDataFrame([(UNSUPPORTED, *[None] * len(columns))], schema))
    return table


