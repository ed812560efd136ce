"""Explainability: importances, odds ratios, permutation importance, Shapley attribution."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from campaignlens.functions.hashing import keyed_hash
from campaignlens.operators.ranking import ranked_by_hash
from campaignlens.operators.sampling import hash_sample, permuted_donors
from campaignlens.operators.thresholds import DEFAULT_THRESHOLD, confusion, with_ratios
from campaignlens.settings import FEATURES, SEED, TARGET, TRANSFORMED_FEATURES
from campaignlens.sources.store import durable

TOP = 20
SHAPLEY_ROWS = 300
SHAPLEY_TOP = 15
_CELLS_PER_TASK = 1024
_CELLS_AT_ONCE = 256

Scorer = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class AdditiveScore:
    """A scorer whose ``p`` is a curve of a sum: ``base`` and a term of every feature by itself, added in their order.

    ``terms`` makes the terms' columns, which are never missing; ``curve`` takes and returns arrays.
    """

    score: Scorer
    base: float
    terms: Callable[[], Mapping[str, Column]]
    curve: Callable[[np.ndarray], np.ndarray]

    def __call__(self, rows: DataFrame) -> DataFrame:
        return self.score(rows)


def tree_importances(model: PipelineModel, names: Sequence[str] = TRANSFORMED_FEATURES, top: int = TOP) -> DataFrame:
    """``(feature, importance)`` of a fitted tree model, largest first; one row per model column."""
    values = model.stages[-1].featureImportances.toArray()
    rows = [(n, float(v)) for n, v in zip(names, values)]
    return SparkSession.active().createDataFrame(rows, "feature string, importance double").orderBy(F.col("importance").desc(), "feature").limit(top)


def coefficient_table(names: Sequence[str], coefficients: Sequence[float]) -> DataFrame:
    """Names and coefficients matched by position."""
    pairs = SparkSession.active().createDataFrame([(list(names), [float(c) for c in coefficients])], "names array<string>, values array<double>")
    return pairs.select(F.explode(F.arrays_zip("names", "values")).alias("z")).select(
        F.col("z.names").alias("feature"), F.col("z.values").alias("coefficient")
    )


def odds_ratio_table(coefficients: DataFrame, top: int = TOP) -> DataFrame:
    """Odds ratios per standard deviation: the ``top`` strongest effects, ordered by ratio."""
    table = coefficients.select(
        "feature", F.exp("coefficient").alias("odds_ratio"), F.abs("coefficient").alias("abs_log_odds")
    )
    strongest = table.orderBy(F.col("abs_log_odds").desc(), "feature").limit(top)
    return strongest.orderBy("odds_ratio", "feature")


def odds_ratios(model: PipelineModel, names: Sequence[str] = TRANSFORMED_FEATURES, top: int = TOP) -> DataFrame:
    return odds_ratio_table(coefficient_table(names, model.stages[-1].coefficients.toArray()), top)


def raising_features(ratios: DataFrame) -> DataFrame:
    return ratios.where(F.col("odds_ratio") > 1)


def top_driver(ratios: DataFrame) -> DataFrame:
    """The feature with the largest odds ratio."""
    return ratios.agg(F.max_by("feature", "odds_ratio").alias("feature"), F.max("odds_ratio").alias("odds_ratio"))


def permuted_variants(rows: DataFrame, features: Sequence[str] = FEATURES, repeats: int = 5, seed: int = SEED) -> DataFrame:
    """All rows once per (feature, repeat) with that feature taken from another row.

    The permutation of a repeat is shared by the features, so the rows are joined once per
    repeat and not once per feature. Adds ``feature`` and ``repeat``.
    """
    features = list(features)
    joined = rows.join(permuted_donors(rows, features, repeats, seed=seed), "id")
    tall = joined.withColumn("feature", F.explode(F.array(*[F.lit(f) for f in features])))
    swapped = {f: F.when(F.col("feature") == f, F.col(f"donor_{f}")).otherwise(F.col(f)) for f in features}
    return tall.withColumns(swapped).drop(*[f"donor_{f}" for f in features])


def permutation_importance(
    score: Scorer, rows: DataFrame, features: Sequence[str] = FEATURES, repeats: int = 5, threshold: float = DEFAULT_THRESHOLD, label: str = TARGET, seed: int = SEED
) -> DataFrame:
    """Mean and population deviation of the F1 drop per raw feature, with a single scoring pass."""
    def f1(scored: DataFrame, keys: list[str]) -> DataFrame:
        return with_ratios(confusion(scored.withColumn("y", F.col(label)), threshold, keys)).select(*keys, "f1")

    baseline = f1(score(rows), []).first()["f1"]
    # Several variants of a row share its id, so the scorer gets a number of its own per variant.
    width = len(features) * repeats
    slot = F.array_position(F.array(*[F.lit(f) for f in features]), F.col("feature")) - 1
    variants = permuted_variants(rows, features, repeats, seed).withColumn(
        "id", F.col("id") * F.lit(width) + slot * F.lit(repeats) + F.col("repeat")
    )
    drops = f1(score(variants), ["feature", "repeat"]).withColumn("drop", F.lit(baseline) - F.col("f1"))
    return drops.groupBy("feature").agg(F.avg("drop").alias("importance_mean"), F.stddev_pop("drop").alias("importance_std"))


def coalition_rows(rows: DataFrame, background: DataFrame, permutations: int, features: Sequence[str] = FEATURES, seed: int = SEED) -> DataFrame:
    """Rows blended with a background row feature by feature, in random feature orders.

    Step ``s`` of permutation ``q`` takes the first ``s`` features of the order from the row itself
    and the others from the background row. Adds ``permutation``, ``step`` and ``order``.
    """
    features = list(features)
    row_key, q = F.col("id"), F.col("permutation")
    tall = rows.select("id", *features).withColumn("permutation", F.explode(F.sequence(F.lit(0), F.lit(permutations - 1))))
    ranks = [F.struct(keyed_hash(row_key, q, F.lit(f), tag="shapley-order", seed=seed).alias("h"), F.lit(f).alias("f")) for f in features]
    tall = tall.withColumn("order", F.transform(F.array_sort(F.array(*ranks)), lambda s: s["f"]))
    size = background.count()
    # The background is numbered by hash rank; every draw picks a number, so the join is on equality and even.
    base = background.select("id", *[F.col(f).alias(f"base_{f}") for f in features])
    numbered = ranked_by_hash(base, [], keyed_hash(F.col("id"), tag="shapley-background", seed=seed), "slot").drop("id")
    draw = F.pmod(keyed_hash(row_key, q, tag="shapley-base", seed=seed), F.lit(size)) + 1
    drawn = tall.withColumn("slot", draw.cast("bigint"))
    mixed = drawn.join(numbered, "slot").withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(len(features)))))
    own = {
        f: F.when(F.array_position("order", F.lit(f)) <= F.col("step"), F.col(f)).otherwise(F.col(f"base_{f}")) for f in features
    }
    return mixed.withColumns(own).select("id", "permutation", "step", "order", *features)


def shapley_values(score: Scorer, rows: DataFrame, background: DataFrame, permutations: int = 20, features: Sequence[str] = FEATURES, sample: int = SHAPLEY_ROWS, background_size: int | None = None, seed: int = SEED) -> DataFrame:
    """``(id, feature, phi)`` by sampled feature orders, for any model, with a single scoring pass.

    Rows are blended with rows drawn from the whole background unless ``background_size`` samples it first. Attributions of a row add up to its score minus the mean score of its drawn background rows.
    """
    features = list(features)
    chosen = hash_sample(rows, sample, tag="shapley", seed=seed)
    base = background if background_size is None else hash_sample(background, background_size, tag="shapley-background", seed=seed)
    steps = len(features) + 1
    blends = coalition_rows(chosen, base, permutations, features, seed)
    keyed = blends.withColumnRenamed("id", "row").withColumnRenamed("order", "feature_order")
    keyed = keyed.withColumn("id", (F.col("row") * F.lit(permutations) + F.col("permutation")) * F.lit(steps) + F.col("step"))
    scored = score(keyed)
    # One path per (row, permutation): nine scores in a row.
    paths = scored.groupBy("row", "permutation").agg(
        F.sort_array(F.collect_list(F.struct("step", "p"))).alias("path"), F.first("feature_order").alias("feature_order")
    )
    moves = paths.select(
        "row",
        F.explode(
            F.transform(
                F.sequence(F.lit(1), F.lit(len(features))),
                lambda s: F.struct(
                    F.element_at("feature_order", s.cast("int")).alias("feature"),
                    (F.element_at("path", (s + 1).cast("int"))["p"] - F.element_at("path", s.cast("int"))["p"]).alias("gain"),
                ),
            )
        ).alias("m"),
    )
    return moves.groupBy(F.col("row").alias("id"), F.col("m.feature").alias("feature")).agg(F.avg("m.gain").alias("phi"))


def exact_shapley_values(
    score: Scorer, rows: DataFrame, background: DataFrame, features: Sequence[str] = FEATURES, sample: int = SHAPLEY_ROWS, seed: int = SEED
) -> DataFrame:
    """``(id, feature, phi)`` by all ``2 ** len(features)`` coalitions against the whole background, for few features.

    A coalition's value is the mean score of the background with the coalition's features taken from the row. Equal background
    rows are scored once. At most ``sample`` rows are explained; they travel with every background cell, and only their means come back.
    An :class:`AdditiveScore` is summed and scored on arrays in the tasks that hold the cells, for the same coalitions; any other scorer gets a row for each.
    """
    features, width = list(features), len(features)
    if isinstance(score, AdditiveScore) and set(terms := dict(score.terms())) == set(features):
        return _additive_shapley_values(score, terms, hash_sample(rows.select("id", *features), sample, tag="shapley", seed=seed), background, features)
    kinds = dict(rows.dtypes)
    chosen = hash_sample(rows.select("id", *features), sample, tag="shapley", seed=seed).collect()  # at most ``sample`` rows
    cells = background.groupBy(*[F.col(f).alias(f"base_{f}") for f in features]).agg(F.count(F.lit(1)).alias("n"))
    if not chosen:
        return rows.select("id", F.lit("").alias("feature"), F.lit(0.0).alias("phi")).limit(0)
    explained = F.array(*[F.struct(F.lit(r["id"]).alias("id"), *[F.lit(r[f]).cast(kinds[f]).alias(f) for f in features]) for r in chosen])
    blends = cells.withColumn("e", F.explode(explained)).withColumn("coalition", F.explode(F.sequence(F.lit(0), F.lit((1 << width) - 1))))
    inside = [F.shiftright("coalition", i).bitwiseAND(F.lit(1)) == 1 for i in range(width)]
    mixed = blends.select(
        F.col("e.id").alias("row"), "coalition", "n", F.lit(0).cast("bigint").alias("id"),
        *[F.when(inside[i], F.col(f"e.{f}")).otherwise(F.col(f"base_{f}")).alias(f) for i, f in enumerate(features)],
    )
    values = score(mixed).groupBy("row", "coalition").agg((F.sum(F.col("p") * F.col("n")) / F.sum("n")).alias("value"))
    weights = _coalition_weights(width)
    size = F.bit_count(F.col("coalition"))
    table = F.array(*[F.lit(w) for w in weights])
    shares = [
        F.sum(F.col("value") * F.when(inside[i], F.element_at(table, size)).otherwise(-F.element_at(table, size + 1))).alias(f)
        for i, f in enumerate(features)
    ]
    return values.groupBy(F.col("row").alias("id")).agg(*shares).unpivot(["id"], features, "feature", "phi")


def _coalition_weights(width: int) -> list[float]:
    """By size s: a coalition of s features counts with s! (width - s - 1)! / width! for every feature outside it, and likewise inside."""
    return [math.factorial(s) * math.factorial(width - s - 1) / math.factorial(width) for s in range(width)]


def _additive_shapley_values(score: AdditiveScore, terms: Mapping[str, Column], chosen: DataFrame, background: DataFrame, features: Sequence[str]) -> DataFrame:
    """All coalitions of all chosen rows against every background cell: sums and scores are arrays, and attributions are added up per task."""
    import pyarrow as pa

    width = len(terms)
    columns = [c.alias(f"t{i}") for i, c in enumerate(terms.values())]
    found = chosen.select("id", *columns).collect()  # at most ``sample`` rows
    points, base, curve = np.array([r[1:] for r in found], float).reshape(-1, width), score.base, score.curve
    cells = durable(background.select(*columns).groupBy(*[f"t{i}" for i in range(width)]).agg(F.count(F.lit(1)).alias("n")))
    tasks = max(1, -(-cells.count() // _CELLS_PER_TASK))
    # bit i of a coalition's number stands for the i-th term
    inside = (np.arange(1 << width) >> np.arange(width)[:, None]) & 1
    size, by_size = inside.sum(axis=0), np.array([*_coalition_weights(width), 0.0])
    weights = np.where(inside, by_size[size - 1], -by_size[size])

    def attribute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, mass = np.zeros(points.shape), 0.0
        for batch in batches:
            *other, n = (c.to_numpy().astype(float) for c in batch.columns)
            for at in range(0, batch.num_rows, _CELLS_AT_ONCE):
                theirs, heavy = np.stack([c[at : at + _CELLS_AT_ONCE] for c in other]), n[at : at + _CELLS_AT_ONCE]
                sums = np.empty((1 << width, len(heavy)))
                for row, own in enumerate(points):
                    sums[0] = base
                    for i in range(width):
                        half = 1 << i
                        np.add(sums[:half], own[i], out=sums[half : 2 * half])
                        sums[:half] += theirs[i]
                    totals[row] += weights @ (curve(sums) @ heavy)
            mass += n.sum()
        if mass:
            made = [pa.array(np.arange(len(points)), pa.int32()), pa.array(list(totals), pa.list_(pa.float64())), pa.array(np.full(len(points), mass))]
            yield pa.RecordBatch.from_arrays(made, ["row", "totals", "mass"])

    parts = cells.repartition(tasks).mapInArrow(attribute, "row int, totals array<double>, mass double")
    order = list(terms)
    shares = [(F.sum(F.col("totals")[order.index(f)]) / F.sum("mass")).alias(f) for f in features]
    kind = dict(chosen.dtypes)["id"]
    ids = F.array(*[F.lit(r["id"]).cast(kind) for r in found]) if found else F.array(F.lit(None).cast(kind))
    values = parts.groupBy("row").agg(*shares).withColumn("id", F.get(ids, F.col("row")))
    # rows that share an id are explained as one, by their mean
    return values.groupBy("id").agg(*[F.avg(f).alias(f) for f in features]).unpivot(["id"], list(features), "feature", "phi")


def shapley_summary(values: DataFrame, top: int = SHAPLEY_TOP) -> DataFrame:
    """Mean absolute attribution per feature, largest first."""
    return values.groupBy("feature").agg(F.avg(F.abs("phi")).alias("mean_abs_phi")).orderBy(F.col("mean_abs_phi").desc(), "feature").limit(top)
