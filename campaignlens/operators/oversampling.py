"""Minority oversampling to parity for mixed numeric and categorical rows."""

from __future__ import annotations

from collections.abc import Sequence
from statistics import median

from pyspark.sql import DataFrame, Window, functions as F

from campaignlens.functions.hashing import HASH_RANGE, keyed_hash
from campaignlens.functions.numeric import count_where
from campaignlens.operators.neighbours import nearest_neighbours
from campaignlens.operators.ranking import ranked_by_hash
from campaignlens.settings import AGE_GROUPS, DUMMIES, NUMERIC_FEATURES, SEED, TARGET

NEIGHBOURS = 5


def encode_group(rows: DataFrame) -> DataFrame:
    """Dummy columns from ``age_group``."""
    return rows.withColumns(
        {d: F.coalesce((F.col("age_group") == g).cast("double"), F.lit(0.0)) for g, d in zip(AGE_GROUPS[1:], DUMMIES)}
    )


def category_penalty(minority: DataFrame, numeric: Sequence[str] = NUMERIC_FEATURES) -> float:
    """Distance between two categories: the median of the numeric deviations of the minority rows."""
    spread = minority.agg(*[F.stddev_pop(c).alias(c) for c in numeric])
    values = [v for v in spread.first() if v is not None]  # one value per numeric column
    return float(median(values)) if values else 0.0


def minority_neighbours(
    rows: DataFrame, k: int = NEIGHBOURS, numeric: Sequence[str] = NUMERIC_FEATURES, label: str = TARGET, smaller: int = 1
) -> DataFrame:
    """The k nearest other rows of every row of the smaller class: ``(qid, id, d2, rank)``.

    Categories enter as scaled indicators, so two different ones are one penalty apart.
    """
    minority = rows.where(F.col(label) == smaller)
    scale = category_penalty(minority, numeric) / 2**0.5
    marks = {f"_g{i}": F.coalesce((F.col("age_group") == g).cast("double"), F.lit(0.0)) * F.lit(scale) for i, g in enumerate(AGE_GROUPS)}
    points = minority.select("id", F.col(label).alias("y"), *numeric, "age_group").withColumns(marks)
    return nearest_neighbours(points, points, k, [*numeric, *marks], exclude_self=True)


def oversample(rows: DataFrame, k: int = NEIGHBOURS, numeric: Sequence[str] = NUMERIC_FEATURES, label: str = TARGET, seed: int = SEED) -> DataFrame:
    """Rows plus synthetic minority rows until both classes are equally large.

    Each synthetic row starts at a random minority row, moves a random part of the way to one of
    its k neighbours in every numeric column, and takes the most frequent category of the
    neighbours. Whichever class is smaller grows. Choices come from keyed
    hashes, so the result is the same on any partitioning.
    """
    spark = rows.sparkSession
    size = rows.agg(count_where(F.col(label) == 1).alias("pos"), count_where(F.col(label) == 0).alias("neg")).first()
    kept = rows.select("id", "age_group", *numeric, label, F.lit(False).alias("synthetic"))
    smaller = 1 if size["pos"] <= size["neg"] else 0
    few, many = sorted((size["pos"], size["neg"]))
    missing = many - few
    if not missing or few < 2:
        return kept
    minority = rows.where(F.col(label) == smaller)
    near = minority_neighbours(rows, k, numeric, label, smaller)
    values = minority.select(F.col("id"), "age_group", *numeric)
    around = (
        near.select("qid", "id", "rank")
        .join(values, "id")
        .groupBy("qid")
        .agg(
            F.sort_array(F.collect_list(F.struct("rank", *numeric))).alias("near"),  # k entries
            F.count(F.lit(1)).alias("found"),
        )
    )
    votes = near.select("qid", "id").join(values.select("id", "age_group"), "id").groupBy("qid", "age_group").agg(
        F.count(F.lit(1)).alias("votes")
    )
    best = Window.partitionBy("qid").orderBy(F.col("votes").desc(), "age_group")
    category = votes.withColumn("place", F.row_number().over(best)).where("place = 1").select("qid", F.col("age_group").alias("category"))
    base = ranked_by_hash(values.drop("age_group"), [], keyed_hash(F.col("id"), tag="smote-base", seed=seed), "place")
    seeds = base.join(around.withColumnRenamed("qid", "id"), "id").join(category.withColumnRenamed("qid", "id"), "id")

    number = F.col("number")
    draws = spark.range(missing).withColumnRenamed("id", "number").select(
        "number",
        (F.pmod(keyed_hash(number, tag="smote-row", seed=seed), F.lit(few)) + 1).alias("place"),
        keyed_hash(number, tag="smote-neighbour", seed=seed).alias("pick"),
        (keyed_hash(number, tag="smote-gap", seed=seed) / F.lit(float(HASH_RANGE))).alias("gap"),
    )
    other = F.element_at("near", (F.pmod(F.col("pick"), F.col("found")) + 1).cast("int"))
    made = draws.join(seeds, "place").select(
        (-F.col("number") - 1).alias("id"),
        F.col("category").alias("age_group"),
        *[(F.col(c) + F.col("gap") * (other[c] - F.col(c))).alias(c) for c in numeric],
        F.lit(smaller).alias(label),
        F.lit(True).alias("synthetic"),
    )
    return kept.unionByName(made)
