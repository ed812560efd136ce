"""Repeatable samples, stratified splits and folds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from campaignlens.functions.hashing import keyed_hash
from campaignlens.operators.ranking import hash_cuts, ranked_by_hash
from campaignlens.settings import SEED, TARGET


def _cuts_before(cuts: Column, most: int) -> Column:
    """How many of up to ``most`` cut points lie strictly before the row in ``(hash, id)`` order."""
    count = F.lit(0)
    for i in range(most):
        cut = F.get(cuts, F.lit(i))
        before = (cut["h"] < F.col("_h")) | ((cut["h"] == F.col("_h")) & (cut["id"] < F.col("id")))
        count = count + F.when(before, 1).otherwise(0)
    return count


def _with_cuts(rows: DataFrame, stratum: str, hashed: Column, positions) -> DataFrame:
    """Attach the hash and the cut points of the class. The class label has two values, so the
    broadcast table has two rows (three when some labels are missing)."""
    cuts = hash_cuts(rows, [stratum], hashed, positions)
    return rows.withColumn("_h", hashed).join(F.broadcast(cuts), stratum, "left")


def stratified_split(
    rows: DataFrame,
    fraction: float = 0.20,
    stratum: str = TARGET,
    tag: str = "split",
    seed: int = SEED,
    names: tuple[str, str] = ("train", "test"),
    output: str = "split",
) -> DataFrame:
    """Exact stratified split: ``bround(fraction * n)`` rows of every class go to the second part.

    The rows themselves are not shuffled. A histogram finds the one cut point per class, and
    each row is compared with it.
    """
    hashed = keyed_hash(F.col("id"), tag=tag, seed=seed)

    def last_of_test(n: Column) -> list[Column]:
        return [F.bround(n * F.lit(float(fraction)), 0)]

    marked = _with_cuts(rows, stratum, hashed, last_of_test)
    in_second = (F.size("cuts") > 0) & (_cuts_before(F.col("cuts"), 1) == 0)
    return marked.withColumn(
        output, F.when(in_second, F.lit(names[1])).otherwise(F.lit(names[0]))
    ).drop("cuts", "n", "_h")


def stratified_folds(
    rows: DataFrame,
    k: int = 5,
    stratum: str = TARGET,
    tag: str = "fold",
    seed: int = SEED,
    output: str = "fold",
) -> DataFrame:
    """Folds ``0..k-1`` whose sizes differ by at most one within every class; no row shuffle."""
    hashed = keyed_hash(F.col("id"), tag=tag, seed=seed)

    def fold_ends(n: Column) -> list[Column]:
        return [F.ceil(n * F.lit(j) / F.lit(float(k))) for j in range(1, k)]

    marked = _with_cuts(rows, stratum, hashed, fold_ends)
    # Classes smaller than k lose coinciding cut points, so the fold is the number of fold
    # ends before the row, counted through the position of the last cut passed.
    passed = _cuts_before(F.col("cuts"), k - 1)
    ends = F.array_distinct(
        F.filter(
            F.array(*[F.ceil(F.col("n") * F.lit(j) / F.lit(float(k))) for j in range(1, k)]), lambda e: e > 0
        )
    )
    rank_floor = F.when(passed > 0, F.element_at(ends, passed)).otherwise(F.lit(0))
    fold = F.floor(rank_floor * F.lit(k) / F.col("n"))
    return marked.withColumn(output, F.coalesce(fold, F.lit(0)).cast("int")).drop("cuts", "n", "_h")


def hash_sample(rows: DataFrame, size: int = 300, tag: str = "sample", seed: int = SEED) -> DataFrame:
    """``min(size, n)`` rows without replacement: the smallest keyed hashes, without a full sort."""
    hashed = keyed_hash(F.col("id"), tag=tag, seed=seed)
    return rows.orderBy(hashed, F.col("id")).limit(size)


def permuted_donors(
    rows: DataFrame, columns: list[str], repeats: int = 5, tag: str = "permute", seed: int = SEED
) -> DataFrame:
    """For each repeat a random permutation of the rows: ``(repeat, id, donor_<column>…)``.

    Row at rank r of one keyed-hash order receives the values of the row at rank r of a second
    one. Ranks are exact and every sort covers a small hash bucket.
    """
    base = ranked_by_hash(rows.select("id"), [], keyed_hash(F.col("id"), tag=tag, seed=seed))
    copies = rows.select("id", *columns).withColumn("repeat", F.explode(F.array(*[F.lit(r) for r in range(repeats)])))
    donors = ranked_by_hash(
        copies, ["repeat"], keyed_hash(F.col("id"), F.col("repeat"), tag=tag, seed=seed)
    ).select("repeat", "rank", *[F.col(c).alias(f"donor_{c}") for c in columns])
    return base.join(donors, "rank").drop("rank")
