"""Running sums, ranks and positions over large ordered sets without a single-task sort.

A plain ``Window.orderBy`` over a whole model or class puts every row in one task. Here the
order is cut into nested *levels* (for a score: 18 leading bits, the next 18 bits, the exact
score, a hash bucket). Totals per level are small; a running sum over them gives every bucket
its offset, and only the rows inside one finest bucket are ever sorted together. The result is
exact, needs no sampling and does not depend on how the input is partitioned. Many equal
scores are no problem: ties are spread over 65,536 hash buckets.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from campaignlens.functions.hashing import hash_bucket, keyed_hash

LEVEL_BITS = 18
SMALL_DOMAIN_DIGITS = 5


@dataclass(frozen=True)
class Level:
    """One cut of the order: a column and its direction."""

    name: str
    descending: bool = False

    def order(self) -> Column:
        return F.col(self.name).desc() if self.descending else F.col(self.name).asc()


def unit_levels(value: Column, prefix: str, descending: bool) -> tuple[dict[str, Column], list[Level]]:
    """Two nested cuts of a number in [0, 1]; scaling by powers of two is exact."""
    scaled = value * F.lit(float(1 << LEVEL_BITS))
    coarse = F.floor(scaled)
    fine = F.floor((scaled - coarse) * F.lit(float(1 << LEVEL_BITS)))
    names = (f"{prefix}_c", f"{prefix}_f")
    return dict(zip(names, (coarse, fine))), [Level(n, descending) for n in names]


def real_levels(value: Column, prefix: str, descending: bool = False) -> tuple[dict[str, Column], list[Level]]:
    """Two nested cuts of any finite double, through a monotone logarithmic scale."""
    scaled = F.signum(value) * F.log1p(F.abs(value)) * F.lit(256.0)
    coarse = F.floor(scaled)
    fine = F.floor((scaled - coarse) * F.lit(float(1 << LEVEL_BITS)))
    names = (f"{prefix}_c", f"{prefix}_f")
    return dict(zip(names, (coarse, fine))), [Level(n, descending) for n in names]


def running_sums(
    rows: DataFrame,
    keys: Sequence[str],
    levels: Sequence[Level],
    order: Sequence[Column],
    sums: Mapping[str, str],
    keep: Callable[[Column, Column, Column], Column] | None = None,
    keep_on: str | None = None,
) -> DataFrame:
    """Add ``run_<name>`` (inclusive running sum) and ``all_<name>`` (total per key) for each of ``sums``.

    ``sums`` maps a result name to the column that is added up. ``keep(before, upto, total)``
    receives the running sum before and after a bucket and the grand total for ``keep_on``;
    buckets for which it is false are dropped before any of their rows is sorted, which turns
    the full ranking into a selection of a few positions. At most one bucket per key and wanted
    position is kept, so the table of kept buckets is broadcast and no other row is shuffled.

    Rows with a missing key or level are left out, in every branch of the plan alike, so that
    the branches can share their shuffles.
    """
    keys, names = list(keys), [lv.name for lv in levels]
    if levels:
        for name in keys + names:
            rows = rows.where(F.col(name).isNotNull())
    few = F.broadcast if keep is not None else (lambda part: part)

    def added_up(source: DataFrame, depth: int) -> DataFrame:
        return source.groupBy(*keys, *names[:depth]).agg(*[F.sum(column).alias(column) for column in sums.values()])

    totals: dict[int, DataFrame] = {}
    if keep is not None and len(levels) > 1:
        # Coarse to fine: a histogram of the first level, combined where the rows are, tells which of its
        # buckets matter; only their rows are grouped by the finer levels.
        totals[1] = added_up(rows, 1)
        coarse = Window.partitionBy(*keys)
        upto = F.sum(sums[keep_on]).over(coarse.orderBy(levels[0].order()).rowsBetween(Window.unboundedPreceding, 0))
        wanted = totals[1].select(
            *keys, names[0], upto.alias("_upto"), F.col(sums[keep_on]).alias("_size"), F.sum(sums[keep_on]).over(coarse).alias("_whole")
        ).where(keep(F.col("_upto") - F.col("_size"), F.col("_upto"), F.col("_whole")))
        rows = rows.join(F.broadcast(wanted.select(*keys, names[0])), [*keys, names[0]], "left_semi")
    level_rows = rows
    for depth in range(len(levels), len(totals), -1):
        level_rows = added_up(level_rows, depth)
        totals[depth] = level_rows

    offsets: DataFrame | None = None
    for depth in range(1, len(levels) + 1):
        path = keys + names[: depth - 1]
        frame = Window.partitionBy(*path).orderBy(levels[depth - 1].order())
        upto = {n: F.sum(c).over(frame.rowsBetween(Window.unboundedPreceding, 0)) for n, c in sums.items()}
        part = totals[depth].select(
            *keys,
            *names[:depth],
            *[F.col(c).alias(f"_size_{n}") for n, c in sums.items()],
            *[(upto[n] - F.col(c)).alias(f"_in_{n}") for n, c in sums.items()],
            *(
                [F.sum(c).over(Window.partitionBy(*path)).alias(f"_all_{n}") for n, c in sums.items()]
                if offsets is None
                else []
            ),
        )
        if offsets is not None:
            part = part.join(few(offsets), path)
        before = {n: F.col(f"_in_{n}") + F.col(f"_before_{n}") if offsets is not None else F.col(f"_in_{n}") for n in sums}
        part = part.select(
            *keys,
            *names[:depth],
            *[F.col(f"_size_{n}") for n in sums],
            *[before[n].alias(f"_before_{n}") for n in sums],
            *[F.col(f"_all_{n}") for n in sums],
        )
        if keep is not None:
            at = F.col(f"_before_{keep_on}")
            part = part.where(keep(at, at + F.col(f"_size_{keep_on}"), F.col(f"_all_{keep_on}")))
        offsets = part.drop(*[f"_size_{n}" for n in sums])

    path = keys + names
    leaf = rows if offsets is None else rows.join(few(offsets), path)
    frame = Window.partitionBy(*path)
    inside = frame.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    added: dict[str, Column] = {}
    for n, c in sums.items():
        run = F.sum(c).over(inside)
        added[f"run_{n}"] = run if offsets is None else run + F.col(f"_before_{n}")
        added[f"all_{n}"] = F.sum(c).over(frame) if offsets is None else F.col(f"_all_{n}")
    return leaf.withColumns(added).drop(*[f"_{kind}_{n}" for kind in ("before", "all") for n in sums])


def score_groups(
    scored: DataFrame,
    keys: Sequence[str] = ("model",),
    digits: int | None = None,
    label: str = "y",
    weight: Column | None = None,
) -> DataFrame:
    """Positives and negatives per distinct score, with running sums from the highest score down.

    ``digits`` rounds the score first (half-even); with at most five digits the distinct scores
    of one key fit easily into one task and the nested levels are skipped.
    """
    w = F.lit(1).cast("bigint") if weight is None else weight
    p = F.col("p") if digits is None else F.bround("p", digits)
    grouped = (
        scored.withColumn("p", p)
        .groupBy(*keys, "p")
        .agg(
            F.sum(F.when(F.col(label) == 1, w).otherwise(F.lit(0))).alias("pos"),
            F.sum(F.when(F.col(label) == 1, F.lit(0)).otherwise(w)).alias("neg"),
        )
    )
    sums = {"pos": "pos", "neg": "neg"}
    if digits is not None and digits <= SMALL_DOMAIN_DIGITS:
        return running_sums(grouped, keys, [], [F.col("p").desc()], sums)
    columns, levels = unit_levels(F.col("p"), "_p", descending=True)
    grouped = grouped.withColumns(columns)
    return running_sums(grouped, keys, levels, [F.col("p").desc()], sums).drop(*columns)


def _ordered_by_score(scored: DataFrame, digits: int | None) -> tuple[DataFrame, list[Level], list[Column]]:
    """Rows with the levels of the order: score descending, keyed hash, id."""
    rows = scored.withColumn("_h", keyed_hash(F.col("id"), tag="tie")).withColumn("_hb", hash_bucket(F.col("_h")))
    levels = [Level("p", descending=True), Level("_hb")]
    if digits is None or digits > SMALL_DOMAIN_DIGITS:
        columns, cuts = unit_levels(F.col("p"), "_p", descending=True)
        rows, levels = rows.withColumns(columns), cuts + levels
    return rows.withColumn("_one", F.lit(1).cast("bigint")), levels, [F.col("_h"), F.col("id")]


_WORK_COLUMNS = ("_h", "_hb", "_one", "_p_c", "_p_f")


def ranked_by_score(
    scored: DataFrame, keys: Sequence[str] = ("model",), digits: int | None = None, label: str = "y"
) -> DataFrame:
    """Every row with its 1-based position from the highest score down and the positives so far.

    Equal scores are ordered by a keyed hash of the id, so no group of customers is favoured.
    Adds ``run_n``, ``all_n``, ``run_pos``, ``all_pos``.
    """
    rows, levels, order = _ordered_by_score(scored, digits)
    rows = rows.withColumn("_pos", F.col(label).cast("bigint"))
    return running_sums(rows, keys, levels, order, {"n": "_one", "pos": "_pos"}).drop(*_WORK_COLUMNS, "_pos")


def positions_by_score(
    scored: DataFrame,
    positions: Callable[[Column], Sequence[Column]],
    keys: Sequence[str] = ("model",),
    digits: int | None = None,
    label: str = "y",
) -> DataFrame:
    """Only the rows at some 1-based positions, which are given as expressions of the row count.

    Same columns as ``ranked_by_score``, but buckets without a wanted position are never sorted.
    """
    def wanted(before: Column, upto: Column, size: Column) -> Column:
        hit = F.lit(False)
        for position in positions(size):
            hit = hit | ((position > before) & (position <= upto))
        return hit

    rows, levels, order = _ordered_by_score(scored, digits)
    rows = rows.withColumn("_pos", F.col(label).cast("bigint"))
    ranked = running_sums(rows, keys, levels, order, {"n": "_one", "pos": "_pos"}, keep=wanted, keep_on="n")
    at = F.array(*[p.cast("bigint") for p in positions(F.col("all_n"))])
    return ranked.where(F.array_contains(at, F.col("run_n"))).drop(*_WORK_COLUMNS, "_pos")


def ranked_by_hash(rows: DataFrame, keys: Sequence[str], hashed: Column, name: str = "rank") -> DataFrame:
    """Exact 1-based rank in keyed-hash order; every sort covers one of 65,536 even buckets."""
    marked = rows.withColumn("_h", hashed).withColumn("_hb", hash_bucket(F.col("_h")))
    marked = marked.withColumn("_one", F.lit(1).cast("bigint"))
    ranked = running_sums(marked, keys, [Level("_hb")], [F.col("_h"), F.col("id")], {"n": "_one"})
    return ranked.withColumnsRenamed({"run_n": name}).drop("_h", "_hb", "_one", "all_n")


def hash_cuts(
    rows: DataFrame,
    keys: Sequence[str],
    hashed: Column,
    positions: Callable[[Column], Sequence[Column]],
) -> DataFrame:
    """Per key: the ``(hash, id)`` pairs at given positions of the hash order, ascending, and the row count.

    One light histogram pass plus a sort of the few buckets that hold a position. Comparing a
    row with these pairs gives its side of each cut without ranking the row.
    """
    def wanted(before: Column, upto: Column, size: Column) -> Column:
        hit = F.lit(False)
        for position in positions(size):
            hit = hit | ((position > before) & (position <= upto))
        return hit

    marked = rows.select(*keys, "id", hashed.alias("_h")).withColumn("_hb", hash_bucket(F.col("_h")))
    marked = marked.withColumn("_one", F.lit(1).cast("bigint"))
    ranked = running_sums(
        marked, keys, [Level("_hb")], [F.col("_h"), F.col("id")], {"n": "_one"}, keep=wanted, keep_on="n"
    )
    at = F.array(*[p.cast("bigint") for p in positions(F.col("all_n"))])
    return (
        ranked.where(F.array_contains(at, F.col("run_n")))
        .groupBy(*keys)
        .agg(
            F.sort_array(F.collect_list(F.struct(F.col("_h").alias("h"), F.col("id").alias("id")))).alias("cuts"),
            F.first("all_n").alias("n"),
        )
    )
