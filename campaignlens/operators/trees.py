"""Decision trees and forests grown level by level, all trees, folds and settings side by side.

Every training row carries its node in every tree. A level is three joins and groupings over all of them: class sums per (tree, node,
feature, value), running sums over the values in order, the best cut of each node, and the rows' step to the children. Held-out rows
walk along with weight zero and pick up the share of responders where a setting stops: at its depth, in a node with fewer
rows than its least split, or in a leaf. As a setting only stops a tree earlier, one tree per criterion (and one forest) serves
the whole grid, and a forest of fewer trees is the beginning of a longer one.

Semantics: cuts lie in the middle between neighbouring values of the node; a pure node, or one whose values are all equal, is a
leaf; an impure node is cut even if nothing is gained. Equal gains (to nine digits) go to the first feature and lowest cut. A forest's tree
draws Poisson(1) weights from the hash of (id, tree) and a node draws its features from the hash of (tree, path): a few at a
time, further ones if all values of the drawn ones are equal. Depth isn't limited unless a setting does so.

Scale: sums are combined where the rows are, so a root's hot key is no more than its distinct values, at most ``MOST_VALUES`` per feature
(beyond them, values are raised to the next quantile). Each level is a written table; only node tables are joined back, by key.
Forests that are only scored grow whole in tasks if every fit is small enough for one (:mod:`campaignlens.operators.forests`).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from campaignlens.functions.hashing import keyed_hash, poisson_weight
from campaignlens.operators import forests
from campaignlens.settings import TARGET, TRANSFORMED_FEATURES
from campaignlens.sources.store import durable

MOST_VALUES = 65_536
FOREST_FEATURES = 3  # the root of eleven columns, rounded down
TREE = ["fit", "criterion", "tree"]
_GAIN_DIGITS = 9


@dataclass(frozen=True)
class Stop:
    """A setting's limits: depth (None for no limit) and the least number of rows of a node that is cut."""

    depth: int | None
    least_split: int = 2


def training_rows(data: DataFrame, criteria: Sequence[str] = ("gini",), trees: int = 0) -> DataFrame:
    """Rows at the roots: ``(fit, criterion, tree, id, y, w, x)``.

    ``data`` has model columns in the scale of ``fit``, and ``w`` (0 for rows that are only scored). ``trees`` > 0 asks for a forest:
    each training row gets its bootstrap weight in every tree.
    """
    x = F.array(*[F.col(f"`{c}`") for c in TRANSFORMED_FEATURES]).alias("x")
    rows = data.select("fit", "id", F.col(TARGET).cast("int").alias("y"), F.col("w").cast("double").alias("w"), x)
    rows = rows.withColumn("criterion", F.explode(F.array(*[F.lit(c) for c in criteria])))
    if not trees:
        return rows.withColumn("tree", F.lit(0))
    rows = rows.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
    draw = poisson_weight(keyed_hash(F.col("id"), F.col("tree"), tag="forest")).cast("double")
    return rows.withColumn("drawn", draw).where("w = 0 OR drawn > 0").withColumn("w", F.col("w") * F.col("drawn")).drop("drawn")


def _purity(n: Column, n1: Column, entropy: Column) -> Column:
    """Rows times purity; grows when a node is cut."""
    n0 = n - n1
    squares = (n1 * n1 + n0 * n0) / n
    logs = sum(F.when(k > 0, k * F.log2(k / n)).otherwise(0.0) for k in (n1, n0))
    return F.when(entropy, logs).otherwise(squares)


def _drawn(features: int | None) -> Column:
    """Numbers of the features that a node tries at this attempt."""
    every = len(TRANSFORMED_FEATURES)
    if features is None:
        return F.sequence(F.lit(0), F.lit(every - 1))
    orders = ["array(" + ", ".join(map(str, order)) + ")" for order in forests.feature_orders(every)]
    order = F.element_at(F.expr("array(" + ", ".join(orders) + ")"), (F.pmod(F.xxhash64(*TREE, "path"), F.lit(len(orders))) + 1).cast("int"))
    return F.slice(order, F.col("attempt") * features + 1, features)


def best_cuts(rows: DataFrame, features: int | None = None) -> DataFrame:
    """One row per node of ``rows``: rows ``n``, responders ``n1``, and the best cut, if any (``feature``, ``threshold``, ``gain``)."""
    node = [*TREE, "path"]
    tried = rows.where("w > 0").withColumn("f", F.explode(_drawn(features)))
    cells = tried.groupBy(*node, "depth", "attempt", "f", F.col("x")[F.col("f")].alias("v")).agg(
        F.sum("w").alias("n"), F.sum(F.col("w") * F.col("y")).alias("n1")
    )
    over = f"OVER (PARTITION BY {', '.join(node)}, f"
    running = cells.selectExpr(
        *node, "depth", "attempt", "f", "v",
        f"sum(n) {over} ORDER BY v) AS nl", f"sum(n1) {over} ORDER BY v) AS nl1", f"lead(v) {over} ORDER BY v) AS next",
        f"sum(n) {over}) AS n", f"sum(n1) {over}) AS n1",
    )
    entropy = F.col("criterion") == "entropy"
    n, n1, nl, nl1 = (F.col(c) for c in ("n", "n1", "nl", "nl1"))
    gain = _purity(nl, nl1, entropy) + _purity(n - nl, n1 - nl1, entropy) - _purity(n, n1, entropy)
    cut = F.struct((-F.round(gain, _GAIN_DIGITS)).alias("loss"), "f", "v", "next", gain.alias("gain"))
    found = running.groupBy(*node, "depth", "attempt", "n", "n1").agg(F.min(F.when(F.col("next").isNotNull(), cut)).alias("cut"))
    return found.select(
        *node, "depth", "attempt", "n", "n1", F.col("cut.f").alias("feature"),
        ((F.col("cut.v") + F.col("cut.next")) / 2).alias("threshold"), F.col("cut.gain").alias("gain"),
    )


def grow(rows: DataFrame, stops: Sequence[Stop], features: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Grows all trees of :func:`training_rows`.

    Returns the nodes ``(fit, criterion, tree, path, depth, n, n1, feature, threshold, gain)`` and, for rows of weight zero,
    ``(fit, criterion, tree, id, y, p)`` with one share of responders per stop.
    """
    deepest = None if any(s.depth is None for s in stops) else max(s.depth for s in stops)
    least = min(s.least_split for s in stops)
    tries = 1 if features is None else -(-len(TRANSFORMED_FEATURES) // features)
    node = [*TREE, "path"]
    limits = F.array(*[F.struct(F.lit(s.depth).cast("int").alias("depth"), F.lit(s.least_split).alias("least")) for s in stops])
    active = rows.withColumns({
        "path": F.lit(""), "depth": F.lit(0), "attempt": F.lit(0),
        "p": F.array_repeat(F.lit(None).cast("double"), len(stops)),
    })
    levels, finished = [], []
    while True:
        cuts = durable(best_cuts(active, features))
        if cuts.isEmpty():
            break
        last = (F.col("n1") == 0) | (F.col("n1") == F.col("n")) | (F.col("n") < least)
        if deepest is not None:
            last = last | (F.col("depth") >= deepest)
        again = F.col("feature").isNull() & (F.col("attempt") + 1 < tries)
        marked = cuts.withColumn("leaf", last | (F.col("feature").isNull() & ~again))
        uncut = F.col("leaf") | F.col("feature").isNull()
        settled = marked.where("leaf OR feature IS NOT NULL")
        shown = [F.when(~uncut, F.col(c)).alias(c) for c in ("feature", "threshold", "gain")]
        levels.append(settled.select(*node, "depth", "n", "n1", *shown))
        joined = active.join(marked.drop("depth", "attempt"), node)
        share = F.col("n1") / F.col("n")
        reached = F.transform(
            F.arrays_zip("p", limits.alias("s")),
            lambda v: F.when(
                v["p"].isNull() & (F.col("leaf") | (v["s"]["depth"] <= F.col("depth")) | (F.col("n") < v["s"]["least"])), share
            ).otherwise(v["p"]),
        )
        side = F.when(F.element_at("x", F.col("feature") + 1) <= F.col("threshold"), "L").otherwise("R")
        moved = joined.withColumn("p", F.when(F.col("w") == 0, reached).otherwise(F.col("p")))
        # a held-out row is done when every setting has stopped; training rows go on until their node is a leaf
        ended = F.col("leaf") | ((F.col("w") == 0) & F.forall("p", lambda v: v.isNotNull()))
        stepped = moved.where("w = 0 OR NOT leaf").select(
            *TREE, "id", "y", "w", "x",
            F.when(uncut, F.col("path")).otherwise(F.concat("path", side)).alias("path"),
            F.when(uncut, F.col("depth")).otherwise(F.col("depth") + 1).alias("depth"),
            F.when(uncut, F.col("attempt") + 1).otherwise(0).alias("attempt"),
            "p", ended.alias("ended"),
        )
        stored = durable(stepped)
        finished.append(stored.where("ended").select(*TREE, "id", "y", "p"))
        active = stored.where("NOT ended").drop("ended")
    return _stacked(levels, node + ["depth", "n", "n1", "feature", "threshold", "gain"]), _stacked(finished, [*TREE, "id", "y", "p"])


def _stacked(parts: Sequence[DataFrame], columns: Sequence[str]) -> DataFrame:
    whole = parts[0].select(*columns)
    for part in parts[1:]:
        whole = whole.union(part.select(*columns))
    return whole


def named_nodes(nodes: DataFrame) -> DataFrame:
    """Nodes with the name of their feature instead of its number."""
    names = F.array(*[F.lit(c) for c in TRANSFORMED_FEATURES])
    return nodes.withColumn("feature", F.when(F.col("feature").isNotNull(), F.element_at(names, F.col("feature") + 1)))


def impurity_importances(nodes: DataFrame) -> DataFrame:
    """``(feature, importance)``: what each feature's cuts gain, as shares per tree, averaged over trees; sums to one."""
    gains = named_nodes(nodes).where("feature IS NOT NULL").groupBy(*TREE, "feature").agg(F.sum("gain").alias("gain"))
    per_tree = gains.groupBy(*TREE).agg(F.sum("gain").alias("whole")).where("whole > 0")
    shares = gains.join(per_tree, TREE).groupBy("feature").agg(F.sum(F.col("gain") / F.col("whole")).alias("share"))
    every = nodes.sparkSession.createDataFrame([(c,) for c in TRANSFORMED_FEATURES], "feature string").join(shares, "feature", "left")
    total = shares.agg(F.sum("share").alias("total"))  # one row
    every = every.join(F.broadcast(total), F.lit(True), "left")
    return every.select("feature", F.coalesce(F.col("share") / F.col("total"), F.lit(0.0)).alias("importance"))


def _fits(train: DataFrame, held: DataFrame) -> DataFrame:
    columns = ["fit", "id", TARGET, *[f"`{c}`" for c in TRANSFORMED_FEATURES]]
    return train.select(*columns, F.lit(1.0).alias("w")).union(held.select(*columns, F.lit(0.0).alias("w")))


def tree_grid_scores(train: DataFrame, held: DataFrame, grid: Sequence[Mapping[str, object]]) -> DataFrame:
    """``(position, fold, id, y, p)`` of held-out rows under every decision-tree setting."""
    stops = [Stop(p["max_depth"], p.get("min_samples_split", 2)) for p in grid]
    distinct = list(dict.fromkeys(stops))
    criteria = list(dict.fromkeys(p.get("criterion", "gini") for p in grid))
    _, scores = grow(training_rows(_fits(train, held), criteria), distinct)
    settings = F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(p.get("criterion", "gini")).alias("of"), F.lit(distinct.index(s) + 1).alias("at"))
        for i, (p, s) in enumerate(zip(grid, stops, strict=True))
    ])
    spread = scores.withColumn("s", F.explode(F.filter(settings, lambda s: s["of"] == F.col("criterion"))))
    return spread.select("s.position", F.col("fit").alias("fold"), "id", "y", F.element_at("p", F.col("s.at")).alias("p"))


def forest_grid_scores(train: DataFrame, held: DataFrame, grid: Sequence[Mapping[str, object]]) -> DataFrame:
    """``(position, fold, id, y, p)`` of held-out rows under every forest setting: mean share over its trees."""
    stops = [Stop(p.get("max_depth"), p.get("min_samples_split", 2)) for p in grid]
    distinct, sizes = list(dict.fromkeys(stops)), [int(p["n_estimators"]) for p in grid]
    fits = _fits(train, held)
    rows = training_rows(fits).drop("criterion", "tree")
    found = forests.fit_sizes(rows)
    if found and all(n <= forests.WHOLE_ROWS and not odd for _, _, n, odd in found):
        limits, steps = [(s.depth, s.least_split) for s in distinct], sorted(set(sizes))
        sums = forests.held_out_sums(rows, [(fit, hashed) for fit, hashed, _, _ in found], limits, sizes, FOREST_FEATURES)
        means = []
        for i, (s, size) in enumerate(zip(stops, sizes, strict=True)):
            upto = range(steps.index(size) + 1)
            grown = sum((F.col("counts")[k] for k in upto), F.lit(0))
            share = sum((F.col("sums")[k * len(distinct) + distinct.index(s)] for k in upto), F.lit(0))
            means.append(F.when(grown > 0, share / F.lit(float(forests.UNIT)) / grown).alias(f"p{i}"))
        wide = sums.select("fit", "id", "y", *means)
    else:
        _, scores = grow(training_rows(fits, trees=max(sizes)), distinct, FOREST_FEATURES)
        means = [
            F.avg(F.when(F.col("tree") < size, F.element_at("p", distinct.index(s) + 1))).alias(f"p{i}")
            for i, (s, size) in enumerate(zip(stops, sizes, strict=True))
        ]
        wide = scores.groupBy("fit", "id", "y").agg(*means)
    settings = F.array(*[F.struct(F.lit(i).alias("position"), F.col(f"p{i}").alias("p")) for i in range(len(stops))])
    return wide.withColumn("s", F.explode(settings)).select("s.position", F.col("fit").alias("fold"), "id", "y", "s.p")
