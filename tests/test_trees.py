"""Trees, forests, boosting and logistic regression against plain NumPy versions."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from campaignlens.operators import boosting, logistic, trees
from campaignlens.operators.prep import fold_statistics
from campaignlens.settings import AGE_GROUPS, NUMERIC_FEATURES, TRANSFORMED_FEATURES
from campaignlens.sources.store import durable

WIDTH = len(TRANSFORMED_FEATURES)


def table(seed: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    x = np.concatenate([rng.normal(size=(n, 3)), rng.integers(0, 4, (n, WIDTH - 5)), rng.integers(0, 2, (n, 2))], axis=1).round(3)
    y = (rng.random(n) < 1 / (1 + np.exp(-(x[:, 0] + x[:, 3] - 2)))).astype(int)
    return x, y


def frame(spark, x, y, fit, w):
    rows = [(int(fit), i, int(t), float(v), *map(float, r)) for i, (r, t, v) in enumerate(zip(x, y, w, strict=True))]
    kinds = "fit int, id long, target int, w double, " + ", ".join(f"`{c}` double" for c in TRANSFORMED_FEATURES)
    return spark.createDataFrame(rows, kinds)


def purity(y: np.ndarray, criterion: str) -> float:
    n1, n = y.sum(), len(y)
    if criterion == "gini":
        return (n1 * n1 + (n - n1) ** 2) / n
    return sum(k * np.log2(k / n) for k in (n1, n - n1) if k)


def plain_tree(x, y, held, criterion, depth, least, at=0):
    """Scores of ``held`` rows by a tree of the stated rules, recursively."""
    if not len(held):
        return np.empty(0)
    n1 = y.sum()
    best = None
    if 0 < n1 < len(y) and len(y) >= least and (depth is None or at < depth):
        for f in range(x.shape[1]):
            values = np.unique(x[:, f])
            for low, high in zip(values[:-1], values[1:], strict=True):
                left = x[:, f] <= (low + high) / 2
                gain = round(purity(y[left], criterion) + purity(y[~left], criterion) - purity(y, criterion), 9)
                if best is None or gain > best[0]:
                    best = (gain, f, (low + high) / 2)
    if best is None:
        return np.full(len(held), n1 / len(y))
    _, f, cut = best
    out = np.empty(len(held))
    for side in (True, False):
        mine, theirs = (x[:, f] <= cut) == side, (held[:, f] <= cut) == side
        out[theirs] = plain_tree(x[mine], y[mine], held[theirs], criterion, depth, least, at + 1)
    return out


def test_every_setting_of_a_tree_equals_a_plain_tree(spark):
    x, y = table(1, 260)
    train, held = slice(0, 200), slice(200, 260)
    data = frame(spark, x, y, 0, np.r_[np.ones(200), np.zeros(60)])
    grid = [{"max_depth": d, "min_samples_split": m, "criterion": c} for d in (2, 4, None) for m in (2, 20) for c in ("gini", "entropy")]
    scores = trees.tree_grid_scores(data.where("w > 0"), data.where("w = 0"), grid).collect()
    assert len(scores) == 60 * len(grid)
    got = {(r["position"], r["id"]): r["p"] for r in scores}
    for position, p in enumerate(grid):
        want = plain_tree(x[train], y[train], x[held], p["criterion"], p["max_depth"], p["min_samples_split"])
        assert [got[position, 200 + i] for i in range(60)] == pytest.approx(want.tolist(), abs=1e-12)


def test_forest_settings_are_beginnings_of_the_longest(spark):
    x, y = table(2, 160)
    data = frame(spark, x, y, 3, np.r_[np.ones(120), np.zeros(40)])
    grid = [{"n_estimators": n, "max_depth": d, "min_samples_split": m} for n in (4, 10) for d in (2, None) for m in (2, 5)]
    scores = trees.forest_grid_scores(data.where("w > 0"), data.where("w = 0"), grid).collect()
    assert len(scores) == 40 * len(grid) and all(0 <= r["p"] <= 1 for r in scores)
    again = trees.forest_grid_scores(data.where("w > 0").repartition(3), data.where("w = 0"), [grid[2]]).collect()
    first = {r["id"]: r["p"] for r in scores if r["position"] == 2}
    assert {r["id"]: r["p"] for r in again} == pytest.approx(first)
    better = {i: np.mean([(r["p"] - r["y"]) ** 2 for r in scores if r["position"] == i]) for i in (4, 5)}
    assert min(better.values()) < np.var(y)


def test_grown_nodes_and_importances(spark):
    x, y = table(3, 120)
    y = (x[:, 0] > 0.2).astype(int)
    rows = trees.training_rows(frame(spark, x, y, 0, np.ones(120)), trees=6)
    nodes, _ = trees.grow(rows, [trees.Stop(None)], features=trees.FOREST_FEATURES)
    counts = {(r["tree"], r["path"]): r for r in nodes.collect()}
    for (tree, path), r in counts.items():
        if r["feature"] is not None:  # children share out the node's rows
            children = [counts[tree, path + side] for side in "LR"]
            assert r["n"] == sum(c["n"] for c in children) and r["n1"] == sum(c["n1"] for c in children)
        else:  # unlimited depth ends in pure nodes, as all rows differ
            assert r["n1"] in (0, r["n"])
    shares = {r["feature"]: r["importance"] for r in trees.impurity_importances(nodes).collect()}
    assert set(shares) == set(TRANSFORMED_FEATURES) and sum(shares.values()) == pytest.approx(1.0)
    assert max(shares, key=shares.get) == TRANSFORMED_FEATURES[0]


def test_impure_copies_end_in_a_leaf(spark):
    x, y = np.ones((9, WIDTH)), np.array([0, 1, 1] * 3)
    nodes, scores = trees.grow(trees.training_rows(frame(spark, x, y, 0, np.r_[np.ones(8), 0])), [trees.Stop(None), trees.Stop(2, 50)])
    assert [(r["path"], r["n"], r["feature"]) for r in nodes.collect()] == [("", 8.0, None)]
    assert [tuple(r["p"]) for r in scores.collect()] == [(5 / 8, 5 / 8)]


def customers(spark, seed: int, n: int):
    x, y = table(seed, n)
    rng = np.random.default_rng(seed)
    rows = [
        (i, None if rng.random() < 0.05 else AGE_GROUPS[rng.integers(5)], *[None if rng.random() < 0.03 else float(v) for v in x[i, : len(NUMERIC_FEATURES)]], int(y[i]), int(i % 3))
        for i in range(n)
    ]
    kinds = "id long, age_group string, " + ", ".join(f"{c} double" for c in NUMERIC_FEATURES) + ", target int, fold int"
    return spark.createDataFrame(rows, kinds)


def plain_boosting(x, y, held, rate, depth, trees_wanted):
    """Gradient boosting by the stated rules, one tree after the other."""
    start = np.log(y.mean() / (1 - y.mean()))
    scores, out = np.full(len(y), start), np.full(len(held), start)

    def grow(rows, theirs, gradient, bend, level):
        best = None
        if level < depth and len(rows) > 1:
            for f in range(x.shape[1]):
                values = np.unique(x[rows, f])
                for low, high in zip(values[:-1], values[1:], strict=True):
                    left = x[rows, f] <= (low + high) / 2
                    n_l, n_r = left.sum(), (~left).sum()
                    gap = gradient[rows][left].sum() / n_l - gradient[rows][~left].sum() / n_r
                    worth = round(n_l * n_r / (n_l + n_r) * gap**2, 9)
                    if worth > 1e-9 and (best is None or worth > best[0]):
                        best = (worth, f, (low + high) / 2)
        if best is None:
            value = gradient[rows].sum() / bend[rows].sum()
            scores[rows] += rate * value
            out[theirs] += rate * value
            return
        _, f, cut = best
        for side in (True, False):
            grow(rows[(x[rows, f] <= cut) == side], theirs[(held[theirs, f] <= cut) == side], gradient, bend, level + 1)

    for _ in range(trees_wanted):
        p = 1 / (1 + np.exp(-scores))
        grow(np.arange(len(y)), np.arange(len(held)), y - p, p * (1 - p), 0)
    return 1 / (1 + np.exp(-out))


def test_boosting_equals_plain_boosting(spark, monkeypatch):
    monkeypatch.setattr(boosting, "_TREES_PER_TABLE", 3)
    rows = customers(spark, 5, 240)
    statistics = fold_statistics(rows, range(3))
    grid = [{"n_estimators": n, "learning_rate": r, "max_depth": d} for n in (2, 7) for r in (0.1, 0.3) for d in (2, 3)]
    scores = boosting.grid_scores(rows, statistics, grid, k=3, bins=1000).collect()
    assert len(scores) == 240 * len(grid)
    got = {(r["position"], r["id"]): r["p"] for r in scores}
    stats = {r["fit"]: r for r in statistics.collect()}
    data = rows.orderBy("id").collect()
    y, fold = np.array([r["target"] for r in data]), np.array([r["fold"] for r in data])
    for k in range(3):
        s = stats[k]
        x = np.array([
            [s[f"{c}_median"] if r[c] is None else r[c] for c in NUMERIC_FEATURES]
            + [float((r["age_group"] or s["age_group_mode"]) == g) for g in AGE_GROUPS[1:]]
            for r in data
        ])
        for position in (1, 6):
            p = grid[position]
            want = plain_boosting(x[fold != k], y[fold != k], x[fold == k], p["learning_rate"], p["max_depth"], p["n_estimators"])
            assert [got[position, i] for i in np.flatnonzero(fold == k)] == pytest.approx(want.tolist(), abs=1e-9)


def test_best_cuts_add_up_repeated_cells():
    offsets = np.array([0, 3, 5])
    cells = [(0, 1, 0, 2, -1.0), (0, 1, 2, 2, 1.0), (0, 1, 3, 4, 0.0), (0, 1, 0, 1, -0.5), (0, 1, 1, 1, -0.2), (0, 1, 3, 2, 0.3)]
    fit, node, cell, n, g = (np.array(c) for c in zip(*cells, strict=True))
    found = boosting.best_cuts(fit, node, cell, np.stack([n, g, n / 4], axis=1), offsets)
    assert (found["feature"].tolist(), found["bin"].tolist(), found["next"].tolist()) == ([0], [1], [2])
    assert found["sides"][0].tolist() == pytest.approx([4, -1.7, 1.0, 2, 1.0, 0.5])


def test_boosting_of_one_class_and_wide_bins(spark):
    rows = customers(spark, 6, 90).withColumn("target", F.lit(1))
    scores = boosting.grid_scores(rows, fold_statistics(rows, range(3)), [{"n_estimators": 2, "learning_rate": 0.1, "max_depth": 3}], k=3, bins=4)
    assert scores.where("p < 0.999").isEmpty() and scores.count() == 90


def test_logits_reach_a_zero_gradient(spark):
    x, y = table(8, 300)
    x[:, 9] = 1.0  # a constant column repeats the intercept
    data = durable(frame(spark, x, y, 0, np.ones(300)).withColumn("fold", F.col("id") % 2))
    found = logistic.fit_logits(data, TRANSFORMED_FEATURES, [0.01, 1.0, 100.0], label="target", fit="fold")
    assert len(found) == 6 and max(m.gradient for m in found) < 1e-8
    for m in found:
        mine = np.arange(300) % 2 == m.fit
        p = 1 / (1 + np.exp(-(m.intercept + x[mine] @ np.array(m.coefficients))))
        gradient = m.strength * (p - y[mine]) @ x[mine] + np.array(m.coefficients)
        assert np.abs(gradient).max() < 1e-5 * m.strength * 300 and abs((p - y[mine]).sum()) < 1e-5 * 300


def test_logit_of_separable_and_fractional_targets(spark):
    rows = durable(spark.createDataFrame([(0.1, 0.25, 4.0), (0.5, 0.5, 2.0), (0.9, 0.75, 4.0)], "p double, y double, n double"))
    (m,) = logistic.fit_logits(rows, ["p"], weight="n")
    assert m.intercept + 0.5 * m.coefficients[0] == pytest.approx(0.0, abs=1e-7)
    assert 1 / (1 + np.exp(-(m.intercept + 0.9 * m.coefficients[0]))) == pytest.approx(0.75, abs=1e-6)
    apart = durable(spark.createDataFrame([(float(i), int(i > 4)) for i in range(10)], "a double, y int"))
    (m,) = logistic.fit_logits(apart, ["a"], [1.0])
    assert m.coefficients[0] > 0.5 and m.gradient < 1e-8


def test_exact_attributions_equal_all_orders(spark):
    """Averages of marginal gains over every order of the features, background row by background row."""
    from itertools import permutations

    from campaignlens.operators import explain

    rng = np.random.default_rng(4)
    names = ["a", "b", "c"]
    base = [(i, *map(float, rng.integers(0, 3, 3))) for i in range(12)]
    rows = [(i, *map(float, rng.integers(0, 5, 3))) for i in range(4)]
    kinds = "id long, a double, b double, c double"
    score = lambda df: df.withColumn("p", F.col("a") * F.col("b") + F.sqrt(F.col("c")))
    plain = lambda x: x[0] * x[1] + np.sqrt(x[2])
    found = explain.exact_shapley_values(score, spark.createDataFrame(rows, kinds), spark.createDataFrame(base, kinds), names)
    got = {(r["id"], r["feature"]): r["phi"] for r in found.collect()}
    assert len(got) == 12
    for i, *x in rows:
        gains = {n: [] for n in names}
        for _, *b in base:
            for order in permutations(range(3)):
                now = list(b)
                for f in order:
                    before = plain(now)
                    now[f] = x[f]
                    gains[names[f]].append(plain(now) - before)
        for n in names:
            assert got[i, n] == pytest.approx(np.mean(gains[n]), abs=1e-12)
    empty = explain.exact_shapley_values(score, spark.createDataFrame(rows, kinds).limit(0), spark.createDataFrame(base, kinds), names)
    assert empty.isEmpty()


def test_figures_are_looked_up_in_their_own_documents(spark, tmp_path):
    from campaignlens.operators import checks

    for name, line in (("first run", "profit,$1,234.00"), ("second", "profit,$99.00")):
        spark.createDataFrame([(line,)], "line string").write.text(str(tmp_path / "out" / name / "table"))
    expected = [("first run", "profit", "$1,234.00"), ("first run", "other", "$99.00"), ("second", "profit", "$99.00"), ("third", "any", "x")]
    absent = checks.absent_figures(spark.createDataFrame(expected, "document string, label string, value string"), str(tmp_path / "out"))
    assert {tuple(r) for r in absent.collect()} == {("first run", "other", "$99.00"), ("third", "any", "x")}


def test_widths_and_types(spark):
    from pyspark.ml.functions import array_to_vector

    from campaignlens.operators import checks, exploration

    rows = spark.createDataFrame([([0.0] * WIDTH,), ([0.0] * 3,)], "x array<double>").withColumn("features", array_to_vector("x"))
    assert checks.width_check(rows).first().asDict() == {"rows": 2, "wrong": 1, "ok": False}
    types = exploration.column_types(spark.createDataFrame([], "id bigint, name string"))
    assert [tuple(r) for r in types.orderBy("position").collect()] == [(0, "id", "bigint"), (1, "name", "string")]


def test_hashes_of_arrays_equal_the_engine(spark):
    from campaignlens.functions.hashing import xxhash64_bytes, xxhash64_int

    paths = ["", "L", "LRLR", "LRLRL", "LLRRLRLR", "LRLRLRLRLRLRLRR", "R" * 31, "LR" * 16, "LRR" * 25]
    rows = spark.createDataFrame([(f, t, p) for f in (0, 4) for t in (0, 149) for p in paths], "fit int, tree int, path string")
    hashed = rows.select("*", F.xxhash64("fit", F.lit("gini")).alias("seed"), F.xxhash64("fit", F.lit("gini"), "tree", "path").alias("hash"))
    for r in hashed.collect():
        seed = xxhash64_int(np.array([r["tree"]]), np.array([r["seed"]]).view(np.uint64))
        texts = np.frombuffer((r["path"] * 2).encode(), np.uint8).reshape(2, -1) if r["path"] else np.zeros((2, 0), np.uint8)
        assert xxhash64_bytes(texts, seed[0]).view(np.int64).tolist() == [r["hash"]] * 2


def test_whole_forests_equal_forests_by_level(spark, monkeypatch):
    """Two fits; many equal values, so that nodes draw constant features; copies of one row under both labels, ids that repeat."""
    from campaignlens.operators import forests

    x, y = table(12, 120)
    x = np.concatenate([x[:, :2].round(1), np.ones((120, 5)), x[:, 7:]], axis=1)
    x[85:95], x[40:50] = x[0], x[0]
    data = frame(spark, x, y, 0, np.r_[np.ones(90), np.zeros(30)]).union(frame(spark, x[::-1] * 1.5, y[::-1], 1, np.r_[np.ones(80), np.zeros(40)]))
    data = data.union(data.where("id < 5 OR id > 115"))
    grid = [{"n_estimators": n, "max_depth": d, "min_samples_split": m} for n in (2, 4) for d in (2, None) for m in (2, 5)]
    run = lambda: {(r["position"], r["fold"], r["id"], r["y"]): r["p"] for r in trees.forest_grid_scores(data.where("w > 0"), data.where("w = 0"), grid).collect()}
    found = run()
    monkeypatch.setattr(forests, "WHOLE_ROWS", 0)
    assert found == pytest.approx(run(), abs=1e-12) and len(found) == 70 * len(grid)


def jobs_of(spark, name: str, rows) -> int:
    """Number of jobs that ``rows()`` takes until it is collected."""
    spark.sparkContext.setJobGroup(name, name)
    rows().collect()
    spark.sparkContext.setJobGroup("", "")
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))


def test_a_forest_takes_a_job_or_two_not_some_a_level(spark):
    x, y = table(13, 200)
    data = durable(frame(spark, x, y, 0, np.r_[np.ones(150), np.zeros(50)]))
    grid = [{"n_estimators": 10, "max_depth": None}]
    assert 0 < jobs_of(spark, "forest", lambda: trees.forest_grid_scores(data.where("w > 0"), data.where("w = 0"), grid)) < 10


def test_whole_ensembles_equal_ensembles_by_level(spark, monkeypatch):
    rows = durable(customers(spark, 7, 150))
    statistics = durable(fold_statistics(rows, range(3)))
    grid = [{"n_estimators": n, "learning_rate": r, "max_depth": d} for r in (0.1, 0.4) for d in (2, 4) for n in (3, 1)]
    run = lambda: {(r["position"], r["fold"], r["id"], r["y"]): r["p"] for r in boosting.grid_scores(rows, statistics, grid, k=3, bins=12).collect()}
    found = run()
    monkeypatch.setattr(boosting, "WHOLE_ROWS", 0)
    assert found == pytest.approx(run(), abs=1e-12) and len(found) == 150 * len(grid)


def test_more_trees_and_levels_take_no_more_jobs(spark):
    rows = durable(customers(spark, 9, 120))
    statistics = durable(fold_statistics(rows, range(3)))
    one, many = ([{"n_estimators": n, "learning_rate": 0.1, "max_depth": d}] for n, d in ((1, 1), (12, 4)))
    few = jobs_of(spark, "one tree", lambda: boosting.grid_scores(rows, statistics, one, k=3))
    assert few == jobs_of(spark, "many trees", lambda: boosting.grid_scores(rows, statistics, many, k=3))


def test_the_published_forests_take_a_few_jobs(spark):
    """All 24 settings: 150 trees of any depth, and shallow ones that end before them."""
    from campaignlens.operators.classifiers import grid

    x, y = table(14, 90)
    data = durable(frame(spark, x, y, 2, np.r_[np.ones(70), np.zeros(20)]))
    settings, found = list(grid("Random Forest")), []

    def scores():
        found.append(durable(trees.forest_grid_scores(data.where("w > 0"), data.where("w = 0"), settings)))
        return found[0]

    assert 0 < jobs_of(spark, "published", scores) < 12
    assert found[0].where("p BETWEEN 0 AND 1").groupBy("position").count().where("count = 20").count() == len(settings) == 24


def test_additive_attributions_equal_those_of_scored_rows(spark):
    """The scorecard on arrays against the same scorecard on rows, whose values are missing, equal, or share an id."""
    from campaignlens.operators import explain
    from campaignlens.operators.scorecard import INTERCEPT, score_curve, score_terms, scorecard
    from campaignlens.settings import FEATURES

    rows = customers(spark, 15, 40)
    rows = rows.union(rows.where("id < 3").withColumn("income", F.lit(90000.0))).union(rows.where("id = 5")).withColumn("income", F.col("income") * 1e5)
    background = customers(spark, 16, 60).union(customers(spark, 16, 60).where("id < 20"))
    score = lambda df: df.withColumn("p", scorecard())

    def absent(df):
        raise AssertionError("no row is scored by itself")

    card = explain.AdditiveScore(absent, INTERCEPT, score_terms, score_curve)
    found = {(r["id"], r["feature"]): r["phi"] for r in explain.exact_shapley_values(card, rows, background).collect()}
    plain = {(r["id"], r["feature"]): r["phi"] for r in explain.exact_shapley_values(score, rows, background).collect()}
    assert len(found) == 40 * len(FEATURES) and found == pytest.approx(plain, abs=1e-12)
    assert explain.exact_shapley_values(card, rows.limit(0), background).isEmpty()
    assert explain.exact_shapley_values(card, rows, background.limit(0)).isEmpty()


def test_the_curve_of_the_scorecard_rounds_half_even(spark):
    from campaignlens.operators.scorecard import SCORE_DIGITS, score_curve

    z = np.r_[np.random.default_rng(17).normal(0, 3, 5000), 0.0, -40.0, 40.0]
    p = F.bround(F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("z"))), SCORE_DIGITS)
    rows = spark.createDataFrame([(i, float(v)) for i, v in enumerate(z)], "i int, z double").select("i", p.alias("p")).orderBy("i").collect()
    assert [r["p"] for r in rows] == score_curve(z).tolist()
