from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from campaignlens.operators import calibration, curves, gains, thresholds
from campaignlens.operators.bootstrap import _metrics_of_draws, bootstrap_ci, grouped_replicates
from campaignlens.settings import linear_grid
from tests.helpers import np_auc, np_average_precision, np_roc, rows_of, scored_frame

# Published confusion counts of six models: tn, fp, fn, tp and the ratios that follow from them.
PUBLISHED = {
    "Random Forest": (374, 7, 49, 18, 0.875, 0.72, 0.26865671641791045, 0.391304347826087, 0.01837270341207349),
    "Logistic Regression": (376, 5, 52, 15, 0.8727678571428571, 0.75, 0.22388059701492538, 0.3448275862068966, 0.013123359580052493),
    "Gradient Boosting": (375, 6, 51, 16, 0.8727678571428571, 0.7272727272727273, 0.23880597014925373, 0.3595505617977528, 0.015748031496062992),
    "K-Nearest Neighbors": (374, 7, 45, 22, 0.8839285714285714, 0.7586206896551724, 0.3283582089552239, 0.4583333333333333, 0.01837270341207349),
    "Naive Bayes": (326, 55, 30, 37, 0.8102678571428571, 0.40217391304347827, 0.5522388059701493, 0.46540880503144655, 0.14435695538057744),
    "Decision Tree": (374, 7, 58, 9, 0.8549107142857143, 0.5625, 0.13432835820895522, 0.21686746987951808, 0.01837270341207349),
}


def random_scores(n=600, digits=None, seed=0):
    rng = np.random.default_rng(seed)
    y = (rng.random(n) < 0.25).astype(int)
    p = np.clip(0.25 + 0.2 * y + rng.normal(0, 0.2, n), 0, 1)
    return (np.round(p, digits) if digits else p), y


def test_published_ratios_follow_from_counts(spark):
    df = spark.createDataFrame([(m, *v[:4]) for m, v in PUBLISHED.items()], "model string, tn bigint, fp bigint, fn bigint, tp bigint")
    for r in thresholds.with_ratios(df).collect():
        want = PUBLISHED[r["model"]][4:]
        assert [r[c] for c in ("accuracy", "precision", "recall", "f1", "fpr")] == pytest.approx(list(want), abs=1e-12)


def test_published_strategy_table(spark):
    rows = [("Everyone", 0, 381, 0, 67), ("Default", 374, 7, 49, 18), ("F1", 351, 30, 29, 38), ("Profit", 290, 91, 19, 48)]
    df = spark.createDataFrame(rows, "strategy string, tn bigint, fp bigint, fn bigint, tp bigint")
    got = {r["strategy"]: r for r in thresholds.economics(df).collect()}
    want = {
        "Everyone": (448, 2240.0, 67, 381, 3350.0, 1110.0, 49.55357142857143, 0.0),
        "Default": (25, 125.0, 18, 7, 900.0, 775.0, 620.0, 94.41964285714286),
        "F1": (68, 340.0, 38, 30, 1900.0, 1560.0, 458.8235294117647, 84.82142857142857),
        "Profit": (139, 695.0, 48, 91, 2400.0, 1705.0, 245.32374100719423, 68.97321428571429),
    }
    names = ["contacts", "total_cost", "responders_reached", "wasted_contacts", "gross_revenue", "net_profit", "roi_pct", "cost_saved_pct"]
    for s, values in want.items():
        assert [got[s][n] for n in names] == pytest.approx(list(values))


def test_grid_values():
    grid = linear_grid()
    assert grid == np.linspace(0.05, 0.95, 91).tolist()
    assert grid[22] == 0.26999999999999996 and grid[8] == 0.13
    assert linear_grid(0.05, 0.90, 86) == np.linspace(0.05, 0.90, 86).tolist()


def test_sweep_equals_direct_counts_on_and_off_the_grid(spark):
    grid = linear_grid()
    rng = np.random.default_rng(3)
    p = np.concatenate([rng.random(500), grid, np.nextafter(grid, 0), np.nextafter(grid, 1), [0.0, 1.0]])
    y = rng.integers(0, 2, len(p))
    got = {r["step"]: r for r in thresholds.threshold_sweep(scored_frame(spark, p, y)).collect()}
    assert len(got) == 91
    for i, t in enumerate(grid):
        hit = p >= t
        want = [int((~hit & (y == 0)).sum()), int((hit & (y == 0)).sum()), int((~hit & (y == 1)).sum()), int((hit & (y == 1)).sum())]
        assert [got[i][c] for c in ("tn", "fp", "fn", "tp")] == want
        assert got[i]["threshold"] == t
    contacts = [got[i]["tp"] + got[i]["fp"] for i in range(91)]
    assert contacts == sorted(contacts, reverse=True)


def test_best_threshold_is_the_lowest_of_equal_ones(spark):
    best = thresholds.best_thresholds(thresholds.threshold_sweep(scored_frame(spark, [0.9, 0.1], [1, 0]))).first()
    assert best["f1_threshold"] == linear_grid()[6]  # the first grid value above 0.1
    assert best["best_f1"] == 1.0


def test_one_class_and_empty_denominators(spark):
    df = scored_frame(spark, [0.1, 0.2], [0, 0])
    row = thresholds.with_ratios(thresholds.confusion(df)).first()
    assert (row["tn"], row["fp"], row["fn"], row["tp"]) == (2, 0, 0, 0)
    assert (row["precision"], row["recall"], row["f1"], row["fpr"]) == (0.0, 0.0, 0.0, 0.0)
    metrics = curves.ranking_metrics(df).first()
    assert metrics["roc_auc"] == 0.5 and metrics["pr_auc"] == 0.0
    assert curves.fpr_at_recall(df).first()["fpr_at_recall"] == 1.0
    capture = curves.top_capture(df).first()
    assert (capture["n_targeted"], capture["responders_captured"], capture["capture_rate"]) == (0, 0, 0.0)


@pytest.mark.parametrize("digits", [None, 2, 4])
def test_auc_and_average_precision_match_numpy(spark, digits):
    p, y = random_scores(digits=digits)
    row = curves.ranking_metrics(scored_frame(spark, p, y), digits=digits).first()
    assert row["roc_auc"] == pytest.approx(np_auc(p, y), abs=1e-12)
    assert row["pr_auc"] == pytest.approx(np_average_precision(p, y), abs=1e-12)


def test_auc_mirrors(spark):
    p, y = random_scores(digits=3)
    a = curves.ranking_metrics(scored_frame(spark, p, y)).first()["roc_auc"]
    b = curves.ranking_metrics(scored_frame(spark, 1 - p, y)).first()["roc_auc"]
    assert a == pytest.approx(1 - b)


@pytest.mark.parametrize("digits", [None, 2])
@pytest.mark.parametrize("reduced", [True, False])
def test_roc_points_match_numpy(spark, digits, reduced):
    p, y = random_scores(300, 2)
    got = curves.roc_points(scored_frame(spark, p, y), digits=digits, reduced=reduced)
    points = [(r["fpr"], r["tpr"]) for r in got.orderBy(F.col("threshold").desc()).collect()]
    assert points[0] == (0.0, 0.0)
    want = np_roc(p, y, reduced)
    assert len(points) == len(want) + 1
    assert np.array(points[1:]) == pytest.approx(np.array(want))
    rate = curves.fpr_at_recall(scored_frame(spark, p, y), digits=digits, reduced=reduced).first()["fpr_at_recall"]
    assert rate == pytest.approx(next(f for f, t in np_roc(p, y, reduced) if t >= 0.7))


def test_pr_curve_ends_at_full_precision(spark):
    p, y = random_scores(200, 2)
    got = curves.pr_points(scored_frame(spark, p, y), digits=2).collect()
    assert len(got) == len(set(p.tolist())) + 1
    assert [(r["precision"], r["recall"]) for r in got if r["threshold"] is None] == [(1.0, 0.0)]


def test_top_capture_counts_the_published_way(spark):
    rng = np.random.default_rng(9)
    p, y = rng.permutation(448) / 448, np.zeros(448, dtype=int)
    order = np.argsort(-p)
    y[order[:41]] = 1
    y[order[200:226]] = 1
    row = curves.top_capture(scored_frame(spark, p, y)).first()
    assert (row["n_targeted"], row["responders_captured"], row["total_responders"]) == (89, 41, 67)
    assert row["capture_rate"] == pytest.approx(0.6119402985074627)


# Sizes of ten equal-count position bins as the usual quantile-cut rule gives them.
@pytest.mark.parametrize("n, sizes", [(448, [45, 45, 45, 44, 45, 45, 44, 45, 45, 45]), (10, [1] * 10), (91, [10] + [9] * 9), (25, [3, 2, 3, 2, 3, 2, 2, 3, 2, 3])])
def test_decile_sizes(spark, n, sizes):
    p, y = np.arange(n) / n, np.arange(n) % 2
    lift = gains.decile_lift(scored_frame(spark, p, y)).orderBy("decile").collect()
    assert [r["customers"] for r in lift] == sizes
    assert sum(r["responders"] for r in lift) == y.sum()
    curve = gains.gains_curve(scored_frame(spark, p, y))
    assert rows_of(curve.groupBy("decile").count(), "decile") == [(i + 1, s) for i, s in enumerate(sizes)]
    last = curve.orderBy(F.col("position").desc()).first()
    assert last["cum_pct_responders"] == 100.0 and last["cum_pct_customers"] == 100.0


def test_gains_read_off(spark):
    p, y = random_scores(448)
    df = scored_frame(spark, p, y)
    ordered = y[np.argsort(-p)]
    got = {r["pct_customers"]: r["cum_pct_responders"] for r in gains.gains_at(df).collect()}
    for pct in (20, 30):
        assert got[pct] == pytest.approx(ordered[: int(448 * pct / 100)].sum() / y.sum() * 100)
    assert gains.gains_at(scored_frame(spark, [0.5, 0.4], [1, 0])).count() == 0


def test_reliability_edges_belong_to_the_lower_bin(spark):
    edges = [i * 0.1 for i in range(11)]
    got = calibration.reliability_table(scored_frame(spark, edges, [0] * 11)).orderBy("bin").collect()
    assert [(r["bin"], r["rows"]) for r in got] == [(0, 2)] + [(i, 1) for i in range(1, 10)]


def test_brier_and_deployment_rule(spark):
    assert calibration.brier(scored_frame(spark, [0.2, 0.9], [0, 1])).first()["brier"] == pytest.approx(0.025)
    assert calibration.validation_improved(0.09607, 0.09784) is False
    assert calibration.validation_improved(0.2, 0.2) is False
    assert calibration.validation_improved(0.2, 0.1) is True


def test_sigmoid_fit_matches_newton(spark):
    p, y = random_scores(400)
    slope, intercept = calibration.fit_sigmoid(scored_frame(spark, p, y))
    hi, lo = (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2)
    t = np.where(y == 1, hi, lo)
    x, w = np.c_[p, np.ones(len(p))], np.zeros(2)
    for _ in range(60):
        mu = 1 / (1 + np.exp(-x @ w))
        w += np.linalg.solve((x * (mu * (1 - mu))[:, None]).T @ x, x.T @ (t - mu))
    assert (slope, intercept) == pytest.approx(tuple(w), abs=1e-4)


def test_normalized_confusion_rows_add_up(spark):
    p, y = random_scores(300)
    cells = thresholds.normalized_confusion(thresholds.confusion(scored_frame(spark, p, y), 0.3))
    for r in cells.groupBy("actual").agg(F.sum("share").alias("s")).collect():
        assert r["s"] == pytest.approx(1.0)


def test_own_threshold_mapping_equals_threshold_table(spark):
    a = scored_frame(spark, *random_scores(200, seed=1), model="a").union(scored_frame(spark, *random_scores(200, seed=2), model="b"))
    table = spark.createDataFrame([("a", 0.2), ("b", 0.6)], "model string, threshold double")
    names = ["model", "threshold", "tn", "fp", "fn", "tp"]
    assert rows_of(thresholds.confusion(a, {"a": 0.2, "b": 0.6}).select(names), "model") == rows_of(thresholds.confusion_at(a, table).select(names), "model")


def test_rounded_thresholds_and_fixed_campaign_size(spark):
    p, y = random_scores(300)
    df = scored_frame(spark, p, y)
    best = spark.createDataFrame([("m", 0.26999999999999996, 0.13)], "model string, f1_threshold double, profit_threshold double")
    table = thresholds.strategy_table(df, best, round_thresholds=2, customers=448).orderBy("position").collect()
    assert [r["threshold"] for r in table] == [0.0, 0.5, 0.27, 0.13]
    assert table[0]["cost_saved_pct"] == pytest.approx((448 - 300) / 448 * 100)
    assert table[2]["strategy"] == "Strategy 3: F1-Optimal (Threshold 0.27)"


# --- bootstrap ---


def test_metrics_of_given_weights_match_numpy():
    p, y = random_scores(80, 1)
    scores = sorted(set(p.tolist()), reverse=True)
    w = np.array([[c for s in scores for c in (int(((p == s) & (y == 1)).sum()), int(((p == s) & (y == 0)).sum()))]])
    found = _metrics_of_draws(w, np.tile([True, False], len(scores)), np.array(scores) >= 0.3)
    assert found["roc_auc"][0] == pytest.approx(np_auc(p, y))
    assert found["pr_auc"][0] == pytest.approx(np_average_precision(p, y))
    hit = p >= 0.3
    assert found["f1"][0] == pytest.approx(2 * y[hit].sum() / (hit.sum() + y.sum()))


def test_grouped_replicates_are_repeatable(spark):
    df = scored_frame(spark, *random_scores(300, 2))
    a = rows_of(grouped_replicates(df, 0.3, 120, ["model"], 2), "replicate")
    b = rows_of(grouped_replicates(df.repartition(5), 0.3, 120, ["model"], 2), "replicate")
    assert a == b and len(a) == 120


def test_both_bootstrap_methods_agree_with_resampling(spark):
    p, y = random_scores(400, 2)
    rng = np.random.default_rng(0)
    aucs = [np_auc(p[i], y[i]) for i in (rng.integers(0, 400, 400) for _ in range(300))]
    df = scored_frame(spark, p, y)
    for method in ("rows", "grouped"):
        row = bootstrap_ci(df, 0.3, 300, digits=2, method=method).where("metric = 'roc_auc'").first()
        assert row["ci_lower"] == pytest.approx(np.percentile(aucs, 2.5), abs=0.015)
        assert row["ci_upper"] == pytest.approx(np.percentile(aucs, 97.5), abs=0.015)
        assert row["std"] == pytest.approx(np.std(aucs), rel=0.25)
        assert row["replicates"] == 300


def test_one_class_replicates_are_skipped(spark):
    df = scored_frame(spark, [0.9, 0.1, 0.2], [1, 0, 0])
    row = bootstrap_ci(df, 0.5, 50, digits=2, method="rows").where("metric = 'f1'").first()
    assert 0 < row["replicates"] < 50
