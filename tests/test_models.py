from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from campaignlens.operators import classifiers, explain
from campaignlens.operators.naive_bayes import fit_gaussian_nb, score_gaussian_nb
from campaignlens.operators import neighbours
from campaignlens.operators.neighbours import nearest_neighbours, neighbour_vote
from campaignlens.operators.oversampling import category_penalty, oversample
from campaignlens.operators.prep import CampaignPreprocessor, fold_statistics, prep_statistics, transformed
from campaignlens.operators.sampling import hash_sample, permuted_donors, stratified_folds, stratified_split
from campaignlens.operators.scorecard import scorecard
from campaignlens.operators.selection import select_model
from campaignlens.plans import demo, tuning
from campaignlens.sources.store import durable
from campaignlens.settings import AGE_GROUPS, DUMMIES, FEATURES, NUMERIC_FEATURES, TRANSFORMED_FEATURES
from tests.helpers import FEATURE_ROW, rows_of

DIRECTORY = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def table(spark):
    return demo.features(spark, DIRECTORY)


@pytest.fixture(scope="module")
def assigned(spark):
    return demo.assigned(spark, DIRECTORY)


def feature_frame(spark, rows):
    return spark.createDataFrame(rows, FEATURE_ROW)


# --- splits and folds ---


def test_split_and_folds_are_exact_disjoint_and_complete(spark, table):
    split = stratified_split(table)
    assert split.count() == table.count() == split.select("id").distinct().count()
    sizes = {(r["target"], r["split"]): r["count"] for r in split.groupBy("target", "split").count().collect()}
    for cls in (0, 1):
        n = sizes[(cls, "train")] + sizes[(cls, "test")]
        assert sizes[(cls, "test")] == round(0.2 * n)
    folds = stratified_folds(table).groupBy("target", "fold").count().collect()
    for cls in (0, 1):
        counts = [r["count"] for r in folds if r["target"] == cls]
        assert len(counts) == 5 and max(counts) - min(counts) <= 1


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 6, 11])
def test_small_classes_spread_over_folds(spark, n):
    df = spark.range(n).withColumn("target", F.lit(1))
    counts = sorted(r["count"] for r in stratified_folds(df).groupBy("fold").count().collect())
    assert sum(counts) == n and len(counts) == min(n, 5) and counts[-1] - counts[0] <= 1


@pytest.mark.parametrize("partitions", [1, 7, 64])
def test_assignment_does_not_depend_on_partitioning(spark, table, partitions):
    shuffled = table.repartition(partitions)
    assert rows_of(stratified_split(table).select("id", "split"), "id") == rows_of(stratified_split(shuffled).select("id", "split"), "id")
    assert rows_of(stratified_folds(table).select("id", "fold"), "id") == rows_of(stratified_folds(shuffled).select("id", "fold"), "id")


def test_sample_and_permutation(spark, table):
    assert hash_sample(table, 20).count() == 20
    assert hash_sample(table, 10_000).count() == table.count()
    donors = permuted_donors(table, ["income"], 3)
    assert donors.count() == 3 * table.count()
    want = sorted(r["income"] or -1 for r in table.collect())
    moved = 0
    for repeat in range(3):
        got = donors.where(F.col("repeat") == repeat).join(table.select("id", "income"), "id").collect()
        assert sorted(r["donor_income"] or -1 for r in got) == want
        moved += sum(r["donor_income"] != r["income"] for r in got)
    assert moved > 2 * table.count()


# --- preprocessing ---


def hand_rows():
    base = [("18-25", None, 1.0), ("26-35", 10.0, 2.0), ("26-35", 20.0, 3.0), ("56+", 30.0, 4.0), ("56+", 50.0, 4.0), (None, None, 4.0)]
    return [(i, g, inc, pp, 0.5, i % 2, 3.0, 0.2, 0.1, i % 2) for i, (g, inc, pp) in enumerate(base)]


def test_statistics_by_hand(spark):
    row = prep_statistics(feature_frame(spark, hand_rows())).first()
    filled = np.array([25.0, 10, 20, 30, 50, 25])
    assert row["income_median"] == 25.0  # mean of the two middle values
    assert row["income_mean"] == pytest.approx(filled.mean())
    assert row["income_std"] == pytest.approx(filled.std())
    assert row["age_group_mode"] == "26-35"  # tie goes to the smallest label
    assert row["website_visits_std"] == 0.0


def test_transform_by_hand(spark):
    df = feature_frame(spark, hand_rows())
    out = transformed(df, prep_statistics(df)).orderBy("id").collect()
    filled = np.array([25.0, 10, 20, 30, 50, 25])
    assert [r["income"] for r in out] == pytest.approx(((filled - filled.mean()) / filled.std()).tolist())
    assert {r["website_visits"] for r in out} == {0.0}  # constant column
    assert [tuple(r[d] for d in DUMMIES) for r in out] == [(0, 0, 0, 0), (1, 0, 0, 0), (1, 0, 0, 0), (0, 0, 0, 1), (0, 0, 0, 1), (1, 0, 0, 0)]
    assert out[0].__fields__ == ["id", *TRANSFORMED_FEATURES]


def test_unknown_group_encodes_like_the_base_group(spark):
    df = feature_frame(spark, hand_rows())
    stats = prep_statistics(df)
    odd = feature_frame(spark, [(9, "99", 10.0, 1.0, 0.5, 0, 3.0, 0.2, 0.1, 0), (10, "18-25", 10.0, 1.0, 0.5, 0, 3.0, 0.2, 0.1, 0)])
    a, b = transformed(odd, stats).drop("id").collect()
    assert tuple(a) == tuple(b)


def test_statistics_ignore_other_rows(spark, assigned):
    train = assigned.where("split = 'train'")
    changed = assigned.withColumn("income", F.when(F.col("split") == "test", F.lit(1e9)).otherwise(F.col("income")))
    assert rows_of(prep_statistics(train)) == rows_of(prep_statistics(changed.where("split = 'train'")))


def test_keyed_fit_equals_separate_fits(spark, assigned):
    rows = demo.fit_rows(assigned)
    together = prep_statistics(rows, ["fit"]).where("fit = 2").drop("fit").first()
    alone = prep_statistics(rows.where("fit = 2").drop("fit")).first()
    for name in together.__fields__:
        assert together[name] == (alone[name] if isinstance(alone[name], str) else pytest.approx(alone[name]))


def test_fold_summaries_give_the_same_fits(spark, assigned):
    train = assigned.where("split = 'train'")
    repeated = prep_statistics(demo.fit_rows(assigned), ["fit"]).orderBy("fit").collect()
    merged = fold_statistics(train, [-1, *range(5)]).orderBy("fit").collect()
    assert len(repeated) == len(merged) == 6
    for a, b in zip(repeated, merged):
        for name in a.__fields__:
            assert b[name] == (a[name] if isinstance(a[name], str) else pytest.approx(a[name], rel=1e-9))


def test_fold_without_any_income(spark):
    rows = [(i, "26-35", None, 1.0, 0.5, 0, 3.0, 0.2, 0.1, i % 2) for i in range(4)]
    stats = prep_statistics(feature_frame(spark, rows))
    assert stats.first()["income_median"] is None
    assert {r["income"] for r in transformed(feature_frame(spark, rows), stats).collect()} == {0.0}


def test_pipeline_stage_round_trip(spark, tmp_path, assigned):
    train = assigned.where("split = 'train'")
    model = CampaignPreprocessor().fit(train)
    model.write().overwrite().save(str(tmp_path / "prep"))
    again = type(model).load(str(tmp_path / "prep"))
    a = [r["features"] for r in model.transform(train).orderBy("id").collect()]
    b = [r["features"] for r in again.transform(train).orderBy("id").collect()]
    plain = transformed(train, prep_statistics(train)).orderBy("id").drop("id").collect()
    assert a == b
    assert np.allclose(np.array([v.toArray() for v in a]), np.array([tuple(r) for r in plain]))


# --- naive Bayes ---


def test_naive_bayes_matches_numpy(spark, assigned):
    train = assigned.where("split = 'train'")
    x = transformed(train, prep_statistics(train), carry=["target"])
    got = {r["id"]: r["p"] for r in score_gaussian_nb(x, fit_gaussian_nb(x, smoothing=1e-6)).collect()}
    rows = x.collect()
    m = np.array([[r[c] for c in TRANSFORMED_FEATURES] for r in rows])
    y = np.array([r["target"] for r in rows])
    eps = 1e-6 * m.var(axis=0).max()
    logp = []
    for cls in (0, 1):
        part = m[y == cls]
        v = part.var(axis=0) + eps
        logp.append(np.log((y == cls).mean()) - 0.5 * (np.log(2 * np.pi * v) + (m - part.mean(axis=0)) ** 2 / v).sum(axis=1))
    want = 1 / (1 + np.exp(logp[0] - logp[1]))
    assert [got[r["id"]] for r in rows] == pytest.approx(want.tolist(), abs=1e-9)


# --- neighbours ---


def points(spark, n, seed, hot=0.0, dims=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(0, 1, (n, dims)).round(2)
    x[rng.random(n) < hot] = 0.25  # many copies of one point
    rows = [(int(i), int(rng.random() < 0.3), *map(float, v)) for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "id bigint, y int, a double, b double, c double"), x, rows


def brute(queries, train, k, own=False):
    found = {}
    for i, q in enumerate(queries):
        d2 = np.round(((train - q) ** 2).sum(axis=1), 9)
        order = sorted((d, j) for j, d in enumerate(d2) if not (own and j == i))[:k]
        found[i] = order
    return found


@pytest.mark.parametrize("leaf, chunk, hot", [(2048, 8192, 0.0), (60, 8192, 0.0), (25, 10, 0.35)])
def test_neighbours_match_brute_force(spark, monkeypatch, leaf, chunk, hot):
    monkeypatch.setattr(neighbours, "CHUNK_ROWS", chunk)
    train, tx, _ = points(spark, 400, 1, hot)
    queries, qx, _ = points(spark, 120, 2, hot)
    got = nearest_neighbours(queries, train, 7, ["a", "b", "c"], leaf_rows=leaf).orderBy("qid", "rank").collect()
    want = brute(qx, tx, 7)
    assert len(got) == 120 * 7
    for i, r in enumerate(got):
        d2, j = want[r["qid"]][i % 7]
        assert (r["id"], r["d2"]) == (j, pytest.approx(d2, abs=1e-9))


def test_neighbours_by_key_and_without_self(spark):
    train, tx, _ = points(spark, 150, 3, 0.3)
    both = train.withColumn("fit", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("a", F.col("a") + 10 * F.col("fit"))
    got = nearest_neighbours(both, both, 4, ["a", "b", "c"], keys=["fit"], exclude_self=True, leaf_rows=20)
    want = brute(tx, tx, 4, own=True)
    rows = got.orderBy("fit", "qid", "rank").collect()
    assert len(rows) == 2 * 150 * 4
    assert all(r["id"] == want[r["qid"]][r["rank"] - 1][1] for r in rows)


def test_copies_do_not_meet_each_other(spark):
    """A third of all rows in one point: results stay exact, and no task sees more than the first copies."""
    rng = np.random.default_rng(7)
    rows = [(i, *(np.zeros(3) if i % 3 == 0 else rng.normal(size=3)).tolist(), i % 2) for i in range(900)]
    both = spark.createDataFrame(rows, "id long, a double, b double, c double, y int")
    got = nearest_neighbours(both, both, 4, ["a", "b", "c"], exclude_self=True).orderBy("qid", "rank").collect()
    x = np.array([r[1:4] for r in rows])
    expected = []
    for i in range(900):
        d2 = np.round(((x - x[i]) ** 2).sum(axis=1), 9)
        order = [j for j in np.lexsort((np.arange(900), d2)) if j != i][:4]
        expected += [(i, int(j)) for j in order]
    assert [(r["qid"], r["id"]) for r in got] == expected
    few = neighbours._first_of_equal(both.select("id", F.array("a", "b", "c").alias("x")), [], 5)
    assert few.count() == 600 + 5


def test_fewer_rows_than_neighbours(spark):
    train, _, _ = points(spark, 3, 4)
    assert nearest_neighbours(train, train, 9, ["a", "b", "c"], leaf_rows=1).count() == 9
    assert nearest_neighbours(train, train.limit(0), 9, ["a", "b", "c"]).count() == 0


def test_votes(spark):
    rows = [(1, 10, 1, 0.0, 1), (1, 11, 0, 0.0, 2), (1, 12, 1, 4.0, 3), (2, 10, 1, 1.0, 1), (2, 11, 0, 4.0, 2), (2, 12, 0, 16.0, 3)]
    near = spark.createDataFrame(rows, "qid bigint, id bigint, y int, d2 double, rank int")
    uniform = {r["id"]: r["p"] for r in neighbour_vote(near, 3).collect()}
    weighted = {r["id"]: r["p"] for r in neighbour_vote(near, 3, "distance").collect()}
    assert uniform == {1: pytest.approx(2 / 3), 2: pytest.approx(1 / 3)}
    assert weighted == {1: pytest.approx(0.5), 2: pytest.approx(1 / 1.75)}


# --- oversampling ---


def test_oversampling_properties(spark, assigned):
    train = assigned.where("split = 'train'")
    x = durable(transformed(train, prep_statistics(train), carry=["target", "age_group"]))
    grown = durable(oversample(x))
    sizes = {r["target"]: r["count"] for r in grown.groupBy("target").count().collect()}
    assert sizes[0] == sizes[1]
    kept = grown.where("not synthetic")
    assert kept.count() == x.count()
    made = grown.where("synthetic").collect()
    minority = x.where("target = 1").collect()
    for c in NUMERIC_FEATURES:
        low, high = min(r[c] for r in minority), max(r[c] for r in minority)
        assert all(low - 1e-9 <= r[c] <= high + 1e-9 for r in made)
    assert {r["age_group"] for r in made} <= set(AGE_GROUPS)
    assert len({r["id"] for r in made}) == len(made) and all(r["id"] < 0 for r in made)
    again = oversample(x.repartition(5))
    assert rows_of(again, "id") == rows_of(grown, "id")
    spread = np.median([np.std([r[c] for r in minority]) for c in NUMERIC_FEATURES])
    assert category_penalty(x.where("target = 1")) == pytest.approx(spread)


def test_balanced_input_is_left_alone(spark):
    df = feature_frame(spark, hand_rows()).withColumn("target", F.col("id").cast("int") % 2)
    assert oversample(df).count() == df.count()


# --- fitted classifiers ---


def newton_logistic(x, y, c):
    n, d = x.shape
    z = np.c_[x, np.ones(n)]
    w, penalty = np.zeros(d + 1), np.r_[np.full(d, 1.0 / c), 0.0]
    for _ in range(100):
        mu = 1 / (1 + np.exp(-z @ w))
        w += np.linalg.solve((z * (mu * (1 - mu))[:, None]).T @ z + np.diag(penalty), z.T @ (y - mu) - penalty * w)
    return w


def test_logistic_regression_equals_the_penalized_optimum(spark, assigned):
    train = assigned.where("split = 'train'")
    model = classifiers.fit_pipeline(classifiers.Candidate("Logistic Regression", {"C": 0.1}), train)
    rows = transformed(train, prep_statistics(train), carry=["target"]).collect()
    x = np.array([[r[c] for c in TRANSFORMED_FEATURES] for r in rows])
    w = newton_logistic(x, np.array([r["target"] for r in rows]), 0.1)
    assert model.stages[-1].coefficients.toArray() == pytest.approx(w[:-1], abs=2e-3)
    ratios = explain.odds_ratios(model).collect()
    assert [r["odds_ratio"] for r in ratios] == sorted(r["odds_ratio"] for r in ratios)
    assert {r["feature"] for r in ratios} == set(TRANSFORMED_FEATURES)


def test_pipeline_saves_and_scores_alike(spark, tmp_path, assigned):
    train, test = assigned.where("split = 'train'"), assigned.where("split = 'test'")
    model = classifiers.fit_pipeline(classifiers.Candidate("Decision Tree", {"max_depth": 3, "criterion": "entropy"}), train)
    model.write().overwrite().save(str(tmp_path / "model"))
    again = PipelineModel.load(str(tmp_path / "model"))
    assert rows_of(classifiers.probability_of_response(model, test), "id") == rows_of(classifiers.probability_of_response(again, test), "id")
    importances = explain.tree_importances(model).collect()
    assert sum(r["importance"] for r in importances) == pytest.approx(1.0)


def test_class_weights(spark):
    df = spark.createDataFrame([(0,)] * 6 + [(1,)] * 2, "target int")
    assert {r["target"]: r["weight"] for r in classifiers.balanced_weights(df).collect()} == {0: 8 / 12, 1: 2.0}
    weighted = classifiers.with_balanced_weights(df)
    assert weighted.agg(F.sum("weight")).first()[0] == pytest.approx(8.0)


def test_grids_have_the_published_sizes():
    assert {m: len(list(classifiers.grid(m))) for m in classifiers.GRIDS} == {
        "Logistic Regression": 5, "K-Nearest Neighbors": 8, "Decision Tree": 18, "Random Forest": 24, "Naive Bayes": 4, "Gradient Boosting": 18,
    }


def test_out_of_fold_scores_cover_every_training_row_once(spark, assigned):
    train = assigned.where("split = 'train'").drop("split")
    models = ["Naive Bayes", "K-Nearest Neighbors", "Decision Tree"]
    chosen, oof, results = tuning.tune(train, models)
    assert set(chosen) == set(models)
    per_model = {r["model"]: (r["n"], r["d"]) for r in oof.groupBy("model").agg(F.count("*").alias("n"), F.countDistinct("id").alias("d")).collect()}
    assert per_model == {m: (train.count(), train.count()) for m in models}
    for m in models:
        best = results.where(F.col("model") == m).orderBy(F.col("cv_pr_auc_mean").desc(), "position").first()
        assert ", ".join(f"{k}={v}" for k, v in chosen[m].parameters.items()) == best["parameters"]


# --- selection ---

# Published development figures: mean and deviation of fold average precision, pooled rate.
BOARD = [
    ("Logistic Regression", 0.5069094199440055, 0.05716059744330707, 0.24918032786885247),
    ("K-Nearest Neighbors", 0.4913160460630565, 0.0520978540006361, 0.29508196721311475),
    ("Decision Tree", 0.4012791731489599, 0.04579528635353234, 0.33704918032786885),
    ("Random Forest", 0.5109070800863982, 0.045004420778011825, 0.1921311475409836),
    ("Naive Bayes", 0.4604840642403489, 0.047593687850992696, 0.36918032786885246),
    ("Gradient Boosting", 0.50022638839564, 0.055087228841960045, 0.20655737704918034),
]
BOARD_SCHEMA = "model string, cv_pr_auc_mean double, cv_pr_auc_std double, oof_fpr_at_recall double"


def test_published_selection(spark):
    row = select_model(spark.createDataFrame(BOARD, BOARD_SCHEMA)).first()
    assert row["selected"] == "Random Forest" and row["runner_up"] == "Logistic Regression" and row["tie_break"]
    assert "0.1921" in row["justification"] and "0.2492" in row["justification"]


@pytest.mark.parametrize(
    "rates, means, winner, tie",
    [((0.3, 0.2), (0.50, 0.49), "b", True), ((0.2, 0.2), (0.50, 0.49), "a", True), ((0.3, 0.2), (0.50, 0.30), "a", False)],
)
def test_selection_rule(spark, rates, means, winner, tie):
    df = spark.createDataFrame([("a", means[0], 0.05, rates[0]), ("b", means[1], 0.05, rates[1])], BOARD_SCHEMA)
    row = select_model(df).first()
    assert (row["selected"], row["tie_break"]) == (winner, tie)


def test_selection_has_no_test_argument():
    import inspect

    assert list(inspect.signature(select_model).parameters) == ["leaderboard"]
    assert not any("test" in p for p in inspect.signature(tuning.tune).parameters)


# --- explanation ---


def test_published_top_driver(spark):
    table = explain.odds_ratio_table(explain.coefficient_table(["email_engagement", "income", "website_visits"], np.log([1.9899, 1.2, 0.7])))
    assert explain.top_driver(table).first()["feature"] == "email_engagement"
    assert explain.raising_features(table).count() == 2
    assert [r["feature"] for r in table.collect()] == ["website_visits", "income", "email_engagement"]


def test_permutation_importance_is_zero_for_an_ignored_feature(spark, table):
    found = explain.permutation_importance(lambda r: r.withColumn("p", F.col("email_engagement")), table, threshold=0.3)
    got = {r["feature"]: (r["importance_mean"], r["importance_std"]) for r in found.collect()}
    assert set(got) == set(FEATURES)
    assert all(got[f] == (0.0, 0.0) for f in FEATURES if f != "email_engagement")
    assert got["email_engagement"][0] > 0


def test_shapley_values_add_up(spark, table):
    score = lambda r: r.withColumn("p", scorecard())
    base = table.where("id < 1")  # a single background row makes the sum exact
    values = explain.shapley_values(score, table, base, permutations=4, sample=30)
    sums = {r["id"]: r["s"] for r in values.groupBy("id").agg(F.sum("phi").alias("s")).collect()}
    assert len(sums) == 30
    p = {r["id"]: r["p"] for r in score(table).collect()}
    for i, s in sums.items():
        assert s == pytest.approx(p[i] - p[0], abs=1e-9)
    assert explain.shapley_summary(values).count() == len(FEATURES)
