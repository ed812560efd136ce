from __future__ import annotations

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from campaignlens.functions.hashing import keyed_hash, poisson_cutoffs
from campaignlens.operators.quantiles import exact_quantiles
from campaignlens.operators.ranking import positions_by_score, ranked_by_hash, ranked_by_score, score_groups
from tests.helpers import rows_of, scored_frame


def scores(kind, n=4000, seed=1):
    rng = np.random.default_rng(seed)
    y = (rng.random(n) < 0.2).astype(int)
    if kind == "distinct":
        p = rng.random(n)
    elif kind == "tiny":  # nearly all mass in one coarse bucket, all distinct
        p = 1e-7 * rng.random(n)
    elif kind == "hot":  # a third of the rows share one score
        p = np.where(rng.random(n) < 0.34, 0.25, rng.random(n))
    else:
        p = np.full(n, 0.5)
    return p, y


@pytest.mark.parametrize("kind", ["distinct", "tiny", "hot", "equal"])
def test_running_counts_match_sorting(spark, kind):
    p, y = scores(kind)
    got = score_groups(scored_frame(spark, p, y)).orderBy(F.col("p").desc()).collect()
    values, run_pos, run_neg = sorted(set(p.tolist()), reverse=True), 0, 0
    assert [r["p"] for r in got] == values
    for r in got:
        hit = p == r["p"]
        run_pos, run_neg = run_pos + int(y[hit].sum()), run_neg + int((1 - y[hit]).sum())
        assert (r["run_pos"], r["run_neg"]) == (run_pos, run_neg)
        assert (r["all_pos"], r["all_neg"]) == (int(y.sum()), int(len(y) - y.sum()))


@pytest.mark.parametrize("kind", ["distinct", "tiny", "hot", "equal"])
@pytest.mark.parametrize("digits", [None, 4])
def test_row_ranks_are_a_total_order(spark, kind, digits):
    p, y = scores(kind, 1500)
    if digits is not None:
        p = np.round(p, digits)
    df = scored_frame(spark, p, y)
    got = ranked_by_score(df, digits=digits).orderBy("run_n").collect()
    assert [r["run_n"] for r in got] == list(range(1, len(p) + 1))
    ps = [r["p"] for r in got]
    assert ps == sorted(ps, reverse=True)
    assert [r["run_pos"] for r in got] == np.cumsum([r["y"] for r in got]).tolist()
    hashes = {r["id"]: r["h"] for r in df.select("id", keyed_hash(F.col("id"), tag="tie").alias("h")).collect()}
    keys = [(-r["p"], hashes[r["id"]], r["id"]) for r in got]
    assert keys == sorted(keys)


def test_positions_equal_full_ranking(spark):
    p, y = scores("hot", 2000)
    df = scored_frame(spark, p, y)
    full = {r["run_n"]: (r["id"], r["run_pos"]) for r in ranked_by_score(df).collect()}
    few = positions_by_score(df, lambda n: [F.floor(n * 0.1), F.floor(n * 0.5), n]).collect()
    assert sorted(r["run_n"] for r in few) == [200, 1000, 2000]
    assert all(full[r["run_n"]] == (r["id"], r["run_pos"]) for r in few)


@pytest.mark.parametrize("partitions", [1, 7, 64])
def test_results_do_not_depend_on_partitioning(spark, partitions):
    p, y = scores("hot", 1000)
    df = scored_frame(spark, p, y)
    a = rows_of(ranked_by_score(df), "run_n")
    b = rows_of(ranked_by_score(df.repartition(partitions).orderBy(F.rand(3))), "run_n")
    assert a == b


def test_hash_rank_is_a_permutation(spark):
    got = [r["rank"] for r in ranked_by_hash(spark.range(5000), [], keyed_hash(F.col("id"), tag="t")).collect()]
    assert sorted(got) == list(range(1, 5001))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.floats(-1e12, 1e12), st.sampled_from([0.0, -0.0, 1.0, 1e-300, -5.5])), min_size=1, max_size=60))
def test_quantiles_match_numpy(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    probs = {"a": 0.025, "b": 0.25, "c": 0.5, "d": 0.9, "e": 1.0, "f": 0.0}
    row = exact_quantiles(df, ["v"], probs).first()
    for name, q in probs.items():
        assert row[name] == pytest.approx(np.quantile(values, q), rel=1e-9, abs=1e-9)


def test_quantiles_by_key_skip_missing_and_handle_hot_values(spark):
    rng = np.random.default_rng(5)
    x = np.where(rng.random(3000) < 0.4, 7.0, rng.normal(0, 1000, 3000))
    rows = [(int(i % 2), None if i % 50 == 0 else float(v)) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "k int, v double")
    got = {r["k"]: r["m"] for r in exact_quantiles(df, ["v"], {"m": 0.5}, ["k"]).collect()}
    for k in (0, 1):
        assert got[k] == pytest.approx(np.median([v for kk, v in rows if kk == k and v is not None]))


def test_poisson_cutoffs_follow_the_distribution():
    cut = poisson_cutoffs()
    assert cut[0] / 2**32 == pytest.approx(np.exp(-1), abs=1e-9)
    assert cut[1] / 2**32 == pytest.approx(2 * np.exp(-1), abs=1e-9)
    assert all(a < b for a, b in zip(cut, cut[1:]))
