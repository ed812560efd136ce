from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from campaignlens.functions import decisions, text
from campaignlens.operators import checks, reporting, scoring
from campaignlens.operators.scorecard import scorecard
from campaignlens.plans import demo, training, tuning
from campaignlens.settings import FEATURES
from campaignlens.sources import files, store
from campaignlens.streaming import scoring as stream
from tests.helpers import rows_of

DIRECTORY = "/root/testdata/sf0.001"


def SCORE(rows):  # noqa: N802 - a scorer value
    return rows.withColumn("p", scorecard())


# --- files ---

HEADER = "ID\tYear_Birth\tEducation\tIncome\tDt_Customer\tNumWebPurchases\tNumCatalogPurchases\tNumStorePurchases\tNumDealsPurchases\tNumWebVisitsMonth\tAcceptedCmp1\tAcceptedCmp2\tAcceptedCmp3\tAcceptedCmp4\tAcceptedCmp5\tResponse"


def write_raw(path, rows):
    path.write_text("\n".join([HEADER, *rows]) + "\n")


def test_raw_table_and_cache(spark, tmp_path):
    raw = tmp_path / "raw.tsv"
    write_raw(raw, ["1\t1980\tPhD\t50000\t15-06-2013\t4\t2\t6\t3\t5\t0\t0\t1\t0\t1\t1", "2\t1950\tBasic\t\t01-01-2014\t0\t0\t0\t2\t1\t0\t0\t0\t0\t0\t0"])
    rows = files.read_raw(spark, str(raw)).orderBy("ID").collect()
    assert rows[0]["Income"] == 50000.0 and rows[1]["Income"] is None and "Education" not in rows[0].__fields__
    cache = str(tmp_path / "cache")
    first = files.build_or_read_features(spark, str(raw), cache)
    assert first.count() == 2 and set(first.columns) == {"id", *FEATURES, "target"}
    assert files.build_or_read_features(spark, str(raw), cache).count() == 2
    write_raw(raw, ["1\t1980\tPhD\t50000\t15-06-2013\t4\t2\t6\t3\t5\t0\t0\t1\t0\t1\t1"])
    assert files.build_or_read_features(spark, str(raw), cache).count() == 1  # changed input rebuilds


def test_missing_raw_table(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.read_raw(spark, str(tmp_path / "nothing.tsv"))
    with pytest.raises(FileNotFoundError, match="one.*two"):
        store.require_artefacts(spark, [str(tmp_path / "one"), str(tmp_path / "two")])


def test_profile_file_has_two_header_rows(spark, tmp_path):
    rows = [("Actual Responder", 1.0, 2.0), ("Actual Non-Responder", 3.0, 4.0)]
    df = spark.createDataFrame(rows, "segment string, income_mean double, income_median double")
    files.write_profiles(df, str(tmp_path / "p"), ["income"])
    body = next((tmp_path / "p").glob("part-*")).read_text().splitlines()
    assert body[:2] == [",income,income", ",mean,median"]
    assert rows_of(files.read_profiles(spark, str(tmp_path / "p"), ["income"]), "segment") == sorted(rows)


def test_document_round_trip(spark, tmp_path):
    files.write_document(files.feature_list_document(spark), str(tmp_path / "doc"))
    row = files.read_document(spark, str(tmp_path / "doc")).first()
    assert row["raw_features"] == list(FEATURES) and row["target_column"] == "target"


def test_materialize_is_versioned(spark, tmp_path):
    location = str(tmp_path / "t")
    build = lambda n: lambda: spark.range(n)
    assert store.materialize(spark, build(3), location, "a").count() == 3
    assert store.materialize(spark, build(5), location, "a").count() == 3
    assert store.materialize(spark, build(5), location, "b").count() == 5


# --- scoring ---


def test_batch_scoring(spark, tmp_path):
    files.write_csv(files.upload_template(spark), str(tmp_path / "up"))
    upload = files.read_upload(spark, str(tmp_path / "up"))
    out = scoring.score_batch(SCORE, upload, 0.2)
    assert out.columns == [*FEATURES, "Response_Probability", "Prediction"]
    rows = {r["age_group"]: r for r in out.collect()}
    assert {r["Prediction"] for r in rows.values()} == {"WILL RESPOND", "WILL NOT RESPOND"}
    summary = scoring.batch_summary(SCORE(upload), 0.2).first()
    assert summary["prospects"] == 3 and summary["spend"] == 5.0 * summary["targeted"]
    assert summary["targeted_pct"] == pytest.approx(100 * summary["targeted"] / 3)


def test_batch_scoring_rejects_bad_uploads(spark):
    with pytest.raises(checks.SchemaError):
        scoring.score_batch(SCORE, files.upload_template(spark).select("age_group", "income"), 0.5)
    with pytest.raises(checks.EmptyInputError):
        scoring.score_batch(SCORE, files.upload_template(spark).limit(0), 0.5)


def test_label_uses_the_unrounded_score(spark):
    df = spark.createDataFrame([(0.49996,)], "p double")
    row = scoring.decide(df, 0.5).first()
    assert row["Response_Probability"] == 0.5 and row["Prediction"] == "WILL NOT RESPOND"


def test_threshold_choices():
    assert scoring.resolve_threshold("default", 0.27, 0.13) == 0.5
    assert scoring.resolve_threshold("f1", 0.27, 0.13) == 0.27
    assert scoring.resolve_threshold("profit", 0.27, 0.13) == 0.13
    assert scoring.resolve_threshold(0.3, 0.27, 0.13) == 0.3
    with pytest.raises(ValueError):
        scoring.resolve_threshold(0.95, 0.27, 0.13)


def test_advice(spark):
    assert decisions.break_even() == 0.1
    df = spark.createDataFrame([(0.3,), (0.05,), (None,)], "p double")
    rows = scoring.contact_advice(df, 0.1).collect()
    assert rows[0]["expected_value"] == pytest.approx(10.0) and rows[0]["value_class"] == "Profitable Contact"
    assert rows[1]["expected_value"] == pytest.approx(-2.5) and rows[1]["value_class"] == "Negative Expected Return"
    assert "30.0%" in rows[0]["recommendation"] and "+10.00" in rows[0]["recommendation"]
    assert spark.range(1).select(decisions.progress(F.lit(1.2)), decisions.progress(F.lit(-0.1))).first() == (1.0, 0.0)


def test_stream_equals_batch(spark, tmp_path):
    rows = demo.features(spark, DIRECTORY)
    rows.repartition(3).write.parquet(str(tmp_path / "in"))
    arriving = stream.customer_stream(spark, str(tmp_path / "in"), files_per_trigger=1)
    stream.run_available(stream.score_stream(SCORE, arriving), str(tmp_path / "out"), str(tmp_path / "progress"))
    stored = spark.read.parquet(str(tmp_path / "out"))
    for threshold in (0.2, 0.4):  # a new threshold needs no new scoring
        got = stream.decide_stored(stored, threshold).select("id", "Response_Probability", "Prediction")
        want = scoring.score_batch(SCORE, rows, threshold).select("id", "Response_Probability", "Prediction")
        assert rows_of(got, "id") == rows_of(want, "id")
    rows.limit(5).withColumn("id", F.col("id") + 1000).write.mode("append").parquet(str(tmp_path / "in"))
    stream.run_available(stream.score_stream(SCORE, stream.customer_stream(spark, str(tmp_path / "in"))), str(tmp_path / "out"), str(tmp_path / "progress"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == rows.count() + 5  # only new rows are added


# --- report texts ---


def test_formats(spark):
    df = spark.createDataFrame([(1234567.891, 0.61194, 374, 7, 49, 18)], "v double, s double, a int, b int, c int, d int")
    row = df.select(
        text.money(F.col("v")), text.thousands(F.col("a")), text.fixed(F.col("v"), 2), text.percent(F.col("s")),
        text.counts_text(*[F.col(c) for c in "abcd"]), text.mean_with_deviation(F.col("s"), F.lit(0.045)),
    ).first()
    assert tuple(row) == ("$1,234,567.89", "374", "1234567.89", "61.2%", "374 / 7 / 49 / 18", "0.6119 ± 0.0450")
    names = spark.range(1).select(text.strip_step_prefix(F.create_map(F.lit("classifier__C"), F.lit("0.1")))).first()[0]
    assert names == {"C": "0.1"}


def test_published_headline_figures(spark):
    rows = [
        ("m", 1, "Strategy 1: Contact Everyone", 448, 2240.0, 67, 381, 1110.0, 49.55, 0.0),
        ("m", 2, "Strategy 2: Default ML", 25, 125.0, 18, 7, 775.0, 620.0, 94.42),
        ("m", 3, "Strategy 3: F1-Optimal", 68, 340.0, 38, 30, 1560.0, 458.82, 84.82),
        ("m", 4, "Strategy 4: Profit-Optimal", 139, 695.0, 48, 91, 1705.0, 245.32, 68.97),
    ]
    names = "model string, position int, strategy string, contacts bigint, total_cost double, responders_reached bigint, wasted_contacts bigint, net_profit double, roi_pct double, cost_saved_pct double"
    df = spark.createDataFrame(rows, names)
    got = {r["metric"]: r["value"] for r in reporting.headline_figures(df).collect()}
    assert got["gain_over_everyone"] == 595.0 and got["gain_over_default"] == 930.0
    assert got["wasted_avoided_pct"] == pytest.approx(290 / 381 * 100)
    assert got["responders_kept_pct"] == pytest.approx(48 / 67 * 100)
    assert reporting.strategy_containing(df, "Everyone").first()["contacts"] == 448


def test_segments_come_in_order(spark):
    df = spark.createDataFrame([("Predicted Responder",), ("Other",), ("Actual Non-Responder",)], "segment string")
    assert [r[0] for r in reporting.segments_in_order(df).collect()] == ["Actual Non-Responder", "Predicted Responder"]


# --- the whole analysis ---


def test_full_analysis(spark, tmp_path):
    features = demo.features(spark, DIRECTORY)
    grids = {"Logistic Regression": {"C": [0.1, 1.0]}, "Naive Bayes": {"var_smoothing": [1e-9]}, "Decision Tree": {"max_depth": [3], "min_samples_split": [2], "criterion": ["gini"]}}
    found = training.run_analysis(features, tuple(grids), grids, replicates=100, k=3, parallelism=4)
    assert found.selected in grids and found.deployed_name.startswith(found.selected)
    assert found.model_card.count() == 3
    assert [r["position"] for r in found.strategies.orderBy("position").collect()] == [1, 2, 3, 4]
    everyone = found.strategies.where("position = 1").first()
    test_rows = found.test_scores.where(F.col("model") == found.selected).count()
    assert everyone["contacts"] == test_rows and everyone["cost_saved_pct"] == 0.0
    for r in found.intervals.collect():
        assert r["ci_lower"] <= r["ci_upper"]
    if found.imbalance is not None:
        assert checks.imbalance_audit(found.imbalance).first()["ok"]
    assert found.profiles.count() >= 3
    assert found.brier_scores["validation_improved"] == (found.brier_scores["validation_calibrated"] < found.brier_scores["validation_uncalibrated"])
    training.store_analysis(found, str(tmp_path / "run"))
    document = spark.read.json(str(tmp_path / "run" / "metrics")).first()
    assert document["selected"] == found.selected and len(document["business_simulation"]) == 4
    assert document["economic_parameters"]["break_even_probability"] == 0.1
    store.require_artefacts(spark, [str(tmp_path / "run" / n) for n in ("results_comparison", "business_simulation", "customer_profiles", "feature_list")])
    again = tuning.FittedModel.load(spark, str(tmp_path / "run" / "model"))
    rows = features.limit(50)
    expected = found.deployed_model.score(rows).select("id", F.bround("p", 10))
    assert rows_of(again.score(rows).select("id", F.bround("p", 10)), "id") == rows_of(expected, "id")
    if again.pipeline is not None:
        batch = scoring.score_batch(scoring.model_probability(again.pipeline), files.upload_template(spark), 0.2)
        assert batch.count() == 3


def test_test_rows_do_not_influence_training(spark):
    assigned = demo.assigned(spark, DIRECTORY)
    changed = assigned.withColumn("income", F.when(F.col("split") == "test", F.lit(9e9)).otherwise(F.col("income")))
    from campaignlens.plans import tuning

    def scores(rows):
        grids = {"Naive Bayes": {"var_smoothing": [1e-9]}}
        return tuning.candidate_scores(tuning.FoldData(rows.where("split = 'train'").drop("split")), ["Naive Bayes"], grids)

    assert rows_of(scores(assigned).select("id", F.bround("p", 10)), "id") == rows_of(scores(changed).select("id", F.bround("p", 10)), "id")
