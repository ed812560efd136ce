from __future__ import annotations

import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from campaignlens.operators import checks
from campaignlens.operators.features import age_group, available_numeric, conform, engineer_features, feature_columns
from campaignlens.settings import FEATURES, RAW_SCHEMA

BASE = (1, 1980, 50000.0, "15-06-2013", 4, 2, 6, 3, 5, 0, 0, 1, 0, 1, 1)


def raw(spark, **changes):
    names = [f.name for f in RAW_SCHEMA.fields]
    row = dict(zip(names, BASE))
    row.update(changes)
    return spark.createDataFrame([tuple(row[n] for n in names)], RAW_SCHEMA)


def derive(spark, **changes):
    return engineer_features(raw(spark, **changes)).first().asDict()


def test_feature_formulas(spark):
    row = derive(spark)
    months = (datetime.date(2014, 12, 31) - datetime.date(2013, 6, 15)).days / 30.4375
    assert row["age_group"] == "26-35"  # 34 years
    assert row["previous_purchases"] == 12.0
    assert row["purchase_frequency"] == float(np.round(12 / months, 4))
    assert row["previous_campaign_response"] == 1
    assert row["email_engagement"] == 0.4
    assert row["discount_usage"] == 0.25
    assert row["website_visits"] == 5.0
    assert row["target"] == 1


@pytest.mark.parametrize(
    "born, group",
    [(2004, "18-25"), (1989, "18-25"), (1988, "26-35"), (1979, "26-35"), (1978, "36-45"), (1969, "36-45"), (1968, "46-55"), (1959, "46-55"), (1958, "56+"), (None, None)],
)
def test_age_bins_are_right_closed(spark, born, group):
    assert derive(spark, Year_Birth=born)["age_group"] == group


def test_zero_purchases_with_deals_gives_zero_usage(spark):
    row = derive(spark, NumWebPurchases=0, NumCatalogPurchases=0, NumStorePurchases=0, NumDealsPurchases=4)
    assert row["discount_usage"] == 0.0 and row["purchase_frequency"] == 0.0


def test_usage_is_clipped_and_tenure_floored(spark):
    row = derive(spark, NumDealsPurchases=40, Dt_Customer="25-12-2014")
    assert row["discount_usage"] == 1.0
    assert row["purchase_frequency"] == 12.0


def test_missing_values_stay_missing(spark):
    row = derive(spark, Income=float("nan"), NumWebPurchases=None, Dt_Customer=None)
    assert row["income"] is None and row["previous_purchases"] is None and row["purchase_frequency"] is None
    assert row["discount_usage"] == 0.0


def test_bad_date_is_an_error_unless_tolerated(spark):
    bad = raw(spark, Dt_Customer="2013/06/15")
    with pytest.raises(Exception):
        engineer_features(bad).collect()
    assert engineer_features(bad, tolerant_dates=True).first()["purchase_frequency"] is None


def test_rounding_is_half_even_like_numpy(spark):
    values = [(n / d) for d in range(1, 40) for n in range(0, 40)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = [r[0] for r in df.orderBy("i").select(F.bround("v", 4)).collect()]
    assert got == [float(np.round(v, 4)) for v in values]


def test_response_does_not_reach_any_feature(spark):
    a, b = derive(spark, Response=0), derive(spark, Response=1)
    assert {k: v for k, v in a.items() if k != "target"} == {k: v for k, v in b.items() if k != "target"}


def test_age_group_expression_handles_any_column(spark):
    assert spark.range(1).select(age_group(F.lit(35))).first()[0] == "26-35"


def test_feature_order_and_available_columns(spark):
    df = engineer_features(raw(spark))
    assert feature_columns(df).columns == ["id", *FEATURES, "target"]
    other = spark.createDataFrame([(1, 2.0, "x")], "a int, b double, c string")
    assert available_numeric(other) == ["a", "b"]


def test_conform_casts_text_uploads(spark):
    up = spark.createDataFrame([("36-45", "58138", "NaN", "keep")], "age_group string, income string, previous_purchases string, note string")
    row = conform(up).first()
    assert row["income"] == 58138.0 and row["previous_purchases"] is None and row["note"] == "keep"


# --- checks ---


def test_schema_check_lists_missing_in_order(spark):
    df = spark.createDataFrame([("36-45", 1.0)], "age_group string, income double")
    ok, missing = checks.validate_schema(df)
    assert not ok and missing == list(FEATURES[2:])
    with pytest.raises(checks.SchemaError, match="previous_purchases"):
        checks.require_schema(df)


def test_empty_input_is_rejected(spark):
    with pytest.raises(checks.EmptyInputError):
        checks.require_rows(spark.createDataFrame([], "a int"))


def test_domain_and_completeness(spark):
    df = spark.createDataFrame([(0, 1.0), (1, float("nan")), (2, None), (None, 4.0)], "target int, x double")
    row = checks.target_domain_check(df).first()
    assert (row["rows"], row["invalid"], row["ok"]) == (4, 2, False)
    assert checks.completeness_check(df, ["x"]).first()["missing"] == 2


def test_bounds_report(spark):
    rows = [("36-45", -1.0, 1.0, 1.0, 0, 1.0, 0.5, 0.5), ("99", 5.0, 101.0, 1.0, 2, 51.0, 1.5, None)]
    df = spark.createDataFrame(rows, "age_group string, income double, previous_purchases double, purchase_frequency double, previous_campaign_response int, website_visits double, email_engagement double, discount_usage double")
    found = {r["column"]: r["outside"] for r in checks.input_bounds(df).collect()}
    assert found == {"income": 1, "previous_purchases": 1, "purchase_frequency": 0, "previous_campaign_response": 1, "website_visits": 1, "email_engagement": 1, "discount_usage": 0, "age_group": 1}


def test_inconsistent_figures(spark):
    expected = spark.createDataFrame([("r", "a", "1.0"), ("r", "b", "2.0"), ("s", "a", "1.0"), ("s", "b", "2.0")], "document string, label string, value string")
    docs = spark.createDataFrame([("r", "1.0"), ("r", "2.0"), ("s", "2.0")], "document string, value string")
    assert [tuple(r) for r in checks.inconsistent_figures(expected, docs).collect()] == [("s", "a", "1.0")]
