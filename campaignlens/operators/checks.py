"""Validation operators: schema, domains, bounds, variance and consistency audits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from campaignlens.functions.numeric import count_where, ratio
from campaignlens.operators.exploration import _missing
from campaignlens.settings import AGE_GROUPS, FEATURES, INPUT_BOUNDS, TARGET, TRANSFORMED_FEATURES

VARIANCE_FLOOR = 1e-6
FLAG_VARIANCE_FLOOR = 0.01
METRIC_TOLERANCE = 1e-4
EFFECT_FLOOR = 0.02


class EmptyInputError(ValueError):
    """The input table has no rows."""


class SchemaError(ValueError):
    """Required columns are missing."""


def validate_schema(rows: DataFrame, required: Sequence[str] = FEATURES) -> tuple[bool, list[str]]:
    """Missing required columns in required order; extra columns are allowed. No job."""
    missing = [c for c in required if c not in rows.columns]
    return not missing, missing


def require_schema(rows: DataFrame, required: Sequence[str] = FEATURES) -> None:
    ok, missing = validate_schema(rows, required)
    if not ok:
        raise SchemaError("Missing required columns: " + ", ".join(missing))


def require_rows(rows: DataFrame) -> None:
    if rows.isEmpty():
        raise EmptyInputError("Input is empty")


def row_count_check(rows: DataFrame, expected: int) -> DataFrame:
    counted = rows.agg(F.count(F.lit(1)).alias("rows"))
    return counted.withColumn("ok", F.col("rows") == F.lit(expected))


def target_domain_check(rows: DataFrame, label: str = TARGET) -> DataFrame:
    """Rows whose label is missing or not 0/1; the check passes with none."""
    bad = count_where(F.col(label).isNull() | ~F.col(label).isin(0, 1)).alias("invalid")
    return rows.agg(F.count(F.lit(1)).alias("rows"), bad).withColumn("ok", F.col("invalid") == 0)


def completeness_check(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, missing, ok)`` for transformed columns, NULL and NaN both counting."""
    counts = rows.agg(*[count_where(_missing(rows, c)).alias(c) for c in columns])
    return counts.unpivot([], [F.col(f"`{c}`") for c in columns], "column", "missing").withColumn(
        "ok", F.col("missing") == 0
    )


def width_check(rows: DataFrame, vector: str = "features", names: Sequence[str] = TRANSFORMED_FEATURES) -> DataFrame:
    """``(rows, wrong, ok)``: vectors whose length isn't the number of model columns."""
    wrong = count_where(F.coalesce(F.size(vector_to_array(vector)), F.lit(-1)) != len(names)).alias("wrong")
    return rows.agg(F.count(F.lit(1)).alias("rows"), wrong).withColumn("ok", F.col("wrong") == 0)


def variance_audit(
    rows: DataFrame, columns: Sequence[str] = TRANSFORMED_FEATURES, flag: str = "previous_campaign_response"
) -> DataFrame:
    """Population variance per column and whether it exceeds its floor."""
    found = rows.agg(*[F.var_pop(F.col(f"`{c}`")).alias(f"v{i}") for i, c in enumerate(columns)])
    cells = F.array(
        *[F.struct(F.lit(c).alias("feature"), F.col(f"v{i}").alias("variance")) for i, c in enumerate(columns)]
    )
    floor = F.when(F.col("feature") == flag, F.lit(FLAG_VARIANCE_FLOOR)).otherwise(F.lit(VARIANCE_FLOOR))
    return found.select(F.explode(cells).alias("c")).select("c.*").withColumn("ok", F.col("variance") > floor)


def input_bounds(rows: DataFrame) -> DataFrame:
    """``(column, outside)``: values beyond the limits of the scoring form. Reports, rejects nothing."""
    counts = [
        count_where(~F.col(c).cast("double").between(low, high)).alias(c) for c, (low, high) in INPUT_BOUNDS.items()
    ]
    counts.append(count_where(~F.col("age_group").isin(*AGE_GROUPS)).alias("age_group"))
    columns = [*INPUT_BOUNDS, "age_group"]
    return rows.agg(*counts).unpivot([], columns, "column", "outside")


def metric_audit(reported: DataFrame, keys: Sequence[str] = ("model",), tolerance: float = METRIC_TOLERANCE) -> DataFrame:
    """Recompute F1, false-positive rate and capture rate from counts and compare with reported values.

    Input columns: ``tn fp fn tp f1 fpr responders_captured total_responders capture_rate``.
    """
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    again: dict[str, Column] = {
        "f1": ratio(2 * tp, 2 * tp + fp + fn),
        "fpr": ratio(fp, fp + tn),
        "capture_rate": ratio(F.col("responders_captured"), F.col("total_responders")),
    }
    cells = F.array(
        *[
            F.struct(F.lit(name).alias("metric"), F.col(name).alias("reported"), value.alias("recomputed"))
            for name, value in again.items()
        ]
    )
    long = reported.select(*keys, F.explode(cells).alias("c")).select(*keys, "c.*")
    return long.withColumn("ok", F.abs(F.col("reported") - F.col("recomputed")) < tolerance)


def inconsistent_figures(expected: DataFrame, documents: DataFrame) -> DataFrame:
    """Expected ``(document, label, value)`` texts that the document does not contain.

    ``documents`` is ``(document, value)`` with one row per figure that a document reports; which
    figures a document must contain is part of ``expected``.
    """
    return expected.join(documents, ["document", "value"], "left_anti").select("document", "label", "value")


def absent_figures(expected: DataFrame, location: str) -> DataFrame:
    """Expected ``(document, label, value)`` texts that occur nowhere in the files below ``location/document``, whatever folders they lie in.

    Every written line is matched with the figures of its own document: a few texts per document, joined by its name.
    """
    spark, folder = expected.sparkSession, "/" + location.rstrip("/").rsplit("/", 1)[-1]
    lines = spark.read.option("recursiveFileLookup", True).text(location).select(
        F.url_decode(F.regexp_extract(F.substring_index(F.col("_metadata.file_path"), folder, -1), r"^/([^/]+)/", 1)).alias("document"), "value"
    )
    wanted = expected.select("document", F.col("value").alias("figure")).distinct()
    present = lines.join(wanted, "document").where(F.contains("value", "figure")).select("document", F.col("figure").alias("value")).distinct()
    return inconsistent_figures(expected, present)


def effect_audit(with_variants: DataFrame, low: str = "p0", high: str = "p1") -> DataFrame:
    """Rows where the prior-response variant does not raise the score by more than the floor."""
    gain = F.col(high) - F.col(low)
    return with_variants.agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(gain).alias("smallest_gain"),
        F.avg(gain).alias("mean_gain"),
        count_where(gain > EFFECT_FLOOR).alias("raised"),
    )


def imbalance_audit(treatments: DataFrame) -> DataFrame:
    return treatments.agg(F.count(F.lit(1)).alias("treatments")).withColumn("ok", F.col("treatments") == 3)


def threshold_audit(best: DataFrame) -> DataFrame:
    """Both optimal thresholds are positive and differ."""
    a, b = F.col("f1_threshold"), F.col("profit_threshold")
    return best.withColumn("ok", (a > 0) & (b > 0) & (a != b))
