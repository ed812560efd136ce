"""Exploratory aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from campaignlens.functions.numeric import count_where, ratio
from campaignlens.operators.features import age_group_position
from campaignlens.operators.quantiles import exact_quantiles, quantiles_of_counts, value_counts
from campaignlens.settings import NUMERIC_FEATURES, TARGET

BOX_COLUMNS = ("income", "previous_purchases", "purchase_frequency", "website_visits", "discount_usage")
CORRELATION_COLUMNS = BOX_COLUMNS + ("email_engagement", "previous_campaign_response", TARGET)
WHISKER = 1.5


def _missing(rows: DataFrame, name: str):
    column = F.col(name)
    kind = dict(rows.dtypes)[name]
    return column.isNull() | F.isnan(column) if kind in ("double", "float") else column.isNull()


def table_shape(rows: DataFrame) -> DataFrame:
    """``(rows, columns)``."""
    return rows.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(rows.columns)).cast("bigint"))


def column_types(rows: DataFrame) -> DataFrame:
    """``(position, column, type)`` in table order, from the schema alone."""
    found = [(i, name, kind) for i, (name, kind) in enumerate(rows.dtypes)]
    return rows.sparkSession.createDataFrame(found, "position int, `column` string, type string")


def missing_counts(rows: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column, missing)`` from a single aggregate."""
    columns = list(columns or rows.columns)
    counts = rows.agg(*[count_where(_missing(rows, c)).alias(c) for c in columns])
    return counts.unpivot([], columns, "column", "missing")


def duplicate_rows(rows: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows beyond the first of each distinct row; missing values count as equal."""
    columns = list(columns or rows.columns)
    return (
        rows.groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("copies"))
        .agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).cast("bigint").alias("duplicates"))
    )


def describe_numeric(rows: DataFrame, columns: Sequence[str] = (*NUMERIC_FEATURES, TARGET)) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum per column."""
    counts = value_counts(rows, columns)
    stats = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    clean = {c: F.when(~_missing(rows, c), F.col(c).cast("double")) for c in columns}
    moments = rows.agg(*[fn(clean[c]).alias(f"{c}:{name}") for c in columns for name, fn in stats.items()])
    long = moments.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column"), *[F.col(f"`{c}:{name}`").alias(name) for name in stats])
                    for c in columns
                ]
            )
        ).alias("s")
    ).select("s.*")
    quartiles = quantiles_of_counts(counts, {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    return long.join(quartiles, "column", "left").select("column", "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def target_balance(rows: DataFrame, label: str = TARGET) -> DataFrame:
    """Rows and share (percent) per class.

    The total is added up over the class counts, at most three rows.
    """
    counts = rows.groupBy(label).agg(F.count(F.lit(1)).alias("rows"))
    whole = counts.groupBy().agg(
        F.sum("rows").alias("total"), F.collect_list(F.struct(F.col(label), F.col("rows"))).alias("classes")
    )
    return whole.select("total", F.explode("classes").alias("c")).select(
        F.col(f"c.{label}").alias(label),
        F.col("c.rows").alias("rows"),
        (ratio(F.col("c.rows"), F.col("total")) * 100).alias("share_pct"),
    )


def prevalence(rows: DataFrame, label: str = TARGET) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("rows"), F.avg(F.col(label)).alias("prevalence"))


def response_rate_by(rows: DataFrame, group: str, label: str = TARGET) -> DataFrame:
    """Response rate in percent per group."""
    return rows.groupBy(group).agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum(F.col(label)).alias("responders"),
        (F.avg(F.col(label)) * 100).alias("response_rate_pct"),
    )


def response_rate_by_age(rows: DataFrame) -> DataFrame:
    """Response rate per age group, in bin order."""
    rates = response_rate_by(rows, "age_group").withColumn("position", age_group_position(F.col("age_group")))
    return rates.orderBy("position")


def boxplot_stats(rows: DataFrame, columns: Sequence[str] = BOX_COLUMNS, group: str = TARGET) -> DataFrame:
    """Quartiles and whiskers per column and group; whiskers end at the last value within 1.5 IQR.

    Works on distinct values with their counts, never on whole groups.
    """
    counts = value_counts(rows, columns, [group])
    quartiles = quantiles_of_counts(counts, {"q1": 0.25, "median": 0.5, "q3": 0.75}, [group])
    reach = (F.col("q3") - F.col("q1")) * F.lit(WHISKER)
    value = F.col("value")
    # One row per (column, group): 5 columns times the classes.
    fenced = counts.join(F.broadcast(quartiles), [group, "column"])
    return fenced.groupBy(group, "column", "q1", "median", "q3").agg(
        F.min(F.when(value >= F.col("q1") - reach, value)).alias("whisker_low"),
        F.max(F.when(value <= F.col("q3") + reach, value)).alias("whisker_high"),
    )


def correlation_matrix(rows: DataFrame, columns: Sequence[str] = CORRELATION_COLUMNS) -> DataFrame:
    """Pearson correlations of all column pairs in one aggregate, pairwise complete."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    value = {c: F.when(~_missing(rows, c), F.col(c).cast("double")) for c in columns}
    found = rows.agg(*[F.corr(value[a], value[b]).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    cells = [(a, b, F.col(f"r{i}")) for i, (a, b) in enumerate(pairs)]
    cells += [(b, a, r) for a, b, r in cells] + [(c, c, F.lit(1.0)) for c in columns]
    return found.select(
        F.explode(
            F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), r.alias("r")) for a, b, r in cells])
        ).alias("cell")
    ).select("cell.*")


def first_rows(rows: DataFrame, n: int = 5, order: Sequence[str] = ("id",)) -> DataFrame:
    return rows.orderBy(*order).limit(n)


def quartiles(rows: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    return exact_quantiles(rows, columns, {"q25": 0.25, "q50": 0.5, "q75": 0.75}, keys)
