"""Exact interpolated quantiles of many columns at once.

The built-in exact percentile keeps all distinct values of a group in one task. Here equal
values are counted first and only the value buckets that hold a wanted position are sorted.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from campaignlens.functions.numeric import clean
from campaignlens.operators.ranking import real_levels, running_sums


def stacked_values(rows: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Long form ``(keys, column, value)`` of numeric columns, missing values dropped."""
    cells = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column"), clean(F.col(c)).alias("value")) for c in columns])
    )
    return rows.select(*keys, cells.alias("_cell")).select(*keys, "_cell.column", "_cell.value").where("value is not null")


def value_counts(rows: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    return stacked_values(rows, columns, keys).groupBy(*keys, "column", "value").agg(F.count(F.lit(1)).alias("n"))


def quantiles_of_counts(counts: DataFrame, probabilities: Mapping[str, float], keys: Sequence[str] = ()) -> DataFrame:
    """Linear-interpolation quantiles per ``(keys, column)`` of a ``(…, column, value, n)`` table."""
    def ranks(total: Column) -> list[tuple[str, Column, Column, Column]]:
        found = []
        for name, q in probabilities.items():
            exact = F.lit(float(q)) * (total - 1)
            low = F.floor(exact)
            found.append((name, low, F.least(low + 1, total - 1), exact - low))
        return found

    def wanted(before: Column, upto: Column, total: Column) -> Column:
        hit = F.lit(False)
        for _, low, high, _ in ranks(total):
            hit = hit | ((low >= before) & (low < upto)) | ((high >= before) & (high < upto))
        return hit

    group = [*keys, "column"]
    columns, levels = real_levels(F.col("value"), "_v")
    ranked = running_sums(
        counts.withColumns(columns), group, levels, [F.col("value")], {"n": "n"}, keep=wanted, keep_on="n"
    )
    upto, before = F.col("run_n"), F.col("run_n") - F.col("n")
    picks, results = [], []
    for name, low, high, fraction in ranks(F.col("all_n")):
        picks += [
            F.max(F.when((low >= before) & (low < upto), F.col("value"))).alias(f"_{name}_lo"),
            F.max(F.when((high >= before) & (high < upto), F.col("value"))).alias(f"_{name}_hi"),
            F.max(fraction).alias(f"_{name}_fr"),
        ]
        lo, hi, fr = (F.col(f"_{name}_{part}") for part in ("lo", "hi", "fr"))
        results.append((lo + (hi - lo) * fr).alias(name))
    return ranked.groupBy(*group).agg(*picks).select(*group, *results)


def exact_quantiles(
    rows: DataFrame, columns: Sequence[str], probabilities: Mapping[str, float], keys: Sequence[str] = ()
) -> DataFrame:
    return quantiles_of_counts(value_counts(rows, columns, keys), probabilities, keys)


def medians_wide(rows: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), suffix: str = "_median") -> DataFrame:
    """One row per key with the median of each column as ``<column><suffix>``."""
    long = exact_quantiles(rows, columns, {"q": 0.5}, keys)
    return long.groupBy(*keys).agg(
        *[F.max(F.when(F.col("column") == c, F.col("q"))).alias(f"{c}{suffix}") for c in columns]
    )
