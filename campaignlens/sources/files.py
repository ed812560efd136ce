"""Text sources and sinks: raw table, feature table, uploads, result tables, documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from campaignlens.operators.features import conform, engineer_features
from campaignlens.settings import FEATURE_SCHEMA, FEATURES, NUMERIC_FEATURES, RAW_SCHEMA, TARGET, TRANSFORMED_FEATURES
from campaignlens.sources.store import materialize, path_exists


def read_raw(spark: SparkSession, location: str) -> DataFrame:
    """Tab-separated raw customer table with a header; only the known columns are kept.

    Columns are matched by name, so extra ones and any order are fine.
    """
    if not path_exists(spark, location):
        raise FileNotFoundError(f"Raw customer table not found at {location}")
    header = spark.read.option("sep", "\t").option("header", True).csv(location)
    missing = [f.name for f in RAW_SCHEMA.fields if f.name not in header.columns]
    if missing:
        raise ValueError("Raw customer table lacks columns: " + ", ".join(missing))
    empty = lambda c: F.when(F.trim(F.col(c)) != "", F.trim(F.col(c)))
    return header.select(*[empty(f.name).cast(f.dataType).alias(f.name) for f in RAW_SCHEMA.fields])


def read_table_csv(spark: SparkSession, location: str, schema: T.StructType | str) -> DataFrame:
    """Comma-separated table with a header and a declared schema."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(location)


def read_features(spark: SparkSession, location: str) -> DataFrame:
    return read_table_csv(spark, location, FEATURE_SCHEMA)


def read_upload(spark: SparkSession, location: str) -> DataFrame:
    """Scoring upload: columns by header name, known ones typed, extra ones kept as text."""
    return conform(spark.read.option("header", True).csv(location))


def build_or_read_features(spark: SparkSession, raw_location: str, cache_location: str) -> DataFrame:
    """Feature cache that is rebuilt when the raw files or the feature code version change."""
    stamp = (
        spark.read.format("binaryFile").load(raw_location).select("path", "modificationTime", "length")
        .agg(F.count(F.lit(1)).alias("files"), F.max("modificationTime").alias("latest"), F.sum("length").alias("bytes"))
        .first()
    )
    version = f"1|{stamp['files']}|{stamp['latest']}|{stamp['bytes']}"
    return materialize(spark, lambda: engineer_features(read_raw(spark, raw_location)), cache_location, version)


def write_csv(rows: DataFrame, location: str) -> None:
    rows.write.mode("overwrite").option("header", True).csv(location)


def write_profiles(profiles: DataFrame, location: str, columns: Sequence[str] = NUMERIC_FEATURES) -> None:
    """Profile table with its header in two rows: feature names, then statistic names."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    names = ["", *[c for c in columns for _ in (0, 1)]]
    kinds = ["", *[s for _ in columns for s in ("mean", "median")]]
    body = profiles.select(
        F.lit(2).alias("place"),
        F.concat_ws(",", "segment", *[text(f"{c}_{s}") for c in columns for s in ("mean", "median")]).alias("line"),
    )
    spark = profiles.sparkSession
    head = spark.createDataFrame([(0, ",".join(names)), (1, ",".join(kinds))], "place int, line string")
    # Four segments and two header rows in one file.
    head.unionByName(body).orderBy("place", "line").coalesce(1).select("line").write.mode("overwrite").text(location)


def read_profiles(spark: SparkSession, location: str, columns: Sequence[str] = NUMERIC_FEATURES) -> DataFrame:
    """Read a table with two header rows back into flat names ``<feature>_<statistic>``."""
    names = ["segment", *[f"{c}_{s}" for c in columns for s in ("mean", "median")]]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    rows = spark.read.schema(schema).csv(location)
    data = rows.where(F.col("segment").isNotNull() & (F.col("segment") != ""))
    return data.select("segment", *[F.col(n).cast("double").alias(n) for n in names[1:]])


def read_document(spark: SparkSession, location: str, schema: T.StructType | str | None = None) -> DataFrame:
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(location)


def write_document(document: DataFrame, location: str) -> None:
    """One nested row as JSON."""
    document.coalesce(1).write.mode("overwrite").json(location)


def feature_list_document(spark: SparkSession) -> DataFrame:
    """Raw, numeric, categorical and transformed feature names, and the target."""
    row = (list(FEATURES), list(NUMERIC_FEATURES), ["age_group"], list(TRANSFORMED_FEATURES), TARGET)
    return spark.createDataFrame(
        [row],
        "raw_features array<string>, numeric_features array<string>, categorical_features array<string>, "
        "transformed_features array<string>, target_column string",
    )


def upload_template(spark: SparkSession) -> DataFrame:
    """Three example rows in the upload format."""
    # Fixed values of the published template.
    rows = [
        ("36-45", 58138.0, 22.0, 0.85, 0, 7.0, 0.0, 0.14),
        ("46-55", 71613.0, 20.0, 1.20, 1, 4.0, 0.2, 0.05),
        ("26-35", 26646.0, 6.0, 0.40, 0, 6.0, 0.0, 0.33),
    ]
    types = {f.name: f.dataType for f in FEATURE_SCHEMA.fields}
    return spark.createDataFrame(rows, T.StructType([T.StructField(c, types[c]) for c in FEATURES]))
