"""Scoring of customers as they arrive: a stateless streaming projection."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from campaignlens.operators.checks import require_schema
from campaignlens.operators.features import conform
from campaignlens.operators.scoring import decide
from campaignlens.settings import FEATURE_SCHEMA


def customer_stream(spark: SparkSession, location: str, schema=FEATURE_SCHEMA, kind: str = "parquet", files_per_trigger: int | None = None) -> DataFrame:
    """Files of customer rows as a stream."""
    reader = spark.readStream.schema(schema).format(kind)
    if kind == "csv":
        reader = reader.option("header", True)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(location)


def score_stream(score: Callable[[DataFrame], DataFrame], stream: DataFrame) -> DataFrame:
    """The batch expressions on a stream. The score is kept unrounded and without a decision,
    so a later change of the threshold needs no new scoring."""
    require_schema(stream)
    return score(conform(stream))


def decide_stored(stored: DataFrame, threshold: float) -> DataFrame:
    """Decision on stored scores at the threshold of the moment."""
    return decide(stored, threshold)


def run_available(scored: DataFrame, location: str, checkpoint: str) -> StreamingQuery:
    """Append all available rows to a parquet sink, exactly once, and stop."""
    query = (
        scored.writeStream.outputMode("append")
        .format("parquet")
        .option("path", location)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


