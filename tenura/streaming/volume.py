"""Streaming daily volume and risk counts of the prediction log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LATENESS = "1 day"


def daily_volume(stream: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Predictions per closed day; a day is final once the watermark has passed its end."""
    timed = stream.withColumn("created_at", F.col("created_at").cast("timestamp"))
    return (
        timed.withWatermark("created_at", lateness)
        .groupBy(F.window("created_at", "1 day").alias("day"))
        .agg(F.count("*").alias("total_predictions"))
        .select(F.to_date("day.start").alias("date"), "total_predictions")
    )


def daily_requests(stream: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Distinct requests per closed day.

    A request repeated within the lateness is counted once; the state per request is dropped
    when the watermark passes.
    """
    timed = stream.withColumn("created_at", F.col("created_at").cast("timestamp"))
    marked = timed.withColumn("day", F.to_date("created_at")).withWatermark("created_at", lateness)
    once = marked.dropDuplicatesWithinWatermark(["request_id", "day"])
    return (
        once.groupBy(F.window("created_at", "1 day").alias("w"))
        .agg(F.count("*").alias("total_requests"))
        .select(F.to_date("w.start").alias("date"), "total_requests")
    )


def risk_counts(stream: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Predictions per closed day and risk level."""
    timed = stream.withColumn("created_at", F.col("created_at").cast("timestamp"))
    return (
        timed.withWatermark("created_at", lateness)
        .groupBy(F.window("created_at", "1 day").alias("day"), "risk_level")
        .agg(F.count("*").alias("n"))
        .select(F.to_date("day.start").alias("date"), "risk_level", "n")
    )
