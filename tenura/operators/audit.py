"""Analytics over the request and prediction log.

Look-back windows take an ``as_of`` moment, never the wall clock: a datetime, or a constant
column such as :func:`latest`.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenura.operators.percentiles import grouped_percentiles
from tenura.operators.ranking import rank_by_hash


def latest(df: DataFrame, column: str = "created_at") -> Column:
    """Newest moment in a log, as a constant.

    One small job finds it; as a constant, unlike as a subquery, it lets look-back filters reach
    the file statistics and partitions of the scan.
    """
    text = df.agg(F.max(column).cast("string")).first()[0]
    return F.lit(text).cast(df.schema[column].dataType)


def day_of(moment: Column | datetime) -> Column:
    return F.to_date(moment if isinstance(moment, Column) else F.lit(moment))


def since(df: DataFrame, as_of: Column | datetime, days: int, column: str = "created_at") -> DataFrame:
    """Rows not older than ``days`` before the day of ``as_of``.

    A log partitioned by ``created_date`` is pruned as well.
    """
    start = F.date_sub(day_of(as_of), days)
    kept = df.where(F.col(column) >= start.cast(df.schema[column].dataType))
    if "created_date" in df.columns:
        kept = kept.where(F.col("created_date") >= start)
    return kept


def high_risk_recent(predictions: DataFrame, as_of: Column | datetime, days: int = 30) -> DataFrame:
    return since(predictions, as_of, days).where(F.col("risk_level") == "HIGH").orderBy(
        F.desc("created_at"), "id"
    )


def risk_or_prob(predictions: DataFrame, above: float = 0.8) -> DataFrame:
    return predictions.where((F.col("risk_level") == "HIGH") | (F.col("attrition_prob") > above))


def predictions_by_request(predictions: DataFrame, request_id) -> DataFrame:
    return predictions.where(F.col("request_id") == F.lit(request_id))


def request_by_id(requests: DataFrame, request_id) -> DataFrame:
    return requests.where(F.col("id") == F.lit(request_id))


def employee_history(predictions: DataFrame, employee_id: str) -> DataFrame:
    return predictions.where(F.col("employee_id") == employee_id).orderBy("created_at", "id")


def count_by_risk(predictions: DataFrame) -> DataFrame:
    return predictions.groupBy("risk_level").agg(F.count("*").alias("n"))


def average_probability(predictions: DataFrame) -> DataFrame:
    return predictions.agg(F.coalesce(F.avg("attrition_prob"), F.lit(0.0)).alias("avg_prob"))


def count_avg_by_risk(predictions: DataFrame) -> DataFrame:
    return predictions.groupBy("risk_level").agg(
        F.count("*").alias("n"), F.avg("attrition_prob").alias("avg_prob")
    )


def daily_volume(predictions: DataFrame, as_of: Column | datetime, days: int = 30) -> DataFrame:
    """Predictions and distinct requests per day, newest first.

    Counting per (day, request) first splits a busy day over all tasks.
    """
    per_request = (
        since(predictions, as_of, days)
        .groupBy(F.to_date("created_at").alias("date"), "request_id")
        .agg(F.count("*").alias("n"))
    )
    return (
        per_request.groupBy("date")
        .agg(F.sum("n").alias("total_predictions"), F.count("request_id").alias("total_requests"))
        .orderBy(F.desc("date"))
    )


def risk_distribution(predictions: DataFrame, as_of: Column | datetime, days: int = 30) -> DataFrame:
    """Share of each risk level in percent, two decimals."""
    counts = count_by_risk(since(predictions, as_of, days))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("percentage", F.round(F.col("n") * 100.0 / total, 2))


def avg_prob_by_department(
    predictions: DataFrame,
    requests: DataFrame,
    as_of: Column | datetime,
    days: int = 90,
    payload: str = "request_data",
) -> DataFrame:
    """Mean probability by the department named in the request payload."""
    recent = since(predictions, as_of, days).select("request_id", "attrition_prob")
    departments = requests.select(
        F.col("id").alias("request_id"), F.get_json_object(payload, "$.departement").alias("department")
    )
    # One partial row per request before the join: a request with very many predictions is light.
    per_request = recent.groupBy("request_id").agg(
        F.sum("attrition_prob").alias("total"), F.count("attrition_prob").alias("known"),
        F.count("*").alias("n"),
    )
    return _mean_by(per_request.join(departments, "request_id"), "department")


def avg_prob_by_snapshot(predictions: DataFrame, as_of: Column | datetime, days: int = 90) -> DataFrame:
    """The same by the department in each prediction's own feature snapshot.

    Batch requests carry no department in their payload; the snapshot always has it.
    """
    rows = since(predictions, as_of, days).select(
        F.get_json_object("features_snapshot", "$.departement").alias("department"),
        F.col("attrition_prob").alias("total"),
        F.when(F.col("attrition_prob").isNotNull(), 1).otherwise(0).alias("known"),
        F.lit(1).alias("n"),
    )
    return _mean_by(rows, "department")


def _mean_by(parts: DataFrame, group: str) -> DataFrame:
    return (
        parts.groupBy(group)
        .agg(
            F.try_divide(F.sum("total"), F.sum("known")).alias("avg_attrition_prob"),
            F.sum("n").alias("prediction_count"),
        )
        .orderBy(F.desc("avg_attrition_prob"), group)
    )


def latency_percentiles(requests: DataFrame, as_of: Column | datetime, days: int = 7) -> DataFrame:
    """Requests, mean, median and 95th percentile of the response time per endpoint."""
    recent = since(requests, as_of, days)
    means = recent.groupBy("endpoint").agg(
        F.count("*").alias("request_count"), F.avg("response_time_ms").alias("avg_response_ms")
    )
    cuts = grouped_percentiles(
        recent, ["endpoint"], "response_time_ms", {"median_response_ms": 0.5, "p95_response_ms": 0.95}
    )
    renamed = cuts.withColumnRenamed("endpoint", "_endpoint")
    return means.join(renamed, means["endpoint"].eqNullSafe(renamed["_endpoint"]), "left").drop("_endpoint")


def model_version_usage(predictions: DataFrame) -> DataFrame:
    return (
        predictions.groupBy("model_version")
        .agg(
            F.count("*").alias("prediction_count"),
            F.min("created_at").alias("first_used"),
            F.max("created_at").alias("last_used"),
        )
        .orderBy(F.desc("last_used"), "model_version")
    )


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of each named table."""
    parts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table"), "n") for name, df in tables.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def newest(predictions: DataFrame, n: int = 100) -> DataFrame:
    return predictions.orderBy(F.desc("created_at"), "id").limit(n)


def page(predictions: DataFrame, offset: int, limit: int) -> DataFrame:
    return predictions.orderBy(F.desc("created_at"), "id").offset(offset).limit(limit)


def page_after(predictions: DataFrame, last_created_at, last_id, limit: int) -> DataFrame:
    """Next page after a known last row; deep pages cost no more than the first."""
    earlier = (F.col("created_at") < F.lit(last_created_at)) | (
        (F.col("created_at") == F.lit(last_created_at)) & (F.col("id") > F.lit(last_id))
    )
    return newest(predictions.where(earlier), limit)


def top_probability(predictions: DataFrame, n: int = 10) -> DataFrame:
    return predictions.orderBy(F.desc("attrition_prob"), "id").limit(n)


def requests_with_predictions(
    requests: DataFrame, predictions: DataFrame, fields: Sequence[str] = ("attrition_prob", "risk_level"),
) -> DataFrame:
    """Each request with its predictions, a row for each, numbered from 1 by ``position`` in hash order of their ids.

    A request without predictions gives one row with nulls. The shape is the same for any number of
    predictions, and no request has to fit one row or one task.
    """
    ranked = rank_by_hash(predictions.select("request_id", "id", *fields), "id", 0, ["request_id"], "position")
    given = ranked.select("request_id", "position", F.col("id").alias("prediction_id"), *fields)
    return requests.join(given, requests["id"] == given["request_id"], "left").drop("request_id")


def accuracy_over_time(predictions: DataFrame, outcomes: DataFrame, cut: float = 0.5) -> DataFrame:
    """Feedback loop: confusion counts and accuracy by month of the prediction.

    ``outcomes`` holds ``employee_id`` and ``actual`` (did leave).
    """
    # The log is reduced to (employee, month) counts before the join.
    flagged = F.col("attrition_prob") >= cut
    per_employee = predictions.groupBy(
        "employee_id", F.date_format("created_at", "yyyy-MM").alias("month")
    ).agg(F.count_if(flagged).alias("said_leave"), F.count_if(~flagged).alias("said_stay"))
    joined = per_employee.join(outcomes, "employee_id")
    actual = F.col("actual")
    total = lambda part, when: F.sum(F.when(when, F.col(part)).otherwise(0))
    counts = joined.groupBy("month").agg(
        total("said_leave", actual).alias("tp"),
        total("said_leave", ~actual).alias("fp"),
        total("said_stay", actual).alias("fn"),
        total("said_stay", ~actual).alias("tn"),
    )
    n = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")
    # A month whose outcomes are all unknown has no accuracy.
    return counts.withColumn("accuracy", F.try_divide(F.col("tp") + F.col("tn"), n)).orderBy("month")
