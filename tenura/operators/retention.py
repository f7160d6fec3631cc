"""Retention, erasure and pseudonyms of the audit log."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura.functions.hashing import pseudonym
from tenura.session import materialise

RETENTION_DAYS = 365


def _cutoff(requests: DataFrame, as_of: Column | datetime, days: int) -> Column:
    moment = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return moment.cast(requests.schema["created_at"].dataType) - F.expr(f"INTERVAL {days} DAYS")


def expired_requests(requests: DataFrame, as_of: Column | datetime, days: int = RETENTION_DAYS) -> DataFrame:
    """Requests strictly older than the retention time."""
    return requests.where(F.col("created_at") < _cutoff(requests, as_of, days))


def kept_requests(requests: DataFrame, as_of: Column | datetime, days: int = RETENTION_DAYS) -> DataFrame:
    return requests.where(F.col("created_at") >= _cutoff(requests, as_of, days))


def kept_predictions(
    predictions: DataFrame, requests: DataFrame, as_of: Column | datetime, days: int = RETENTION_DAYS
) -> DataFrame:
    """Predictions whose request stays; a prediction's own age does not matter."""
    gone = expired_requests(requests, as_of, days).select(F.col("id").alias("request_id"))
    return predictions.join(gone, "request_id", "left_anti")


def deleted_predictions(
    predictions: DataFrame, requests: DataFrame, as_of: Column | datetime, days: int = RETENTION_DAYS
) -> DataFrame:
    gone = expired_requests(requests, as_of, days).select(F.col("id").alias("request_id"))
    return predictions.join(gone, "request_id", "left_semi")


def erase_employee(predictions: DataFrame, employee_ids: DataFrame) -> DataFrame:
    """Log without the given employees' predictions; rows without an employee stay."""
    return predictions.join(employee_ids.select("employee_id").distinct(), "employee_id", "left_anti")


def pseudonymise(predictions: DataFrame, salt: str) -> DataFrame:
    """Log with employee ids replaced by salted hashes."""
    return predictions.withColumn("employee_id", pseudonym(F.col("employee_id"), salt))


def _drop_rows(path: str, table: DataFrame, dead: DataFrame, key: str, layout: tuple[str, ...]) -> None:
    """Remove rows from a log laid out by day: untouched days stay, others are rewritten or dropped whole."""
    spark = table.sparkSession
    touched = [r[0] for r in dead.select("created_date").distinct().collect()]  # one value for each day
    if not touched:
        return
    known = F.array(*[F.lit(d) for d in touched if d is not None])
    in_touched = F.array_contains(known, F.col("created_date"))
    if None in touched:
        in_touched = in_touched | F.col("created_date").isNull()
    kept = materialise(table.where(in_touched).join(dead.select(key).distinct(), key, "left_anti").select(table.columns), "kept-days")
    left = {r[0] for r in kept.select("created_date").distinct().collect()}
    for day in set(touched) - left:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/created_date={day or '__HIVE_DEFAULT_PARTITION__'}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    writer = kept.hint("rebalance", "created_date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*layout).parquet(path)


def cleanup(
    spark: SparkSession, requests_path: str, predictions_path: str, as_of: datetime | Column, days: int = RETENTION_DAYS,
    layout: tuple[str, ...] = ("created_date",),
) -> int:
    """Delete expired requests and their predictions from the log; gives the number of deleted requests.

    Whole expired days are dropped and only days that keep some rows are rewritten. Predictions go first:
    a run that fails leaves requests that the next run deletes with what is left of their predictions.
    A request without a time never expires.
    """
    requests, predictions = spark.read.parquet(requests_path), spark.read.parquet(predictions_path)
    gone = materialise(expired_requests(requests, as_of, days).select("id", "created_date"), "expired")
    removed = gone.count()
    keys = gone.select(F.col("id").alias("request_id"))
    given = materialise(predictions.join(keys, "request_id", "left_semi").select("request_id", "created_date"), "expired-predictions")
    _drop_rows(predictions_path, predictions, given, "request_id", layout)
    _drop_rows(requests_path, requests, gone, "id", layout)
    return removed
