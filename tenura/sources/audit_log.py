"""Rows and files of the request and prediction log."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ISO_UTC = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def iso_utc(moment: Column | None = None) -> Column:
    """UTC time as ISO text with a trailing Z."""
    now = F.current_timestamp() if moment is None else moment
    return F.date_format(F.convert_timezone(F.current_timezone(), F.lit("UTC"), now.cast("timestamp_ntz")), ISO_UTC)


def row_id(*parts: Column) -> Column:
    """Id in uuid form that repeats for the same parts; without parts a random one."""
    if not parts:
        return F.uuid()
    digest = F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]))
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *[F.substring(digest, start, length) for start, length in cuts])


def request_key(request: Column) -> Column:
    """Id of a request's row in the log; predictions refer to it by the same call."""
    return row_id(F.lit("request"), request)


def request_rows(
    df: DataFrame,
    endpoint: str,
    payload: Column,
    status: Column,
    created_at: Column,
    request: Column,
    client_ip: Column | None = None,
    user_agent: Column | None = None,
    response_time_ms: Column | None = None,
) -> DataFrame:
    """Audit rows of requests, rejected ones included (they carry their own status)."""
    none = F.lit(None)
    return df.select(
        request_key(request).alias("id"),
        created_at.alias("created_at"),
        F.lit(endpoint).alias("endpoint"),
        payload.alias("request_data"),
        (none if client_ip is None else client_ip).cast("string").alias("client_ip"),
        (none if user_agent is None else user_agent).cast("string").alias("user_agent"),
        status.cast("int").alias("http_status"),
        (none if response_time_ms is None else response_time_ms).cast("int").alias("response_time_ms"),
        F.to_date(created_at).alias("created_date"),
    )


def prediction_rows(
    scored: DataFrame,
    model_version: str,
    prediction_date: Column,
    id_parts: Sequence[Column] = (),
    snapshot: Column | None = None,
) -> DataFrame:
    """Audit rows of predictions: probability as a fraction, never as percent; ``request_id`` is the log's key
    of the request (`request_key`), not the caller's."""
    return scored.select(
        row_id(*id_parts).alias("id"),
        request_key(F.col("request_id")).alias("request_id"),
        F.col("employee_id"),
        prediction_date.alias("created_at"),
        prediction_date.alias("prediction_date"),
        F.col("attrition_prob"),
        F.col("risk_level"),
        F.lit(model_version).alias("model_version"),
        (F.lit(None).cast("string") if snapshot is None else snapshot).alias("features_snapshot"),
        F.to_date(prediction_date).alias("created_date"),
    )


def append_log(df: DataFrame, path: str) -> None:
    """Append audit rows, one folder per day.

    Rebalancing gathers a day's rows in few files and splits a day that is too large for one task.
    """
    df.hint("rebalance", "created_date").write.mode("append").partitionBy("created_date").parquet(path)


@dataclass(frozen=True)
class BatchLog:
    """Requests and predictions that are written in batches, each of which becomes visible as a whole.

    Rows lie by day, and inside a day by run and batch. A row of ``commits`` for the run and batch is written last, and
    `published` shows only batches that have one; so a writer that is lost at any moment leaves nothing that is read,
    and writing the batch again replaces what it left.
    """

    requests: str
    predictions: str
    commits: str

    def _batch(self, run: str, batch_id: int) -> str:
        return f"{self.commits}/run={run}/batch_id={batch_id}"

    def withdraw(self, spark: SparkSession, run: str, batch_id: int) -> None:
        """Take a batch out of sight, before it is written again."""
        place = spark._jvm.org.apache.hadoop.fs.Path(self._batch(run, batch_id))
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)

    def write(self, df: DataFrame, path: str, run: str, batch_id: int) -> None:
        """Rows of one batch, replacing what an earlier attempt left in the same days.

        Rebalancing gathers a day's rows in few files.
        """
        named = df.withColumn("run", F.lit(run)).withColumn("batch_id", F.lit(batch_id).cast("long"))
        writer = named.hint("rebalance", "created_date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("created_date", "run", "batch_id").parquet(path)

    def publish(self, spark: SparkSession, run: str, batch_id: int) -> None:
        done = spark.range(1).select(F.current_timestamp().alias("committed_at"))
        done.coalesce(1).write.mode("overwrite").parquet(self._batch(run, batch_id))

    def append(self, requests: DataFrame, predictions: DataFrame, run: str, batch_id: int) -> None:
        """Write both tables of a batch, then publish it."""
        spark = requests.sparkSession
        self.withdraw(spark, run, batch_id)
        self.write(predictions, self.predictions, run, batch_id)
        self.write(requests, self.requests, run, batch_id)
        self.publish(spark, run, batch_id)

    def batches(self, spark: SparkSession) -> DataFrame:
        """``run`` and ``batch_id`` of every published batch."""
        try:
            return spark.read.parquet(self.commits).select(F.col("run").cast("string"), F.col("batch_id").cast("long")).distinct()
        except AnalysisException:  # nothing was ever published
            return spark.createDataFrame([], "run string, batch_id long")

    def published(self, spark: SparkSession) -> tuple[DataFrame, DataFrame]:
        """Requests and predictions of published batches.

        run and batch_id are folders, so what is not published is skipped without being read where the list of
        batches is small enough for a broadcast.
        """
        done = self.batches(spark)
        keys = [F.col("run").cast("string").alias("run"), F.col("batch_id").cast("long").alias("batch_id")]
        tables = (spark.read.parquet(path) for path in (self.requests, self.predictions))
        requests, predictions = (t.select(*[c for c in t.columns if c not in ("run", "batch_id")], *keys).join(done, ["run", "batch_id"], "left_semi") for t in tables)
        return requests, predictions
