"""Stream scoring: requests in, predictions, audit rows and quarantine out."""

from __future__ import annotations

import warnings
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tenura.operators.quality import FEATURES, payload_rules, typed, validate
from tenura.operators.score import AttritionModel
from tenura.sources.audit_log import BatchLog, prediction_rows, request_rows, row_id
from tenura.sources.files import batch_schema, explode_batches

ACCEPTED, REJECTED = 200, 422
ENDPOINT = "/api/v1/predict/batch"


@dataclass(frozen=True)
class Sinks:
    """Folders of one scoring stream."""

    root: str

    @property
    def scored(self) -> str:
        return f"{self.root}/scored"

    @property
    def quarantine(self) -> str:
        return f"{self.root}/quarantine"

    @property
    def verdicts(self) -> str:
        return f"{self.root}/verdicts"

    @property
    def requests(self) -> str:
        return f"{self.root}/api_requests"

    @property
    def predictions(self) -> str:
        return f"{self.root}/predictions"

    @property
    def log(self) -> BatchLog:
        """The log, whose published batches are what readers see."""
        return BatchLog(self.requests, self.predictions, f"{self.root}/commits")

    @property
    def checkpoint(self) -> str:
        return f"{self.root}/checkpoint"


def read_requests(spark: SparkSession, folder: str, files_per_batch: int = 100) -> DataFrame:
    """Batch payloads as a stream of JSON lines; unreadable lines keep their text."""
    return spark.readStream.schema(batch_schema()).option("maxFilesPerTrigger", files_per_batch).json(folder)


RUN = "sql.streaming.queryId"


def _write(df: DataFrame, path: str, run: str, batch_id: int) -> None:
    """Each micro-batch of a run has a folder of its own: a repeated batch replaces itself, and a new
    checkpoint, which is a new run, replaces nothing."""
    df.write.mode("overwrite").parquet(f"{path}/run={run}/batch_id={batch_id}")


def score_batch(requests: DataFrame, batch_id: int, model: AttritionModel, sinks: Sinks, run: str | None = None) -> None:
    """One micro-batch: validate, score, then log.

    Scores, quarantine and a verdict for each request are written first; the log follows from what was
    written. If it cannot be written, the stream goes on, and `repair_log` writes it later.
    """
    spark = requests.sparkSession
    run = run or spark.sparkContext.getLocalProperty(RUN) or "once"
    started = F.lit(spark.range(1).select(F.current_timestamp()).first()[0])
    requests = requests.persist()
    readable = requests.where(F.col("_corrupt_record").isNull()).withColumn(
        "request_id", F.coalesce("request_id", row_id(F.to_json(F.struct("created_at", "employees"))))
    )
    checked = validate(explode_batches(readable), payload_rules()).persist()
    try:
        keys = ["request_id", "employee_id", "position", "created_at"]
        good = typed(checked.where("is_valid"))
        snapshot = F.to_json(F.struct(*FEATURES)).alias("features_snapshot")
        scored = model.score(good.withColumn("features_snapshot", snapshot), [*keys, "features_snapshot"])
        _write(scored, sinks.scored, run, batch_id)
        unread = requests.where(F.col("_corrupt_record").isNotNull()).select(
            F.coalesce("request_id", row_id(F.col("_corrupt_record"))).alias("request_id"), F.col("_corrupt_record").alias("payload"),
            F.lit(None).cast("int").alias("position"),
        )
        rejected = checked.where(~F.col("is_valid")).select(
            "request_id", "employee_id", "position", F.to_json(F.struct(*FEATURES)).alias("payload"), "errors"
        )
        _write(rejected.unionByName(unread, allowMissingColumns=True), sinks.quarantine, run, batch_id)
        # A request counts as rejected if any of its employees is, if it has none, or if it cannot be read.
        facts = readable.groupBy("request_id").agg(
            F.min("created_at").alias("created_at"), F.min("client_ip").alias("client_ip"), F.min("user_agent").alias("user_agent")
        )
        verdicts = checked.groupBy("request_id").agg(F.count("position").alias("employee_count"), F.bool_and("is_valid").alias("ok"))
        verdicts = verdicts.join(facts, "request_id").unionByName(
            unread.select("request_id", F.lit(0).cast("long").alias("employee_count"), F.lit(False).alias("ok")).distinct(), allowMissingColumns=True
        )
        elapsed = (F.unix_millis(F.current_timestamp()) - F.unix_millis(started)).cast("int")
        verdicts = verdicts.withColumn("created_at", F.coalesce("created_at", started)).withColumn("elapsed_ms", elapsed)
        _write(verdicts, sinks.verdicts, run, batch_id)
    finally:
        checked.unpersist()
        requests.unpersist()
    try:
        write_log(spark, sinks, model.version, run, batch_id)
    except (PySparkException, Py4JJavaError) as error:
        warnings.warn(f"micro-batch {batch_id} of run {run} is scored but not logged: {str(error)[:300]}", stacklevel=2)


def write_log(spark: SparkSession, sinks: Sinks, version: str, run: str, batch_id: int) -> None:
    """Audit rows of one micro-batch, made from its scores and verdicts and published together; repeating it changes nothing."""
    scored = spark.read.parquet(f"{sinks.scored}/run={run}/batch_id={batch_id}")
    verdicts = spark.read.parquet(f"{sinks.verdicts}/run={run}/batch_id={batch_id}")
    dates = verdicts.select("request_id", F.col("created_at").alias("asked_at"))
    scored = scored.join(dates, "request_id")
    parts = [F.col("request_id"), F.col("position"), F.col("employee_id")]
    predictions = prediction_rows(scored, version, F.col("asked_at"), parts, F.col("features_snapshot"))
    payload = F.to_json(F.struct("employee_count"))
    status = F.when(F.col("ok"), ACCEPTED).otherwise(REJECTED)
    rows = request_rows(
        verdicts, ENDPOINT, payload, status, F.col("created_at"), F.col("request_id"),
        F.col("client_ip"), F.col("user_agent"), F.col("elapsed_ms"),
    )
    sinks.log.append(rows, predictions, run, batch_id)


def repair_log(spark: SparkSession, sinks: Sinks, version: str) -> int:
    """Write the log of every scored micro-batch that is not published; gives their number."""
    done = spark.read.parquet(sinks.verdicts).select(F.col("run").cast("string"), F.col("batch_id").cast("long")).distinct()
    done = done.join(sinks.log.batches(spark), ["run", "batch_id"], "left_anti")
    missing = done.collect()  # a row for each micro-batch that failed
    for batch in missing:
        write_log(spark, sinks, version, batch["run"], batch["batch_id"])
    return len(missing)


def start_scoring(
    spark: SparkSession, folder: str, model: AttritionModel, sinks: Sinks, available_now: bool = True, **options
) -> StreamingQuery:
    """Score every request file of a folder, now or continuously."""
    writer = (
        read_requests(spark, folder, **options)
        .writeStream.foreachBatch(lambda df, batch_id: score_batch(df, batch_id, model, sinks))
        .option("checkpointLocation", sinks.checkpoint)
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()
