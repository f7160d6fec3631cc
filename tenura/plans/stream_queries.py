"""Queries that run a stream over the given tables to its present end."""

from __future__ import annotations

from pyspark.sql import functions as F

from tenura.operators import quality
from tenura.plans.model_queries import loaded
from tenura.plans.quality_queries import broken
from tenura.plans.registry import query
from tenura.session import fresh_path
from tenura.sources.views import view, with_views
from tenura.streaming import scoring, volume
from tenura.streaming.replay import replay

# Days that end before the watermark: one day behind the newest event.
_CLOSED = """CAST(ts AS DATE) < CAST((SELECT MAX(ts) FROM events) - INTERVAL 1 DAY AS DATE)"""


def _event_stream(spark, folder):
    """Events as a prediction log: an event is a prediction, its user the request."""
    schema = spark.read.parquet(f"{folder}/events.parquet").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(folder)
    return stream.select(
        F.col("ts").alias("created_at"),
        F.col("user_id").alias("request_id"),
        F.when(F.col("value") < 5, "LOW").when(F.col("value") < 20, "MEDIUM").otherwise("HIGH").alias("risk_level"),
    )


def _closed(spark, folder, stream, label):
    out = fresh_path(spark, label)
    run = (
        stream.writeStream.format("parquet").outputMode("append").option("path", f"{out}/data")
        .option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start()
    )
    run.awaitTermination()
    newest = spark.read.parquet(f"{folder}/events.parquet").agg(F.max("ts")).scalar()
    closed_before = F.to_date(newest - F.expr("INTERVAL 1 DAY"))
    rows = spark.read.schema(stream.schema).parquet(f"{out}/data").where(F.col("date") < closed_before)
    return rows.withColumn("date", F.col("date").cast("string"))


@query("stream_daily_volume", f"""
    SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS date, COUNT(*) AS total_predictions
    FROM events WHERE {_CLOSED} GROUP BY 1""")
def stream_daily_volume(spark, folder):
    return _closed(spark, folder, volume.daily_volume(_event_stream(spark, folder)), "volume")


@query("stream_daily_requests", f"""
    SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS date, COUNT(DISTINCT user_id) AS total_requests
    FROM events WHERE {_CLOSED} GROUP BY 1""")
def stream_daily_requests(spark, folder):
    return _closed(spark, folder, volume.daily_requests(_event_stream(spark, folder)), "requests")


@query("stream_risk_counts", f"""
    SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS date,
           CASE WHEN value < 5 THEN 'LOW' WHEN value < 20 THEN 'MEDIUM' ELSE 'HIGH' END AS risk_level, COUNT(*) AS n
    FROM events WHERE {_CLOSED} GROUP BY 1, 2""")
def stream_risk_counts(spark, folder):
    return _closed(spark, folder, volume.risk_counts(_event_stream(spark, folder)), "risk")


# A tenth of the events is one delivery late, a tenth two deliveries: of these only a day that is still open counts.
_SPANS = 6
_ARRIVALS = f"""
    WITH ends AS (SELECT MIN(ts) AS lo, MAX(ts) AS hi FROM events),
    arrivals AS (
        SELECT ts, user_id, CAST(ts AS DATE) AS day, LEAST({_SPANS - 1},
                   FLOOR({_SPANS} * (EPOCH_US(ts) - EPOCH_US(lo))::DOUBLE / (EPOCH_US(hi) - EPOCH_US(lo) + 1)::DOUBLE))::BIGINT
               + CASE SUBSTR(MD5('late:' || CAST(event_id AS VARCHAR)), 1, 1) WHEN '0' THEN 1 WHEN '1' THEN 2 ELSE 0 END AS delivery
        FROM events, ends),
    newest AS (SELECT delivery, MAX(ts) AS top FROM arrivals GROUP BY 1),
    marks AS (
        SELECT delivery, DATE_TRUNC('millisecond', MAX(top) OVER (ORDER BY delivery ROWS BETWEEN UNBOUNDED PRECEDING
                   AND 1 PRECEDING)) - INTERVAL 1 DAY AS mark FROM newest),
    kept AS (
        SELECT a.* FROM arrivals a JOIN marks m USING (delivery)
        WHERE m.mark IS NULL OR a.day + INTERVAL 1 DAY > m.mark),
    final AS (SELECT DATE_TRUNC('millisecond', MAX(ts)) - INTERVAL 1 DAY AS mark FROM events)"""


def _delivery(spark, folder):
    """Number of the delivery that brings an event: its sixth of the time, or later for some."""
    lo, hi = spark.read.parquet(f"{folder}/events.parquet").agg(F.min(F.unix_micros(_ts())), F.max(F.unix_micros(_ts()))).first()
    if lo is None:
        return F.lit(0)
    span = F.floor(_SPANS * (F.unix_micros(_ts()) - lo).cast("double") / float(hi - lo + 1))
    digit = F.substring(F.md5(F.concat(F.lit("late:"), F.col("event_id").cast("string"))), 1, 1)
    return F.least(F.lit(_SPANS - 1), span) + F.when(digit == "0", 1).when(digit == "1", 2).otherwise(0)


def _ts():
    return F.col("ts").cast("timestamp")


def _replayed(spark, folder, daily, label):
    events = spark.read.parquet(f"{folder}/events.parquet").select("ts", "event_id", "user_id")
    named = lambda s: daily(s.select(F.col("ts").alias("created_at"), F.col("user_id").alias("request_id")))
    found = replay(events, _delivery(spark, folder), named, label)
    return found.withColumn("date", F.col("date").cast("string"))


@query("stream_late_volume", _ARRIVALS + """
    SELECT CAST(day AS VARCHAR) AS date, COUNT(*) AS total_predictions
    FROM kept, final WHERE day + INTERVAL 1 DAY <= final.mark GROUP BY 1""")
def stream_late_volume(spark, folder):
    """Events of each closed day that came before the watermark had passed the day; later ones are dropped."""
    return _replayed(spark, folder, volume.daily_volume, "late-volume")


@query("stream_score")
def stream_score(spark, folder):
    """All employee records as batch payloads, scored as a stream; one row per outcome."""
    raw = view(spark, folder, "employees_raw")
    batches = raw.groupBy(F.floor(F.col("c_custkey") / 50).cast("string").alias("request_id")).agg(
        F.lit("2024-01-31 00:00:00").alias("created_at"),
        F.collect_list(F.struct("employee_id", *quality.FEATURES)).alias("employees"),
    )
    source = fresh_path(spark, "stream-in")
    batches.write.json(source)
    sinks = scoring.Sinks(fresh_path(spark, "stream-out"))
    scoring.start_scoring(spark, source, loaded(spark, folder), sinks, files_per_batch=4).awaitTermination()
    scored = spark.read.parquet(sinks.scored).select("employee_id", "risk_level", F.lit("scored").alias("outcome"))
    held = spark.read.parquet(sinks.quarantine).select(
        "employee_id", F.lit(None).cast("string").alias("risk_level"), F.lit("quarantine").alias("outcome")
    )
    return scored.unionByName(held)


@query("stream_score_outcomes", with_views("employees_raw") + f"""
    , found AS ({broken('employees_raw')})
    SELECT employee_id, CASE WHEN LEN(errs) = 0 THEN 'scored' ELSE 'quarantine' END AS outcome, LEN(errs) = 0 AS has_level
    FROM found""")
def stream_score_outcomes(spark, folder):
    """Where each record of the stream ends: scored if it keeps the contract, else in quarantine."""
    return stream_score(spark, folder).select("employee_id", "outcome", F.col("risk_level").isNotNull().alias("has_level"))
