"""Queries over the request and prediction log."""

from __future__ import annotations

from pyspark.sql import functions as F

from tenura.functions.risk import decision_columns
from tenura.operators import audit, quality, retention
from tenura.plans.registry import query, rounded
from tenura.session import fresh_path
from tenura.sources.audit_log import BatchLog, append_log, prediction_rows, request_rows
from tenura.sources.views import table, view, with_views

P, R = with_views("predictions"), with_views("requests")
PR = with_views("predictions", "requests")
NEWEST = "(SELECT CAST(MAX(created_at) AS DATE) FROM predictions)"
NEWEST_R = "(SELECT CAST(MAX(created_at) AS DATE) FROM requests)"


def _since(days: int, newest: str = NEWEST) -> str:
    return f"created_at >= {newest} - INTERVAL {days} DAY"


@query("avg_prob_by_department", PR + f"""
    SELECT r.request_data->>'departement' AS department,
           ROUND(AVG(p.attrition_prob), 6) AS avg_attrition_prob,
           COUNT(*) AS prediction_count
    FROM predictions p JOIN requests r ON p.request_id = r.id
    WHERE p.{_since(90)} GROUP BY 1""")
def avg_prob_by_department(spark, folder):
    predictions, requests = view(spark, folder, "predictions"), view(spark, folder, "requests")
    return rounded(audit.avg_prob_by_department(predictions, requests, audit.latest(predictions)))


@query("avg_prob_by_snapshot", PR + f"""
    SELECT r.request_data->>'departement' AS department,
           ROUND(AVG(p.attrition_prob), 6) AS avg_attrition_prob,
           COUNT(*) AS prediction_count
    FROM predictions p JOIN requests r ON p.request_id = r.id
    WHERE p.{_since(90)} GROUP BY 1""")
def avg_prob_by_snapshot(spark, folder):
    predictions = view(spark, folder, "predictions")
    shots = view(spark, folder, "requests").select(
        F.col("id").alias("request_id"), F.col("request_data").alias("features_snapshot")
    )
    joined = predictions.join(shots, "request_id")
    return rounded(audit.avg_prob_by_snapshot(joined, audit.latest(predictions)))


@query("daily_volume", P + f"""
    SELECT CAST(CAST(created_at AS DATE) AS VARCHAR) AS date, COUNT(*) AS total_predictions,
           COUNT(DISTINCT request_id) AS total_requests
    FROM predictions WHERE {_since(30)} GROUP BY 1""")
def daily_volume(spark, folder):
    predictions = view(spark, folder, "predictions")
    volume = audit.daily_volume(predictions, audit.latest(predictions))
    return volume.withColumn("date", F.col("date").cast("string"))


@query("risk_distribution", P + f"""
    SELECT risk_level, COUNT(*) AS n,
           ROUND(COUNT(*) * 100.0 / SUM(COUNT(*)) OVER (), 2)::DOUBLE AS percentage
    FROM predictions WHERE {_since(30)} GROUP BY 1""")
def risk_distribution(spark, folder):
    predictions = view(spark, folder, "predictions")
    out = audit.risk_distribution(predictions, audit.latest(predictions))
    return out.withColumn("percentage", F.col("percentage").cast("double"))


@query("latency_percentiles", R + f"""
    SELECT endpoint, COUNT(*) AS request_count, ROUND(AVG(response_time_ms), 6) AS avg_response_ms,
           ROUND(QUANTILE_CONT(response_time_ms, 0.5), 6) AS median_response_ms,
           ROUND(QUANTILE_CONT(response_time_ms, 0.95), 6) AS p95_response_ms
    FROM requests WHERE {_since(7, NEWEST_R)} GROUP BY 1""")
def latency_percentiles(spark, folder):
    requests = view(spark, folder, "requests")
    return rounded(audit.latency_percentiles(requests, audit.latest(requests)))


@query("model_version_usage", P + """
    SELECT model_version, COUNT(*) AS prediction_count, MIN(created_at) AS first_used,
           MAX(created_at) AS last_used FROM predictions GROUP BY 1""")
def model_version_usage(spark, folder):
    return audit.model_version_usage(view(spark, folder, "predictions"))


@query("count_by_risk", P + "SELECT risk_level, COUNT(*) AS n FROM predictions GROUP BY 1")
def count_by_risk(spark, folder):
    return audit.count_by_risk(view(spark, folder, "predictions"))


@query("avg_prob", P + "SELECT ROUND(COALESCE(AVG(attrition_prob), 0.0), 6) AS avg_prob FROM predictions")
def avg_prob(spark, folder):
    return rounded(audit.average_probability(view(spark, folder, "predictions")))


@query("count_avg_by_risk", P + """
    SELECT risk_level, COUNT(*) AS n, ROUND(AVG(attrition_prob), 6) AS avg_prob
    FROM predictions GROUP BY 1""")
def count_avg_by_risk(spark, folder):
    return rounded(audit.count_avg_by_risk(view(spark, folder, "predictions")))


@query("table_counts", PR + """
    SELECT 'requests' AS "table", COUNT(*) AS n FROM requests
    UNION ALL SELECT 'predictions', COUNT(*) FROM predictions
    UNION ALL SELECT 'high_risk', COUNT(*) FROM predictions WHERE risk_level = 'HIGH'""")
def table_counts(spark, folder):
    predictions = view(spark, folder, "predictions")
    return audit.table_counts(
        {
            "requests": view(spark, folder, "requests"),
            "predictions": predictions,
            "high_risk": predictions.where(F.col("risk_level") == "HIGH"),
        }
    )


@query("high_risk_recent", P + f"""
    SELECT * FROM predictions WHERE risk_level = 'HIGH' AND {_since(30)}""")
def high_risk_recent(spark, folder):
    predictions = view(spark, folder, "predictions")
    return audit.high_risk_recent(predictions, audit.latest(predictions))


@query("risk_or_prob", P + """
    SELECT id, risk_level, attrition_prob FROM predictions
    WHERE risk_level = 'HIGH' OR attrition_prob > 0.8""")
def risk_or_prob(spark, folder):
    return audit.risk_or_prob(view(spark, folder, "predictions")).select("id", "risk_level", "attrition_prob")


@query("predictions_by_request", P + "SELECT * FROM predictions WHERE request_id = 7")
def predictions_by_request(spark, folder):
    return audit.predictions_by_request(view(spark, folder, "predictions"), 7)


@query("request_by_id", R + "SELECT * FROM requests WHERE id = 7")
def request_by_id(spark, folder):
    return audit.request_by_id(view(spark, folder, "requests"), 7)


@query("employee_history", P + "SELECT * FROM predictions WHERE employee_id = '7'")
def employee_history(spark, folder):
    return audit.employee_history(view(spark, folder, "predictions"), "7")


# Log ids can occur twice in the given tables, hence only the ordering columns are shown.
@query("recent_predictions", P + """
    SELECT created_at, id FROM predictions ORDER BY created_at DESC, id LIMIT 100""")
def recent_predictions(spark, folder):
    return audit.newest(view(spark, folder, "predictions").select("created_at", "id"), 100)


@query("predictions_page", P + """
    SELECT created_at, id FROM predictions ORDER BY created_at DESC, id LIMIT 20 OFFSET 40""")
def predictions_page(spark, folder):
    return audit.page(view(spark, folder, "predictions").select("created_at", "id"), 40, 20)


@query("predictions_page_after", P + """
    , mark AS (SELECT MAX(created_at) AS m FROM predictions WHERE risk_level = 'LOW')
    SELECT created_at, id FROM predictions, mark
    WHERE created_at < m OR (created_at = m AND id > '5')
    ORDER BY created_at DESC, id LIMIT 20""")
def predictions_page_after(spark, folder):
    predictions = view(spark, folder, "predictions")
    mark = audit.latest(predictions.where(F.col("risk_level") == "LOW"))
    return audit.page_after(predictions.select("created_at", "id"), mark, "5", 20)


@query("top_prob", P + """
    SELECT attrition_prob, id FROM predictions ORDER BY attrition_prob DESC, id LIMIT 10""")
def top_prob(spark, folder):
    return audit.top_probability(view(spark, folder, "predictions").select("attrition_prob", "id"))


@query("requests_with_predictions", PR + """
    , given AS (
        SELECT request_id, id AS prediction_id, risk_level,
               ROW_NUMBER() OVER (PARTITION BY request_id ORDER BY MD5('0:' || id), id) AS position
        FROM predictions)
    SELECT r.id, r.endpoint, g.position, g.prediction_id, g.risk_level
    FROM requests r LEFT JOIN given g ON r.id = g.request_id""")
def requests_with_predictions(spark, folder):
    given = audit.requests_with_predictions(view(spark, folder, "requests"), view(spark, folder, "predictions"))
    return given.select("id", "endpoint", "position", "prediction_id", "risk_level")


@query("fk_orphans", PR + """
    SELECT p.id, p.request_id FROM predictions p
    WHERE NOT EXISTS (SELECT 1 FROM requests r WHERE r.id = p.request_id AND r.http_status = 200)""")
def fk_orphans(spark, folder):
    logged = view(spark, folder, "requests").where(F.col("http_status") == 200)
    return quality.orphans(view(spark, folder, "predictions").select("id", "request_id"), logged)


@query("pk_duplicates", """
    SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS id, COUNT(*) AS n
    FROM lineitem GROUP BY 1 HAVING COUNT(*) > 1""")
def pk_duplicates(spark, folder):
    """Order and line number are no key of these lines."""
    key = F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("id")
    return quality.duplicate_keys(table(spark, folder, "lineitem").select(key), "id")


EXPIRED = """, gone AS (
    SELECT id FROM requests
    WHERE created_at < (SELECT MAX(created_at) FROM requests) - INTERVAL 365 DAY)"""


@query("retention_kept", PR + EXPIRED + """
    SELECT id, request_id, created_at FROM predictions WHERE request_id NOT IN (SELECT id FROM gone)""")
def retention_kept(spark, folder):
    predictions, requests = view(spark, folder, "predictions"), view(spark, folder, "requests")
    kept = retention.kept_predictions(predictions, requests, audit.latest(requests))
    return kept.select("id", "request_id", "created_at")


@query("retention_deleted", PR + EXPIRED + """
    SELECT (SELECT COUNT(*) FROM gone) AS requests_deleted,
           (SELECT COUNT(*) FROM predictions WHERE request_id IN (SELECT id FROM gone)) AS predictions_deleted""")
def retention_deleted(spark, folder):
    predictions, requests = view(spark, folder, "predictions"), view(spark, folder, "requests")
    newest = audit.latest(requests)
    requests_deleted = retention.expired_requests(requests, newest).agg(F.count("*").alias("requests_deleted"))
    predictions_deleted = retention.deleted_predictions(predictions, requests, newest).agg(F.count("*")).scalar()
    return requests_deleted.withColumn("predictions_deleted", predictions_deleted)


@query("retention_cleanup", PR + EXPIRED + """
    SELECT (SELECT COUNT(*) FROM gone) AS requests_deleted, COUNT(*) AS predictions_kept,
           (SELECT COUNT(*) FROM requests WHERE id NOT IN (SELECT id FROM gone)) AS requests_kept
    FROM predictions WHERE request_id NOT IN (SELECT id FROM gone)""")
def retention_cleanup(spark, folder):
    """The written log, cleaned in place."""
    _, _, paths = _written_log(spark, folder)
    newest = audit.latest(view(spark, folder, "requests"))
    removed = retention.cleanup(spark, *paths, newest)
    counts = [spark.read.parquet(p).agg(F.count("*")).scalar() for p in paths]
    return spark.range(1).select(
        F.lit(removed).cast("long").alias("requests_deleted"), counts[1].alias("predictions_kept"), counts[0].alias("requests_kept")
    )


@query("erase_employee", P + """
    SELECT id, employee_id FROM predictions
    WHERE employee_id NOT IN (SELECT CAST(p_partkey AS VARCHAR) FROM part WHERE p_size = 1)""")
def erase_employee(spark, folder):
    asked = table(spark, folder, "part").where(F.col("p_size") == 1)
    ids = asked.select(F.col("p_partkey").cast("string").alias("employee_id"))
    return retention.erase_employee(view(spark, folder, "predictions"), ids).select("id", "employee_id")


@query("pseudonymise", P + "SELECT id, SHA256('pepper' || employee_id) AS employee_id FROM predictions")
def pseudonymise(spark, folder):
    return retention.pseudonymise(view(spark, folder, "predictions"), "pepper").select("id", "employee_id")


@query("accuracy_over_time", P + """
    , judged AS (
        SELECT STRFTIME(p.created_at, '%Y-%m') AS month, p.attrition_prob >= 0.5 AS said, q.p_size > 25 AS actual
        FROM predictions p JOIN part q ON p.employee_id = CAST(q.p_partkey AS VARCHAR))
    SELECT month, COUNT(*) FILTER (said AND actual) AS tp, COUNT(*) FILTER (said AND NOT actual) AS fp,
           COUNT(*) FILTER (NOT said AND actual) AS fn, COUNT(*) FILTER (NOT said AND NOT actual) AS tn,
           ROUND(AVG(CASE WHEN said = actual THEN 1.0 ELSE 0.0 END), 6) AS accuracy
    FROM judged GROUP BY 1""")
def accuracy_over_time(spark, folder):
    outcomes = table(spark, folder, "part").select(
        F.col("p_partkey").cast("string").alias("employee_id"), (F.col("p_size") > 25).alias("actual")
    )
    return rounded(audit.accuracy_over_time(view(spark, folder, "predictions"), outcomes))


UUID_SQL = (
    "SUBSTR({h}, 1, 8) || '-' || SUBSTR({h}, 9, 4) || '-' || SUBSTR({h}, 13, 4) || '-' || "
    "SUBSTR({h}, 17, 4) || '-' || SUBSTR({h}, 21, 12)"
)


@query("audit_requests", R + f"""
    SELECT {UUID_SQL.format(h="MD5('request|' || CAST(id AS VARCHAR))")} AS id, created_at, '/api/v1/predict' AS endpoint,
           request_data, http_status, response_time_ms, CAST(CAST(created_at AS DATE) AS VARCHAR) AS created_date
    FROM requests""")
def audit_requests(spark, folder):
    requests = view(spark, folder, "requests")
    rows = request_rows(
        requests, "/api/v1/predict", F.col("request_data"), F.col("http_status"), F.col("created_at"),
        F.col("id"), response_time_ms=F.col("response_time_ms"),
    )
    path = fresh_path(spark, "requests")
    append_log(rows, path)
    back = spark.read.schema(rows.schema).parquet(path)
    return back.select(
        "id", "created_at", "endpoint", "request_data", "http_status", "response_time_ms",
        F.col("created_date").cast("string").alias("created_date"),
    )


@query("audit_predictions", P + f"""
    SELECT {UUID_SQL.format(h="MD5(id)")} AS id,
           {UUID_SQL.format(h="MD5('request|' || CAST(request_id AS VARCHAR))")} AS request_id, employee_id,
           created_at AS prediction_date, ROUND(attrition_prob, 6) AS attrition_prob, risk_level,
           'v1' AS model_version, CAST(CAST(created_at AS DATE) AS VARCHAR) AS created_date
    FROM predictions""")
def audit_predictions(spark, folder):
    predictions = view(spark, folder, "predictions")
    rows = prediction_rows(predictions, "v1", F.col("created_at"), [F.col("id")])
    path = fresh_path(spark, "predictions")
    append_log(rows, path)
    back = spark.read.schema(rows.schema).parquet(path)
    return rounded(
        back.select(
            "id", "request_id", "employee_id", "prediction_date", "attrition_prob", "risk_level", "model_version",
            F.col("created_date").cast("string").alias("created_date"),
        )
    )


def _written_log(spark, folder):
    """Both tables of the log, written (here a folder holds a month) and read back, and their folders."""
    requests, predictions = view(spark, folder, "requests"), view(spark, folder, "predictions")
    asked = request_rows(
        requests, "/api/v1/predict", F.col("request_data"), F.col("http_status"), F.col("created_at"), F.col("id")
    )
    given = prediction_rows(predictions, "v1", F.col("created_at"), [F.col("id")])
    back, paths = [], []
    for rows, label in ((asked, "requests"), (given, "predictions")):
        paths.append(fresh_path(spark, label))
        append_log(rows.withColumn("created_date", F.trunc("created_date", "MM")), paths[-1])
        back.append(spark.read.schema(rows.schema).parquet(paths[-1]))
    return *back, paths


@query("log_join", PR + """
    SELECT r.http_status, p.risk_level, COUNT(*) AS n, COUNT(DISTINCT p.request_id) AS n_requests
    FROM predictions p LEFT JOIN requests r ON p.request_id = r.id GROUP BY 1, 2""")
def log_join(spark, folder):
    """The written log joined to itself over its own keys; a prediction without its request has no status."""
    requests, predictions, _ = _written_log(spark, folder)
    asked = requests.select(F.col("id").alias("request_id"), "http_status")
    per_request = predictions.groupBy("request_id", "risk_level").agg(F.count("*").alias("n"))
    return per_request.join(asked, "request_id", "left").groupBy("http_status", "risk_level").agg(
        F.sum("n").alias("n"), F.count("*").alias("n_requests")
    )


@query("log_commit", PR + """
    , r AS (SELECT id % 4 AS batch, COUNT(*) AS n_requests FROM requests WHERE id % 4 < 2 GROUP BY 1),
      p AS (SELECT request_id % 4 AS batch, COUNT(*) AS n_predictions FROM predictions WHERE request_id % 4 < 2 GROUP BY 1)
    SELECT batch, n_requests, n_predictions FROM r JOIN p USING (batch)""")
def log_commit(spark, folder):
    """The log written in four batches: two are published, one loses its writer between its tables, one before its commit."""
    requests, predictions = view(spark, folder, "requests"), view(spark, folder, "predictions")
    root = fresh_path(spark, "batch-log")
    log = BatchLog(f"{root}/requests", f"{root}/predictions", f"{root}/commits")
    year = F.trunc("created_date", "YEAR")
    for batch in range(4):
        asked = request_rows(
            requests.where(F.col("id") % 4 == batch), "/api/v1/predict", F.col("request_data"), F.col("http_status"), F.col("created_at"), F.col("id")
        ).withColumn("created_date", year)
        given = prediction_rows(predictions.where(F.col("request_id") % 4 == batch), "v1", F.col("created_at"), [F.col("id")]).withColumn("created_date", year)
        if batch < 2:
            log.append(asked, given, "query", batch)
            continue
        log.write(given, log.predictions, "query", batch)
        if batch == 3:
            log.write(asked, log.requests, "query", batch)
    requests, predictions = log.published(spark)
    asked = requests.groupBy(F.col("batch_id").alias("batch")).agg(F.count("*").alias("n_requests"))
    given = predictions.groupBy(F.col("batch_id").alias("batch")).agg(F.count("*").alias("n_predictions"))
    return asked.join(given, "batch")


@query("risk_bucket", P + """
    SELECT id, attrition_prob >= 0.5 AS will_leave, ROUND(attrition_prob * 100, 2) AS probability_leave,
           ROUND((1 - attrition_prob) * 100, 2) AS probability_stay,
           CASE WHEN attrition_prob * 100 < 40 THEN 'LOW' WHEN attrition_prob * 100 < 60 THEN 'MEDIUM'
                ELSE 'HIGH' END AS risk_level
    FROM predictions""")
def risk_bucket(spark, folder):
    predictions = view(spark, folder, "predictions").select("id", "attrition_prob")
    return predictions.select("id", *[c.alias(n) for n, c in decision_columns(F.col("attrition_prob")).items()])
