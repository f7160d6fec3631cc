"""Queries that check records against their contract."""

from __future__ import annotations

from pyspark.sql import functions as F

from tenura.operators import quality
from tenura.plans.registry import query
from tenura.session import fresh_path
from tenura.sources import files
from tenura.sources.views import table, view, with_views

E = with_views("employees_raw")


def _item(condition: str, field: str, rule: str) -> str:
    return f"CASE WHEN {condition} THEN '{field}:{rule}' END"


def _whole(field: str) -> str:
    number = f"TRY_CAST({field} AS DOUBLE)"
    return f"(CASE WHEN {number} = FLOOR({number}) THEN {number} END)"


def _record_items() -> list[str]:
    items = [_item(f"{f} IS NULL", f, "required") for f in ("employee_id", *quality.FEATURES)]
    for field in quality.INTEGER_FIELDS:
        items.append(_item(f"{field} IS NOT NULL AND {_whole(field)} IS NULL", field, "whole_number"))
    items.append(_item("revenu_mensuel IS NOT NULL AND TRY_CAST(revenu_mensuel AS DOUBLE) IS NULL",
                       "revenu_mensuel", "number"))
    for field, (low, high) in quality.INTEGER_FIELDS.items():
        bounds = [f"{_whole(field)} < {low}"] if low is not None else []
        bounds += [f"{_whole(field)} > {high}"] if high is not None else []
        items.append(_item(" OR ".join(bounds), field, "range"))
    items.append(_item("TRY_CAST(revenu_mensuel AS DOUBLE) <= 0", "revenu_mensuel", "range"))
    for field, allowed in quality.ENUM_FIELDS.items():
        words = ", ".join(f"'{w}'" for w in allowed)
        items.append(_item(f"{field} NOT IN ({words})", field, "enum"))
    return items


def broken(source: str) -> str:
    """SQL list of the rules that a record of ``source`` breaks, beside its columns."""
    return f"SELECT *, LIST_FILTER([{', '.join(_record_items())}], lambda x: x IS NOT NULL) AS errs FROM {source}"


@query("validate_rows", E + f"""
    , found AS ({broken('employees_raw')})
    SELECT c_custkey, LEN(errs) = 0 AS is_valid, LEN(errs) AS n_errors, ARRAY_TO_STRING(errs, ',') AS errors
    FROM found""")
def validate_rows(spark, folder):
    checked = quality.validate(view(spark, folder, "employees_raw"))
    shown = F.transform("errors", lambda e: F.concat_ws(":", e["field"], e["rule"]))
    return checked.select(
        "c_custkey", "is_valid", F.size("errors").cast("long").alias("n_errors"), F.array_join(shown, ",").alias("errors")
    )


@query("validate_types", E + f"""
    SELECT c_custkey, age AS age_text, CAST({_whole('age')} AS INT) AS age,
           age IS NOT NULL AND {_whole('age')} IS NULL AS type_error FROM employees_raw""")
def validate_types(spark, folder):
    raw = view(spark, folder, "employees_raw")
    checked = raw.withColumn("errs", quality.broken_rules(quality.type_rules()))
    return checked.select(
        "c_custkey",
        F.col("age").alias("age_text"),
        quality.as_whole(F.col("age")).alias("age"),
        F.exists("errs", lambda e: e["field"] == "age").alias("type_error"),
    )


@query("batch_size_check", """
    SELECT o_custkey AS batch_id, COUNT(*) AS batch_size, COUNT(*) BETWEEN 1 AND 12 AS is_valid
    FROM orders GROUP BY 1""")
def batch_size_check(spark, folder):
    batches = table(spark, folder, "orders").select(F.col("o_custkey").alias("batch_id"))
    return quality.batch_size_check(batches, "batch_id", (1, 12))


@query("check_predictions", with_views("predictions") + """
    , logged AS (SELECT *, CASE WHEN model_version = 'R' THEN attrition_prob * 100 ELSE attrition_prob END AS prob
                 FROM predictions)
    SELECT field, rule, n FROM (
        SELECT 'request_id' AS field, 'required' AS rule, COUNT(*) FILTER (request_id IS NULL) AS n FROM logged
        UNION ALL SELECT 'id', 'required', COUNT(*) FILTER (id IS NULL) FROM logged
        UNION ALL SELECT 'created_at', 'required', COUNT(*) FILTER (created_at IS NULL) FROM logged
        UNION ALL SELECT 'prediction_date', 'required', COUNT(*) FILTER (created_at IS NULL) FROM logged
        UNION ALL SELECT 'attrition_prob', 'between_0_and_1', COUNT(*) FILTER (NOT prob BETWEEN 0 AND 1) FROM logged
        UNION ALL SELECT 'risk_level', 'enum', COUNT(*) FILTER (risk_level NOT IN ('LOW', 'MEDIUM', 'HIGH')) FROM logged
        UNION ALL SELECT 'employee_id', 'max_length_50', COUNT(*) FILTER (LENGTH(employee_id) > 50) FROM logged
        UNION ALL SELECT 'risk_level', 'max_length_10', COUNT(*) FILTER (LENGTH(risk_level) > 10) FROM logged
        UNION ALL SELECT 'model_version', 'required', COUNT(*) FILTER (model_version IS NULL) FROM logged
        UNION ALL SELECT 'model_version', 'max_length_50', COUNT(*) FILTER (LENGTH(model_version) > 50) FROM logged)""")
def check_predictions(spark, folder):
    """One model version logs percents where the table wants fractions; the rule finds these rows."""
    clash = F.when(F.col("model_version") == "R", F.col("attrition_prob") * 100).otherwise(F.col("attrition_prob"))
    logged = view(spark, folder, "predictions").withColumn("attrition_prob", clash)
    logged = logged.withColumn("prediction_date", F.col("created_at"))
    return quality.broken_rule_counts(logged, quality.prediction_rules())


@query("check_requests", with_views("requests") + """
    , logged AS (SELECT *, CASE WHEN http_status = 200 THEN http_status END AS status, REPEAT('f', CAST(id % 60 AS INT)) AS ip FROM requests)
    SELECT field, rule, n FROM (
        SELECT 'id' AS field, 'required' AS rule, COUNT(*) FILTER (id IS NULL) AS n FROM logged
        UNION ALL SELECT 'created_at', 'required', COUNT(*) FILTER (created_at IS NULL) FROM logged
        UNION ALL SELECT 'endpoint', 'required', COUNT(*) FILTER (endpoint IS NULL) FROM logged
        UNION ALL SELECT 'endpoint', 'max_length_100', COUNT(*) FILTER (LENGTH(endpoint) > 100) FROM logged
        UNION ALL SELECT 'request_data', 'required', COUNT(*) FILTER (request_data IS NULL) FROM logged
        UNION ALL SELECT 'client_ip', 'max_length_45', COUNT(*) FILTER (LENGTH(ip) > 45) FROM logged
        UNION ALL SELECT 'http_status', 'required', COUNT(*) FILTER (status IS NULL) FROM logged)""")
def check_requests(spark, folder):
    """Request rows with addresses that are too long now and then, and statuses that are missing."""
    logged = view(spark, folder, "requests").withColumn("client_ip", F.repeat(F.lit("f"), (F.col("id") % 60).cast("int")))
    logged = logged.withColumn("http_status", F.when(F.col("http_status") == 200, F.col("http_status")))
    return quality.broken_rule_counts(logged, quality.request_rules())


@query("check_outputs", with_views("predictions") + """
    SELECT field, rule, n FROM (
        SELECT 'probability_leave' AS field, 'between_0_and_100' AS rule,
               COUNT(*) FILTER (NOT attrition_prob * 120 BETWEEN 0 AND 100) AS n FROM predictions
        UNION ALL SELECT 'risk_level', 'enum', COUNT(*) FILTER (LOWER(risk_level) = 'low') FROM predictions)""")
def check_outputs(spark, folder):
    """Scores stretched beyond 100 percent, and one level in lower case."""
    level = F.when(F.col("risk_level") == "LOW", "low").otherwise(F.col("risk_level"))
    given = view(spark, folder, "predictions").select((F.col("attrition_prob") * 120).alias("probability_leave"), level.alias("risk_level"))
    return quality.broken_rule_counts(given, quality.output_rules())


@query("batch_explode", E + """
    SELECT CAST(CAST(FLOOR(c_custkey / 50) AS BIGINT) AS VARCHAR) AS request_id, employee_id, age, genre,
           heure_supplementaires FROM employees_raw""")
def batch_explode(spark, folder):
    """Employees as batch payloads of at most 50, written as JSON lines and read back."""
    raw = view(spark, folder, "employees_raw")
    batch = F.floor(F.col("c_custkey") / 50).cast("string").alias("request_id")
    fields = ["employee_id", *quality.FEATURES]
    batches = raw.groupBy(batch).agg(F.collect_list(F.struct(*fields)).alias("employees"))
    path = fresh_path(spark, "batches")
    batches.write.json(path)
    return files.explode_batches(files.read_batches(spark, path)).select(
        "request_id", "employee_id", "age", "genre", "heure_supplementaires"
    )
