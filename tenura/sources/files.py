"""CSV, JSON and model-card sources and sinks."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenura.operators.prep import nan_to_null
from tenura.operators.quality import CATEGORICAL_FEATURES, FEATURES


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with a header; give a schema for large files, without one the types are inferred."""
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    return nan_to_null(reader.csv(path))


def load_raw_sources(
    spark: SparkSession, path_sirh: str, path_eval: str, path_survey: str, schemas: dict | None = None
) -> dict[str, DataFrame]:
    """The three HR extracts; a missing file raises."""
    paths = {"sirh": path_sirh, "evals": path_eval, "survey": path_survey}
    return {name: read_csv(spark, path, (schemas or {}).get(name)) for name, path in paths.items()}


def read_drop_list(spark: SparkSession, path: str) -> list[str]:
    """JSON array of column names; an absent file gives an empty list."""
    try:
        text = spark.read.text(path, wholetext=True).first()
    except AnalysisException:
        return []
    return list(json.loads(text.value)) if text else []


def write_drop_list(spark: SparkSession, names: list[str], path: str) -> None:
    rows = spark.createDataFrame([(json.dumps(names),)], "value string")
    rows.coalesce(1).write.mode("overwrite").text(path)


def read_metadata(spark: SparkSession, path: str) -> DataFrame | None:
    """Model card as one nested row; None where it cannot be read."""
    try:
        card = spark.read.option("multiLine", True).json(path)
    except AnalysisException:
        return None
    return None if "_corrupt_record" in card.columns or not card.columns else card


def batch_schema() -> T.StructType:
    """Batch payloads; employees keep the types that were sent."""
    return T.StructType(
        [
            T.StructField("request_id", T.StringType()),
            T.StructField("created_at", T.TimestampType()),
            T.StructField("client_ip", T.StringType()),
            T.StructField("user_agent", T.StringType()),
            T.StructField("employees", T.ArrayType(T.VariantType())),
            T.StructField("_corrupt_record", T.StringType()),
        ]
    )


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """Batch payloads, one JSON object per line; unreadable lines keep their text."""
    return spark.read.schema(batch_schema()).json(path)


def explode_batches(batches: DataFrame) -> DataFrame:
    """One row per employee with the id of its request and its position in it.

    Every field is text, so that validation sees what was sent, and ``not_text`` lists the text fields that
    were sent as something else. A request without employees gives one row whose position is null.
    """
    employee = F.col("employee")
    sent = {f: F.try_variant_get(employee, f"$.{f}", "variant") for f in CATEGORICAL_FEATURES}
    odd = [F.when(~F.schema_of_variant(v).isin("STRING", "VOID"), F.lit(f)) for f, v in sent.items()]
    rows = batches.select("request_id", "created_at", F.posexplode_outer("employees").alias("position", "employee"))
    return rows.select(
        "request_id", "created_at", "position",
        *[F.try_variant_get(employee, f"$.{f}", "string").alias(f) for f in ("employee_id", *FEATURES)],
        F.array_compact(F.array(*odd)).alias("not_text"),
    )


def write_metadata(card: Row | dict, spark: SparkSession, path: str) -> None:
    text = json.dumps(card.asDict(recursive=True) if isinstance(card, Row) else card, default=str)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def write_report(lines: DataFrame, path: str) -> None:
    """Report rows ``(position, section, metric, value)`` as text lines."""
    text = lines.orderBy("position").select(
        F.concat_ws(": ", F.concat_ws(" / ", "section", "metric"), "value").alias("value")
    )
    text.coalesce(1).write.mode("overwrite").text(path)
