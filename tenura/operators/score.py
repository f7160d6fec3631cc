"""Batch scoring with a saved pipeline, and facts about the model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from tenura.functions.risk import decision_columns
from tenura.operators.explain import top_features
from tenura.operators.prep import require_columns
from tenura.sources.audit_log import iso_utc
from tenura.sources.files import read_metadata

# File names inside a model folder and metric names shown by the model facts.
PIPELINE, METADATA, REPORT = "pipeline", "feature_metadata.json", "training_report.txt"
#: What Spark says of a folder that is not there or holds no pipeline; any other error is passed on.
ABSENT = ("InvalidInputException", "Input path does not exist", "PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")
SHOWN_METRICS = ("accuracy", "precision", "recall", "f1", "roc_auc")


class AttritionModel:
    """A saved pipeline (encoder, classifier) with its metadata."""

    def __init__(self, pipeline: PipelineModel, metadata: DataFrame):
        self.pipeline = pipeline
        self.metadata = metadata
        self.version = metadata.select("model_version").first()[0]

    @staticmethod
    def load(spark: SparkSession, folder: str, card_name: str = METADATA) -> "AttritionModel | None":
        """The model of a folder; None if a file is missing or unreadable."""
        card = read_metadata(spark, f"{folder}/{card_name}")
        if card is None:
            return None
        try:
            return AttritionModel(PipelineModel.load(f"{folder}/{PIPELINE}"), card)
        except (Py4JJavaError, PySparkException) as error:
            if any(sign in str(error) for sign in ABSENT):
                return None
            raise

    @property
    def encoder(self):
        return self.pipeline.stages[0]

    def probabilities(self, df: DataFrame, keys: Sequence[str]) -> DataFrame:
        """Row keys and ``attrition_prob`` as a fraction; missing columns raise."""
        inputs = require_columns(df, self.encoder.input_columns(), keys)
        scored = self.pipeline.transform(inputs)
        return scored.select(*keys, vector_to_array("probability")[1].alias("attrition_prob"))

    def score(self, df: DataFrame, keys: Sequence[str] = ("employee_id",)) -> DataFrame:
        """Decision, percents and risk level for any number of rows; one pass, no shuffle."""
        prob = self.probabilities(df, keys)
        return prob.select(
            *keys, "attrition_prob", *[c.alias(n) for n, c in decision_columns(F.col("attrition_prob")).items()]
        )

    def explain(self, df: DataFrame, keys: Sequence[str] = ("employee_id",)) -> DataFrame:
        """The five strongest contributions to each row's score."""
        inputs = require_columns(df, self.encoder.input_columns(), keys)
        encoded = self.encoder.transform(inputs)
        return top_features(encoded, self.pipeline.stages[-1], self.encoder.feature_names(), keys)

    def response(self, scored: DataFrame, elapsed_ms: int | None = None) -> DataFrame:
        """Scored rows with version, time and number of rows, as sent to a caller."""
        total = scored.agg(F.count("*")).scalar()
        return scored.withColumns(
            {
                "model_version": F.lit(self.version),
                "predicted_at": iso_utc(),
                "total_employees": total,
                "response_time_ms": F.lit(elapsed_ms).cast("int"),
            }
        )


def model_info(model: AttritionModel | None, spark: SparkSession) -> DataFrame:
    """Version, date, five rounded metrics and feature lists; no row if no model is loaded."""
    schema = ", ".join(
        ["model_version string", "training_date string", *[f"{m} double" for m in SHOWN_METRICS],
         "categorical array<string>", "numeric array<string>"]
    )
    if model is None:
        return spark.createDataFrame([], schema)
    return model.metadata.select(
        "model_version",
        "training_date",
        *[F.round(f"performance_cv.{m}_mean", 3).alias(m) for m in SHOWN_METRICS],
        F.col("features.categorical").alias("categorical"),
        F.col("features.numeric").alias("numeric"),
    )
