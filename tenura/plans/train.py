"""The training job: join, prune, encode, validate, fit on all rows, write model, card and report."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura.operators.features import make_encoder
from tenura.operators.models import NOT_APPLIED, ENHANCED, Classifier, boosted, class_counts, fit_estimator, with_weights
from tenura.operators.prep import keep_present, map_target, split_feature_types
from tenura.operators.quality import CATEGORICAL_FEATURES
from tenura.operators.score import METADATA, PIPELINE, REPORT
from tenura.plans.crossval import Evaluation, cross_validate
from tenura.session import materialise
from tenura.sources.files import write_metadata, write_report
from tenura.sources.model_store import ModelStore, fingerprint

MODEL_VERSION = "boosted_enhanced_v1.0"


NAME = "attrition"


@dataclass(frozen=True)
class Fitted:
    """A pipeline fitted to all rows, and its card without scores."""

    pipeline: PipelineModel
    metadata: dict


@dataclass(frozen=True)
class Training:
    pipeline: PipelineModel
    evaluation: Evaluation
    metadata: dict
    folder: str


@dataclass(frozen=True)
class Job:
    """What a model is trained on, and how."""

    rows: DataFrame  # id, y and features of rows with a known target
    cats: list[str]
    nums: list[str]
    drop_list: list[str]
    settings: dict
    trees: int | None
    n_features_raw: int

    @property
    def classifier(self) -> Classifier:
        return Classifier("BoostedTrees_enhanced", boosted(self.settings, self.trees))

    @property
    def fingerprint(self) -> str:
        return fingerprint(self.rows, {"model": MODEL_VERSION, "cats": self.cats, "nums": self.nums, "drop": self.drop_list, "trees": self.trees, **self.settings})


def feature_lists(
    df: DataFrame, target: str, drop_list: list[str], keys: list[str], categorical=CATEGORICAL_FEATURES
) -> tuple[list[str], list[str]]:
    """Categorical features of the given list, and all numeric ones that are not dropped."""
    numeric, other = split_feature_types(df, target)
    return keep_present(other, categorical, drop_list), keep_present(numeric, numeric, [*drop_list, *keys])


def report_lines(spark: SparkSession, card: dict) -> DataFrame:
    """Card as ``(position, section, metric, value)`` rows."""
    data, balance = card["dataset"], card["dataset"]["class_balance"]
    n, perf = data["n_samples"], card["performance_cv"]
    share = lambda k: f"{balance[k]} ({balance[k] / n:.1%})"
    rows = [
        ("RUN", "fitted at", card["training_date"]),
        ("RUN", "version", card["model_version"]),
        ("ROWS", "used", str(n)),
        ("ROWS", "columns before encoding", str(data["n_features_raw"])),
        ("ROWS", "columns after encoding", str(data["n_features_encoded"])),
        ("ROWS", "stayed", share("class_0_stayed")),
        ("ROWS", "left", share("class_1_left")),
    ]
    shown = ("accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc")
    rows += [
        ("FOLDS", f"{m}, mean and deviation", f"{perf[f'{m}_mean']:.3f} / {perf[f'{m}_std']:.3f}") for m in shown
    ]
    rows += [("SETTINGS", k, str(v)) for k, v in card["hyperparameters"].items()]
    rows += [("SETTINGS WITHOUT EFFECT", k, str(v)) for k, v in card["hyperparameters_not_applied"].items()]
    rows += [("FOLDER", kind, name) for kind, name in (("pipeline", PIPELINE), ("card", METADATA), ("report", REPORT))]
    return spark.createDataFrame(
        [(i, *r) for i, r in enumerate(rows)], "position int, section string, metric string, value string"
    )


def prepare(
    df: DataFrame,
    *,
    key: str,
    target: str,
    drop_list: list[str],
    settings: dict = ENHANCED,
    trees: int | None = None,
    n_features_raw: int | None = None,
) -> Job:
    labelled = map_target(df, target, "y").withColumn("id", F.col(key).cast("string"))
    rows = materialise(labelled.where(F.col("y").isNotNull()), "training-rows")
    cats, nums = feature_lists(df, target, drop_list, [key])
    return Job(rows, cats, nums, drop_list, settings, trees, n_features_raw or len(df.columns) - 2)


def fit(job: Job) -> Fitted:
    """Fit encoder and classifier to every row; no cross-validation."""
    counts = class_counts(job.rows)
    n = sum(counts.values())
    weighted = with_weights(job.rows, counts, job.classifier.balanced)
    encoder = make_encoder(job.cats, job.nums).fit(weighted)
    pipeline = PipelineModel([encoder, fit_estimator(job.classifier.build(n), encoder.transform(weighted), n)])
    names = encoder.feature_names()
    settings = job.settings
    used = {k: v for k, v in {**settings, "n_estimators": job.trees or settings["n_estimators"]}.items() if k not in NOT_APPLIED}
    card = {
        "model_version": MODEL_VERSION,
        "training_date": datetime.now(timezone.utc).isoformat(),
        "dataset": {
            "n_samples": n,
            "n_features_raw": job.n_features_raw,
            "n_features_encoded": len(names),
            "class_balance": {
                "class_0_stayed": counts.get(0, 0),
                "class_1_left": counts.get(1, 0),
                "attrition_rate": counts.get(1, 0) / n,
            },
        },
        "features": {
            "categorical": job.cats, "numeric": job.nums, "dropped_correlated": job.drop_list, "total_input": len(job.cats) + len(job.nums),
        },
        "hyperparameters": used,
        "hyperparameters_not_applied": {k: v for k, v in settings.items() if k in NOT_APPLIED},
    }
    return Fitted(pipeline, card)


def validate(job: Job, card: dict, k: int = 5) -> tuple[Evaluation, dict]:
    """Scores of unseen rows, and the card with their means."""
    evaluation = cross_validate(job.rows, make_encoder(job.cats, job.nums), {job.classifier.name: job.classifier}, k=k)
    performance = {}
    for row in evaluation.summary().collect():
        name = "pr_auc" if row["metric"] == "average_precision" else row["metric"]
        performance |= {f"{name}_mean": row["mean"], f"{name}_std": row["std"]}
    return evaluation, {**card, "performance_cv": performance}


def train(df: DataFrame, folder: str, *, k: int = 5, **options) -> Training:
    """Train on every row with a known target, validate, and write all results below ``folder``.

    The final fit runs beside the folds. Options are those of `prepare`.
    """
    spark = df.sparkSession
    job = prepare(df, **options)
    with ThreadPoolExecutor(1) as pool:
        fitted = pool.submit(fit, job)
        evaluation, scores = validate(job, {}, k)
        done = fitted.result()
    card = {**done.metadata, **scores}
    done.pipeline.write().overwrite().save(f"{folder}/{PIPELINE}")
    write_metadata(card, spark, f"{folder}/{METADATA}")
    write_report(report_lines(spark, card), f"{folder}/{REPORT}")
    return Training(done.pipeline, evaluation, card, folder)


def stored(store: ModelStore, job: Job) -> str:
    """Version of this training's model in the store; it is fitted and published only if there is none."""
    print_ = job.fingerprint
    known = store.versions(NAME, print_)
    if known:
        return known[0]
    done = fit(job)
    return store.publish(NAME, print_, done.pipeline, {**done.metadata, "fingerprint": print_})


def scored(store: ModelStore, job: Job, k: int = 5) -> tuple[str, DataFrame | None]:
    """Version of the model with the means over folds on its card, and the summary if it was made now."""
    version = stored(store, job)
    if store.is_scored(NAME, version):
        return version, None
    spark = store.spark
    card = store.load(NAME, version).metadata.first().asDict(recursive=True)
    evaluation, card = validate(job, card, k)
    store.add_scores(NAME, version, card, report_lines(spark, card))
    return version, evaluation.summary()
