"""The palette of classifiers."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (
    GBTClassificationModel,
    GBTClassifier,
    LogisticRegression,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenura.functions.hashing import uniform
from tenura.operators.trees import fit_in_tasks

SEED = 42
LABEL, FEATURES, WEIGHT = "y", "features", "weight"
# Forests here need a depth limit; this one lets leaves get small on data of this kind.
FOREST_DEPTH = 10

# Settings of the boosted models.
BOOSTED = {"n_estimators": 300, "learning_rate": 0.1, "max_depth": 6, "subsample": 0.8, "colsample_bytree": 0.8}
ENHANCED = {
    "n_estimators": 200, "learning_rate": 0.1, "max_depth": 7, "min_child_weight": 3, "subsample": 0.7,
    "colsample_bytree": 1.0, "reg_alpha": 1, "reg_lambda": 5, "scale_pos_weight": 1.0, "random_state": 42,
}
#: Settings that the boosted trees here have no counterpart for.
NOT_APPLIED = ("reg_alpha", "reg_lambda", "scale_pos_weight")
FOREST_TREES = 300
#: Rows that one task of a fit reads: growing a tree is a row of short jobs, whose tasks must be worth their start.
ROWS_PER_TASK = 50_000
LOGISTIC_ITERATIONS = 1000


class _DummyParams(Params):
    keyCol = Param(Params._dummy(), "keyCol", "row key", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "0/1 label", TypeConverters.toString)
    seed = Param(Params._dummy(), "seed", "seed of the draws", TypeConverters.toInt)
    prior = Param(Params._dummy(), "prior", "share of ones, fitted", TypeConverters.toFloat)

    def _defaults(self):
        self._setDefault(keyCol="id", labelCol=LABEL, seed=SEED, prior=0.0)


class DummyStratified(Estimator, _DummyParams, DefaultParamsReadable, DefaultParamsWritable):
    """Guesses a class at random with the shares seen in training."""

    @keyword_only
    def __init__(self, *, keyCol="id", labelCol=LABEL, seed=SEED):
        super().__init__()
        self._defaults()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "DummyStratifiedModel":
        share = dataset.agg(F.avg(F.col(self.getOrDefault(self.labelCol)).cast("double"))).first()[0] or 0.0
        model = DummyStratifiedModel()
        self._copyValues(model)
        return model._set(prior=float(share))


class DummyStratifiedModel(Model, _DummyParams, DefaultParamsReadable, DefaultParamsWritable):
    def __init__(self):
        super().__init__()
        self._defaults()

    def _transform(self, dataset: DataFrame) -> DataFrame:
        get = self.getOrDefault
        one = (uniform(F.col(get(self.keyCol)), get(self.seed)) < get(self.prior)).cast("double")
        return dataset.withColumn("probability", array_to_vector(F.array(1 - one, one))).withColumn("prediction", one)


@dataclass(frozen=True)
class Classifier:
    """A named estimator; ``build`` gets the number of training rows."""

    name: str
    build: Callable[[int], Estimator]
    balanced: bool = False


def logistic(n_rows: int) -> Estimator:
    """Unit penalty on the summed loss, which per row is 1/n."""
    return LogisticRegression(
        labelCol=LABEL, featuresCol=FEATURES, weightCol=WEIGHT, maxIter=LOGISTIC_ITERATIONS,
        regParam=1.0 / max(1, n_rows), standardization=False,
    )


def forest(trees: int = FOREST_TREES) -> Callable[[int], Estimator]:
    return lambda _: RandomForestClassifier(
        labelCol=LABEL, featuresCol=FEATURES, weightCol=WEIGHT, numTrees=trees, maxDepth=FOREST_DEPTH, seed=SEED
    )


def boosted(settings: dict, trees: int | None = None) -> Callable[[int], Estimator]:
    """Gradient boosted trees; leaf penalties are not available and are left out."""
    return lambda _: GBTClassifier(
        labelCol=LABEL, featuresCol=FEATURES, maxIter=trees or settings["n_estimators"],
        maxDepth=settings["max_depth"], stepSize=settings["learning_rate"], subsamplingRate=settings["subsample"],
        featureSubsetStrategy="all" if settings["colsample_bytree"] == 1 else str(settings["colsample_bytree"]),
        minInstancesPerNode=settings.get("min_child_weight", 1), seed=settings.get("random_state", SEED),
    )


def default_classifiers(trees: int | None = None) -> dict[str, Classifier]:
    """The palette by name; ``trees`` overrides the number of trees of every ensemble."""
    found = [
        Classifier("Dummy(stratified)", lambda _: DummyStratified()),
        Classifier("LogReg", logistic, balanced=True),
        Classifier("RandomForest", forest(trees or FOREST_TREES), balanced=True),
        Classifier("BoostedTrees", boosted(BOOSTED, trees)),
        Classifier("BoostedTrees_enhanced", boosted(ENHANCED, trees)),
    ]
    return {c.name: c for c in found}


def class_counts(df: DataFrame, label: str = LABEL) -> dict[int, int]:
    return {int(r[label]): r["n"] for r in df.groupBy(label).agg(F.count("*").alias("n")).collect()}


def with_weights(df: DataFrame, counts: dict[int, int], balanced: bool, label: str = LABEL) -> DataFrame:
    """Weight of a row: all rows over classes times rows of its class, or one."""
    if not balanced:
        return df.withColumn(WEIGHT, F.lit(1.0))
    n = sum(counts.values())
    weight = F.lit(1.0)
    for value, size in counts.items():
        weight = F.when(F.col(label) == value, n / (len(counts) * size)).otherwise(weight)
    return df.withColumn(WEIGHT, weight)


def gathered(df: DataFrame, n: int) -> DataFrame:
    """The ``n`` rows in so many partitions that each task has enough to do; never more than there are."""
    return df.coalesce(max(1, -(-n // ROWS_PER_TASK)))


def fit_estimator(estimator: Estimator, rows: DataFrame, n: int) -> Model:
    """The estimator fitted to the ``n`` rows: ensembles inside tasks where that is possible, all others by MLlib."""
    ready = gathered(rows, n)
    grown = fit_in_tasks(estimator, ready, n)
    return estimator.fit(ready) if grown is None else grown


def fit_classifier(classifier: Classifier, train: DataFrame) -> Model:
    counts = class_counts(train)
    n = sum(counts.values())
    return fit_estimator(classifier.build(n), with_weights(train, counts, classifier.balanced), n)


def positive_score(model_output: DataFrame) -> Column:
    """Probability of class one, else the raw decision value."""
    if "probability" in model_output.columns:
        return vector_to_array("probability")[1]
    return vector_to_array("rawPrediction")[1]


def score(model: Model, df: DataFrame, keep: Sequence[str], out: str = "score") -> DataFrame:
    if isinstance(model, (GBTClassificationModel, RandomForestClassificationModel)):
        # trees look features up one by one, which in a sparse vector is a search
        df = df.withColumn(FEATURES, array_to_vector(vector_to_array(FEATURES)))
    done = model.transform(df)
    return done.select(*keep, positive_score(done).alias(out))
