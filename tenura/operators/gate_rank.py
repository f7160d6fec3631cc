"""Two-sided ranking as an estimator: a gate and two rankers, fitted on all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.operators.gate import GATE_CUT, TOP_NEG, TOP_POS, gate_rank_predict, gate_rank_scores
from tenura.operators.models import FEATURES, FOREST_TREES, LABEL, Classifier, fit_classifier, forest, logistic, score
from tenura.session import materialise, spread

GATE, POS, NEG = "gate", "pos_score", "neg_score"
PARTS = (GATE, POS, NEG)
#: Columns that a model adds; columns of these names in its input are replaced.
ADDED = (*PARTS, "side", "rank", "fused", "probability", "prediction")
#: Columns that a part needs for itself or leaves behind.
_SCRATCH = ("rawPrediction", "probability", "prediction")


class _GateRankParams(Params):
    keyCol = Param(Params._dummy(), "keyCol", "row key, which breaks ties of a side", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "0/1 label", TypeConverters.toString)
    featuresCol = Param(Params._dummy(), "featuresCol", "vector of features", TypeConverters.toString)
    cut = Param(Params._dummy(), "cut", "gate score from which a row is on the upper side", TypeConverters.toFloat)
    topPos = Param(Params._dummy(), "topPos", "share of the upper side predicted as 1", TypeConverters.toFloat)
    topNeg = Param(Params._dummy(), "topNeg", "share of the lower side predicted as 1", TypeConverters.toFloat)

    def _defaults(self):
        self._setDefault(
            keyCol="id", labelCol=LABEL, featuresCol=FEATURES, cut=GATE_CUT, topPos=TOP_POS, topNeg=TOP_NEG
        )


class GateRank(Estimator, _GateRankParams):
    """Fits the gate and both rankers; see :mod:`tenura.operators.gate` for what they decide.

    The parts are entries of the classifier palette: a balanced logistic gate and balanced forests by default.
    """

    def __init__(self, gate: Classifier | None = None, pos: Classifier | None = None, neg: Classifier | None = None,
                 trees: int = FOREST_TREES, **params):
        super().__init__()
        self._defaults()
        self._set(**params)
        ranker = Classifier("ranker", forest(trees), balanced=True)
        self.parts = {GATE: gate or Classifier(GATE, logistic, balanced=True), POS: pos or ranker, NEG: neg or ranker}

    def _fit(self, dataset: DataFrame) -> "GateRankModel":
        get = self.getOrDefault
        rows = dataset.select(F.col(get("labelCol")).alias(LABEL), F.col(get("featuresCol")).alias(FEATURES))
        # all parts see the same rows, so one that stands for two sides is fitted once
        fitted = {id(part): fit_classifier(part, rows) for part in {id(p): p for p in self.parts.values()}.values()}
        return self._copyValues(GateRankModel({name: fitted[id(part)] for name, part in self.parts.items()}))


class GateRankModel(Model, _GateRankParams, MLWritable, MLReadable):
    """Scores of the three parts, exact ranks inside each side, and the predictions that follow from them.

    ``probability`` holds the fused score, so the model stands where a classifier may stand. Predictions depend on
    all rows of the table, since a share of each side is taken; the scored rows are therefore written once.
    """

    def __init__(self, models: dict[str, Model] | None = None):
        super().__init__()
        self._defaults()
        self.models = models or {}

    def scores(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        """Columns ``gate``, ``pos_score`` and ``neg_score`` beside the kept ones."""
        features = self.getOrDefault("featuresCol")
        kept = [c for c in keep if c not in PARTS]
        scored = df.select(*kept, F.col(features).alias("_features"))
        for name, model in self.models.items():
            carried = [*scored.columns]
            scored = score(
                model, scored.select(F.struct(*carried).alias("_row"), F.col("_features").alias(FEATURES)), ["_row"], name
            ).select("_row.*", name)
        return scored.drop("_features")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        get = self.getOrDefault
        kept = [c for c in dataset.columns if c not in ADDED]
        scored = materialise(self.scores(spread(dataset), kept), "gate-rank")
        ranked = gate_rank_predict(scored, get("keyCol"), cut=get("cut"), top_pos=get("topPos"), top_neg=get("topNeg"))
        fused = gate_rank_scores(ranked.drop("side"), cut=get("cut"))
        return fused.select(
            *kept, *PARTS, "side", "rank", "fused",
            array_to_vector(F.array(1 - F.col("fused"), F.col("fused"))).alias("probability"),
            F.col("prediction").cast("double").alias("prediction"),
        )

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    """Parameters as metadata, each part in a folder of its own."""

    def __init__(self, model: GateRankModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        for name, part in self.model.models.items():
            part.write().session(self.sparkSession).save(f"{path}/{name}")


class _Reader(MLReader):
    def load(self, path: str) -> GateRankModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = GateRankModel({name: DefaultParamsReader.loadParamsInstance(f"{path}/{name}", self.sparkSession) for name in PARTS})
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
