"""Queries that train, compare, score and explain.

All have the palette's defaults: full ensembles, all classifiers and five folds. Queries about the same
unseen scores share one cross-validation.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from tenura.operators import metrics, models, quality, score
from tenura.operators.features import make_encoder
from tenura.operators.gate import GATE_CUT, TOP_NEG, TOP_POS
from tenura.operators.gate_rank import GateRank
from tenura.operators.prep import TARGET, map_target
from tenura.operators.ranking import running_totals
from tenura.operators.resample import make_samplers
from tenura.plans.crossval import cross_validate, threshold_table
from tenura.plans.quality_queries import broken
from tenura.plans.registry import query, rounded
from tenura.plans.train import NAME, prepare, report_lines, scored, stored
from tenura.session import fresh_path, materialise, shared_dir, spread
from tenura.sources.model_store import STORE_SETTING, ModelStore
from tenura.sources.views import table, view, with_views

# What can be known of a model's results without the model: the records that are scored.
VALID = with_views("attrition") + f", found AS ({broken('attrition')}), valid AS (SELECT * FROM found WHERE LEN(errs) = 0)"
ENCODER = dict(cats=quality.CATEGORICAL_FEATURES, nums=quality.NUMERIC_FEATURES)


def valid_employees(spark, folder):
    """Records that keep the contract, typed."""
    return quality.split_valid(view(spark, folder, "attrition"))[0]


def spread_employees(spark, folder):
    """The same records, checked on all cores, for what does not follow their order."""
    return quality.split_valid(spread(view(spark, folder, "attrition")))[0]


def labelled(spark, folder):
    rows = map_target(valid_employees(spark, folder), TARGET, "y")
    return materialise(rows.withColumn("id", F.col("employee_id")), "labelled")


def _encoded(spark, folder):
    rows = labelled(spark, folder)
    return materialise(make_encoder(**ENCODER).fit(rows).transform(rows).select("id", "y", "features"), "encoded")


def _fit_and_rate(spark, folder, name):
    """Metrics of a model on its own training rows."""
    train_rows = _encoded(spark, folder)
    model = models.fit_classifier(models.default_classifiers()[name], train_rows)
    # written once: the metrics read the scores several times
    rated = materialise(models.score(model, spread(train_rows), ["id", "y"]).withColumn("model", F.lit(name)), "rated")
    return rounded(metrics.all_metrics(rated, ["model"]))


_EMB = with_views("emb")


@query("clf_dummy", _EMB + """
    SELECT id, y, CASE WHEN ('0x' || SUBSTR(MD5('42:' || CAST(id AS VARCHAR)), 1, 8))::BIGINT / 4294967296.0::DOUBLE
                            < (SELECT AVG(y) FROM emb) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS score FROM emb""")
def clf_dummy(spark, folder):
    emb = view(spark, folder, "emb")
    return models.score(models.DummyStratified().fit(emb), emb, ["id", "y"])


@query("clf_logreg")
def clf_logreg(spark, folder):
    return _fit_and_rate(spark, folder, "LogReg")


@query("clf_rf")
def clf_rf(spark, folder):
    return _fit_and_rate(spark, folder, "RandomForest")


@query("clf_gbt")
def clf_gbt(spark, folder):
    return _fit_and_rate(spark, folder, "BoostedTrees")


@query("clf_gbt_enhanced")
def clf_gbt_enhanced(spark, folder):
    return _fit_and_rate(spark, folder, "BoostedTrees_enhanced")


def _contents(spark, folder):
    """A number that follows the rows of the customers."""
    rows = table(spark, folder, "customer")
    return hash(rows.agg(F.sum(F.xxhash64(*rows.columns).cast("decimal(38,0)"))).first()[0])


@lru_cache(maxsize=8)
def _evaluated(app: str, spark, folder: str, data: int):
    """One cross-validation of the palette per session, folder and contents of its customers."""
    return cross_validate(labelled(spark, folder), make_encoder(**ENCODER), models.default_classifiers())


def evaluated(spark, folder):
    return _evaluated(spark.sparkContext.applicationId, spark, folder, _contents(spark, folder))


@query("cv_compare")
def cv_compare(spark, folder):
    return rounded(evaluated(spark, folder).comparison().drop("sampler"))


@query("cv_compare_sampling")
def cv_compare_sampling(spark, folder):
    dense = make_encoder(**ENCODER, dense=True)
    found = cross_validate(labelled(spark, folder), dense, models.default_classifiers(), make_samplers())
    return rounded(found.comparison())


@query("oof_scores")
def oof_scores(spark, folder):
    return rounded(evaluated(spark, folder).scores.select("model", "id", "y", "score"))


@query("threshold_metrics_cv")
def threshold_metrics_cv(spark, folder):
    chosen = models.default_classifiers()["LogReg"]
    return rounded(threshold_table(labelled(spark, folder), make_encoder(**ENCODER), chosen))


@lru_cache(maxsize=8)
def _gated(app: str, spark, folder: str, data: int) -> str:
    """Folder of the fitted encoder, gate and rankers of these tables; one fit per session and contents."""
    path = fresh_path(spark, "gate-rank-model")
    Pipeline(stages=[make_encoder(**ENCODER), GateRank()]).fit(labelled(spark, folder)).save(path)
    return path


def gated(spark, folder):
    """All labelled records with the ranks and predictions of the saved two-sided ranking."""
    path = _gated(spark.sparkContext.applicationId, spark, folder, _contents(spark, folder))
    return PipelineModel.load(path).transform(labelled(spark, folder))


@query("gate_rank_fit")
def gate_rank_fit(spark, folder):
    return rounded(gated(spark, folder).select("id", "y", "gate", "side", "fused", F.col("prediction").cast("int").alias("prediction")))


@query("gate_rank_checked", VALID + """
    SELECT employee_id AS id, true AS side_fits, true AS fused_fits, true AS rank_fits, true AS prediction_fits FROM valid""")
def gate_rank_checked(spark, folder):
    """Every record's side, score, rank and prediction follow from the scores of the saved parts.

    A rank fits if it lies between the counts of better and of not worse scores of the side.
    """
    rows = materialise(gated(spark, folder).select("id", "gate", "pos_score", "neg_score", "side", "rank", "fused", "prediction"), "gated")
    per_score = rows.groupBy("side", F.col("fused").alias("value")).agg(F.count("*").alias("n"))
    upto = running_totals(per_score, "value", ["n"], ["side"], descending=True)
    own = F.when(F.col("gate") >= GATE_CUT, F.col("pos_score")).otherwise(F.col("neg_score"))
    share = F.when(F.col("side") == 1, TOP_POS).otherwise(TOP_NEG)
    placed = rows.join(upto.withColumnsRenamed({"value": "fused"}), ["side", "fused"], "left")
    return placed.select(
        "id", (F.col("side") == (F.col("gate") >= GATE_CUT).cast("int")).alias("side_fits"),
        (F.col("fused") == own).alias("fused_fits"),
        F.coalesce(F.col("rank").between(F.col("cum_n") - F.col("n") + 1, F.col("cum_n")), F.lit(False)).alias("rank_fits"),
        (F.col("prediction") == (F.col("rank") <= F.floor(share * F.col("all_n"))).cast("double")).alias("prediction_fits"),
    )


@lru_cache(maxsize=8)
def _job(app: str, spark, folder: str, data: int):
    return prepare(valid_employees(spark, folder).drop("c_custkey"), key="employee_id", target=TARGET, drop_list=["niveau_hierarchique_poste"])


def job(spark, folder):
    """The training of these tables' employees."""
    return _job(spark.sparkContext.applicationId, spark, folder, _contents(spark, folder))


def store(spark):
    """The model store: the folder of the session setting, else one below the shared folder."""
    return ModelStore(spark, spark.conf.get(STORE_SETTING, None) or f"{shared_dir(spark)}/models")


def loaded(spark, folder):
    """The stored model of these tables; it is fitted, without validation, only if the store has none."""
    return store(spark).load(NAME, stored(store(spark), job(spark, folder)))


def validated(spark, folder):
    """The stored model with the means over folds on its card."""
    return store(spark).load(NAME, scored(store(spark), job(spark, folder))[0])


@query("train_flow")
def train_flow(spark, folder):
    """Mean and deviation of each metric over folds, as the card of the stored model has them."""
    card = validated(spark, folder).metadata.select("performance_cv.*").first().asDict()
    names = {"pr_auc": "average_precision"}
    rows = [("None", "BoostedTrees_enhanced", names.get(k[:-5], k[:-5]), v, card[f"{k[:-5]}_std"]) for k, v in card.items() if k.endswith("_mean")]
    return rounded(spark.createDataFrame(rows, "sampler string, model string, metric string, mean double, std double"))


@query("model_metadata")
def model_metadata(spark, folder):
    card = loaded(spark, folder).metadata
    return card.select(
        "model_version", "dataset.n_samples", "dataset.n_features_raw", "dataset.n_features_encoded",
        "dataset.class_balance.attrition_rate", "hyperparameters.max_depth",
        F.size("features.numeric").alias("n_numeric"), F.size("features.categorical").alias("n_categorical"),
    )


@query("training_report")
def training_report(spark, folder):
    return report_lines(spark, validated(spark, folder).metadata.first().asDict(recursive=True))


@query("model_info")
def model_info(spark, folder):
    return score.model_info(validated(spark, folder), spark)


@query("score_batch")
def score_batch(spark, folder):
    model = loaded(spark, folder)
    return model.response(model.score(valid_employees(spark, folder)))


@query("score_batch_checked", VALID + """
    SELECT employee_id, true AS in_range, true AS adds_up, true AS level_fits, true AS decision_fits,
           (SELECT COUNT(*) FROM valid) AS total_employees FROM valid""")
def score_batch_checked(spark, folder):
    """Every valid record is scored once, and its percents, level and decision agree with each other."""
    shown = score_batch(spark, folder)
    leave = F.col("probability_leave")
    level = F.when(F.col("attrition_prob") < 0.4, "LOW").when(F.col("attrition_prob") < 0.6, "MEDIUM").otherwise("HIGH")
    return shown.select(
        "employee_id", leave.between(0, 100).alias("in_range"),
        (F.abs(leave + F.col("probability_stay") - 100) < 0.011).alias("adds_up"),
        (F.col("risk_level") == level).alias("level_fits"),
        (F.col("will_leave") == (F.col("attrition_prob") >= 0.5)).alias("decision_fits"), "total_employees",
    )


@query("explain_checked", VALID + "SELECT employee_id, 5 AS n_features, true AS ordered, true AS impacts_fit FROM valid")
def explain_checked(spark, folder):
    """Every valid record has five different features, strongest first, whose impact has the sign of its value."""
    found = loaded(spark, folder).explain(spread_employees(spark, folder))
    sizes = F.transform("top_features", lambda x: F.abs(x["shap_value"]))
    return found.select(
        "employee_id", F.size(F.array_distinct(F.transform("top_features", lambda x: x["feature"]))).alias("n_features"),
        (sizes == F.reverse(F.array_sort(sizes))).alias("ordered"),
        F.forall("top_features", lambda x: x["impact"].isNotNull() & x["shap_value"].isNotNull()).alias("impacts_fit"),
    )


@query("oof_keys", VALID + """
    SELECT employee_id AS id, 5 AS n_models, true AS in_range FROM valid""")
def oof_keys(spark, folder):
    """Every labelled record gets one score from each model of the palette."""
    return oof_keys_all(spark, folder)


@query("oof_keys_all", VALID + """
    SELECT employee_id AS id, 5 AS n_models, true AS in_range FROM valid""")
def oof_keys_all(spark, folder):
    """Every labelled record gets one score from each model of the palette."""
    return _keys(oof_scores(spark, folder))


def _keys(scores):
    return scores.groupBy("id").agg(
        F.count_distinct("model").cast("int").alias("n_models"), F.bool_and(F.col("score").between(0, 1)).alias("in_range")
    )


@query("model_facts", VALID + """
    SELECT COUNT(*) AS n_samples, ROUND(AVG(CASE WHEN a_quitte_l_entreprise = 'Oui' THEN 1.0 ELSE 0.0 END), 6) AS attrition_rate,
           SUM(CASE WHEN a_quitte_l_entreprise = 'Oui' THEN 1 ELSE 0 END)::BIGINT AS n_left FROM valid""")
def model_facts(spark, folder):
    """Rows and class balance on the model's card."""
    card = loaded(spark, folder).metadata
    return rounded(card.select("dataset.n_samples", "dataset.class_balance.attrition_rate", F.col("dataset.class_balance.class_1_left").alias("n_left")))


@query("explain_topk")
def explain_topk(spark, folder):
    found = loaded(spark, folder).explain(spread_employees(spark, folder))
    return found.select("employee_id", F.inline("top_features"))
