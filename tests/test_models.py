"""Encoders, classifiers, training, scoring and explanations."""

from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from tenura.operators import explain, features, metrics, models, quality, score
from tenura.operators.gate_rank import GateRank
from tenura.operators.prep import TARGET, MissingColumns
from tenura.plans import crossval, model_queries, train
from tenura.session import fresh_path
from tenura.sources.model_store import ModelStore

ENCODER = model_queries.ENCODER


@pytest.fixture(scope="module")
def people(spark, folder):
    return model_queries.labelled(spark, folder).cache()


@pytest.fixture(scope="module")
def run(spark, folder):
    people = model_queries.valid_employees(spark, folder).drop("c_custkey")
    return train.train(people, fresh_path(spark, "test-model"), key="employee_id", target=TARGET,
                       drop_list=["absent"], trees=4, k=3)


def test_unknown_levels(spark):
    known = spark.createDataFrame([("a",), ("b",), ("c",), ("a",), (None,)], "c string")
    new = spark.createDataFrame([("zzz",), ("b",), (None,)], "c string")
    model = features.make_encoder(["c", "absent"], []).fit(known)
    assert model.feature_names() == ["cats__c_a", "cats__c_b", "cats__c_c"]
    rows = [list(r[0]) for r in model.transform(new).select(vector_to_array("features")).collect()]
    assert rows == [[0, 0, 0], [0, 1, 0], [1, 0, 0]]
    crowded = features.make_encoder(["c"], [], maxCategories=2).fit(known)
    assert crowded.feature_names() == ["cats__c_a", "cats__c_infrequent"]
    rows = [list(r[0]) for r in crowded.transform(new).select(vector_to_array("features")).collect()]
    assert rows == [[0, 1], [0, 1], [1, 0]]


def test_encoder_is_saved_whole(spark, people):
    model = features.make_encoder(**ENCODER).fit(people)
    path = fresh_path(spark, "encoder")
    PipelineModel([model]).save(path)
    back = PipelineModel.load(path)
    a, b = (m.transform(people).select("id", vector_to_array("features").alias("x")) for m in (model, back))
    assert a.exceptAll(b).count() == 0
    attrs = model.transform(people).schema["features"].metadata["ml_attr"]
    assert attrs["num_attrs"] == len(model.feature_names()) == len(model.categorical_mask())


def test_models_beat_guessing(people):
    chosen = models.default_classifiers(trees=8)
    found = crossval.cross_validate(people, features.make_encoder(**ENCODER), chosen, k=3)
    scores = {r["model"]: r for r in found.comparison().collect()}
    assert set(scores) == set(chosen)
    guess = scores["Dummy(stratified)"]["average_precision"]
    for name in set(chosen) - {"Dummy(stratified)"}:
        assert scores[name]["average_precision"] > guess + 0.05
    assert found.scores.count() == people.count() * len(chosen)
    assert found.scores.where(~F.col("score").between(0, 1)).count() == 0
    one = found.scores.where(F.col("model") == "LogReg")
    assert one.select("id").distinct().count() == people.count()


def test_gate_rank_in_a_pipeline(spark, people):
    """Fitted, saved and read as a stage; ranks and predictions follow from its own scores."""
    steps = [features.make_encoder(**ENCODER), GateRank(trees=3, topPos=0.5, cut=0.4)]
    model = Pipeline(stages=steps).fit(people)
    path = fresh_path(spark, "gate")
    model.save(path)
    # Clashing columns are replaced, others stay.
    odd = people.withColumn("gate", F.lit("x")).withColumn("prediction", F.lit(7.0)).withColumn("rank", F.lit(0))
    wanted = ["id", "y", "gate", "pos_score", "neg_score", "side", "rank", "fused", "prediction"]
    a = model.transform(people).select(*wanted)
    b = PipelineModel.load(path).transform(odd).select(*wanted)
    assert a.exceptAll(b).count() == 0 and b.count() == people.count()
    rows = a.toPandas()
    assert (rows["side"] == (rows["gate"] >= 0.4)).all()
    own = np.where(rows["side"] == 1, rows["pos_score"], rows["neg_score"])
    assert np.allclose(rows["fused"], own)
    for side, share in ((1, 0.5), (0, 0.10)):
        mine = rows[rows["side"] == side].sort_values("rank")
        assert list(mine["rank"]) == list(range(1, len(mine) + 1))
        assert mine["fused"].is_monotonic_decreasing
        assert list(mine["prediction"]) == [1.0] * int(share * len(mine)) + [0.0] * (len(mine) - int(share * len(mine)))


def test_gate_rank_of_no_rows(spark, people):
    model = Pipeline(stages=[features.make_encoder(**ENCODER), GateRank(trees=2)]).fit(people)
    done = model.transform(people.limit(0))
    assert done.count() == 0 and {"fused", "prediction", "rank"} <= set(done.columns)


def test_gate_rank_among_classifiers(people):
    """It is validated like any classifier, by its fused score."""
    chosen = {"GateRank": models.Classifier("GateRank", lambda _: GateRank(trees=4))}
    found = crossval.cross_validate(people, features.make_encoder(**ENCODER), chosen, k=2)
    assert found.scores.count() == people.count()
    assert found.scores.where(~F.col("score").between(0, 1)).count() == 0
    assert found.comparison().first()["average_precision"] > people.agg(F.avg("y")).first()[0]


def test_training_writes_everything(spark, run):
    card = run.metadata
    assert set(card) == {
        "model_version", "training_date", "dataset", "features", "hyperparameters", "hyperparameters_not_applied", "performance_cv",
    }
    assert card["features"]["total_input"] == 24
    balance = card["dataset"]["class_balance"]
    assert balance["class_0_stayed"] + balance["class_1_left"] == card["dataset"]["n_samples"]
    model = score.AttritionModel.load(spark, run.folder)
    assert model.encoder.feature_names() == run.pipeline.stages[0].feature_names()
    info = score.model_info(model, spark).first()
    assert info["accuracy"] == pytest.approx(card["performance_cv"]["accuracy_mean"], abs=5.1e-4)
    assert len(info["categorical"]) == 6 and len(info["numeric"]) == 18
    report = [r[0] for r in spark.read.text(f"{run.folder}/{score.REPORT}").collect()]
    assert any(line == f"ROWS / used: {card['dataset']['n_samples']}" for line in report)


def test_missing_model(spark):
    assert score.AttritionModel.load(spark, "/absent/model") is None
    assert score.model_info(None, spark).count() == 0


def test_scores_keep_keys_and_ranges(spark, folder, run):
    people = model_queries.valid_employees(spark, folder)
    model = score.AttritionModel.load(spark, run.folder)
    scored = model.score(people)
    assert scored.select("employee_id").exceptAll(people.select("employee_id")).count() == 0
    assert quality.broken_rule_counts(scored, quality.output_rules()).agg(F.sum("n")).first()[0] == 0
    assert scored.where(F.abs(F.col("probability_leave") + F.col("probability_stay") - 100) > 0.011).count() == 0
    assert scored.where(F.col("will_leave") != (F.col("attrition_prob") >= 0.5)).count() == 0
    with pytest.raises(MissingColumns, match="genre"):
        model.score(people.drop("genre"))
    one = model.score(people.orderBy("employee_id").limit(1)).first()
    assert one == scored.where(F.col("employee_id") == one["employee_id"]).first()


def test_explanations_add_up(spark, folder, run):
    people = model_queries.valid_employees(spark, folder)
    model = score.AttritionModel.load(spark, run.folder)
    phi = explain.shapley_values(model.encoder.transform(people), model.pipeline.stages[-1], ["employee_id"])
    summed = phi.select("employee_id", (F.aggregate("phi", F.lit(0.0), lambda a, v: a + v) + F.col("base")).alias("odds"))
    joined = summed.join(model.probabilities(people, ["employee_id"]), "employee_id")
    p = F.col("attrition_prob")
    assert joined.where(F.abs(F.col("odds") - F.log(p / (1 - p))) > 1e-9).count() == 0
    top = model.explain(people)
    assert top.where(F.size("top_features") != 5).count() == 0
    entries = top.select(F.inline("top_features"))
    assert {r[0] for r in entries.select("impact").distinct().collect()} <= {"increases risk", "decreases risk", "neutral"}
    assert entries.where((F.col("impact") == "increases risk") != (F.col("shap_value") > 0)).where(
        F.col("shap_value") != 0).count() == 0


def _expected(node, at, row, known):
    """Value of a tree if only some features are known."""
    here = node[at]
    if here.left < 0:
        return here.prediction
    if int(here.feature) in known:
        return _expected(node, here.left if row[int(here.feature)] <= here.threshold else here.right, row, known)
    return sum(node[c].cover / here.cover * _expected(node, c, row, known) for c in (here.left, here.right))


def test_contributions_against_all_coalitions(spark):
    rng = np.random.default_rng(11)
    x = np.round(rng.normal(size=(300, 4)), 1)
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5) | (x[:, 2] > 1)).astype(int)
    df = spark.createDataFrame([(int(t), [float(v) for v in r]) for t, r in zip(y, x)], "y int, x array<double>")
    df = df.select("y", array_to_vector("x").alias("features"))
    model = GBTClassifier(labelCol="y", maxIter=3, maxDepth=4, seed=1).fit(df)
    nodes = explain.tree_nodes(spark, model)
    tables, _ = explain.leaf_paths(nodes, model.treeWeights)
    got = explain.contributions(x[:20], explain.path_blocks(tables, 4))
    trees = [{r.id: r for r in part.itertuples()} for _, part in nodes.groupby("tree")]
    for i in range(20):
        value = lambda s: sum(w * _expected(t, 0, x[i], s) for w, t in zip(model.treeWeights, trees))  # noqa: B023, E731
        for f in range(4):
            others = [g for g in range(4) if g != f]
            want = sum(
                factorial(len(s)) * factorial(3 - len(s)) / factorial(4) * (value({*s, f}) - value(set(s)))
                for n in range(4) for s in combinations(others, n)
            )
            assert got[i, f] == pytest.approx(want, abs=1e-10)


def test_deep_trees_are_explained(spark):
    """Paths of up to twelve features: the values add up to the output and equal the sums over all coalitions."""
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(3000, 14)), 2)
    y = (np.prod(np.sign(x[:, :3]), axis=1) + x[:, 3:12].sum(axis=1) / 3 + rng.normal(size=3000) > 0).astype(int)
    df = spark.createDataFrame([(int(t), [float(v) for v in r]) for t, r in zip(y, x)], "y int, x array<double>")
    df = df.select("y", array_to_vector("x").alias("features"))
    model = GBTClassifier(labelCol="y", maxIter=2, maxDepth=12, seed=1).fit(df)
    nodes = explain.tree_nodes(spark, model)
    tables, base = explain.leaf_paths(nodes, model.treeWeights)
    assert max(t.feature.shape[1] for t in tables) >= 9
    got = explain.contributions(x[:200], explain.path_blocks(tables, 14))
    trees = [{r.id: r for r in part.itertuples()} for _, part in nodes.groupby("tree")]
    for i in range(200):
        output = sum(w * _expected(t, 0, x[i], set(range(14))) for w, t in zip(model.treeWeights, trees))
        assert got[i].sum() + base == pytest.approx(output, abs=1e-10)
    longest = max(tables, key=lambda t: t.feature.shape[1])
    m = longest.feature.shape[1]
    one = explain.PathTable(*(a[:1] for a in (longest.feature, longest.low, longest.high, longest.share, longest.value)))
    holds = (x[7, one.feature[0]] > one.low[0]) & (x[7, one.feature[0]] <= one.high[0])
    want = np.zeros(14)
    for f in range(m):
        others = [g for g in range(m) if g != f]
        for n in range(m):
            for s in combinations(others, n):
                rest = np.prod([float(holds[g]) if g in s else one.share[0, g] for g in others])
                size = factorial(n) * factorial(m - 1 - n) / factorial(m)
                want[one.feature[0, f]] += size * rest * (holds[f] - one.share[0, f]) * one.value[0]
    assert explain.contributions(x[7:8], explain.path_blocks([one], 14))[0] == pytest.approx(want, rel=1e-9, abs=1e-14)


def test_minmax(spark):
    df = spark.createDataFrame([(-2.0,), (0.0,), (6.0,)], "raw double")
    got = [r["scaled"] for r in metrics.minmax_scores(df, "raw").orderBy("raw").collect()]
    assert got == pytest.approx([0, 0.25, 1])


def test_model_queries_are_whole(spark, monkeypatch):
    """The queries validate the whole palette at full size in five folds."""
    calls = []

    class Done:
        def comparison(self):
            return None

    def record(rows, encoder, classifiers, samplers=None, *, k=5, **options):
        calls.append((classifiers, k))
        return Done()

    for name, value in {"cross_validate": record, "labelled": lambda *a: None, "rounded": lambda x: x}.items():
        monkeypatch.setattr(model_queries, name, value)
    model_queries.cv_compare_sampling(None, "f")
    model_queries._evaluated.__wrapped__("app", None, "f", 0)
    for classifiers, k in calls:
        assert list(classifiers) == list(models.default_classifiers()) and k == 5
        built = {n: c.build(10) for n, c in classifiers.items() if n not in ("Dummy(stratified)", "LogReg")}
        assert built["RandomForest"].getNumTrees() == 300
        assert [built[n].getMaxIter() for n in ("BoostedTrees", "BoostedTrees_enhanced")] == [300, 200]
    assert len(calls) == 2


def test_store_publishes_whole_models(spark, folder, monkeypatch):
    people = model_queries.valid_employees(spark, folder).drop("c_custkey")
    options = dict(key="employee_id", target=TARGET, drop_list=["absent"], trees=2)
    store = ModelStore(spark, fresh_path(spark, "store"))
    job = train.prepare(people, **options)
    assert job.fingerprint == train.prepare(people.repartition(3), **options).fingerprint
    assert job.fingerprint != train.prepare(people, **{**options, "trees": 3}).fingerprint
    assert job.fingerprint != train.prepare(people.limit(300), **options).fingerprint
    assert store.versions(train.NAME) == [] and store.load(train.NAME) is None

    marks = []
    monkeypatch.setattr(store, "_mark", marks.append)
    lost = train.stored(store, job)  # a writer that is lost before its marker
    assert len(marks) == 1 and store.versions(train.NAME) == [] and store.load(train.NAME, lost) is None
    monkeypatch.undo()

    version = train.stored(store, job)
    assert version != lost and train.stored(store, job) == version
    monkeypatch.setattr(train, "fit", None)  # whatever is stored is not fitted again
    assert train.stored(store, job) == version
    first = store.load(train.NAME)
    assert "performance_cv" not in first.metadata.columns
    assert train.scored(store, job, k=2)[0] == version
    again, summary = train.scored(store, job, k=2)
    assert again == version and summary is None
    card = store.load(train.NAME, version).metadata.select("performance_cv.roc_auc_mean", "fingerprint").first()
    assert 0 < card["roc_auc_mean"] <= 1 and card["fingerprint"] == job.fingerprint
    a, b = (m.score(people).select("employee_id", "attrition_prob") for m in (first, store.load(train.NAME)))
    assert a.exceptAll(b).count() == 0


def test_raw_scores_are_scaled(spark):
    rows = [("None", "margin", 0, "a", 0, -3.0), ("None", "margin", 0, "b", 1, 1.0), ("None", "margin", 0, "c", 1, 5.0),
            ("None", "probability", 0, "a", 0, 0.25), ("None", "same", 0, "a", 0, 7.0)]
    scores = spark.createDataFrame(rows, "sampler string, model string, fold int, id string, y int, score double")
    got = {(r["model"], r["id"]): r["score"] for r in crossval.scaled_by_model(scores).collect()}
    assert got == {("margin", "a"): 0, ("margin", "b"): 0.5, ("margin", "c"): 1, ("probability", "a"): 0.25, ("same", "a"): 0}
