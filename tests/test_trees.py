"""Ensembles grown inside tasks against MLlib's."""

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from tenura.operators import explain, models, trees
from tenura.operators.gate_rank import GateRank
from tenura.session import spread


def rows_of(spark, n, seed=3):
    """Numbers, levels of a category and a constant; few distinct rows, so that many splits tie."""
    rng = np.random.default_rng(seed)
    number, level = np.round(rng.normal(size=n), 2), rng.integers(0, 4, n)
    x = np.column_stack([number, rng.integers(0, 6, n), *(level == v for v in range(4)), np.ones(n), rng.normal(size=n)]).astype(float)
    y = ((number > 0.3) ^ (level == 2) | (rng.random(n) < 0.1)).astype(int)
    df = spark.createDataFrame([(i, int(t), [float(v) for v in r]) for i, (t, r) in enumerate(zip(y, x))], "id long, y int, x array<double>")
    return df.select("id", "y", array_to_vector("x").alias("features")).coalesce(1).cache()


def described(model):
    return [tree.toDebugString.split("\n")[1:] for tree in model.trees]


@pytest.mark.parametrize("subset, rate, least", [("all", 0.7, 3), ("0.6", 0.8, 1), ("all", 1.0, 1)])
def test_boosted_trees_are_those_of_mllib(spark, subset, rate, least):
    rows = rows_of(spark, 500)
    estimator = GBTClassifier(labelCol="y", maxIter=12, maxDepth=5, stepSize=0.1, subsamplingRate=rate,
                              featureSubsetStrategy=subset, minInstancesPerNode=least, seed=42)
    grown, fitted = trees.fit_in_tasks(estimator, rows, 500), estimator.fit(rows)
    assert described(grown) == described(fitted)
    assert grown.treeWeights == fitted.treeWeights and grown.numFeatures == fitted.numFeatures
    a, b = (explain.tree_nodes(spark, m) for m in (grown, fitted))
    assert a.sort_values(["tree", "id"]).reset_index(drop=True).equals(b.sort_values(["tree", "id"]).reset_index(drop=True))


def test_boosted_trees_need_few_jobs(spark):
    """What took time was the start of some jobs for each level of each tree."""
    rows = rows_of(spark, 300)
    context = spark.sparkContext
    context.setJobGroup("boosted", "boosted")
    try:
        models.fit_classifier(models.Classifier("b", models.boosted(models.ENHANCED, 30)), rows)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert len(context.statusTracker().getJobIdsForGroup("boosted")) < 40


def test_codes_give_the_sums_of_their_features():
    rng = np.random.default_rng(1)
    level = rng.integers(0, 5, 4000)
    bins = np.stack([rng.integers(0, 20, 4000), *(level == v for v in range(5)), rng.random(4000) < 0.5]).astype(np.uint8)
    held = [list(f) for f, _ in trees._bundles(bins, np.arange(1, 7))]
    assert held == [[1, 2, 3, 4, 5], [6]]
    label = np.where((bins[0] > 9) ^ (level == 1), 1.0, -1.0)
    n_splits = np.array([19, 1, 1, 1, 1, 1, 1])
    found = [trees.Boosting(bins, n_splits, 4, 1, 7, exact).grow(label, np.arange(4000), trees.JavaRandom(1))[0] for exact in (True, False)]
    assert found[0].feature == found[1].feature and found[0].split == found[1].split
    assert np.allclose(found[0].stats, found[1].stats)


def test_forests_in_tasks(spark, monkeypatch):
    """As good as MLlib's, whatever the partitions, with weights of classes and all trees."""
    rows = models.with_weights(rows_of(spark, 1500), {0: 1, 1: 1}, False)
    estimator = RandomForestClassifier(labelCol="y", weightCol=models.WEIGHT, numTrees=30, maxDepth=6, seed=42)
    assert trees.fit_in_tasks(estimator, rows, 1500) is None
    monkeypatch.setattr(trees, "FOREST_ROWS", 100)
    grown, again, fitted = trees.fit_in_tasks(estimator, rows, 1500), trees.fit_in_tasks(estimator, rows, 1500), estimator.fit(rows)
    assert isinstance(grown, RandomForestClassificationModel) and grown.getNumTrees == 30 and described(grown) == described(again)
    right = [m.transform(rows).where(F.col("prediction") == F.col("y")).count() for m in (grown, fitted)]
    assert right[0] > 1300 and abs(right[0] - right[1]) < 60
    assert max(t.depth for t in grown.trees) == 6
    light, heavy = (
        trees.fit_in_tasks(estimator, rows.withColumn(models.WEIGHT, F.when(F.col("y") == 1, w).otherwise(1.0)), 1500)
        .transform(rows).agg(F.sum("prediction")).first()[0] for w in (0.05, 20.0)
    )
    assert light < heavy


def test_what_is_left_to_mllib(spark):
    rows = rows_of(spark, 200)
    assert trees.fit_in_tasks(GBTClassifier(labelCol="y", maxIter=2, minInfoGain=0.1), rows, 200) is None
    assert trees.fit_in_tasks(GBTClassifier(labelCol="y", maxIter=2), rows, 10**9) is None
    marked = rows.withMetadata("features", {"ml_attr": {"attrs": {"nominal": [{"idx": 2, "vals": ["a", "b"]}]}, "num_attrs": 8}})
    assert trees.fit_in_tasks(GBTClassifier(labelCol="y", maxIter=2), marked, 200) is None
    one = rows.withColumn("y", F.lit(0))
    estimator = GBTClassifier(labelCol="y", maxIter=2, seed=1)
    assert described(trees.fit_in_tasks(estimator, one, 200)) == described(estimator.fit(one))


def test_model_in_a_pipeline_is_saved_whole(spark, tmp_path):
    rows = rows_of(spark, 200)
    model = models.fit_classifier(models.Classifier("b", models.boosted(models.BOOSTED, 3)), rows)
    model.write().save(str(tmp_path / "model"))
    back = GBTClassificationModel.load(str(tmp_path / "model"))
    assert described(back) == described(model) and back.getStepSize() == 0.1 and back.getLabelCol() == "y"


def test_sparse_rows_are_scored_alike(spark):
    rows = rows_of(spark, 200)
    model = models.fit_classifier(models.Classifier("b", models.boosted(models.BOOSTED, 3)), rows)
    got = models.score(model, rows, ["id"]).join(model.transform(rows).select("id", vector_to_array("probability")[1].alias("want")), "id")
    assert got.count() == 200 and got.where(F.col("score") != F.col("want")).count() == 0


def test_a_ranker_of_both_sides_is_fitted_once(spark, monkeypatch):
    from tenura.operators import gate_rank

    fits = []
    monkeypatch.setattr(gate_rank, "fit_classifier", lambda part, rows: fits.append(part.name) or part.name)
    model = GateRank()._fit(rows_of(spark, 50))
    assert sorted(fits) == ["gate", "ranker"] and model.models == {"gate": "gate", "pos_score": "ranker", "neg_score": "ranker"}


def test_cases_of_paths_equal_single_rows():
    """Many rows look up what a few rows work out one by one, NaN and infinite numbers too."""
    rng = np.random.default_rng(2)
    feature = np.stack([rng.permutation(6)[:4] for _ in range(50)])
    low, high = np.where(rng.random((50, 4)) < 0.5, -np.inf, -0.5), np.where(rng.random((50, 4)) < 0.5, np.inf, 0.5)
    paths = [explain.PathTable(feature, low, high, rng.uniform(0.1, 0.9, (50, 4)), rng.normal(size=50))]
    x = rng.normal(size=(400, 6))
    x[0, :3] = np.nan, np.inf, np.nan
    blocks = explain.path_blocks(paths, 6)
    apart = np.concatenate([explain.contributions(x[i : i + 8], blocks) for i in range(0, 400, 8)])
    assert np.allclose(explain.contributions(x, blocks), apart, rtol=0, atol=1e-12)


def test_explaining_uses_all_cores(spark):
    rows = rows_of(spark, 60)
    assert rows.rdd.getNumPartitions() == 1
    model = models.fit_classifier(models.Classifier("b", models.boosted(models.BOOSTED, 2)), rows)
    cores = spark.sparkContext.defaultParallelism
    assert explain.shapley_values(rows, model, ["id"]).rdd.getNumPartitions() == cores
    assert spread(rows).rdd.getNumPartitions() == cores and sorted(spread(rows).collect()) == sorted(rows.collect())
