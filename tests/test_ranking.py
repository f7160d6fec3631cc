"""Ranks, running totals, percentiles and rank correlations on skewed data, against brute force."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tenura.functions.hashing import hash_text
from tenura.operators import correlation, folds, metrics, percentiles, ranking


@pytest.fixture(scope="module")
def skewed(spark):
    """One value holds a third of the rows; one group holds most of them."""
    rng = np.random.default_rng(5)
    n = 3000
    value = np.round(rng.normal(size=n), 2)
    value[: n // 3] = 0.25
    value[n // 3 : n // 3 + 50] = value.min()
    pdf = pd.DataFrame(
        {"id": [f"k{i}" for i in range(n)], "g": np.where(rng.random(n) < 0.9, "a", "b"), "value": value,
         "y": (rng.random(n) < 0.3).astype(int)}
    ).sample(frac=1, random_state=1)
    return pdf, spark.createDataFrame(pdf).repartition(7).cache()


@pytest.mark.parametrize("many", [False, True])
@pytest.mark.parametrize("descending", [False, True])
def test_rank_by_value_is_exact(skewed, monkeypatch, descending, many):
    if many:
        monkeypatch.setattr(ranking, "ROWS_PER_BUCKET", 20)
    pdf, df = skewed
    got = ranking.rank_by_value(df, "value", "id", ["g"], descending).toPandas().set_index("id")["rank"]
    hashed = df.select("id", hash_text(F.col("id"), ranking.TIE_SEED).alias("h")).toPandas()
    want = pdf.merge(hashed, on="id")
    want["signed"] = -want["value"] if descending else want["value"]
    want = want.sort_values(["signed", "h", "id"])
    want["rank"] = want.groupby("g").cumcount() + 1
    assert got.to_dict() == want.set_index("id")["rank"].to_dict()


def test_hot_value_is_spread_over_buckets(skewed, monkeypatch):
    monkeypatch.setattr(ranking, "ROWS_PER_BUCKET", 20)
    _, df = skewed
    starts, heavy = ranking.value_cuts(df, "value", 3000)
    assert 0.25 in heavy
    sizes = (
        df.where(~F.col("value").isin(sorted(heavy)))
        .groupBy(ranking.bucket_of(F.col("value"), starts))
        .count()
        .agg(F.max("count"))
        .first()[0]
    )
    assert sizes < 100


@pytest.mark.parametrize("n_starts", [0, 1, 5, 64, 65, 300])
def test_bucket_of_matches_searchsorted(spark, n_starts):
    starts = sorted({round(float(v), 3) for v in np.random.default_rng(n_starts).normal(size=n_starts)})
    values = [-9.0, 9.0, 0.0, *starts, *[s + 1e-9 for s in starts]]
    got = spark.createDataFrame([(float(v),) for v in values], "v double").select(
        "v", ranking.bucket_of(F.col("v"), starts).alias("b")
    )
    for row in got.collect():
        assert row["b"] == np.searchsorted(starts, row["v"], side="right")


def test_running_totals(skewed):
    pdf, df = skewed
    counts = df.groupBy("g", "value").agg(F.count("*").alias("c"))
    got = ranking.running_totals(counts, "value", ["c"], ["g"], descending=True).toPandas()
    want = pdf.groupby(["g", "value"]).size().reset_index(name="c").sort_values("value", ascending=False)
    want["cum"] = want.groupby("g")["c"].cumsum()
    merged = got.merge(want, on=["g", "value"])
    assert len(merged) == len(want)
    assert (merged["cum_c"] == merged["cum"]).all()
    assert (merged["all_c"] == merged.groupby("g")["c_x"].transform("sum")).all()


def test_percentiles(skewed):
    pdf, df = skewed
    got = percentiles.grouped_percentiles(df, ["g"], "value", {"p5": 0.05, "p50": 0.5, "p95": 0.95}).toPandas()
    for row in got.itertuples():
        part = pdf.loc[pdf.g == row.g, "value"]
        assert [row.p5, row.p50, row.p95] == pytest.approx(list(part.quantile([0.05, 0.5, 0.95])))


def test_null_groups_and_values_stay(spark):
    rows = [("a", i, float(i % 3)) for i in range(9)] + [(None, 9 + i, None) for i in range(5)]
    df = spark.createDataFrame(rows, "g string, id long, v double")
    for descending in (True, False):
        got = ranking.rank_by_value(df, "v", "id", descending=descending).toPandas().sort_values("rank")
        assert list(got["rank"]) == list(range(1, 15))
        values = [None if pd.isna(v) else v for v in got["v"]]
        assert values == ([2.0] * 3 + [1.0] * 3 + [0.0] * 3 + [None] * 5 if descending
                          else [None] * 5 + [0.0] * 3 + [1.0] * 3 + [2.0] * 3)
    assert ranking.rank_by_hash(df, "id", 1, ["g"]).count() == 14
    medians = percentiles.grouped_percentiles(df.fillna(7.0), ["g"], "v", {"m": 0.5}).collect()
    assert {r["g"]: r["m"] for r in medians} == {"a": 1.0, None: 7.0}


def test_median_of_one_row_and_of_none(spark):
    df = spark.createDataFrame([(1.5, None), (None, None)], "a double, b double")
    assert [tuple(r) for r in percentiles.column_medians(df, ["a", "b"]).collect()] == [("a", 1.5)]


def test_hash_rank_is_a_permutation_and_folds_are_even(skewed):
    _, df = skewed
    ranks = ranking.rank_by_hash(df, "id", 42).select("rank").toPandas()["rank"]
    assert sorted(ranks) == list(range(1, 3001))
    sizes = folds.stratified_folds(df, "id").groupBy("y", "fold").count().toPandas()
    assert sizes.groupby("y")["count"].agg(lambda c: c.max() - c.min()).max() <= 1


def _pairs(seed):
    rng = np.random.default_rng(seed)
    n = 400
    x = np.round(rng.normal(size=n), 1)
    y = np.round(x + rng.normal(size=n), 1)
    x[: n // 3], y[10:150] = 0.5, -0.5
    pdf = pd.DataFrame({"x": x, "y": y})
    pdf.loc[rng.random(n) < 0.1, "x"] = np.nan
    pdf.loc[rng.random(n) < 0.1, "y"] = np.nan
    return pdf


def _tau(pdf):
    known = pdf.dropna()
    x, y = known["x"].to_numpy(), known["y"].to_numpy()
    sx, sy = np.sign(x[:, None] - x), np.sign(y[:, None] - y)
    return (sx * sy).sum() / np.sqrt((sx**2).sum() * (sy**2).sum())


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("rows_per_bucket", [1_000_000, 10])
def test_kendall_and_spearman(spark, monkeypatch, seed, rows_per_bucket):
    monkeypatch.setattr(ranking, "ROWS_PER_BUCKET", rows_per_bucket)
    pdf = _pairs(seed)
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "x double, y double")
    assert correlation.kendall_pairs(df, ["x", "y"]).first()["corr"] == pytest.approx(_tau(pdf), abs=1e-12)
    ranks = pdf.dropna().rank()
    rho = correlation.spearman_pairs(df, ["x", "y"]).first()["corr"]
    assert rho == pytest.approx(ranks.corr().iloc[0, 1], abs=1e-12)


@pytest.mark.parametrize("method", ["spearman", "kendall"])
def test_all_rank_correlations_at_once(spark, monkeypatch, method):
    """Four columns of different scale, hot values and nulls; one is constant, one never known with another."""
    monkeypatch.setattr(ranking, "ROWS_PER_BUCKET", 40)
    monkeypatch.setattr(ranking, "MAX_BUCKETS", 64)
    pdf = _pairs(3)
    pdf["z"] = np.where(np.arange(400) % 3 == 0, 1000.0 * pdf["x"] - pdf["y"], 7.0)
    pdf["same"] = 1.0
    pdf["apart"] = np.where(pdf["x"].isna(), np.arange(400.0), np.nan)
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), ", ".join(f"{c} double" for c in pdf))
    got = {(r[0], r[1]): r[2] for r in correlation.correlation_pairs(df, list(pdf), method).collect()}
    assert len(got) == 10
    for (a, b), value in got.items():
        known = pdf[[a, b]].dropna()
        if len(known) < 2 or known.nunique().min() < 2:
            assert value is None
        else:
            known.columns = ["x", "y"]
            want = _tau(known) if method == "kendall" else known.rank().corr().iloc[0, 1]
            assert value == pytest.approx(abs(want), abs=1e-12)


def _jobs(spark, group, run):
    spark.sparkContext.setJobGroup(group, group)
    run()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_jobs_do_not_grow_with_pairs(spark):
    df = spark.range(200).selectExpr(*[f"double((id * {p}) % 23) AS c{p}" for p in (3, 5, 7, 11, 13)])
    jobs = lambda n: _jobs(
        spark, f"pairs-{n}", lambda: correlation.correlation_pairs(df, df.columns[:n], "spearman").collect())
    assert jobs(5) <= jobs(2) + 2


def test_constant_column_has_no_correlation(spark):
    df = spark.createDataFrame([(1.0, float(i), 2.0 * i) for i in range(9)], "c double, x double, z double")
    got = {(r[0], r[1]): r[2] for r in correlation.correlation_pairs(df, ["c", "x", "z"]).collect()}
    assert got[("c", "x")] is None and got[("x", "z")] == pytest.approx(1.0)
    assert correlation.suggest_correlated(df, threshold=0.9)[0] == ["x"]
    assert correlation.suggest_correlated(df, threshold=0.9, protect=["x"])[0] == ["z"]
    assert correlation.suggest_correlated(df, threshold=0.9, protect=["x", "z"])[0] == []
    assert correlation.suggest_correlated(df, ["x"]) == ([], [])


def test_metrics_on_tiny_cases(spark):
    rows = [(1, 0.9), (0, 0.8), (1, 0.8), (0, 0.3), (1, 0.1)]
    df = spark.createDataFrame(rows, "y int, score double")
    got = metrics.ranking_metrics(df).first()
    assert got["roc_auc"] == pytest.approx((2 + 1.5 + 0) / 6)
    assert got["average_precision"] == pytest.approx(1 / 3 * 1 + 1 / 3 * (2 / 3) + 1 / 3 * (3 / 5))
    empty = metrics.threshold_metrics(df, thresholds=[0.95]).first()
    assert (empty["precision"], empty["recall"], empty["f1"]) == (0.0, 0.0, 0.0)
