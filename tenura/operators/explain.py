"""Contributions of features to the score of a boosted-tree model.

Path-dependent Shapley values of tree ensembles (Lundberg et al., 2018).  A leaf's value reaches
a row if all conditions on its path hold; a feature outside a coalition lets through the share of
training rows that took the path.  For one path only the m features on it matter.  The Shapley weight
of a coalition of size s is the integral of t^s (1-t)^(m-1-s) over t from 0 to 1, so the weighted sum over
all coalitions is the integral of a product with one factor for each other feature: (1-t) times its share,
plus t if its condition holds.  That is a polynomial of degree m - 1, which Gauss-Legendre sums over
about m / 2 points integrate without error; a path costs m^2 / 2 steps, at any depth of the tree.
The values add up: contributions plus base give the log-odds of leaving.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura.session import fresh_path, spread

TOP = 5
_PATHS_AT_ONCE = 400
_ROWS_AT_ONCE = 512
#: Most cases of a path that are worked out beforehand.
_CASES = 256
# The model's probability is the logistic function of twice the summed tree outputs.
_LOG_ODDS = 2.0


@dataclass(frozen=True)
class PathTable:
    """Paths with the same number of features: feature, interval and share per condition, leaf value."""

    feature: np.ndarray
    low: np.ndarray
    high: np.ndarray
    share: np.ndarray
    value: np.ndarray


def tree_nodes(spark: SparkSession, model: GBTClassificationModel) -> pd.DataFrame:
    """Nodes of all trees, from the saved form of the model; as large as the model itself. Raises for splits
    by category, whose first category would read as a threshold."""
    path = fresh_path(spark, "trees")
    model.write().save(path)
    saved = spark.read.parquet(f"{path}/data")
    if not saved.where("nodeData.leftChild >= 0 and nodeData.split.numCategories >= 0").isEmpty():
        raise ValueError("splits by category are not supported; encode categories before the trees")
    return (
        saved
        .select(
            F.col("treeID").alias("tree"),
            F.col("nodeData.id").alias("id"),
            F.col("nodeData.prediction").alias("prediction"),
            F.col("nodeData.rawCount").cast("double").alias("cover"),
            F.col("nodeData.leftChild").alias("left"),
            F.col("nodeData.rightChild").alias("right"),
            F.col("nodeData.split.featureIndex").alias("feature"),
            F.get("nodeData.split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"),
        )
        .toPandas()
    )


def leaf_paths(nodes: pd.DataFrame, weights: Sequence[float]) -> tuple[list[PathTable], float]:
    """Paths grouped by length, and the expected output of the ensemble.

    Several conditions on one feature become one interval.
    """
    by_length: dict[int, list] = {}
    base = 0.0
    for tree, part in nodes.groupby("tree"):
        node = {r.id: r for r in part.itertuples()}
        stack = [(0, {})]
        while stack:
            at, conditions = stack.pop()
            here = node[at]
            if here.left < 0:
                leaf = here.prediction * weights[tree]
                base += leaf * float(np.prod([share for _, _, share in conditions.values()]))
                by_length.setdefault(len(conditions), []).append((conditions, leaf))
                continue
            low, high, share = conditions.get(here.feature, (-np.inf, np.inf, 1.0))
            for child, interval in (
                (here.left, (low, min(high, here.threshold))),
                (here.right, (max(low, here.threshold), high)),
            ):
                passed = share * node[child].cover / here.cover
                stack.append((child, {**conditions, here.feature: (*interval, passed)}))
    tables = []
    for length, paths in sorted(by_length.items()):
        if length == 0:
            continue
        column = lambda i: np.array([[c[i] for c in p.values()] for p, _ in paths], dtype=float)
        tables.append(
            PathTable(
                np.array([list(p) for p, _ in paths], dtype=int), column(0), column(1), column(2),
                np.array([leaf for _, leaf in paths]),
            )
        )
    return tables, base


@dataclass(frozen=True)
class PathBlock:
    """Paths of one length, ready to be applied: factors of absent conditions ``[f, path, point]`` and the map of
    conditions to features."""

    paths: PathTable
    absent: np.ndarray
    points: np.ndarray
    weights: np.ndarray
    spread: np.ndarray


def path_blocks(tables: list[PathTable], n_features: int) -> list[PathBlock]:
    """What a task needs for all its batches; made once."""
    out = []
    for table in tables:
        m = table.feature.shape[1]
        x, w = np.polynomial.legendre.leggauss((m + 1) // 2)
        points, weights = (x + 1) / 2, w / 2
        for at in range(0, len(table.value), _PATHS_AT_ONCE):
            some = slice(at, at + _PATHS_AT_ONCE)
            part = PathTable(*(a[some] for a in (table.feature, table.low, table.high, table.share, table.value)))
            spread = np.zeros((m, len(part.value), n_features))
            for f in range(m):
                spread[f, np.arange(len(part.value)), part.feature[:, f]] = 1.0
            out.append(PathBlock(part, part.share.T[:, :, None] * (1 - points), points, weights, spread))
    return out


def _parts(block: PathBlock, holds: list[np.ndarray]) -> list[np.ndarray]:
    """What each condition of a path adds for rows whose conditions hold or not; one array for each condition.

    All factors are positive, because each child of a split holds training rows, so the factor of a feature can
    be divided out of the whole product without loss.
    """
    paths, m = block.paths, block.paths.feature.shape[1]
    sums = [np.zeros(holds[0].shape) for _ in range(m)]
    for q, (point, weight) in enumerate(zip(block.points, block.weights)):
        factors = [np.where(h, a[:, q] + point, a[:, q]) for h, a in zip(holds, block.absent)]
        whole = weight * paths.value * np.multiply.reduce(factors)
        for f in range(m):
            sums[f] += whole / factors[f]
    return [sums[f] * (holds[f] - paths.share[:, f]) for f in range(m)]


def _by_pattern(columns: np.ndarray, block: PathBlock, phi: np.ndarray) -> None:
    """Add a block's contributions for many rows, both with a row for each feature.

    What a path adds depends only on which of its m conditions hold, so the 2^m cases are worked out once and a
    row looks its case up.
    """
    paths, m = block.paths, block.paths.feature.shape[1]
    cases = np.arange(2**m)
    holds = [np.repeat((cases >> f & 1).astype(bool)[:, None], len(paths.value), axis=1) for f in range(m)]
    tables = [np.ascontiguousarray(part.T) for part in _parts(block, holds)]
    for p in range(len(paths.value)):
        case = np.zeros(columns.shape[1], dtype=np.intp)
        for f in range(m):
            x, low, high = columns[paths.feature[p, f]], paths.low[p, f], paths.high[p, f]
            held = x <= high if low == -np.inf else x > low if high == np.inf else (x > low) & (x <= high)
            case |= held.astype(np.intp) << f
        for f in range(m):
            phi[paths.feature[p, f]] += tables[f][p].take(case)


def contributions(rows: np.ndarray, blocks: list[PathBlock]) -> np.ndarray:
    """Contribution of every feature for every row."""
    phi = np.zeros(rows.shape)
    columns = np.ascontiguousarray(rows.T)
    by_feature = np.zeros(columns.shape)
    for block in blocks:
        paths, m = block.paths, block.paths.feature.shape[1]
        if 2**m <= min(len(rows), _CASES):
            _by_pattern(columns, block, by_feature)
            continue
        for start in range(0, len(rows), _ROWS_AT_ONCE):
            part = rows[start : start + _ROWS_AT_ONCE]
            holds = []
            for f in range(m):
                x = part[:, paths.feature[:, f]]
                holds.append((x > paths.low[:, f]) & (x <= paths.high[:, f]))
            for f, added in enumerate(_parts(block, holds)):
                phi[start : start + len(part)] += added @ block.spread[f]
    return phi + by_feature.T


def _over_rows(df: DataFrame, model: GBTClassificationModel, keys: Sequence[str], features: str, shape, schema: str):
    """Run ``shape(contributions, base)`` over batches of rows, which are dealt to all cores if they lie in few partitions.

    The paths, no larger than the model, go to the tasks.
    """
    spark = df.sparkSession
    tables, base = leaf_paths(tree_nodes(spark, model), model.treeWeights)
    shared = spark.sparkContext.broadcast([(t.feature, t.low, t.high, t.share, t.value) for t in tables])
    keys = list(keys)

    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tables = [PathTable(*arrays) for arrays in shared.value]
        blocks = None
        for batch in batches:
            if len(batch):
                x = np.stack(batch["_x"].to_numpy())
                blocks = path_blocks(tables, x.shape[1]) if blocks is None else blocks
                phi = _LOG_ODDS * contributions(x, blocks)
                yield batch[keys].assign(**shape(phi, _LOG_ODDS * base))

    rows = spread(df.select(*keys, vector_to_array(features).alias("_x")))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name in keys)
    return rows.mapInPandas(explain, f"{fields}, {schema}")


def shapley_values(
    df: DataFrame, model: GBTClassificationModel, keys: Sequence[str], features: str = "features"
) -> DataFrame:
    """Keys with ``phi`` (one value per feature, in log-odds) and ``base``."""
    shape = lambda phi, base: {"phi": list(phi), "base": base}
    return _over_rows(df, model, keys, features, shape, "phi array<double>, base double")


def impact(value: Column) -> Column:
    return F.when(value > 0, "increases risk").when(value < 0, "decreases risk").otherwise("neutral")


def top_features(
    df: DataFrame, model: GBTClassificationModel, names: Sequence[str], keys: Sequence[str], n: int = TOP,
    features: str = "features",
) -> DataFrame:
    """Keys with ``top_features``: the n contributions largest in size, ties in feature order."""

    def shape(phi: np.ndarray, base: float) -> dict:
        order = np.argsort(-np.abs(phi), axis=1, kind="stable")[:, :n]
        return {"_at": list(order.astype(np.int32)), "_phi": list(np.take_along_axis(phi, order, axis=1)), "base": base}

    found = _over_rows(df, model, keys, features, shape, "_at array<int>, _phi array<double>, base double")
    named = F.array(*map(F.lit, names))
    entry = lambda at, value: F.struct(
        F.get(named, at).alias("feature"), F.round(value, 4).alias("shap_value"), impact(value).alias("impact")
    )
    return found.select(*keys, F.zip_with("_at", "_phi", entry).alias("top_features"), "base")
