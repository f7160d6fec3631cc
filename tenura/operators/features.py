"""Imputation and encoding of employee records, as ML estimators that can be saved."""

from __future__ import annotations

import json
from collections.abc import Sequence
from itertools import chain

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenura.functions.text import tokens
from tenura.operators.percentiles import column_medians
from tenura.operators.profile import cell_counts

MAX_CATEGORIES = 30
MAX_TOKENS = 30
INFREQUENT = "infrequent"


# ---------------------------------------------------------------- fitting

def top_values(df: DataFrame, columns: Sequence[str], n: int) -> dict[str, tuple[list[str], int]]:
    """The ``n`` most frequent known values of each column (ties: smallest) and the number of values.

    The window keeps only ``n`` rows per column already before the shuffle, so that a column with
    very many values is not gathered in one task.
    """
    if not columns:
        return {}
    counts = cell_counts(df, list(columns)).where(F.col("value").isNotNull())
    order = Window.partitionBy("column").orderBy(F.desc("cnt"), "value")
    best = counts.withColumn("pos", F.row_number().over(order)).where(F.col("pos") <= n)
    sizes = counts.groupBy("column").agg(F.count("*").alias("n"))
    both = best.select("column", "pos", "value", F.lit(None).cast("long").alias("n")).unionByName(
        sizes.select("column", F.lit(0).alias("pos"), F.lit(None).cast("string").alias("value"), "n")
    )
    found: dict[str, list] = {c: [] for c in columns}
    number = dict.fromkeys(columns, 0)
    for row in sorted(both.collect(), key=lambda r: r["pos"]):
        if row["pos"]:
            found[row["column"]].append(row["value"])
        else:
            number[row["column"]] = row["n"]
    return {c: (found[c], number[c]) for c in columns}


def fit_modes(df: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """Most frequent known value of each column, the smallest if tied."""
    return {c: best[0] for c, (best, _) in top_values(df, columns, 1).items() if best}


def fit_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Exact median of each column."""
    if not columns:
        return {}
    return {r["column"]: r["median"] for r in column_medians(df, columns).collect()}


def fit_levels(
    df: DataFrame, columns: Sequence[str], max_categories: int = MAX_CATEGORIES, drop_binary: bool = True
) -> list[dict]:
    """Fill value, shown levels and whether the rest shares an ``infrequent`` level."""
    plans = []
    for column, (best, size) in top_values(df, columns, max_categories).items():
        if not best:
            continue
        crowded = size > max_categories
        levels = sorted(best[: max_categories - 1] if crowded else best)
        if drop_binary and size == 2:
            levels = levels[1:]
        plans.append({"column": column, "mode": best[0], "levels": levels, "infrequent": crowded})
    return plans


def fit_tokens(df: DataFrame, column: str, max_tokens: int = MAX_TOKENS) -> list[str]:
    """Tokens found in most rows, in alphabetical order."""
    per_row = df.select(F.explode(F.array_distinct(tokens(F.coalesce(F.col(column), F.lit(""))))).alias("token"))
    best = per_row.groupBy("token").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "token").limit(max_tokens)
    return sorted(r["token"] for r in best.collect())


# ---------------------------------------------------------------- columns

def impute_mode(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    modes = fit_modes(df, columns)
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(m).cast(df.schema[c].dataType)) for c, m in modes.items()})


def impute_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    medians = fit_medians(df, columns)
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(m)) for c, m in medians.items()})


def one_hot_columns(plans: Sequence[dict]) -> list[tuple[str, Column]]:
    """Named 0/1 columns; an unknown value falls to ``infrequent`` if there is one, else all are 0."""
    out = []
    for plan in plans:
        name = plan["column"]
        value = F.coalesce(F.col(name).cast("string"), F.lit(plan["mode"]))
        out += [(f"cats__{name}_{lv}", (value == lv).cast("double")) for lv in plan["levels"]]
        if plan["infrequent"]:
            out.append((f"cats__{name}_{INFREQUENT}", (~value.isin(plan["levels"])).cast("double")))
    return out


def multi_hot_columns(column: str, vocabulary: Sequence[str]) -> list[tuple[str, Column]]:
    found = tokens(F.coalesce(F.col(column), F.lit("")))
    return [(f"multiuse__{t}", F.array_contains(found, t).cast("double")) for t in vocabulary]


def numeric_columns(medians: dict[str, float]) -> list[tuple[str, Column]]:
    return [(f"num__{c}", F.coalesce(F.col(c).cast("double"), F.lit(float(m)))) for c, m in medians.items()]


# ---------------------------------------------------------------- estimator

class _EncoderParams(Params):
    catCols = Param(Params._dummy(), "catCols", "single-valued text columns", TypeConverters.toListString)
    numCols = Param(Params._dummy(), "numCols", "numeric columns", TypeConverters.toListString)
    multiCol = Param(Params._dummy(), "multiCol", "comma list column, may be empty", TypeConverters.toString)
    maxCategories = Param(Params._dummy(), "maxCategories", "levels per column", TypeConverters.toInt)
    multiMaxFeatures = Param(Params._dummy(), "multiMaxFeatures", "tokens kept", TypeConverters.toInt)
    dropBinary = Param(Params._dummy(), "dropBinary", "one column for two levels", TypeConverters.toBoolean)
    dense = Param(Params._dummy(), "dense", "dense instead of sparse vectors", TypeConverters.toBoolean)
    outputCol = Param(Params._dummy(), "outputCol", "vector column", TypeConverters.toString)
    state = Param(Params._dummy(), "state", "fitted values as JSON", TypeConverters.toString)

    def _defaults(self):
        self._setDefault(
            catCols=[], numCols=[], multiCol="", maxCategories=MAX_CATEGORIES, multiMaxFeatures=MAX_TOKENS,
            dropBinary=True, dense=False, outputCol="features", state="{}",
        )


class FeatureEncoder(Estimator, _EncoderParams, DefaultParamsReadable, DefaultParamsWritable):
    """Impute and encode: single-valued text, then the comma list, then numbers.

    Other columns are left out of the vector, and columns that are absent are ignored.
    """

    @keyword_only
    def __init__(self, *, catCols=None, numCols=None, multiCol=None, maxCategories=None, multiMaxFeatures=None,
                 dropBinary=None, dense=None, outputCol=None):
        super().__init__()
        self._defaults()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> "FeatureEncoderModel":
        get = self.getOrDefault
        present = set(dataset.columns)
        cats = [c for c in get(self.catCols) if c in present]
        nums = [c for c in get(self.numCols) if c in present]
        multi = get(self.multiCol) if get(self.multiCol) in present else ""
        medians = fit_medians(dataset, nums)
        state = {
            "cats": fit_levels(dataset, cats, get(self.maxCategories), get(self.dropBinary)),
            "multi": multi,
            "tokens": fit_tokens(dataset, multi, get(self.multiMaxFeatures)) if multi else [],
            "medians": {c: medians[c] for c in nums if c in medians},
        }
        model = FeatureEncoderModel()
        self._copyValues(model)
        return model._set(state=json.dumps(state))


class FeatureEncoderModel(Model, _EncoderParams, DefaultParamsReadable, DefaultParamsWritable):
    def __init__(self):
        super().__init__()
        self._defaults()

    @property
    def fitted(self) -> dict:
        return json.loads(self.getOrDefault(self.state))

    def output_columns(self) -> list[tuple[str, Column]]:
        state = self.fitted
        multi = multi_hot_columns(state["multi"], state["tokens"]) if state["multi"] else []
        return list(chain(one_hot_columns(state["cats"]), multi, numeric_columns(state["medians"])))

    def feature_names(self) -> list[str]:
        return [n for n, _ in self.output_columns()]

    def categorical_mask(self) -> list[bool]:
        """True for encoded text columns, in the order of the vector."""
        return [not n.startswith("num__") for n in self.feature_names()]

    def input_columns(self) -> list[str]:
        state = self.fitted
        return [p["column"] for p in state["cats"]] + [c for c in [state["multi"]] if c] + list(state["medians"])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        columns = self.output_columns()
        out = self.getOrDefault(self.outputCol)
        if self.getOrDefault(self.dense):
            vector = dataset.withColumn(out, array_to_vector(F.array(*[c for _, c in columns])))
        else:
            parts = [f"_f{i}" for i in range(len(columns))]
            wide = dataset.select("*", *[c.alias(p) for p, (_, c) in zip(parts, columns)])
            vector = VectorAssembler(inputCols=parts, outputCol=out).transform(wide).drop(*parts)
        attributes = {"numeric": [{"idx": i, "name": n} for i, (n, _) in enumerate(columns)]}
        return vector.withMetadata(out, {"ml_attr": {"attrs": attributes, "num_attrs": len(columns)}})


def make_encoder(cats: Sequence[str], nums: Sequence[str], multi: str = "", dense: bool = False, **options):
    return FeatureEncoder(catCols=list(cats), numCols=list(nums), multiCol=multi, dense=dense, **options)


def make_encoder_pair(cats: Sequence[str], nums: Sequence[str], multi: str = "", **options):
    """The encoder for resampling (dense) and the one for the model (sparse)."""
    return make_encoder(cats, nums, multi, True, **options), make_encoder(cats, nums, multi, False, **options)
