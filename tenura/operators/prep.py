"""Joining and shaping the HR extracts."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenura.functions.text import digits_key, standard_name

KEY = "id_employee"
TARGET = "a_quitte_l_entreprise"
LEFT, STAYED = "Oui", "Non"


class MissingColumns(ValueError):
    """Raised when required columns are absent; names them."""


def standardize_columns(df: DataFrame) -> DataFrame:
    """Trimmed, lower-case names with underscores."""
    return df.toDF(*[standard_name(c) for c in df.columns])


def nan_to_null(df: DataFrame) -> DataFrame:
    """Make NaN a SQL null, so that missing values have one form."""
    floating = (T.DoubleType, T.FloatType)
    return df.select(
        *[
            F.when(~F.isnan(F.col(f.name)), F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, floating)
            else F.col(f.name)
            for f in df.schema
        ]
    )


def _suffix_clashes(left: DataFrame, right: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Give columns found on both sides the suffixes ``_x`` and ``_y``."""
    shared = (set(left.columns) & set(right.columns)) - {key}
    rename = lambda df, tail: df.withColumnsRenamed({c: c + tail for c in shared})
    return rename(left, "_x"), rename(right, "_y")


def left_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    left, right = _suffix_clashes(left, right, key)
    return left.join(right, key, "left")


def build_central(
    sirh: DataFrame,
    evals: DataFrame,
    survey: DataFrame,
    strict_keys: bool = True,
) -> DataFrame:
    """One employee table: sirh, then evaluations, then survey, by left joins on the employee."""
    evals = evals.withColumn(KEY, digits_key(F.col("eval_number"), strict_keys))
    survey = survey.withColumnRenamed("code_sondage", KEY)
    return left_join(left_join(sirh, evals, KEY), survey, KEY)


def target_label(value: Column) -> Column:
    """1 for leavers, 0 for stayers, null for anything else."""
    return F.when(value == LEFT, 1).when(value == STAYED, 0)


def map_target(df: DataFrame, column: str = TARGET, out: str = "label") -> DataFrame:
    """Map a text target; a target that is not text stays as it is."""
    if isinstance(df.schema[column].dataType, T.StringType):
        return df.withColumn(out, target_label(F.col(column)))
    return df.withColumn(out, F.col(column))


def split_feature_types(df: DataFrame, target: str) -> tuple[list[str], list[str]]:
    """Names of numeric and of other columns, without the target (flags are not numeric)."""
    fields = [f for f in df.schema if f.name != target]
    numeric = [f.name for f in fields if isinstance(f.dataType, T.NumericType)]
    return numeric, [f.name for f in fields if f.name not in numeric]


def keep_present(columns: Sequence[str], wanted: Iterable[str], without: Iterable[str] = ()) -> list[str]:
    """Wanted names that exist, each once and in the wanted order, less the excluded ones."""
    present, excluded = set(columns), set(without)
    return [c for c in dict.fromkeys(wanted) if c in present and c not in excluded]


def select_uncorrelated(
    df: DataFrame,
    drop_list: Iterable[str],
    also_drop: Iterable[str] = (),
    whitelist: Iterable[str] | None = None,
) -> DataFrame:
    """Leave out the correlated columns; names that are absent are ignored."""
    wanted = df.columns if whitelist is None else whitelist
    return df.select(*keep_present(df.columns, wanted, [*drop_list, *also_drop]))


def require_columns(df: DataFrame, required: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Required columns in model order, row keys first; missing ones are named in the error."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise MissingColumns(f"Missing required features: {missing}")
    return df.select(*keep, *[c for c in required if c not in keep])


def head_sample(df: DataFrame, order: Sequence[str], n: int = 100) -> DataFrame:
    """First rows by a given order."""
    return df.orderBy(*order).limit(n)


def class_balance(df: DataFrame, label: str = "label") -> DataFrame:
    """Stayers, leavers and share of leavers over all labelled rows."""
    y = F.col(label)
    return df.agg(
        F.count_if(y == 0).alias("class_0_stayed"),
        F.count_if(y == 1).alias("class_1_left"),
        F.avg(y.cast("double")).alias("attrition_rate"),
    )
