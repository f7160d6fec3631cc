"""Column profile, value counts and rates by category."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.functions.text import tokens
from tenura.operators.prep import LEFT, TARGET

QUASI_CONSTANT_FROM = 0.98
HIGH_MISSING_FROM = 0.80
MODERATE_MISSING_FROM = 0.40


def cell_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``(column, value, cnt)`` over all cells, nulls included, values as text.

    The map side adds up equal cells first, so a frequent value does not make a heavy shuffle key.
    """
    columns = columns or df.columns
    cells = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in columns]).unpivot(
        [], columns, "column", "value"
    )
    return cells.groupBy("column", "value").agg(F.count("*").alias("cnt"))


def profile_columns(df: DataFrame) -> DataFrame:
    """One row per column: type, distinct values (null counts as one), missing, top value.

    Among equally frequent values the null comes first, then the smallest text.
    """
    per_column = (
        cell_counts(df)
        .groupBy("column")
        .agg(
            F.count("*").alias("nunique"),
            F.sum(F.when(F.col("value").isNull(), F.col("cnt")).otherwise(0)).alias("n_missing"),
            F.sum("cnt").alias("n_rows"),
            F.min(F.struct((-F.col("cnt")).alias("neg"), F.col("value").alias("value"))).alias("top"),
        )
    )
    names = df.sparkSession.createDataFrame(
        [(f.name, f.dataType.simpleString()) for f in df.schema], "column string, dtype string"
    )
    ratio = lambda part: F.try_divide(part, F.col("n_rows"))
    return (
        names.join(per_column, "column", "left")
        .select(
            "column",
            "dtype",
            F.coalesce("nunique", F.lit(0)).alias("nunique"),
            F.coalesce("n_missing", F.lit(0)).alias("n_missing"),
            F.coalesce(ratio(F.col("n_missing")), F.lit(0.0)).alias("pct_missing"),
            F.col("top.value").alias("top_value"),
            ratio(-F.col("top.neg")).alias("top_ratio"),
        )
        .orderBy(F.desc("pct_missing"), F.desc("top_ratio"), "column")
    )


def profile_flags(
    profile: DataFrame,
    quasi_constant: float = QUASI_CONSTANT_FROM,
    high_missing: float = HIGH_MISSING_FROM,
    moderate_missing: float = MODERATE_MISSING_FROM,
) -> DataFrame:
    """``(flag, column)`` shortlists of a profile."""
    constant = F.col("nunique") <= 1
    missing = F.col("pct_missing")
    top = F.coalesce("top_ratio", F.lit(1.0))
    flags = F.array_compact(
        F.array(
            F.when(constant, "constant"),
            F.when((top >= quasi_constant) & ~constant, "quasi_constant"),
            F.when(missing >= high_missing, "high_missing"),
            F.when((missing >= moderate_missing) & (missing < high_missing), "moderate_missing"),
        )
    )
    return profile.select(F.explode(flags).alias("flag"), "column").orderBy("flag", "column")


def value_frequencies(df: DataFrame, column: str, split: bool = False, sep: str = ",") -> DataFrame:
    """Counts of the non-null values, or of the parts of separated lists.

    ``percentage`` is the share of all counted parts and ``n_unique`` the number of values.
    """
    if column not in df.columns:
        raise KeyError(f"no column named {column}")
    text = df.where(F.col(column).isNotNull()).select(F.col(column).cast("string").alias("value"))
    if split:
        text = text.select(F.explode(tokens(F.col("value"), sep)).alias("value"))
    counts = text.groupBy("value").agg(F.count("*").alias("frequency"))
    whole = counts.agg(F.struct(F.sum("frequency").alias("total"), F.count("*").alias("n"))).scalar()
    return counts.select(
        "value",
        "frequency",
        (F.col("frequency") / whole["total"] * 100).alias("percentage"),
        whole["n"].alias("n_unique"),
    ).orderBy(F.desc("frequency"), "value")


def rate_by_category(df: DataFrame, category: str, target: str = TARGET) -> DataFrame:
    """Share of leavers over all rows of a category, and the number of rows with a target."""
    return (
        df.where(F.col(category).isNotNull())
        .groupBy(category)
        .agg(
            F.count(target).alias("n"),
            F.avg(F.when(F.col(target) == LEFT, 1.0).otherwise(0.0)).alias("taux_depart"),
        )
        .orderBy(F.desc("taux_depart"), category)
    )
