"""Exact interpolated percentiles and modes from value counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.operators.ranking import running_totals


def grouped_percentiles(
    df: DataFrame, groups: Sequence[str], value: str, probs: dict[str, float]
) -> DataFrame:
    """Continuous percentiles per group, one column for each name in ``probs``.

    Equal values are counted first, then running counts locate the two neighbours of each
    position; no task sees all values of a group.
    """
    groups = list(groups)
    known = df.where(F.col(value).isNotNull()).select(*groups, F.col(value).cast("double").alias("_v"))
    counts = known.groupBy(*groups, "_v").agg(F.count("*").alias("_c"))
    located = running_totals(counts, "_v", ["_c"], groups)
    cuts = []
    for name, p in probs.items():
        place = (F.col("all__c") - 1) * F.lit(p)
        lower = F.min(F.when(F.col("cum__c") > F.floor(place), F.col("_v")))
        upper = F.min(F.when(F.col("cum__c") > F.ceil(place), F.col("_v")))
        share = F.max(place - F.floor(place))
        cuts.append((lower + (upper - lower) * share).alias(name))
    return located.groupBy(*groups).agg(*cuts)


def column_medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, median)`` for numeric columns; an all-null column is absent."""
    cells = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [], list(columns), "column", "value"
    )
    return grouped_percentiles(cells, ["column"], "value", {"median": 0.5})
