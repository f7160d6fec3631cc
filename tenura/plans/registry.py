"""Named queries, each with the SQL that a second engine runs to check it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def keep(func: Query) -> Query:
        QUERIES[name] = func
        if sql is not None:
            SQL[name] = sql
        return func

    return keep


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles to a fixed number of places, so that two engines can be compared."""
    return df.select(
        *[
            F.round(f.name, places).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
            for f in df.schema
        ]
    )


def load_all() -> None:
    """Import every module that registers queries."""
    from tenura.plans import (  # noqa: F401
        audit_queries,
        feature_queries,
        metric_queries,
        model_queries,
        prep_queries,
        quality_queries,
        sampling_queries,
        stream_queries,
    )
