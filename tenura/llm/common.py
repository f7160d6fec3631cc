"""Reading tables and keeping intermediate results for the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tenura.session import materialise, shared_dir

__all__ = ["bound_batches", "fits", "materialise", "partitions", "shared_dir", "short_reads", "table"]

#: Bytes of rows that go to Python at once. Spark counts 10,000 rows and up to 64 MB else, held on both sides.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20
#: Rows that a reader of parquet holds at once. With Spark's 4,096, texts of 2 KB fill arrays of 8 MB in every task.
READ_SETTING, READ_ROWS = "spark.sql.parquet.columnarReaderBatchSize", 64


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bound_batches(spark: SparkSession) -> None:
    """Send rows to Python in batches of about `BATCH_BYTES`, unless the session has a value of its own."""
    if BATCH_SETTING not in spark.conf.getAll:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


@contextmanager
def short_reads(spark: SparkSession) -> Iterator[None]:
    """What runs inside reads `READ_ROWS` rows of parquet at once, unless the session has a value of its own."""
    own = READ_SETTING in spark.conf.getAll
    if not own:
        spark.conf.set(READ_SETTING, str(READ_ROWS))
    try:
        yield
    finally:
        if not own:
            spark.conf.unset(READ_SETTING)


def fits(rows: int, row_bytes: int, limit: int = 32 << 20) -> bool:
    """Whether a side of this counted size may be broadcast; callers shuffle it otherwise."""
    return rows * row_bytes <= limit
