"""Every query with an SQL twin gives the same result on a second engine."""

import pytest

import __spark_entry__ as entry_points
from tenura.plans import registry
from compare import compare, connect

QUERIES, SQL = entry_points.queries(), registry.SQL


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, folder, con, name):
    assert compare(QUERIES[name](spark, folder), con, SQL[name]) == []


def test_entry_has_rows(spark):
    assert entry_points.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(entry_points.oracle_sql()) <= set(QUERIES)


@pytest.mark.parametrize("name", ["latency_percentiles", "gate_rank_predict", "cv_summary", "near_miss1", "daily_volume"])
@pytest.mark.parametrize("partitions", ["1", "64"])
def test_independent_of_partitioning(spark, folder, con, name, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        assert compare(QUERIES[name](spark, folder), con, SQL[name]) == []
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
