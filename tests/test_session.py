"""What is kept on disk by steps that write their result."""

import os
import time
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tenura.llm import dedup
from tenura.session import FREE_SHUFFLES, materialise


def shuffled(spark):
    """Bytes of each shuffle file of this process."""
    tops = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirsString()
    return {x: os.path.getsize(f"{d}/{x}") for top in tops for d, _, names in os.walk(top) for x in names if x.startswith("shuffle_")}


def left_by(spark, step):
    """Bytes that a step leaves in shuffle files. These go a little after it, and the driver's garbage is not collected."""
    before = shuffled(spark)
    step()
    for _ in range(50):
        left = sum(n for x, n in shuffled(spark).items() if x not in before)
        if left < 20_000:
            break
        time.sleep(0.2)
    return left


@pytest.fixture
def docs(spark):
    words = [F.substring(F.md5((F.col("id") * 100 + i).cast("string")), 1, 8) for i in range(60)]
    return materialise(spark.range(0, 2000, 1, 4).select(F.col("id").alias("doc_id"), F.concat_ws(" ", *words).alias("text")), "docs")


def test_a_written_step_frees_what_it_shuffled(spark):
    held = []
    df = spark.range(100_000).groupBy(F.md5(F.col("id").cast("string")).alias("x")).count()
    assert left_by(spark, lambda: held.append(materialise(df, "counts"))) < 20_000
    assert held[0].count() == 100_000


def test_the_setting_is_put_back(spark):
    before = spark.conf.get(FREE_SHUFFLES, "false")
    materialise(spark.range(3), "rows")
    with pytest.raises(Exception):
        materialise(spark.range(3).select(F.raise_error(F.lit("no"))), "rows")
    assert spark.conf.get(FREE_SHUFFLES, "false") == before


def test_counts_of_shingles_are_not_kept_as_shuffles(spark, docs):
    held = []
    assert left_by(spark, lambda: held.append(dedup._commonness(docs))) < 20_000
    assert (held[0] > 0).sum() > 0


def test_nodes_without_links_have_no_group_and_stay_where_they_lie(spark, monkeypatch):
    monkeypatch.setattr(dedup, "BLOCK", 2)  # lists are cut, too
    names = [bytes([i]) * 16 for i in range(1, 7)]
    prefix = np.arange(5, dtype=np.int64).tobytes()
    nodes = materialise(spark.createDataFrame([(n, 17, prefix) for n in names], "node binary, n_shingles long, prefix binary"), "nodes")
    roots = materialise(spark.createDataFrame([(n, names[0]) for n in names[:3]], "node binary, root binary"), "roots")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        grouped = dedup._grouped(nodes, roots)
        assert "hashpartitioning" not in grouped._jdf.queryExecution().executedPlan().toString()
        assert {bytes(r.node): r.group for r in grouped.collect()} == {n: names[0] if n in names[:3] else None for n in names}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    found = {(bytes(r.a), bytes(r.b)) for r in dedup.rest_of_pairs(grouped).collect()}
    assert found == {p for p in combinations(names, 2) if p[1] not in names[:3]}
    every = {(bytes(r.a), bytes(r.b)) for r in dedup.rest_of_pairs(dedup._grouped(nodes, None)).collect()}
    assert every == set(combinations(names, 2))
