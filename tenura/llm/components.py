"""Connected components of links between nodes, by local contraction, least labels and pointer jumps."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.llm.common import materialise

LINKS_PER_TASK = 200_000


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each node of a task's links beside the least node that these links reach."""
    root: dict = {}
    kind = None

    def find(x):
        top = x
        while root[top] != top:
            top = root[top]
        while root[x] != top:
            root[x], x = top, root[x]
        return top

    for batch in batches:
        kind = batch.schema.field("a").type
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
            root.setdefault(a, a)
            root.setdefault(b, b)
            a, b = find(a), find(b)
            if a != b:
                root[max(a, b)] = min(a, b)
    if root:
        nodes = list(root)
        yield pa.RecordBatch.from_arrays([pa.array(nodes, kind), pa.array([find(x) for x in nodes], kind)], names=["node", "root"])


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the least node reachable) for every node that has a link (``a``, ``b``).

    Links are dealt out to tasks of at most about 200,000, and each task contracts its own to stars. If
    more than one task was needed, the stars are joined: each round a node takes the least label among
    its own and its neighbours' and then the label of that label, so rounds grow with the logarithm of
    the longest path. Labels are written to the shared folder after each round. A node with very many
    links is one row after partial aggregation, and its side of a join is split by adaptive execution.
    """
    kept = links.select("a", "b")
    tasks = max(1, -(-kept.count() // LINKS_PER_TASK))
    kind = links.schema["a"].dataType.simpleString()
    stars = materialise(kept.repartition(tasks).mapInArrow(_contract, f"node {kind}, root {kind}"), "stars")
    if tasks == 1:
        return stars
    both = materialise(stars.select("node", "root").union(stars.select("root", "node")).toDF("a", "b").distinct(), "links")
    labels = materialise(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("root")), "labels")
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("root").alias("near"))
        lower = materialise(
            labels.join(near, labels["node"] == near["a"]).select("node", F.col("root").alias("old"), F.least("root", "near").alias("root")), "lower"
        )
        jump = lower.select(F.col("node").alias("root"), F.col("root").alias("further"))
        after = materialise(lower.join(jump, "root").select("node", F.least("root", "further").alias("root"), "old"), "labels")
        labels = after.select("node", "root")
        if after.where("root <> old").isEmpty():
            return labels
