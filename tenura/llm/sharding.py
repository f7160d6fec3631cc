"""Placing documents in shards by a hierarchical weighted hash tree."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenura.llm.common import materialise, partitions, short_reads

PLANNED = 16
RACK, REGION = 2, 4
#: Ranges of ids that one task writes, as long as every core has a task.
RANGES = 16


class Leaf(NamedTuple):
    region: str
    rack: str
    shard: int
    weight: float = 1.0


def tree(shards: int, planned: int = PLANNED) -> list[Leaf]:
    """Regions of two racks with two shards each for the planned shards; each later shard opens a
    region of its own, so that growth changes no weight below an older region."""
    found = []
    for shard in range(shards):
        region = f"g{shard // REGION}" if shard < planned else f"x{shard}"
        found.append(Leaf(region, f"{region}/{shard % REGION // RACK}" if shard < planned else f"{region}/0", shard))
    return found


def _draw(key: Column, child: Column) -> Column:
    """Exponential draw of a child, its rate being its weight: the least draw wins in proportion to weight."""
    bits = F.shiftrightunsigned(F.xxhash64(child["label"], key), 12)
    return -F.log((bits.cast("double") + 0.5) / F.lit(float(1 << 52))) / child["weight"]


def _children(pairs: list[tuple[str, float]]) -> Column:
    weights: dict[str, float] = {}
    for label, weight in pairs:
        weights[label] = weights.get(label, 0.0) + weight
    return F.array(*[F.struct(F.lit(k).alias("label"), F.lit(w).alias("weight")) for k, w in weights.items()])


def _descend(key: Column, children: Column) -> Column:
    drawn = F.transform(children, lambda c: F.struct(_draw(key, c).alias("draw"), c["label"].alias("label")))
    return F.array_min(drawn)["label"]


def place(key: Column, leaves: list[Leaf]) -> Column:
    """Shard of a key: a weighted draw among the regions, then the racks of the region, then its shards.

    A draw depends on the key, the child's name and the child's weight alone. So a changed weight moves
    keys only into the subtree that gained or out of the one that lost. Leaves of weight 0 or less are
    left out. A null key is one key like any other.
    """
    alive = [x for x in leaves if x.weight > 0]
    if not alive:
        raise ValueError("no shard has a positive weight")

    def below(level: str, child: str) -> Column:
        groups: dict[str, list[tuple[str, float]]] = {}
        for x in alive:
            name = f"s{x.shard}" if child == "shard" else getattr(x, child)
            groups.setdefault(getattr(x, level), []).append((name, x.weight))
        return F.create_map(*[v for k, pairs in groups.items() for v in (F.lit(k), _children(pairs))])

    key = F.coalesce(key.cast("string"), F.lit("null"))
    region = _descend(key, _children([(x.region, x.weight) for x in alive]))
    rack = _descend(key, F.element_at(below("region", "rack"), region))
    shard = _descend(key, F.element_at(below("rack", "shard"), rack))
    return F.substring(shard, 2, 12).cast("int")


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with their place among the rows of the same range and shard."""
    seen: dict[int, int] = {}
    for batch in batches:
        shards = batch.column("shard").to_numpy(zero_copy_only=False)
        places = np.empty(len(shards), np.int64)
        for shard in np.unique(shards):
            at = np.flatnonzero(shards == shard)
            before = seen.get(int(shard), 0)
            places[at] = before + np.arange(len(at))
            seen[int(shard)] = before + len(at)
        yield batch.drop_columns(["copy"]).append_column("place", pa.array(places))


def _writers(spark: SparkSession) -> int:
    """Tasks that write the numbered rows. A range is small, and each file costs the executor several
    processes where the shared folder is a local path: Hadoop sets permissions by chmod there."""
    ranges = partitions(spark)
    return min(ranges, max(spark.sparkContext.defaultParallelism, ranges // RANGES))


def shard_documents(docs: DataFrame, leaves: list[Leaf], grown: list[Leaf] | None = None) -> DataFrame:
    """One row per document with its shard and a gapless slot inside it, in order of doc_id.

    Law ``key``: equal doc_ids share a shard, whatever their texts. A null text has size 1 and checksum 0;
    a null doc_id is a key of its own and takes the first slots. Repeated rows each get a slot. An empty
    table gives no rows; other columns are ignored. Texts never move: the shuffle carries ids and sizes.
    Rows are dealt out by ranges of doc_id, checksum and a row number, so no doc_id or text is too
    frequent for one task. A task numbers and writes several ranges, one after the other.
    """
    spark = docs.sparkSession
    small = docs.select(
        F.col("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.monotonically_increasing_id().alias("copy"),
    )
    order = ["doc_id", "text_crc32", "size", "copy"]
    with short_reads(spark):
        # ranges are found in one pass and dealt out in another: the second one takes ids and sizes from local disk
        small = small.persist(StorageLevel.DISK_ONLY)
        try:
            ranged = small.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
            placed = ranged.withColumn("shard", place(F.col("doc_id"), leaves))
            placed = placed.withColumn("grown_shard", place(F.col("doc_id"), grown) if grown else F.lit(None).cast("int"))
            placed = placed.withColumn("part", F.spark_partition_id())
            kind = placed.drop("copy").schema.add("place", T.LongType())
            numbered = materialise(placed.mapInArrow(_number, kind).coalesce(_writers(spark)), "shards")
        finally:
            small.unpersist()
    counts = numbered.groupBy("shard", "part").agg(F.max("place").alias("last"))
    before = F.sum(F.col("last") + 1).over(Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("shard", "part", F.coalesce(before, F.lit(0)).alias("begin"))
    # one row per shard and range: bounded by the job's own partition count
    return numbered.join(F.broadcast(starts), ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("begin") + F.col("place")).alias("slot"), "grown_shard",
    )
