"""Token files: frequency-ranked ids in byte-aligned variable-length coding.

A folder of the format holds two tables. ``ranks`` lists the vocabulary by falling frequency. ``blocks``
has runs of documents in ascending order of doc_id: their ids as ranks, each in 1 to 4 little-endian
bytes (``data``), and apart from these the lengths, two bits for each id and four ids to a byte
(``control``); every document begins a new control byte.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tenura.llm.arrow import binaries, numbers, slices
from tenura.llm.common import partitions
from tenura.llm.tokens import SLICE_BYTES, encoder, read_spec
from tenura.session import fresh_path

END_ID = 2
BLOCK_IDS = 1 << 20
BLOCKS = "part int, before long, doc_ids array<long>, counts array<long>, control binary, data binary"
BLOCKS_ARROW = pa.schema(
    [("part", pa.int32()), ("before", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())),
     ("control", pa.binary()), ("data", pa.binary())]
)
#: Lengths of the four ids that a control byte describes.
LENGTHS = np.array([[1 + (c >> 2 * i & 3) for i in range(4)] for c in range(256)], np.uint8)


def _used(counts: np.ndarray) -> np.ndarray:
    """Which slots of the control bytes hold an id: all but at most three behind each document."""
    room = -(-counts // 4) * 4
    ends, spare = np.cumsum(room), room - counts
    used = np.ones(int(room.sum()), bool)
    for back in (1, 2, 3):
        used[ends[spare >= back] - back] = False
    return used


def code(ranks: np.ndarray, counts: np.ndarray | None = None) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of documents with so many ranks each; of one document if none are named."""
    counts = np.array([len(ranks)]) if counts is None else counts
    most = int(ranks.max(initial=0))
    ranks = ranks.astype("<u2" if most < 1 << 16 else "<u4")
    extra = (ranks >= 1 << 8).astype(np.uint8)
    for bits in (16, 24):
        if most >= 1 << bits:
            extra += ranks >= 1 << bits
    used = _used(counts)
    padded = np.zeros(len(used), np.uint8)
    padded[used] = extra
    four = padded.view("<u4")
    control = (four | four >> 6 | four >> 12 | four >> 18).astype(np.uint8)  # bits of a byte each, side by side
    keep = np.ones((len(ranks), ranks.itemsize), bool)
    for byte in range(1, ranks.itemsize):
        keep[:, byte] = extra >= byte
    return control.tobytes(), ranks.view(np.uint8)[keep.ravel()].tobytes()


def decode(control: bytes, data: bytes, counts: np.ndarray) -> np.ndarray:
    """Ranks of a block's documents, end to end: lengths come from a table, bytes from their places."""
    slots, used = LENGTHS[np.frombuffer(control, np.uint8)].ravel(), _used(counts)
    if len(used) != len(slots):
        raise ValueError("control bytes do not fit the counts")
    lengths = slots[used]
    begins = np.cumsum(lengths, dtype=np.int64)
    if (int(begins[-1]) if len(begins) else 0) != len(data):
        raise ValueError("data bytes do not fit the lengths")
    begins -= lengths
    raw = np.frombuffer(data, np.uint8)
    found = raw[begins].astype(np.uint32)
    for byte in range(1, int(lengths.max(initial=0))):
        longer = np.flatnonzero(lengths > byte)
        found[longer] |= raw[begins[longer] + byte].astype(np.uint32) << np.uint32(8 * byte)
    return found


def _encode(sent, end_id: int) -> Callable:
    """Documents as ids, and in the last row of a task how often it met each id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(sent.value)
        kind = "<u2" if max(tool.size, end_id + 1) <= 1 << 16 else "<u4"
        seen = np.zeros(max(tool.size, end_id + 1), np.int64)
        names = ["doc_id", "ids", "token", "times"]
        kinds = [pa.int64(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int64())]
        for batch in slices(batches, "text", SLICE_BYTES):
            flat, counts = tool.encode(batch.column("text"))
            seen += np.bincount(flat, minlength=len(seen))
            seen[end_id] += len(counts)
            ids = binaries(np.insert(flat.astype(kind), np.cumsum(counts), end_id), counts + 1)
            none = [pa.nulls(len(ids), k) for k in kinds[2:]]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), ids, *none], names=names)
        token = np.flatnonzero(seen)
        if len(token):
            columns = [[None], [None], [token.tolist()], [seen[token].tolist()]]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return run


def _write(ranks, kind: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank_of, part = ranks.value, TaskContext.get().partitionId()
        held: list[tuple] = []
        size = before = 0

        def block() -> pa.RecordBatch:
            row = {
                "part": part, "before": before, "doc_ids": [d for h in held for d in h[0]],
                "counts": [n for h in held for n in h[1]], "control": b"".join(h[2] for h in held), "data": b"".join(h[3] for h in held),
            }
            return pa.RecordBatch.from_pylist([row], schema=BLOCKS_ARROW)

        for batch in slices(batches, "ids", BLOCK_IDS * np.dtype(kind).itemsize):
            flat, counts = numbers(batch.column("ids"), kind)
            held.append((batch.column("doc_id").to_pylist(), counts.tolist(), *code(rank_of[flat], counts)))
            size += len(flat)
            if size >= BLOCK_IDS:
                yield block()
                before, size, held = before + size, 0, []
        if held:
            yield block()

    return run


def write_tokens(docs: DataFrame, tokenizer: str, path: str, end_id: int = END_ID) -> None:
    """Encode every whole text, append ``end_id``, and write the folder ``path`` in ascending doc_id order.

    Texts are encoded once, without a shuffle, and kept as plain ids in the shared folder with each task's
    counts; these give the ranks (ties to the smaller id). Then ids, not texts, are dealt out by ranges
    of doc_id. A null or empty text is its end id alone. Null doc_ids come first; repeated rows are all
    written, equal doc_ids in the order of their ids. An empty table gives empty tables.
    """
    spark = docs.sparkSession
    spec = read_spec(tokenizer)
    size = max(encoder(spec).size, end_id + 1)
    sent = spark.sparkContext.broadcast(spec)
    kept = fresh_path(spark, "ids")
    encoded = docs.select("doc_id", "text").mapInArrow(
        _encode(sent, end_id), "doc_id long, ids binary, token array<int>, times array<long>"
    )
    encoded.write.option("compression", "zstd").parquet(kept)
    encoded = spark.read.schema(encoded.schema).parquet(kept)
    counts = encoded.where("token is not null").select(F.explode(F.arrays_zip("token", "times")).alias("x"))
    counts = counts.groupBy("x.token").agg(F.sum("x.times").alias("times"))
    by_rank = counts.orderBy(F.desc("times"), "token").toArrow()  # at most as many rows as the vocabulary has
    order = by_rank.column("token").to_numpy().astype(np.int64)
    rank_of = np.zeros(size, np.uint32)
    rank_of[order] = np.arange(len(order))
    spark.createDataFrame(
        pa.table({"rank": pa.array(np.arange(len(order)), pa.int32()), "token": pa.array(order, pa.int32())})
    ).coalesce(1).write.parquet(f"{path}/ranks")
    kind = "<u2" if size <= 1 << 16 else "<u4"
    ranged = encoded.where("ids is not null").select("doc_id", "ids", F.xxhash64("ids").alias("tie"))
    ranged = ranged.withColumn("copy", F.monotonically_increasing_id())
    keys = ["doc_id", "tie", "copy"]
    ranged = ranged.repartitionByRange(partitions(spark), *keys).sortWithinPartitions(*keys).select("doc_id", "ids")
    ranged.mapInArrow(_write(spark.sparkContext.broadcast(rank_of), kind), BLOCKS).write.option("compression", "zstd").parquet(
        f"{path}/blocks"
    )


def _read(tokens) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token_of = tokens.value
        for batch in batches:
            for row in batch.to_pylist():
                counts = np.array(row["counts"], np.int64)
                flat = token_of[decode(row["control"], row["data"], counts)].astype("<u4")
                ends = np.cumsum(counts)
                starts = row["begin"] + ends - counts
                step = 0
                while step < len(counts):  # rows of bounded size
                    to = max(step + 1, int(np.searchsorted(ends, (ends[step - 1] if step else 0) + BLOCK_IDS, "right")))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(row["doc_ids"][step:to], pa.int64()), pa.array(starts[step:to]), pa.array(counts[step:to]),
                            binaries(flat[ends[step] - counts[step] : ends[to - 1]], counts[step:to]),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids"],
                    )
                    step = to

    return run


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Documents of a token folder: doc_id, start (ids of all documents before), n_tokens, and ids as
    little-endian unsigned 32-bit numbers."""
    order = spark.read.parquet(f"{path}/ranks").orderBy("rank").toArrow().column("token").to_numpy()
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    sizes = blocks.select("part", (F.col("before") + F.aggregate("counts", F.lit(0).cast("long"), lambda a, b: a + b)).alias("end"))
    sizes = sizes.groupBy("part").agg(F.max("end").alias("size"))
    earlier = F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    # one row per written partition
    offsets = sizes.select("part", F.coalesce(earlier, F.lit(0)).alias("earlier"))
    placed = blocks.join(F.broadcast(offsets), "part").withColumn("begin", F.col("earlier") + F.col("before"))
    tokens = spark.sparkContext.broadcast(order.astype(np.uint32))
    return placed.select("doc_ids", "counts", "control", "data", "begin").mapInArrow(
        _read(tokens), "doc_id long, start long, n_tokens long, ids binary"
    )
