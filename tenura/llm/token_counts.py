"""Token counts of whole texts; huge documents are counted in overlapping chunks on many tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tenura.llm.arrow import slices
from tenura.llm.common import materialise, partitions
from tenura.llm.tokens import SLICE_BYTES, encoder, read_spec

STEP = 1 << 15
OVERLAP = 1 << 9
SPLIT = "doc_id {}, n_bytes long, n_tokens long, key long, idx int, begin long, size long, text string"
MARKS = "key long, idx int, begin long, size long, n long, head array<long>, head_n array<long>, tail array<long>, tail_n array<long>"


def _split(sent, step: int, overlap: int) -> Callable:
    """Counts of ordinary documents, and chunks of the huge ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(sent.value)
        key = TaskContext.get().partitionId() << 36
        names = ["doc_id", "n_bytes", "n_tokens", "key", "idx", "begin", "size", "text"]
        kinds = [None, pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string()]
        for batch in slices(batches, "text", SLICE_BYTES):
            kinds[0] = batch.schema.field("doc_id").type
            sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).cast(pa.int64())
            batch = batch.append_column("n_bytes", sizes)
            long = pc.fill_null(pc.greater(pc.utf8_length(batch.column("text")), step + overlap), False)
            if not tool.by_words:  # no boundary can be proven
                long = pa.array(np.zeros(batch.num_rows, bool))
            short = batch.filter(pc.invert(long))
            _, counts = tool.encode(short.column("text"), want_ids=False)
            none = [pa.nulls(short.num_rows, k) for k in kinds[3:]]
            yield pa.RecordBatch.from_arrays([short.column("doc_id"), short.column("n_bytes"), pa.array(counts, pa.int64()), *none], names=names)
            for row in batch.filter(long).to_pylist():
                key += 1
                text, at, idx = row["text"], 0, 0
                while True:
                    last = at + step + overlap >= len(text)
                    part = text[at:] if last else text[at : at + step + overlap]
                    columns = [row["doc_id"], row["n_bytes"], None, key, idx, at, len(part), part]
                    yield pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(columns, kinds)], names=names)
                    if last:
                        break
                    at, idx = at + step, idx + 1

    return run


def _stable(text: str, low: int, high: int, offsets: np.ndarray) -> tuple[list[int], list[int]]:
    """Places where a space follows a visible character and a token begins, with the tokens before each.

    There the pre-tokenizer's pattern always parts the text (see `splits_at_spaces`), so the ids on either
    side do not depend on the other side.
    """
    places, before = [], []
    for p in range(max(low, 1), min(high, len(text))):
        if text[p] == " " and not text[p - 1].isspace():
            n = int(np.searchsorted(offsets, p))
            if n < len(offsets) and offsets[n] == p:
                places.append(p)
                before.append(n)
    return places, before


def _encode_chunks(sent, step: int, overlap: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(sent.value).library
        for batch in slices(batches, "text", SLICE_BYTES):
            rows = []
            for row in batch.to_pylist():
                text = row["text"]
                found = tool.encode(text, add_special_tokens=False)
                offsets = np.array([a for a, _ in found.offsets], np.int64)
                head, head_n = _stable(text, 0, overlap, offsets)
                tail, tail_n = _stable(text, step, step + overlap, offsets)
                rows.append(
                    {"key": row["key"], "idx": row["idx"], "begin": row["begin"], "size": row["size"], "n": len(offsets),
                     "head": [row["begin"] + p for p in head], "head_n": head_n, "tail": [row["begin"] + p for p in tail], "tail_n": tail_n}
                )
            yield pa.RecordBatch.from_pylist(rows, schema=MARKS_ARROW)

    return run


MARKS_ARROW = pa.schema(
    [("key", pa.int64()), ("idx", pa.int32()), ("begin", pa.int64()), ("size", pa.int64()), ("n", pa.int64())]
    + [(c, pa.list_(pa.int64())) for c in ("head", "head_n", "tail", "tail_n")]
)


def _count_runs(sent) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(sent.value)
        for batch in slices(batches, "text", SLICE_BYTES):
            _, counts = tool.encode(batch.column("text"), want_ids=False)
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(counts, pa.int64())], names=["key", "n_tokens"])

    return run


def _huge(chunks: DataFrame, sent, step: int, overlap: int) -> DataFrame:
    """Tokens by key: chunks are spliced at the first stable boundary that both neighbours share.

    Where an overlap holds none, it is widened: all chunks up to the next junction that holds are joined
    and encoded as one text.
    """
    spark = chunks.sparkSession
    dealt = chunks.select("key", "idx", "begin", "size", "text").repartition(partitions(spark), "key", "idx")
    marks = materialise(dealt.mapInArrow(_encode_chunks(sent, step, overlap), MARKS), "marks")
    left = marks.select("key", "idx", "tail", "tail_n")
    right = marks.select("key", (F.col("idx") - 1).alias("idx"), "head", "head_n")
    common = F.array_min(F.array_intersect("tail", "head"))

    def at(counts: str, places: str):
        return F.when(F.col("p").isNotNull(), F.element_at(counts, F.array_position(places, F.col("p")).cast("int")))

    joints = left.join(right, ["key", "idx"]).withColumn("p", common)
    joints = joints.select("key", "idx", "p", at("tail_n", "tail").alias("upto"), at("head_n", "head").alias("skip"))
    after = joints.select("key", "idx", F.lit(True).alias("more"), F.col("p").alias("high"), "upto")
    before = joints.select("key", (F.col("idx") + 1).alias("idx"), F.lit(True).alias("less"), F.col("p").alias("low"), "skip")
    each = marks.select("key", "idx", "begin", "size", "n").join(after, ["key", "idx"], "left").join(before, ["key", "idx"], "left")
    each = materialise(
        each.withColumn("whole", (F.col("more").isNull() | F.col("high").isNotNull()) & (F.col("less").isNull() | F.col("low").isNotNull())), "spliced"
    )
    spliced = each.where("whole").select("key", (F.coalesce("upto", "n") - F.coalesce("skip", F.lit(0))).alias("n_tokens"))
    # chunks beside a failed junction: a run goes on over every junction that failed
    opens = F.when(F.col("less").isNull() | F.col("low").isNotNull(), 1).otherwise(0)
    runs = each.where("not whole").withColumn("run", F.sum(opens).over(Window.partitionBy("key").orderBy("idx")))
    lowest = F.coalesce("low", "begin")
    highest = F.coalesce("high", F.when(F.col("more").isNull(), F.col("begin") + F.col("size")).otherwise(F.col("begin") + step))
    runs = runs.select("key", "idx", "run", (lowest - F.col("begin")).alias("from"), (highest - lowest).alias("take"))
    texts = runs.join(chunks.select("key", "idx", "text"), ["key", "idx"])
    part = F.substring("text", (F.col("from") + 1).cast("int"), F.col("take").cast("int"))
    joined = texts.groupBy("key", "run").agg(F.array_sort(F.collect_list(F.struct("idx", part.alias("text")))).alias("parts"))
    joined = joined.select("key", F.array_join(F.transform("parts", lambda x: x["text"]), "").alias("text"))
    widened = joined.mapInArrow(_count_runs(sent), "key long, n_tokens long")
    return spliced.union(widened).groupBy("key").agg(F.sum("n_tokens").alias("n_tokens"))


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 512, step: int = STEP, overlap: int = OVERLAP) -> DataFrame:
    """Bytes and tokens of every whole text: doc_id, n_bytes, n_tokens, over_limit (n_tokens > ``limit``).

    ``tokenizer`` is the path of a file of the tokenizers library. Texts of up to ``step + overlap``
    characters are counted where they are read. Longer ones become overlapping chunks that are encoded
    with offsets on other tasks and spliced; that needs a vocabulary whose boundaries can be proven
    (`splits_at_spaces`), and with others every text is counted whole.

    A null or empty text has 0 bytes and 0 tokens. Repeated rows each get a row; a null doc_id stays null.
    An empty table gives no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    if not 0 < overlap <= step:
        raise ValueError("the overlap must be positive and at most the step")
    sent = spark.sparkContext.broadcast(read_spec(tokenizer))
    kind = SPLIT.format(docs.schema["doc_id"].dataType.simpleString())
    rows = materialise(docs.select("doc_id", "text").mapInArrow(_split(sent, step, overlap), kind), "counts")
    chunks = rows.where("key is not null")
    huge = chunks.where("idx = 0").select("key", "doc_id", "n_bytes").join(_huge(chunks, sent, step, overlap), "key")
    names = ["doc_id", "n_bytes", "n_tokens"]
    every = rows.where("key is null").select(*names).union(huge.select(*names))
    return every.withColumn("over_limit", F.col("n_tokens") > limit)
