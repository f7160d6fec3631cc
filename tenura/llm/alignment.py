"""Two tokenizers side by side: each distinct text is aligned once, pair counts are weighted by its copies."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.llm.arrow import raw, slices
from tenura.llm.common import materialise
from tenura.llm.tokens import encoder, read_spec
from tenura.session import fresh_path

SLICE_BYTES = 1 << 20
KEPT_WORDS = 300_000
#: Pairs whose counts are sent to every task (17 bytes each), the most frequent ones; all others are joined.
FREQUENT = 1 << 20
#: Pairs that a task adds up before it hands them on.
HELD_PAIRS = 1 << 20
#: At most so many texts are repeated so often that their measures are sent to every task.
HOT_TEXTS = 50_000
LEAST_HOT = 1_000
MEASURES = ("n_a", "n_b", "n_groups", "n_links")
ALIGNED = "key binary, copies long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, times binary"


class Bytes(NamedTuple):
    """The bytes of every token id."""

    flat: np.ndarray
    begins: np.ndarray
    sizes: np.ndarray

    def joined(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of these tokens end to end, and where each token ends."""
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        places = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.begins[ids] - (ends - sizes), sizes)
        return self.flat[places], ends


def _bytes(tokens: list[bytes]) -> Bytes:
    sizes = np.array([len(t) for t in tokens], np.int64)
    return Bytes(np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(sizes) - sizes, sizes)


def byte_level_table() -> dict[str, int]:
    """The byte behind each character of a byte-level vocabulary: visible Latin-1 stands for itself, the rest follows from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Pair:
    """Both tokenizers of a process, and the bytes of their ids."""

    def __init__(self, spec: str, model: bytes, kept_words: int):
        self.a = encoder(spec, kept_words, True)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        byte_of = byte_level_table()
        tokens = [b""] * self.a.size
        added = self.a.library.get_added_tokens_decoder()
        for token, number in self.a.library.get_vocab().items():
            tokens[number] = token.encode() if number in added else bytes(byte_of[c] for c in token)
        self.bytes_a = _bytes(tokens)
        pieces = range(self.b.get_piece_size())
        self.bytes_b = _bytes(
            [bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace("▁", " ").encode() for i in pieces]
        )
        self.shift = max(1, len(tokens).bit_length())  # bits of an id of B come below those of A
        self.shift_b = max(1, len(pieces).bit_length())
        most = max(len(tokens), len(pieces))
        names = [str(i).encode() for i in range(most)]
        self.width = len(names[-1])
        self.digits = np.zeros((most, self.width + 1), np.uint8)
        self.n_digits = np.array([len(n) for n in names], np.int64)
        for i, name in enumerate(names):
            self.digits[i, : len(name)] = np.frombuffer(name, np.uint8)

    def encode_b(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = self.b.encode(texts, num_threads=1)
        return np.array([i for x in ids for i in x], np.int64), np.array([len(x) for x in ids], np.int64)


@lru_cache(maxsize=1)
def pair(spec: str, model: bytes, kept_words: int) -> Pair:
    return Pair(spec, model, kept_words)


class Aligned(NamedTuple):
    """Measures of the texts of a batch; the links of text i are ``pair[begins[i]:begins[i + 1]]``."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    digests: list[str]
    begins: np.ndarray
    pair: np.ndarray
    times: np.ndarray


def _chosen(ids: np.ndarray, counts: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return ids[np.repeat(keep, counts)], counts[keep]


def _differs(got: np.ndarray, want: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Whether the bytes of each text differ; texts are not empty."""
    return np.logical_or.reduceat(got != want, begins) if len(begins) else np.zeros(0, bool)


def align(tool: Pair, column: pa.Array) -> Aligned:
    """Tokens, groups and links of each text (not null) of a column."""
    texts = column.cast(pa.large_string())
    rows = len(texts)
    spaced = pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), texts, pa.scalar("", pa.large_string()))
    flat_a, n_a = tool.a.encode(spaced)
    flat_a, (flat_b, n_b) = flat_a.astype(np.int64), tool.encode_b(texts.to_pylist())
    data, offsets = raw(spaced)
    size = np.diff(offsets)

    def byte_counts(ids: np.ndarray, counts: np.ndarray, table: Bytes) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(table.sizes[ids])])
        ends = np.cumsum(counts)
        return sums[ends] - sums[ends - counts]

    keep = (size > 1) & (byte_counts(flat_a, n_a, tool.bytes_a) == size) & (byte_counts(flat_b, n_b, tool.bytes_b) == size)
    for again in (True, False):  # first by length, then by the bytes themselves
        part_a, count_a = _chosen(flat_a, n_a, keep)
        part_b, count_b = _chosen(flat_b, n_b, keep)
        bytes_a, ends_a = tool.bytes_a.joined(part_a)
        bytes_b, ends_b = tool.bytes_b.joined(part_b)
        held = size[keep]
        borders = np.cumsum(held)
        if again:
            want, begins = data[np.repeat(keep, size)], borders - held
            wrong = _differs(bytes_a, want, begins) | _differs(bytes_b, want, begins)
            if not wrong.any():
                break
            keep[np.flatnonzero(keep)[wrong]] = False
    return _measured(tool, rows, keep, part_a, part_b, count_a, count_b, ends_a, ends_b, borders)


def _measured(tool: Pair, rows: int, keep: np.ndarray, a: np.ndarray, b: np.ndarray, count_a: np.ndarray, count_b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray, borders: np.ndarray) -> Aligned:
    """Borders where both tokenizers end a token cut groups; every stretch between two borders of either is one link."""
    size = int(borders[-1]) if len(borders) else 0
    stops_a, stops_b = np.zeros(size, bool), np.zeros(size, bool)  # whether a token ends with this byte
    stops_a[ends_a - 1] = stops_b[ends_b - 1] = True
    every = np.flatnonzero(stops_a | stops_b)
    first, second = a[_earlier(stops_a[every])], b[_earlier(stops_b[every])]
    n_links = np.diff(np.searchsorted(every, borders), prepend=0)
    doc = np.repeat(np.arange(len(borders)), n_links)
    n_groups = np.diff(np.concatenate([[0], np.cumsum(stops_a & stops_b)])[borders], prepend=0)

    def placed(values: np.ndarray) -> np.ndarray:
        full = np.zeros(rows, np.int64)
        full[keep] = values
        return full

    bits = tool.shift + tool.shift_b
    key, times = np.unique(doc << bits | first << tool.shift_b | second, return_counts=True)
    owner = np.flatnonzero(keep)[key >> bits] if len(key) else np.zeros(0, np.int64)
    digests = [""] * rows
    for row, digest in zip(np.flatnonzero(keep).tolist(), _digests(tool, a, b, stops_b[ends_a - 1], stops_a[ends_b - 1], count_a + count_b)):
        digests[row] = digest
    return Aligned(
        placed(count_a), placed(count_b), placed(n_groups), placed(n_links), digests,
        np.searchsorted(owner, np.arange(rows + 1)), key & ((1 << bits) - 1), times,
    )


def _earlier(flags: np.ndarray) -> np.ndarray:
    """How many flags are set before each place."""
    return np.cumsum(flags) - flags


def _digests(tool: Pair, a: np.ndarray, b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray, tokens: np.ndarray) -> Iterator[str]:
    """SHA-256 of each text's groups, written as ids of A, ids of B, and so on; the flags mark the last token of a group."""
    until_a, until_b = (np.append(0, np.flatnonzero(x) + 1) for x in (last_a, last_b))
    place_a = np.arange(len(a)) + until_b[_earlier(last_a)]
    place_b = np.arange(len(b)) + until_a[_earlier(last_b) + 1] if len(b) else np.zeros(0, np.int64)
    ids, mark = np.empty(len(a) + len(b), np.int64), np.full(len(a) + len(b), ord(","), np.uint8)
    ids[place_a], ids[place_b] = a, b
    mark[place_a[last_a]], mark[place_b[last_b]] = ord("|"), ord(";")
    grid, length = tool.digits[ids], tool.n_digits[ids]
    grid[np.arange(len(ids)), length] = mark
    flat = grid[np.arange(tool.width + 1) <= length[:, None]]
    ends = np.concatenate([[0], np.cumsum(length + 1)])[np.concatenate([[0], np.cumsum(tokens)])]
    for low, high in zip(ends[:-1].tolist(), ends[1:].tolist()):
        yield hashlib.sha256(flat[low : high - 1]).hexdigest()


def _align_texts(sent, kept_words: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = pair(*sent.value, kept_words)
        for batch in slices(batches, "text", SLICE_BYTES):
            found = align(tool, batch.column("text"))
            begins = found.begins.tolist()
            cells = [found.pair.astype("<u8"), found.times.astype("<u4")]
            pairs, times = ([x[low:high].tobytes() for low, high in zip(begins[:-1], begins[1:])] for x in cells)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"), batch.column("copies"), *[pa.array(getattr(found, m)) for m in MEASURES],
                    pa.array(found.digests), pa.array(pairs, pa.binary()), pa.array(times, pa.binary()),
                ],
                names=["key", "copies", *MEASURES, "groups_sha256", "pairs", "times"],
            )

    return run


def _added(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    pairs, weights = (np.concatenate([h[i] for h in held]) for i in (0, 1))
    found, place = np.unique(pairs, return_inverse=True)
    total = np.zeros(len(found), np.int64)
    np.add.at(total, place, weights)
    return found, total


def _count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs with the number of documents of this task that hold them, added up as far as memory is bounded."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    fresh = 0

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(held[0][0].astype(np.int64)), pa.array(held[0][1])], names=["pair", "docs"])

    for batch in slices(batches, "pairs", SLICE_BYTES):
        sizes = pc.binary_length(batch.column("pairs")).to_numpy() // 8
        flat = np.frombuffer(b"".join(batch.column("pairs").to_pylist()), "<u8")
        held.append((flat, np.repeat(batch.column("copies").to_numpy(), sizes)))
        fresh += len(flat)
        if fresh >= HELD_PAIRS:
            held, fresh = [_added(held)], 0
            if len(held[0][0]) >= HELD_PAIRS:
                yield out()
                held = []
    if held:
        held = [_added(held)]
        yield out()


def _frequent_sums(sent) -> Callable:
    """Of each text the best links and the counts over links, as far as its pairs are among those sent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, docs, best = sent.value
        for batch in slices(batches, "pairs", SLICE_BYTES):
            begins, pairs, times, place, has = _looked_up(batch, known)
            there = np.where(has, place, 0)
            sums = [np.concatenate([[0], np.cumsum(np.where(has, times * x[there], 0))]) for x in (best.astype(np.int64), docs)] if len(known) else [np.zeros(len(pairs) + 1, np.int64)] * 2
            n_best, count_sum = (s[begins[1:]] - s[begins[:-1]] for s in sums)
            kept = [batch.column(c) for c in ("key", "copies", *MEASURES, "groups_sha256")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(n_best), pa.array(count_sum)], names=["key", "copies", *MEASURES, "groups_sha256", "n_best", "count_sum"])

    return run


def _looked_up(batch: pa.RecordBatch, known: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    pairs = np.frombuffer(b"".join(batch.column("pairs").to_pylist()), "<u8").astype(np.int64)
    times = np.frombuffer(b"".join(batch.column("times").to_pylist()), "<u4").astype(np.int64)
    begins = np.concatenate([[0], np.cumsum(pc.binary_length(batch.column("pairs")).to_numpy() // 8)])
    place = np.searchsorted(known, pairs)
    has = place < len(known)
    has[has] = known[place[has]] == pairs[has]
    return begins, pairs, times, place, has


def _other_links(sent) -> Callable:
    """A row for each pair of a text that is not among those sent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value[0]
        for batch in slices(batches, "pairs", SLICE_BYTES):
            begins, pairs, times, _, has = _looked_up(batch, known)
            row = np.repeat(np.arange(batch.num_rows), np.diff(begins))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").take(pa.array(row[~has])), pa.array(pairs[~has]), pa.array(times[~has])], names=["key", "pair", "times"]
            )

    return run


def _pair_table(aligned: DataFrame, shift_b: int) -> DataFrame:
    """Every linked pair of ids: pair, docs (documents that hold it), best (most documents of its A id)."""
    counts = aligned.select("copies", "pairs").mapInArrow(_count_pairs, "pair long, docs long")
    counts = materialise(counts.groupBy("pair").agg(F.sum("docs").alias("docs")), "pairs")
    own = F.shiftright("pair", shift_b)
    # a row for each id of A
    most = counts.groupBy(own.alias("a")).agg(F.max("docs").alias("most"))
    ranked = counts.withColumn("a", own).join(F.broadcast(most), "a")
    return materialise(ranked.select("pair", "docs", (F.col("docs") == F.col("most")).alias("best")), "pair-counts")


def _texts(aligned: DataFrame, table: DataFrame, frequent: int) -> DataFrame:
    """Measures of each distinct text. The most frequent pairs are looked up in tasks; the others are joined, and as
    each of them is in no more documents than the rarest of the frequent ones, none is a hot key."""
    spark = aligned.sparkSession
    rest = table.count() > frequent
    chosen = (table.orderBy(F.desc("docs"), "pair").limit(frequent) if rest else table).toArrow().sort_by("pair")
    sent = spark.sparkContext.broadcast(tuple(chosen.column(c).to_numpy() for c in ("pair", "docs", "best")))
    kind = "key binary, copies long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
    texts = aligned.mapInArrow(_frequent_sums(sent), kind)
    if not rest:
        return materialise(texts, "texts")
    others = aligned.mapInArrow(_other_links(sent), "key binary, pair long, times long").join(table, "pair")
    added = others.groupBy("key").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("times") * F.col("docs")).alias("more_sum"))
    texts = texts.join(added, "key", "left").withColumns(
        {"n_best": F.col("n_best") + F.coalesce("more_best", F.lit(0)), "count_sum": F.col("count_sum") + F.coalesce("more_sum", F.lit(0))}
    )
    return materialise(texts.drop("more_best", "more_sum"), "texts")


def align_tokenizers(docs: DataFrame, tokenizer: str, model: str, frequent: int = FREQUENT, kept_words: int = KEPT_WORDS, least_hot: int = LEAST_HOT) -> DataFrame:
    """Alignment of two tokenizers for every document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    ``tokenizer`` (A) is a byte-level file of the tokenizers library and sees a space before the text, ``model`` (B) is
    one of sentencepiece and adds that space itself; strings of special tokens are plain text. Byte offsets where both
    end a token cut the tokens into groups, and tokens of A and B whose bytes overlap are linked. The count of a pair of
    ids is the number of documents that hold it linked; n_best counts links whose pair has the highest count
    of its A id (ties included), count_sum adds up the counts of all links.

    Texts are grouped whole, so each distinct one is encoded and aligned once, and its pairs count as often as it
    occurs; measures are joined back to documents by the SHA-256 of the text. Texts repeated very often (more than
    ``least_hot`` times, and more than one in 50,000 documents, so there are at most 50,000) are joined by broadcast.

    Null and empty texts, and texts that the tokens' bytes do not give back, have no tokens: zeros and an empty
    string. Repeated rows each get a row and count each; a null doc_id stays null. An empty table gives no rows.
    Other columns are ignored.
    """
    spark = docs.sparkSession
    with open(model, "rb") as file:
        sent = spark.sparkContext.broadcast((read_spec(tokenizer), file.read()))
    tool = pair(*sent.value, kept_words)
    digest = F.unhex(F.sha2("text", 256))
    named = materialise(docs.select("doc_id", F.when(F.col("text") != "", digest).alias("key")), "keys")
    distinct = docs.where("text <> ''").groupBy("text").agg(F.count("*").alias("copies")).select(digest.alias("key"), "text", "copies")
    path = fresh_path(spark, "aligned")
    distinct.mapInArrow(_align_texts(sent, kept_words), ALIGNED).write.option("compression", "zstd").parquet(path)
    aligned = spark.read.schema(ALIGNED).parquet(path)
    texts = _texts(aligned, _pair_table(aligned, tool.shift_b), frequent)
    hot_from = max(least_hot, named.count() // HOT_TEXTS)
    out = ["doc_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in (*MEASURES, "n_best", "count_sum")], F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256")]
    hot = F.broadcast(texts.where(F.col("copies") > hot_from))
    cold = named.join(hot.select("key"), "key", "left_anti").join(texts.where(F.col("copies") <= hot_from), "key", "left")
    return named.join(hot, "key").select(out).union(cold.select(out))
