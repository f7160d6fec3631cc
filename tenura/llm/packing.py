"""Hierarchical multi-length packing of documents into training sequences."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tenura.llm.arrow import slices
from tenura.llm.tokens import KEPT_WORDS, SLICE_BYTES, encoder, read_spec

TIERS = (128, 256, 512, 1024)
END_ID = 0
STEP_TOKENS = 1 << 16
PIECES = (
    "start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, tier int, step long"
)


class Piece:
    __slots__ = ("doc", "start", "ids", "doc_tokens")

    def __init__(self, doc, start: int, ids: np.ndarray, doc_tokens: int):
        self.doc, self.start, self.ids, self.doc_tokens = doc, start, ids, doc_tokens

    def cut(self, size: int) -> tuple[Piece, Piece]:
        rest = Piece(self.doc, self.start + size, self.ids[size:].copy(), self.doc_tokens)
        return Piece(self.doc, self.start, self.ids[:size], self.doc_tokens), rest


class Pool:
    """Pieces shorter than the longest window, by length; the longest that fits is found by one bit test."""

    def __init__(self, longest: int):
        self.shelves: list[list[Piece]] = [[] for _ in range(longest)]
        self.filled = 0

    def add(self, piece: Piece) -> None:
        self.shelves[len(piece.ids)].append(piece)
        self.filled |= 1 << len(piece.ids)

    def take(self, most: int) -> Piece | None:
        """The longest piece of at most ``most`` tokens."""
        size = (self.filled & ((1 << (most + 1)) - 1)).bit_length() - 1
        return self._pop(size) if size > 0 else None

    def shortest(self) -> Piece | None:
        return self._pop((self.filled & -self.filled).bit_length() - 1) if self.filled else None

    def _pop(self, size: int) -> Piece:
        piece = self.shelves[size].pop()
        if not self.shelves[size]:
            self.filled &= ~(1 << size)
        return piece


def pack_round(pool: Pool, tiers: tuple[int, ...]) -> tuple[list[tuple[int, list[Piece]]], list[Piece]]:
    """Full windows, longest tier first, and the pieces for which the pool was too small to fill one.

    A piece opens a window of the smallest tier that holds it. The gap takes the longest shorter pieces
    that fit whole and then the beginning of the shortest piece left, whose rest goes back to the pool.
    """
    windows, left = [], []
    while (piece := pool.take(tiers[-1] - 1)) is not None:
        tier = next(t for t in tiers if t >= len(piece.ids))
        held, gap = [piece], tier - len(piece.ids)
        while gap:
            other = pool.take(gap)
            if other is None:
                other = pool.shortest()
                if other is None:
                    break
                other, rest = other.cut(gap)
                pool.add(rest)
            held.append(other)
            gap -= len(other.ids)
        if gap:
            left = held
        else:
            windows.append((tier, held))
    return windows, left


def tail_windows(pieces: list[Piece], longest: int) -> list[tuple[int, list[Piece]]]:
    """The last pieces of a task in windows whose lengths are powers of two, so that none has padding."""
    windows, queue, total = [], pieces[::-1], sum(len(p.ids) for p in pieces)
    while total:
        size = min(longest, 1 << (total.bit_length() - 1))
        held, gap = [], size
        while gap:
            piece = queue.pop()
            if len(piece.ids) > gap:
                piece, rest = piece.cut(gap)
                queue.append(rest)
            held.append(piece)
            gap -= len(piece.ids)
        windows.append((size, held))
        total -= size
    return windows


def _deal(windows: list[tuple[int, list[Piece]]], step_tokens: int) -> list[int]:
    """A step for each window: every tier is dealt round over the steps, so each has the same mix."""
    steps = max(1, round(sum(size for size, _ in windows) / step_tokens))
    order = sorted(range(len(windows)), key=lambda i: -windows[i][0])
    dealt = [0] * len(windows)
    for turn, i in enumerate(order):
        dealt[i] = turn % steps
    return dealt


def _pack(sent, tiers: tuple[int, ...], end_id: int, step_tokens: int, kept_words: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, longest, pool = encoder(sent.value, kept_words), tiers[-1], Pool(tiers[-1])
        limit = min(SLICE_BYTES, 10 * kept_words)
        kind = None
        made = steps = TaskContext.get().partitionId() << 36

        def batch_of(windows: list[tuple[int, list[Piece]]]) -> pa.RecordBatch:
            nonlocal made, steps
            dealt = _deal(windows, step_tokens)
            rows = [
                (p.doc, p.start, len(p.ids), p.ids.tobytes(), p.doc_tokens, made + i, offset, size, steps + dealt[i])
                for i, (size, held) in enumerate(windows)
                for p, offset in zip(held, np.cumsum([0] + [len(p.ids) for p in held[:-1]]).tolist())
            ]
            made += len(windows)
            steps += max(dealt, default=-1) + 1
            kinds = [kind, pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * 3, pa.int32(), pa.int64()]
            columns = [list(c) for c in zip(*rows)] or [[]] * len(kinds)
            names = ["doc_id", *[x.split()[0] for x in PIECES.split(", ")]]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        for batch in slices(batches, "text", limit):
            kind = batch.schema.field("doc_id").type
            flat, counts = tool.encode(batch.column("text"))
            windows, ends = [], np.cumsum(counts)
            for doc, end, count in zip(batch.column("doc_id").to_pylist(), ends.tolist(), counts.tolist()):
                ids = np.append(flat[end - count : end], np.uint32(end_id)).astype("<u4")
                full = len(ids) - len(ids) % longest
                windows += [(longest, [Piece(doc, at, ids[at : at + longest], len(ids))]) for at in range(0, full, longest)]
                if full < len(ids):
                    pool.add(Piece(doc, full, ids[full:].copy(), len(ids)))
            packed, left = pack_round(pool, tiers)
            for piece in left:
                pool.add(piece)
            yield batch_of(windows + packed)
        if kind is not None:
            left = [p for shelf in pool.shelves for p in shelf]
            yield batch_of(tail_windows(left, longest))

    return run


def pack(
    docs: DataFrame, tokenizer: str, tiers: tuple[int, ...] = TIERS, end_id: int = END_ID, step_tokens: int = STEP_TOKENS,
    kept_words: int = KEPT_WORDS,
) -> DataFrame:
    """Documents cut into pieces and packed in sequences of the tiers' lengths (powers of two).

    One row per piece: doc_id, start (ids of the document before it), length, ids (little-endian unsigned
    32-bit numbers), doc_tokens, sequence_id, offset, tier (length of the sequence) and step (group of
    sequences that are trained together). Every id of a document, its end id included, lies in exactly
    one piece. Whole windows of the longest tier are cut off long documents; what remains of each
    document goes to the tier of its length, and gaps are filled from shorter tiers. Each task packs what
    it reads, with pieces left over carried to its next batch and the last cut at powers of two; so
    nothing is shuffled and no sequence has padding.

    A null or empty text is its end id alone. Repeated rows are packed each; a null doc_id stays null.
    An empty table gives no rows. Other columns are ignored. ``tokenizer`` is the path of a file of the
    tokenizers library, read on the driver. ``kept_words`` bounds the words whose ids a process keeps, and so
    its memory; results do not depend on it.
    """
    if any(t & (t - 1) for t in tiers) or sorted(tiers) != list(tiers):
        raise ValueError("tiers must be ascending powers of two")
    sent = docs.sparkSession.sparkContext.broadcast(read_spec(tokenizer))
    kind = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {PIECES}"
    return docs.select("doc_id", "text").mapInArrow(_pack(sent, tiers, end_id, step_tokens, kept_words), kind)
