"""Toxicity by a support vector machine over a gapped subsequence kernel, with Nystroem landmarks."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenura.llm.arrow import raw, slices
from tenura.llm.common import materialise

SLICE_BYTES = 1 << 20
#: The kernel: common subsequences of four letters, weighted by DECAY to the power of the bytes they span in each text.
DECAY = 0.7
SPAN = 7
CODES = 1 << 20  # subsequences are kept under a hash of this range
#: Longest stretch that is compared at once; longer ones are cut twice, so that every half of one lies whole in a piece.
LONGEST = 32
#: Labelled documents of each class that are looked at, and segments of each class that the machine is fitted to.
SAMPLE_DOCS = 2_000
CLEAN_TIMES = 3  # clean documents for each toxic one: a rare word is innocent only if it is met in one of them
SEGMENTS = 2_000
LANDMARKS = 256
ROUNDS = 3
PENALTY = 3.0
#: A segment weighs as much as its count, up to this number.
MOST = 100
#: A segment is to blame from this evidence on (log ratio of its shares in toxic and clean sentences, times its toxic
#: count) if the log ratio is strong; below the weak one it is innocent, for a language may be more often toxic.
EVIDENCE, STRONG, WEAK = 15.0, 2.0, 1.0
#: ... and from this share of the greatest evidence of any segment.
SHARE = 0.01
LEAST_SCORE = 0.3
WEIGHTS = np.array([0, 0, 0, 0, *(DECAY**n for n in range(4, SPAN + 1))], np.float32)
OFFSETS = [(i, j, k) for k in range(3, SPAN) for j in range(2, k) for i in range(1, j)]


def _classes() -> np.ndarray:
    """Class of each byte: letters without case, digits and signs that stand for letters, second bytes of others; 0 is no letter."""
    found = np.zeros(256, np.int32)
    for i in range(26):
        found[ord("a") + i] = found[ord("A") + i] = 1 + i
    # Signs written for letters.
    for sign, letter in zip("013457@$", "oieastas"):
        found[ord(sign)] = found[ord(letter)]
    # accented letters of both cases differ in one bit that is left out
    found[0x80:0xC0] = 27 + (np.arange(64) & 31)
    return found


CLASS = _classes()
BLANK = np.isin(np.arange(256), (0x20, *range(0x09, 0x0E)))


class Segments(NamedTuple):
    """Stretches of letters that are compared with landmarks."""

    letters: np.ndarray  # classes, without the bytes that are no letters
    place: np.ndarray  # where each stood, so that left-out bytes count as gaps
    segment: np.ndarray
    begins: np.ndarray  # first byte of each segment, and one past its last one
    ends: np.ndarray
    text: np.ndarray  # text of each segment


def segments(data: np.ndarray, offsets: np.ndarray) -> Segments:
    """Words, and runs of words of one letter as one segment; long ones are cut, at every 32nd letter and again half-way between."""
    blank = BLANK[data]
    word_starts = ~blank
    word_starts[1:] &= blank[:-1]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    word_starts[inner] = ~blank[inner]
    starts = np.flatnonzero(word_starts)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return Segments(none, none, none, none, none, none)
    text = np.searchsorted(offsets, starts, "right") - 1
    letter = CLASS[data] > 0
    counted = np.concatenate([[0], np.cumsum(letter)])
    single = counted[np.append(starts[1:], len(data))] - counted[starts] <= 1
    joined = np.zeros(len(starts), bool)
    joined[1:] = single[1:] & single[:-1] & (text[1:] == text[:-1])
    heads = starts[~joined]
    place = np.flatnonzero(letter)
    number = (np.cumsum(~joined) - 1)[np.cumsum(word_starts)[place] - 1]
    first = np.searchsorted(number, np.arange(len(heads) + 1))
    rank = np.arange(len(place)) - first[number]
    size = np.diff(first)
    owner = text[~joined]
    cut = [_cut(place, number, rank, size, owner, 0, 0)]
    long = size > LONGEST
    if long.any():
        some = long[number]
        cut.append(_cut(place[some], number[some], rank[some], size, owner, LONGEST // 2, cut[0][3]))
    place, number, owner = (np.concatenate([c[i] for c in cut]) for i in range(3))
    begins = np.searchsorted(number, np.arange(len(owner)))
    return Segments(CLASS[data[place]], place, number, place[begins], place[np.append(begins[1:], len(place)) - 1] + 1, owner)


def _cut(place: np.ndarray, number: np.ndarray, rank: np.ndarray, size: np.ndarray, owner: np.ndarray, shift: int, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    block = (rank + shift) // LONGEST
    new = np.ones(len(place), bool)
    new[1:] = (number[1:] != number[:-1]) | (block[1:] != block[:-1])
    ids = np.cumsum(new) - 1 + base
    return place, ids, owner[number[new]], int(new.sum()) + base


def subsequences(s: Segments) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each way to choose four letters, from each letter on: the bytes that they span (0: too many, or not of one
    segment) and the number of the subsequence. Bytes that are no letter count as gaps."""
    count = len(s.letters)
    code = s.letters.astype(np.uint32)
    for second, third, last in OFFSETS:
        size = count - last
        if size <= 0:
            continue
        span = (s.place[last:] - s.place[:size] + 1).astype(np.int32)
        span[(s.segment[last:] != s.segment[:size]) | (span > SPAN)] = 0
        number = (code[:size] << np.uint32(18)) | (code[second : second + size] << np.uint32(12)) | (code[third : third + size] << np.uint32(6)) | code[last:]
        yield span, (number * np.uint32(0x9E3779B1)) >> np.uint32(12)


class Model(NamedTuple):
    weights: np.ndarray  # of every subsequence: the machine's landmarks added up
    bias: float
    slope: float
    shift: float

    def probability(self, decision: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * decision + self.shift, -40, 40)))


def decisions(weights: np.ndarray, bias: float, s: Segments) -> np.ndarray:
    """Decision of the machine for each segment."""
    total = np.zeros(len(s.letters), np.float32)
    square = np.zeros(len(s.letters), np.float32)
    for span, number in subsequences(s):
        worth = WEIGHTS[span]
        total[: len(span)] += worth * weights[number]
        square[: len(span)] += worth * worth
    if not len(s.text):
        return np.zeros(0)
    begins = np.flatnonzero(np.diff(s.segment, prepend=-1))
    length = np.sqrt(np.add.reduceat(square, begins))
    return np.add.reduceat(total, begins) / np.where(length > 0, length, 1) + bias


def document_decisions(weights: np.ndarray, bias: float, column: pa.Array, rows: int) -> np.ndarray:
    """The highest decision of any segment of each text; that of an empty segment where there is none."""
    s = segments(*raw(column))
    best = np.full(rows, bias)
    np.maximum.at(best, s.text, decisions(weights, bias, s))
    return best


def canonical(s: Segments) -> list[bytes]:
    """What the kernel sees of each segment: classes of letters, and zeros for gaps as far as they matter."""
    begins = np.flatnonzero(np.diff(s.segment, prepend=-1))
    gap = np.minimum(np.diff(s.place, prepend=0), SPAN)
    gap[begins] = 1
    ends = np.cumsum(gap)
    flat = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    flat[ends - 1] = s.letters
    stops = np.append(begins[1:], len(gap)) - 1
    data = flat.tobytes()
    return [data[low:high] for low, high in zip((ends[begins] - 1).tolist(), ends[stops].tolist())]


def restored(names: list[bytes]) -> Segments:
    """Segments from their canonical form."""
    data = np.frombuffer(b"".join(names), np.uint8)
    offsets = np.cumsum([0] + [len(n) for n in names])
    place = np.flatnonzero(data)
    number = np.searchsorted(offsets, place, "right") - 1
    begins, ends = offsets[:-1], offsets[1:]
    return Segments(data[place].astype(np.int32), place, number, begins, ends, np.arange(len(names)))


class Space(NamedTuple):
    """Training segments as weighted subsequences."""

    segment: np.ndarray
    number: np.ndarray
    worth: np.ndarray  # divided by the segment's length, so that equal segments have a kernel of about 1
    count: int

    def kernel(self, landmark: int) -> np.ndarray:
        """Kernel of every segment with this one."""
        own = self.segment == landmark
        table = np.bincount(self.number[own], self.worth[own], CODES)
        return np.bincount(self.segment, self.worth * table[self.number], self.count)


def space(names: list[bytes]) -> Space:
    s = restored(names)
    parts = []
    for span, number in subsequences(s):
        has = span > 0
        parts.append((s.segment[: len(span)][has], number[has], WEIGHTS[span[has]].astype(float)))
    segment, number, worth = (np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.int64) for i in range(3))
    square = np.bincount(segment, worth * worth, len(names))
    return Space(segment, number, worth / np.sqrt(square[segment]), len(names))


def landmarks(x: Space, weight: np.ndarray, most: int = LANDMARKS) -> tuple[np.ndarray, np.ndarray]:
    """Nystroem features of all segments and the segments chosen as landmarks, each time the weightiest one that is explained badly.

    Features are the columns of a pivoted Cholesky factor, which is what the kernel with the landmarks and the inverse
    root of the kernel among them give.
    """
    cell, place = np.unique(x.segment * CODES + x.number, return_inverse=True)
    rest = np.bincount(cell // CODES, np.bincount(place, x.worth, len(cell)) ** 2, x.count)
    weight = weight / np.maximum(rest, 1e-9)  # repeated subsequences make a segment no more important
    features, chosen = np.zeros((x.count, most)), []
    for i in range(min(most, x.count)):
        best = int(np.argmax(np.where(rest > 1e-3, rest * weight, 0)))
        if rest[best] <= 1e-3:
            break
        chosen.append(best)
        features[:, i] = (x.kernel(best) - features[:, :i] @ features[best, :i]) / np.sqrt(rest[best])
        rest = np.maximum(rest - features[:, i] ** 2, 0)
        rest[best] = 0
    return features[:, : len(chosen)], np.array(chosen, np.int64)


def separate(features: np.ndarray, target: np.ndarray, weight: np.ndarray, penalty: float = PENALTY) -> tuple[np.ndarray, float]:
    """Linear support vector machine with squared hinge loss (targets -1 and 1), by Newton steps."""
    x = np.column_stack([features, np.ones(len(features))])
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 1e-6
    v = np.zeros(x.shape[1])

    def loss(v: np.ndarray) -> float:
        slack = np.maximum(0, 1 - target * (x @ v))
        return 0.5 * v @ ridge @ v + penalty * (weight * slack**2).sum()

    for _ in range(50):
        active = target * (x @ v) < 1
        held = x[active] * weight[active, None]
        step = np.linalg.solve(ridge + 2 * penalty * held.T @ x[active], ridge @ v + 2 * penalty * held.T @ (x[active] @ v - target[active]))
        rate, before = 1.0, loss(v)
        while rate > 1e-4 and loss(v - rate * step) > before:
            rate /= 2
        v = v - rate * step
        if before - loss(v) <= 1e-8 * before:
            break
    return v[:-1], float(v[-1])


def machine(names: list[bytes], target: np.ndarray, weight: np.ndarray, most: int = LANDMARKS) -> tuple[np.ndarray, float]:
    """Weights of all subsequences and the bias of a machine fitted to these segments.

    The decision is a sum over landmarks of a coefficient times the kernel with it, and the kernel is an inner product over
    subsequences; so those of the landmarks are added up once, and a segment costs the same however many landmarks there are.
    """
    x = space(names)
    features, chosen = landmarks(x, weight, most)
    if not len(chosen):
        return np.zeros(CODES, np.float32), -1.0
    v, bias = separate(features, target, weight)
    coefficient = np.linalg.solve(features[chosen].T, v)
    alpha = np.zeros(x.count)
    alpha[chosen] = coefficient
    return np.bincount(x.number, x.worth * alpha[x.segment], CODES).astype(np.float32), bias


def calibrate(decision: np.ndarray, target: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve through decisions and classes (0, 1), with targets drawn in a little."""
    high = (weight[target == 1].sum() + 1) / (weight[target == 1].sum() + 2)
    low = 1 / (weight[target == 0].sum() + 2)
    want = np.where(target == 1, high, low)
    x = np.column_stack([decision, np.ones(len(decision))])
    v = np.array([1.0, 0.0])

    def loss(v: np.ndarray) -> float:
        z = x @ v
        return (weight * (np.logaddexp(0, z) - want * z)).sum() + 1e-3 * v[0] ** 2

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ v, -40, 40)))
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag([2e-3, 1e-9])
        step = np.linalg.solve(curve, x.T @ (weight * (p - want)) + np.array([2e-3 * v[0], 0]))
        rate, before = 1.0, loss(v)
        while rate > 1e-6 and loss(v - rate * step) > before:
            rate /= 2
        v = v - rate * step
        if before - loss(v) <= 1e-9 * before:
            break
    return float(max(v[0], 0.0)), float(v[1])


def held_out(column: str = "doc_id") -> Column:
    """Documents whose labels are never learnt from."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % 4 == 2


TABLE = "segment binary, toxic long, clean long"


def labelled_sentences(sample: DataFrame) -> DataFrame:
    """Distinct sentences; one that also stands in a clean document is clean."""
    parts = F.explode(F.split("text", r"[.!?]+(?=\s|\z)|\n"))
    return sample.select(parts.alias("text"), "toxic").groupBy("text").agg(F.min("toxic").alias("toxic"))


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments of labelled sentences, each beside the one before it."""
    for batch in slices(batches, "text", SLICE_BYTES):
        s = segments(*raw(batch.column("text")))
        if not len(s.text):
            continue
        toxic = batch.column("toxic").to_numpy(zero_copy_only=False).astype(bool)
        coded = pa.array(canonical(s), pa.binary()).dictionary_encode()
        code, count = coded.indices.to_numpy().astype(np.int64), len(coded.dictionary)
        before = np.full(len(code), count)
        before[1:] = np.where(s.text[1:] == s.text[:-1], code[:-1], count)
        cell = np.unique((code * (count + 1) + before) * 2 + toxic[s.text])
        names = pa.concat_arrays([coded.dictionary, pa.array([b""], pa.binary())])
        yield pa.RecordBatch.from_arrays(
            [names.take(pa.array(cell // 2 // (count + 1))), names.take(pa.array(cell // 2 % (count + 1))), pa.array(cell % 2 == 1)], names=["segment", "before", "toxic"]
        )


def segment_counts(sentences: DataFrame) -> DataFrame:
    """For each segment the number of different segments before it in toxic and in clean sentences.

    Copies and near copies of a document repeat a word with its neighbour, so they add nothing; an insult has many neighbours.
    """
    pairs = sentences.mapInArrow(_neighbours, "segment binary, before binary, toxic boolean").groupBy("segment", "before").agg(F.min("toxic").alias("toxic"))
    return pairs.groupBy("segment").agg(F.sum(F.col("toxic").cast("long")).alias("toxic"), F.sum((~F.col("toxic")).cast("long")).alias("clean"))


def _segment_decisions(sent) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = decisions(*sent.value, restored(batch.column("segment").to_pylist()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found.astype(float))], names=[*batch.schema.names, "decision"])

    return run


def _document_decisions(sent) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE_BYTES):
            found = document_decisions(*sent.value, batch.column("text"), batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(found)], names=["toxic", "decision"])

    return run


def sampled(docs: DataFrame, labels: DataFrame, each: int) -> tuple[DataFrame, dict[bool, int]]:
    """Text and class of about ``each`` toxic and three times as many clean documents, drawn by the hash of doc_id, and the
    size of both classes.

    Of labels that contradict each other toxic holds; null labels and held-out documents take no part.
    """
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()).groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic"))
    sizes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    draw = F.shiftrightunsigned(F.xxhash64("doc_id"), 11).cast("double") / F.lit(float(1 << 53))
    rate = F.when(F.col("toxic"), each / max(sizes.get(True, 0), 1)).otherwise(CLEAN_TIMES * each / max(sizes.get(False, 0), 1))
    chosen = known.where(draw < rate).select(F.col("doc_id").alias("id"), "toxic")
    # about four times ``each`` ids
    return docs.join(F.broadcast(chosen), F.col("doc_id") == F.col("id")).select("text", "toxic"), sizes


def learn(docs: DataFrame, labels: DataFrame, each: int = SAMPLE_DOCS, size: int = SEGMENTS, rounds: int = ROUNDS) -> Model:
    """Fit the machine to segments of labelled sentences, and a probability to the decisions of the sampled documents.

    A document's label is given to its sentences, but in a toxic sentence only some segments are to blame. At first
    these are the ones found behind far more neighbours in toxic than in clean sentences; then, in ``rounds`` rounds, also those
    of weaker evidence that the machine finds toxic, while clean segments that it takes for toxic are added to the others.
    """
    spark = docs.sparkSession
    sample, sizes = sampled(docs, labels, each)
    sample = materialise(sample, "labelled")
    if not sizes.get(True) or not sizes.get(False):
        share = 1.0 if sizes.get(True) else 0.0
        return Model(np.zeros(CODES, np.float32), -1.0, 0.0, 40.0 if share else -40.0)
    counts = segment_counts(labelled_sentences(sample))
    counts = materialise(counts, "segments")
    total = counts.agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).first()
    ratio = F.log((F.col("toxic") + 0.5) / F.lit((total["toxic"] or 0) + 1.0)) - F.log((F.col("clean") + 0.5) / F.lit((total["clean"] or 0) + 1.0))
    counts = counts.withColumn("ratio", ratio).withColumn("evidence", F.col("toxic") * F.col("ratio"))

    def top(df: DataFrame, order: list[Column], n: int, count: str = "clean") -> dict[bytes, int]:
        """Segments and how often they were counted."""
        rows = df.orderBy(*order, "segment").limit(n).select("segment", F.col(count).alias("n")).collect()
        return {bytes(r["segment"]): r["n"] for r in rows}

    least = max(EVIDENCE, SHARE * (counts.agg(F.max("evidence")).first()[0] or 0))
    strong = (F.col("evidence") >= least) & (F.col("ratio") >= STRONG)
    innocent = (F.col("clean") > 0) & (F.col("ratio") < WEAK)
    toxic = top(counts.where(strong), [F.desc("evidence")], size, "toxic")
    clean = top(counts.where(innocent), [F.desc("clean")], size // 2) | top(counts.where(innocent), [F.xxhash64("segment")], size // 2)
    weights, bias = np.zeros(CODES, np.float32), -1.0
    for left in range(rounds, -1, -1):
        names = [*toxic, *(n for n in clean if n not in toxic)]
        target = np.where(np.arange(len(names)) < len(toxic), 1.0, -1.0)
        if not toxic or len(names) == len(toxic):
            break
        share = np.minimum([toxic[n] if n in toxic else clean[n] for n in names], MOST).astype(float)
        share *= len(names) / 2 / np.bincount((target > 0).astype(int), share, 2)[(target > 0).astype(int)]
        weights, bias = machine(names, target, share)
        if left:
            sent = spark.sparkContext.broadcast((weights, bias))
            judged = counts.mapInArrow(_segment_decisions(sent), TABLE + ", ratio double, evidence double, decision double")
            judged = materialise(judged, "judged")
            toxic = top(judged.where(strong | ((F.col("ratio") >= WEAK) & (F.col("toxic") > 1) & (F.col("decision") >= 1))), [F.desc("evidence")], size, "toxic")
            clean |= top(judged.where(innocent), [F.desc("decision")], size // 2)
    sent = spark.sparkContext.broadcast((weights, bias))
    found = sample.mapInArrow(_document_decisions(sent), "toxic boolean, decision double").toArrow()
    is_toxic = found.column("toxic").to_numpy().astype(bool)
    if is_toxic.all() or not is_toxic.any():
        return Model(weights, bias, 1.0, 0.0)
    # the classes as often as they are among all labels
    weight = np.where(is_toxic, sizes[True] / is_toxic.sum(), sizes[False] / (~is_toxic).sum())
    weight *= len(weight) / weight.sum()
    return Model(weights, bias, *calibrate(found.column("decision").to_numpy(), is_toxic.astype(int), weight))


def _score(sent, least: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in slices(batches, "text", SLICE_BYTES):
            data, offsets = raw(batch.column("text"))
            s = segments(data, offsets)
            found = decisions(model.weights, model.bias, s)
            best = np.full(batch.num_rows, model.bias)
            np.maximum.at(best, s.text, found)
            score = model.probability(best)
            worst = np.full(batch.num_rows, -1)
            at = np.flatnonzero(found == best[s.text])[::-1] if len(found) else np.zeros(0, np.int64)
            worst[s.text[at]] = at  # the first of equal ones
            low, high = (np.append(x, 0)[worst] for x in (s.begins, s.ends))
            shown = [data[a:b].tobytes().decode(errors="replace") if w >= 0 and p >= least else None for a, b, w, p in zip(low, high, worst, score)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(score), pa.array((score >= least).astype(np.int32)), pa.array(shown, pa.string())],
                names=["doc_id", "held_out", "score", "predicted", "segment"],
            )

    return run


def score_toxicity(docs: DataFrame, labels: DataFrame, least: float = LEAST_SCORE, **settings: int) -> DataFrame:
    """Toxicity of every whole text: doc_id, held_out, score, predicted (score of at least ``least``), segment.

    Texts fall into sentences, and these into segments: words, and runs of single letters. The kernel of two
    segments adds up the subsequences of four letters that they share, each weighted down by the letters it spans, so
    letters that are left out, inserted or parted change it little. A support vector machine on Nystroem features judges segments;
    a sentence is as toxic as its worst segment and a document as its worst sentence, which
    ``segment`` shows where the document is predicted toxic. Learning sees texts and ``labels`` of documents that are
    not held out, and of these a bounded sample (see `learn`); scoring reads all texts whole.

    A null or empty text has the score of an empty segment. Repeated rows each get a row; a null doc_id is never
    learnt from. Without labels of both classes every score is that of the only one, 0 without any. An empty table gives
    no rows. Other columns are ignored.
    """
    source = docs.select("doc_id", held_out().alias("held_out"), "text")
    sent = docs.sparkSession.sparkContext.broadcast(learn(docs.select("doc_id", "text"), labels.select("doc_id", "toxic"), **settings))
    kind = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, held_out boolean, score double, predicted int, segment string"
    return source.mapInArrow(_score(sent, least), kind)
