"""Text quality from overlapping heuristics: their accuracies by expectation-maximisation, then a linear scorer."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.llm import bytewords
from tenura.llm.arrow import raw, slices

ABSTAIN, BAD, GOOD = 0, 1, 2
BUCKETS = 1 << 14
SHAPES = 1 << 9
SAMPLE = 6_000  # documents that the scorer is fitted to
WRONG = 0.015
FEW = 20  # words from which the share of short ones says something
ROUNDS = 60
EPOCHS = 12
RATE = 0.5
WORD = bytewords.word_table([(0x20, 0x20), (0x09, 0x0D)])

_BYTE = np.arange(256)
UPPER = (_BYTE >= ord("A")) & (_BYTE <= ord("Z"))
LOWER = ((_BYTE >= ord("a")) & (_BYTE <= ord("z"))) | (_BYTE >= 0x80)
DIGIT = (_BYTE >= ord("0")) & (_BYTE <= ord("9"))
STOP = np.isin(_BYTE, np.frombuffer(b".!?", np.uint8))
PLAIN = STOP | np.isin(_BYTE, np.frombuffer(b",;:'\"()-", np.uint8))
SYMBOL = WORD & ~(UPPER | LOWER | DIGIT | PLAIN)

#: Name, statistic, and the range in which a heuristic finds a text bad and good; it abstains elsewhere.
LABELLERS = (
    ("repeats", "repeats", (0.15, np.inf), (-np.inf, 0.03)),
    ("pairs", "pairs", (-np.inf, 0.5), (0.8, np.inf)),
    ("symbols", "symbols", (0.015, np.inf), (-np.inf, 0.003)),
    ("capitals", "capitals", (0.4, np.inf), (-np.inf, 0.15)),
    ("short words", "short", (-np.inf, 0.12), (0.22, np.inf)),
    ("sentences", "stops", (-np.inf, 0.005), (0.015, 0.7)),
    ("length", "words", (-np.inf, 0), (20, np.inf)),
    ("digits", "digits", (0.15, np.inf), (-np.inf, 0.02)),
)


class Shard(NamedTuple):
    words: bytewords.Words
    doc: np.ndarray  # document of each word
    shape: np.ndarray  # what each word looks like, as a small number
    statistics: dict[str, np.ndarray]


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def describe(column: pa.Array) -> Shard:
    """Words of a batch of texts and the statistics that the heuristics look at."""
    data, offsets = raw(column)
    words = bytewords.split(data, offsets, WORD)
    count = len(offsets) - 1
    doc = np.repeat(np.arange(count), np.diff(words.first))
    size = words.ends - words.starts

    def per_doc(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags)])
        return sums[words.first[1:]] - sums[words.first[:-1]]

    def per_word(table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sums = np.concatenate([[0], np.cumsum(table[data], dtype=np.int32)])
        return sums[words.ends] - sums[words.starts], sums[offsets[1:]] - sums[offsets[:-1]]

    upper, all_upper = per_word(UPPER)
    symbols, all_symbols = per_word(SYMBOL)
    digits, all_digits = per_word(DIGIT)
    _, all_lower = per_word(LOWER)
    same = np.zeros(len(doc), bool)
    same[1:] = (words.hashes[1:] == words.hashes[:-1]) & (doc[1:] == doc[:-1])
    stop = STOP[data[words.ends - 1]] if len(doc) else np.zeros(0, bool)
    n = np.diff(words.first)
    pair = words.hashes.copy()
    pair[1:] ^= bytewords.mix(words.hashes[:-1])
    distinct = np.zeros(count)
    for d in np.flatnonzero(n > 1):
        part = pair[words.first[d] + 1 : words.first[d + 1]]
        distinct[d] = len(np.unique(part)) / len(part)
    distinct[n <= 1] = 1
    length = np.diff(offsets)
    statistics = {
        "repeats": _share(per_doc(same), n), "pairs": distinct, "symbols": _share(all_symbols, length),
        "capitals": _share(all_upper, all_upper + all_lower), "short": np.where(n < FEW, np.nan, _share(per_doc((size <= 3) & (symbols == 0)), n)), "stops": _share(per_doc(stop), n),
        "words": n.astype(float), "digits": _share(all_digits, length),
    }
    big = np.minimum(np.log2(np.maximum(size, 1)).astype(np.int64), 7)
    shape = big | (upper > 1) << 3 | (upper == 1) << 4 | (symbols > 0) << 5 | (digits > 0) << 6 | same << 7 | stop << 8
    return Shard(words, doc, shape, statistics)


def votes(shard: Shard) -> np.ndarray:
    """A vote of every heuristic (column) for every document (row)."""
    columns = []
    for _, name, bad, good in LABELLERS:
        value = shard.statistics[name]
        vote = np.full(len(value), ABSTAIN)
        vote[(value >= good[0]) & (value <= good[1])] = GOOD
        vote[(value >= bad[0]) & (value <= bad[1])] = BAD
        columns.append(vote)
    return np.array(columns).T.reshape(-1, len(LABELLERS))


def pattern(vote: np.ndarray) -> np.ndarray:
    return vote @ 3 ** np.arange(len(LABELLERS))


def unpack(patterns: np.ndarray) -> np.ndarray:
    return patterns[:, None] // 3 ** np.arange(len(LABELLERS)) % 3


class Labels(NamedTuple):
    prior: float  # share of good documents
    chances: np.ndarray  # (heuristic, class, vote) among those that vote; 1 for abstaining, which says nothing

    def posterior(self, vote: np.ndarray) -> np.ndarray:
        """Probability that a document with these votes is good."""
        logs = np.log(self.chances)[np.arange(len(LABELLERS)), :, vote].sum(axis=1)
        logs += np.log([1 - self.prior, self.prior])
        return 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -50, 50)))


def estimate(vote: np.ndarray, count: np.ndarray, rounds: int = ROUNDS) -> Labels:
    """Expectation-maximisation over vote patterns and how many documents have each.

    Heuristics are taken as independent given the class, and abstaining as no evidence. Counts start with one document for each vote,
    and with four for votes that agree with the class, so classes keep their meaning.
    """
    weights = count.astype(float)
    chances = np.zeros((len(LABELLERS), 2, 3))
    chances[:, 0], chances[:, 1] = (1, 0.7, 0.3), (1, 0.1, 0.9)
    labels = Labels(0.7, chances)
    start = np.ones((len(LABELLERS), 2, 3))
    start[:, 0, BAD] = start[:, 1, GOOD] = 4
    for _ in range(rounds):
        good = labels.posterior(vote)
        each = np.stack([1 - good, good]) * weights
        chances = start.copy()
        for value in (BAD, GOOD):
            chances[:, :, value] += (vote == value).T @ each.T
        chances[:, :, 1:] /= chances[:, :, 1:].sum(axis=2, keepdims=True)
        over = np.maximum(chances[:, 1, BAD] - WRONG, 0)
        chances[:, 1, BAD] -= over
        chances[:, 1, GOOD] += over
        prior = float(np.clip((each[1].sum() + 1) / (weights.sum() + 2), 0.01, 0.99))
        labels = Labels(prior, chances)
    return labels


def features(shard: Shard) -> tuple[np.ndarray, np.ndarray]:
    """Feature of every word twice over: its hash bucket and, behind these, its shape; and the document."""
    bucket = (shard.words.hashes >> np.uint64(50)).astype(np.int64)
    return np.concatenate([bucket, BUCKETS + shard.shape]), np.concatenate([shard.doc, shard.doc])


def _inputs(shard: Shard, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Non-zero features by document: begin of each document, features, and their share of its words."""
    feature, doc = features(shard)
    width = BUCKETS + SHAPES
    cell, count = np.unique(doc * width + feature, return_counts=True)
    doc, feature = cell // width, cell % width
    total = np.bincount(shard.doc, minlength=rows)
    return np.searchsorted(doc, np.arange(rows + 1)), feature, np.sqrt(count / total[doc])


class Scorer(NamedTuple):
    weights: np.ndarray
    bias: float


def fit(inputs: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray, epochs: int = EPOCHS, seed: int = 8) -> Scorer:
    """Logistic regression on soft labels by stochastic gradients with a rate for each weight."""
    weights, square, bias, bias_square = np.zeros(BUCKETS + SHAPES), np.full(BUCKETS + SHAPES, 1e-3), 0.0, 1e-3
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for row in rng.permutation(len(inputs)):
            feature, value = inputs[row]
            error = 1 / (1 + np.exp(-np.clip(weights[feature] @ value + bias, -30, 30))) - target[row]
            step = error * value + 1e-5 * weights[feature]
            square[feature] += step * step
            weights[feature] -= RATE * step / np.sqrt(square[feature])
            bias_square += error * error
            bias -= RATE * error / np.sqrt(bias_square)
    return Scorer(weights, bias)


def _patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: dict[int, int] = {}
    for batch in slices(batches, "text"):
        each, count = np.unique(pattern(votes(describe(batch.column("text")))), return_counts=True)
        for k, n in zip(each.tolist(), count.tolist()):
            seen[k] = seen.get(k, 0) + n
    yield pa.RecordBatch.from_pydict({"pattern": pa.array(list(seen), pa.int64()), "n": pa.array(list(seen.values()), pa.int64())})


def _sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        shard = describe(batch.column("text"))
        begin, feature, value = _inputs(shard, batch.num_rows)
        places = pa.array(begin, pa.int32())
        yield pa.RecordBatch.from_pydict(
            {
                "pattern": pa.array(pattern(votes(shard)), pa.int64()),
                "feature": pa.ListArray.from_arrays(places, pa.array(feature, pa.int32())),
                "value": pa.ListArray.from_arrays(places, pa.array(value, pa.float32())),
            }
        )


class Model(NamedTuple):
    labels: Labels
    scorer: Scorer


def learn(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """Estimate the heuristics over all documents and fit the scorer to those with the smallest hashes
    of doc_id, at most ``sample`` of them."""
    counts = docs.select("text").mapInArrow(_patterns, "pattern long, n long").groupBy("pattern").agg(F.sum("n").alias("n"))
    known = counts.orderBy("pattern").toArrow()  # at most 3 to the power of the heuristics
    labels = estimate(unpack(known.column("pattern").to_numpy()), known.column("n").to_numpy())
    draw = F.xxhash64("doc_id")
    edge = docs.select(draw.alias("draw")).orderBy("draw").limit(sample).agg(F.max("draw")).first()[0]
    if edge is None:
        return Model(labels, Scorer(np.zeros(BUCKETS + SHAPES), 0.0))
    # Texts are read where they lie; only their features, at most one for each bucket and shape, meet.
    chosen = docs.where(draw <= edge).select("text")
    rows = chosen.mapInArrow(_sample, "pattern long, feature array<int>, value array<float>").limit(sample).toArrow()
    rows = rows.take(pa.array(np.lexsort((np.array([len(x) for x in rows.column("feature")]), rows.column("pattern").to_numpy()))))
    pairs = list(zip(rows.column("feature").to_numpy(), rows.column("value").to_numpy()))
    return Model(labels, fit(pairs, labels.posterior(unpack(rows.column("pattern").to_numpy()))))


def scores(model: Model, shard: Shard, rows: int) -> np.ndarray:
    begin, feature, value = _inputs(shard, rows)
    sums = np.concatenate([[0], np.cumsum(model.scorer.weights[feature] * value)])
    return 1 / (1 + np.exp(-np.clip(sums[begin[1:]] - sums[begin[:-1]] + model.scorer.bias, -30, 30)))


def _score(sent, least: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in slices(batches, "text"):
            shard = describe(batch.column("text"))
            vote = votes(shard)
            score = scores(model, shard, batch.num_rows)
            score[shard.statistics["words"] == 0] = 0
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(["".join("-01"[v] for v in row) for row in vote.tolist()]),
                    pa.array(model.labels.posterior(vote)), pa.array(score), pa.array(score >= least),
                ],
                names=["doc_id", "votes", "label", "score", "keep"],
            )

    return run


def score_quality(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """Quality of every whole text: doc_id, votes, label, score, keep (score of at least ``least``).

    ``votes`` has a character for each heuristic: 0 bad, 1 good, - abstains. How often each heuristic is
    right is estimated from all documents' votes, without any given label; ``label`` is the probability
    of a good text that follows from the votes. These labels train a linear model on hashed words and
    word shapes, and ``score`` is its probability, so it also judges where all heuristics abstain.

    A null or empty text has score 0. Repeated rows each get a row; a null doc_id stays null. An empty
    table gives no rows. Other columns are ignored.
    """
    source = docs.select("doc_id", "text")
    sent = docs.sparkSession.sparkContext.broadcast(learn(source))
    kind = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, votes string, label double, score double, keep boolean"
    return source.mapInArrow(_score(sent, least), kind)
