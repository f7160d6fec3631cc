"""Language identification with a bidirectional gated recurrent network over bytes, in numpy."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenura.llm.arrow import raw, slices

WINDOW = 128  # bytes that the network reads at once
HIDDEN = 8
UNKNOWN = "und"
#: Bounds of the training sample.
DOCS_PER_LANGUAGE = 600
WINDOWS_PER_DOC = 4
EPOCHS = 5
BATCH = 128
RATE = 0.01
LANES = 1024  # windows read side by side


class Network(NamedTuple):
    """Weights: byte tables with biases in them (256 x 3H), recurrent matrices (H x 3H), read-outs (H x C).

    Columns of the gates are update, reset, candidate; index 0 reads forwards and 1 backwards.
    """

    languages: list[str]
    tables: np.ndarray
    recurrent: np.ndarray
    readout: np.ndarray
    bias: np.ndarray


def _step(table: np.ndarray, recurrent: np.ndarray, byte: np.ndarray, state: np.ndarray):
    """Next state, and what the way back needs."""
    size = state.shape[1]
    inputs, past = table[byte], state @ recurrent
    total = np.clip(inputs[:, : 2 * size] + past[:, : 2 * size], -30, 30)
    gate = 1 / (1 + np.exp(-total))
    update, reset = gate[:, :size], gate[:, size:]
    candidate = np.tanh(inputs[:, 2 * size :] + reset * past[:, 2 * size :])
    return candidate + update * (state - candidate), (update, reset, candidate, past[:, 2 * size :])


def windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, length and document of the windows; every byte lies in exactly one, and none crosses texts."""
    counts = -(-np.diff(offsets) // WINDOW)
    doc = np.repeat(np.arange(len(counts)), counts)
    inner = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
    begin = offsets[:-1][doc] + inner * WINDOW
    return begin, np.minimum(WINDOW, offsets[1:][doc] - begin), doc


def position_logits(net: Network, data: np.ndarray, begin: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Evidence for each language at every byte of windows of falling length: (time, language, window), and
    how many windows reach each time. Windows lie along the last axis, so that every operation runs over them."""
    size, steps, count = net.recurrent.shape[1], int(length[0]), len(begin)
    reach = np.searchsorted(-length, -np.arange(steps), "left")
    found = np.zeros((2, steps, len(net.bias), count), np.float32)
    # 1 / (1 + exp(-x)) for the gates and 2 / (1 + exp(-2x)) - 1 for the candidate: signs and factors go into the weights
    scale = np.full(3 * size, -1, np.float32)
    scale[2 * size :] = -2
    room = [np.empty((3 * size, count), np.float32) for _ in (0, 1)]
    for side in (0, 1):
        table, recurrent = (np.ascontiguousarray((x * scale).T) for x in (net.tables[side], net.recurrent[side]))
        readout = np.ascontiguousarray(net.readout[side].T)
        state = np.zeros((size, count), np.float32)
        place, move = (begin.copy(), 1) if side == 0 else (begin + length - 1, -1)
        for t in range(steps):
            n = reach[t]
            whole = n == count
            total, past, now = (x if whole else x[:, :n] for x in (*room, state))
            seen = data[place[:n]]
            if whole:
                np.take(table, seen, axis=1, out=total, mode="clip")
            else:
                total[:] = np.take(table, seen, axis=1)
            place += move
            past[:] = recurrent @ now
            gate, candidate = total[: 2 * size], total[2 * size :]
            gate += past[: 2 * size]
            np.minimum(gate, 60, out=gate)
            np.exp(gate, out=gate)
            gate += 1
            np.reciprocal(gate, out=gate)
            drawn = past[2 * size :]
            drawn *= gate[size:]
            candidate += drawn
            np.minimum(candidate, 60, out=candidate)
            np.exp(candidate, out=candidate)
            candidate += 1
            np.divide(2, candidate, out=candidate)
            candidate -= 1
            now -= candidate
            now *= gate[:size]
            now += candidate
            found[side, t, :, :n] = readout @ now
    forwards, backwards = found
    every = np.arange(count)
    same = int(np.searchsorted(-length, -length[0], "right"))  # windows of full length only turn the time round
    forwards[:, :, :same] += backwards[::-1, :, :same]
    for t in range(steps):
        n = reach[t]
        if n > same:
            forwards[t, :, same:n] += backwards[length[same:n] - 1 - t, :, every[same:n]].T
    forwards += net.bias[:, None]
    return forwards, reach


def document_probabilities(net: Network, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Mean over all bytes of a text of the probabilities at each byte; zeros for an empty text."""
    pooled = np.zeros((len(offsets) - 1, len(net.languages)))
    begin, length, doc = windows(data, offsets)
    order = np.argsort(-length, kind="stable")
    for at in range(0, len(order), LANES):
        part = order[at : at + LANES]
        logits, reach = position_logits(net, data, begin[part], length[part])
        logits -= logits.max(axis=1, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=1, keepdims=True)
        for t, n in enumerate(reach.tolist()):
            logits[t, :, n:] = 0
        np.add.at(pooled, doc[part], logits.sum(axis=0, dtype=np.float64).T)
    return pooled / np.maximum(np.diff(offsets), 1)[:, None]


def train(texts: list[bytes], labels: list[str], hidden: int = HIDDEN, epochs: int = EPOCHS, seed: int = 6) -> Network:
    """Fit the network to windows by backpropagation through time, every position bearing its text's label.

    Equal weight for each language; Adam with a falling rate. Texts longer than a window are cut to it.
    """
    languages = sorted(set(labels))
    rng = np.random.default_rng(seed)
    target = np.searchsorted(languages, labels)
    weight = (len(labels) / len(languages) / np.bincount(target))[target].astype(np.float32)
    length = np.array([min(len(t), WINDOW) for t in texts])
    grid = np.zeros((len(texts), WINDOW), np.uint8)
    for row, text in enumerate(texts):
        grid[row, : length[row]] = np.frombuffer(text[:WINDOW], np.uint8)
    count = len(languages)
    values = {
        "tables": rng.normal(0, 0.3, (2, 256, 3 * hidden)),
        "recurrent": rng.normal(0, 1 / np.sqrt(hidden), (2, hidden, 3 * hidden)),
        "readout": rng.normal(0, 0.3, (2, hidden, count)), "bias": np.zeros(count),
    }
    values = {k: v.astype(np.float32) for k, v in values.items()}
    mean, square = ({k: np.zeros_like(v) for k, v in values.items()} for _ in range(2))
    turns, total = 0, epochs * -(-len(texts) // BATCH)
    for _ in range(epochs):
        for rows in np.array_split(rng.permutation(len(texts)), max(1, len(texts) // BATCH)):
            grads = _gradients(values, grid[rows], length[rows], target[rows], weight[rows])
            turns += 1
            rate = RATE * (1 - 0.9 * turns / max(total, turns))
            for k, g in grads.items():
                mean[k] += 0.1 * (g - mean[k])
                square[k] += 0.01 * (g * g - square[k])
                values[k] -= rate * (mean[k] / (1 - 0.9**turns)) / (np.sqrt(square[k] / (1 - 0.99**turns)) + 1e-6)
    return Network(languages, **values)


def _gradients(values: dict, grid: np.ndarray, length: np.ndarray, target: np.ndarray, weight: np.ndarray) -> dict:
    """Gradients of the mean cross-entropy over positions, through all steps of both directions."""
    rows, steps = len(grid), int(length.max())
    hidden, every = values["recurrent"].shape[1], np.arange(rows)
    live = np.arange(steps)[:, None] < length
    back = np.clip(length - 1 - np.arange(steps)[:, None], 0, None)
    bytes_at = [grid[:, :steps].T, grid[every, back]]
    states, notes = [np.zeros((steps + 1, rows, hidden), np.float32) for _ in (0, 1)], [[], []]
    for side in (0, 1):
        for t in range(steps):
            after, note = _step(values["tables"][side], values["recurrent"][side], bytes_at[side][t], states[side][t])
            states[side][t + 1] = np.where(live[t][:, None], after, states[side][t])
            notes[side].append(note)
    readings = [states[0][1:], states[1][1:][back, every]]
    logits = readings[0] @ values["readout"][0] + readings[1] @ values["readout"][1] + values["bias"]
    logits -= logits.max(axis=2, keepdims=True)
    error = np.exp(logits)
    error /= error.sum(axis=2, keepdims=True)
    error[:, every, target] -= 1
    error *= (live * weight / live.sum())[:, :, None].astype(np.float32)
    grads = {k: np.zeros_like(v) for k, v in values.items()}
    grads["bias"] = error.sum(axis=(0, 1))
    for side in (0, 1):
        grads["readout"][side] = np.einsum("tnh,tnc->hc", readings[side], error)
        from_output = error @ values["readout"][side].T
        if side:  # back to the order in which the states were made
            from_output = from_output[back, every]
        ahead = np.zeros((rows, hidden), np.float32)
        recurrent = values["recurrent"][side]
        for t in range(steps - 1, -1, -1):
            mask = live[t][:, None]
            ahead += from_output[t] * mask
            update, reset, candidate, past = notes[side][t]
            before = states[side][t]
            flow = ahead * mask
            d_candidate = flow * (1 - update) * (1 - candidate**2)
            d_update = flow * (before - candidate) * update * (1 - update)
            d_reset = d_candidate * past * reset * (1 - reset)
            inner = np.concatenate([d_update, d_reset, d_candidate], axis=1)
            np.add.at(grads["tables"][side], bytes_at[side][t], inner)
            through = np.concatenate([d_update, d_reset, d_candidate * reset], axis=1)
            grads["recurrent"][side] += before.T @ through
            ahead = np.where(mask, flow * update + through @ recurrent.T, ahead)
    return grads


def held_out(column: str = "doc_id") -> Column:
    """Documents that are never learnt from."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def _cut(limit: int) -> Callable:
    """At most ``limit`` windows of each text, evenly spread over it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            data, offsets = raw(batch.column("text"))
            begin, length, doc = windows(data, offsets)
            counts = np.bincount(doc, minlength=batch.num_rows)
            first = np.cumsum(counts) - counts
            chosen = [f + np.unique(np.linspace(0, n - 1, min(n, limit)).astype(int)) for f, n in zip(first, counts) if n]
            for part in chosen:
                texts = [data[begin[i] : begin[i] + length[i]].tobytes() for i in part]
                row = int(doc[part[0]])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(texts, pa.binary()), batch.column("lang").take(pa.array([row] * len(part)))], names=["piece", "lang"]
                )

    return run


def learn(docs: DataFrame, docs_per_language: int = DOCS_PER_LANGUAGE, windows_per_doc: int = WINDOWS_PER_DOC) -> Network | None:
    """Train on a bounded sample: of each language about ``docs_per_language`` documents, drawn by the hash
    of doc_id, and some windows of each. Held-out documents and null languages take no part. None if nothing is left."""
    fit = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    # one rate for each language: a draw below it takes about the wanted number of documents
    rates = fit.groupBy("lang").agg((F.lit(float(docs_per_language)) / F.count("*")).alias("rate"))
    draw = F.shiftrightunsigned(F.xxhash64("doc_id"), 11).cast("double") / F.lit(float(1 << 53))
    texts = fit.join(F.broadcast(rates), "lang").where(draw < F.col("rate")).select("text", "lang")
    sample = texts.mapInArrow(_cut(windows_per_doc), "piece binary, lang string")
    limit = docs_per_language * windows_per_doc
    dealt = sample.groupBy("lang").agg(F.count("*").alias("n")).collect()
    if any(row["n"] > 4 * limit for row in dealt):  # only if one doc_id stands for very many rows
        sample = sample.orderBy(F.xxhash64("piece")).limit(limit * len(dealt))
    rows = sample.toArrow().sort_by([("lang", "ascending"), ("piece", "ascending")])
    if not rows.num_rows:
        return None
    return train(rows.column("piece").to_pylist(), rows.column("lang").to_pylist())


def _predict(sent) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = sent.value
        for batch in slices(batches, "text"):
            language, score = predictions(net, batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(language, pa.string()), pa.array(score)], names=[*batch.schema.names, "lang_pred", "score"]
            )

    return run


def predictions(net: Network | None, column: pa.Array) -> tuple[list[str], np.ndarray]:
    texts = pc.fill_null(column.cast(pa.large_string()), "")
    lettered = pc.match_substring_regex(texts, r"\p{L}").to_numpy(zero_copy_only=False)
    if net is None:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    found = document_probabilities(net, *raw(texts))
    best = found.argmax(axis=1)
    score = np.where(lettered, found[np.arange(len(best)), best], 0.0)
    return [net.languages[i] if ok else UNKNOWN for i, ok in zip(best, lettered)], np.clip(score, 0.0, 1.0)


def identify(docs: DataFrame) -> DataFrame:
    """Language of every whole text: doc_id, held_out, lang_pred, score.

    The network reads windows of 128 bytes in both directions and gives each byte a probability for each
    learned language; a document's probabilities are the means over all its bytes, and score is the
    greatest. Learning sees only text and lang of documents that are not held out (see `learn`).

    A null text or one without a letter is ``und`` with score 0, as is everything if there is nothing to
    learn from. Repeated rows each get a row; a null doc_id is never learnt from. Ties go to the first
    language in alphabetical order. An empty table gives no rows. Other columns are ignored.
    """
    sent = docs.sparkSession.sparkContext.broadcast(learn(docs))
    source = docs.select("doc_id", held_out().alias("held_out"), "text")
    kind = T.StructType([*source.schema, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return source.mapInArrow(_predict(sent), kind).drop("text")


def _known(sent, least: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            language, score = predictions(sent.value, batch.column("text"))
            yield batch.filter(pa.array([x != UNKNOWN and s >= least for x, s in zip(language, score)], pa.bool_()))

    return run


def keep_known(docs: DataFrame, least: float) -> DataFrame:
    """The documents, with all their columns, whose language is known with a score of at least ``least``."""
    return docs.mapInArrow(_known(docs.sparkSession.sparkContext.broadcast(learn(docs)), least), docs.schema)
