"""Benchmark decontamination with suffix arrays over the training documents."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.llm import bytewords
from tenura.llm.arrow import SLICE_BYTES, raw, slices

WINDOW = 10
BENCHMARK_BYTES = 16 << 20
#: Bytes of text in a shard, for any index up to this size: a shard's arrays take many times its text.
SHARD_BYTES = 1 << 20
WORD = bytewords.word_table([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])
WORD[ord("A") : ord("Z") + 1] = True  # these become a-z
FOLD = np.arange(256, dtype=np.uint8)
FOLD[ord("A") : ord("Z") + 1] += 32


class Tests(NamedTuple):
    """Benchmark windows in sorted order, with the items that hold each."""

    vocabulary: np.ndarray  # sorted hashes of all words of the benchmark
    keys: np.ndarray  # windows as fixed-width keys of word numbers
    sizes: np.ndarray  # words of each window
    texts: list[bytes]  # words of each window, for the last comparison
    items: list[np.ndarray]  # items that hold each window
    places: list[np.ndarray]  # the window's first word in each of them
    names: np.ndarray  # item_id by item number, as text


def _keys(numbers: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """The ``width`` words from each place as one big-endian byte string, for sorting."""
    padded = np.concatenate([numbers, np.zeros(width, numbers.dtype)])
    grid = padded[at[:, None] + np.arange(width)]
    stop = np.cumsum(grid == 0, axis=1) > 0  # a word outside the vocabulary, or the end of a text
    grid[stop] = 0
    return np.ascontiguousarray(grid.astype(">u4")).view(f"S{4 * width}").ravel()


def _joined(data: np.ndarray, words: bytewords.Words, at: int, size: int) -> bytes:
    return b" ".join(FOLD[data[words.starts[i] : words.ends[i]]].tobytes() for i in range(at, at + size))


def read_tests(items: pa.Table, window: int = WINDOW) -> Tests:
    """Index the windows of the benchmark: ``window`` consecutive words, or all of a shorter item."""
    data, offsets = raw(items.column("text").combine_chunks())
    words = bytewords.split(data, offsets, WORD)
    vocabulary = np.unique(words.hashes)
    numbers = np.searchsorted(vocabulary, words.hashes).astype(np.uint32) + 1
    found: dict[bytes, list] = {}
    for item in range(len(items)):
        first, last = words.first[item], words.first[item + 1]
        size = min(window, last - first)
        for at in range(first, last - size + 1) if size else ():
            held = found.setdefault(_joined(data, words, at, size), [size, numbers[at : at + size], []])
            held[2].append((item, at - first))
    keys = np.zeros((len(found), window), np.uint32)
    for row, (size, each, _) in enumerate(found.values()):
        keys[row, :size] = each
    flat = np.ascontiguousarray(keys.astype(">u4")).view(f"S{4 * window}").ravel()
    return Tests(
        vocabulary, flat, np.array([x[0] for x in found.values()], np.int64), list(found),
        *[[np.array([pair[side] for pair in x[2]], np.int64) for x in found.values()] for side in (0, 1)],
        np.array([str(x) for x in items.column("item_id").to_pylist()], object),
    )


def _after(keys: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The greatest key that starts with the first ``sizes`` words of each key."""
    width = keys.dtype.itemsize // 4
    grid = np.frombuffer(keys.tobytes(), ">u4").reshape(len(keys), width).copy()
    grid[np.arange(width) >= sizes[:, None]] = 0xFFFFFFFF
    return np.ascontiguousarray(grid).view(keys.dtype).ravel()


class Matches(NamedTuple):
    words: bytewords.Words
    data: np.ndarray
    test: np.ndarray  # window of each match
    place: np.ndarray  # its first word in the shard


def shard_bytes(tests: Tests) -> int:
    """Bytes of text to search at once. All windows are looked up in every shard, so shards grow with a large index."""
    return min(SLICE_BYTES, max(SHARD_BYTES, tests.keys.nbytes))


def search(column: pa.Array, tests: Tests) -> Matches:
    """Occurrences of all test windows in one shard of documents.

    The shard's suffix array holds the suffixes that start with as many benchmark words as the shortest
    window has, sorted by their first words; no other suffix can start with a window. Each window is
    looked up by binary search, and words are compared byte by byte in the end.
    """
    data, offsets = raw(column)
    words = bytewords.split(data, offsets, WORD)
    none = np.zeros(0, np.int64)
    if not len(words.starts) or not len(tests.keys):
        return Matches(words, data, none, none)
    near = np.minimum(np.searchsorted(tests.vocabulary, words.hashes), len(tests.vocabulary) - 1)
    numbers = np.where(tests.vocabulary[near] == words.hashes, near + 1, 0).astype(np.uint32)
    ends = words.first[np.searchsorted(words.first, np.arange(len(numbers)), "right")]
    breaks = np.flatnonzero(numbers == 0)
    following = np.append(breaks, len(numbers))[np.searchsorted(breaks, np.arange(len(numbers)))]
    room = np.minimum(ends, following) - np.arange(len(numbers))
    suffixes = np.flatnonzero(room >= tests.sizes.min())
    width = tests.keys.dtype.itemsize // 4
    keys = _keys(numbers, suffixes, width)
    short = room[suffixes] < width
    if short.any():  # words of the next text do not belong to a suffix
        grid = np.frombuffer(keys[short].tobytes(), ">u4").reshape(-1, width).copy()
        grid[np.arange(width) >= room[suffixes][short][:, None]] = 0
        keys[short] = np.ascontiguousarray(grid).view(keys.dtype).ravel()
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    low = np.searchsorted(ordered, tests.keys, "left")
    high = np.searchsorted(ordered, _after(tests.keys, tests.sizes), "right")
    test = np.repeat(np.arange(len(low)), high - low)
    inner = np.arange(len(test)) - np.repeat(np.cumsum(high - low) - (high - low), high - low)
    place = suffixes[order[np.repeat(low, high - low) + inner]]
    right = [tests.texts[t] == _joined(data, words, p, tests.sizes[t]) for t, p in zip(test.tolist(), place.tolist())]
    keep = np.array(right, bool) if right else np.zeros(0, bool)
    return Matches(words, data, test[keep], place[keep])


def _spans(tests: Tests, found: Matches, rows: int) -> list[list[tuple[int, int]]]:
    """For each document its runs of hit words, as first word and length."""
    cover = np.zeros(len(found.words.starts) + 1, np.int64)
    np.add.at(cover, found.place, 1)
    np.add.at(cover, found.place + tests.sizes[found.test], -1)
    inside = np.cumsum(cover)[:-1] > 0
    first = found.words.first
    runs: list[list[tuple[int, int]]] = [[] for _ in range(rows)]
    for d in np.unique(np.searchsorted(first, found.place, "right") - 1):
        flags = np.concatenate([[False], inside[first[d] : first[d + 1]], [False]])
        edges = np.flatnonzero(flags[1:] != flags[:-1])
        runs[d] = [(int(a), int(b - a)) for a, b in zip(edges[::2], edges[1::2])]
    return runs


def _longest(tests: Tests, found: Matches, rows: int) -> list[list[tuple[str, int, int, int]]]:
    """For each document and item the longest common run: item_id, word in the item, in the document, words.

    Matches of neighbouring windows on one diagonal belong to one run.
    """
    held: list[list[tuple[str, int, int, int]]] = [[] for _ in range(rows)]
    if not len(found.test):
        return held
    times = np.array([len(tests.items[t]) for t in found.test])
    place = np.repeat(found.place, times)
    size = np.repeat(tests.sizes[found.test], times)
    item = np.concatenate([tests.items[t] for t in found.test])
    at = np.concatenate([tests.places[t] for t in found.test])
    doc = np.searchsorted(found.words.first, place, "right") - 1
    order = np.lexsort((place, place - at, item, doc))
    doc, item, place, at, size = (x[order] for x in (doc, item, place, at, size))
    breaks = np.ones(len(doc), bool)
    breaks[1:] = (np.diff(doc) != 0) | (np.diff(item) != 0) | (np.diff(place - at) != 0) | (np.diff(place) != 1)
    begin = np.flatnonzero(breaks)
    end = np.append(begin[1:], len(doc)) - 1
    words = place[end] + size[end] - place[begin]
    best: dict[tuple[int, int], int] = {}
    for run, key in enumerate(zip(doc[begin].tolist(), item[begin].tolist())):
        if key not in best or words[run] > words[best[key]]:
            best[key] = run
    for (d, i), run in best.items():
        start = begin[run]
        held[d].append((tests.names[i], int(at[start]), int(place[start] - found.words.first[d]), int(words[run])))
    return held


RUN = "array<struct<first_word:int,n_words:int>>"
LONGEST = "array<struct<item_id:string,item_word:int,doc_word:int,n_words:int>>"
RUN_ARROW = pa.list_(pa.struct([("first_word", pa.int32()), ("n_words", pa.int32())]))
LONGEST_ARROW = pa.list_(
    pa.struct([("item_id", pa.string()), ("item_word", pa.int32()), ("doc_word", pa.int32()), ("n_words", pa.int32())])
)


def _as_structs(rows: list[list[tuple]], kind: pa.DataType) -> pa.Array:
    names = [kind.value_type.field(i).name for i in range(kind.value_type.num_fields)]
    return pa.array([[dict(zip(names, x)) for x in row] for row in rows], kind)


def _match(sent) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests = sent.value
        for batch in slices(batches, "text", shard_bytes(tests)):
            found, rows = search(batch.column("text"), tests), batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("mark"), pa.array(np.diff(found.words.first)),
                    _as_structs(_spans(tests, found, rows), RUN_ARROW), _as_structs(_longest(tests, found, rows), LONGEST_ARROW),
                ],
                names=["doc_id", "mark", "n_words", "hits", "longest"],
            )

    return run


def _parts(benchmark: DataFrame, window: int) -> list:
    """The benchmark's index as broadcast parts, each made of a bounded number of bytes."""
    spark = benchmark.sparkSession
    size = benchmark.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    cut = max(1, -(-size // BENCHMARK_BYTES))
    keyed = benchmark.select("item_id", "text")
    chosen = [keyed if cut == 1 else keyed.where(F.pmod(F.xxhash64("item_id"), F.lit(cut)) == part) for part in range(cut)]
    return [spark.sparkContext.broadcast(read_tests(part.toArrow(), window)) for part in chosen]


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Verbatim passages of the benchmark in each document.

    One row per document: doc_id, n_words, n_hit (words inside any occurrence of a window), n_items,
    items_sha256, contaminated, hits (runs of hit words) and longest (for each item the longest common
    run and where it lies in both). Documents are cut into shards, and the task that reads a shard sorts
    its suffixes and looks up all windows; nothing is shuffled. The benchmark is broadcast in parts of at
    most 16 MB of text; with more parts than one, each takes a pass and the runs are united by document.

    A null or empty text has no words, no hits and the checksum of the empty text. Null, empty and
    repeated items are fine: an item without words matches nothing, and each item_id counts once. Items
    shorter than the window match as a whole. Repeated documents each get a row. Other columns are ignored.
    """
    parts = _parts(benchmark, window)
    kind = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, mark string, n_words long, hits {RUN}, longest {LONGEST}"
    alone = len(parts) == 1
    mark = F.lit(None).cast("string") if alone else F.concat_ws(" ", F.col("doc_id").cast("string"), F.sha2(F.coalesce("text", F.lit("")), 256))
    source = docs.select("doc_id", "text", mark.alias("mark"))
    passes = [source.mapInArrow(_match(part), kind) for part in parts]
    if alone:
        found = passes[0]
    else:
        runs = [p.where(F.size("hits") > 0).dropDuplicates(["mark"]).select("mark", "hits", "longest") for p in passes]
        united = runs[0]
        for more in runs[1:]:
            united = united.union(more)
        united = united.groupBy("mark").agg(
            F.flatten(F.collect_list("hits")).alias("hits"), F.flatten(F.collect_list("longest")).alias("longest")
        )  # as many lists as parts
        nothing = [F.coalesce(c, F.array().cast(t)).alias(c) for c, t in (("hits", RUN), ("longest", LONGEST))]
        counted = passes[0].select("doc_id", "mark", "n_words")
        found = counted.join(united.withColumn("hits", _unite(F.col("hits"))), "mark", "left").select("doc_id", "n_words", *nothing)
    items = F.array_sort(F.array_distinct(F.transform("longest", lambda x: x["item_id"])))
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, x: n + x["n_words"])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"), "hits", "longest",
    )


def _unite(runs):
    """Overlapping runs of words joined into disjoint ones."""
    start = F.array().cast(RUN)

    def add(done, run):
        last = F.element_at(done, -1)
        end = F.greatest(last["first_word"] + last["n_words"], run["first_word"] + run["n_words"])
        longer = F.struct(last["first_word"].alias("first_word"), (end - last["first_word"]).alias("n_words"))
        joined = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(longer))
        touches = (F.size(done) > 0) & (run["first_word"] <= F.try_element_at(done, F.lit(-1))["first_word"] + F.try_element_at(done, F.lit(-1))["n_words"])
        return F.when(touches, joined).otherwise(F.concat(done, F.array(run)))

    return F.aggregate(F.array_sort(runs), start, add)


def _clean(sent) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests = sent.value
        for batch in slices(batches, "text", shard_bytes(tests)):
            found = search(batch.column("text"), tests)
            keep = np.ones(batch.num_rows, bool)
            keep[np.searchsorted(found.words.first, found.place, "right") - 1] = False
            yield batch.filter(pa.array(keep))

    return run


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents, with all their columns, in which no window of the benchmark occurs."""
    for part in _parts(benchmark, window):
        docs = docs.mapInArrow(_clean(part), docs.schema)
    return docs
