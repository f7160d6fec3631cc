"""Near-duplicate documents by MinHash, an LSH forest and an exact prefix filter, confirmed on whole shingle sets."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.llm import bytewords
from tenura.llm.arrow import raw, slices
from tenura.llm.common import fits, materialise, partitions
from tenura.llm.components import components

SHINGLE = 5
PERCENT = 75
TREES = 32
LEVELS = 4  # parts of the signature that no two trees share
DEPTH = 16  # parts of a sort key
LEAST_DEPTH = 3  # parts that neighbours must share
KEY_BYTES = LEVELS * 2 + DEPTH - LEVELS  # two bytes for each of the tree's own parts, one for the others
#: Parts of a sort key in which a pair of neighbours must agree; at the threshold 12 of 16 do. What this leaves out is
#: found in another tree or by the prefix filter.
LEAST_ALIKE = 10
MINHASHES = TREES * LEVELS
#: Rounds of candidates: trees, and neighbours looked at on each side of a document.
ROUNDS = ((2, 1), (8, 1), (TREES, 4))
#: A pair at the threshold agrees in 96 of 128 parts with a deviation of 4.9; fewer than 64 are 6.5 deviations off.
LEAST_AGREEING = 64
#: Bits of a shingle that its count is kept under, and of these the ones that name a range of counts.
SLOT_BITS = 22
RANGE_BITS = 6
#: Rows of one shingle that are compared in one task; longer lists are cut, and every two of their parts meet.
BLOCK = 1024
FLUSH = 1 << 18
PIECE = 1 << 16
SLICE_BYTES = 2 << 20
ID, PRINT, AGAIN = "_chosen_doc_id", "_chosen_print", "_chosen_again"
WORD = bytewords.word_table([(0x20, 0x20), (0x09, 0x0D)])
_RANDOM = np.random.default_rng(75)
FACTORS = _RANDOM.integers(0, 1 << 31, MINHASHES, np.uint32) * np.uint32(2) + np.uint32(1)
SHIFTS = _RANDOM.integers(0, 1 << 32, MINHASHES, np.uint64).astype(np.uint32)
PLACES = _RANDOM.integers(0, 1 << 63, SHINGLE, np.uint64) * np.uint64(2) + np.uint64(1)


def _orders() -> np.ndarray:
    """For each tree the parts of the signature in its sort order; the first ones are the tree's own."""
    own = np.arange(MINHASHES).reshape(LEVELS, TREES).T
    rest = [np.random.default_rng(t).permutation(np.setdiff1d(np.arange(MINHASHES), own[t]))[: DEPTH - LEVELS] for t in range(TREES)]
    return np.concatenate([own, np.array(rest)], axis=1)


ORDERS = _orders()


def shingle_hashes(column: pa.Array, size: int = SHINGLE) -> tuple[bytewords.Words, np.ndarray]:
    """Words of all texts and 64-bit hashes of the runs of ``size`` words that begin at each, also across texts."""
    words = bytewords.split(*raw(column), WORD)
    sums = np.zeros(max(0, len(words.hashes) - size + 1), np.uint64)
    for place in range(size):
        sums += words.hashes[place : place + len(sums)] * PLACES[place]
    return words, bytewords.mix(sums)


def shingle_sets(column: pa.Array, size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the runs of ``size`` words of each text; all words, if fewer."""
    words, sums = shingle_hashes(column, size)
    hashes, first = words.hashes, words.first
    sets = []
    for low, high in zip(first[:-1].tolist(), first[1:].tolist()):
        if high - low >= size:
            sets.append(np.unique(sums[low : high - size + 1]))
        elif high > low:
            alone = (hashes[low:high] * PLACES[: high - low]).sum(dtype=np.uint64) + np.uint64(high - low)
            sets.append(bytewords.mix(np.array([alone], np.uint64)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash parts of non-empty sets, 16 bits each."""
    parts = np.empty((len(sets), MINHASHES), np.uint16)
    row = 0
    while row < len(sets):
        last, size = row, 0
        while last < len(sets) and (last == row or size + len(sets[last]) <= PIECE):
            size += len(sets[last])
            last += 1
        flat = (np.concatenate(sets[row:last]) >> np.uint64(32)).astype(np.uint32)
        begins = np.cumsum([0] + [len(s) for s in sets[row : last - 1]])
        room = np.empty_like(flat)
        for i in range(MINHASHES):
            np.multiply(flat, FACTORS[i], out=room)
            room += SHIFTS[i]
            least = np.minimum.reduceat(room, begins)
            parts[row:last, i] = (least * np.uint32(0x9E3779B1)) >> np.uint32(16)
        row = last
    return parts


def _node(sets: list[np.ndarray]) -> list[bytes | None]:
    """A name for each distinct set; empty sets have none."""
    return [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]


def _slots(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - SLOT_BITS)).astype(np.int32)


def _slot_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often this task meets the shingles of each slot, a row for each range of slots; counts stop at 65,535."""
    counts = np.zeros(1 << SLOT_BITS, np.uint32)
    for batch in slices(batches, "text", SLICE_BYTES):
        _, sums = shingle_hashes(batch.column("text"))
        counts += np.bincount(_slots(sums), minlength=len(counts)).astype(np.uint32)
    parts = np.minimum(counts, 0xFFFF).astype("<u2").reshape(1 << RANGE_BITS, -1)
    full = np.flatnonzero(parts.any(axis=1))
    yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array([parts[i].tobytes() for i in full], pa.binary())], names=["range", "counts"])


def _added_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of each range over all tasks, one after the other, in eighths of powers of two."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for number, counts in zip(batch.column("range").to_pylist(), batch.column("counts")):
            found = np.frombuffer(counts.as_buffer(), "<u2").astype(np.int64)
            sums[number] = sums[number] + found if number in sums else found
    levels = [np.minimum(255, 8 * np.log2(np.maximum(x, 1))).astype(np.uint8).tobytes() for x in sums.values()]
    yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(levels, pa.binary())], names=["range", "levels"])


def _commonness(docs: DataFrame) -> np.ndarray:
    """For each slot how common its shingles are in all texts, in eighths of powers of two.

    It only orders the shingles of a set: any order gives the same links, this one gives short lists. A task sends
    its counts, not shingles: at most 8 MB, however much text it reads.
    """
    ranges = docs.select("text").mapInArrow(_slot_counts, "range int, counts binary").repartition(1 << RANGE_BITS, "range")
    found = materialise(ranges.mapInArrow(_added_counts, "range int, levels binary"), "levels").toArrow()  # 4 MB at most
    common = np.zeros((1 << RANGE_BITS, 1 << SLOT_BITS - RANGE_BITS), np.uint8)
    for number, levels in zip(found["range"].to_pylist(), found["levels"].to_pylist()):
        common[number] = np.frombuffer(levels, np.uint8)
    return common.ravel()


def prefix(found: np.ndarray, common: np.ndarray) -> np.ndarray:
    """The rarest shingles of a set, so many that two sets similar enough have one of them in common."""
    count = len(found) - -(-PERCENT * len(found) // 100) + 1
    return found[np.argsort(common[_slots(found)], kind="stable")[:count]]


def _sketch(common: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE_BYTES):
            sets = shingle_sets(batch.column("text"))
            full = [s for s in sets if len(s)]
            parts = iter(signatures(full)) if full else iter(())
            marks = [next(parts).tobytes() if len(s) else None for s in sets]
            rare = [prefix(s, common).tobytes() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("print"), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(_node(sets), pa.binary()), pa.array(marks, pa.binary()), pa.array(rare, pa.binary()),
                ],
                names=["doc_id", "print", "n_shingles", "node", "parts", "prefix"],
            )

    return run


def _tree_rows(trees: int) -> Callable:
    """A row for each tree and node, its key being the node's signature in the tree's order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            parts = np.frombuffer(b"".join(batch.column("parts").to_pylist()), np.uint16).reshape(-1, MINHASHES)
            for tree in range(trees):
                own, more = np.ascontiguousarray(parts[:, ORDERS[tree, :LEVELS]].astype(">u2")), parts[:, ORDERS[tree, LEVELS:]].astype(np.uint8)
                keys = np.concatenate([own.view(np.uint8), more], axis=1)
                key = pa.Array.from_buffers(pa.binary(KEY_BYTES), len(keys), [None, pa.py_buffer(keys)]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(keys), tree, np.int32)), key, *[batch.column(c) for c in ("node", "group", "n_shingles")]],
                    names=["tree", "key", "node", "group", "n_shingles"],
                )

    return run


PAIRS = "a binary, b binary, cut long, tree int, key binary, node binary, `group` binary, n_shingles long"
PAIRS_ARROW = pa.schema(
    [("a", pa.binary()), ("b", pa.binary()), ("cut", pa.int64()), ("tree", pa.int32())]
    + [(c, pa.binary()) for c in ("key", "node", "group")] + [("n_shingles", pa.int64())]
)
SORTED = ["tree", "key", "node", "group", "n_shingles"]


def _neighbours(rows: pa.Table, reach: int, from_row: int = 0) -> tuple[list[bytes], list[bytes]]:
    """Pairs of rows at most ``reach`` apart in sort order that share a prefix of the least depth.

    The rows nearest in the order share the longest prefixes, so a crowded region is searched at a
    greater depth than a sparse one. Pairs are left out if both are of one group already, if one
    set is too small a part of the other, or if too few parts of their keys agree.
    """
    whole = np.frombuffer(b"".join(rows.column("key").to_pylist()), np.uint8).reshape(-1, KEY_BYTES)
    keys, rest = np.ascontiguousarray(whole[:, : 2 * LEVELS]).view(np.uint16), whole[:, 2 * LEVELS :]
    tree, size = rows.column("tree").to_numpy(), rows.column("n_shingles").to_numpy()
    group = rows.column("group").combine_chunks().dictionary_encode()
    group = (group.combine_chunks() if isinstance(group, pa.ChunkedArray) else group).indices.to_numpy()
    node = rows.column("node").to_pylist()
    a, b = [], []
    for off in range(1, min(reach, len(node) - 1) + 1):
        low, high = slice(None, -off), slice(off, None)
        near = (tree[low] == tree[high]) & (keys[low, :LEAST_DEPTH] == keys[high, :LEAST_DEPTH]).all(axis=1)
        near[: max(0, from_row - off)] = False
        if not near.any():
            break
        near &= (group[low] != group[high]) & (100 * np.minimum(size[low], size[high]) >= PERCENT * np.maximum(size[low], size[high]))
        at = np.flatnonzero(near)
        alike = (keys[at] == keys[at + off]).sum(axis=1) + (rest[at] == rest[at + off]).sum(axis=1)
        at = at[alike >= LEAST_ALIKE].tolist()
        a += [min(node[i], node[i + off]) for i in at]
        b += [max(node[i], node[i + off]) for i in at]
    return a, b


def _as_pairs(a: list[bytes], b: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(a, pa.binary()), pa.array(b, pa.binary()), *[pa.nulls(len(a), f.type) for f in list(PAIRS_ARROW)[2:]]],
        schema=PAIRS_ARROW,
    )


def _edge(rows: pa.Table, cut: int) -> pa.RecordBatch:
    held = rows.combine_chunks()
    count = held.num_rows
    columns = [pa.nulls(count, pa.binary()), pa.nulls(count, pa.binary()), pa.array(np.full(count, cut), pa.int64())]
    kept = [held.column(c).combine_chunks() for c in SORTED]
    return pa.RecordBatch.from_arrays([*columns, *kept], schema=PAIRS_ARROW)


def _sorted_pairs(reach: int) -> Callable:
    """Candidate pairs inside one range of the sorted order, and the rows at its two ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, carried, first = TaskContext.get().partitionId(), None, True
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            if first and part:
                yield _edge(rows.slice(0, reach), part - 1)
            first = False
            before = 0
            if carried is not None:
                before = carried.num_rows
                rows = pa.concat_tables([carried, rows])
            pairs = _neighbours(rows, reach, before)
            if pairs[0]:
                yield _as_pairs(*pairs)
            carried = rows.slice(max(0, rows.num_rows - reach)).combine_chunks()
        if carried is not None:
            yield _edge(carried, part)

    return run


def _edge_pairs(reach: int) -> Callable:
    def run(rows: pa.Table) -> pa.Table:
        order = sorted(range(rows.num_rows), key=lambda i: (rows["tree"][i].as_py(), rows["key"][i].as_py(), rows["node"][i].as_py()))
        a, b = _neighbours(rows.take(pa.array(order)), reach)
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})

    return run


def candidates(nodes: DataFrame, trees: int, reach: int) -> DataFrame:
    """Distinct pairs (a < b) of nodes that stand near each other in one of the sorted orders.

    Rows are dealt out by ranges of (tree, key, node): a region in which very many documents share a
    whole key is cut by node. Neighbours on either side of a cut meet in a small second step.
    """
    spark = nodes.sparkSession
    rows = nodes.select("node", "parts", F.coalesce("group", "node").alias("group"), "n_shingles").mapInArrow(
        _tree_rows(trees), "tree int, key binary, node binary, `group` binary, n_shingles long"
    )
    keys = ["tree", "key", "node"]
    ranged = rows.repartitionByRange(partitions(spark), *keys).sortWithinPartitions(*keys)
    found = materialise(ranged.mapInArrow(_sorted_pairs(reach), PAIRS), "pairs")
    # at most twice the reach of rows for each cut
    across = found.where("cut is not null").select("cut", *SORTED).groupBy("cut").applyInArrow(_edge_pairs(reach), "a binary, b binary")
    return found.where("cut is null").select("a", "b").union(across).distinct()


INDEX = "shingle long, short long, group long, size long, place long"
#: Zeros, as most nodes have no link and their rows are sent: a name would not compress.
NO_GROUP = bytes(8)


def _index_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each shingle of a prefix; ``short`` and ``group`` are the first 8 bytes of these names, 0 for no group."""
    for batch in slices(batches, "prefix", SLICE_BYTES // 4):
        held = [np.frombuffer(x.as_buffer(), np.int64) for x in batch.column("prefix")]
        counts = [len(x) for x in held]
        short, group = (
            np.frombuffer(b"".join((x or NO_GROUP)[:8] for x in batch.column(c).to_pylist()), ">i8").astype(np.int64) for c in ("node", "group")
        )
        size = batch.column("n_shingles").to_numpy()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate(held)), *[pa.array(np.repeat(x, counts)) for x in (short, group, size)],
                pa.array(np.concatenate([np.arange(n) for n in counts])),
            ],
            names=["shingle", "short", "group", "size", "place"],
        )


CELL = ["shingle", "low", "high"]
CELL_ROWS = [*CELL, "own", "short", "group", "size", "place"]


def _cell_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of each cell in different groups whose sizes and places in the order leave room for enough common shingles."""

    def compare(c: dict[str, np.ndarray], ends: np.ndarray) -> Iterator[pa.RecordBatch]:
        rows, off, found, count = np.flatnonzero(ends - np.arange(len(ends)) > 1), 1, [], 0
        while len(rows):
            for at in range(0, len(rows), FLUSH):
                i = rows[at : at + FLUSH]
                j = i + off
                one, other = c["size"][i], c["size"][j]
                room = np.minimum(one - c["place"][i], other - c["place"][j])
                near = ((c["group"][i] != c["group"][j]) | (c["group"][i] == 0)) & ((c["low"][i] == c["high"][i]) | (c["own"][i] != c["own"][j]))
                near &= (100 * np.minimum(one, other) >= PERCENT * np.maximum(one, other)) & ((100 + PERCENT) * room >= PERCENT * (one + other))
                both = np.stack([c["short"][i[near]], c["short"][j[near]]])
                found.append(np.sort(both, axis=0))
                count += both.shape[1]
                if count >= FLUSH:
                    yield pairs(found)
                    found, count = [], 0
            rows = rows[ends[rows] > rows + off + 1]
            off += 1
        if count:
            yield pairs(found)

    def pairs(found: list[np.ndarray]) -> pa.RecordBatch:
        a, b = np.unique(np.concatenate(found, axis=1), axis=1)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    def ready(c: dict[str, np.ndarray], last: bool) -> tuple[int, np.ndarray]:
        """How many rows are in cells that are complete, and for each of these where its cell ends."""
        count = len(c["shingle"])
        new = np.zeros(count, bool)
        for name in CELL:
            new[1:] |= c[name][1:] != c[name][:-1]
        ends = np.append(np.flatnonzero(new), count)
        begins = np.append(0, ends[:-1])
        whole = count if last else int(begins[-1])
        return whole, np.repeat(ends, ends - begins)[:whole]

    carried = None
    for batch in batches:
        if not batch.num_rows:
            continue
        c = {name: batch.column(name).to_numpy() for name in CELL_ROWS}
        if carried is not None:
            c = {name: np.concatenate([carried[name], c[name]]) for name in CELL_ROWS}
        whole, ends = ready(c, False)
        yield from compare(c, ends)
        carried = {name: x[whole:].copy() for name, x in c.items()}
    if carried is not None:
        yield from compare(carried, ready(carried, True)[1])


def rest_of_pairs(nodes: DataFrame) -> DataFrame:
    """All distinct pairs (a < b) of nodes of different groups that can be similar enough, by exact prefix filtering.

    Sets with a Jaccard similarity of 0.75 have a shingle in common among the rarest quarter of each. Where the
    first common one stands bounds how many more there can be. Lists longer than a block are cut by node, and a
    cell is one pair of their parts.
    """
    spark = nodes.sparkSession
    index = nodes.select("node", "group", "n_shingles", "prefix").mapInArrow(_index_rows, INDEX)
    long_lists = materialise(index.groupBy("shingle").agg(F.count("*").alias("rows")).where(F.col("rows") > BLOCK), "long-lists")
    count = long_lists.count()
    if count:
        side = F.broadcast(long_lists) if fits(count, 40) else long_lists
        dealt = index.join(side, "shingle", "left").withColumn("parts", F.coalesce(F.ceil(F.col("rows") / BLOCK), F.lit(1)).cast("int"))
        dealt = dealt.withColumn("own", F.pmod(F.xxhash64("short"), "parts").cast("int"))
        dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        dealt = dealt.withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")})
    else:
        dealt = index.withColumns({name: F.lit(0) for name in ("own", "low", "high")})
    cells = dealt.select(*CELL_ROWS).repartition(partitions(spark), *CELL).sortWithinPartitions(*CELL)
    found = materialise(cells.mapInArrow(_cell_pairs, "a long, b long").distinct(), "short-pairs")
    # two nodes may share a short name, and then both are compared
    names = nodes.select("node", F.conv(F.hex(F.substring("node", 1, 8)), 16, -10).cast("long").alias("short"))
    found = found.join(names.select(F.col("short").alias("a"), F.col("node").alias("x")), "a")
    found = found.join(names.select(F.col("short").alias("b"), F.col("node").alias("y")), "b")
    return found.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


def _agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, MINHASHES) for c in ("parts_a", "parts_b"))
        yield batch.select(["a", "b"]).filter(pa.array((a == b).sum(axis=1) >= LEAST_AGREEING))


def _whole_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", SLICE_BYTES):
        sets = shingle_sets(batch.column("text"))
        right = pa.array([a == b for a, b in zip(_node(sets), batch.column("node").to_pylist())], pa.bool_())
        made = pa.RecordBatch.from_arrays([batch.column("node"), pa.array([s.tobytes() for s in sets], pa.large_binary()).cast(pa.binary())], names=["node", "shingles"])
        yield made.filter(right)


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for x, y in zip(batch.column("set_a"), batch.column("set_b")):
            one, other = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
            both = len(np.intersect1d(one, other, assume_unique=True))
            keep.append(100 * both >= PERCENT * (len(one) + len(other) - both))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _confirmed(docs: DataFrame, nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs whose whole sets are similar enough. Only texts of documents in such a pair are read again."""
    marks = nodes.select("node", "parts")
    marked = pairs.join(marks.select(F.col("node").alias("a"), F.col("parts").alias("parts_a")), "a")
    marked = marked.join(marks.select(F.col("node").alias("b"), F.col("parts").alias("parts_b")), "b")
    likely = materialise(marked.select("a", "b", "parts_a", "parts_b").mapInArrow(_agree, "a binary, b binary"), "likely")
    wanted = likely.select(F.col("a").alias("node")).union(likely.select("b")).distinct()
    wanted = materialise(wanted.join(nodes.select("node", "doc_id"), "node"), "wanted")
    count = wanted.count()
    side = F.broadcast(wanted) if fits(count, 64) else wanted
    sets = docs.select("doc_id", "text").join(side, docs["doc_id"].eqNullSafe(wanted["doc_id"])).select("node", "text")
    sets = sets.mapInArrow(_whole_sets, "node binary, shingles binary")
    # a doc_id may be repeated, and then its set is made for each row
    sets = materialise(sets, "sets").dropDuplicates(["node"])
    full = likely.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a")), "a")
    full = full.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b")), "b")
    return materialise(full.select("a", "b", "set_a", "set_b").mapInArrow(_confirm, "a binary, b binary"), "links")


def _grouped(nodes: DataFrame, roots: DataFrame | None) -> DataFrame:
    """Nodes with the root of their component as ``group``, null without a link. Few links leave the nodes where they lie."""
    if roots is None:
        return nodes.withColumn("group", F.lit(None).cast("binary"))
    side = F.broadcast(roots) if fits(roots.count(), 64) else roots
    return nodes.join(side, "node", "left").withColumnRenamed("root", "group")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, print (hash of the text), n_shingles, root (names the component), component_id, kept.

    Two documents are linked if their sets of 5-word shingles have a Jaccard similarity of 0.75 or more;
    component_id is the least doc_id reachable over links, and kept marks the documents that bear it.
    Documents with equal sets are one node from the start, so copies make no pairs. Nodes are sorted by
    their MinHash signature in 32 orders, and neighbours with a long common prefix are candidates: first
    the next one in 2 orders and in 8, then four on each side in all orders, leaving out pairs that are in one
    component by then. These rounds only save work: last, an exact prefix filter over the rarest shingles
    of each set gives every pair of nodes of different components that can be similar enough, however
    crowded. Candidates whose signatures agree well enough are confirmed on whole sets.

    A pair at the threshold fails the comparison of signatures with a chance of 3e-10; no other is missed.

    A null or empty text has no shingles, is linked with nothing and kept. Repeated rows are copies; rows
    that share a doc_id but not the text are separate documents. A null doc_id counts as the greatest id.
    An empty table gives no rows. Other columns are ignored.
    """
    source = docs.select("doc_id", "text", F.xxhash64("text").alias("print"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = materialise(source.mapInArrow(_sketch(_commonness(docs)), f"doc_id {id_type}, print long, n_shingles long, node binary, parts binary, prefix binary"), "sketches")
    nodes = rows.where("node is not null").groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), *[F.first(c).alias(c) for c in ("n_shingles", "parts", "prefix")]
    )
    nodes = materialise(nodes, "nodes")
    links, roots = None, None
    for search in (*[partial(candidates, trees=trees, reach=reach) for trees, reach in ROUNDS], rest_of_pairs):
        found = _confirmed(docs, nodes, materialise(search(_grouped(nodes, roots)), "candidates"))
        links = found if links is None else links.union(found)
        roots = components(links)
    linked = nodes.select("node", "doc_id").join(roots, "node")
    least = linked.groupBy("root").agg(F.min("doc_id").alias("least"))
    linked = linked.join(least, "root").select("node", "root", "least")
    # copies of an unlinked text have the least doc_id of their node
    every = nodes.select("node", F.col("doc_id").alias("own")).join(linked, "node", "left").select(
        "node", F.coalesce("root", "node").alias("root"), F.when(F.col("root").isNull(), F.col("own")).otherwise(F.col("least")).alias("component_id")
    )
    named = rows.select("doc_id", "print", "n_shingles", "node").join(every, "node", "left")
    named = named.withColumn("component_id", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))
    return named.select("doc_id", "print", "n_shingles", "root", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents, with all their columns, without near-duplicates of one with a smaller doc_id.

    Of rows that share the least doc_id of a group one is kept. Null and empty texts are all kept.
    """
    found = materialise(near_duplicates(docs), "groups").where("n_shingles > 0 and kept")
    copies = found.groupBy("root", F.col("doc_id").alias(ID), F.col("print").alias(PRINT)).agg(F.count("*").alias("copies"))
    chosen = copies.groupBy("root").agg(F.min(F.struct(PRINT, ID, "copies")).alias("x")).select(f"x.{ID}", f"x.{PRINT}", "x.copies")
    chosen = materialise(chosen, "chosen")
    count = chosen.count()
    side = chosen.select(ID, PRINT, (F.col("copies") > 1).alias(AGAIN))
    side = F.broadcast(side) if fits(count, 40) else side
    marked = docs.withColumn("_own" + PRINT, F.xxhash64("text"))
    same = marked["doc_id"].eqNullSafe(side[ID]) & (marked["_own" + PRINT] == side[PRINT])
    joined = marked.join(side, same, "left").drop("_own" + PRINT)
    wordless = F.coalesce(~F.col("text").rlike("[^ \\t-\\r]"), F.lit(True))
    once = joined.where((F.col(AGAIN).isNotNull() & ~F.col(AGAIN)) | wordless)
    kept = once.select(docs.columns)
    if not chosen.where("copies > 1").isEmpty():
        # partial aggregation leaves one of the repeated rows before they are shuffled
        kept = kept.union(joined.where(F.col(AGAIN)).dropDuplicates([ID, PRINT]).select(docs.columns))
    return kept
