"""Repair of conversation structure: the cheapest edits to legal turns, by a run-length dynamic program in min-plus algebra."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tenura.llm.common import materialise, partitions

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: States of the form (s?(ua)+)?: nothing yet, after s, after u, after a. It may end in the first and the last.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
STATES = range(4)
NEVER = 1 << 60
#: The state after a row of each initial (s, u, a, any other), or None where the form forbids it.
KEEPS = {
    START: (AFTER_S, AFTER_U, None, None), AFTER_S: (None, AFTER_U, None, None),
    AFTER_U: (None, None, AFTER_A, None), AFTER_A: (None, AFTER_U, None, None),
}
#: The state after a row that may be given a role: a user, or behind a user an assistant.
MADE = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)
MADE_ROLE = ("user", "user", "assistant", "user")
#: Symbols: twice the place of the initial, one more if truncated; the last one is a row that must go.
GOES = 8
#: Rows whose choices are unrolled at a time, and runs that a task holds of one conversation.
BLOCK = 4_096
PIECE_RUNS = 1 << 20
SOLVED = 1 << 16
ORDER = ("conv_id", "turn", "role", "print")

Vector = tuple[int, int, int, int]
Matrix = tuple[Vector, Vector, Vector, Vector]
#: Cost of ending here: what is missing is inserted.
END: Vector = (0, 2 * INSERT, INSERT, 0)


def product(x: Matrix, y: Matrix) -> Matrix:
    return tuple(tuple(min(x[i][k] + y[k][j] for k in STATES) for j in STATES) for i in STATES)


def applied(x: Matrix, v: Vector) -> Vector:
    a, b, c, d = v
    return tuple(min(r[0] + a, r[1] + b, r[2] + c, r[3] + d) for r in x)


UNIT: Matrix = tuple(tuple(0 if i == j else NEVER for j in STATES) for i in STATES)


def _inserts() -> Matrix:
    """Cheapest insertions from one state to another, none included."""
    step = [list(row) for row in UNIT]
    for state in STATES:
        step[state][MADE[state]] = min(step[state][MADE[state]], INSERT)
    once = tuple(map(tuple, step))
    return product(product(once, once), once)


INSERTS = _inserts()


@lru_cache(maxsize=None)
def row_costs(symbol: int) -> tuple[tuple[int, int, int], tuple[int | None, ...]]:
    """Costs of deleting, keeping and giving another role, and the states that keeping leads to."""
    if symbol == GOES:
        return (DELETE, NEVER, NEVER), (None,) * 4
    more = TRUNCATED * (symbol % 2)
    return (DELETE, more, REROLE + more), tuple(KEEPS[s][symbol // 2] for s in STATES)


@lru_cache(maxsize=None)
def power(symbol: int, bit: int) -> Matrix:
    """Transition of 2 to the power of ``bit`` equal rows, each with any insertions before it."""
    if bit:
        half = power(symbol, bit - 1)
        return product(half, half)
    (delete, keep, rerole), kept = row_costs(symbol)
    step = [[NEVER] * 4 for _ in STATES]
    for state in STATES:
        step[state][state] = delete
        step[state][MADE[state]] = min(step[state][MADE[state]], rerole)
        if kept[state] is not None:
            step[state][kept[state]] = min(step[state][kept[state]], keep)
    return product(INSERTS, tuple(map(tuple, step)))


def ahead(symbol: int, count: int, after: Vector) -> Vector:
    """Cost to the end from each state before a run of equal rows, given that after it."""
    bit = 0
    while count >> bit:
        if count >> bit & 1:
            after = applied(power(symbol, bit), after)
        bit += 1
    return after


@lru_cache(maxsize=SOLVED)
def transition(runs: tuple[tuple[int, int], ...]) -> Matrix:
    """Transition of a piece of a conversation; pieces are multiplied in order."""
    whole = UNIT
    for symbol, count in runs:
        for bit in range(count.bit_length()):
            if count >> bit & 1:
                whole = product(whole, power(symbol, bit))
    return whole


def unroll(runs: list[tuple[int, int]], state: int, after: Vector, last: bool) -> tuple[str, int, int]:
    """The least of the cheapest edits of a piece that begins in ``state``, its costs, and the state behind it.

    Costs at the borders of runs, and of blocks inside long runs, come from powers; the rows of one block at
    a time are stepped through.
    """
    borders = [after]
    for symbol, count in reversed(runs):
        borders.append(ahead(symbol, count, borders[-1]))
    borders.reverse()
    first, begin, edits = borders[0], state, []
    for (symbol, count), behind in zip(runs, borders[1:]):
        for done in range(0, count, BLOCK):
            size = min(BLOCK, count - done)
            costs = [ahead(symbol, count - done - size, behind)]
            for _ in range(size):
                costs.append(applied(power(symbol, 0), costs[-1]))
            costs.reverse()
            for here, there in zip(costs[:-1], costs[1:]):
                state = _edit(symbol, state, here, there, edits)
    while last and state not in (START, AFTER_A):
        edits.append("I")
        state = MADE[state]
    return "".join(edits), first[begin] - (0 if last else after[state]), state


def _edit(symbol: int, state: int, here: Vector, there: Vector, edits: list[str]) -> int:
    """Add the edits of one row, the least letters first, and return the state behind it."""
    (delete, keep, rerole), kept = row_costs(symbol)
    while True:
        made, cost = MADE[state], here[state]
        if cost == delete + there[state]:
            edits.append("D")
            return state
        if cost == INSERT + here[made]:
            edits.append("I")
            state = made
        elif kept[state] is not None and cost == keep + there[kept[state]]:
            edits.append("K")
            return kept[state]
        else:
            edits.append("R")
            return made


@lru_cache(maxsize=SOLVED)
def solved(runs: tuple[tuple[int, int], ...]) -> tuple[str, int]:
    """Edits and cost of a whole conversation."""
    edits, cost, _ = unroll(list(runs), START, END, True)
    return edits, cost


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows conv_id, turn, role, text after a repeatable damage; null role and text are one space.

    By crc32 of "conv_id:turn" (nulls: a space) modulo 20: 0 drops the row, 1 empties the text, 2 takes out full
    stops, exclamation and question marks, 3 repeats the row, 4 makes it the user's.
    """
    def given(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.pmod(F.crc32(F.concat(given("conv_id"), F.lit(":"), given("turn")).cast("binary")), F.lit(20))
    rows = conversations.select("conv_id", "turn", given("role").alias("role"), given("text").alias("text"), kind.alias("kind")).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("time")).drop("time")


def _printed(rows: DataFrame) -> DataFrame:
    given = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]
    return rows.select("conv_id", "turn", *given).withColumn("print", F.unhex(F.md5("text")))


def cells(rows: DataFrame) -> DataFrame:
    """Equal rows of one turn with their number and whether they hold the first row of that role and text.

    Only digests of texts are grouped, and added up before they are shuffled. The first turn of a role and text
    is joined back on the whole key of a cell, which is unique, so a text that recurs without end is no hot key.
    """
    last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    light = _printed(rows).select(*ORDER, (last == "").alias("blank"), (~last.isin(".", "!", "?")).alias("open"))
    found = materialise(light.groupBy(*ORDER, "blank", "open").agg(F.count("*").alias("times")), "cells")
    turns = found.groupBy("conv_id", "role", "print").agg(F.min("turn").alias("least"), F.max(F.col("turn").isNull()).alias("any_null"))
    firsts = turns.select(F.col("conv_id").alias("c"), F.when(~F.col("any_null"), F.col("least")).alias("t"), F.col("role").alias("r"), F.col("print").alias("p"))
    same = found["conv_id"].eqNullSafe(firsts["c"]) & found["turn"].eqNullSafe(firsts["t"]) & (found["role"] == firsts["r"]) & (found["print"] == firsts["p"])
    return found.join(firsts, same, "left").select(*ORDER, "blank", "open", "times", firsts["r"].isNotNull().alias("first"))


PIECE = (
    "conv_id {0}, piece long, symbols array<int>, lengths array<long>, blank long, duplicate long, truncated long, illegal long, "
    "first string, last string, matrix array<long>"
)
COUNTS = ("blank", "duplicate", "truncated", "illegal")
LEGAL = ("su", "ua", "au")


def _place(initial: str) -> int:
    return "sua".find(initial) if initial in ("s", "u", "a") else 3


class _Piece:
    """Rows of one conversation that one task meets in a run."""

    def __init__(self, conv_id, number: int):
        self.conv_id, self.number = conv_id, number
        self.runs: list[list[int]] = []
        self.counts = dict.fromkeys(COUNTS, 0)
        self.first = self.last = None

    def _rows(self, symbol: int, times: int) -> None:
        if times and self.runs and self.runs[-1][0] == symbol:
            self.runs[-1][1] += times
        elif times:
            self.runs.append([symbol, times])

    def add(self, cell: dict) -> None:
        times, initial = cell["times"], cell["role"][:1]
        if self.last is None:
            self.first = initial
        else:
            self.counts["illegal"] += self.last + initial not in LEGAL
        self.counts["illegal"] += times - 1
        self.last = initial
        if cell["blank"]:
            self.counts["blank"] += times
        else:
            again = times - cell["first"]
            self.counts["duplicate"] += again
            if cell["first"]:
                self.counts["truncated"] += cell["open"]
                self._rows(2 * _place(initial) + cell["open"], 1)
            times = again
        self._rows(GOES, times)

    def row(self) -> dict:
        matrix = [x for row in transition(tuple(map(tuple, self.runs))) for x in row]
        return {
            "conv_id": self.conv_id, "piece": self.number, "symbols": [r[0] for r in self.runs], "lengths": [r[1] for r in self.runs],
            **self.counts, "first": self.first, "last": self.last, "matrix": matrix,
        }


def _pieces(id_type: pa.DataType) -> Callable:
    """Each conversation's rows in this partition as runs of symbols, with the transition of the whole piece."""
    schema = pa.schema(
        [("conv_id", id_type), ("piece", pa.int64()), ("symbols", pa.list_(pa.int32())), ("lengths", pa.list_(pa.int64()))]
        + [(c, pa.int64()) for c in COUNTS] + [("first", pa.string()), ("last", pa.string()), ("matrix", pa.list_(pa.int64()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, done, piece = TaskContext.get().partitionId() << 32, [], None
        for batch in batches:
            for cell in batch.to_pylist():
                if piece is None or piece.conv_id != cell["conv_id"] or len(piece.runs) >= PIECE_RUNS:
                    if piece is not None:
                        done.append(piece.row())
                        number += 1
                    piece = _Piece(cell["conv_id"], number)
                piece.add(cell)
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=schema)
                done = []
        if piece is not None:
            yield pa.RecordBatch.from_pylist([piece.row()], schema=schema)

    return run


def _runs(row: dict) -> list[tuple[int, int]]:
    return list(zip(row["symbols"], row["lengths"]))


def _repeated(column: pa.ChunkedArray, rows: int) -> pa.Array:
    return column.slice(0, 1).combine_chunks().take(pa.array([0] * rows, pa.int64()))


def _seams(pieces: pa.Table) -> pa.Table:
    """For the pieces of one conversation the costs behind each, and illegal pairs across its beginning."""
    rows = pieces.sort_by("piece").to_pylist()
    after = [END]
    for row in reversed(rows):
        m = row["matrix"]
        after.append(applied(tuple(tuple(m[4 * i : 4 * i + 4]) for i in STATES), after[-1]))
    after.reverse()
    return pa.table(
        {
            "number": pa.array([r["piece"] for r in rows], pa.int64()),
            "behind": pa.array([list(v) for v in after[1:]], pa.list_(pa.int64())),
            "final": pa.array([i == len(rows) - 1 for i in range(len(rows))]),
            "seam": pa.array([0] + [int(x["last"] + y["first"] not in LEGAL) for x, y in zip(rows[:-1], rows[1:])], pa.int64()),
        }
    )


def _variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edits, cost and last state of a piece for each state it may begin in."""
    for batch in batches:
        for row in range(batch.num_rows):
            one = batch.slice(row, 1)
            cell = one.select(["symbols", "lengths", "behind", "final"]).to_pylist()[0]
            edits, costs, ends = zip(*[unroll(_runs(cell), s, tuple(cell["behind"]), cell["final"]) for s in STATES])
            yield pa.RecordBatch.from_arrays(
                [*[one.column(c) for c in ("conv_id", "piece", *COUNTS)], pa.array([edits], pa.list_(pa.string())), pa.array([costs], pa.list_(pa.int64())), pa.array([ends], pa.list_(pa.int64()))],
                names=["conv_id", "piece", *COUNTS, "edits", "costs", "ends"],
            )


def _folded(pieces: pa.Table) -> pa.Table:
    """One conversation from its pieces: each is entered in the state that the one before it is left in."""
    state, cost, audit = START, 0, []
    for row in pieces.sort_by("piece").select(["edits", "costs", "ends"]).to_pylist():
        audit.append(row["edits"][state])
        cost += row["costs"][state]
        state = row["ends"][state]
    counts = [pa.array([sum(pieces.column(c).to_pylist())], pa.int64()) for c in COUNTS]
    return pa.table([_repeated(pieces.column("conv_id"), 1), *counts, pa.array([cost], pa.int64()), pa.array(["".join(audit)])], names=["conv_id", *COUNTS, "cost", "audit"])


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [solved(tuple(_runs(r))) for r in batch.select(["symbols", "lengths"]).to_pylist()]
        kept = [batch.column(c) for c in ("conv_id", *COUNTS)]
        yield pa.RecordBatch.from_arrays([*kept, pa.array([c for _, c in found], pa.int64()), pa.array([a for a, _ in found], pa.string())], names=["conv_id", *COUNTS, "cost", "audit"])


def _arrow_type(rows: DataFrame) -> pa.DataType:
    return to_arrow_type(rows.schema["conv_id"].dataType)


def audit(rows: DataFrame) -> DataFrame:
    """Faults and cheapest edits of every conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit.

    ``rows`` has conv_id, turn, role and text. A conversation's rows stand in the order of turn (nulls first), then
    role and a hash of the text. Each row has one fault at most: blank (no visible character), duplicate (role and text
    seen before), truncated (the last visible character is no ``.``, ``!`` or ``?``). gaps are the turns that
    lack between the least and the greatest; illegal counts neighbours whose initials are not su, ua or au. ``audit`` is the
    least of the cheapest lists of edits that make the initials (s?(ua)+)?: K keeps a row, R (3) makes it the user's or
    the assistant's, D (4) deletes it, as blank and duplicate rows must be, I (3) inserts an empty row; a truncated
    row that stays costs 3 more.

    Rows are dealt by ranges of that order, so a long conversation is shared by many tasks: equal
    symbols are runs, a piece of a conversation is a min-plus product of powers, pieces are joined by
    their products, and each is unrolled for every state that it may begin in. Only the edits of a
    conversation, a letter a row, meet in the end.

    Null role and text are one space; a null conv_id is a conversation, null turns come first and make no gap. Repeated rows
    are duplicates. An empty table gives no rows. Other columns are ignored.
    """
    spark = rows.sparkSession
    id_type = rows.schema["conv_id"].dataType.simpleString()
    found = materialise(cells(rows), "ordered-cells")
    order = [F.col(c).asc_nulls_first() for c in ORDER]
    ranged = found.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
    pieces = materialise(ranged.select("conv_id", "role", "blank", "open", "times", "first").mapInArrow(_pieces(_arrow_type(rows)), PIECE.format(id_type)), "pieces")
    # at most as many as there are borders between partitions, and pieces closed for their length
    split = F.broadcast(pieces.groupBy(F.col("conv_id").alias("c")).agg(F.count("*").alias("k")).where("k > 1"))
    several = pieces["conv_id"].eqNullSafe(split["c"])
    parts = pieces.join(split, several).drop("c", "k")
    seams = parts.select("conv_id", "piece", "first", "last", "matrix").groupBy("conv_id").applyInArrow(_seams, "number long, behind array<long>, final boolean, seam long")
    joined = parts.join(seams, parts["piece"] == seams["number"]).withColumn("illegal", F.col("illegal") + F.col("seam"))
    kind = f"conv_id {id_type}, blank long, duplicate long, truncated long, illegal long"
    unrolled = joined.select("conv_id", "piece", *COUNTS, "symbols", "lengths", "behind", "final").mapInArrow(
        _variants, f"conv_id {id_type}, piece long, blank long, duplicate long, truncated long, illegal long, edits array<string>, costs array<long>, ends array<long>"
    )
    kind += ", cost long, audit string"
    long_ones = unrolled.groupBy("conv_id").applyInArrow(_folded, kind)
    short_ones = pieces.join(split, several, "left_anti").select("conv_id", *COUNTS, "symbols", "lengths").mapInArrow(_solve, kind)
    turns = found.groupBy(F.col("conv_id").alias("c")).agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps")
    )
    every = short_ones.union(long_ones)
    return materialise(every.join(turns, every["conv_id"].eqNullSafe(turns["c"])).select("conv_id", "gaps", *COUNTS, "cost", "audit"), "audits")


REPAIRED = "conv_id {0}, place long, edit string, turn {1}, role string, text string"


def _repair(schema: pa.Schema) -> Callable:
    """Follow each conversation's edits, which come in its first row, along the rows behind it."""
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv_id = edits = None
        at = place = 0
        state = START
        out: list[tuple] = []

        def insert_all() -> None:
            nonlocal at, place, state
            while edits is not None and at < len(edits) and edits[at] == "I":
                out.append((conv_id, place, "I", None, MADE_ROLE[state], ""))
                state, at, place = MADE[state], at + 1, place + 1

        for batch in batches:
            for row in batch.to_pylist():
                if row["edits"] is not None:
                    conv_id, edits, at, place, state = row["conv_id"], row["edits"], 0, 0, START
                    insert_all()
                    continue
                edit, role = edits[at], row["role"]
                at += 1
                if edit == "K":
                    state = KEEPS[state][_place(role[:1])]
                elif edit == "R":
                    role, state = MADE_ROLE[state], MADE[state]
                if edit != "D":
                    out.append((conv_id, place, edit, row["turn"], role, row["text"]))
                    place += 1
                insert_all()
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], schema.field(i).type) for i in range(len(names))], names=names)
                out = []

    return run


def repair(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """The repaired rows: conv_id, place, edit (K, R or I), turn, role, text.

    Each conversation's rows come one after the other in one partition, as a stream behind their edits; memory
    does not grow with a conversation. Treats nulls and ties as `audit` does; inserted rows have no turn.
    """
    texts = _printed(rows)
    id_type, turn_type = (rows.schema[c].dataType.simpleString() for c in ("conv_id", "turn"))
    heads = audits.select("conv_id", F.lit(None).cast(turn_type).alias("turn"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"), F.lit(None).cast("binary").alias("print"), F.col("audit").alias("edits"))
    every = heads.union(texts.withColumn("edits", F.lit(None).cast("string")))
    # nulls come first, and a head has neither role nor print
    order = [F.col("conv_id").asc_nulls_first(), F.col("edits").isNull(), *[F.col(c).asc_nulls_first() for c in ORDER[1:]]]
    dealt = every.repartition(partitions(rows.sparkSession), "conv_id").sortWithinPartitions(*order).select("conv_id", "turn", "role", "text", "edits")
    kinds = [_arrow_type(rows), pa.int64(), pa.string(), to_arrow_type(rows.schema["turn"].dataType), pa.string(), pa.string()]
    schema = pa.schema(list(zip(("conv_id", "place", "edit", "turn", "role", "text"), kinds)))
    return dealt.mapInArrow(_repair(schema), REPAIRED.format(id_type, turn_type))


def _digest(id_type: pa.DataType) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state, done = None, None, []

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], id_type), pa.array([d[1] for d in done], pa.string())], names=["conv_id", "digest"])

        for batch in batches:
            for conv_id, place, role, text in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "place", "role", "text")]):
                if place == 0:
                    if state is not None:
                        done.append((current, state.hexdigest()))
                    current, state = conv_id, hashlib.sha256()
                state.update(f"{chr(10) if place else ''}{role}:{text}".encode())
            if done:
                yield out()
                done = []
        if state is not None:
            done.append((current, state.hexdigest()))
            yield out()

    return run


def digests(repaired: DataFrame) -> DataFrame:
    """conv_id and digest (SHA-256 of the lines ``role:text``) of what `repair` returns, in its order.

    A digest is made byte after byte, so one conversation's text passes through one task, as a stream.
    """
    kind = repaired.schema["conv_id"].dataType.simpleString()
    return repaired.select("conv_id", "place", "role", "text").mapInArrow(_digest(_arrow_type(repaired)), f"conv_id {kind}, digest string")
