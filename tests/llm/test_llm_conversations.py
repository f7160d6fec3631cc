"""Conversation repair against a plain search over all edits."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tenura.llm import conversations as c
from tenura.llm.queries import repaired_conversations

COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}


def harm(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(key.encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def edits_of(faults):
    """Least (cost, edits) for each state after each row, with the lines that they leave."""
    best = {0: (0, "", ())}

    def insert(best):
        for _ in range(3):
            for state, (cost, audit, lines) in list(best.items()):
                new, role = (3, "assistant") if state == 2 else (2, "user")
                step = (cost + 3, audit + "I", (*lines, f"{role}:"))
                if new not in best or step[:2] < best[new][:2]:
                    best[new] = step
        return best

    for role, text, fault in faults:
        after = {}
        for state, (cost, audit, lines) in insert(best).items():
            options = [(state, 4, "D", ())]
            if fault not in ("blank", "duplicate"):
                more = 3 if fault == "truncated" else 0
                made, maker = (3, "assistant") if state == 2 else (2, "user")
                options.append((made, 3 + more, "R", (f"{maker}:{text}",)))
                if (state, role[:1]) in NEXT:
                    options.append((NEXT[state, role[:1]], more, "K", (f"{role}:{text}",)))
            for new, price, letter, line in options:
                step = (cost + price, audit + letter, lines + line)
                if new not in after or step[:2] < after[new][:2]:
                    after[new] = step
        best = after
    return min(x for s, x in insert(best).items() if s in (0, 3))


def brute_force(given):
    rows, out = harm(given), []
    for conv in {r[0] for r in given}:
        own = [r[1:] for r in rows if r[0] == conv]
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).digest()))
        seen, faults = set(), []
        for _, role, text in own:
            visible = re.sub(r"[\x20\x09-\x0D]", "", text)
            fault = "blank" if not visible else "duplicate" if (role, text) in seen else "truncated" if visible[-1] not in ".!?" else ""
            seen.add((role, text))
            faults.append((role, text, fault))
        cost, audit, lines = edits_of(faults)
        turns = {r[0] for r in own} - {None}
        count = [sum(f[2] == name for f in faults) for name in ("blank", "duplicate", "truncated")]
        pairs = [x[0][:1] + y[0][:1] for x, y in zip(faults[:-1], faults[1:])]
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out.append((conv, gaps, *count, sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


def check(spark, rows, parts=7):
    clash = {x: F.lit("x") for x in ("edits", "place", "print", "piece", "c", "k", "id", "times", "number")}
    given = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns(clash).repartition(parts)
    df = repaired_conversations(given, c.damaged(given))
    assert df.columns == COLUMNS
    assert sorted((tuple(r) for r in df.collect()), key=repr) == brute_force(rows)


def some_rows(seed, count, convs):
    rng = random.Random(seed)
    roles = ["system", "user", "user", "assistant", "assistant", "tool", "", None, "admin"]
    texts = ["Yes.", "No", "What?", "  ", "", None, "a.\n ", "é!", ". x", " "]
    return [
        (rng.choice(convs), rng.choice([None, *range(12)]), rng.choice(roles), rng.choice([*texts, f"text {rng.random()}."]))
        for _ in range(count)
    ]


def test_many_short_conversations(spark):
    check(spark, some_rows(1, 400, [None, *range(60)]))


def test_one_conversation_holds_most_rows(spark):
    rng = random.Random(2)
    long = [(7, t, rng.choice(["user", "assistant"]), f"{t}{rng.choice('.!?x')}") for t in range(3_000)]
    long += [(7, t, "user", f"{t}x") for t in range(3_000, 9_500)] + [(7, 10_000, "user", "again.")] * 500
    check(spark, long + some_rows(3, 60, [1, 2, 9]), parts=11)


def test_rows_that_all_go(spark):
    dropped = next(t for t in range(100) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    check(spark, [(5, dropped, "user", "x."), (6, None, None, None), (8, 1, "user", " "), (8, 2, "user", "")])


def test_empty_table(spark):
    check(spark, [])


@pytest.mark.parametrize("symbol", range(9))
@pytest.mark.parametrize("count", [0, 1, 2, 7, 100])
def test_powers_are_repeated_steps(symbol, count):
    want = c.END
    for _ in range(count):
        want = c.applied(c.power(symbol, 0), want)
    assert c.ahead(symbol, count, c.END) == want
    assert c.applied(c.transition(((symbol, count),)), c.END) == want


def test_pieces_join_to_the_whole():
    rng = random.Random(4)
    runs = [(rng.randrange(9), rng.randrange(1, 9)) for _ in range(40)]
    whole = c.unroll(runs, c.START, c.END, True)
    behind = c.applied(c.transition(tuple(runs[17:])), c.END)
    edits, cost, state = c.unroll(runs[:17], c.START, behind, False)
    rest, more, _ = c.unroll(runs[17:], state, c.END, True)
    assert (edits + rest, cost + more) == whole[:2]


def test_repaired_rows_are_legal(spark, folder):
    given = spark.read.parquet(f"{folder}/conversations.parquet")
    rows = c.damaged(given)
    done = c.repair(rows, c.audit(rows))
    initials = done.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("place", F.substring("role", 1, 1).alias("r")))).alias("x"))
    assert all(re.fullmatch("s?(ua)+", "".join(p.r for p in r.x)) for r in initials.collect())
