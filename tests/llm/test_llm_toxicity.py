"""Toxicity: the kernel against a plain one, the machine against its parts, and scores on held-out texts."""

import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tenura.llm import toxicity as t
from tenura.llm.arrow import raw
from tenura.llm.queries import QUERIES

SYLLABLES = ["ka", "lo", "mi", "ren", "tu", "sa", "vel", "dor", "ni", "pe", "gor", "hal"]
INSULTS = ["idiot", "pathetic", "scumbag", "moron"]


def of(*texts):
    return t.segments(*raw(pa.array(texts)))


def letters(name):
    return [(i, c) for i, c in enumerate(name) if c]


def plain_kernel(x, y):
    """Common subsequences of four letters over all choices of places."""

    def parts(name):
        found = {}
        for four in itertools.combinations(letters(name), 4):
            span = four[-1][0] - four[0][0] + 1
            if span <= t.SPAN:
                found.setdefault(tuple(c for _, c in four), []).append(t.DECAY**span)
        return found

    def length(found):
        return sum(w * w for ws in found.values() for w in ws) ** 0.5 or 1

    one, two = parts(x), parts(y)
    return sum(sum(one[k]) * sum(two[k]) for k in one.keys() & two.keys()) / length(one) / length(two)


def test_kernel_is_the_plain_one():
    names = t.canonical(of("idiot i.d.i.o.t iddiot stupid barbarbar ab chón worthless $tup1d"))
    x = t.space(names)
    got = np.stack([x.kernel(i) for i in range(x.count)])
    want = np.array([[plain_kernel(a, b) for a in names] for b in names])
    assert np.allclose(got, want, atol=1e-6)


def test_segments():
    s = of("You i d i o t, and", None, "", "x" * 80)
    shown = [bytes(96 + c if c else 46 for c in n).decode() for n in t.canonical(s)]
    assert shown[:3] == ["you", "i.d.i.o.t", "and"] and set(s.text.tolist()) == {0, 3}
    assert [len(n) for n in shown[3:]] == [32, 32, 16, 16, 32, 32]
    again = t.restored(t.canonical(s))
    assert t.canonical(again) == t.canonical(s)


def test_features_give_the_kernel_and_the_sum_over_landmarks_is_the_decision():
    names = sorted(set(t.canonical(of("idiot pathetic scumbag moron there nothing together another stationary motor scuba path"))))
    target = np.array([1.0 if i % 3 == 0 else -1.0 for i in range(len(names))])
    x = t.space(names)
    features, chosen = t.landmarks(x, np.ones(len(names)), 64)
    kernel = np.stack([x.kernel(i) for i in range(x.count)])
    assert np.allclose(features @ features.T, kernel, atol=1e-2)
    v, bias = t.separate(features, target, np.ones(len(names)))
    weights, same = t.machine(names, target, np.ones(len(names)), 64)
    assert same == pytest.approx(bias)
    assert np.allclose(t.decisions(weights, bias, t.restored(names)), features @ v + bias, atol=1e-3)


def test_inserted_and_parted_letters_change_little():
    names = t.canonical(of("idiot pathetic scumbag moron there nothing together another stationary motor scuba path"))
    weights, bias = t.machine(names, np.array([1.0] * 4 + [-1.0] * (len(names) - 4)), np.ones(len(names)))
    got = t.decisions(weights, bias, of("IDIOT i.d.i.o.t i d i o t idxiot m0ron pathhetic mother stationary"))
    assert (got[:6] > 0).all() and (got[6:] < 0).all()


def text(rng, insult=None):
    words = ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(rng.randint(8, 60))]
    if insult:
        words.insert(rng.randrange(len(words)), insult)
    return " ".join(words) + "."


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(13)
    rows = [(i, text(rng, rng.choice(INSULTS) if i % 6 == 0 else None), int(i % 6 == 0)) for i in range(1_200)]
    return rows, spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"), spark.createDataFrame([(r[0], 1, r[2]) for r in rows], "doc_id long, quality int, toxic int")


def test_held_out_documents(corpus):
    rows, docs, labels = corpus
    got = {r.doc_id: r for r in t.score_toxicity(docs, labels).collect()}
    truth = {r[0]: r[2] for r in rows}
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1
    unseen = [r for r in got.values() if r.held_out]
    assert len(unseen) > 200
    assert sum(r.predicted != truth[r.doc_id] for r in unseen) <= 0.02 * len(unseen)
    assert all(r.segment.strip(".") in INSULTS for r in unseen if r.predicted and truth[r.doc_id])


def test_held_out_labels_are_not_seen(corpus):
    _, docs, labels = corpus
    turned = labels.withColumn("toxic", F.when(t.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = ({r.doc_id: r.score for r in t.score_toxicity(docs, x).collect()} for x in (labels, turned))
    assert one == two


def test_nulls_long_texts_repeats_and_clashing_columns(spark, corpus):
    _, docs, labels = corpus
    odd = [(90_001, None), (90_002, ""), (90_003, "idiot"), (90_003, "idiot"), (None, "you moron"), (90_004, "kalo " * 60_000 + "scumbag"), (90_005, "x" * 100_000), (90_006, "... 你好 \U0001f600")]
    every = docs.union(spark.createDataFrame(odd, docs.schema)).withColumns({c: F.lit("x") for c in ("toxic", "id", "score", "segment")}).repartition(6)
    more = labels.union(spark.createDataFrame([(90_001, None, None), (None, None, 1), (0, 1, 0), (0, 1, 1)], labels.schema)).withColumn("text", F.lit("y"))
    got = t.score_toxicity(every, more).where("doc_id >= 90000 or doc_id is null").orderBy("doc_id", "score").collect()
    assert len(got) == len(odd)
    by = {r.doc_id: r for r in got}
    assert by[90_001].score == by[90_002].score == by[90_006].score and by[90_001].predicted == 0
    assert by[90_003].predicted == by[None].predicted == by[90_004].predicted == 1 and by[90_005].predicted == 0


def test_without_labels_or_rows(spark, corpus):
    _, docs, labels = corpus
    assert {(r.score < 1e-9, r.predicted) for r in t.score_toxicity(docs.limit(9), labels.limit(0)).collect()} == {(True, 0)}
    assert {r.predicted for r in t.score_toxicity(docs.limit(9), labels.where("toxic = 1")).collect()} == {1}
    assert t.score_toxicity(docs.limit(0), labels).collect() == []


def test_registered_query(spark, folder):
    df = QUERIES["op13_toxicity"](spark, folder)
    assert df.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    assert df.count() == spark.read.parquet(f"{folder}/documents.parquet").count()
