"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns."""

import collections
import hashlib
import pathlib
import random
import re
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tenura.llm import bytewords, common, components, decontaminate, dedup, language, packing, pii, quality, sharding, token_counts, token_output, tokens, topk
from tenura.llm.arrow import raw
from tenura.llm.queries import BYTE_BPE
from tenura.session import fresh_path, shared_dir

PATH = public_tokenizers.path(BYTE_BPE)
TOKENIZER = Tokenizer.from_file(PATH)
SCHEMA = "doc_id long, text string, lang string, size int, row string, n_words string, score string, key string, part string"


def words(seed, count):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(count))


TEXTS = [
    (1, None), (2, ""), (3, "one"), (4, "two  spaces and\ttabs \n mixed \n"), (5, words(5, 30_000)), (6, "x" * 200_000),
    (7, words(7, 40)), (7, words(7, 40)), (8, words(7, 40).upper()), (9, "ÄÖÜ ñandú 漢字 🎉 <|endoftext|> mail a.b@c.example.org 2001-02-03"),
    (10, "   "), (None, words(11, 12)), (12, " lead and trail "), (13, "a   b  c\x1c d\x85 e"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(d, t, random.Random(i).choice(["en", None]), 1, "r", "n", "s", "k", "p") for i, (d, t) in enumerate(TEXTS)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


def crc(numbers):
    return zlib.crc32(np.array(numbers, "<u4").tobytes())


def encoded(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("seed", range(6))
def test_encoder_equals_the_library(seed):
    rng = random.Random(seed)
    pieces = ["foo", "Bar", " ", "  ", "\n", "\t", " \n", "'s", "12", "é", "漢", "<|endoftext|>", " ", "\x1c", "\x85", ".", "!?", "🎉", " ", "\r\n"]
    texts = ["".join(rng.choices(pieces, k=rng.randint(0, 12))) for _ in range(3000)]
    tool = tokens.Encoder(tokens.read_spec(PATH))
    flat, counts = tool.encode(pa.array(texts))
    want = [encoded(t) for t in texts]
    assert counts.tolist() == [len(x) for x in want] and flat.tolist() == [i for x in want for i in x]


def test_encoder_forgets_and_goes_on():
    tool = tokens.Encoder(tokens.read_spec(PATH), kept_words=10)
    for seed in range(5):
        text = words(seed, 50)
        assert tool.encode(pa.array([text, None]))[0].tolist() == encoded(text)


@pytest.mark.parametrize("plain", [False, True])
def test_encoder_cuts_where_ids_stay_the_same(plain):
    rng = random.Random(7)
    blanks = " \n\t\r\x0b\x1c\x85\xa0\u1680\u180e\u2003\u2028\u202f\u205f\u3000"
    pieces = [*blanks, " ", " ", "\n", "\n", *".,'!<|>_-\"", "a", "Zo", "7", "'s", "'LL", "é", "×", "÷", "ÿ", "ſ", "ƿ", "ж", "\u0301", "²", "“", "。", "中", "🎉", "\x00", "\x7f", "<|endoftext|>"]
    texts = ["".join(rng.choices(pieces, k=rng.randint(0, 9))) for _ in range(4000)]
    tool, library = tokens.Encoder(tokens.read_spec(PATH), 2000, plain), Tokenizer.from_file(PATH)
    library.encode_special_tokens = plain
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    for at in range(0, len(texts), 500):
        flat, counts = tool.encode(pa.array(texts[at : at + 500]))
        assert counts.tolist() == [len(x) for x in want[at : at + 500]]
        assert flat.tolist() == [i for x in want[at : at + 500] for i in x]


def test_words_are_known_whatever_stands_beside_them():
    names = sorted({*words(3, 400).split()} - {""})[:40]
    names = [w for w in names if w.isascii() and w.isalpha()] + ["Haus", "été", "Wort"]
    tool = tokens.Encoder(tokens.read_spec(PATH))
    text = " ".join(f"{a}{mark}\n{b}" for a in names for b in names for mark in (".", ",", "***"))
    assert tool.encode(pa.array([text]))[0].tolist() == encoded(text)
    assert tool.entries < 4 * len(names) + 10


def test_words_met_again_outlive_a_small_slice():
    tool = tokens.Encoder(tokens.read_spec(PATH), kept_words=300)
    usual, rare = [f"usual{i}x" for i in range(50)], [f"rare{i}x" for i in range(400)]
    for text in (usual, usual, rare, ["one"]):
        text = " ".join(text)
        assert tool.encode(pa.array([text]))[0].tolist() == encoded(text)
    assert {f" {w}" for w in usual[1:]} <= tool.known.keys() and len(tool.known) < 100


def test_other_tokenizers_go_to_the_library_whole():
    path = public_tokenizers.path("word_bpe_49k.json")
    tool, library = tokens.Encoder(tokens.read_spec(path)), Tokenizer.from_file(path)
    assert not tool.by_words
    texts = ["Hello  World", "", "x y"]
    flat, counts = tool.encode(pa.array(texts))
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert flat.tolist() == [i for x in want for i in x] and counts.tolist() == [len(x) for x in want]


@pytest.mark.parametrize(("step", "overlap"), [(1000, 64), (37, 5), (1 << 15, 512)])
def test_token_counts(docs, step, overlap):
    rows = token_counts.count_tokens(docs, PATH, step=step, overlap=overlap).collect()
    want = collections.Counter((d, len((t or "").encode()), len(encoded(t))) for d, t in TEXTS)
    assert collections.Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in rows) == want


def test_token_counts_empty(empty):
    assert token_counts.count_tokens(empty, PATH).count() == 0


def test_token_files(spark, docs, empty):
    path = fresh_path(spark, "t")
    token_output.write_tokens(docs, PATH, path)
    rows = sorted(token_output.read_tokens(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted((d for d, _ in TEXTS), key=lambda d: (d is not None, d))
    start = 0
    for r in rows:
        assert r.start == start
        start += r.n_tokens
    assert collections.Counter((r.doc_id, zlib.crc32(r.ids)) for r in rows) == collections.Counter((d, crc([*encoded(t), 2])) for d, t in TEXTS)
    path = fresh_path(spark, "t")
    token_output.write_tokens(empty, PATH, path)
    assert token_output.read_tokens(spark, path).count() == 0


def test_coding_round_trip():
    rng = np.random.default_rng(0)
    runs = [rng.integers(0, 1 << bits, size) for bits, size in ((4, 1), (8, 7), (16, 100), (24, 5), (31, 33), (1, 0))]
    coded = [token_output.code(x) for x in runs]
    counts = np.array([len(x) for x in runs])
    # many documents at once give the same bytes
    assert token_output.code(np.concatenate(runs), counts) == tuple(b"".join(x) for x in zip(*coded))
    back = token_output.decode(b"".join(c for c, _ in coded), b"".join(d for _, d in coded), counts)
    assert back.tolist() == np.concatenate(runs).tolist()
    with pytest.raises(ValueError):
        token_output.decode(coded[2][0], coded[2][1][:-1], counts[2:3])


def test_coding_holds_few_bytes_for_an_id():
    rng = np.random.default_rng(2)
    counts = rng.integers(0, 900, 1000)
    ranks = np.minimum(rng.zipf(1.2, counts.sum()), 50_000).astype(np.uint32)
    tracemalloc.start()
    coded = token_output.code(ranks, counts)
    most = [tracemalloc.get_traced_memory()[1]]
    tracemalloc.reset_peak()
    back = token_output.decode(*coded, counts)
    most.append(tracemalloc.get_traced_memory()[1])
    tracemalloc.stop()
    assert back.tolist() == ranks.tolist()
    assert most[0] < 16 * len(ranks) and most[1] < 32 * len(ranks)


def test_packing(docs, empty):
    rows = packing.pack(docs, PATH).collect()
    pieces = collections.defaultdict(bytes)
    assert sum(r.length for r in rows) == sum(len(encoded(t)) + 1 for _, t in TEXTS)
    for r in sorted(rows, key=lambda r: r.start):
        if r.doc_id != 7:
            pieces[r.doc_id] += bytes(r.ids)
    for d, t in TEXTS:
        if d != 7:
            assert pieces[d] == np.array([*encoded(t), 0], "<u4").tobytes()
    assert packing.pack(empty, PATH).count() == 0
    with pytest.raises(ValueError):
        packing.pack(docs, PATH, tiers=(100,))


def test_sharding(docs, empty):
    rows = sharding.shard_documents(docs, sharding.tree(16), sharding.tree(17)).collect()
    assert sorted((r.size, r.text_crc32) for r in rows) == sorted((len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for _, t in TEXTS)
    for shard in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(sum(r.shard == shard for r in rows)))
    assert len({r.shard for r in rows if r.doc_id == 7}) == 1
    assert sharding.shard_documents(empty, sharding.tree(16)).count() == 0


def test_one_doc_id_for_all_rows(spark):
    same = spark.range(3000).select(F.lit(5).cast("long").alias("doc_id"), F.lit("same").alias("text"))
    rows = sharding.shard_documents(same, sharding.tree(16)).collect()
    assert len({r.shard for r in rows}) == 1 and sorted(r.slot for r in rows) == list(range(3000))


def test_shards_are_written_in_few_files_whatever_the_number_of_ranges(spark):
    docs = spark.range(4000).select((F.col("id") * 7 % 3900).alias("doc_id"), F.repeat(F.lit("ä"), (F.col("id") % 9).cast("int")).alias("text"))
    few = sorted(map(tuple, sharding.shard_documents(docs, sharding.tree(16), sharding.tree(17)).collect()))
    folder, before = pathlib.Path(shared_dir(spark).removeprefix("file:")), spark.conf.get("spark.sql.shuffle.partitions")
    old = set(folder.glob("shards-*"))
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        rows = sharding.shard_documents(docs, sharding.tree(16), sharding.tree(17)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    (new,) = set(folder.glob("shards-*")) - old
    assert spark.read.parquet(str(new)).select("part").distinct().count() > 100
    assert len(list(new.glob("part-*"))) <= max(spark.sparkContext.defaultParallelism, 200 // sharding.RANGES)
    for shard in range(16):
        held = sorted((r.slot, r.doc_id) for r in rows if r.shard == shard)
        assert [s for s, _ in held] == list(range(len(held))) and [d for _, d in held] == sorted(d for _, d in held)
    assert sorted(map(tuple, rows)) == few


def test_sharding_reads_few_texts_at_once(spark, docs, monkeypatch):
    seen, write = [], sharding.materialise
    monkeypatch.setattr(sharding, "materialise", lambda *a: seen.append(spark.conf.get(common.READ_SETTING)) or write(*a))
    sharding.shard_documents(docs, sharding.tree(16))
    assert common.READ_SETTING not in spark.conf.getAll
    spark.conf.set(common.READ_SETTING, "1000")
    try:
        sharding.shard_documents(docs, sharding.tree(16))
        assert spark.conf.get(common.READ_SETTING) == "1000"
    finally:
        spark.conf.unset(common.READ_SETTING)
    assert seen == [str(common.READ_ROWS), "1000"]


def test_sharding_reads_each_text_once_and_keeps_nothing(spark):
    read, kept = spark.sparkContext.accumulator(0), spark.sparkContext._jsc.sc().getPersistentRDDs().size()

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    rows = sharding.shard_documents(docs.mapInArrow(counted, docs.schema), sharding.tree(16)).collect()
    assert len({r.doc_id for r in rows}) == len(rows) == read.value == 5000
    assert spark.sparkContext._jsc.sc().getPersistentRDDs().size() == kept


def test_weights_move_only_into_the_changed_subtree(spark):
    old = sharding.tree(16)
    new = [x._replace(weight=3.0) if x.shard == 5 else x for x in old]
    keys = spark.range(20_000)
    rows = keys.select(sharding.place(F.col("id"), old).alias("a"), sharding.place(F.col("id"), new).alias("b")).where("a <> b").collect()
    region = {x.shard: x.region for x in old}
    assert rows and all(region[r.b] == region[5] for r in rows)
    share = keys.select(sharding.place(F.col("id"), new).alias("s")).where("s = 5").count() / 20_000
    assert abs(share - 3 / 18) < 0.015
    for n in (17, 18, 20):
        grown = keys.select(sharding.place(F.col("id"), sharding.tree(n)).alias("a"), sharding.place(F.col("id"), sharding.tree(n + 1)).alias("b"))
        assert grown.where(f"a <> b and b <> {n}").isEmpty()


def brute_top(vectors, k):
    out = set()
    for q, v in {i: min(x for j, x in vectors if j == i) for i, _ in vectors if i % 50 == 0}.items():
        scores = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in vectors if j != q and len(w) == len(v))
        out |= {(q, rank + 1, j, -s) for rank, (s, j) in enumerate(scores[:k])}
    return out


def test_top_k(spark):
    rng = random.Random(1)
    rows = [(i, [rng.randint(-2, 2) / 4 for _ in range(3)], "x") for i in range(300)]
    rows += [(400 + i, [0.5, 0.5, 0.5], "x") for i in range(40)] + [(500, None, "x"), (550, [1.0, None, 0.0], "x"), (600, [float("nan"), 0.0, 1.0], "x")]
    rows += [(650, [float("inf"), 1.0, 1.0], "x"), (700, [1.0, 2.0], "x"), (701, [3.0, 2.0], "x"), (None, [1.0, 1.0, 1.0], "x"), (50, rows[50][1], "x"), (750, [], "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, block string").repartition(5)
    found = {(r.query_id, r.rank, r.vec_id, r.score) for r in topk.top_k(topk.quantise(df), "vec_id % 50 = 0", 5).collect()}
    ok = [(i, tuple(int(np.floor(x * 256)) for x in v)) for i, v, _ in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    assert found == brute_top(ok, 5)
    assert topk.top_k(topk.quantise(df.where("false")), "vec_id % 50 = 0", 5).count() == 0


def test_top_k_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    monkeypatch.setattr(topk, "VECTOR_BLOCK", 20)
    rng = random.Random(2)
    rows = [(i, [rng.uniform(-3, 3) for _ in range(8)]) for i in range(0, 1000, 5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    found = {(r.query_id, r.rank, r.vec_id, r.score) for r in topk.top_k(topk.quantise(df), "vec_id % 50 = 0", 7).collect()}
    ok = [(i, tuple(int(np.floor(float(np.float32(x)) * 256)) for x in v)) for i, v in rows]
    assert found == brute_top(ok, 7)


PLAIN = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return [m.decode() for m in PLAIN.findall(re.sub(rb"[A-Z]", lambda m: m.group().lower(), (text or "").encode()))]


def brute_contamination(text, items, window=10):
    held, hits, names = plain_words(text), set(), set()
    for name, item in items:
        w = plain_words(item)
        size = min(window, len(w))
        for at in range(len(w) - size + 1) if size else ():
            for p in range(len(held) - size + 1):
                if held[p : p + size] == w[at : at + size]:
                    hits |= set(range(p, p + size))
                    names.add(str(name))
    return len(held), len(hits), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hits)


@pytest.mark.parametrize("part", [decontaminate.BENCHMARK_BYTES, 400])
def test_decontamination(spark, docs, empty, monkeypatch, part):
    monkeypatch.setattr(decontaminate, "BENCHMARK_BYTES", part)
    items = [(10, words(7, 40)), (9, "One"), (100, words(5, 30_000)[2000:2300]), (3, None), (4, ""), (5, words(99, 30)), (10, words(7, 40)), (11, "漢字 🎉"), (12, "xx " * 5)]
    bench = spark.createDataFrame([(i, t, "c") for i, t in items], "item_id long, text string, mark string")
    more = docs.union(spark.createDataFrame([(20, words(7, 40)[:60] + " " + words(8, 20) + " " + words(7, 40)[30:], "en", 1, "", "", "", "", "")], SCHEMA))
    rows = decontaminate.contamination(more, bench).collect()
    texts = [*TEXTS, (20, words(7, 40)[:60] + " " + words(8, 20) + " " + words(7, 40)[30:])]
    want = collections.Counter((d, *brute_contamination(t, items)) for d, t in texts if d != 5)
    got = collections.Counter((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in rows if r.doc_id != 5)
    assert got == want
    five = next(r for r in rows if r.doc_id == 5)
    assert five.contaminated and {x.item_id for x in five.longest} == {"100"}
    run = next(x for x in five.longest)
    assert plain_words(words(5, 30_000))[run.doc_word : run.doc_word + run.n_words] == plain_words(items[2][1])[run.item_word : run.item_word + run.n_words]
    assert run.n_words >= len(plain_words(items[2][1])) - 2
    kept = decontaminate.remove_contaminated(more, bench)
    assert kept.columns == more.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in rows if not r.contaminated)
    assert decontaminate.contamination(empty, bench).count() == 0
    assert not any(r.contaminated for r in decontaminate.contamination(docs, bench.where("false")).collect())


def brute_sets(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m.group().lower(), (text or "").encode()))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_groups(rows):
    sets, root = [brute_sets(t) for _, t in rows], list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), d), d)
    return {(d, len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(rows)}


def test_near_duplicates_edges(docs, empty):
    rows = dedup.near_duplicates(docs).collect()
    assert len(rows) == len(TEXTS)
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in rows}
    assert got == brute_groups([x for x in TEXTS if x[0] is not None]) | {(None, 8, None)}
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    assert dedup.near_duplicates(empty).count() == 0
    kept = dedup.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(d) for d in [1, 2, 3, 4, 5, 6, 7, 9, 10, None, 12, 13])


def test_near_duplicates_in_a_crowd(spark):
    """Chains of edits, crowds with a shared passage, and a large group of close copies."""
    rng = random.Random(4)
    rows = []
    shared = words(1000, 60).split()
    for group in range(25):
        base = words(group, 80).split()
        for _ in range(12):
            for _ in range(rng.randint(0, 3)):
                base[rng.randrange(len(base))] = words(rng.random(), 1)
            rows.append(" ".join(base))
    for i in range(150):
        rows.append(" ".join(shared + words(5000 + i, rng.randint(10, 60)).split()))
    big = words(77, 100).split()
    for _ in range(200):
        copy = list(big)
        for _ in range(rng.randint(0, 2)):
            copy[rng.randrange(100)] = words(rng.random(), 1)
        rows.append(" ".join(copy))
    rng.shuffle(rows)
    pairs = list(enumerate(rows))
    df = spark.createDataFrame(pairs, "doc_id long, text string").repartition(6)
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in dedup.near_duplicates(df).collect()} == brute_groups(pairs)


def test_near_duplicates_in_a_dense_crowd(spark):
    """Single links in a crowd of 1,200 documents that all but reach the threshold."""
    base, rng = words(31, 200).split(), random.Random(8)
    texts = []
    for i in range(1200):
        tail = words(9000 + i, 35).split()
        if i % 40 == 1:
            tail[:3] = texts[-1].split()[200:203]
        texts.append(" ".join(base + tail))
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    found = dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)).collect()
    assert {r.doc_id: r.component_id for r in found} == {i: i - 1 if i % 40 == 1 else i for i in range(1200)}


def test_near_duplicates_beside_a_large_group(spark):
    """Texts that are each linked to one member of a component of 800 close copies."""
    base = words(41, 200).split()
    texts = [base + words(20_000 + i, 12).split() for i in range(800)]
    texts += [texts[20 * i] + words(30_000 + i, 65).split() for i in range(40)]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string").repartition(6)
    assert {r.component_id for r in dedup.near_duplicates(docs).collect()} == {0}


def test_pairs_with_few_equal_parts_are_compared():
    """70 of 128 equal parts are rare for a link, but no reason to leave out the exact comparison."""
    parts = np.zeros((2, dedup.MINHASHES), np.uint16)
    parts[1, 70:] = 1
    batch = pa.RecordBatch.from_pydict({"a": [b"a"], "b": [b"b"], "parts_a": [parts[0].tobytes()], "parts_b": [parts[1].tobytes()]})
    assert sum(x.num_rows for x in dedup._agree(iter([batch]))) == 1


def test_components(spark):
    links = [(i, i + 1) for i in range(200)] + [(500, 501), (501, 500), (600, 700), (700, 650), (600, 600)]
    rows = components.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.root for r in rows} == {**dict.fromkeys(range(201), 0), 500: 500, 501: 500, 600: 600, 700: 600, 650: 600}


def test_words_and_hashes():
    texts = ["One two", "", "TWO", "twoone", "one", "é two"]
    data, offsets = raw(pa.array(texts))
    found = bytewords.split(data, offsets, dedup.WORD)
    assert found.first.tolist() == [0, 2, 2, 3, 4, 5, 7]
    h = found.hashes.tolist()
    assert h[1] == h[2] == h[6] and h[0] == h[4] and len(set(h)) == 4


def test_pseudonyms(docs, empty):
    done = pii.pseudonymise(docs, b"k")
    assert done.columns == docs.columns and done.schema == docs.schema
    rows = {r.doc_id: r.text for r in done.collect()}
    assert rows[1] is None and rows[2] == "" and rows[7] == words(7, 40) and rows[5] == words(5, 30_000)
    assert "a.b@c" not in rows[9] and "2001-02-03" not in rows[9] and rows[9].startswith("ÄÖÜ ñandú 漢字 🎉 <|endoftext|> mail ")
    assert pii.pseudonymise(empty, b"k").count() == 0 and pii.find_and_replace(empty, b"k").count() == 0


VALUES = [
    ("card", "4111 1111 1111 1111"), ("card", "378282246310005"), ("iban", "DE89 3704 0044 0532 0130 00"), ("iban", "GB82WEST12345698765432"),
    ("ssn", "123-45-6789"), ("ip", "192.168.0.1"), ("iso", "1984-02-29"), ("date", "31/12/1999"), ("date", "12-25-1990"),
    ("phone", "+1 (415) 555-0100"), ("phone", "(415) 555-0100"), ("phone", "+442071838750"), ("email", "Jo.Doe+x@mail.example.co.uk"),
    ("secret", "0123456789abcdef0123"),
]


@pytest.mark.parametrize("value", ["TR330006100519786457841326", "SA0380000000608010167519", "AE07 0331 2345 6789 0123 456",
                                   "BR1800360305000010009795493C1", "IL620108000000099999999"])
def test_accounts_outside_europe(value):
    new = pii._iban(pii.Permutation(b"k"), value)
    assert new is not None and new != value and new[:2] == value[:2] and len(new) == len(value)
    assert pii._iban(pii.Permutation(b"k"), value[:-1]) is None


@pytest.mark.parametrize(("kind", "value"), VALUES)
def test_formats(kind, value):
    tool = pii.Pseudonyms(b"k")
    text = f'token = "{value}"' if kind == "secret" else f"see {value}, ok"
    new, spans = tool.replace(text)
    assert [s[0] for s in spans] == [kind] and value not in new
    made = new[spans[0][1] : spans[0][1] + spans[0][2]]
    if kind != "ip":
        shape = lambda s: re.sub(r"[a-z]", "a", re.sub(r"[A-Z]", "A", re.sub(r"\d", "0", s)))
        assert shape(made) == shape(value) if kind != "secret" else len(made) == len(value)
    assert tool.replace(new)[1] and tool.replace(text) == (new, spans) and pii.Pseudonyms(b"other").replace(text)[0] != new


@pytest.mark.parametrize("text", ["4111111111111112", "DE88 3704 0044 0532 0130 00", "000-12-3456", "300.1.1.1", "2001-02-30", "31/13/1999", "version 1.2.3", "1234567"])
def test_what_fails_its_check_stays(text):
    assert pii.Pseudonyms(b"k").replace(f"a {text} b") == (f"a {text} b", [])


@pytest.mark.parametrize("bound", [1, 2, 3, 10, 97, 1000])
def test_permutation_is_one_to_one(bound):
    permute = pii.Permutation(b"k")
    assert {permute(i, bound, "t") for i in range(bound)} == set(range(bound))


def test_far_apart_values_in_a_long_text():
    tool = pii.Pseudonyms(b"k")
    text = " ".join([words(1, 3000), "a@b.example", words(2, 3000), "+1 (415) 555-0100", words(3, 10), "4111111111111111"])
    assert [k for k, _, _ in tool.replace(text)[1]] == ["email", "phone", "card"]


@pytest.mark.parametrize(
    ("text", "kinds"),
    [
        ("+1 (826) 555-4081 190.137.223.204", ["phone", "ip"]), ("4111111111111111 27.65.93.188", ["card", "ip"]),
        ("4111111111111112 27.65.93.188", ["ip"]), ("+44 20 7183 8750 4111 1111 1111 1111", ["phone", "card"]),
        ("10.0.0.1 10.0.0.2 a@b.example c@d.example", ["ip", "ip", "email", "email"]), ("DE89 3704 0044 0532 0130 00 2001-02-03", ["iban", "iso"]),
        ("4111111111111111 4111111111111111", ["card", "card"]),
    ],
)
def test_values_side_by_side(text, kinds):
    new, spans = pii.Pseudonyms(b"k").replace(f"see {text} there")
    assert [k for k, _, _ in spans] == kinds
    same = set(text.split()) & set(new.split())
    assert all(x.startswith("+") or x == "4111111111111112" for x in same)


def test_language_edges(spark, docs, empty):
    rows = language.identify(docs).collect()
    assert len(rows) == len(TEXTS)
    by_id = {r.doc_id: r for r in rows}
    for d in (1, 2, 10):
        assert (by_id[d].lang_pred, by_id[d].score) == ("und", 0.0)
    assert by_id[7].lang_pred == "en"
    assert language.identify(empty).count() == 0
    alone = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language.identify(alone).collect()} == {"und"}
    kept = language.keep_known(docs, 0.0)
    assert kept.columns == docs.columns and kept.where("text is null or text = ''").isEmpty()


def test_gradients_of_the_network():
    rng = np.random.default_rng(1)
    values = {
        "tables": rng.normal(0, 0.3, (2, 256, 6)), "recurrent": rng.normal(0, 0.5, (2, 2, 6)),
        "readout": rng.normal(0, 0.5, (2, 2, 3)), "bias": rng.normal(0, 0.1, 3),
    }
    values = {k: v.astype(np.float64) for k, v in values.items()}
    grid, length = rng.integers(97, 100, (4, 128)).astype(np.uint8), np.array([5, 3, 1, 4])
    target, weight = np.array([0, 1, 2, 0]), np.ones(4, np.float32)

    def loss(v):
        net = language.Network(["a", "b", "c"], **v)
        order = np.argsort(-length, kind="stable")
        begin = order * 128
        logits, _ = language.position_logits(net, grid.ravel(), begin, length[order])
        total = 0.0
        for at, row in enumerate(order):
            for t in range(length[row]):
                x = logits[t, :, at].astype(float)
                total -= x[target[row]] - np.log(np.exp(x).sum())
        return total / length.sum()

    grads = language._gradients(values, grid, length, target, weight)
    for name in values:
        for _ in range(6):
            at = tuple(rng.integers(0, s) for s in values[name].shape)
            if name == "tables":
                at = (at[0], int(rng.integers(97, 100)), at[2])
            step = 1e-2
            up, down = ({k: v.copy() for k, v in values.items()} for _ in range(2))
            up[name][at] += step
            down[name][at] -= step
            assert abs((loss(up) - loss(down)) / (2 * step) - grads[name][at]) < 2e-3


def test_quality_edges(docs, empty):
    rows = quality.score_quality(docs).collect()
    assert len(rows) == len(TEXTS) and all(0 <= r.score <= 1 and 0 <= r.label <= 1 for r in rows)
    assert all(r.score == 0 and not r.keep for r in rows if r.doc_id in (1, 2, 10))
    assert quality.score_quality(empty).count() == 0


def test_estimated_accuracies():
    rng = np.random.default_rng(3)
    truth = rng.random(20_000) < 0.8
    wrong = np.array([0.0, 0.01, 0.005, 0.0, 0.01, 0.0, 0.0, 0.005])
    found = np.array([0.6, 0.5, 0.9, 0.4, 0.7, 0.5, 0.6, 0.8])
    bad = np.where(truth[:, None], rng.random((20_000, 8)) < wrong, rng.random((20_000, 8)) < found)
    vote = np.where(rng.random((20_000, 8)) < 0.1, quality.ABSTAIN, np.where(bad, quality.BAD, quality.GOOD))
    each, count = np.unique(quality.pattern(vote), return_counts=True)
    labels = quality.estimate(quality.unpack(each), count)
    assert abs(labels.prior - 0.8) < 0.02 and np.abs(labels.chances[:, 0, quality.BAD] - found).max() < 0.05
    assert ((labels.posterior(vote) > 0.5) == truth).mean() > 0.99


@pytest.mark.parametrize("parts", [1, 4, 32])
def test_blocks_do_not_depend_on_input_partitions(spark, monkeypatch, parts):
    rng = np.random.default_rng(5)
    rows = [(i, rng.integers(-9, 9, 4).tolist()) for i in range(500)]
    kept, made = {}, topk.materialise

    def keep(df, label):
        kept[label] = made(df, label)
        return kept[label]

    monkeypatch.setattr(topk, "materialise", keep)
    monkeypatch.setattr(topk, "VECTOR_BLOCK", 100)
    df = spark.createDataFrame(rows, "vec_id long, v array<long>").repartition(parts)
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in topk.top_k(df, "vec_id % 50 = 0", 5).collect()}
    vectors = np.array([v for _, v in rows])
    for q in range(0, 500, 50):
        scores = vectors @ vectors[q]
        best = sorted((-int(s), i) for i, s in enumerate(scores) if i != q)[:5]
        assert [got[q, n + 1] for n in range(5)] == [(i, -s) for s, i in best]
    assert kept["vectors"].count() <= 2 * 6
