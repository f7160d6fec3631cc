"""The registered queries over whole tables, against SQL, the libraries or brute force."""

import collections
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from compare import compare, connect
from tenura.llm import pii
from tenura.llm.queries import BYTE_BPE, QUERIES, SQL

TOKENIZER = Tokenizer.from_file(public_tokenizers.path(BYTE_BPE))


@pytest.fixture(scope="module")
def texts(spark, folder):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}


@pytest.fixture(scope="module")
def ids(texts):
    return {d: x.ids for d, x in zip(texts, TOKENIZER.encode_batch(list(texts.values()), add_special_tokens=False))}


def crc(numbers):
    return zlib.crc32(np.array(numbers, "<u4").tobytes())


def test_there_is_one_query_for_each_operator():
    assert sorted(int(n.split("_")[0][2:]) for n in QUERIES) == list(range(1, 11))


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, folder, name):
    assert compare(QUERIES[name](spark, folder), connect(folder), SQL[name]) == []


def test_token_files(spark, folder, ids):
    rows = {r.doc_id: r for r in QUERIES["op2_token_output"](spark, folder).collect()}
    assert rows.keys() == ids.keys()
    start = 0
    for doc in sorted(ids):
        want = [*ids[doc], 2]
        assert (rows[doc].start, rows[doc].n_tokens, rows[doc].ids_crc32) == (start, len(want), crc(want))
        start += len(want)


def test_token_counts(spark, folder, texts, ids):
    rows = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in QUERIES["op3_token_counts"](spark, folder).collect()}
    assert rows == {d: (len(texts[d].encode()), len(x), len(x) > 512) for d, x in ids.items()}


def test_packing(spark, folder, ids):
    rows = QUERIES["op10_pack"](spark, folder).collect()
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert by_doc.keys() == ids.keys()
    for doc, held in by_doc.items():
        want, at = [*ids[doc], 0], 0
        for r in sorted(held, key=lambda r: r.start):
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(want), crc(want[at : at + r.length]))
            at += r.length
        assert at == len(want)
    for held in by_sequence.values():
        at = 0
        for r in sorted(held, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == held[0].tier <= 1024 and at & (at - 1) == 0
    steps = collections.Counter()
    for held in by_sequence.values():
        steps[held[0].step] += held[0].tier
    assert max(steps.values()) < 2 * (1 << 16)


def test_shards(spark, folder, texts):
    rows = QUERIES["op7_shard"](spark, folder).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        data = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law) == (len(data) + 1, zlib.crc32(data), "key")
        assert r.grown_shard in (r.shard, 16)
    counts = collections.Counter(r.shard for r in rows)
    assert set(counts) == set(range(16)) and max(counts.values()) < 2 * min(counts.values())
    for shard in counts:
        held = sorted((r.slot, r.doc_id) for r in rows if r.shard == shard)
        assert [s for s, _ in held] == list(range(len(held))) and [d for _, d in held] == sorted(d for _, d in held)
    moved = sum(r.grown_shard == 16 for r in rows)
    assert 0 < moved < 2 * len(rows) / 17


def test_language(spark, folder):
    rows = QUERIES["op6_language"](spark, folder).collect()
    known = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang").collect()}
    assert len(rows) == len(known)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    right = [r.lang_pred == known[r.doc_id] for r in rows if r.held_out]
    assert sum(right) >= 0.97 * len(right)


def test_quality(spark, folder):
    rows = QUERIES["op8_quality"](spark, folder).collect()
    known = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    good = [r.keep for r in rows if known.get(r.doc_id) == 1]
    bad = [r.keep for r in rows if known.get(r.doc_id) == 0]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.05 * len(bad)


def test_pseudonyms(spark, folder, texts):
    rows = QUERIES["op5_pii"](spark, folder).collect()
    tool = pii.Pseudonyms(b"another key")
    assert len(rows) == len(texts)
    seen = 0
    for r in rows:
        old, new = tool.replace(texts[r.doc_id])[1], r.pii
        assert [(k, n) for k, _, n in old if k != "ip"] == [(x.kind, x.length) for x in new if x.kind != "ip"]
        for x in new:
            value = r.text[x.start : x.start + x.length]
            assert value not in texts[r.doc_id] and tool.make(x.kind, value) is not None
            seen += 1
        if not new:
            assert r.text == texts[r.doc_id]
    assert seen > 50
