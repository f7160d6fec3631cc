"""The pipeline, stage by stage, against brute force on its own input."""

from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from test_llm_edges import brute_contamination, brute_groups
from tenura.llm import common, decontaminate
from tenura.llm.queries import BYTE_BPE


@pytest.fixture(scope="module")
def stages(spark, folder, tmp_path_factory):
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("doc_id < 400").cache()
    held = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name.replace(" ", "-"))
        stage(spark, held[-1], folder).write.parquet(path)
        held.append(spark.read.parquet(path))
    return held


def test_order_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near duplicates", "decontamination", "personal data", "packing"]
    assert all(s.columns == stages[0].columns for s in stages[1:-1])


def test_language_keeps_clean_documents(stages):
    assert stages[1].count() >= 0.99 * stages[0].count()


def test_one_of_each_group(stages):
    rows = [(r.doc_id, r.text) for r in stages[1].select("doc_id", "text").collect()]
    want = sorted(d for d, _, least in brute_groups(rows) if d == least)
    assert sorted(r.doc_id for r in stages[2].select("doc_id").collect()) == want and len(want) < len(rows)


def test_no_benchmark_is_left(spark, folder, stages):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    texts = {r.doc_id: r.text for r in stages[2].select("doc_id", "text").collect()}
    kept = {r.doc_id for r in stages[3].select("doc_id").collect()}
    gone = texts.keys() - kept
    assert gone and all(brute_contamination(texts[d], items)[4] for d in gone)
    assert not any(brute_contamination(texts[d], items)[4] for d in sorted(kept)[:60])


def test_personal_data_changes_only_texts_that_hold_some(stages):
    old = {r.doc_id: r.text for r in stages[3].collect()}
    new = {r.doc_id: r for r in stages[4].collect()}
    assert old.keys() == new.keys() and all(r.n_chars == len(r.text) for r in new.values())
    changed = [d for d in old if old[d] != new[d].text]
    assert 0 < len(changed) < len(old) / 4


def test_packed_pieces_hold_all_tokens(stages):
    library = Tokenizer.from_file(public_tokenizers.path(BYTE_BPE))
    pieces = {}
    for r in sorted(stages[5].collect(), key=lambda r: r.start):
        pieces[r.doc_id] = pieces.get(r.doc_id, b"") + bytes(r.ids)
    for r in stages[4].collect():
        assert pieces.pop(r.doc_id) == np.array([*library.encode(r.text, add_special_tokens=False).ids, 0], "<u4").tobytes()
    assert not pieces


def test_registered():
    import __spark_entry__

    assert __spark_entry__.queries().keys() >= {"pipeline", "op1_topk"}


def test_stages_send_rows_in_small_batches(spark, stages):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"size": [batch.nbytes]})

    rows = spark.range(4000, numPartitions=1).select(F.repeat(F.lit("word "), 1000).alias("text"))  # 20 MB
    assert max(r.size for r in rows.mapInArrow(sizes, "size long").collect()) <= 1.5 * common.BATCH_BYTES


def test_own_batch_size_is_kept(spark, folder):
    before = spark.conf.get(common.BATCH_SETTING)
    try:
        spark.conf.set(common.BATCH_SETTING, "12345")
        common.bound_batches(spark)
        assert spark.conf.get(common.BATCH_SETTING).startswith("12345")
    finally:
        spark.conf.set(common.BATCH_SETTING, before)


def test_shards_of_a_small_benchmark_are_small(monkeypatch):
    passage = "one two three four five six seven eight nine ten"
    tests = decontaminate.read_tests(pa.table({"item_id": [1], "text": [passage]}))
    seen, search = [], decontaminate.search
    monkeypatch.setattr(decontaminate, "search", lambda column, tests: seen.append(column.nbytes) or search(column, tests))
    texts = ["other words " * 8000] * 40  # 4 MB
    texts[7] += passage
    docs = pa.RecordBatch.from_pydict({"doc_id": list(range(40)), "text": texts})
    kept = [d for b in decontaminate._clean(SimpleNamespace(value=tests))([docs]) for d in b.column("doc_id").to_pylist()]
    assert kept == [d for d in range(40) if d != 7] and max(seen) <= 1.1 * decontaminate.SHARD_BYTES
