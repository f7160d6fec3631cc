"""Tokenizer alignment against a plain alignment of single texts."""

import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tenura.llm import alignment
from tenura.llm.common import table
from tenura.llm.queries import BYTE_BPE, PIECE_BPE, QUERIES

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def tools():
    a = Tokenizer.from_file(public_tokenizers.path(BYTE_BPE))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(PIECE_BPE))


def ends(parts):
    total, found = 0, []
    for part in parts:
        total += len(part)
        found.append(total)
    return found


def aligned(tools, text):
    """Groups and links of one text, token by token."""
    if not text:
        return [], []
    a, b = tools
    byte_of = alignment.byte_level_table()
    ids_a = a.encode(" " + text, add_special_tokens=False).ids
    ids_b = b.encode(text)
    bytes_a = [bytes(byte_of[c] for c in a.id_to_token(i)) for i in ids_a]
    bytes_b = [bytes([int(b.id_to_piece(i)[1:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
    want = (" " + text).encode()
    if b"".join(bytes_a) != want or b"".join(bytes_b) != want:
        return [], []
    ends_a, ends_b = ends(bytes_a), ends(bytes_b)
    groups, i, j = [], 0, 0
    for border in sorted(set(ends_a) & set(ends_b)):
        group = ([], [])
        while i < len(ids_a) and ends_a[i] <= border:
            group[0].append(ids_a[i])
            i += 1
        while j < len(ids_b) and ends_b[j] <= border:
            group[1].append(ids_b[j])
            j += 1
        groups.append(group)
    links, i, j = [], 0, 0
    while i < len(ids_a) and j < len(ids_b):
        links.append((ids_a[i], ids_b[j]))
        x, y = ends_a[i], ends_b[j]
        i, j = i + (x <= y), j + (y <= x)
    return groups, links


def brute_force(tools, rows):
    found = [(doc, *aligned(tools, text)) for doc, text in rows]
    count = Counter(pair for _, _, links in found for pair in set(links))
    highest = defaultdict(int)
    for (a, _), n in count.items():
        highest[a] = max(highest[a], n)
    out = []
    for doc, groups, links in found:
        written = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append(
            (doc, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(links),
             sum(count[p] == highest[p[0]] for p in links), sum(count[p] for p in links), hashlib.sha256(written.encode()).hexdigest() if groups else "")
        )
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select(COLUMNS).collect()), key=repr)


def run(docs, **more):
    return alignment.align_tokenizers(docs, public_tokenizers.path(BYTE_BPE), public_tokenizers.path(PIECE_BPE), **more)


def test_whole_table(spark, folder, tools):
    rows = [tuple(r) for r in table(spark, folder, "documents").select("doc_id", "text").collect()]
    assert got(QUERIES["op11_cross_tokenizer"](spark, folder)) == brute_force(tools, rows)


EDGES = [
    (1, None), (2, ""), (3, " "), (4, "a"), (5, "  two  spaces \n\t and a tab"), (6, "<|endoftext|> and <s> </s> <unk> <0x41>"),
    (7, "a▁b"), (8, "naïve 你好 \U0001f600\U0001f469‍\U0001f4bb"), (9, "x" * 20_000), (10, "word " * 30_000),
    (11, "\u0000\u0001"), (12, "Å ﬁ ½"), (13, "same"), (14, "same"), (None, "same"), (13, "same"), (15, "\n"), (16, "\r\n "),
]


def edge_rows(spark):
    return spark.createDataFrame(EDGES, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("key", "copies", "pairs", "n_a")}).repartition(5)


@pytest.mark.parametrize("more", [{}, {"frequent": 3}, {"frequent": 0}, {"least_hot": 1}, {"kept_words": 1}])
def test_nulls_odd_texts_copies_and_clashing_columns(spark, tools, more):
    assert got(run(edge_rows(spark), **more)) == brute_force(tools, EDGES)


def test_empty_table(spark):
    df = run(spark.createDataFrame([], "doc_id long, text string"))
    assert df.collect() == [] and df.columns == COLUMNS
