"""The registered queries of this subpackage, each beside the SQL that checks it where SQL can."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura.llm import alignment, conversations, decontaminate, dedup, language, packing, pii, quality, sharding, token_counts, token_output, topk, toxicity
from tenura.llm.common import table
from tenura.session import fresh_path

BYTE_BPE = "byte_bpe_50k.json"
PIECE_BPE = "piece_bpe_32k.model"
#: Session setting with the secret key of the pseudonyms; without it a public one is used.
KEY_SETTING = "tenura.pii.key"

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def keep(func: Query) -> Query:
        QUERIES[name] = func
        if sql is not None:
            SQL[name] = sql
        return func

    return keep


@query(
    "op1_topk",
    """
    WITH v AS (
      SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
      WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    pairs AS (
      SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
    ranked AS (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs)
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
)
def op1_topk(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(topk.quantise(table(spark, folder, "embeddings")), "vec_id % 50 = 0", 5)


@query("op2_token_output")
def op2_token_output(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "tokens")
    token_output.write_tokens(table(spark, folder, "documents"), public_tokenizers.path(BYTE_BPE), path)
    back = token_output.read_tokens(spark, path)
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("op3_token_counts")
def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, folder, "documents"), public_tokenizers.path(BYTE_BPE))


@query(
    "op4_decontaminate",
    r"""
    WITH bench AS (
      SELECT CAST(item_id AS VARCHAR) AS item,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
    windows AS (
      SELECT DISTINCT item, least(len(w), 10) AS size,
        array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS win
      FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, least(len(w), 1)) + 1)) AS i FROM bench)),
    sizes AS (SELECT DISTINCT size FROM windows),
    docs AS (
      SELECT doc_id, row_number() OVER () AS r,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
    places AS (
      SELECT r, i, size, array_to_string(w[i : i + size - 1], ' ') AS win
      FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM docs, sizes WHERE len(w) >= size)),
    found AS (SELECT p.r, p.i, p.size, t.item FROM places p JOIN windows t ON p.win = t.win AND p.size = t.size),
    hit AS (
      SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(i, i + size)) AS k FROM found) GROUP BY r),
    items AS (
      SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM found GROUP BY r)
    SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(i.n_items, 0) AS n_items,
      sha256(coalesce(i.ids, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
    FROM docs d LEFT JOIN hit h USING (r) LEFT JOIN items i USING (r)
    """,
)
def op4_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.drop("hits", "longest")


def pii_key(spark: SparkSession) -> bytes:
    return spark.conf.get(KEY_SETTING, "a public key, for trials alone").encode()


@query("op5_pii")
def op5_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.find_and_replace(table(spark, folder, "documents"), pii_key(spark))


@query("op6_language")
def op6_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(table(spark, folder, "documents"))


@query("op7_shard")
def op7_shard(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_documents(table(spark, folder, "documents"), sharding.tree(16), sharding.tree(17))


@query("op8_quality")
def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.score_quality(table(spark, folder, "documents"))


@query(
    "op9_near_duplicates",
    r"""
    WITH RECURSIVE docs AS (
      SELECT doc_id, row_number() OVER () AS r,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[^\x20\x09-\x0D]+') AS w FROM documents),
    shingles AS (
      SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1)) AS i FROM docs)),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    common AS (
      SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
      FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
    links AS (
      SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
      WHERE 100 * shared >= 75 * (x.n + y.n - shared)),
    reach AS (
      SELECT doc_id AS a, doc_id AS b FROM documents
      UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
    least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
    SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, l.component_id, d.doc_id = l.component_id AS kept
    FROM docs d LEFT JOIN sizes s ON s.doc_id = d.doc_id JOIN least l ON l.a = d.doc_id
    """,
)
def op9_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.near_duplicates(table(spark, folder, "documents")).drop("print", "root")


@query("op10_pack")
def op10_pack(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pack(table(spark, folder, "documents"), public_tokenizers.path(BYTE_BPE))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@query("op11_cross_tokenizer")
def op11_cross_tokenizer(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.align_tokenizers(table(spark, folder, "documents"), public_tokenizers.path(BYTE_BPE), public_tokenizers.path(PIECE_BPE))


@query(
    "op12_conversation_repair",
    r"""
    WITH RECURSIVE crc AS (
      SELECT list(c ORDER BY i) AS t FROM (
        SELECT i, list_reduce(list_concat([i], range(8)), lambda c, k: xor(c >> 1, 3988292384 * (c & 1))) AS c FROM range(256) r(i))),
    given AS (
      SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
    kinds AS (
      SELECT g.*, xor(list_reduce(list_concat([4294967295], list_transform(range(1, len(k) + 1), lambda i: ascii(k[i]))),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS kind FROM given g, crc),
    harmed AS (
      SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
        CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS again FROM kinds WHERE kind <> 0),
    placed AS (
      SELECT *, row_number() OVER w AS i, lag(role) OVER w AS before,
        row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, again) AS nth,
        regexp_extract(text, '([^ 	-
])[ 	-
]*$', 1) AS mark FROM harmed
      WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), again)),
    faults AS (
      SELECT *, mark = '' AS blank, mark <> '' AND nth > 1 AS duplicate, mark <> '' AND nth = 1 AND mark NOT IN ('.', '!', '?') AS truncated,
        before IS NOT NULL AND coalesce(before[1], '') || coalesce(role[1], '') NOT IN ('su', 'ua', 'au') AS illegal FROM placed),
    facts AS (
      SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) AS n,
        count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated,
        count(*) FILTER (illegal) AS illegal FROM faults GROUP BY conv_id),
    inserts AS (
      SELECT * FROM (VALUES (0, 0, '', []), (1, 1, '', []), (2, 2, '', []), (3, 3, '', []), (0, 2, 'I', ['user:']), (0, 3, 'II', ['user:', 'assistant:']),
        (1, 2, 'I', ['user:']), (1, 3, 'II', ['user:', 'assistant:']), (2, 3, 'I', ['assistant:']), (3, 2, 'I', ['user:'])) x(s, t, e, lines)),
    keeps AS (SELECT * FROM (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)) x(s, c, t)),
    states AS (SELECT * FROM (VALUES (0, 2, 'user'), (1, 2, 'user'), (2, 3, 'assistant'), (3, 2, 'user')) x(s, made, maker)),
    best AS (
      SELECT conv_id, CAST(0 AS BIGINT) AS i, 0 AS s, CAST(0 AS BIGINT) AS cost, '' AS audit, CAST([] AS VARCHAR[]) AS lines FROM facts
      UNION ALL
      SELECT conv_id, i, s, min(cost), arg_min(audit, printf('%09d', cost) || audit), arg_min(lines, printf('%09d', cost) || audit) FROM (
        SELECT b.conv_id, f.i, e.t AS s, b.cost + 3 * len(n.e) + e.price AS cost, b.audit || n.e || e.e AS audit,
          list_concat(list_concat(b.lines, n.lines), e.line) AS lines
        FROM best b JOIN faults f ON f.conv_id IS NOT DISTINCT FROM b.conv_id AND f.i = b.i + 1 JOIN inserts n ON n.s = b.s
        JOIN states w ON w.s = n.t LEFT JOIN keeps k ON k.s = n.t AND k.c = f.role[1],
        LATERAL (SELECT * FROM (VALUES
          ('D', n.t, 4, CAST([] AS VARCHAR[])),
          ('R', CASE WHEN NOT f.blank AND NOT f.duplicate THEN w.made END, CASE WHEN f.truncated THEN 6 ELSE 3 END, [w.maker || ':' || f.text]),
          ('K', CASE WHEN NOT f.blank AND NOT f.duplicate THEN k.t END, CASE WHEN f.truncated THEN 3 ELSE 0 END, [f.role || ':' || f.text])) x(e, t, price, line)) e
        WHERE e.t IS NOT NULL) GROUP BY conv_id, i, s),
    ended AS (
      SELECT b.conv_id, min(b.cost + 3 * len(n.e)) AS cost, arg_min(b.audit || n.e, printf('%09d', b.cost + 3 * len(n.e)) || b.audit || n.e) AS audit,
        arg_min(list_concat(b.lines, n.lines), printf('%09d', b.cost + 3 * len(n.e)) || b.audit || n.e) AS lines
      FROM best b JOIN facts f ON f.conv_id IS NOT DISTINCT FROM b.conv_id AND f.n = b.i JOIN inserts n ON n.s = b.s
      WHERE n.t IN (0, 3) GROUP BY b.conv_id)
    SELECT o.conv_id, CAST(coalesce(f.gaps, 0) AS BIGINT) AS gaps, coalesce(f.blank, 0) AS blank, coalesce(f.duplicate, 0) AS duplicate,
      coalesce(f.truncated, 0) AS truncated, coalesce(f.illegal, 0) AS illegal, CAST(coalesce(e.cost, 0) AS BIGINT) AS cost,
      coalesce(e.audit, '') AS audit, sha256(coalesce(array_to_string(e.lines, chr(10)), '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM o.conv_id
      LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
    """,
)
def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    given = table(spark, folder, "conversations")
    return repaired_conversations(given, conversations.damaged(given))


def repaired_conversations(given: DataFrame, rows: DataFrame) -> DataFrame:
    """Audits and digests of the repaired ``rows`` for every conversation of ``given``."""
    audits = conversations.audit(rows)
    done = conversations.digests(conversations.repair(rows, audits)).withColumnRenamed("conv_id", "c")
    ids = given.select(F.col("conv_id").alias("id")).distinct()
    joined = ids.join(audits, ids["id"].eqNullSafe(audits["conv_id"]), "left").join(done, ids["id"].eqNullSafe(done["c"]), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", *conversations.COUNTS, "cost")]
    return joined.select(F.col("id").alias("conv_id"), *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("digest", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


@query("op13_toxicity")
def op13_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))
