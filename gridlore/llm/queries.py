"""The registered queries of this package."""
from __future__ import annotations

import public_tokenizers

from gridlore.llm import (
    decontamination,
    exact_dedup,
    fingerprints,
    near_dedup,
    packing,
    passages,
    prefix_trie,
    sharding,
    token_counts,
    token_files,
    toxicity,
    transcripts,
    whitening,
)


def _table(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_toxicity(spark, sf):
    docs = _table(spark, sf, "documents")
    model = toxicity.train(docs, _table(spark, sf, "labels"))
    return toxicity.score_documents(docs, model)


def op2_chat_format(spark, sf):
    return transcripts.format_chats(_table(spark, sf, "conversations"))


def op3_decontamination(spark, sf):
    docs, benchmark = _table(spark, sf, "documents"), _table(spark, sf, "benchmark")
    return decontamination.contaminated(docs, benchmark).drop("mark")


def op4_passages(spark, sf):
    return passages.repeated_passages(_table(spark, sf, "documents")).drop("mark")


def op5_shards(spark, sf):
    return sharding.shard(_table(spark, sf, "documents"), shards=8)


def op6_near_classes(spark, sf):
    return near_dedup.near_classes(_table(spark, sf, "documents")).select("doc_id", "class_id")


def op7_token_files(spark, sf):
    path = public_tokenizers.path("word_bpe_49k.json")
    return token_files.token_files(_table(spark, sf, "documents"), path, end=2)


def op8_pack(spark, sf):
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack(_table(spark, sf, "documents"), path, size=1024, end=0).drop("ids")


def op9_fingerprints(spark, sf):
    return fingerprints.fingerprint_documents(_table(spark, sf, "documents"))


def op10_token_counts(spark, sf):
    path = public_tokenizers.path("word_bpe_49k.json")
    return token_counts.count_tokens(_table(spark, sf, "documents"), path, limit=2048)


def op11_prefix_trie(spark, sf):
    return prefix_trie.prefix_trie(_table(spark, sf, "conversations"))


def op12_exact_dedup(spark, sf):
    return exact_dedup.exact_copies(_table(spark, sf, "documents"))


def op13_whitening(spark, sf):
    return whitening.whiten(_table(spark, sf, "embeddings"), most=32)


QUERIES = {
    query.__name__: query
    for query in (
        op1_toxicity, op2_chat_format, op3_decontamination, op4_passages, op5_shards, op6_near_classes,
        op7_token_files, op8_pack, op9_fingerprints,
        op10_token_counts, op11_prefix_trie, op12_exact_dedup, op13_whitening,
    )
}

# The other operators learn, sketch, tokenize or find eigenvectors; see tests/llm.
ORACLE: dict[str, str] = {
    # A node is told by its smallest member and its depth. crc32 is worked out bit by bit.
    "op11_prefix_trie": r"""
WITH turns AS (
  SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x,
         row_number() OVER (PARTITION BY conv_id
           ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT c, max(pos) AS own, c - c % 5 AS base,
         xor(4294967295, list_reduce(
           list_concat([4294967295::BIGINT],
                       list_transform(string_split(c::VARCHAR, ''), lambda k: ascii(k)::BIGINT)),
           lambda v, b: list_reduce(
             [xor(v, b), 0, 0, 0, 0, 0, 0, 0, 0],
             lambda t, i: CASE WHEN t & 1 = 1 THEN xor(t >> 1, 3988292384) ELSE t >> 1 END))) % 9 AS h
  FROM turns GROUP BY c),
moves AS (
  SELECT a.c, a.base, a.h, least(a.h, coalesce(b.own, 0)) AS taken
  FROM convs a LEFT JOIN convs b ON b.c = a.base),
built AS (
  SELECT m.c, t.pos AS d, t.r, t.x FROM moves m JOIN turns t ON t.c = m.base AND t.pos <= m.taken
  UNION ALL
  SELECT m.c, t.pos - m.h + m.taken, t.r, t.x FROM moves m JOIN turns t ON t.c = m.c AND t.pos > m.h),
whole AS (
  SELECT m.c, coalesce(list(struct_pack(r := b.r, x := b.x) ORDER BY b.d) FILTER (b.d IS NOT NULL), []) AS seq
  FROM moves m LEFT JOIN built b USING (c) GROUP BY m.c),
steps AS (
  SELECT c, len(seq) AS n, unnest(range(0, len(seq) + 1)) AS d, seq FROM whole),
paths AS (
  SELECT c, n, d, CASE WHEN d > 0 THEN octet_length(encode(seq[d].x)) ELSE 0 END AS bytes,
         min(c) OVER (PARTITION BY d, seq[1:d]) AS top FROM steps),
nodes AS (
  SELECT top, d, count(*) AS n_convs, any_value(bytes) AS bytes,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (n = d), '')) AS ends_sha256
  FROM paths GROUP BY top, d),
kin AS (
  SELECT n.*, p.top AS parent FROM nodes n LEFT JOIN paths p ON p.c = n.top AND p.d = n.d - 1),
born AS (SELECT parent AS top, d - 1 AS d, count(*) AS n_children FROM kin WHERE d > 0 GROUP BY ALL),
placed AS (
  SELECT k.*, coalesce(b.n_children, 0) AS n_children FROM kin k LEFT JOIN born b USING (top, d)),
sums AS (
  SELECT p.top, p.d, count(*) FILTER (u.n_children = 0) AS n_leaves,
         sum((u.n_convs - 1) * u.bytes)::BIGINT AS saved_tokens
  FROM placed u JOIN paths p ON p.c = u.top AND p.d <= u.d GROUP BY p.top, p.d)
SELECT top AS conv_id, d AS depth, parent AS parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
FROM placed JOIN sums USING (top, d)""",
    "op12_exact_dedup": r"""
WITH texts AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents)
SELECT doc_id, min(doc_id) OVER copies AS keep_id, count(*) OVER copies AS group_size,
       doc_id = min(doc_id) OVER copies AS kept, sha256(body) AS text_sha256
FROM texts WINDOW copies AS (PARTITION BY body)""",
}
