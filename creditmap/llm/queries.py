"""The registered queries of the operators and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditmap.llm import chat_format, factorization_quality, hard_negatives, kneser_ney_toxicity, language_mixture, length_histogram, merkle_manifest, mixture_packing, multi_index_search, multiset_fingerprint
from creditmap.llm.bpe_trie import encode_decode_digests
from creditmap.llm.common import table
from creditmap.llm.jaccard_join import Similarity, near_duplicates
from creditmap.llm.residual_packing import pack_documents

WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_factorization_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return factorization_quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_kneser_ney_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney_toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_mixture.identify(table(spark, sf_dir, "documents")).drop("langs")


def op3_length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    lengths = length_histogram.encoded_lengths(table(spark, sf_dir, "documents"), BYTE_VOCABULARY, public_tokenizers.PATTERN)
    return length_histogram.histogram(lengths)


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    same = "</s>[INST] ok [/INST]"
    more = spark.range(2).select(F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
                                 F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(same).alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    rows = rows.select("conv_id", "turn", "role", chat_format.text_parts(F.col("text")).alias("parts"))
    found = chat_format.read_chats(chat_format.format_chats(rows))
    loss = chat_format.loss_text(F.col("formatted"), F.col("loss_spans"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return (found.select("conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
                         loss.alias("loss"), F.length("formatted").cast("bigint").alias("formatted_chars"))
            .select("conv_id", "n_turns", "turns_sha256", F.length("loss").cast("bigint").alias("loss_chars"),
                    F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"), "formatted_chars"))


def op6_residual_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), WORD_VOCABULARY)


def op7_multiset_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiset_fingerprint.edited_fingerprints(table(spark, sf_dir, "documents"))


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), Similarity(words=4, num=85, den=100))


def op9_multi_index_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index_search.top_k(table(spark, sf_dir, "embeddings"))


def op10_bpe_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode_digests(table(spark, sf_dir, "documents"), WORD_VOCABULARY)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine_embeddings(table(spark, sf_dir, "embeddings"))


def op12_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture_packing.pack_documents(table(spark, sf_dir, "documents"), WORD_VOCABULARY)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest.verified_documents(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_factorization_quality,
    op2_kneser_ney_toxicity,
    op3_length_histogram,
    op4_language_mixture,
    op5_chat_format,
    op6_residual_packing,
    op7_multiset_fingerprint,
    op8_ngram_jaccard_join,
    op9_multi_index_search,
    op10_bpe_trie,
    op11_hard_negatives,
    op12_mixture_packing,
    op13_merkle_manifest,
)}

_WORDS = r"[x FOR x IN regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') IF x <> '']"

_FIELD = "coalesce(strlen({0})::VARCHAR || ':' || {0}, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text)) + ")"


# crc32 of the decimals of doc_id, bit by bit
_CRC = ("xor(4294967295, list_reduce([4294967295] || [ascii(c)::BIGINT FOR c IN string_split(doc_id::VARCHAR, '')], lambda s, b: "
        "list_reduce([xor(s, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)))")

ORACLE_SQL: dict[str, str] = {
    "op11_hard_negatives": """
WITH r AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT a.id AS anchor_id, b.id, a.label = b.label AS alike, list_sum([x[1] * x[2] FOR x IN list_zip(a.v, b.v)])::BIGINT AS score
  FROM r a JOIN r b ON a.id % 50 = 0 AND a.id <> b.id),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)::INTEGER AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT alike AND 100 * score BETWEEN 50 * positive_score AND 95 * positive_score
QUALIFY rank <= 3
""",
    "op13_merkle_manifest": f"""
WITH RECURSIVE
  rows AS (
    SELECT row_number() OVER () AS k, doc_id, source, {_leaf("text")} AS leaf,
           CASE WHEN {_CRC} % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf("text")} END AS now
    FROM documents),
  placed AS (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, k) - 1 AS pos, dense_rank() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS grp FROM rows),
  low AS (
    SELECT grp, 0 AS lvl, pos, count(*) OVER (PARTITION BY grp) AS n, leaf AS node FROM placed
    UNION ALL
    SELECT grp, lvl + 1, pos // 3, (any_value(n) + 2) // 3, sha256(string_agg(node, '' ORDER BY pos)) FROM low WHERE n > 1 GROUP BY grp, lvl, pos // 3),
  subroots AS (SELECT grp, node, (SELECT count(DISTINCT grp) FROM placed) AS n FROM low WHERE n = 1),
  high AS (
    SELECT 0 AS lvl, grp::BIGINT AS pos, n, node FROM subroots
    UNION ALL
    SELECT lvl + 1, pos // 3, (any_value(n) + 2) // 3, sha256(string_agg(node, '' ORDER BY pos)) FROM high WHERE n > 1 GROUP BY lvl, pos // 3),
  tree AS (
    SELECT grp, lvl, pos, n, node FROM low WHERE n > 1
    UNION ALL
    SELECT s.grp, 1000 + lvl, pos, h.n, h.node FROM high h, (SELECT DISTINCT grp FROM placed) s WHERE h.n > 1),
  beside AS (
    SELECT p.k, t.lvl, coalesce(string_agg(t.node, '' ORDER BY t.pos) FILTER (t.pos < own), '') AS l, coalesce(string_agg(t.node, '' ORDER BY t.pos) FILTER (t.pos > own), '') AS r
    FROM (SELECT k, grp, lvl, CASE WHEN lvl < 1000 THEN pos ELSE grp END // (3 ** (lvl % 1000))::BIGINT AS own FROM placed JOIN (SELECT DISTINCT grp, lvl FROM tree) USING (grp)) p
    JOIN tree t ON t.grp = p.grp AND t.lvl = p.lvl AND t.pos // 3 = p.own // 3
    GROUP BY p.k, t.lvl),
  steps AS (SELECT k, row_number() OVER (PARTITION BY k ORDER BY lvl) AS step, l, r FROM beside),
  fold AS (
    SELECT k, 0 AS step, now AS node FROM placed
    UNION ALL
    SELECT k, fold.step + 1, sha256(l || node || r) FROM fold JOIN steps USING (k) WHERE steps.step = fold.step + 1),
  proofs AS (SELECT k, string_agg(l || r, '' ORDER BY step) AS proof FROM steps GROUP BY k),
  top AS (SELECT node FROM high WHERE n = 1)
SELECT p.doc_id, p.leaf, s.node AS subroot, top.node AS root, sha256(coalesce(proof, '')) AS proof_sha256,
       f.node AS folded_root, f.node = top.node AS verified
FROM placed p JOIN subroots s USING (grp) CROSS JOIN top LEFT JOIN proofs USING (k)
JOIN (SELECT k, arg_max(node, step) AS node FROM fold GROUP BY k) f USING (k)
""",
    "op5_chat_format": r"""
WITH c AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length(replace(role, '<', '<\') || replace(text, '<', '<\')) + 9 + 7 + 8)::BIGINT AS formatted_chars
FROM t GROUP BY conv_id
""".replace("\\\\", "\\"),
    "op9_multi_index_search": """
WITH v AS (SELECT DISTINCT vec_id, [coalesce(x, 0) > 0 FOR x IN embedding] AS code
           FROM embeddings WHERE embedding IS NOT NULL AND vec_id IS NOT NULL),
d AS (SELECT q.vec_id AS query, v.vec_id, len([x FOR x IN list_zip(q.code, v.code) IF x[1] <> x[2]]) AS distance
      FROM v q JOIN v ON q.vec_id % 100 = 0 AND q.vec_id <> v.vec_id)
SELECT query, row_number() OVER (PARTITION BY query ORDER BY distance, vec_id) AS rank, vec_id, distance
FROM d QUALIFY rank <= 10
""",
    "op8_ngram_jaccard_join": f"""
WITH RECURSIVE
  w AS (SELECT doc_id, {_WORDS} AS words FROM documents),
  g AS (
    SELECT DISTINCT doc_id, gram FROM (
      SELECT doc_id, unnest(CASE WHEN len(words) >= 4
               THEN [array_to_string(words[i:i + 3], ' ') FOR i IN range(1, len(words) - 2)]
               WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END) AS gram FROM w)),
  n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
  hits AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM g x JOIN g y ON x.gram = y.gram AND x.doc_id <> y.doc_id GROUP BY ALL),
  links AS (SELECT a, b FROM hits JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
            WHERE 100 * c >= 85 * (na.n + nb.n - c)),
  reach(doc_id, other) AS (
    SELECT doc_id, doc_id FROM documents
    UNION
    SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, r.component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id
JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) r ON r.doc_id = d.doc_id
""",
}
