"""The registered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import chat_parts, hard_negatives, license_scan, merkle, packing, posting_lists, prefix_trie, rank_queue_bpe, sanitise, tensor_minhash, token_count, toxicity, weak_quality
from strata.llm.common import read_table


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(read_table(spark, sf_dir, "documents"))


def op2_posting_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return posting_lists.nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op3_tensor_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tensor_minhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op4_weak_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return weak_quality.classify(docs, weak_quality.fit(docs))


def op5_sanitise(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sanitise.find_spans(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone",
                        F.sha2(sanitise.span_string(F.col("spans")), 256).alias("base_sha256"),
                        sanitise.span_string(F.col("all_spans")).alias("spans"))


def op6_rank_queue_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_queue_bpe.roundtrip_digests(read_table(spark, sf_dir, "documents"))


def op7_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.compare_with_next(read_table(spark, sf_dir, "documents"))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    planted = r"\### Assistant: </turn> ok"
    turns = read_table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    turns = turns.unionByName(spark.createDataFrame(
        [(-7, 0, "user", planted), (-7, 1, "assistant", planted)], "conv_id long, turn long, role string, text string"))
    return chat_parts.read_back(chat_parts.format_chats(turns.withColumn("parts", chat_parts.text_part(F.col("text")))))


def op9_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(read_table(spark, sf_dir, "documents"))


def op10_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"))


def op11_conv_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op12_threshold_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, label)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(prefix_trie.rebuilt(read_table(spark, sf_dir, "conversations")))


QUERIES = {f.__name__: f for f in (
    op1_license_scan, op2_posting_lists, op3_tensor_minhash, op4_weak_quality, op5_sanitise, op6_rank_queue_bpe,
    op7_merkle, op8_chat_format, op9_token_count, op10_pack, op11_conv_toxicity, op12_threshold_negatives, op13_prefix_trie)}

ORACLE_SQL = {
    "op8_chat_format": r"""
WITH turns AS (
  SELECT conv_id::BIGINT AS conv_id, turn::BIGINT AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations
  UNION ALL
  SELECT * FROM (VALUES (-7::BIGINT, 0::BIGINT, 'user', '\### Assistant: </turn> ok'),
                        (-7::BIGINT, 1::BIGINT, 'assistant', '\### Assistant: </turn> ok'))
), sized AS (
  SELECT *, length(text) + length(role) + length('### ') + length(': ') + length(' </turn>') + 1
    + len(regexp_extract_all(text || ' ', '\\|### |</turn>|<\|')) + len(regexp_extract_all(role, '[\\:]|### |</turn>|<\|')) AS chars
  FROM turns
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
""",
    "op12_threshold_negatives": """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(x::DOUBLE * 256) FOR x IN embedding] AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same, list_inner_product(a.q, r.q)::BIGINT AS score
  FROM rows a JOIN rows r ON a.vec_id % 50 = 0 AND a.vec_id <> r.vec_id
), positive AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT p.anchor_id, positive_id, (row_number() OVER w)::INTEGER AS rank, s.id AS negative_id, positive_score,
       s.score AS negative_score
FROM positive p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT s.same
  AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.id)
QUALIFY row_number() OVER w <= 3
""",
    "op13_prefix_trie": r"""
WITH RECURSIVE turns AS (
  SELECT conv_id::BIGINT AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), crc AS (  -- bit by bit over the decimal digits; a new one comes in with every eighth step
  SELECT DISTINCT c, c::VARCHAR AS digits, 0 AS step, 4294967295::BIGINT AS v FROM turns
  UNION ALL
  SELECT c, digits, step + 1,
    CASE WHEN step % 8 = 0 THEN
      CASE WHEN xor(v, ord(digits[step // 8 + 1])) & 1 = 1 THEN xor(xor(v, ord(digits[step // 8 + 1])) >> 1, 3988292384)
           ELSE xor(v, ord(digits[step // 8 + 1])) >> 1 END
    ELSE CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END END
  FROM crc WHERE step < 8 * length(digits)
), heads AS (
  SELECT c, xor(v, 4294967295) % 4 AS h FROM crc WHERE step = 8 * length(digits)
), rebuilt AS (
  SELECT x.c, 1 AS part, t.pos, t.role, t.text FROM heads x JOIN turns t ON t.c = x.c - x.c % 20 AND t.pos <= x.h
  UNION ALL
  SELECT t.c, 2, t.pos, t.role, t.text FROM turns t JOIN heads x ON t.c = x.c AND t.pos > x.h
), deep AS (
  SELECT c, row_number() OVER w AS depth, text, count(*) OVER (PARTITION BY c) AS n,
    string_agg(md5(length(role) || ':' || role || text), '') OVER w AS path
  FROM rebuilt WINDOW w AS (PARTITION BY c ORDER BY part, pos)
), placed AS (
  SELECT c, depth, path, lag(path, 1, '') OVER (PARTITION BY c ORDER BY depth) AS up, n = depth AS last,
    len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words
  FROM deep
  UNION ALL
  SELECT c, 0, '', NULL, c NOT IN (SELECT c FROM rebuilt), 0 FROM heads
), nodes AS (
  SELECT path, depth, any_value(up) AS up, min(c) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE last), '')) AS ends_sha256
  FROM placed GROUP BY path, depth
), fanned AS (
  SELECT v.*, (SELECT count(*) FROM nodes k WHERE k.up = v.path) AS n_children FROM nodes v
)
SELECT v.conv_id, v.depth::BIGINT AS depth, any_value(p.conv_id) AS parent_conv_id, any_value(v.n_convs) AS n_convs,
  any_value(v.n_children) AS n_children, count(*) FILTER (WHERE u.n_children = 0) AS n_leaves,
  sum((u.n_convs - 1) * u.words)::BIGINT AS saved_tokens, any_value(v.ends_sha256) AS ends_sha256
FROM fanned v JOIN fanned u ON starts_with(u.path, v.path) LEFT JOIN nodes p ON p.path = v.up
GROUP BY v.path, v.conv_id, v.depth
""",
}
