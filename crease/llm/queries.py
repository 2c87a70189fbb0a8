"""Registered queries of the training-data operators, one for each, over its
whole table with production parameters, and DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crease.llm import conversation_trie, decontamination, embedding_dedup, filter_audit, language_id, mixing, secret_scan, sharding, simhash, suffix_dedup, token_counts, url_filter, warc
from crease.llm.common import load
from crease.session import scratch_path

# fixed values: the contract's rules, by name and verdict
URL_RULES = [
    url_filter.Rule.parse("org/", True),
    url_filter.Rule.parse("example.org/es/", False),
    url_filter.Rule.parse("example.org/en/1", False),
    url_filter.Rule.parse("com/fr/", True),
    url_filter.Rule.parse("com/de/", False),
]

TARGET_ENTROPY = 0.95  # of the greatest possible one
SECRET_SAMPLE = 20_000  # documents the Markov models are trained on
TOKENIZER = "word_bpe_49k.json"
TOKEN_LIMIT = 2048


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources flattened to the target entropy; as many tokens as the corpus has."""
    return mixing.mix_sources(load(spark, sf_dir, "documents"), budget_share=1.0, target_entropy=TARGET_ENTROPY)


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicate_vectors(load(spark, sf_dir, "embeddings"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the archives, then take every value from what is read back."""
    folder = scratch_path(spark, "llm-warc")
    warc.write_warc(load(spark, sf_dir, "pages"), folder)
    records = warc.read_warc(spark, folder)
    return records.select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    fold = language_id.held_out(F.col("doc_id"))
    model = language_id.train(docs.filter(~fold))
    rows = docs.select("doc_id", fold.alias("held_out"), "text")
    return language_id.predict(rows, model).select("doc_id", "held_out", "lang_pred", "score")


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    models = secret_scan.train(secret_scan.training_sample(docs, "doc_id", SECRET_SAMPLE))
    return secret_scan.digest_columns(secret_scan.find_secrets(docs, models))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(load(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_contamination(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(load(spark, sf_dir, "documents"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's columns and, behind them, whether a document loses anything."""
    found = suffix_dedup.remove_repeats(load(spark, sf_dir, "documents")).drop("spans")
    return found.withColumn("has_repeats", F.col("n_removed") > 0)


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = load(spark, sf_dir, "pages")
    model = url_filter.train(url_filter.labelled_by_rules(pages, URL_RULES))
    return url_filter.judge_urls(pages, URL_RULES, model).select("page_id", "host", "path", "rule", "verdict")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_filters(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts.count_tokens(load(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), limit=TOKEN_LIMIT)


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.conversation_trie(load(spark, sf_dir, "conversations"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "pipeline": pipeline,
    "op1_mixing": op1_mixing,
    "op2_embedding_dedup": op2_embedding_dedup,
    "op3_warc": op3_warc,
    "op4_language_id": op4_language_id,
    "op5_secret_scan": op5_secret_scan,
    "op6_simhash": op6_simhash,
    "op7_decontamination": op7_decontamination,
    "op8_sharding": op8_sharding,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_url_filter": op10_url_filter,
    "op11_filter_audit": op11_filter_audit,
    "op12_token_counts": op12_token_counts,
    "op13_conversation_trie": op13_conversation_trie,
}

_OP2 = """WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
),
ok AS (
  SELECT vec_id, e FROM v
  WHERE e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0
),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b
    ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95
),
reach(a, b) AS (
  SELECT vec_id, vec_id FROM v UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a
),
low AS (SELECT a, MIN(b) AS component_id FROM reach GROUP BY a),
cnt AS (SELECT a, COUNT(*) AS n FROM link GROUP BY a)
SELECT v.vec_id, CAST(COALESCE(n, 0) AS BIGINT) AS n_links, component_id, v.vec_id = component_id AS kept
FROM v JOIN low ON low.a = v.vec_id LEFT JOIN cnt ON cnt.a = v.vec_id"""

_OP3 = """WITH p AS (
  SELECT page_id, CAST(strlen(COALESCE(html, '')) AS BIGINT) AS payload_bytes, sha1(COALESCE(html, '')) AS payload_digest FROM pages
),
last AS (SELECT payload_digest AS d, MAX(page_id) AS last_id FROM p WHERE payload_bytes >= 1000 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN last_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN last_id <> page_id THEN last_id END AS refers_to
FROM p LEFT JOIN last ON d = payload_digest AND payload_bytes >= 1000"""

_OP9 = """WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, encode(COALESCE(text, '')) AS b FROM documents
),
s AS MATERIALIZED (
  SELECT r, p, md5(b[p:p + 399]) AS h FROM (SELECT r, b, unnest(range(1, octet_length(b) - 398)) AS p FROM d WHERE octet_length(b) >= 400)
),
again AS (SELECT h FROM s GROUP BY h HAVING COUNT(*) > 1),
starts AS (
  SELECT r, p, CASE WHEN p > lag(p) OVER (PARTITION BY r ORDER BY p) + 400 THEN 1 ELSE 0 END AS begins
  FROM s WHERE h IN (SELECT h FROM again)
),
runs AS (
  SELECT r, MIN(p) AS a, MAX(p) + 399 AS z FROM (SELECT r, p, SUM(begins) OVER (PARTITION BY r ORDER BY p) AS run FROM starts) GROUP BY r, run
),
removed AS (SELECT r, SUM(z - a + 1) AS n_removed, COUNT(*) AS n_spans FROM runs GROUP BY r),
gaps AS (
  SELECT r, z + 1 AS x, COALESCE(lead(a) OVER (PARTITION BY r ORDER BY a) - 1, 9223372036854775000) AS y FROM runs
  UNION ALL
  SELECT r, 1, MIN(a) - 1 FROM runs GROUP BY r
),
kept AS (SELECT r, string_agg(hex(b[x:least(y, octet_length(b))]), '' ORDER BY x) AS text FROM gaps JOIN d USING (r) WHERE x <= least(y, octet_length(b)) GROUP BY r)
SELECT doc_id, octet_length(b) AS n_bytes, CAST(COALESCE(n_removed, 0) AS BIGINT) AS n_removed, COALESCE(n_spans, 0) AS n_spans,
       CASE WHEN n_spans IS NULL THEN sha256(b) ELSE sha256(unhex(COALESCE(text, ''))) END AS kept_sha256, n_spans IS NOT NULL AS has_repeats
FROM d LEFT JOIN removed USING (r) LEFT JOIN kept USING (r)"""

_OP11 = r"""WITH RECURSIVE d AS (
  SELECT doc_id, COALESCE(lang, '') AS part, COALESCE(text, '') AS text FROM documents
),
w AS (
  SELECT doc_id, part, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM d
),
first AS (SELECT text AS t, MIN(doc_id) AS first_id FROM d GROUP BY 1),
known AS (SELECT doc_id AS of_id, MAX(quality = 1) AS good, MAX(toxic = 1) AS toxic FROM labels GROUP BY 1),
m AS (
  SELECT part, COALESCE(good, false) AS good, COALESCE(toxic, false) AS toxic,
         len(words) < 100 AS a,
         100 * len(list_distinct(words)) < 80 * len(words) AS b,
         100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) AS c,
         regexp_matches(text, '[#$%&*|]') AS d,
         COALESCE(first_id < doc_id, false) AS e
  FROM w JOIN first ON t = text LEFT JOIN known ON of_id = doc_id
),
cells AS (
  SELECT part, a::INT + b::INT * 2 + c::INT * 4 + d::INT * 8 + e::INT * 16 AS mask, COUNT(*) AS n,
         COUNT(*) FILTER (good) AS good, COUNT(*) FILTER (toxic) AS toxic
  FROM m GROUP BY ALL
),
orders(filter_order, active) AS (
  SELECT '', 0
  UNION ALL
  SELECT filter_order || f, active + bit FROM orders, (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(f, bit)
  WHERE active & bit = 0
),
steps AS (
  SELECT o.filter_order, s.step, substr(o.filter_order, s.step, 1) AS f,
         1 << (ascii(substr(o.filter_order, s.step, 1)) - 65) AS bit,
         COALESCE((SELECT SUM(1 << (ascii(substr(o.filter_order, k, 1)) - 65)) FROM range(1, s.step) r(k)), 0)::INT AS before
  FROM orders o, (SELECT unnest([1, 2, 3, 4, 5]) AS step) s WHERE length(o.filter_order) = 5
),
run AS (
  SELECT part, filter_order, step, f,
         COALESCE(SUM(n) FILTER (mask & (before | bit) = 0), 0) AS kept,
         COALESCE(SUM(n) FILTER (mask & before = 0 AND mask & bit <> 0), 0) AS removed,
         COALESCE(SUM(n) FILTER (mask & before <> 0 AND mask & bit <> 0), 0) AS redundant,
         COALESCE(SUM(n) FILTER (mask = bit), 0) AS unique_fails,
         COALESCE(SUM(good) FILTER (mask & before = 0 AND mask & bit <> 0), 0) AS good_lost,
         COALESCE(SUM(toxic) FILTER (mask & before = 0 AND mask & bit <> 0), 0) AS toxic_lost
  FROM cells, steps GROUP BY part, filter_order, step, f
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(SUM(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM run"""

# crc32 of the few bytes of a decimal number, bit by bit over the reflected polynomial 0xEDB88320
_OP13 = r"""WITH RECURSIVE convs AS (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL),
crc(conv_id, k, c) AS (
  SELECT conv_id, 0, 4294967295::BIGINT FROM convs
  UNION ALL
  SELECT conv_id, k + 1, list_reduce(
    list_prepend(xor(c, ascii(substr(conv_id::VARCHAR, k + 1, 1))), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
    lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)
  FROM crc WHERE k < length(conv_id::VARCHAR)
),
h AS (SELECT conv_id, xor(c, 4294967295) % 6 AS h FROM crc WHERE k = length(conv_id::VARCHAR)),
t AS (
  SELECT conv_id, COALESCE(role, '') AS role, COALESCE(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, COALESCE(role, ''), COALESCE(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
),
r AS (
  SELECT h.conv_id, 0 AS own, pos, role, text FROM h JOIN t ON t.conv_id = h.conv_id - h.conv_id % 100 AND pos <= h
  UNION ALL
  SELECT h.conv_id, 1, pos, role, text FROM h JOIN t ON t.conv_id = h.conv_id AND pos > h
),
seq AS (
  SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY own, pos) AS d FROM r
),
keyed AS (
  SELECT conv_id, d, length(text) AS chars,
         list(md5(role || chr(1) || text)) OVER (PARTITION BY conv_id ORDER BY d) AS key
  FROM seq
),
node AS (
  SELECT d, key, md5(array_to_string(key, '')) AS id, CASE WHEN d > 1 THEN md5(array_to_string(key[:d - 1], '')) ELSE 'root' END AS up,
         MIN(conv_id) AS conv_id, COUNT(*) AS n, MIN(chars) AS chars
  FROM keyed GROUP BY d, key
  UNION ALL
  SELECT 0, [], 'root', NULL, MIN(conv_id), COUNT(*), 0 FROM convs HAVING COUNT(*) > 0
),
ends AS (
  SELECT id, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids
  FROM (SELECT c.conv_id, COALESCE((SELECT md5(array_to_string(arg_max(k.key, k.d), '')) FROM keyed k WHERE k.conv_id = c.conv_id), 'root') AS id FROM convs c)
  GROUP BY id
),
kids AS (SELECT up AS id, COUNT(*) AS n_children FROM node WHERE up IS NOT NULL GROUP BY up),
above(id, anc) AS (
  SELECT id, id FROM node UNION ALL SELECT above.id, node.up FROM above JOIN node ON node.id = above.anc WHERE node.up IS NOT NULL
),
sums AS (
  SELECT anc AS id, COUNT(*) FILTER (kids.id IS NULL) AS n_leaves, SUM((n - 1) * chars) AS saved_tokens
  FROM above JOIN node ON node.id = above.id LEFT JOIN kids ON kids.id = above.id GROUP BY anc
)
SELECT node.conv_id, CAST(node.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, CAST(node.n AS BIGINT) AS n_convs,
       CAST(COALESCE(n_children, 0) AS BIGINT) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens,
       sha256(COALESCE(ids, '')) AS ends_sha256
FROM node JOIN sums ON sums.id = node.id LEFT JOIN kids ON kids.id = node.id LEFT JOIN ends ON ends.id = node.id LEFT JOIN node p ON p.id = node.up"""

ORACLE_SQL: dict[str, str] = {"op2_embedding_dedup": _OP2, "op3_warc": _OP3, "op9_suffix_dedup": _OP9, "op11_filter_audit": _OP11, "op13_conversation_trie": _OP13}
