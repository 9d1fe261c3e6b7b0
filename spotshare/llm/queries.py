"""The queries of the numbered operators, and the SQL that states the results of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from spotshare.llm import bpe, conversations, licences, pieces, quality, ranking, rules, sharding, simhash, suffixes, templates, toxicity, urls
from spotshare.llm.common import bucket_of_id, table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
PIECE_MODEL = "piece_bpe_32k.model"


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, quality.training_labels(table(spark, sf_dir, "labels"), "toxic", 4, 2))
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id", (bucket_of_id("doc_id", 4) == 2).alias("held_out"), F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.3).cast("int").alias("predicted"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages").select("page_id", "url")).drop("url")


def op5_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.placement(table(spark, sf_dir, "documents"))


def op6_benchmark_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.removal_digests(table(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.withColumn("fingerprint", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    vectors, net = quality.train(docs, quality.training_labels(table(spark, sf_dir, "labels"), "quality", 3, 1))
    return quality.score(docs, vectors, net).select(
        "doc_id", (bucket_of_id("doc_id", 3) == 1).alias("held_out"), F.col("quality_score").alias("score"),
        (F.col("quality_score") >= 0.5).cast("int").alias("predicted"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.prefix_trie(table(spark, sf_dir, "conversations")).drop("node", "parent")


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = ranking.build_index(table(spark, sf_dir, "documents"))
    return ranking.search(index, table(spark, sf_dir, "benchmark"), 20)


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_MODEL))


QUERIES = {f.__name__: f for f in (
    op1_license_scan, op2_toxicity, op3_quality_rules, op4_url_filter, op5_hilbert_shards, op6_benchmark_templates, op7_suffix_dedup,
    op8_simhash, op9_quality_classifier, op10_byte_bpe, op11_conversation_trie,
    op12_ranked_search, op13_sentencepiece)}

_WORDS = r"'[^\x20\x09-\x0D]+'"

ORACLES = {
    "op3_quality_rules": rf"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), {_WORDS}) AS words,
         [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(x, {_WORDS})] AS lines
  FROM documents),
five AS (
  SELECT *, [array_to_string(words[i:i + 4], ' ') FOR i IN range(1, greatest(len(words) - 3, 1))] AS windows FROM w),
ids AS (SELECT *, row_number() OVER () AS row FROM five),
places AS (SELECT row, unnest(windows) AS win, unnest(range(1, len(windows) + 1)) AS place FROM ids),
starts AS (SELECT row, place FROM (SELECT row, place, count(*) OVER (PARTITION BY row, win) AS n FROM places) WHERE n > 1),
covered AS (SELECT row, count(DISTINCT place + k) AS n FROM starts, range(0, 5) AS r(k) GROUP BY row),
base AS (
  SELECT doc_id, text, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words
  FROM ids LEFT JOIN covered USING (row)),
failed AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM base)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR word_chars < 2 * n_words OR word_chars > 15 * n_words
            OR 10 * n_dup_lines > 3 * len(string_split(text, chr(10)))
            OR 2 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > word_chars
            OR 10 * (length(text) - length(replace(text, '!!', ''))) > 4 * n_words) AS kept
FROM failed""",
    "op4_url_filter": r"""
WITH parts AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
sites(action, rule_host, rule_path) AS (VALUES
  ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
ids AS (SELECT *, row_number() OVER () AS row FROM parts),
fits AS (
  SELECT row, arg_max(action, length(rule_host || rule_path)) AS action, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule
  FROM ids JOIN sites ON ('.' || host) LIKE ('%.' || rule_host) AND starts_with(path, rule_path) GROUP BY row)
SELECT page_id, host, path, rule, coalesce(action, CASE WHEN
    host LIKE 'ads.%' AND starts_with(path, '/') OR host LIKE '%.ads.%' AND starts_with(path, '/')
    OR regexp_matches(host, 'ads-track|doubleclick|tracker\.|casino|xxx\.') AND starts_with(path, '/')
    OR regexp_matches(path, '(?s)^/(.*/)?ads/|^/.*\.exe$|^/.*\.zip$|^/(.*/)?login|^/cart|^/wp-admin/|^/.*\.php.\.bak$')
    OR host LIKE '%.onion' AND starts_with(path, '/') THEN 'block' ELSE 'allow' END) AS verdict
FROM ids LEFT JOIN fits USING (row)""",
    "op11_conversation_trie": r"""
WITH RECURSIVE bits(n, step, v) AS (
  SELECT range, 0, range FROM range(256)
  UNION ALL SELECT n, step + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM bits WHERE step < 8),
crcs AS (SELECT list(v ORDER BY n) AS of_byte FROM bits WHERE step = 8),
said AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT *, md5(strlen(role)::VARCHAR || ':' || role || text) AS turn_key,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(strlen(role)::VARCHAR || ':' || role || text)) AS nth
  FROM said),
convs AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base,
         xor(list_reduce(list_prepend(4294967295, [ord(c)::BIGINT FOR c IN string_split(conv_id::VARCHAR, '')]),
                         lambda crc, byte: xor(crc >> 8, of_byte[(xor(crc, byte) & 255) + 1])), 4294967295) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM said), crcs),
built AS (
  SELECT c.conv_id, o.nth - 4 AS nth, o.text, o.turn_key FROM convs c JOIN own o ON o.conv_id = c.base AND o.nth <= c.h
  UNION ALL SELECT c.conv_id, o.nth, o.text, o.turn_key FROM convs c JOIN own o ON o.conv_id = c.conv_id AND o.nth > c.h),
prefixes AS (
  SELECT conv_id, row_number() OVER w AS depth, string_agg(turn_key, '') OVER w AS node,
         len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words
  FROM built WINDOW w AS (PARTITION BY conv_id ORDER BY nth ROWS UNBOUNDED PRECEDING)
  UNION ALL SELECT conv_id, 0, '', 0 FROM convs),
lasts AS (SELECT conv_id, arg_max(node, depth) AS node FROM prefixes GROUP BY conv_id),
ends AS (SELECT node, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids FROM lasts GROUP BY node),
nodes AS (SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words FROM prefixes GROUP BY node, depth),
grown AS (
  SELECT n.*, p.conv_id AS parent_conv_id, (SELECT count(*) FROM nodes c WHERE c.depth = n.depth + 1 AND starts_with(c.node, n.node)) AS n_children
  FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND starts_with(n.node, p.node)),
sums AS (
  SELECT u.node, count(*) FILTER (v.n_children = 0) AS n_leaves, sum((v.n_convs - 1) * v.words) AS saved_tokens
  FROM grown u JOIN grown v ON starts_with(v.node, u.node) GROUP BY u.node)
SELECT conv_id, depth::BIGINT AS depth, parent_conv_id, n_convs::BIGINT AS n_convs, n_children::BIGINT AS n_children,
       n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM grown JOIN sums USING (node) LEFT JOIN ends USING (node)""",
    "op12_ranked_search": r"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
held AS (SELECT row, doc_id, terms, len(terms)::BIGINT AS n FROM docs WHERE len(terms) > 0),
stats AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM held),
counts AS (SELECT row, term, count(*)::BIGINT AS tf FROM (SELECT row, unnest(terms) AS term FROM held) GROUP BY row, term),
weights AS (
  SELECT term, floor(1000 * ln((2.0::DOUBLE * any_value(n_docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM counts, stats GROUP BY term),
items AS (
  SELECT row_number() OVER () AS item, item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM benchmark),
asked AS (SELECT item, item_id, term, count(*)::BIGINT AS times FROM (SELECT item, item_id, unnest(terms) AS term FROM items) GROUP BY item, item_id, term),
scored AS (
  SELECT item, any_value(item_id) AS item_id, row, any_value(doc_id) AS doc_id,
         sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN counts USING (term) JOIN held USING (row), stats GROUP BY item, row),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 20""",
}
