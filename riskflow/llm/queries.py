"""One query per operator, each with production parameters over its whole table."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.llm import (
    byte_bpe,
    chat_format,
    decontaminate,
    exact_dedup,
    hard_negatives,
    language_id,
    near_dedup,
    ppm,
    quality,
    ranked_search,
    secret_scan,
    token_files,
    url_filter,
)
from riskflow.llm.common import crc_remainder, table


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), url_filter.rules_table(spark))


def op2_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    trains = crc_remainder("doc_id", 10) != 0
    return ppm.score_documents(table(spark, sf_dir, "documents"), trains)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_remainder("doc_id", 4) == 2
    model = language_id.fit(docs, ~held_out)
    return language_id.identify(docs, model, "doc_id", "text", held_out.alias("held_out"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = table(spark, sf_dir, "benchmark")
    return decontaminate.find_passages(table(spark, sf_dir, "documents"), benchmark)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame(
        [(-1, 0, "user", said), (-1, 1, "assistant", said)],
        "conv_id bigint, turn int, role string, text string",
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat_format.formatted_digests(rows.unionByName(extra))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = table(spark, sf_dir, "documents")
    return byte_bpe.round_trip(spark, docs, vocabulary, public_tokenizers.PATTERN)


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return token_files.round_trip(spark, table(spark, sf_dir, "documents"), path, end_id=2)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = ranked_search.build_index(table(spark, sf_dir, "documents"))
    return ranked_search.search(index, table(spark, sf_dir, "benchmark"), k=10)


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secret_scan.scan_digests(docs, secret_scan.train(secret_scan.labelled_samples(docs)))


QUERIES = {
    "op1_url_filter": op1_url_filter,
    "op2_ppm": op2_ppm,
    "op3_language_id": op3_language_id,
    "op4_decontaminate": op4_decontaminate,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_chat_format": op6_chat_format,
    "op7_near_dedup": op7_near_dedup,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_token_files": op9_token_files,
    "op10_quality": op10_quality,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_ranked_search": op12_ranked_search,
    "op13_secret_scan": op13_secret_scan,
    "pipeline": corpus_pipeline.run,
}

ORACLE_SQL = {
    "op1_url_filter": """
WITH rules(action, host, path) AS (
  VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
         ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
), cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0
                       THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), parts AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut
), judged AS (
  SELECT p.page_id, p.host, p.path,
         arg_max(r, length(r.host) + length(r.path)) AS best
  FROM parts p LEFT JOIN rules r
    ON (p.host = r.host OR p.host LIKE '%.' || r.host) AND starts_with(p.path, r.path)
  GROUP BY ALL
)
SELECT page_id, host, path, best.host || best.path AS rule,
       coalesce(best.action, 'allow') AS verdict
FROM judged
""",
    "op5_exact_dedup": r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM n WINDOW w AS (PARTITION BY t)
""",
    "op6_chat_format": r"""
WITH t AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
  SELECT *, CASE role WHEN 'user' THEN 6 WHEN 'system' THEN 5 WHEN 'assistant' THEN 5
                 ELSE 13 + length(role) END + length(text) + 4
         + len(regexp_extract_all(text, '\\|</?s>|\[/?(?:SYS|INST|ANS|ROLE)\]')) AS chars
  FROM t
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
""",
    "op12_ranked_search": r"""
WITH words AS (
  SELECT row_number() OVER () AS doc, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), sized AS (SELECT doc, doc_id, terms, len(terms) AS n FROM words WHERE len(terms) > 0
), corpus AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_words FROM sized
), postings AS (
  SELECT doc, term, count(*) AS tf FROM (SELECT doc, unnest(terms) AS term FROM sized) GROUP BY ALL
), weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w
  FROM postings, corpus GROUP BY term
), asked AS (
  SELECT item, item_id, term, count(*) AS times FROM (
    SELECT row_number() OVER () AS item, item_id,
           unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark) GROUP BY ALL
), scored AS (
  SELECT item, any_value(item_id) AS item_id, doc, any_value(doc_id) AS doc_id,
         sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_words))))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN postings USING (term) JOIN sized USING (doc), corpus
  GROUP BY item, doc
)
SELECT item_id, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scored WHERE score > 0
QUALIFY rank <= 10
""",
    "op11_hard_negatives": """
WITH usable AS (
  SELECT row_number() OVER () AS row, vec_id,
         CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), anchors AS (
  SELECT row_number() OVER () AS anchor, * FROM (SELECT DISTINCT vec_id, label, v FROM usable WHERE vec_id % 100 = 0)
), parts AS (
  SELECT row, vec_id, label, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM usable
), scored AS (
  SELECT a.anchor, p.row, any_value(a.vec_id) AS anchor_id, any_value(p.vec_id) AS id,
         any_value(a.label) = any_value(p.label) AS same, sum(a.x * p.x)::BIGINT AS score
  FROM (SELECT anchor, vec_id, label, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM anchors) a
  JOIN parts p USING (d) GROUP BY a.anchor, p.row
), positives AS (
  SELECT anchor, row AS positive, anchor_id, id AS positive_id, score AS positive_score
  FROM scored WHERE same AND id <> anchor_id
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       row_number() OVER (PARTITION BY p.anchor, p.positive ORDER BY s.score DESC, s.id)::INTEGER AS rank,
       s.id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s
  ON p.anchor = s.anchor AND NOT s.same AND 30 * p.positive_score <= 100 * s.score
     AND 100 * s.score <= 90 * p.positive_score
QUALIFY rank <= 10
""",
}
