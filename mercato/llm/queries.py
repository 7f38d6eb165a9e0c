"""The operators applied to whole tables, and DuckDB SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.llm import (
    collocations, fingerprint, hard_negatives, language_id, lm_scoring, mixing, near_dedup, packing, quality, sentence_pieces, token_counts, topk,
    url_filter,
)
from mercato.llm.common import crc_of_id, table


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op2_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(table(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_path())


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_of_id(F.col("doc_id")) % 4 == 2
    prototypes = language_id.learn(docs, ~held_out)
    return language_id.predict(docs, prototypes).select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"),
                                                        "lang_pred", "score")


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target is the documents labelled as of good quality."""
    docs = table(spark, sf_dir, "documents")
    return lm_scoring.score_corpus(docs, table(spark, sf_dir, "labels").filter("quality = 1"))


def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.exact_top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


URL_RULES = """SELECT * FROM VALUES
  ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block') AS rules(host, path, verdict)"""


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), spark.sql(URL_RULES))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_of_id(F.col("doc_id")) % 5 == 0
    field = quality.learn(docs, table(spark, sf_dir, "labels"), ~held_out)
    return quality.score(docs, field).select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score",
                                             (F.col("score") >= 0.3).cast("int").alias("predicted"))


#: Sources are weighted by the square root of their sizes.
MIX_POWER = 0.5


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mixing.replicate(docs, mixing.tempered(docs, MIX_POWER))


def op11_collocation_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh id carries the next label, so that near vectors of other labels exist."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return hard_negatives.hard_negatives(vectors, F.col("vec_id") % 100 == 0)


def op13_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    coded = sentence_pieces.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return coded.select("doc_id", F.expr("octet_length(ids) div 4").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"), "agrees")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_document_fingerprints": op2_document_fingerprints,
    "op3_token_counts": op3_token_counts,
    "op4_language_id": op4_language_id,
    "op5_lm_scoring": op5_lm_scoring,
    "op6_exact_top_k": op6_exact_top_k,
    "op7_minhash_near_dedup": op7_minhash_near_dedup,
    "op8_url_filters": op8_url_filters,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_source_mixing": op10_source_mixing,
    "op11_collocation_mining": op11_collocation_mining,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_sentence_pieces": op13_sentence_pieces,
}

ORACLE: dict[str, str] = {}

ORACLE["op6_exact_top_k"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

ORACLE["op8_url_filters"] = r"""
WITH u AS (
  SELECT page_id, url, CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS after
  FROM pages),
p AS (
  SELECT row_number() OVER () AS row_id, page_id,
         translate(regexp_extract(after, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(after, '^[^/?#]*([^?#]*)', 1) AS path
  FROM u),
r(rule_host, rule_path, rule_verdict) AS (VALUES
  ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
m AS (
  SELECT p.*, rule_host || rule_path AS rule, rule_verdict,
         row_number() OVER (PARTITION BY row_id ORDER BY length(rule_host || rule_path) DESC NULLS LAST, length(rule_host) DESC) AS place
  FROM p LEFT JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT page_id, host, path, rule, coalesce(rule_verdict, 'allow') AS verdict FROM m WHERE place = 1
"""

ORACLE["op10_source_mixing"] = """
WITH n AS (SELECT source, count(*) AS n, pow(count(*)::DOUBLE, 0.5) AS w FROM documents GROUP BY source),
rates AS (
  SELECT source, w / (SELECT sum(w) FROM n) * (SELECT sum(n) FROM n) / n AS rate FROM n),
draws AS (
  SELECT source, CAST(ceil(rate / 16.0) AS BIGINT) AS draws, rate / CAST(ceil(rate / 16.0) AS BIGINT) AS mean FROM rates),
cdf AS (
  SELECT source, draws, k, sum(exp(k * ln(mean) - mean - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS p
  FROM draws, range(0, 86) AS t(k)),
drawn AS (
  SELECT d.*, dr.draw,
         CAST('0x' || substr(md5('1|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || CAST(dr.draw AS VARCHAR)), 1, 13) AS BIGINT)
           / CAST(4503599627370496 AS DOUBLE) AS u
  FROM documents d JOIN (SELECT source, unnest(range(0, draws)) AS draw FROM draws) dr ON d.source IS NOT DISTINCT FROM dr.source),
counted AS (
  SELECT x.doc_id, x.text, x.lang, x.source, x.n_chars, x.draw, count(*) AS copies
  FROM (SELECT row_number() OVER () AS r, * FROM drawn) x JOIN cdf c ON x.source IS NOT DISTINCT FROM c.source AND c.p <= x.u
  GROUP BY x.r, x.doc_id, x.text, x.lang, x.source, x.n_chars, x.draw)
SELECT doc_id, text, lang, source, n_chars, draw * 86 + i AS copy,
       md5('place|1|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || CAST(draw * 86 + i AS VARCHAR)) AS shuffle_key
FROM (SELECT *, unnest(range(0, copies)) AS i FROM counted)
"""

ORACLE["op11_collocation_mining"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
worded AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM worded GROUP BY lang),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM worded),
spans AS (SELECT lang, w, i, unnest(range(1, 6)) AS m FROM starts),
f AS (
  SELECT lang, list_slice(w, i, i + m - 1) AS p, m, count(*) AS f
  FROM spans WHERE i + m - 1 <= len(w) GROUP BY ALL HAVING count(*) >= 100),
cuts AS (SELECT lang, p, m, f AS a, unnest(range(1, m)) AS k FROM f WHERE m >= 2),
scored AS (
  SELECT c.lang, c.p, c.m, a, k, x.f AS l, y.f AS r, n,
         CAST((1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
  FROM cuts c JOIN n USING (lang)
  JOIN f x ON x.lang = c.lang AND x.p = list_slice(c.p, 1, k)
  JOIN f y ON y.lang = c.lang AND y.p = list_slice(c.p, k + 1, c.m)),
low AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
inner_of AS (
  SELECT DISTINCT lang, list_slice(p, i, i + q - 1) AS p, f
  FROM (SELECT lang, p, m, f, q, unnest(range(1, m - q + 2)) AS i
        FROM (SELECT lang, p, m, f, unnest(range(2, m)) AS q FROM f WHERE m >= 3))),
gone AS (SELECT DISTINCT l.lang, l.p FROM low l JOIN inner_of o ON o.lang = l.lang AND o.p = l.p AND 100 * o.f >= 100 * l.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank,
       array_to_string(p, ' ') AS phrase, a, l, r, n, score
FROM low ANTI JOIN gone USING (lang, p)
QUALIFY rank <= 2000
"""

ORACLE["op12_hard_negatives"] = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS anchor_id, c.vec_id AS vec_id, q.label = c.label AS same,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""
