"""The registered queries: one thin query per operator, and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm import (decontaminate, langid, line_dedup, mixing, ngram_join, quality, rollup, secrets,
                          token_alignment, token_files, toxicity, url_filter, whitening)
from lakeloom.llm._io import held_out, read

URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
             ("block", "net/es/"), ("block", "net/fr/")]


TOXIC_FROM = 0.7


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"), ~held_out("doc_id", 3, 1))
    out = toxicity.score(docs, model)
    return out.select("doc_id", F.coalesce(held_out("doc_id", 3, 1), F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(read(spark, sf_dir, "documents"))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(read(spark, sf_dir, "documents"))


OP3_SQL = r"""
WITH RECURSIVE word AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, hash(CASE WHEN len(w) < 4 THEN w ELSE w[s:s + 3] END) AS t FROM word,
    LATERAL (SELECT unnest(generate_series(1, greatest(1, len(w) - 3))) AS s) WHERE len(w) > 0),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
-- linked documents share one of the first n - ceil(0.85 n) + 1 shingles in any common order; here the rarest come first
placed AS (
  SELECT doc_id, t, n, row_number() OVER (PARTITION BY doc_id ORDER BY df, t) AS r
  FROM shingle JOIN size USING (doc_id) JOIN (SELECT t, count(*) AS df FROM shingle GROUP BY t) USING (t)),
prefix AS (SELECT doc_id, t, n FROM placed WHERE r <= n - (85 * n + 99) // 100 + 1),
candidate AS (
  SELECT DISTINCT a.doc_id AS x, b.doc_id AS y, a.n AS nx, b.n AS ny FROM prefix a JOIN prefix b
    ON a.t = b.t AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)),
link AS (
  SELECT x, y FROM candidate JOIN shingle a ON a.doc_id = x JOIN shingle b ON b.doc_id = y AND a.t = b.t
  GROUP BY x, y, nx, ny HAVING 100 * count(*) >= 85 * (nx + ny - count(*))),
edge AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach(doc_id, other) AS (
  SELECT x, y FROM edge UNION SELECT r.doc_id, e.y FROM reach r JOIN edge e ON e.x = r.other)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(m, d.doc_id)) AS component_id
FROM documents d LEFT JOIN size USING (doc_id) LEFT JOIN (SELECT doc_id, min(other) AS m FROM reach GROUP BY doc_id) USING (doc_id)
"""


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(read(spark, sf_dir, "documents"))


OP4_SQL = r"""
WITH lines AS (
  SELECT doc_id, u.line, u.n FROM documents,
    LATERAL (SELECT unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS n) u),
keyed AS (
  SELECT doc_id, line, n, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
repeated AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT doc_id, line, n, r.k IS NOT NULL AND doc_id <> keeper AS gone FROM keyed LEFT JOIN repeated r USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return quality.judge(docs, quality.fit(docs, read(spark, sf_dir, "labels")))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = langid.fit(docs, ~held_out("doc_id", 4, 2))
    out = langid.predict(docs, model)
    return out.select("doc_id", F.coalesce(held_out("doc_id", 4, 2), F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")


def op8_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.corpus_history(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items",
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


OP9_SQL = r"""
WITH doc AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(13, len(w)) AS size, w[s:s + 12] AS win FROM item,
    LATERAL (SELECT unnest(generate_series(1, greatest(1, len(w) - 12))) AS s) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT size FROM win),
spot AS (SELECT doc_id, size, s, w[s:s + size - 1] AS win FROM doc, sizes,
    LATERAL (SELECT unnest(generate_series(1, len(w) - size + 1)) AS s) WHERE len(w) >= size),
hit AS (SELECT doc_id, a.size, s, item_id FROM spot a JOIN win USING (win)),
words AS (SELECT doc_id, count(DISTINCT s + k) AS n_hit FROM hit, LATERAL (SELECT unnest(generate_series(0, size - 1)) AS k) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(read(spark, sf_dir, "pages"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


OP10_SQL = r"""
WITH part AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
url AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM part),
rules(verdict, rule, h, p) AS (VALUES ('allow', 'com/', 'com', '/'), ('block', 'example.com/en/', 'example.com', '/en/'),
  ('allow', 'www.example.com/en/', 'www.example.com', '/en/'), ('block', 'net/es/', 'net', '/es/'), ('block', 'net/fr/', 'net', '/fr/')),
best AS (
  SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict FROM url JOIN rules
    ON (host = h OR host LIKE '%.' || h) AND starts_with(path, p) GROUP BY page_id)
-- these pages hold no redirect and no canonical link, so no decision spreads
SELECT u.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM url u LEFT JOIN best USING (page_id)
"""


def _public(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align_corpus(read(spark, sf_dir, "documents"), _public("byte_bpe_50k.json"), _public("piece_bpe_32k.model"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``deviation`` is null where the exact number does not fit in 64 bits;
    ``deviation_exact`` always holds it."""
    out = whitening.whiten(read(spark, sf_dir, "embeddings"))
    return out.select("vec_id", "component", "n", F.col("deviation").try_cast("long").alias("deviation"), "whitened", "explained",
                      "identity_error", F.col("deviation").alias("deviation_exact"))


END_OF_TEXT = 2


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = token_files.write(read(spark, sf_dir, "documents"), _public("word_bpe_49k.json"), END_OF_TEXT)
    return token_files.documents(spark, folder)


QUERIES = {f.__name__: f for f in (
    op1_toxicity, op2_secret_scan, op3_ngram_join, op4_line_dedup, op5_source_mixing, op6_quality_rules,
    op7_language_id, op8_token_rollup, op9_decontamination, op10_url_filter,
    op11_token_alignment, op12_embedding_whitening, op13_token_files)}
ORACLE_SQL = {"op3_ngram_join": OP3_SQL, "op4_line_dedup": OP4_SQL, "op8_token_rollup": rollup.ORACLE_SQL,
              "op9_decontamination": OP9_SQL, "op10_url_filter": OP10_SQL}
