"""The operators of this package as named queries over the driver's tables, with DuckDB SQL where SQL can say it."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillscope.llm import (
    byte_bpe, hnsw, language_id, maxent_lm, ngram_join, packing, periodic_runs, quality_rules, secret_scan, sql_checks, toxicity,
    tree_bpe, url_rules, vector_codes,
)
from tillscope.llm.common import crc_mod, read_table

Query = Callable[[SparkSession, str], DataFrame]

#: The rules of the url query: host, path, verdict.
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan_documents(read_table(spark, sf_dir, "documents"))
    of = lambda *kinds: secret_scan.of_kinds(F.col("findings"), list(kinds))
    counts = [F.size(of(k)).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")]
    base = secret_scan.spans_text(of("assign", "access", "hex"))
    return found.select(
        F.col("path").alias("doc_id"), *counts, F.sha2(base, 256).alias("base_sha256"),
        secret_scan.spans_text(F.col("findings")).alias("spans"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = crc_mod(F.col("doc_id"), 3) == 1
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels").where(~held_out))
    return toxicity.score(docs, model, ["doc_id"]).select(
        "doc_id", held_out.alias("held_out"), "score", F.col("rejected").cast("int").alias("predicted"), "hits")


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = crc_mod(F.col("doc_id"), 7) == 2
    model, counts = maxent_lm.fit(docs.where(~held_out))
    return maxent_lm.score_texts(docs, model, counts, ["doc_id"]).withColumn("held_out", held_out)


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(read_table(spark, sf_dir, "documents"), n=4, share=85)


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.sql("SELECT * FROM VALUES " + ", ".join(map(str, URL_RULES)) + " AS r(host, path, verdict)")
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return url_rules.judge_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    dictionaries = language_id.learn_dictionaries(docs.where(crc_mod(F.col("doc_id"), 4) != 2))
    return language_id.predict_language(docs, dictionaries).select(
        "doc_id", (crc_mod(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score", "margin", "rejected")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(read_table(spark, sf_dir, "documents"), ["doc_id"]).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance")


def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = hnsw.valid_vectors(read_table(spark, sf_dir, "embeddings"))
    index = hnsw.build_index(vectors, copies=21)  # a query's own id and 20 more
    return hnsw.nearest(vectors.where(F.col("id") % 20 == 0), index, k=20)


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip_digests(
        read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
        public_tokenizers.PATTERN)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(read_table(spark, sf_dir, "embeddings"), parts=16, entries=64, rounds=2, scale=256).select(
        F.col("id").alias("vec_id"), F.lower(F.hex("codes")).alias("code"), "error", "label_error", "codebooks_sha256")


def planted_words(doc_id: int | None, text: str | None) -> list[bytes]:
    """The words of a text, in one of ten documents (by the id's crc32) periodic from some word on; without an id as they are."""
    words = periodic_runs.words_of(text)
    n, h = len(words), 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digests(read_table(spark, sf_dir, "documents"), planted_words)


def op13_tree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tree_bpe.round_trip_digests(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def queries() -> dict[str, Query]:
    return {
        "op1_secret_scans": op1_secret_scans,
        "op2_toxicity": op2_toxicity,
        "op3_lm_scoring": op3_lm_scoring,
        "op4_ngram_join": op4_ngram_join,
        "op5_url_filters": op5_url_filters,
        "op6_language_id": op6_language_id,
        "op7_quality_rules": op7_quality_rules,
        "op8_nearest_neighbours": op8_nearest_neighbours,
        "op9_byte_bpe": op9_byte_bpe,
        "op10_packing": op10_packing,
        "op11_vector_codes": op11_vector_codes,
        "op12_periodic_runs": op12_periodic_runs,
        "op13_tree_bpe": op13_tree_bpe,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    sql = {
        "op1_secret_scans": _op1_sql(),
        "op4_ngram_join": sql_checks.ngram_join_sql(),
        "op5_url_filters": OP5_SQL,
        "op11_vector_codes": sql_checks.vector_codes_sql(),
        "op12_periodic_runs": sql_checks.periodic_runs_sql(),
    }
    return sql | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})


def _op1_sql() -> str:
    """Each kind's matches and the pieces between them give the spans; no ledger, every row on its own."""
    kinds = []
    for i, r in enumerate(secret_scan.RULES):
        pattern = r.pattern.replace("'", "''")
        kinds.append(f"""
  SELECT n, '{r.kind}' AS kind, {i} AS ord,
         string_split_regex(text, '{pattern}') AS p, regexp_extract_all(text, '{pattern}', 0) AS m,
         regexp_extract_all(text, '{pattern}', {r.group}) AS g, {r.least} AS least
  FROM docs WHERE regexp_matches(text, '{pattern}')""")
    return f"""
WITH docs AS (SELECT row_number() OVER () AS n, doc_id, coalesce(text, '') AS text FROM documents),
hits AS ({" UNION ALL ".join(kinds)}),
cut AS (
  SELECT n, kind, ord, least, unnest(range(1, len(m) + 1)) AS i, p, m, g FROM hits
), spans AS (
  SELECT n, kind, ord, sum(length(p[i]) + length(m[i])) OVER (PARTITION BY n, kind ORDER BY i) AS stop,
         length(m[i]) AS size, length(g[i]) >= least AS good
  FROM cut
), joined AS (
  SELECT n, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
         count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(kind || ':' || (stop - size) || ':' || stop, ',' ORDER BY stop - size, ord) FILTER (ord < 3) AS base,
         string_agg(kind || ':' || (stop - size) || ':' || stop, ',' ORDER BY stop - size, ord) AS spans
  FROM spans WHERE good GROUP BY n
)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
       coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN joined USING (n)
"""


OP5_SQL = f"""
WITH parts AS (
  SELECT page_id, url, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), split AS (
  SELECT row_number() OVER () AS n, page_id,
         coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM parts
), rules(rhost, rpath, verdict) AS (VALUES {", ".join(map(str, URL_RULES))}
), hits AS (
  SELECT n, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(verdict, length(rhost || rpath)) AS verdict
  FROM split JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY n
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM split LEFT JOIN hits USING (n)
"""
