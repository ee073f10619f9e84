"""The training-data queries by name, each over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chosen_path, ego_join, langid, license, line_dedup, mixing, perm_index, quality, suffix_index
from .common import held_out_row, table


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_index.remove_repeats(table(spark, sf_dir, "documents"))


def op2_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perm_index.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op3_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.near_duplicates(table(spark, sf_dir, "documents"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bpe.encode(table(spark, sf_dir, "documents"), tokenizer_path(), decoded=True)
    return rows.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op5_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license.scan(table(spark, sf_dir, "documents"))


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = langid.identify(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", held_out_row(F.col("doc_id")).alias("held_out"), "lang_pred", "score", F.array_join("langs", ",").alias("langs"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))


def op9_grid_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ego_join.link_vectors(table(spark, sf_dir, "embeddings"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


QUERIES = {
    f.__name__: f
    for f in (
        op1_suffix_dedup, op2_permutation_index, op3_chosen_path, op4_bpe, op5_license, op6_langid, op7_quality, op8_line_dedup,
        op9_grid_join, op10_mixing,
    )
}

ORACLE_SQL = {
    "op8_line_dedup": f"""
WITH lines AS (
  SELECT doc_id, source, i, l, trim(l, ' ') AS t FROM (
    SELECT doc_id, source, generate_subscripts(ls, 1) AS i, unnest(ls) AS l
    FROM (SELECT doc_id, source, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL))),
per_host AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
boiler AS (
  SELECT l.source, l.t FROM (SELECT source, t, count(DISTINCT doc_id) AS pages FROM lines WHERE t <> '' GROUP BY source, t) l
  JOIN per_host p ON l.source IS NOT DISTINCT FROM p.source
  WHERE l.pages >= {line_dedup.MIN_PAGES} AND l.pages > p.n * CAST({line_dedup.RATIO} AS DOUBLE)),
marked AS (
  SELECT l.doc_id, l.i, l.l, b.t IS NOT NULL AS gone FROM lines l
  LEFT JOIN boiler b ON l.source IS NOT DISTINCT FROM b.source AND l.t = b.t)
SELECT doc_id, CAST(count(*) AS INTEGER) AS n_lines, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS INTEGER) AS n_dropped,
  sha256(coalesce(string_agg(l, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS text_sha256
FROM marked GROUP BY doc_id
""",
    "op5_license": "WITH w AS (SELECT doc_id, text, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),\n"
    "p(label, ps) AS (VALUES " + ", ".join(f"('{k}', string_split('{v}', ' '))" for k, v in license.PHRASES.items()) + "),\n"
    "base AS (SELECT doc_id, label, unnest(list_filter(range(0, len(ws)), lambda i: ws[i+1:i+len(ps)] = ps)) AS pos FROM w, p WHERE list_has_all(ws, ps)),\n"
    "t(label, ts, need, width) AS (VALUES " + ", ".join(f"('{k}', string_split('{' '.join(ws)}', ' '), {need}, {width})" for k, ws, need, width in license.templates_of(license.TEMPLATES, license.THRESHOLD)) + "),\n"
    "possible AS (SELECT doc_id, ws, label, ts, need, width FROM w, t WHERE len(list_intersect(ts, list_distinct(ws))) >= need),\n"
    "best AS (SELECT doc_id, label, ts, need, list_max(list_transform(range(0, greatest(len(ws) - width, 0) + 1), lambda i: len(list_intersect(ts, list_distinct(ws[i+1:i+width]))))) AS most FROM possible),\n"
    "hits AS (SELECT doc_id, label, most / CAST(len(ts) AS DOUBLE) AS c FROM best WHERE most >= need),\n"
    "b AS (SELECT doc_id, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM base GROUP BY doc_id),\n"
    "a AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT doc_id, label FROM base UNION SELECT doc_id, label FROM hits) GROUP BY doc_id),\n"
    "h AS (SELECT doc_id, max(c) AS c FROM hits GROUP BY doc_id)\n"
    "SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, CASE WHEN n_base IS NOT NULL THEN CAST(1 AS DOUBLE) ELSE coalesce(c, CAST(0 AS DOUBLE)) END AS score\n"
    "FROM w LEFT JOIN b USING (doc_id) LEFT JOIN a USING (doc_id) LEFT JOIN h USING (doc_id)",
}
