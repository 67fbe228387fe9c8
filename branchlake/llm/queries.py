"""The registered queries of the operators, with their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from branchlake.llm import embedding_dedup, exact_dedup, line_dedup, ngram_join, q_audit, q_text, secret_scan, sharding
from branchlake.llm.common import text_or_empty
from branchlake.sources.scratch import fresh


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = sharding.shuffle_into_shards(docs, 16, seed=20240601)
    return out.select(
        "doc_id",
        (F.octet_length(text_or_empty()) + 1).cast("long").alias("size"),
        F.crc32(text_or_empty()).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = secret_scan.scan_versions(docs, fresh(spark, "blob-ledger"), ["doc_id"])
    text = secret_scan.joined(F.col("findings"))
    return found.select(
        "doc_id",
        *[secret_scan.count_of(F.col("findings"), k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(text, 256).alias("base_sha256"),
        text.alias("spans"),
    )


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))
    return out.withColumnRenamed("id", "vec_id")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs, min_chars=1, min_docs=10))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(text_or_empty(), 256).alias("kept_sha256"))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ngram_join.ngram_components(table(spark, sf_dir, "documents"), width=3, percent=90)
    return out.withColumnRenamed("id", "doc_id")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = exact_dedup.exact_dedup(docs, keep="largest")
    return out.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


QUERIES = {f.__name__: f for f in (op1_sharding, op2_secret_scan, op3_embedding_dedup, op4_line_dedup, q_text.op5_pii, op6_ngram_join, op7_exact_dedup, q_text.op8_sentencepiece, q_text.op9_packing, q_text.op10_toxicity)} | q_audit.QUERIES

_KEY = r"translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
_SECRETS = (("assign", 0, _ASSIGN, 2, 12), ("access", 1, r"AKIA[A-Z0-9]+", 0, 18), ("hex", 2, r"[0-9a-f]+", 0, 16))
_FOUND = "\nUNION ALL\n".join(
    f"""SELECT doc_id, '{kind}' AS kind, {rank} AS rank, hits[i] AS hit, parts[i] AS part, {least} AS least,
  list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS s
FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM (SELECT doc_id, regexp_extract_all(t, '{p}') AS hits,
  regexp_extract_all(t, '{p}', {g}) AS parts, string_split_regex(t, '{p}') AS gaps FROM d))"""
    for kind, rank, p, g, least in _SECRETS
)

ORACLE_SQL = {
    "op2_secret_scan": f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
found AS ({_FOUND}),
kept AS (SELECT doc_id, kind, rank, CAST(s AS BIGINT) AS s, CAST(s + length(hit) AS BIGINT) AS e FROM found WHERE length(part) >= least),
agg AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
  count(*) FILTER (kind = 'hex') AS n_hex, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) AS spans FROM kept GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN agg USING (doc_id)""",
    "op4_line_dedup": f"""WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
  unnest(range(0, len(string_split(coalesce(text, ''), chr(10))))) AS pos FROM documents),
k AS (SELECT *, {_KEY} AS key FROM l),
hot AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (hot.key IS NOT NULL) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (hot.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN hot USING (key) GROUP BY doc_id""",
    "op7_exact_dedup": """SELECT doc_id, max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
  count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size, doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
  sha256(coalesce(text, '')) AS text_sha256 FROM documents""",
} | q_audit.ORACLE_SQL
