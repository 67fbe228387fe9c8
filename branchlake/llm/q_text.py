"""Queries of the operators that read texts in Python batches: op5, op9, op10."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from branchlake.llm import gumbel_pieces, packing, pii, secret_scan, toxicity

THRESHOLD = 0.7


def held_out() -> Column:
    """The remainder of crc32(doc_id as text) that is kept out of every fit; a null doc_id is kept out too."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(True))


def toxicity_model(spark: SparkSession, sf_dir: str, docs: DataFrame) -> toxicity.Model:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic").where(~held_out())
    return toxicity.fit(docs, labels)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity_model(spark, sf_dir, docs))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), 4096, cache=300_000)


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = pii.find(docs, pii.fit())
    base, every = F.filter("pii", lambda s: s["base"]), F.col("pii")
    return found.select(
        "doc_id",
        *[secret_scan.count_of(base, k).alias(f"n_{k}") for k in pii.KINDS],
        F.sha2(secret_scan.joined(base), 256).alias("base_sha256"),
        secret_scan.joined(every).alias("spans"),
    )


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two different segmentations of each text: a row per document and sample, each decoded again (``decoded_crc32`` is of the UTF-8 text that its ids give)."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = gumbel_pieces.encode(docs, public_tokenizers.path("piece_bpe_32k.model"), k=2, seed=11, digest=True)
    return out.select(F.col("key").alias("doc_id"), F.posexplode("samples").alias("sample", "s")).select("doc_id", "sample", "s.*")
