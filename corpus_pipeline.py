"""From raw documents to packed sequences: toxicity, line deduplication, near duplicates, personal data, packing.

Each stage takes (spark, docs, sf_dir) and all that the one before kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from branchlake.llm import line_dedup, ngram_join, packing, pii, q_text, toxicity
from branchlake.llm.common import cut, release, small_side

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _columns(docs: DataFrame) -> DataFrame:
    """The columns of documents, with the character count of the text as it is now."""
    return docs.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("long")).select(*COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; null and empty texts stay."""
    docs = docs.select(*COLUMNS)
    scored = toxicity.score(docs, q_text.toxicity_model(spark, sf_dir, docs))
    return _columns(scored.where((F.col("score") < q_text.THRESHOLD) | (F.coalesce(F.length("text"), F.lit(0)) == 0)))


def drop_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that ten or more documents share go from all of them; every document stays, if need be with an empty text."""
    return _columns(line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs, min_chars=1, min_docs=10)))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, Jaccard of 0.8 or more) one row stays, of the smallest doc_id (null comes last); texts without words all stay.

    Identifiers may repeat or be null, so rows are told apart by their place in the files that they are read from; rows that come from elsewhere are written first.
    """
    place = [F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")]
    try:
        keyed = docs.select(*COLUMNS, *place)
    except AnalysisException:
        keyed = cut(docs.select(*COLUMNS), "pipeline-rows").select(*COLUMNS, *place)
    named = keyed.select(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "file", "row").alias("key"), "text")
    found = ngram_join.ngram_components(named, id_col="key", width=5, percent=80)
    gone = found.where(F.col("id") != F.col("component_id")).select("id.file", "id.row")
    return _columns(keyed.join(small_side(gone), ["file", "row"], "left_anti"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data give way to their kind in angle brackets; every document stays."""
    return _columns(pii.redact(docs.select(*COLUMNS), pii.fit()))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 4096 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), 4096)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_common_lines),
    ("ngram_join", drop_near_duplicates),
    ("pii", redact_personal_data),
    ("packing", pack_sequences),
]

#: SQL can't express the classifier, the random field or the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES[:-1]):
        before, docs = docs, cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if i:
            release(before)
    return STAGES[-1][1](spark, docs, sf_dir)
