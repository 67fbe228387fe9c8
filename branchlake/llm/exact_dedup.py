"""Exact deduplication by a tree merge of sorted digest runs.

Every input partition sorts its digests into a run and streams it, keeping one entry (digest, identifier to keep, copies) of equal ones. Runs then meet in binomial rounds: each
round clears one more digit of the run numbers (in base ``fan_in``), and the runs that now share a number are merged in digest order, keeping at every level the identifier that wins. An
entry is kept as a struct, which Spark aggregates by sorting and streaming, never by hashing, so both ends of every exchange are ordered runs. Entries of a merge are dealt out by
(run, digest), so no round gathers a run in one task, and a text that makes up a third of all rows is one entry per partition before anything is shuffled. Only digests
travel, never texts.

"Verified": at every level two entries count as equal only if SHA-256, byte length and an independent 64-bit hash all agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from branchlake.llm.common import text_or_empty

KEYS = ["digest", "n_bytes", "check"]


def digest_runs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = text_or_empty(text_col)
    return docs.select(
        F.col(id_col).alias("id"), F.sha2(text, 256).alias("digest"), F.octet_length(text).alias("n_bytes"), F.xxhash64(text).alias("check")
    )


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest", leaves: int = 64, fan_in: int = 8
) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, digest.

    ``keep`` is "smallest" or "largest" identifier of the group. Null texts equal empty ones. Null identifiers never win; a group of only
    null identifiers has a null ``keep_id`` and keeps them. Repeated rows (same identifier and text) count in ``group_size`` and share
    their ``kept``. Empty input gives an empty result; columns other than the two named are not read.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep must be smallest or largest")
    best, named = (F.min, F.col("id").isNull()) if keep == "smallest" else (F.max, F.col("id").isNotNull())
    rows = digest_runs(docs, id_col, text_col)
    entries = rows.select(F.pmod(F.spark_partition_id(), F.lit(leaves)).alias("run"), *KEYS, F.struct(named.alias("named"), "id").alias("entry"), F.lit(1).cast("bigint").alias("copies"))
    merged = lambda runs: runs.groupBy("run", *KEYS).agg(best("entry").alias("entry"), F.sum("copies").alias("copies"))
    runs, span = merged(entries), 1
    while span < leaves:
        span *= fan_in
        runs = merged(runs.withColumn("run", (F.col("run") - F.col("run") % span).cast("int")))
    heads = runs.select(*KEYS, F.col("entry.id").alias("keep_id"), F.col("copies").alias("group_size"))
    return rows.join(heads, KEYS).select("id", "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "digest")
