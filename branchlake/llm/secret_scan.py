"""Secret scanning over an incremental blob ledger, with native expressions only.

Every historical version of every path is content-addressed (SHA-256 of its text). The ledger holds one row per (blob, rule version)
that was ever scanned, with its findings. A run scans only pairs the ledger lacks, appends them, and joins findings back to all paths.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from branchlake.llm.common import text_or_empty


@dataclass(frozen=True)
class Rule:
    """``group``: the part whose length must reach ``least``; the span is the whole match."""

    kind: str
    pattern: str
    group: int
    least: int


# The base kinds, in their listed order. A minimum length inside the hex and access patterns finds the same
# matches as filtering afterwards, because a failing run of those classes holds no later, longer match.
RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"(AKIA[A-Z0-9]{14,})", 1, 18),
    Rule("hex", r"([0-9a-f]{16,})", 1, 16),
)
RULE_VERSION = "base-1"

FINDINGS = "array<struct<start:bigint,rank:int,end:bigint,kind:string>>"


def spans(text: Column, found: Column, parts: Column, rule: Rule, rank: int) -> Column:
    """Matches with code-point positions. The texts between matches (split) and the matches alternate, so positions are running lengths."""
    gaps = F.split(text, rule.pattern, -1)
    pairs = F.arrays_zip(F.slice(gaps, 1, F.size(found)).alias("gap"), found.alias("hit"), parts.alias("part"))
    none = F.array().cast(FINDINGS)

    def step(acc, x):
        start = acc["at"] + F.length(x["gap"])
        end = start + F.length(x["hit"])
        one = F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(rule.kind).alias("kind"))
        out = F.when(F.length(x["part"]) >= rule.least, F.concat(acc["out"], F.array(one))).otherwise(acc["out"])
        return F.struct(end.cast("bigint").alias("at"), out.cast(FINDINGS).alias("out"))

    walked = F.aggregate(pairs, F.struct(F.lit(0).cast("bigint").alias("at"), none.alias("out")), step, lambda a: a["out"])
    return F.when(F.size(found) > 0, walked).otherwise(none)


def scan(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """blobs (blob_id, body) -> (blob_id, findings), findings in order of start, then kind as listed."""
    hits = blobs
    for i, r in enumerate(rules):
        hits = hits.withColumns({f"hit{i}": F.regexp_extract_all("body", F.lit(r.pattern), F.lit(0)), f"part{i}": F.regexp_extract_all("body", F.lit(r.pattern), F.lit(r.group))})
    every = F.concat(*[spans(F.col("body"), F.col(f"hit{i}"), F.col(f"part{i}"), r, i) for i, r in enumerate(rules)])
    return hits.select("blob_id", F.array_sort(every).alias("findings"))


def scan_versions(
    versions: DataFrame, ledger: str, paths: list[str], text_col: str = "text", rules: tuple[Rule, ...] = RULES, rule_version: str = RULE_VERSION
) -> DataFrame:
    """Scan what the ledger at ``ledger`` (a shared folder) lacks, then return ``paths`` columns, blob_id and findings of every input row.

    Null texts are empty blobs. Copies of a blob are scanned once; repeated rows come back as often as they came in. An empty table writes an empty
    ledger entry. A run that fails before its append leaves the ledger as it was, so running again is safe; one writer per ledger.
    """
    spark = versions.sparkSession
    rows = versions.select(*[F.col(f"`{p}`") for p in paths], F.sha2(text_or_empty(text_col), 256).alias("blob_id"), text_or_empty(text_col).alias("body"))
    known = _ledger(spark, ledger).where(F.col("rule_version") == rule_version)
    unseen = rows.select("blob_id", "body")
    if not known.isEmpty():
        unseen = unseen.join(known.select("blob_id"), "blob_id", "left_anti")
    blobs = unseen.groupBy("blob_id").agg(F.first("body").alias("body"))
    scan(blobs, rules).withColumn("rule_version", F.lit(rule_version)).write.mode("append").parquet(ledger)
    findings = _ledger(spark, ledger).where(F.col("rule_version") == rule_version).select("blob_id", "findings")
    return rows.drop("body").join(findings, "blob_id")


def _ledger(spark, path: str) -> DataFrame:
    schema = f"blob_id string, findings {FINDINGS}, rule_version string"
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def joined(findings: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(findings, lambda f: F.concat_ws(":", f["kind"], f["start"].cast("string"), f["end"].cast("string"))), ",")


def count_of(findings: Column, kind: str) -> Column:
    return F.size(F.filter(findings, lambda f: f["kind"] == kind)).cast("long")
