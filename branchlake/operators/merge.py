"""Upserts and what surrounds them, as pure DataFrame operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from branchlake.defs import HASH, INSERTED, TableDef
from branchlake.functions.schema import cast_to, fill_void, unify_branches, widen

STRATEGIES = ("upsert", "insert-only")


def merge_keys(target: DataFrame, delta: DataFrame, keys: list[str]) -> list[str]:
    """The hash if both sides carry it, else the composite key."""
    return [HASH] if HASH in target.columns and HASH in delta.columns else keys


def check_unique(delta: DataFrame, keys: list[str]) -> None:
    if not delta.groupBy(*keys).count().where("count > 1").limit(1).isEmpty():
        raise ValueError("duplicate keys in the delta")


def keyed_join(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """A join by keys in which null equals null, under the wider of their types; of an inner or outer one the right side's keys stay away."""
    own = right.withColumnsRenamed({k: f"__key_{i}" for i, k in enumerate(keys)})
    kinds = [widen(left.schema[k].dataType, right.schema[k].dataType) for k in keys]
    on = reduce(Column.__and__, [F.col(k).cast(t).eqNullSafe(F.col(f"__key_{i}").cast(t)) for i, (k, t) in enumerate(zip(keys, kinds, strict=True))])
    return left.join(own, on, how).drop(*[f"__key_{i}" for i in range(len(keys))])


def _aligned(target: DataFrame, delta: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both under the stored columns plus the delta's new ones; old rows hold null there, types widen."""
    stored = {f.name.lower(): f for f in target.schema.fields}
    fields = [T.StructField(f.name, f.dataType, True) for f in target.schema.fields]
    for f in delta.schema.fields:
        old = stored.get(f.name.lower())
        if old is None:
            fields.append(T.StructField(f.name, f.dataType, True))
        else:
            fields = [T.StructField(g.name, widen(g.dataType, f.dataType), True) if g.name == old.name else g for g in fields]
    schema = fill_void(T.StructType(fields))
    return cast_to(target, schema), cast_to(delta, schema)


def merge_upsert(target: DataFrame, delta: DataFrame, keys: list[str]) -> DataFrame:
    """Matched rows are replaced whole, others are added; keys must be unique in the delta, and a null in one is a value like others."""
    old, new = _aligned(target, delta)
    return keyed_join(old, new.select(*keys), keys, "left_anti").select(*old.columns).unionAll(new)


def merge_insert_only(target: DataFrame, delta: DataFrame, keys: list[str]) -> DataFrame:
    old, new = _aligned(target, delta)
    return old.unionAll(keyed_join(new, old.select(*keys).distinct(), keys, "left_anti").select(*old.columns))


def merge(target: DataFrame, delta: DataFrame, keys: list[str], strategy: str = "upsert") -> DataFrame:
    if strategy not in STRATEGIES:
        raise ValueError(f"unsupported merge strategy: {strategy}")
    keys = merge_keys(target, delta, keys)
    check_unique(delta, keys)
    return (merge_upsert if strategy == "upsert" else merge_insert_only)(target, delta, keys)


def carry_forward(delta: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """The first-load time of rows already stored survives, new rows keep theirs."""
    before = existing.select(*keys, F.col(INSERTED).alias("__before"))
    return keyed_join(delta, before, keys, "left").withColumn(INSERTED, F.coalesce("__before", INSERTED)).select(*delta.columns)


def merge_with_history(target: DataFrame, delta: DataFrame, keys: list[str]) -> DataFrame:
    keys = merge_keys(target, delta, keys)
    check_unique(delta, keys)
    return merge_upsert(target, carry_forward(delta, target, keys), keys)


def split_delta(target: DataFrame, delta: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(matched, new) rows of the delta."""
    have = target.select(*keys)
    return keyed_join(delta, have, keys, "left_semi"), keyed_join(delta, have, keys, "left_anti")


def changed_rows(target: DataFrame, delta: DataFrame, keys: list[str]) -> DataFrame:
    """Delta rows that match a key and differ from it in some other shared column, nulls compared as values."""
    other = [c for c in delta.columns if c not in keys and c in target.columns]
    old = target.select(*keys, *[F.col(c).alias(f"__old_{c}") for c in other])
    differs = reduce(Column.__or__, [~F.col(c).eqNullSafe(F.col(f"__old_{c}")) for c in other], F.lit(False))
    return keyed_join(delta, old, keys, "inner").where(differs).select(*delta.columns)


def dedupe_delta(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The first row per key in an explicit order of columns or expressions; a descending one is given as F.desc(column). Among equals it is the one with the smallest hash of the whole row."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order, F.xxhash64(*[c for c in df.columns if not _holds_map(df.schema[c].dataType)])))
    return df.withColumn("__rank", rank).where("__rank = 1").drop("__rank")


def _holds_map(kind: T.DataType) -> bool:
    """Maps have no order and no hash."""
    return "map<" in kind.simpleString()


def cluster_by_hash(df: DataFrame, branch: str = "branch_id") -> DataFrame:
    """Rows dealt out by range of (branch, hash) and ordered so, so that a file covers a short range of hashes and the ranges of its footer prune."""
    return df.repartitionByRange(branch, HASH).sortWithinPartitions(branch, HASH)


def choose_disposition(tdef: TableDef, mode: str, succeeded: int, in_run: int, configured: int) -> str:
    """append, replace, merge or skip."""
    if not succeeded:
        return "skip"
    if tdef.is_snapshot:
        return "append"
    rebuild = in_run == configured and (mode == "INITIAL" or tdef.change_column is None)
    return "replace" if rebuild else "merge"


def rebuild(branches: list[DataFrame]) -> DataFrame:
    """A full rebuild holds the branches that succeeded; one that failed has no rows this time."""
    return unify_branches(branches)


def merge_impact(target: DataFrame, delta: DataFrame, keys: list[str], more_files: int = 0, more_bytes: int = 0) -> DataFrame:
    """One row: matched, changed and new rows, and the files and bytes of ``target`` (a file scan, or rows with ``__file`` and ``__bytes``) that a copy-on-write would rewrite.

    ``more_files`` and ``more_bytes`` belong to the table and are known to hold no key of the delta, so they are not in ``target``.
    """
    located = {"__file", "__bytes"} <= set(target.columns)
    files = target.select(*keys, "__file", "__bytes") if located else target.select(*keys, F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_size").alias("__bytes"))
    own = delta.select(*keys).distinct().withColumn("__hit", F.lit(1))
    per_file = keyed_join(files, own, keys, "left").groupBy("__file").agg(F.max("__bytes").alias("bytes"), F.count("__hit").alias("hit"))
    disk = per_file.agg(
        (F.count(F.lit(1)) + F.lit(more_files).cast("bigint")).alias("files"), _plus(F.sum("bytes"), more_files, more_bytes).alias("bytes"), F.count_if(F.col("hit") > 0).alias("files_rewritten"),
        F.coalesce(F.sum(F.when(F.col("hit") > 0, F.col("bytes"))), F.lit(0)).alias("bytes_rewritten"), _plus(F.sum("hit"), more_files, 0).alias("matched"),
    )
    changed = changed_rows(target, delta, keys).agg(F.count(F.lit(1)).alias("changed"))
    rows = delta.agg(F.count(F.lit(1)).alias("delta_rows"), F.count_distinct(F.struct(*keys)).alias("delta_keys"))
    out = disk.crossJoin(changed).crossJoin(rows)  # three single rows
    return out.select(
        "delta_rows", "matched", "changed", (F.col("delta_rows") - F.col("matched")).alias("inserts"), "files", "files_rewritten", "bytes", "bytes_rewritten",
        F.round(100 * F.col("bytes_rewritten") / F.col("bytes"), 1).alias("pct_rewritten"), (F.col("delta_keys") < F.col("delta_rows")).alias("duplicate_keys"),
    )


def _plus(total: Column, files: int, more: int) -> Column:
    """A sum over files with that of ``files`` others, null only if there are none at all."""
    return F.coalesce(total, F.lit(0)) + F.lit(more).cast("bigint") if files else total


def sample_delta(df: DataFrame, keys: list[str], n: int, fraction: float, seed: str) -> DataFrame:
    """``n`` rows in a seeded order of their keys; the first ``fraction`` of them with the first numeric column beyond the keys raised by one."""
    order = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(seed)))
    picked = df.withColumn("__o", order).orderBy("__o", *keys).limit(n)
    numeric = next((f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in keys), None)
    if numeric:
        rank = F.row_number().over(Window.orderBy("__o", *keys))  # over the limited rows only
        picked = picked.withColumn("__r", rank).withColumn(numeric, F.when(F.col("__r") <= int(n * fraction), F.col(numeric) + 1).otherwise(F.col(numeric)).cast(df.schema[numeric].dataType))
    return picked.select(*df.columns)


def collision_check(df: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct keys against distinct hashes."""
    return df.agg(F.count_distinct(F.struct(*keys)).alias("distinct_keys"), F.count_distinct(HASH).alias("distinct_hashes"))
