"""What changed between two snapshots: counts, rows, fields."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from branchlake.functions.keys import canon, fmt, key_hash, row_hash
from branchlake.functions.schema import business_columns

#: changed keys that a diff broadcasts at most, 16 bytes each
BROADCAST_KEYS = 500_000


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.agg((F.count(F.lit(1)) - F.count_distinct(F.struct(*keys))).alias("duplicate_keys"))


def _value_columns(df: DataFrame, keys: list[str]) -> list[str]:
    return [c for c in business_columns(df) if c not in keys]


def diff_keys(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, change): updated, inserted or deleted; unchanged keys are left out. Only keys and hashes are shuffled. Keys are equal if their texts are, a null one included."""
    j = _hashed(old, new, keys, lambda side: [F.struct(*keys).alias(f"__{side}")])
    return j.select(*[F.coalesce(F.col("__a")[k], F.col("__b")[k]).alias(k) for k in keys], _change().alias("change")).where("change IS NOT NULL")


def _change() -> Column:
    return F.when(F.col("__ha").isNull(), F.lit("inserted")).when(F.col("__hb").isNull(), F.lit("deleted")).when(F.col("__ha") != F.col("__hb"), F.lit("updated"))


def _hashed(old: DataFrame, new: DataFrame, keys: list[str], more=lambda _: [], how: str = "full_outer") -> DataFrame:
    """Both sides' key hashes and row hashes next to each other."""
    cols = sorted(set(_value_columns(old, keys)) & set(_value_columns(new, keys)))
    a, b = (df.select(key_hash(df, keys).alias("__k"), row_hash(df, cols).alias(f"__h{side}"), *more(side)) for df, side in ((old, "a"), (new, "b")))
    return a.join(b, "__k", how)


def snapshot_diff(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """One row: updated, inserted, deleted."""
    is_ = lambda c: F.count_if(F.col("change") == c)
    return _hashed(old, new, keys).select(_change().alias("change")).agg(is_("updated").alias("updated"), is_("inserted").alias("inserted"), is_("deleted").alias("deleted"))


def collect_changed(df: DataFrame, changed: DataFrame, keys: list[str]) -> DataFrame:
    own = changed.select(key_hash(changed, keys).alias("__k"))
    return df.withColumn("__k", key_hash(df, keys)).join(own, "__k", "left_semi").drop("__k")


def changed_pairs(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Updated rows of both sides next to each other: keys, then old_<column> and new_<column>.

    Hashes of keys and rows say first which keys differ. While these are at most BROADCAST_KEYS, of 16 bytes each, they are broadcast, and rows are fetched for them alone, so no value of an
    unchanged row is shuffled. With more of them they are joined to both sides.
    """
    cols = sorted(set(_value_columns(old, keys)) & set(_value_columns(new, keys)))
    differ = _hashed(old, new, keys, how="inner").where(~F.col("__ha").eqNullSafe(F.col("__hb"))).select("__k").distinct()
    few = differ.limit(BROADCAST_KEYS + 1).collect()  # at most so many
    differ = F.broadcast(old.sparkSession.createDataFrame(few, "__k binary")) if len(few) <= BROADCAST_KEYS else differ

    def own(df: DataFrame, side: str) -> DataFrame:
        rows = df.withColumn("__k", key_hash(df, keys)).join(differ, "__k", "left_semi")
        return rows.select("__k", row_hash(df, cols).alias(f"__h{side}"), *(keys if side == "old" else []), *[F.col(c).alias(f"{side}_{c}") for c in cols])

    return own(old, "old").join(own(new, "new"), "__k").where(~F.col("__hold").eqNullSafe(F.col("__hnew"))).drop("__k", "__hold", "__hnew")


def _differs(old: DataFrame, new: DataFrame, c: str) -> Column:
    return canon(F.col(f"old_{c}"), old.schema[c].dataType) != canon(F.col(f"new_{c}"), new.schema[c].dataType)


def field_changes(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, column, old, new) per changed cell; whether it changed is decided on canonical values."""
    pairs = changed_pairs(old, new, keys)
    cols = [c[4:] for c in pairs.columns if c.startswith("old_") and c not in keys]
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("column"), fmt(F.col(f"old_{c}"), old.schema[c].dataType).alias("old"), fmt(F.col(f"new_{c}"), new.schema[c].dataType).alias("new"), _differs(old, new, c).alias("changed"))
            for c in cols
        ]
    )
    return pairs.select(*keys, F.explode(cells).alias("x")).where("x.changed").select(*keys, "x.column", "x.old", "x.new")


def wide_changes(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """A row per updated record: "old → new" in changed cells, the number of changes, and only columns that changed somewhere."""
    pairs = changed_pairs(old, new, keys)
    cols = [c[4:] for c in pairs.columns if c.startswith("old_") and c not in keys]
    cells = {c: F.when(_differs(old, new, c), F.concat(fmt(F.col(f"old_{c}"), old.schema[c].dataType), F.lit(" → "), fmt(F.col(f"new_{c}"), new.schema[c].dataType))) for c in cols}
    wide = pairs.select(*keys, *[v.alias(c) for c, v in cells.items()])
    some = wide.agg(*[F.count(c).alias(c) for c in cols]).first().asDict() if cols else {}
    kept = [c for c in cols if some[c]]
    n = reduce(Column.__add__, [F.col(c).isNotNull().cast("int") for c in kept], F.lit(0))
    return wide.select(*keys, n.alias("changes"), *kept)


def change_counts(changes: DataFrame) -> DataFrame:
    return changes.groupBy("column").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "column")


def top_changed(changes: DataFrame, n: int = 10) -> DataFrame:
    return change_counts(changes).limit(n)


def diff_summary(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """(label, value) rows, with the duplicate keys of each side."""
    d = snapshot_diff(old, new, keys)
    rows = d.select(F.explode(F.array(*[F.struct(F.lit(c).alias("label"), F.col(c).alias("value")) for c in d.columns])).alias("x")).select("x.label", "x.value")
    for name, df in (("duplicate keys, baseline", old), ("duplicate keys, latest", new)):
        rows = rows.unionAll(duplicate_keys(df, keys).select(F.lit(name), "duplicate_keys"))
    return rows


def write_changes_csv(changes: DataFrame, path: str) -> None:
    changes.write.mode("overwrite").option("header", True).csv(path)
