"""Type widening, schema unification and casts."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from branchlake.defs import HELPER_CDC, HELPER_DATE, STAMPS, normal

#: families of types; within one the wider wins, across families only text fits both
FAMILIES = {"whole": (T.ByteType, T.ShortType, T.IntegerType, T.LongType), "exact": (T.DecimalType,), "binary": (T.FloatType, T.DoubleType), "time": (T.TimestampType, T.TimestampNTZType)}
#: digits that an integer counts for next to a decimal
INT_DIGITS = 18


def _family(kind: T.DataType) -> str | None:
    return next((name for name, kinds in FAMILIES.items() if isinstance(kind, kinds)), None)


def _decimal(a: T.DataType, b: T.DataType) -> T.DecimalType:
    digits = [(k.precision - k.scale, k.scale) if isinstance(k, T.DecimalType) else (INT_DIGITS, 0) for k in (a, b)]
    whole, scale = (max(d[i] for d in digits) for i in (0, 1))
    return T.DecimalType(min(38, whole + scale), scale)


def widen(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type both fit; strings take everything that has no closer common type, an all-null column takes the other's."""
    known = [k for k in (a, b) if not isinstance(k, T.NullType)]
    if len({k.simpleString() for k in known}) < 2:
        return known[0] if known else a
    families = {_family(a), _family(b)}
    if families == {"time"}:
        return T.TimestampNTZType()
    if None in families or "time" in families:
        return T.StringType()
    return T.DoubleType() if "binary" in families else _decimal(a, b)


def unify_schemas(schemas: list[T.StructType]) -> T.StructType:
    """Columns in the order first seen; nullable if it is anywhere or is absent anywhere."""
    found: dict[str, T.StructField] = {}
    for s in schemas:
        for f in s.fields:
            old = found.get(f.name)
            found[f.name] = T.StructField(f.name, widen(old.dataType, f.dataType), old.nullable or f.nullable) if old else f
    everywhere = set.intersection(*({f.name for f in s.fields} for s in schemas)) if schemas else set()
    return T.StructType([T.StructField(n, f.dataType, f.nullable or n not in everywhere) for n, f in found.items()])


def cast_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the schema's columns: missing ones null, others dropped; a value that does not fit is an error."""
    have = {c.lower(): c for c in df.columns}
    return df.select(*[(F.col(f"`{have[f.name.lower()]}`") if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])


def unify_branches(dfs: list[DataFrame]) -> DataFrame:
    """UNION ALL of branches under the unified schema. Types are cast before the union, whose own coercion differs."""
    schema = fill_void(unify_schemas([d.schema for d in dfs]))
    return reduce(DataFrame.unionAll, [cast_to(d, schema) for d in dfs])


def fill_void(schema: T.StructType, destination: T.StructType | None = None) -> T.StructType:
    """All-null columns take the destination's type, else string."""
    stored = {f.name.lower(): f.dataType for f in destination.fields} if destination else {}
    return T.StructType(
        [T.StructField(f.name, stored.get(f.name.lower(), T.StringType()) if isinstance(f.dataType, T.NullType) else f.dataType, f.nullable) for f in schema.fields]
    )


def widen_to_destination(schema: T.StructType, destination: T.StructType) -> T.StructType:
    """Shared columns widen by the stored type; columns only stored are not added."""
    stored = {f.name.lower(): f.dataType for f in destination.fields}
    return T.StructType([T.StructField(f.name, widen(f.dataType, stored.get(f.name.lower(), f.dataType)), f.nullable) for f in schema.fields])


def schema_diff(branch: T.StructType, unified: T.StructType) -> dict:
    mine, whole = ({f.name: f.dataType for f in s.fields} for s in (branch, unified))
    return {
        "missing_in_branch": [n for n in whole if n not in mine],
        "extra_in_branch": [n for n in mine if n not in whole],
        "type_widened": {n: f"{t.simpleString()} -> {whole[n].simpleString()}" for n, t in mine.items() if n in whole and whole[n] != t},
    }


def drift_report(df: DataFrame, branches: dict[str, T.StructType]) -> DataFrame:
    """A row per branch column that is missing, extra or widened against the unified schema."""
    unified = unify_schemas(list(branches.values()))
    rows = []
    for name, s in branches.items():
        d = schema_diff(s, unified)
        rows += [(name, "missing", c, None) for c in d["missing_in_branch"]]
        rows += [(name, "extra", c, None) for c in d["extra_in_branch"]]
        rows += [(name, "widened", c, t) for c, t in d["type_widened"].items()]
    return df.sparkSession.createDataFrame(rows, "branch string, kind string, column string, detail string")


def require_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """The same rows; a null in a key column is an error when the row is read."""
    out = df
    for k in keys:
        c = F.col(f"`{k}`")
        out = out.withColumn(k, F.when(c.isNull(), F.raise_error(F.lit(f"null in key column {k}")).cast(df.schema[k].dataType)).otherwise(c))
    return out


def normalize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*map(normal, df.columns))


def business_columns(df: DataFrame) -> list[str]:
    """All columns but stamps, helper columns and loader bookkeeping, whatever their case."""
    hidden = {normal(c) for c in (*STAMPS, HELPER_CDC, HELPER_DATE)}
    return [c for c in df.columns if normal(c) not in hidden and not c.lower().startswith("_dlt")]


def strip_reserved(df: DataFrame) -> DataFrame:
    gone = {HELPER_CDC.lower(), HELPER_DATE.lower()}
    return df.drop(*[c for c in df.columns if c.lower() in gone])


def column_drift(df: DataFrame, source: list[str], lake: list[str]) -> DataFrame:
    """One row per column of either side: in both, only in the source or only in the lake."""
    s, k = ({normal(c) for c in cs} for cs in (source, lake))
    rows = [(c, "both" if c in s & k else "source_only" if c in s else "lake_only") for c in sorted(s | k)]
    return df.sparkSession.createDataFrame(rows, "column string, side string")


_DATE, _STAMP, _NUMBER = re.compile(r"\d{4}-\d\d-\d\d"), re.compile(r"\d{4}-\d\d-\d\d[ T]\d\d:\d\d(:\d\d(\.\d+)?)?"), re.compile(r"[+-]?\d+(\.\d+)?")


def literal(raw: str) -> Column:
    """A configured bound: an expression if it calls anything, else a date, timestamp, number or string."""
    raw = raw.strip()
    if "(" in raw:
        return F.expr(raw)
    if _DATE.fullmatch(raw):
        return F.lit(raw).cast("date")
    if _STAMP.fullmatch(raw):
        return F.lit(raw).cast("timestamp_ntz")
    if _NUMBER.fullmatch(raw):
        return F.expr(raw)
    return F.lit(raw)
