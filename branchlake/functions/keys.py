"""Canonical text, fingerprints, row hashes and stable keys, all in built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The null sentinel and the separator of fingerprints.
NULL, SEPARATOR = "\x00\x00NULL", "\x1f"
#: Julian day number of 1970-01-01
EPOCH_JULIAN = 2440588
#: types that a text column may turn out to hold, the narrowest first
INFERRED = ("bigint", "decimal(38,10)", "double", "date", "timestamp_ntz")

_INTS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOATS = (T.FloatType, T.DoubleType)


def canon_decimal(c: Column) -> Column:
    """Plain text without trailing zeros, whatever the scale."""
    s = F.regexp_replace(c.cast("string"), r"(\.\d*?)0+$", "$1")
    return F.regexp_replace(s, r"\.$", "")


def canon(c: Column, kind: T.DataType) -> Column:
    """Canonical text of a value; null has a sentinel of its own. Times lose what is below a second; zoned ones are told by their wall clock in UTC, whatever the session's zone."""
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        out = F.date_format(naive_utc(c) if isinstance(kind, T.TimestampType) else c, "yyyy-MM-dd HH:mm:ss")
    elif isinstance(kind, T.DateType):
        out = F.date_format(c, "yyyy-MM-dd")
    elif isinstance(kind, T.DecimalType):
        out = canon_decimal(c) if kind.scale > 0 else c.cast("string")
    elif isinstance(kind, _FLOATS):
        whole = (c == F.floor(c)) & (F.abs(c) < 1e15)
        out = F.when(whole, c.cast("bigint").cast("string")).otherwise(c.cast("string"))
    elif isinstance(kind, T.BinaryType):
        out = F.lower(F.hex(c))
    else:
        out = c.cast("string")
    return F.coalesce(out, F.lit(NULL))


def _of(df: DataFrame, name: str) -> Column:
    return canon(F.col(f"`{name}`"), df.schema[name].dataType)


def fingerprint(df: DataFrame, columns: list[str]) -> Column:
    """Canonical columns joined by a separator; empty for no columns."""
    return F.concat_ws(SEPARATOR, *[_of(df, c) for c in columns]) if columns else F.lit("")


def row_hash(df: DataFrame, columns: list[str]) -> Column:
    """16 bytes over the fingerprint; never null, and said to be so, or else a join would compute it once more to see whether it is."""
    return F.coalesce(F.unhex(F.md5(fingerprint(df, columns))), F.lit(b""))


def key_hash(df: DataFrame, columns: list[str]) -> Column:
    """16 bytes that stand for the key in a shuffle."""
    return row_hash(df, columns)


def check_stable(df: DataFrame, keys: list[str]) -> None:
    """Floats and decimals with a fraction print differently from run to run, so they are no keys."""
    for k in keys:
        kind = df.schema[k].dataType
        if isinstance(kind, _FLOATS) or isinstance(kind, T.DecimalType) and kind.scale > 0:
            raise ValueError(f"key column {k} ({kind.simpleString()}) is not run-stable")


def serialize_keys(df: DataFrame, keys: list[str]) -> Column:
    """An injective binary form: per column 01 for null, else 00, the length in four bytes and the UTF-8 text."""
    check_stable(df, keys)

    def one(k: str) -> Column:
        kind, c = df.schema[k].dataType, F.col(f"`{k}`")
        text = F.lower(F.hex(c)) if isinstance(kind, T.BinaryType) else c.cast("string")
        size = F.unhex(F.lpad(F.hex(F.octet_length(text)), 8, "0"))
        return F.coalesce(F.concat(F.unhex(F.lit("00")), size, F.encode(text, "UTF-8")), F.unhex(F.lit("01")))

    return F.concat(*map(one, keys))


def merge_hash(df: DataFrame, keys: list[str]) -> Column:
    return F.unhex(F.md5(serialize_keys(df, keys)))


def with_merge_hash(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.withColumn("merge_hash", merge_hash(df, keys))


def stabilize_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Whole floats become decimal(38,0), a fraction is an error; decimals with a scale become canonical text."""
    out = df
    for k in keys:
        kind, c = df.schema[k].dataType, F.col(f"`{k}`")
        if isinstance(kind, _FLOATS):
            out = out.withColumn(k, F.when(c != F.floor(c), F.raise_error(F.lit(f"key column {k} has a fraction")).cast("decimal(38,0)")).otherwise(c.cast("decimal(38,0)")))
        elif isinstance(kind, T.DecimalType) and kind.scale > 0:
            out = out.withColumn(k, canon_decimal(c))
    return out


def julian_day(c: Column) -> Column:
    return F.unix_date(c.cast("date")) + EPOCH_JULIAN


def from_julian(c: Column) -> Column:
    return F.date_from_unix_date((c - EPOCH_JULIAN).cast("int"))


def naive_utc(c: Column) -> Column:
    """A zoned instant as its wall clock in UTC, whatever the session's zone: days and seconds since 1970 without a zone in between, so that no local hour is missing or doubled."""
    micros = F.unix_micros(c.cast("timestamp"))
    days = F.floor(micros / F.lit(86_400_000_000)).cast("int")
    seconds = ((micros - days.cast("bigint") * 86_400_000_000).cast("decimal(20,0)") / 1_000_000).cast("decimal(18,6)")
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(days, F.lit(0), F.lit(0), seconds)


def safe_cast(df: DataFrame, name: str, kind: str) -> DataFrame:
    """Cast a text column to ``kind`` if every value fits, else to the first of INFERRED that gives every text back as it was, else keep the text; one aggregate decides.

    So '007' stays a text unless a number is asked for, and no digit is lost to a type that nobody named.
    """
    c = F.col(f"`{name}`")

    def back(k: str) -> Column:
        cast = c.try_cast(k)
        return canon_decimal(cast) if k.startswith("decimal") else cast.cast("string")

    lost = df.agg(
        F.count_if(c.isNotNull() & c.try_cast(kind).isNull()).alias("asked"), F.count(c).alias("values"), *[F.count_if(c.isNotNull() & ~c.eqNullSafe(back(k))).alias(k) for k in INFERRED]
    ).first()
    fits = [kind] if not lost["asked"] else [k for k in INFERRED if k != kind and not lost[k] and lost["values"]]
    return df.withColumn(name, c.try_cast(fits[0])) if fits else df


def fmt(c: Column, kind: T.DataType) -> Column:
    """For display: whole floats without a fraction, null as empty text."""
    text = F.when((c == F.floor(c)) & (F.abs(c) < 1e15), c.cast("bigint").cast("string")).otherwise(c.cast("string")) if isinstance(kind, _FLOATS) else c.cast("string")
    return F.coalesce(text, F.lit(""))
