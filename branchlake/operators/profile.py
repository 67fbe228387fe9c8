"""Profiling: candidate keys, columns, years."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from branchlake.functions.keys import from_julian


def key_profile(df: DataFrame, columns: list[str], combinations: dict[str, list[str]]) -> DataFrame:
    """(candidate, rows, distinct_values, nulls, verdict) for columns and named combinations, in one pass: every row gives one (candidate, 96-bit value hash) for each, counted per value before values are."""
    named = {c: [c] for c in columns} | combinations
    one = lambda i, cols: F.struct(
        F.lit(i).alias("i"), F.coalesce(*[F.when(F.col(c).isNull(), F.lit(True)) for c in cols], F.lit(False)).alias("null"), F.xxhash64(*cols).alias("a"), F.hash(*cols).alias("b")
    )
    cells = df.select(F.inline(F.array(*[one(i, cols) for i, cols in enumerate(named.values())])))
    per = cells.select("i", "null", *[F.when(~F.col("null"), F.col(c)).alias(c) for c in "ab"]).groupBy("i", "null", "a", "b").agg(F.count(F.lit(1)).alias("n"))
    out = per.groupBy("i").agg(F.sum("n").alias("rows"), F.count_if(~F.col("null")).alias("distinct_values"), F.coalesce(F.sum(F.when(F.col("null"), F.col("n"))), F.lit(0)).alias("nulls"))
    names = df.sparkSession.createDataFrame(list(enumerate(named)), "i int, candidate string")  # a row a candidate
    out = names.join(out, "i", "left").na.fill(0, ["rows", "distinct_values", "nulls"])
    verdict = F.when((F.col("nulls") == 0) & (F.col("distinct_values") == F.col("rows")), F.lit("unique")).when(F.col("nulls") > 0, F.lit("has nulls")).otherwise(F.lit("not unique"))
    return out.select("candidate", "rows", "distinct_values", "nulls", verdict.alias("verdict"))


def year_distribution(df: DataFrame, column: str, floor: int) -> DataFrame:
    """Rows per year of a Julian day column from ``floor`` on, with a share bar of at most 60 signs."""
    years = df.where(F.col(column) >= floor).groupBy(F.year(from_julian(F.col(column))).alias("year")).agg(F.count(F.lit(1)).alias("n"))
    total = years.agg(F.sum("n").alias("total"))
    bar = F.repeat(F.lit("#"), F.least(F.lit(60), F.floor(F.col("n") * 60 / F.col("total")).cast("int")))
    return years.crossJoin(F.broadcast(total)).select("year", "n", bar.alias("bar"))  # one row


def column_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, rows, distinct_values, nulls, density, low, high) in one pass: values are counted per (column, value), then columns from these.

    A value travels as a number or a text that sorts as it does, next to its own text.
    """
    cells = F.array(*[F.struct(F.lit(i).alias("i"), *_sortable(F.col(c), df.schema[c].dataType), F.col(c).cast("string").alias("text")) for i, c in enumerate(columns)])
    per = df.select(F.inline(cells)).groupBy("i", "whole", "real", "chars", "text").agg(F.count(F.lit(1)).alias("n"))
    edge = F.struct("whole", "real", "chars", "text")
    known = F.col("text").isNotNull()
    out = per.groupBy("i").agg(
        F.sum("n").alias("rows"), F.count_if(known).alias("distinct_values"), F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("nulls"),
        F.min(F.when(known, edge))["text"].alias("low"), F.max(F.when(known, edge))["text"].alias("high"),
    )
    names = df.sparkSession.createDataFrame(list(enumerate(columns)), "i int, column string")  # a row a column
    out = names.join(out, "i", "left").na.fill(0, ["rows", "distinct_values", "nulls"])
    return out.select("column", "rows", "distinct_values", "nulls", "low", "high", F.when(F.col("distinct_values") > 0, 1.0 / F.col("distinct_values")).alias("density"))


def _sortable(c: Column, kind: T.DataType) -> list[Column]:
    """The value as ``whole``, ``real`` or ``chars``, the others null; each sorts as the value does."""
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        whole, real, chars = F.unix_micros(c.cast("timestamp")), None, None
    elif isinstance(kind, T.DateType):
        whole, real, chars = F.unix_date(c), None, None
    elif isinstance(kind, (T.FloatType, T.DoubleType)):
        whole, real, chars = None, c, None
    elif isinstance(kind, T.NumericType):
        whole, real, chars = c, None, None
    else:
        whole, real, chars = None, None, c.cast("string")
    return [F.lit(v).cast(t).alias(n) if v is None else v.cast(t).alias(n) for v, t, n in ((whole, "decimal(38,10)", "whole"), (real, "double", "real"), (chars, "string", "chars"))]


def matching_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("matching_rows"))
