"""Browsing lake tables and run logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MOST = 1000
_TIMES = (T.DateType, T.TimestampType, T.TimestampNTZType)
GRAINS = {"minute": "yyyy-MM-dd HH:mm", "hour": "yyyy-MM-dd HH:00", "day": "yyyy-MM-dd", "month": "yyyy-MM", "year": "yyyy"}
_PREFIX = {"year": 4, "month": 7, "day": 10}
TIME_COLUMNS = ("recorded_at", "check_time", "updated_at", "Recorded_updated_at", "start_time", "insert_at")


def sample_rows(df: DataFrame, branch: int | None = None, date_column: str | None = None, day: str | None = None, limit: int | None = 50) -> DataFrame:
    """Rows of a branch and day, at most 1000, or all of them with no limit; a null date counts as empty text."""
    if branch is not None:
        df = df.where(F.col("branch_id") == branch)
    if date_column and day is not None:
        df = df.where(F.coalesce(F.substring(F.col(date_column).cast("string"), 1, 10), F.lit("")) == day)
    return df if limit is None else df.limit(min(limit, MOST))


def bucket(df: DataFrame, column: str, grain: str) -> Column:
    """Time label of a grain; other types by their text prefix."""
    c = F.col(column)
    if isinstance(df.schema[column].dataType, _TIMES):
        return F.date_format(c, GRAINS[grain])
    return F.substring(c.cast("string"), 1, _PREFIX.get(grain, 10))


def aggregate(df: DataFrame, by: str, date_column: str | None = None, grain: str = "month") -> DataFrame:
    """Row counts ``by`` branch, date or branch_date."""
    keys = ([F.col("branch_id")] if "branch" in by else []) + ([bucket(df, date_column, grain).alias("bucket")] if "date" in by else [])
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def branch_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("branch_id").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("branch_id").asc_nulls_last())


def summarize(df: DataFrame, branch_column: str, time_column: str, grain: str, branches: list | None = None) -> DataFrame:
    """Records by branch and time grain; null times are "(null)", values that are no time stand for themselves."""
    if branches is not None:
        df = df.where(F.col(branch_column).isin(*branches))
    temporal = isinstance(df.schema[time_column].dataType, _TIMES)
    label = F.date_format(time_column, GRAINS[grain]) if temporal else F.col(time_column).cast("string")
    return df.groupBy(F.col(branch_column).alias("branch"), F.coalesce(label, F.lit("(null)")).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def summarize_totals(summary: DataFrame) -> DataFrame:
    """Subtotal per branch, and the grand total under a null branch."""
    total = summary.rollup("branch").agg(F.sum("n").alias("n"), F.grouping("branch").alias("g"))
    return total.select("branch", F.when(F.col("g") == 1, F.lit("grand total")).otherwise(F.lit("subtotal")).alias("kind"), "n")


def run_summary(log: DataFrame, limit: int = 50) -> DataFrame:
    """One row per run, newest first: wall clock, rows, units, outcomes, drift, errors, tables."""
    us = lambda c: F.unix_micros(c.cast("timestamp"))
    ok = F.col("status") == "SUCCESS"
    return (
        log.groupBy("pipeline_run_id")
        .agg(
            F.min("start_time").alias("started"), F.max("end_time").alias("ended"), F.floor((us(F.max("end_time")) - us(F.min("start_time"))) / 1000).alias("wall_ms"),
            F.sum("row_count").alias("rows"), F.count(F.lit(1)).alias("units"), F.count_if(ok).alias("ok"), F.count_if(~ok).alias("failed"),
            F.count("schema_discrepancy").alias("drift"), F.count("error_details").alias("errors"), F.count_distinct("table_name").alias("tables"),
        )
        .orderBy(F.col("started").desc_nulls_last(), F.desc("pipeline_run_id"))
        .limit(min(limit, MOST))
    )


def run_detail(log: DataFrame, control: DataFrame, limit: int | None = None, tie: tuple[str, ...] = ()) -> DataFrame:
    """All units of a run, or the first ``limit``, with their stored marks: failures first, then table, then branch. Branch ids may be text on one side and numbers on the other."""
    marks = control.select(F.col("table_name").alias("__t"), F.col("branch_id").cast("string").alias("__b"), F.col("status").alias("control_status"), "last_cdc_value", "last_date_value")
    j = log.join(marks, (F.col("table_name") == F.col("__t")) & (F.col("branch_id").cast("string") == F.col("__b")), "left").drop("__t", "__b")
    j = j.orderBy(F.col("status") == "SUCCESS", F.coalesce("table_name", F.lit("")), F.col("branch_id").asc_nulls_last(), "pipeline_run_id", *tie)
    return j if limit is None else j.limit(limit)


def recent_run_log(log: DataFrame, runs: int) -> DataFrame:
    """Log rows of the newest ``runs`` runs."""
    ids = log.groupBy("pipeline_run_id").agg(F.max("start_time").alias("at")).orderBy(F.desc("at"), F.desc("pipeline_run_id")).limit(runs)
    return log.join(ids.select("pipeline_run_id"), "pipeline_run_id", "left_semi")


def newest_rows(df: DataFrame, limit: int = 200, columns: tuple[str, ...] = TIME_COLUMNS, tie: tuple[str, ...] = ()) -> DataFrame:
    """Newest rows by the first time column there is, with the table's row count next to each."""
    column = next((c for c in columns if c in df.columns), None)
    total = df.agg(F.count(F.lit(1)).alias("total_rows"))
    order = ([F.col(column).desc_nulls_last()] if column else []) + [F.col(t) for t in tie]
    top = (df.orderBy(*order) if order else df).limit(min(limit, MOST))
    return top.crossJoin(F.broadcast(total))  # one row


def read_rows(df: DataFrame, equals: dict | None = None, order_by: str | None = None, descending: bool = True, limit: int = 200, tie: tuple[str, ...] = ()) -> DataFrame:
    """Filter, order and limit; an order column that is not there is ignored."""
    for c, v in (equals or {}).items():
        df = df.where(F.col(c) == v)
    if order_by in df.columns:
        df = df.orderBy(F.col(order_by).desc() if descending else F.col(order_by).asc(), *tie)
    return df.limit(limit)


def export_csv(df: DataFrame, path: str) -> None:
    """The whole filtered table with a header; one file per partition."""
    df.write.mode("overwrite").option("header", True).csv(path)
