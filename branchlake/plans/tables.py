"""How the registered queries see the driver's tables: branches, a drifted copy, a run log. Each comes with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def source_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").withColumns({"o_totalprice": F.col("o_totalprice").cast("decimal(18,2)"), "branch_id": F.col("o_orderkey") % 7})


def drifted(src: DataFrame) -> DataFrame:
    """A copy that lost keys, bumped prices and gained keys."""
    price = (F.col("o_totalprice") + F.when(F.col("o_orderkey") % 89 == 0, 1).otherwise(0)).cast("decimal(18,2)")
    kept = src.where(F.col("o_orderkey") % 97 != 0).withColumn("o_totalprice", price)
    return kept.unionByName(src.where(F.col("o_orderkey") % 101 == 0).withColumn("o_orderkey", F.col("o_orderkey") + 10_000_000))


def orders_delta(src: DataFrame) -> DataFrame:
    """Updates of every 50th order, and as many new ones."""
    some = src.where(F.col("o_orderkey") % 50 == 0)
    bumped = some.withColumn("o_totalprice", (F.col("o_totalprice") + 5).cast("decimal(18,2)"))
    return bumped.unionByName(some.withColumn("o_orderkey", F.col("o_orderkey") + 20_000_000))


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    failed = F.col("event_type") == "error"
    return e.select(
        F.concat(F.lit("run-"), (F.col("user_id") % 20).cast("string")).alias("pipeline_run_id"), F.concat(F.lit("t"), (F.col("event_id") % 5).cast("string")).alias("table_name"),
        (F.col("event_id") % 7).alias("branch_id"), F.col("event_id"), (F.col("event_id") % 1000).alias("row_count"), F.when(failed, "FAILED").otherwise("SUCCESS").alias("status"),
        F.when(F.col("event_id") % 5 == 0, "replace").otherwise("merge").alias("write_disposition"), F.col("ts").alias("start_time"), (F.col("ts") + F.expr("interval 90 seconds")).alias("end_time"),
        F.when(F.col("event_id") % 50 == 0, "{}").alias("schema_discrepancy"), F.when(failed, "read failed").alias("error_details"),
    )


def control(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (table, branch), from the run log; branch 6 of no table is stored."""
    log = run_log(spark, sf_dir).where("branch_id < 6")
    return log.groupBy("table_name", F.col("branch_id").cast("string").alias("branch_id")).agg(
        F.max_by("status", "event_id").alias("status"), F.sum("row_count").alias("row_count"), F.max("event_id").cast("string").alias("last_cdc_value"),
        F.lit("number").alias("last_cdc_kind"), F.date_format(F.max("start_time"), "yyyy-MM-dd").alias("last_date_value"), F.lit("datetime").alias("last_date_kind"),
        F.date_format(F.max("end_time"), "yyyy-MM-dd HH:mm:ss").alias("last_run_at"),
    )


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A commit log: every event is a snapshot."""
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("commit_id"), F.col("ts").alias("committed_at"))


SRC = """src AS (SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice, o_orderdate, o_orderpriority, o_orderkey % 7 AS branch_id FROM orders)"""
DRIFTED = """lake AS (SELECT * REPLACE (CAST(o_totalprice + CASE WHEN o_orderkey % 89 = 0 THEN 1 ELSE 0 END AS DECIMAL(18,2)) AS o_totalprice) FROM src WHERE o_orderkey % 97 <> 0
UNION ALL SELECT * REPLACE (o_orderkey + 10000000 AS o_orderkey) FROM src WHERE o_orderkey % 101 = 0)"""
DELTA = """delta AS (SELECT * REPLACE (CAST(o_totalprice + 5 AS DECIMAL(18,2)) AS o_totalprice) FROM src WHERE o_orderkey % 50 = 0
UNION ALL SELECT * REPLACE (o_orderkey + 20000000 AS o_orderkey) FROM src WHERE o_orderkey % 50 = 0)"""
LOG = """log AS (SELECT 'run-' || (user_id % 20) AS pipeline_run_id, 't' || (event_id % 5) AS table_name, event_id % 7 AS branch_id, event_id, event_id % 1000 AS row_count,
CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS status, CASE WHEN event_id % 5 = 0 THEN 'replace' ELSE 'merge' END AS write_disposition,
ts AS start_time, ts + INTERVAL 90 SECOND AS end_time, CASE WHEN event_id % 50 = 0 THEN '{}' END AS schema_discrepancy, CASE WHEN event_type = 'error' THEN 'read failed' END AS error_details FROM events)"""
CONTROL = """control AS (SELECT table_name, CAST(branch_id AS VARCHAR) AS branch_id, arg_max(status, event_id) AS status, CAST(sum(row_count) AS BIGINT) AS row_count,
CAST(max(event_id) AS VARCHAR) AS last_cdc_value, 'number' AS last_cdc_kind, strftime(max(start_time), '%Y-%m-%d') AS last_date_value, 'datetime' AS last_date_kind,
strftime(max(end_time), '%Y-%m-%d %H:%M:%S') AS last_run_at FROM log WHERE branch_id < 6 GROUP BY ALL)"""
COMMITS = "commits AS (SELECT event_id AS commit_id, ts AS committed_at FROM events), newest AS (SELECT commit_id FROM commits ORDER BY committed_at DESC, commit_id DESC LIMIT 1)"
