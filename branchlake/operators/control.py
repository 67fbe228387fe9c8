"""Stored high-water marks, run log and their summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from branchlake.functions.schema import cast_to

UNIT = ["table_name", "branch_id"]


def upsert_control(existing: DataFrame, rows: DataFrame) -> DataFrame:
    """Upsert on (table_name, branch_id): every other column is overwritten, one the new rows lack becomes null."""
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in existing.schema.fields])
    return existing.join(rows.select(*UNIT), UNIT, "left_anti").select(*existing.columns).unionAll(cast_to(rows, schema))


def append_log(log: DataFrame, rows: DataFrame) -> DataFrame:
    return log.unionByName(rows, allowMissingColumns=True)


def advance(control: DataFrame, captured: DataFrame) -> DataFrame:
    """Control marks after a run. ``captured`` has the same columns; the larger mark stays with its kind: numbers compare as numbers, other kinds as text, and a number that
    does not parse gives way to the new value."""
    joined = control.alias("o").join(captured.alias("n"), [F.col(f"o.{k}") == F.col(f"n.{k}") for k in UNIT], "full_outer")
    out = [F.coalesce(F.col(f"n.{k}"), F.col(f"o.{k}")).alias(k) for k in UNIT]
    for role in ("cdc", "date"):
        old, new = (F.struct(F.col(f"{side}.last_{role}_value").alias("value"), F.col(f"{side}.last_{role}_kind").alias("kind")) for side in "on")
        ov, nv = old["value"], new["value"]
        a, b = ov.try_cast("double"), nv.try_cast("double")
        larger = F.when(new["kind"] == "number", a.isNull() | b.isNull() | (b > a)).otherwise(nv > ov)
        mark = F.when(nv.isNotNull() & (ov.isNull() | larger), new).otherwise(old)
        out += [mark[part].alias(f"last_{role}_{part}") for part in ("value", "kind")]
    return joined.select(*out)


def control_rows(units: DataFrame) -> DataFrame:
    """units (table_name, branch_id, category, load_mode, status, load_status, row_count, marks) -> control rows: a failed unit advances no mark, a failed load fails the unit."""
    ok = (F.col("status") == "SUCCESS") & (F.col("load_status") != "FAILED")
    marks = [F.when(ok, F.col(f"last_{r}_{p}")).alias(f"last_{r}_{p}") for r in ("cdc", "date") for p in ("value", "kind")]
    return units.select(
        *UNIT, F.when(F.col("category") == "snapshots", F.lit("SNAPSHOT")).otherwise(F.col("load_mode")).alias("load_mode"),
        F.when(F.col("load_status") == "FAILED", F.lit("FAILED")).otherwise(F.col("status")).alias("status"), "row_count", *marks,
    )


def log_rows(units: DataFrame) -> DataFrame:
    """Run-log rows; drift is a JSON text, null without drift."""
    drift = F.when(F.size("missing") + F.size("extra") > 0, F.to_json(F.struct(F.col("missing").alias("missing_in_branch"), F.col("extra").alias("extra_in_branch"))))
    return units.select("pipeline_run_id", *UNIT, "row_count", "status", F.col("disposition").alias("write_disposition"), "load_status", drift.alias("schema_discrepancy"), "error_details")


def control_rows_view(control: DataFrame) -> DataFrame:
    """Flat control state in order of table and branch."""
    cols = ["status", "row_count", "last_cdc_value", "last_date_value"]
    return control.select(*UNIT, *[c for c in cols if c in control.columns]).orderBy(*UNIT)


def clear_control(control: DataFrame, tables: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(control without the dropped tables, the dropped tables that had marks)."""
    names = tables.select("table_name").distinct()
    return control.join(names, "table_name", "left_anti"), control.join(names, "table_name", "left_semi").select("table_name").distinct()


def control_summary(control: DataFrame) -> DataFrame:
    """One row per status, with the grand totals next to it."""
    total = control.agg(
        F.count(F.lit(1)).alias("units"), F.count_distinct("table_name").alias("tables"), F.count_distinct("branch_id").alias("branches"),
        F.sum("row_count").alias("total_rows"), F.max("last_run_at").alias("last_run"),
    )
    return control.groupBy("status").agg(F.count(F.lit(1)).alias("n")).crossJoin(F.broadcast(total))  # one row


def load_summary(log: DataFrame) -> DataFrame:
    failed = F.col("status") != "SUCCESS"
    return log.groupBy("table_name").agg(
        F.max("write_disposition").alias("write_disposition"), F.count_if(~failed).alias("ok"), F.count_if(failed).alias("failed"),
        F.coalesce(F.sum(F.when(~failed, F.col("row_count"))), F.lit(0)).alias("rows"),
        F.when(F.bool_and(failed), F.lit("SKIPPED")).when(F.bool_or(failed), F.lit("PARTIAL")).otherwise(F.lit("LOADED")).alias("load_status"),
    )
