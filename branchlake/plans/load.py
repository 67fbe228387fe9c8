"""One table's load from extracts to lake, marks and run log.

Source rows are read once: they are staged first, and everything after that (emptiness, marks, the merge, its counts) comes from the staged rows. So a mark never speaks of a row that
the load has not seen, however the source moves on meanwhile.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from branchlake.defs import BRANCH, HELPER_CDC, HELPER_DATE, INSERTED, UPDATED, TableDef, normal
from branchlake.functions.keys import stabilize_keys, with_merge_hash
from branchlake.functions.schema import cast_to, normalize_columns, require_keys, schema_diff, strip_reserved, unify_branches, unify_schemas, widen_to_destination
from branchlake.operators.control import advance, control_rows, log_rows
from branchlake.operators.merge import choose_disposition
from branchlake.sources.extract import capture_watermarks, extract, helper_join, inject_columns, stage, with_derived_key
from branchlake.sources.lake import Lake, retain
from branchlake.sources.scratch import fresh


@dataclass
class LoadResult:
    table: str
    disposition: str
    status: str
    rows: int
    marks: DataFrame | None = None
    drift: dict = field(default_factory=dict)
    failed: list[int] = field(default_factory=list)
    error: str | None = None


def load_table(
    lake: Lake, tdef: TableDef, branches: dict[int, DataFrame | None], mode: str, now: datetime, configured: int, run_id: str = "", marks: dict[int, tuple[str | None, str | None]] | None = None,
    parents: dict[int, DataFrame] | None = None,
) -> LoadResult:
    """``branches``: source rows by branch id, None for one that could not be read. ``marks``: (change, date) high-water marks by branch. ``parents``: the helper's table by branch, for a
    table that borrows its change columns; rows that bring these columns already need none."""
    good = {b: d for b, d in branches.items() if d is not None}
    failed = sorted(set(branches) - set(good))
    disposition = choose_disposition(tdef, mode, len(good), len(branches), configured)
    if disposition == "skip":
        return LoadResult(tdef.lake_name, disposition, "SKIPPED", 0, failed=failed)
    parts = {}
    for b, d in good.items():
        if tdef.helper and not {HELPER_CDC, HELPER_DATE} & set(d.columns):
            d = helper_join(d, parents[b], tdef.helper)
        cdc, date = (marks or {}).get(b, (None, None))
        taken = with_derived_key(extract(d, tdef, mode, cdc, date), tdef)
        parts[b] = inject_columns(stabilize_keys(taken, [k for k in tdef.keys if k in taken.columns]), b, tdef, now, now)
    unified = unify_schemas([p.schema for p in parts.values()])
    drift = {b: d for b, p in parts.items() if any((d := schema_diff(p.schema, unified)).values())}
    folder = fresh(lake.spark, "staged")
    try:
        return _load_staged(lake, tdef, stage(unify_branches(list(parts.values())), folder), disposition, now, run_id, drift, failed)
    finally:  # committed by now, or to be read again from the source
        lake.delete(folder)


def _load_staged(lake: Lake, tdef: TableDef, whole: DataFrame, disposition: str, now: datetime, run_id: str, drift: dict, failed: list[int]) -> LoadResult:
    marks = capture_watermarks(whole, tdef, BRANCH)
    captured = lake.spark.createDataFrame(marks.collect(), marks.schema)  # a row per branch; it outlives the staged rows
    rows = normalize_columns(strip_reserved(whole)).withColumnsRenamed({normal(BRANCH): "branch_id", normal(INSERTED): "insert_at", normal(UPDATED): "recorded_updated_at"})
    keys = [*[normal(k) for k in tdef.keys], "branch_id"]
    if tdef.keys:
        rows = with_merge_hash(require_keys(rows, keys), keys)
    if rows.isEmpty():
        return LoadResult(tdef.lake_name, disposition, "SUCCESS", 0, captured, drift, failed)
    if disposition == "merge":
        if lake.has(tdef.lake_name):
            stored = lake.read(tdef.lake_name).schema
            for f in widen_to_destination(rows.schema, stored).fields:
                rows = rows.withColumn(f.name, F.col(f.name).cast(f.dataType))
        commit = lake.merge(tdef.lake_name, rows, keys, run_id, now)
    elif disposition == "append":
        commit = lake.append(tdef.lake_name, rows, run_id, now)
    else:
        commit = lake.replace(tdef.lake_name, rows, run_id, now)
    added = lake.commits(tdef.lake_name).where(F.col("commit_id") == commit).agg(F.sum("added_records").alias("n")).first()["n"]
    return LoadResult(tdef.lake_name, disposition, "PARTIAL" if failed else "SUCCESS", added, captured, drift, failed)


CONTROL, LOG = "etl_control", "etl_run_log"
_CONTROL = "table_name string, branch_id bigint, load_mode string, status string, row_count bigint, last_cdc_value string, last_cdc_kind string, last_date_value string, last_date_kind string"
_MARKS = [f"last_{role}_{part}" for role in ("cdc", "date") for part in ("value", "kind")]


@dataclass(frozen=True)
class Retention:
    """Snapshots that stay after a load: of the run itself the last, and of all those of the last ``days`` or the newest ``min_keep``."""

    days: int = 7
    min_keep: int = 1


def stored(lake: Lake, table: str, schema: str) -> DataFrame:
    return cast_to(lake.read(table), StructType.fromDDL(schema)) if lake.has(table) else lake.spark.createDataFrame([], schema)


def expire(lake: Lake, table: str, run_id: str, now: datetime, keep: Retention) -> int:
    """Squash what the run has committed and drop snapshots that are too old; returns how many went."""
    snapshots = lake.snapshots(table).select("commit_id", "committed_at", "run_id").collect()  # one row a snapshot
    own = [r["commit_id"] for r in snapshots if r["run_id"] == run_id]
    later = lake.spark.createDataFrame([tuple(r) for r in snapshots if r["run_id"] != run_id or r["commit_id"] == max(own)], "commit_id bigint, committed_at timestamp_ntz, run_id string")
    kept = retain(later, keep.days, keep.min_keep, str(now)).where("keep")
    return lake.keep_snapshots(table, kept) if kept.count() < len(snapshots) else 0


def _record(lake: Lake, tdef: TableDef, branches: dict[int, DataFrame | None], mode: str, now: datetime, run_id: str, done: LoadResult) -> None:
    """Upsert the marks of the loaded branches and append a log row per branch. Both are commits of their own, so loads of other tables that record themselves at the same time lose nothing."""
    spark, name, error = lake.spark, tdef.lake_name, done.error
    log = lake.commits(name).where((F.col("run_id") == run_id) & F.col("branch_id").isNotNull()) if lake.has(name) else spark.createDataFrame([], "branch_id bigint, added_records bigint")
    added = {r["branch_id"]: r["n"] for r in log.groupBy("branch_id").agg(F.sum("added_records").alias("n")).collect()}  # a row per branch
    units = spark.createDataFrame(
        [
            (
                name, b, tdef.category, mode, run_id, done.disposition, "FAILED" if d is None else "SUCCESS", "FAILED" if error else "LOADED", 0 if d is None or error else added.get(b, 0),
                done.drift.get(b, {}).get("missing_in_branch", []), done.drift.get(b, {}).get("extra_in_branch", []), error or ("not read" if d is None else None),
            )
            for b, d in sorted(branches.items())
        ],
        "table_name string, branch_id bigint, category string, load_mode string, pipeline_run_id string, disposition string, status string, load_status string, row_count bigint, missing array<string>, extra array<string>, error_details string",
    )
    captured = done.marks if done.marks is not None else spark.createDataFrame([], f"{BRANCH} bigint, cdc_value string, cdc_kind string, date_value string, date_kind string")
    captured = captured.select(F.col(BRANCH).alias("branch_id"), *[F.col(m.removeprefix("last_")).alias(m) for m in _MARKS])
    rows = control_rows(units.join(captured, "branch_id", "left"))
    control = stored(lake, CONTROL, _CONTROL).where(F.col("table_name") == name).select("table_name", "branch_id", *_MARKS)
    moved = advance(control, rows.select("table_name", "branch_id", *_MARKS)).join(rows.drop(*_MARKS), ["table_name", "branch_id"])
    lake.merge(CONTROL, cast_to(moved, StructType.fromDDL(_CONTROL)), ["table_name", "branch_id"], run_id, now)
    lake.append(LOG, log_rows(units).withColumn("recorded_at", F.lit(str(now)).cast("timestamp_ntz")), run_id, now)


def run_table(
    lake: Lake, tdef: TableDef, branches: dict[int, DataFrame | None], mode: str, now: datetime, configured: int, run_id: str, parents: dict[int, DataFrame] | None = None, keep: Retention | None = Retention(),
) -> LoadResult:
    """A load that records itself: it starts from the marks in the lake's control table, and afterwards advances those of the branches that were loaded and writes a log row per branch.

    A load that fails is recorded as such, without advancing anything, and its result says so, as it does if only the recording fails; the next run takes the same rows again. Tables may be run at the same
    time. ``keep``: which snapshots stay of the table and of the two that record (None: all); files that go with the others are for ``Lake.sweep``.
    """
    name = tdef.lake_name
    try:
        control = stored(lake, CONTROL, _CONTROL).where(F.col("table_name") == name)
        marks = {r["branch_id"]: (r["last_cdc_value"], r["last_date_value"]) for r in control.collect()}  # one row per branch
        done = load_table(lake, tdef, branches, mode, now, configured, run_id, marks, parents)
    except Exception as e:  # one table must not end the others
        done = LoadResult(name, "none", "FAILED", 0, failed=sorted(b for b, d in branches.items() if d is None), error=str(e)[:500])
    try:
        _record(lake, tdef, branches, mode, now, run_id, done)
    except Exception as e:  # the data may be there, but the next run must take them again
        done.status, done.error = "FAILED", done.error or f"not recorded: {e}"[:500]
        return done
    for table in (name, CONTROL, LOG) if keep else ():
        try:
            if lake.has(table):
                expire(lake, table, run_id, now, keep)
        except Exception as e:  # what has not gone now goes with the next run
            warnings.warn(f"snapshots of {table} not expired: {str(e)[:300]}", stacklevel=2)
    return done
