"""Queries on control state, reconciliation, history, exploration, profiling and models."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from branchlake.defs import TableDef
from branchlake.functions.keys import fingerprint, julian_day, row_hash
from branchlake.operators import control as C
from branchlake.operators import explore as E
from branchlake.operators import history as H
from branchlake.operators import logs as L
from branchlake.operators import profile as P
from branchlake.operators import reconcile as R
from branchlake.plans import models as MO
from branchlake.plans.tables import COMMITS, CONTROL, DRIFTED, LOG, SRC, control, drifted, query, run_log, snapshots, source_orders, table
from branchlake.sources import lake as LK
from branchlake.sources.extract import stage
from branchlake.sources.scratch import fresh

NOW = datetime(2026, 1, 2, 3, 4, 5)
ORDERS = TableDef("ORDERS", ("o_orderkey",), "transactions", cdc_column="o_orderdate", date_column="o_orderdate")
KEY = ["o_orderkey"]

# ---- reconciliation

_BUCKETS = f"""WITH {SRC}, {DRIFTED}, j AS (SELECT coalesce(src.branch_id, lake.branch_id) AS branch_id, src.o_orderkey AS s, lake.o_orderkey AS k, src.o_totalprice AS sp, lake.o_totalprice AS kp
FROM src FULL JOIN lake ON src.o_orderkey = lake.o_orderkey AND src.branch_id = lake.branch_id),
c AS (SELECT branch_id, count(s) AS source_rows, count(k) AS lake_rows, count(s) AS source_hashed, count(k) AS lake_hashed, count(*) FILTER (sp = kp) AS matched, count(*) FILTER (sp <> kp) AS mismatch,
count(*) FILTER (k IS NULL) AS only_source, count(*) FILTER (s IS NULL) AS only_lake FROM j GROUP BY branch_id)"""
_CHECKED = _BUCKETS + """, t AS (SELECT *, source_rows - lake_rows AS count_delta, mismatch + only_source + only_lake AS total_delta FROM c),
p AS (SELECT *, CASE WHEN total_delta = 0 THEN 0.0 WHEN source_hashed > 0 THEN round(100.0 * total_delta / source_hashed, 4) END AS delta_pct FROM t),
checked AS (SELECT *, CASE WHEN count_delta <> 0 THEN 'MISMATCH' WHEN total_delta = 0 THEN 'OK' WHEN delta_pct <= 10 THEN 'WITHIN_TOLERANCE' ELSE 'MISMATCH' END AS status FROM p)"""


def _both(spark, d):
    src = source_orders(spark, d)
    return src, drifted(src)


@query("q4_hash_check", _CHECKED + " SELECT * FROM checked")
def q4(spark, d):
    return R.hash_check(*_both(spark, d), KEY)


@query("j2_compare", _BUCKETS + " SELECT * FROM c")
def j2(spark, d):
    src, lake = _both(spark, d)
    cols = [c for c in src.columns if c != "branch_id"]
    return R.compare(R.keyed_hashes(src, KEY, cols), R.keyed_hashes(lake, KEY, cols))


@query("a2_dedupe_min_hash", "SELECT CAST(l_orderkey % 7 AS BIGINT) AS branch_id, l_orderkey || chr(31) || l_linenumber AS k, upper(min(md5(CAST(l_partkey AS VARCHAR)))) AS h, count(*) AS rows FROM lineitem GROUP BY ALL")
def a2(spark, d):
    li = table(spark, d, "lineitem").withColumn("branch_id", F.col("l_orderkey") % 7)
    told = li.select("branch_id", fingerprint(li, ["l_orderkey", "l_linenumber"]).alias("k"), row_hash(li, ["l_partkey"]).alias("h"))
    return R.dedupe_min_hash(told).withColumn("h", F.hex("h"))


WIN = R.make_window(TableDef("ORDERS", KEY and ("o_orderkey",), "transactions", date_column="o_orderdate", date_max="2001-01-01"), {"last_date": {"value": "2000-06-30 00:00:00.000000", "kind": "datetime"}}, date(1998, 1, 1), None, date(2026, 1, 1))
_IN = "o_orderdate >= DATE '1998-01-01' AND o_orderdate <= DATE '2000-06-30'"


@query("p13_window_filter", f"SELECT o_orderkey FROM orders WHERE {_IN}")
def p13(spark, d):
    return R.apply_window(table(spark, d, "orders"), WIN).select("o_orderkey")


@query("a3_window_count", f"WITH {SRC} SELECT branch_id, count(*) AS n FROM src WHERE {_IN} GROUP BY 1")
def a3(spark, d):
    return R.window_count(source_orders(spark, d), WIN)


@query("q3_count_check", f"WITH {SRC}, {DRIFTED}, s AS (SELECT branch_id, count(*) AS n FROM src WHERE {_IN} GROUP BY 1), k AS (SELECT branch_id, count(*) AS n FROM lake WHERE {_IN} GROUP BY 1) SELECT branch_id, coalesce(s.n, 0) AS source_rows, coalesce(k.n, 0) AS lake_rows, coalesce(s.n, 0) - coalesce(k.n, 0) AS count_delta, CASE WHEN coalesce(s.n, 0) = coalesce(k.n, 0) THEN 'OK' ELSE 'MISMATCH' END AS status FROM s FULL JOIN k USING (branch_id)")
def q3(spark, d):
    return R.count_check(*_both(spark, d), WIN)


@query("q5_q6_tolerance", _CHECKED + ", u AS (SELECT branch_id, total_delta, delta_pct FROM checked) SELECT branch_id, delta_pct, CASE WHEN total_delta = 0 THEN 'OK' WHEN delta_pct <= 1.5 THEN 'WITHIN_TOLERANCE' ELSE 'MISMATCH' END AS status FROM u")
def q56(spark, d):
    checked = R.hash_check(*_both(spark, d), KEY)
    return checked.select("branch_id", "delta_pct", R.classify(F.lit(0), F.col("total_delta"), F.col("delta_pct"), 1.5).alias("status"))


_RESULT = _CHECKED + """, results AS (SELECT '2026-01-02 03:04:05' AS check_time, 'r1' AS pipeline_run_id, 'orders' AS table_name, 'ORDERS' AS source_table, branch_id, 'o_orderdate' AS date_column,
'1990-01-01 00:00:00' AS window_start, '(max)' AS window_end, 'no-mark/open' AS window_note, source_rows AS source_row_count, lake_rows AS lake_row_count, count_delta AS row_count_delta,
CAST(6 AS BIGINT) AS hash_columns, source_hashed AS source_hashed_rows, lake_hashed AS lake_hashed_rows, matched AS hash_matched, only_source AS hash_only_in_source, only_lake AS hash_only_in_lake, mismatch AS hash_mismatch,
total_delta AS hash_total_delta, delta_pct AS hash_delta_pct, '' AS columns_only_in_source, '' AS columns_only_in_lake, status, NULL AS error_details FROM checked)"""


def _results(spark, d):
    win = R.make_window(ORDERS, None, date(1990, 1, 1), None, date(2026, 1, 1))
    src, lake = _both(spark, d)
    return R.reconcile(src, lake, ORDERS, win, NOW, "r1")


@query("q7_dq_results", _RESULT + " SELECT * FROM results")
def q7(spark, d):
    return _results(spark, d).withColumn("check_time", F.date_format("check_time", "yyyy-MM-dd HH:mm:ss"))


@query("q8_dq_summary", _RESULT + " SELECT table_name, branch_id, row_count_delta, hash_total_delta, hash_delta_pct, status, window_note FROM results")
def q8(spark, d):
    return R.dq_summary(_results(spark, d))


@query("a11_dq_tally", _CHECKED + " SELECT status, count(*) AS n FROM checked GROUP BY 1")
def a11(spark, d):
    return R.dq_tally(R.hash_check(*_both(spark, d), KEY))


@query("q10_staged_vs_lake", _CHECKED + " SELECT branch_id, matched, mismatch, only_source, only_lake FROM checked")
def q10(spark, d):
    src, lake = _both(spark, d)
    lk = LK.Lake(spark, fresh(spark, "lake"))
    lk.replace("orders", lake, "r1", NOW)
    staged = stage(src, fresh(spark, "staged"))
    return R.hash_check(staged, lk.read("orders"), KEY).select("branch_id", "matched", "mismatch", "only_source", "only_lake")


@query("s12_dq_csv", _CHECKED + " SELECT CAST(branch_id AS VARCHAR) AS branch_id, status FROM checked")
def s12(spark, d):
    path = fresh(spark, "dq-csv")
    R.write_dq_csv(_results(spark, d), path)
    return spark.read.csv(path, header=True).select("branch_id", "status")


@query("q10_named_keys", _CHECKED + " SELECT branch_id, hash_matched, status FROM (SELECT branch_id, matched AS hash_matched, status FROM checked)")
def q10n(spark, d):
    """Keys and columns are named as the source names them, in capitals and with signs."""
    src, lake = _both(spark, d)
    tdef = TableDef("ORDERS", ("O-OrderKey",), "transactions")
    return R.reconcile(src.withColumnRenamed("o_orderkey", "O-OrderKey"), lake.withColumnRenamed("o_orderkey", "O_ORDERKEY"), tdef, R.Window_(None), NOW, "r1").select("branch_id", "hash_matched", "status")


@query("q9_isolated_failure", "SELECT 'orders' AS table_name, 'ERROR' AS status, count(*) > 0 AS told FROM orders")
def q9(spark, d):
    """A row that can't be read ends the check of its table with an ERROR row, not the caller."""
    src, lake = _both(spark, d)
    broken = src.withColumn("o_custkey", F.when(F.col("o_orderkey") % 1000 == 7, F.raise_error(F.lit("unreadable")).cast("bigint")).otherwise(F.col("o_custkey")))
    return R.reconcile(broken, lake, ORDERS, R.Window_(None), NOW, "r1").select("table_name", "status", F.col("error_details").contains("unreadable").alias("told"))


@query("j3_null_keys", f"WITH {SRC}, {DRIFTED}, a AS (SELECT o_custkey % 50 AS c, CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderkey END AS k, max(o_totalprice) AS p FROM src GROUP BY 1, 2), b AS (SELECT o_custkey % 50 AS c, CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderkey END AS k, max(o_totalprice) AS p FROM lake GROUP BY 1, 2) SELECT * FROM (SELECT coalesce(a.c, b.c) AS c, coalesce(a.k, b.k) AS k, CASE WHEN a.c IS NULL THEN 'inserted' WHEN b.c IS NULL THEN 'deleted' WHEN a.p <> b.p THEN 'updated' END AS change FROM a FULL JOIN b ON a.c = b.c AND a.k IS NOT DISTINCT FROM b.k) WHERE change IS NOT NULL")
def j3n(spark, d):
    """A null in a key is a value like others: it meets the null of the other side."""
    k = F.when(F.col("o_orderkey") % 13 != 0, F.col("o_orderkey"))
    old, new = (df.groupBy((F.col("o_custkey") % 50).alias("c"), k.alias("k")).agg(F.max("o_totalprice").alias("p")) for df in _both(spark, d))
    return H.diff_keys(old, new, ["c", "k"])


# ---- history

_CHANGES = f"WITH {SRC}, {DRIFTED}, ch AS (SELECT coalesce(src.o_orderkey, lake.o_orderkey) AS o_orderkey, CASE WHEN src.o_orderkey IS NULL THEN 'inserted' WHEN lake.o_orderkey IS NULL THEN 'deleted' WHEN src.o_totalprice <> lake.o_totalprice THEN 'updated' END AS change, src.o_totalprice AS o, lake.o_totalprice AS n FROM src FULL JOIN lake USING (o_orderkey))"


@query("j3_diff_keys", _CHANGES + " SELECT o_orderkey, change FROM ch WHERE change IS NOT NULL")
def j3(spark, d):
    return H.diff_keys(*_both(spark, d), KEY)


@query("d1_snapshot_diff", _CHANGES + " SELECT count(*) FILTER (change = 'updated') AS updated, count(*) FILTER (change = 'inserted') AS inserted, count(*) FILTER (change = 'deleted') AS deleted FROM ch")
def d1(spark, d):
    return H.snapshot_diff(*_both(spark, d), KEY)


@query("j5_changed_rows_semi", _CHANGES + " SELECT o_orderkey, o AS o_totalprice FROM ch WHERE change = 'updated'")
def j5(spark, d):
    old, new = _both(spark, d)
    return H.collect_changed(old, H.diff_keys(old, new, KEY).where("change = 'updated'"), KEY).select("o_orderkey", "o_totalprice")


@query("d2_changed_pairs", _CHANGES + " SELECT o_orderkey, o AS old_o_totalprice, n AS new_o_totalprice FROM ch WHERE change = 'updated'")
def d2(spark, d):
    return H.changed_pairs(*_both(spark, d), KEY).select("o_orderkey", "old_o_totalprice", "new_o_totalprice")


@query("d3_field_changes", _CHANGES + " SELECT o_orderkey, 'o_totalprice' AS \"column\", CAST(o AS VARCHAR) AS old, CAST(n AS VARCHAR) AS new FROM ch WHERE change = 'updated'")
def d3(spark, d):
    return H.field_changes(*_both(spark, d), KEY)


@query("s13_changes_csv", _CHANGES + " SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o AS VARCHAR) AS old, CAST(n AS VARCHAR) AS new FROM ch WHERE change = 'updated'")
def s13(spark, d):
    path = fresh(spark, "changes-csv")
    H.write_changes_csv(H.field_changes(*_both(spark, d), KEY), path)
    return spark.read.csv(path, header=True).select("o_orderkey", "old", "new")


@query("d4_wide_changes", _CHANGES + " SELECT o_orderkey, CAST(1 AS INTEGER) AS changes, o || ' → ' || n AS o_totalprice FROM ch WHERE change = 'updated'")
def d4(spark, d):
    return H.wide_changes(*_both(spark, d), KEY)


@query("d5_diff_summary", _CHANGES + " SELECT 'updated' AS label, count(*) FILTER (change = 'updated') AS value FROM ch UNION ALL SELECT 'inserted', count(*) FILTER (change = 'inserted') FROM ch UNION ALL SELECT 'deleted', count(*) FILTER (change = 'deleted') FROM ch UNION ALL SELECT 'duplicate keys, baseline', 0 UNION ALL SELECT 'duplicate keys, latest', 0")
def d5(spark, d):
    return H.diff_summary(*_both(spark, d), KEY)


@query("a4_duplicate_keys", "SELECT count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS duplicate_keys FROM lineitem")
def a4(spark, d):
    return H.duplicate_keys(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


def _wide_drift(spark, d):
    src, lake = _both(spark, d)
    return src, lake.withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 50 == 0, "Z").otherwise(F.col("o_orderstatus")))


_COUNTS = f"WITH {SRC}, {DRIFTED}, ch AS (SELECT src.o_orderkey, src.o_totalprice <> lake.o_totalprice AS p, lake.o_orderkey % 50 = 0 AS s FROM src JOIN lake USING (o_orderkey))"


@query("a17_change_counts", _COUNTS + " SELECT 'o_totalprice' AS \"column\", count(*) FILTER (p) AS n FROM ch UNION ALL SELECT 'o_orderstatus', count(*) FILTER (s) FROM ch")
def a17(spark, d):
    return H.change_counts(H.field_changes(*_wide_drift(spark, d), KEY))


@query("w8_top_changed", _COUNTS + " SELECT 'o_orderstatus' AS \"column\", count(*) FILTER (s) AS n FROM ch")
def w8(spark, d):
    return H.top_changed(H.field_changes(*_wide_drift(spark, d), KEY), 1)


@query("a18_changes_per_record", _COUNTS + " SELECT o_orderkey, CAST(p AS INTEGER) + CAST(s AS INTEGER) AS changes FROM ch WHERE p OR s")
def a18(spark, d):
    return H.wide_changes(*_wide_drift(spark, d), KEY).select("o_orderkey", "changes")


# ---- commit log

_DAY = "2024-01-15"


@query("w1_pick_snapshots", f"WITH {COMMITS} SELECT (SELECT commit_id FROM commits WHERE CAST(committed_at AS DATE) = DATE '{_DAY}' ORDER BY committed_at DESC, commit_id DESC LIMIT 1) AS baseline, commit_id AS latest FROM newest")
def w1(spark, d):
    return LK.pick_snapshots(snapshots(spark, d), _DAY)


@query("d6_retention", f"WITH {COMMITS} SELECT commit_id, (row_number() OVER (ORDER BY committed_at DESC, commit_id DESC) <= 3 OR committed_at >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 7 DAY) AS keep FROM commits")
def d6(spark, d):
    return LK.retain(snapshots(spark, d), 7, 3, "2024-01-31 00:00:00").select("commit_id", "keep")


@query("d7_squash", f"WITH {COMMITS} SELECT commit_id FROM commits WHERE commit_id < 10 OR commit_id IN (SELECT commit_id FROM newest)")
def d7(spark, d):
    log = snapshots(spark, d)
    return LK.squash(log, log.where("commit_id < 10")).select("commit_id")


@query("d8_expire_to_latest", f"WITH {COMMITS} SELECT commit_id FROM newest")
def d8(spark, d):
    return LK.expire_to_latest(snapshots(spark, d)).select("commit_id")


@query("j10_orphan_files", "SELECT 'f' || event_id AS folder, event_id AS bytes FROM events WHERE event_id % 7 <> 0")
def j10(spark, d):
    files = table(spark, d, "events").select(F.concat(F.lit("f"), F.col("event_id").cast("string")).alias("folder"), F.col("event_id").alias("bytes"))
    return LK.orphan_files(files, files.where("bytes % 7 = 0"), "folder")


def _versions(spark, d):
    src = source_orders(spark, d).select("o_orderkey", "o_totalprice", "branch_id")
    stamp = lambda df, v: df.withColumns({"version": F.lit(v).cast("timestamp_ntz"), "version_date": F.lit(v[:10]).cast("date")})
    lk = LK.Lake(spark, fresh(spark, "lake"))
    lk.append("copies", stamp(src, "2026-01-01 00:00:00"), "r1", NOW)
    lk.append("copies", stamp(drifted(src), "2026-01-02 00:00:00"), "r2", NOW)
    return lk


@query("d11_time_travel", f"WITH {SRC}, {DRIFTED} SELECT o_orderkey, o_totalprice FROM lake")
def d11(spark, d):
    return LK.at_version(_versions(spark, d).read("copies"), "2026-01-02 00:00:00").select("o_orderkey", "o_totalprice")


@query("d9_orphan_sweep", f"WITH {SRC}, {DRIFTED} SELECT count(*) AS rows, CAST(1 AS INTEGER) AS expired, true AS swept FROM lake")
def d9(spark, d):
    lk = LK.Lake(spark, fresh(spark, "lake"))
    for v, df in enumerate(_both(spark, d)):
        lk.replace("orders", df, f"r{v}", NOW)
    expired = lk.keep_snapshots("orders", LK.expire_to_latest(lk.snapshots("orders")))
    files, size, failed = lk.sweep("orders", older_than=timedelta(0))
    return lk.read("orders").agg(F.count(F.lit(1)).alias("rows")).select("rows", F.lit(expired).alias("expired"), F.lit(files > 0 and size > 0 and not failed).alias("swept"))


@query("x1_list_tables", f"WITH {SRC}, {DRIFTED} SELECT 'copies' AS \"table\", false AS is_system, (SELECT count(*) FROM src) + (SELECT count(*) FROM lake) AS rows, true AS stored, CAST(2 AS BIGINT) AS snapshots, '2026-01-02 03:04:05' AS updated, 'snapshots' AS category UNION ALL SELECT 'orders', false, (SELECT count(*) FROM src), true, 1, '2026-01-02 03:04:05', 'transactions'")
def x1(spark, d):
    lk = _versions(spark, d)
    lk.replace("orders", source_orders(spark, d), "r1", NOW)
    out = lk.list_tables(spark.createDataFrame([("orders", "transactions"), ("copies", "snapshots")], "table string, category string"))
    return out.select("table", "is_system", "rows", ((F.col("files") > 0) & (F.col("bytes") > 0)).alias("stored"), "snapshots", F.date_format("updated", "yyyy-MM-dd HH:mm:ss").alias("updated"), "category")


@query("x2_table_overview", f"WITH {SRC}, {DRIFTED} SELECT CAST(1 AS BIGINT) AS commit_id, 'append' AS operation, 'r1' AS run_id, (SELECT count(*) FROM src) AS added_records, (SELECT count(*) FROM src) AS total_records, false AS is_current UNION ALL SELECT 2, 'append', 'r2', (SELECT count(*) FROM lake), (SELECT count(*) FROM src) + (SELECT count(*) FROM lake), true")
def x2(spark, d):
    return _versions(spark, d).table_overview("copies")["history"].drop("committed_at")


# ---- exploration

_EVB = "ev AS (SELECT *, event_id % 7 AS branch_id, CASE WHEN event_id % 11 <> 0 THEN ts END AS happened FROM events)"


def _events(spark, d):
    return table(spark, d, "events").withColumns({"branch_id": F.col("event_id") % 7, "at": F.when(F.col("event_id") % 11 != 0, F.col("ts"))})


@query("p15_sample_rows", f"WITH {_EVB} SELECT event_id FROM ev WHERE branch_id = 2 AND strftime(happened, '%Y-%m-%d') = '2024-01-10'")
def p15(spark, d):
    return E.sample_rows(_events(spark, d), 2, "at", "2024-01-10", None).select("event_id")


@query("a5_branch_counts", f"WITH {_EVB} SELECT branch_id, count(*) AS n FROM ev GROUP BY 1")
def a5(spark, d):
    return E.branch_counts(_events(spark, d))


@query("a6_aggregate", f"WITH {_EVB} SELECT branch_id, strftime(ts, '%Y-%m-%d') AS bucket, count(*) AS n FROM ev GROUP BY 1, 2")
def a6(spark, d):
    return E.aggregate(_events(spark, d), "branch_date", "ts", "day")


@query("a6_aggregate_prefix", "SELECT substr(CAST(event_id AS VARCHAR), 1, 4) AS bucket, count(*) AS n FROM events GROUP BY 1")
def a6p(spark, d):
    return E.aggregate(_events(spark, d), "date", "event_id", "year")


_A7 = f"WITH {_EVB}, s AS (SELECT branch_id AS branch, coalesce(strftime(happened, '%Y-%m-%d %H:00'), '(null)') AS bucket, count(*) AS n FROM ev WHERE branch_id IN (0, 1, 2) GROUP BY 1, 2)"


@query("a7_summarize", _A7 + " SELECT * FROM s")
def a7(spark, d):
    return E.summarize(_events(spark, d), "branch_id", "at", "hour", [0, 1, 2])


@query("a8_totals", _A7 + " SELECT branch, 'subtotal' AS kind, CAST(sum(n) AS BIGINT) AS n FROM s GROUP BY 1 UNION ALL SELECT NULL, 'grand total', CAST(sum(n) AS BIGINT) FROM s")
def a8(spark, d):
    return E.summarize_totals(E.summarize(_events(spark, d), "branch_id", "at", "hour", [0, 1, 2]))


@query("a9_run_summary", f"WITH {LOG} SELECT pipeline_run_id, CAST(floor((epoch_us(max(end_time)) - epoch_us(min(start_time))) / 1000) AS BIGINT) AS wall_ms, CAST(sum(row_count) AS BIGINT) AS rows, count(*) AS units, count(*) FILTER (status = 'SUCCESS') AS ok, count(*) FILTER (status <> 'SUCCESS') AS failed, count(schema_discrepancy) AS drift, count(error_details) AS errors, count(DISTINCT table_name) AS tables FROM log GROUP BY 1")
def a9(spark, d):

    return E.run_summary(run_log(spark, d), 1000).drop("started", "ended")


@query("j8_run_detail", f"WITH {LOG}, {CONTROL} SELECT event_id, log.status, control.status AS control_status, last_cdc_value, last_date_value FROM log LEFT JOIN control ON log.table_name = control.table_name AND CAST(log.branch_id AS VARCHAR) = control.branch_id WHERE pipeline_run_id = 'run-3'")
def j8(spark, d):
    return E.run_detail(run_log(spark, d).where("pipeline_run_id = 'run-3'"), control(spark, d)).select("event_id", "status", "control_status", "last_cdc_value", "last_date_value")


@query("w5_run_detail_order", f"WITH {LOG} SELECT event_id FROM log ORDER BY status = 'SUCCESS', table_name, branch_id, pipeline_run_id, event_id LIMIT 1000")
def w5(spark, d):
    return E.run_detail(run_log(spark, d), control(spark, d), 1000, ("event_id",)).select("event_id")


@query("j9_recent_runs", f"WITH {LOG} SELECT event_id, pipeline_run_id FROM log WHERE pipeline_run_id IN (SELECT pipeline_run_id FROM log GROUP BY 1 ORDER BY max(start_time) DESC, 1 DESC LIMIT 3)")
def j9(spark, d):
    return E.recent_run_log(run_log(spark, d), 3).select("event_id", "pipeline_run_id")


@query("w3_newest_rows", f"WITH {LOG} SELECT event_id, (SELECT count(*) FROM log) AS total_rows FROM log ORDER BY start_time DESC, event_id LIMIT 200")
def w3(spark, d):
    return E.newest_rows(run_log(spark, d), 200, tie=("event_id",)).select("event_id", "total_rows")


@query("w4_read_rows", f"WITH {LOG} SELECT event_id, row_count FROM log WHERE status = 'FAILED' ORDER BY row_count DESC, event_id LIMIT 25")
def w4(spark, d):
    return E.read_rows(run_log(spark, d), {"status": "FAILED"}, "row_count", True, 25, ("event_id",)).select("event_id", "row_count")


@query("s11_export_csv", f"WITH {_EVB} SELECT CAST(event_id AS VARCHAR) AS event_id, event_type FROM ev WHERE branch_id = 4")
def s11(spark, d):
    path = fresh(spark, "export")
    E.export_csv(_events(spark, d).where("branch_id = 4").select("event_id", "event_type"), path)
    return spark.read.csv(path, header=True)


@query("j11_category_lookup", f"WITH {LOG} SELECT l.table_name AS \"table\", n, category FROM (SELECT table_name, count(*) AS n FROM log GROUP BY 1) l LEFT JOIN (VALUES ('t0', 'masters'), ('t1', 'transactions'), ('t2', 'snapshots')) c(t, category) ON c.t = l.table_name")
def j11(spark, d):
    cats = spark.createDataFrame([("t0", "masters"), ("t1", "transactions"), ("t2", "snapshots")], "table string, category string")
    return LK.with_category(run_log(spark, d).groupBy(F.col("table_name").alias("table")).agg(F.count(F.lit(1)).alias("n")), cats)


# ---- control state

_UNITS = f"WITH {LOG}, {CONTROL}"


@query("c1_advance", _UNITS + """, n AS (SELECT table_name, branch_id, CASE WHEN branch_id = '1' THEN NULL WHEN branch_id = '2' THEN '1' WHEN branch_id = '3' THEN 'x' ELSE CAST(CAST(last_cdc_value AS BIGINT) + 7 AS VARCHAR) END AS v FROM control WHERE branch_id <> '0')
SELECT c.table_name, c.branch_id, CASE WHEN n.v IS NULL THEN last_cdc_value WHEN n.v = 'x' THEN 'x' WHEN TRY_CAST(n.v AS BIGINT) > TRY_CAST(last_cdc_value AS BIGINT) THEN n.v ELSE last_cdc_value END AS last_cdc_value, last_date_value FROM control c LEFT JOIN n USING (table_name, branch_id)""")
def c1(spark, d):
    now = control(spark, d)
    b = F.col("branch_id")
    cdc = F.when(b == "1", None).when(b == "2", "1").when(b == "3", "x").otherwise((F.col("last_cdc_value").cast("bigint") + 7).cast("string"))
    got = now.where(b != "0").withColumn("last_cdc_value", cdc).withColumn("last_date_value", F.when(b == "4", "2000-01-01").otherwise(F.col("last_date_value")))
    return C.advance(now, got).select("table_name", "branch_id", "last_cdc_value", "last_date_value")


def _units(spark, d):
    bad = F.col("branch_id") == "4"
    return control(spark, d).withColumns({
        "category": F.when(F.col("table_name") == "t0", "snapshots").otherwise("masters"), "load_mode": F.lit("INITIAL"), "load_status": F.when(bad, "FAILED").otherwise("LOADED"), "pipeline_run_id": F.lit("r1"),
        "disposition": F.lit("merge"), "missing": F.when(bad, F.array(F.lit("a"))).otherwise(F.array().cast("array<string>")), "extra": F.array().cast("array<string>"), "error_details": F.when(bad, "load failed"),
    })


@query("c2_control_rows", _UNITS + " SELECT table_name, branch_id, CASE WHEN table_name = 't0' THEN 'SNAPSHOT' ELSE 'INITIAL' END AS load_mode, CASE WHEN branch_id = '4' THEN 'FAILED' ELSE status END AS status, row_count, CASE WHEN status = 'SUCCESS' AND branch_id <> '4' THEN last_cdc_value END AS last_cdc_value FROM control")
def c2(spark, d):
    return C.control_rows(_units(spark, d)).select("table_name", "branch_id", "load_mode", "status", "row_count", "last_cdc_value")


@query("c3_log_rows", _UNITS + " SELECT 'r1' AS pipeline_run_id, table_name, branch_id, row_count, status, 'merge' AS write_disposition, CASE WHEN branch_id = '4' THEN 'FAILED' ELSE 'LOADED' END AS load_status, CASE WHEN branch_id = '4' THEN '{\"missing_in_branch\":[\"a\"],\"extra_in_branch\":[]}' END AS schema_discrepancy, CASE WHEN branch_id = '4' THEN 'load failed' END AS error_details FROM control")
def c3(spark, d):
    return C.log_rows(_units(spark, d))


@query("s14_control_upsert", _UNITS + " SELECT table_name, branch_id, status, last_cdc_value, row_count FROM control WHERE branch_id <> '2' UNION ALL SELECT table_name, branch_id, 'NEW', '9', NULL FROM control WHERE branch_id = '2'")
def s14(spark, d):
    now = control(spark, d)
    new = now.where("branch_id = '2'").select("table_name", "branch_id", F.lit("NEW").alias("status"), F.lit("9").alias("last_cdc_value"))
    return C.upsert_control(now, new).select("table_name", "branch_id", "status", "last_cdc_value", "row_count")


@query("s15_append_log", f"WITH {LOG} SELECT event_id, status FROM log UNION ALL SELECT event_id + 1000000, 'SUCCESS' FROM log WHERE branch_id = 0")
def s15(spark, d):
    log = run_log(spark, d)
    return C.append_log(log, log.where("branch_id = 0").select((F.col("event_id") + 1_000_000).alias("event_id"), F.lit("SUCCESS").alias("status"))).select("event_id", "status")


@query("c5_control_view", _UNITS + " SELECT table_name, branch_id, status, row_count, last_cdc_value, last_date_value FROM control")
def c5(spark, d):
    return C.control_rows_view(control(spark, d))


@query("c6_clear_control", _UNITS + " SELECT table_name, branch_id, 'kept' AS part FROM control WHERE table_name <> 't1' UNION ALL SELECT 't1', NULL, 'cleared' WHERE EXISTS (SELECT 1 FROM control WHERE table_name = 't1')")
def c6(spark, d):
    gone = spark.createDataFrame([("t1",), ("never",)], "table_name string")
    kept, had = C.clear_control(control(spark, d), gone)
    return kept.select("table_name", "branch_id", F.lit("kept").alias("part")).unionAll(had.select("table_name", F.lit(None).cast("string"), F.lit("cleared")))


@query("a10_control_summary", _UNITS + " SELECT status, count(*) AS n, (SELECT count(*) FROM control) AS units, (SELECT count(DISTINCT table_name) FROM control) AS tables, (SELECT count(DISTINCT branch_id) FROM control) AS branches, (SELECT CAST(sum(row_count) AS BIGINT) FROM control) AS total_rows, (SELECT max(last_run_at) FROM control) AS last_run FROM control GROUP BY 1")
def a10(spark, d):
    return C.control_summary(control(spark, d))


@query("a19_load_summary", f"WITH {LOG} SELECT table_name, max(write_disposition) AS write_disposition, count(*) FILTER (status = 'SUCCESS') AS ok, count(*) FILTER (status <> 'SUCCESS') AS failed, CAST(coalesce(sum(row_count) FILTER (status = 'SUCCESS'), 0) AS BIGINT) AS rows, CASE WHEN bool_and(status <> 'SUCCESS') THEN 'SKIPPED' WHEN bool_or(status <> 'SUCCESS') THEN 'PARTIAL' ELSE 'LOADED' END AS load_status FROM log GROUP BY 1")
def a19(spark, d):
    return C.load_summary(run_log(spark, d))


def _pipeline_lines(spark, d):
    e, i = table(spark, d, "events"), F.col("event_id").cast("string")
    ts, t = F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.concat(F.lit("t"), (F.col("event_id") % 5).cast("string"))
    text = (
        F.when(F.col("event_id") % 4 == 0, F.concat(F.lit("[b1/"), t, F.lit("] 1,"), F.lpad((F.col("event_id") % 1000).cast("string"), 3, "0"), F.lit(" rows (attempt 1)")))
        .when(F.col("event_id") % 4 == 1, F.concat(F.lit("["), t, F.lit("] loaded: disp=merge ok=3 fail=0 rows="), i))
        .when(F.col("event_id") % 4 == 2, F.concat(F.lit("["), t, F.lit("] load failed: code "), i))
        .otherwise(F.lit("nothing of note"))
    )
    return e.select(F.concat(ts, F.lit(",123 | INFO | "), text).alias("line"))


@query("c7_pipeline_log", """SELECT CASE event_id % 4 WHEN 0 THEN 'unit' WHEN 1 THEN 'loaded' ELSE 'load_failed' END AS kind, 't' || (event_id % 5) AS "table", CASE event_id % 4 WHEN 0 THEN 1000 + event_id % 1000 WHEN 1 THEN event_id END AS rows, CASE event_id % 4 WHEN 1 THEN 'merge' WHEN 2 THEN 'code ' || event_id END AS detail FROM events WHERE event_id % 4 <> 3""")
def c7(spark, d):
    return L.parse_pipeline_log(_pipeline_lines(spark, d)).select("kind", "table", "rows", "detail")


@query("c8_dq_log", "SELECT 'orders' AS \"table\", 'b' || (event_id % 7) AS branch, event_id AS source_rows, CASE WHEN event_id % 3 <> 0 THEN event_id END AS matched, 'OK' AS status FROM events")
def c8(spark, d):
    i = F.col("event_id").cast("string")
    line = F.concat(F.lit("2026-01-01 00:00:00,000 | INFO | DQ-UNIT orders/b"), (F.col("event_id") % 7).cast("string"), F.lit(" | ora="), i, F.lit(" ice="), i, F.lit(" cnt=0 | match="), F.when(F.col("event_id") % 3 == 0, "-").otherwise(i), F.lit(" delta=0 pct=0.0 | OK"))
    return L.parse_dq_log(table(spark, d, "events").select(line.alias("line"))).select("table", "branch", "source_rows", "matched", "status")


@query("c9_generic_log", "SELECT 'counts' AS kind, event_id AS updated, CAST(2 AS BIGINT) AS inserted, NULL AS detail FROM events WHERE event_id % 2 = 0 UNION ALL SELECT 'issue', NULL, NULL, 'WARNING | slow ' || event_id FROM events WHERE event_id % 2 <> 0")
def c9(spark, d):
    i = F.col("event_id").cast("string")
    line = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("Updated : "), i, F.lit("  Inserted : 2  Deleted : 0"))).otherwise(F.concat(F.lit("2026-01-01 00:00:00,000 | WARNING | slow "), i))
    return L.parse_generic_log(table(spark, d, "events").select(line.alias("line"))).select("kind", "updated", "inserted", "detail")


@query("c9_classify_log", "SELECT user_id AS log, CASE user_id % 4 WHEN 0 THEN 'dq' WHEN 1 THEN 'pipeline' WHEN 2 THEN 'snapshot' ELSE 'generic' END AS log_kind FROM events GROUP BY user_id")
def c9k(spark, d):
    """A log per user: the command in its header decides, whatever its lines look like; one without a command goes by its lines."""
    e, kind = table(spark, d, "events"), F.col("user_id") % 4
    i = F.col("event_id").cast("string")
    progress = F.concat(F.lit("2026-01-01 00:00:00,000 | INFO | PROGRESS 0:00:01 | extract | tables 1/2 | extract 1/2 | rows="), i)
    body = e.select(F.col("user_id").alias("log"), F.when(kind == 3, F.concat(F.lit("DQ-UNIT a/b | x "), i)).otherwise(progress).alias("line"))
    head = F.when(kind == 0, "# command : python run_dq --all").when(kind == 2, "# command : python snapshots.py").when(kind == 3, "# command : fresh start")
    return L.classify_log(body.unionAll(e.where(kind != 1).select("user_id", head).distinct()), "log")


@query("c7_progress_lines", "SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS at, 'progress' AS kind, event_id AS rows, event_id % 50 AS ok, CASE WHEN event_id % 2 = 0 THEN 3 ELSE 0 END AS fail, 'load orders' AS detail, '0:01:02' AS elapsed, event_id % 7 AS tables_done, CAST(9 AS BIGINT) AS tables_total, CAST(60 AS BIGINT) AS units_total, '1.5 GB' AS memory, '2.0 GB' AS memory_peak, '12' AS buffers FROM events")
def c7p(spark, d):
    e, n = table(spark, d, "events"), lambda c: c.cast("string")
    i = F.col("event_id")
    failed = F.when(i % 2 == 0, " 3 failed").otherwise("")
    line = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(",123 | INFO | PROGRESS 0:01:02 | load orders | tables "), n(i % 7), F.lit("/9 | extract "), n(i % 50), F.lit("/60"), failed, F.lit(" | rows="), n(i), F.lit(" | rss=1.5 GB(peak 2.0 GB) arrow=12"))
    got = L.parse_pipeline_log(e.select(line.alias("line")))
    return got.select(F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at"), "kind", "rows", "ok", "fail", "detail", "elapsed", "tables_done", "tables_total", "units_total", "memory", "memory_peak", "buffers")


@query("c8_scope_and_progress", "SELECT 'scope' AS kind, 'r' || event_id AS run, 'b1,b2' AS branches, CAST(4 AS BIGINT) AS tables, 'last week' AS detail, 'md5' AS hashed, NULL AS done, NULL AS total, NULL AS ok, NULL AS tolerated, NULL AS mismatched, NULL AS failed, NULL AS elapsed, NULL AS level FROM events WHERE event_id % 3 = 0 UNION ALL SELECT 'progress', NULL, NULL, NULL, (event_id % 9) || '/9', NULL, event_id % 9, 9, event_id % 5, 1, 2, event_id % 3, '0:00:07', NULL FROM events WHERE event_id % 3 = 1 UNION ALL SELECT 'issue', NULL, NULL, NULL, 'ERROR | lost ' || event_id, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'error' FROM events WHERE event_id % 3 = 2")
def c8s(spark, d):
    e, n, i = table(spark, d, "events"), lambda c: c.cast("string"), F.col("event_id")
    scope = F.concat(F.lit("DQ run r"), n(i), F.lit(" | branches=['b1', 'b2'] | tables=4 | window=last week | hash=md5"))
    progress = F.concat(F.lit("DQ-PROGRESS 0:00:07 | units "), n(i % 9), F.lit("/9 | ok "), n(i % 5), F.lit(" tol 1 mismatch 2 err "), n(i % 3))
    line = F.when(i % 3 == 0, F.concat(F.lit("2026-01-01 00:00:00,000 | INFO | "), scope)).when(i % 3 == 1, F.concat(F.lit("2026-01-01 00:00:00,000 | INFO | "), progress)).otherwise(F.concat(F.lit("2026-01-01 00:00:00,000 | ERROR | lost "), n(i)))
    got = L.parse_dq_log(e.select(line.alias("line")))
    return got.select("kind", "run", F.concat_ws(",", F.when(F.size("branches") > 0, F.col("branches"))).alias("b"), "tables", "detail", "hashed", "done", "total", "ok", "tolerated", "mismatched", "failed", "elapsed", "level").withColumn("branches", F.nullif("b", F.lit(""))).drop("b")


# ---- profiling and models


@query("a12_key_profile", "SELECT 'o_orderkey' AS candidate, count(*) AS rows, count(DISTINCT o_orderkey) AS distinct_values, CAST(0 AS BIGINT) AS nulls, 'unique' AS verdict FROM orders UNION ALL SELECT 'o_orderstatus', count(*), count(DISTINCT o_orderstatus), 0, 'not unique' FROM orders UNION ALL SELECT 'customer and day', count(*), count(DISTINCT (o_custkey, o_orderdate)), 0, CASE WHEN count(*) = count(DISTINCT (o_custkey, o_orderdate)) THEN 'unique' ELSE 'not unique' END FROM orders")
def a12(spark, d):
    return P.key_profile(table(spark, d, "orders"), ["o_orderkey", "o_orderstatus"], {"customer and day": ["o_custkey", "o_orderdate"]})


@query("a13_year_distribution", "WITH y AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n FROM orders WHERE o_orderdate >= DATE '1997-01-01' GROUP BY 1) SELECT year, n, repeat('#', CAST(least(60, floor(n * 60 / (SELECT sum(n) FROM y))) AS INTEGER)) AS bar FROM y")
def a13(spark, d):
    o = table(spark, d, "orders").select(julian_day(F.col("o_orderdate")).alias("j"))
    return P.year_distribution(o, "j", 2450450)  # 1997-01-01


@query("a14_column_stats", "SELECT 'o_orderkey' AS \"column\", count(*) AS rows, count(DISTINCT o_orderkey) AS distinct_values, CAST(0 AS BIGINT) AS nulls, CAST(min(o_orderkey) AS VARCHAR) AS low, CAST(max(o_orderkey) AS VARCHAR) AS high, 1.0 / count(DISTINCT o_orderkey) AS density FROM orders UNION ALL SELECT 'o_orderstatus', count(*), count(DISTINCT o_orderstatus), 0, min(o_orderstatus), max(o_orderstatus), 1.0 / count(DISTINCT o_orderstatus) FROM orders")
def a14(spark, d):
    return P.column_stats(table(spark, d, "orders"), ["o_orderkey", "o_orderstatus"])


MODELS = [MO.Model("per_branch", "SELECT branch_id, count(*) AS n FROM {{ ref('branch_customers') }} GROUP BY branch_id"), MO.Model("branch_customers", "SELECT *, c_custkey % 7 AS branch_id FROM {{ ref('customer') }}", "view")]
TESTS = [MO.SqlTest("branch_set", "SELECT * FROM {{ ref('per_branch') }} WHERE branch_id IS NULL"), MO.SqlTest("no_small_branch", "SELECT * FROM {{ ref('per_branch') }} WHERE n > 0")]


def _sources(spark, d):
    table(spark, d, "customer").createOrReplaceTempView("customer")
    return {"customer"}


@query("x3_sql_model", "SELECT c_custkey % 7 AS branch_id, count(*) AS n FROM customer GROUP BY 1")
def x3(spark, d):
    return MO.run_models(spark, MODELS, _sources(spark, d), folder=fresh(spark, "models"))["per_branch"]


@query("x4_sql_test", "SELECT 'branch_set' AS test, CAST(0 AS BIGINT) AS failing_rows, true AS passed UNION ALL SELECT 'no_small_branch', count(DISTINCT c_custkey % 7), false FROM customer")
def x4(spark, d):
    known = _sources(spark, d) | set(MO.run_models(spark, MODELS, _sources(spark, d)))
    a, b = (MO.failing_rows(spark, t, known) for t in TESTS)
    return a.unionAll(b)


@query("x5_build", "SELECT * FROM (VALUES ('model', 'branch_customers', true), ('model', 'per_branch', true), ('test', 'branch_set', true), ('test', 'no_small_branch', false)) t(kind, name, passed)")
def x5(spark, d):
    return MO.build_models(spark, MODELS, TESTS, _sources(spark, d), folder=fresh(spark, "models"))
