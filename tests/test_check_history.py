from datetime import date, datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from branchlake.defs import HelperJoin, TableDef
from branchlake.operators import control as C
from branchlake.operators import explore as E
from branchlake.operators import history as H
from branchlake.operators import logs as L
from branchlake.operators import reconcile as R
from branchlake.plans import models as MO

TODAY = date(2026, 7, 19)
T_ = TableDef("t", ("id",), "transactions", date_column="day", cdc_column="day")


def _kh(spark, rows):
    df = spark.createDataFrame(rows, "id bigint, v string, branch_id bigint")
    return R.keyed_hashes(df, ["id"], ["v"])


def test_buckets(spark):
    got = R.compare(_kh(spark, [(1, "a", 1), (2, "b", 1), (3, "c", 1)]), _kh(spark, [(1, "a", 1), (2, "DIFF", 1), (4, "d", 1)])).first()
    assert (got["matched"], got["mismatch"], got["only_source"], got["only_lake"]) == (1, 1, 1, 1)
    lone = R.compare(_kh(spark, [(1, "x", 1)]), _kh(spark, [])).first()
    assert (lone["only_source"], lone["lake_rows"]) == (1, 0)


@settings(max_examples=8, deadline=None)
@given(s=st.dictionaries(st.integers(0, 8), st.sampled_from("ab"), max_size=6), k=st.dictionaries(st.integers(0, 8), st.sampled_from("ab"), max_size=6))
def test_partition_law(spark, s, k):
    got = R.compare(_kh(spark, [(i, v, 1) for i, v in s.items()]), _kh(spark, [(i, v, 1) for i, v in k.items()])).collect()
    if s or k:
        r = got[0]
        assert r["source_rows"] == r["matched"] + r["mismatch"] + r["only_source"] == len(s)


@pytest.mark.parametrize(
    ("count", "total", "source", "want", "pct"),
    [(0, 8, 1000, "WITHIN_TOLERANCE", 0.8), (0, 100, 1000, "WITHIN_TOLERANCE", 10.0), (0, 150, 1000, "MISMATCH", 15.0), (5, 0, 1000, "MISMATCH", 0.0), (0, 50, 0, "MISMATCH", None), (0, 0, 10, "OK", 0.0)],
)
def test_status(spark, count, total, source, want, pct):
    p = R.delta_pct(F.lit(total), F.lit(source))
    r = spark.range(1).select(p.alias("p"), R.classify(F.lit(count), F.lit(total), p).alias("s")).first()
    assert (r["p"], r["s"]) == (pct, want)


def test_windows():
    mark = {"last_date": {"value": "2026-06-01 00:00:00.000000", "kind": "datetime"}}
    w = R.make_window(T_, mark, date(2026, 1, 1), None, TODAY)
    assert (w.lower, w.upper, w.note) == (datetime(2026, 1, 1), datetime(2026, 6, 1), None)
    assert R.make_window(T_, mark, date(2026, 1, 1), date(2026, 2, 1), TODAY).upper == datetime(2026, 2, 1)
    assert "no-date-column" == R.make_window(TableDef("m"), None, TODAY, None, TODAY).note
    now = TableDef("t", date_column="day", date_max="TRUNC(SYSDATE)")
    assert R.make_window(now, None, date(2026, 1, 1), None, TODAY).upper == datetime(2026, 7, 19)
    odd = R.make_window(TableDef("t", date_column="day", date_max="some_expr"), None, date(2026, 1, 1), None, TODAY)
    assert (odd.upper, odd.source_upper) == (None, "some_expr")
    julian = TableDef("t", date_column="j", date_is_julian=True, date_max="2461000")
    assert R.make_window(julian, {"last_date": {"value": "2460000", "kind": "number"}}, date(2000, 1, 1), None, TODAY).lower == 2451545
    helper = TableDef("t", date_column="day", helper=HelperJoin("p", (), "c"))
    assert R.make_window(helper, mark, date(2026, 1, 1), None, TODAY).note == "helper/open"
    assert "mark-text/open" == R.make_window(T_, {"last_date": {"value": "x", "kind": "datetime"}}, date(2026, 1, 1), None, TODAY).note
    assert "mark-kind/open" == R.make_window(T_, {"last_date": {"value": "1", "kind": "number"}}, date(2026, 1, 1), None, TODAY).note


def test_reconcile_missing_sides_and_errors(spark):
    src = spark.createDataFrame([(1, "a", 1)], "ID bigint, v string, branch_id bigint")
    tdef, win, at = TableDef("t", ("ID",)), R.Window_(None), datetime(2026, 1, 1)
    r = R.reconcile(src, None, tdef, win, at, "r").first()
    assert (r["lake_row_count"], r["status"]) == (0, "MISMATCH")
    assert R.reconcile(None, src, tdef, win, at, "r").first()["status"] == "SKIPPED"
    bad = R.reconcile(src, src.drop("branch_id"), tdef, win, at, "r").first()
    assert bad["status"] == "ERROR" and bad["error_details"]
    assert len(R.reconcile(src, src, tdef, win, at, "r").columns) == 25


def test_opaque_ceiling_holds_on_the_source_only(spark):
    df = spark.sql("SELECT id, TIMESTAMP_NTZ '2026-01-01 00:00:00' + make_dt_interval(CAST(id AS INT)) AS day, 1L AS branch_id FROM range(10)")
    win = R.make_window(TableDef("t", date_column="day", date_max="timestamp_ntz '2026-01-03 00:00:00' + interval 0 days"), None, date(2026, 1, 2), None, TODAY)
    assert win.upper is None and win.note == "no-mark/ceiling"
    r = R.count_check(df, df, win).first()
    assert (r["source_rows"], r["lake_rows"]) == (2, 9)


def test_reconcile_isolates_a_failing_row_and_normalises_keys(spark):
    src = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "`Cust-Key` bigint, v string, branch_id bigint")
    tdef, at = TableDef("t", ("Cust-Key",)), datetime(2026, 1, 1)
    assert R.reconcile(src, src, tdef, R.Window_(None), at, "r").first()["status"] == "OK"
    broken = src.withColumn("v", F.when(F.col("Cust-Key") == 2, F.raise_error(F.lit("lost")).cast("string")).otherwise(F.col("v")))
    row = R.reconcile(broken, src, tdef, R.Window_(None), at, "r").first()
    assert row["status"] == "ERROR" and "lost" in row["error_details"]


def test_null_keys_meet(spark):
    old = spark.createDataFrame([(None, 1, "a"), (2, None, "b"), (3, 3, "c")], "id bigint, k bigint, v string")
    new = spark.createDataFrame([(None, 1, "a"), (2, None, "B"), (None, None, "n")], "id bigint, k bigint, v string")
    got = {(r["id"], r["k"], r["change"]) for r in H.diff_keys(old, new, ["id", "k"]).collect()}
    assert got == {(2, None, "updated"), (3, 3, "deleted"), (None, None, "inserted")}
    assert [(r["id"], r["old"], r["new"]) for r in H.field_changes(old, new, ["id", "k"]).collect()] == [(2, "b", "B")]
    assert H.collect_changed(old, H.diff_keys(old, new, ["id", "k"]).where("change = 'updated'"), ["id", "k"]).first()["v"] == "b"


def test_diff_decides_on_canonical_values(spark):
    old = spark.sql("SELECT 1L AS id, CAST(1.50 AS DECIMAL(8,2)) AS p, 'a' AS s UNION ALL SELECT 2L, CAST(3 AS DECIMAL(8,2)), 'b' UNION ALL SELECT 3L, NULL, 'c'")
    new = spark.sql("SELECT 1L AS id, CAST(1.5 AS DECIMAL(10,4)) AS p, 'a' AS s UNION ALL SELECT 2L, CAST(4 AS DECIMAL(10,4)), 'B' UNION ALL SELECT 4L, NULL, 'n'")
    assert tuple(H.snapshot_diff(old, new, ["id"]).first()) == (1, 1, 1)
    assert sorted((r["column"], r["old"]) for r in H.field_changes(old, new, ["id"]).collect()) == [("p", "3.00"), ("s", "b")]
    wide = H.wide_changes(old, new, ["id"]).first()
    assert wide["changes"] == 2 and wide["s"] == "b → B"


def test_control_round_trip(spark):
    cols = "table_name string, branch_id string, last_cdc_value string, last_cdc_kind string, last_date_value string, last_date_kind string"
    a = spark.createDataFrame([("c", "1", "100", "number", "5", "number")], cols)
    b = spark.createDataFrame([("c", "1", "200", "number", None, None), ("c", "2", "7", "number", None, None)], cols)
    got = {r["branch_id"]: (r["last_cdc_value"], r["last_date_value"]) for r in C.advance(a, b).collect()}
    assert got == {"1": ("200", "5"), "2": ("7", None)}
    assert C.advance(a, a.withColumn("last_cdc_value", F.lit("99"))).first()["last_cdc_value"] == "100"  # numbers as numbers
    assert C.upsert_control(a, b.drop("last_date_kind")).where("branch_id = '1'").first()["last_date_kind"] is None


def test_a_mark_keeps_its_kind(spark):
    cols = "table_name string, branch_id string, last_cdc_value string, last_cdc_kind string, last_date_value string, last_date_kind string"
    old = spark.createDataFrame([("c", "1", "2026-01-02", "datetime", "9", "number"), ("c", "2", "x", "string", None, None)], cols)
    new = spark.createDataFrame([("c", "1", "2026-01-01", "string", "10", "number"), ("c", "2", "5", "number", "7", "number")], cols)
    got = {r["branch_id"]: tuple(r)[2:] for r in C.advance(old, new).collect()}
    assert got == {"1": ("2026-01-02", "datetime", "10", "number"), "2": ("5", "number", "7", "number")}


def test_run_summary_tolerates_null_times(spark):
    log = spark.createDataFrame(
        [("r1", "a", "1", 100, "SUCCESS", "2026-01-01 06:00:00", "2026-01-01 06:05:00"), ("r1", "b", "1", 50, "FAILED", "2026-01-01 06:03:00", "2026-01-01 06:12:00"), ("r1", "b", "2", 25, "SUCCESS", None, None)],
        "pipeline_run_id string, table_name string, branch_id string, row_count bigint, status string, start_time string, end_time string",
    ).withColumns({"start_time": F.col("start_time").cast("timestamp_ntz"), "end_time": F.col("end_time").cast("timestamp_ntz"), "schema_discrepancy": F.lit(None).cast("string"), "error_details": F.lit(None).cast("string")})
    r = E.run_summary(log).first()
    assert (r["wall_ms"], r["rows"], r["units"], r["failed"], r["tables"]) == (720_000, 175, 3, 1, 2)


def test_logs(spark):
    lines = [
        "2026-01-01 00:00:00,123 | INFO | PROGRESS 0:01:02 | load:orders | tables 1/2 | extract 3/4 1 failed | rows=1,234 | rss=1 GB(peak 2 GB) arrow=3", "x [b1/orders] 1,000 rows (attempt 2)",
        "[b1/orders] connection error (x): lost", "[orders] no rows; load skipped (disp=merge ok=1 fail=0)", "[orders] skipped: none", "  orders SUCCESS disp=merge ok=1 fail=0 rows=5", "2026-01-01 00:00:00,123 | WARNING | odd", "chatter",
    ]
    got = L.parse_pipeline_log(spark.createDataFrame([(x,) for x in lines], "line string")).collect()
    assert [r["kind"] for r in got] == ["progress", "unit", "unit_error", "no_rows", "skipped", "summary", "issue"]
    assert got[0]["rows"] == 1234 and got[0]["fail"] == 1 and got[1]["rows"] == 1000 and got[6]["detail"].endswith("odd")
    assert (got[0]["elapsed"], got[0]["memory"], got[0]["memory_peak"], got[0]["tables_total"], got[0]["units_total"]) == ("0:01:02", "1 GB", "2 GB", 2, 4)
    assert got[1]["attempt"] == 2 and (got[2]["branch"], got[2]["table"], got[2]["detail"]) == ("b1", "orders", "lost") and got[6]["level"] == "warning"
    kinds = lambda *x: L.classify_log(spark.createDataFrame([(y,) for y in x], "line string")).first()[0]
    assert kinds("# command : python check_dq.py", "x PROGRESS 0:00:01") == "dq" and kinds("# command : other", "DQ-UNIT a/b") == "generic" and kinds("nothing") == "generic"
    one = L.classify_log(spark.createDataFrame([("Updated : 1  Inserted : 2  Deleted : 3",)], "line string")).first()[0]
    assert one == "snapshot"


def test_models_order_and_refuse(spark):
    a, b = MO.Model("a", "SELECT * FROM {{ ref('b') }}"), MO.Model("b", "SELECT 1 AS x")
    assert [m.name for m in MO.order([a, b])] == ["b", "a"]
    with pytest.raises(ValueError, match="circle"):
        MO.order([MO.Model("p", "{{ ref('q') }}"), MO.Model("q", "{{ ref('p') }}")])
    with pytest.raises(ValueError, match="unknown"):
        MO.resolve("{{ ref('zz') }}", {"a"})
    assert [tuple(r) for r in MO.build_models(spark, [a, b], [MO.SqlTest("t", "SELECT * FROM {{ ref('a') }} WHERE x <> 1")], set()).collect()] == [("model", "b", True), ("model", "a", True), ("test", "t", True)]
