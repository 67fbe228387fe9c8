from datetime import datetime, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from branchlake.defs import HelperJoin, TableDef
from branchlake.functions.keys import with_merge_hash
from branchlake.operators import merge as M
from branchlake.plans.load import load_table
from branchlake.sources import extract as X
from branchlake.sources.lake import Lake
from branchlake.sources.scratch import fresh

NOW = datetime(2026, 7, 19, 1, 2, 3)


def test_null_change_value_of_an_old_row_is_missed(spark):
    """Three-valued logic: an old row whose change column is null is neither new nor updated."""
    df = spark.createDataFrame([(1, None, "2020-01-01"), (2, 9, "2020-01-01"), (3, 9, None), (4, None, "2024-06-01")], "id bigint, cdc bigint, day string").withColumn("day", F.to_date("day"))
    tdef = TableDef("t", cdc_column="cdc", date_column="day", category="transactions")
    assert sorted(r["id"] for r in X.extract(df, tdef, "INCREMENTAL", "5", "2024-01-01").collect()) == [2, 3, 4]


def test_collision_rename_repeats_the_prefix(spark):
    src = spark.createDataFrame([(501, 1, 2)], "BRANCH_ID bigint, SRC_BRANCH_ID bigint, INSERT_AT bigint")
    out = X.inject_columns(src, 7, TableDef("t"), NOW)
    r = out.first().asDict()
    assert r["SRC_SRC_BRANCH_ID"] == 501 and r["SRC_BRANCH_ID"] == 1 and r["SRC_INSERT_AT"] == 2 and r["BRANCH_ID"] == 7


def test_snapshots_share_one_version(spark):
    tdef = TableDef("t", category="snapshots")
    a, b = (X.inject_columns(spark.createDataFrame([(1,)], "ID bigint"), i, tdef, NOW, NOW) for i in (11, 22))
    rows = a.unionByName(b).select("version", "version_date").distinct().collect()
    assert len(rows) == 1 and rows[0]["version_date"] == NOW.date()


def test_unknown_branch_is_an_error(spark):
    with pytest.raises(ValueError):
        X.select_branches(spark.range(1).withColumn("branch_id", F.lit(1)), [9], known=[1, 2])


def test_jdbc_source_and_disjoint_predicates(spark):
    url = "jdbc:derby:memory:shop;create=true"
    df = spark.range(10).select(F.col("id").cast("int").alias("ID"), (F.col("id") * 10).cast("int").alias("CDC"))
    driver = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    df.write.mode("overwrite").jdbc(url, "T", properties=driver)
    got = X.read_source(spark, TableDef("T"), {"format": "jdbc", "url": url, **driver})
    assert got.count() == 10
    named = X.read_source(spark, TableDef("(SELECT ID FROM T WHERE CDC > 50)", name="late"), {"format": "jdbc", "url": url, **driver})
    assert named.count() == 4
    both = X.read_incremental_jdbc(spark, url, "T", "ID >= 8", "ID < 8 AND CDC > 60", driver)
    assert both.rdd.getNumPartitions() == 2 and sorted(r["ID"] for r in both.collect()) == [7, 8, 9]


def _t(spark, rows):
    return spark.createDataFrame(rows, "id bigint, name string, branch_id bigint")


def test_upsert_and_insert_only(spark):
    target, delta = _t(spark, [(0, "seed", 1)]), _t(spark, [(i, "new", 1) for i in range(3)])
    assert sorted(map(tuple, M.merge(target, delta, ["id", "branch_id"]).collect())) == [(0, "new", 1), (1, "new", 1), (2, "new", 1)]
    assert sorted(map(tuple, M.merge(target, delta, ["id", "branch_id"], "insert-only").collect()))[0] == (0, "seed", 1)


def test_merge_refuses_what_it_cannot_do(spark):
    target, twice = _t(spark, [(0, "seed", 1)]), _t(spark, [(1, "a", 1), (1, "b", 1)])
    with pytest.raises(ValueError, match="strategy"):
        M.merge(target, target, ["id"], "delete")
    with pytest.raises(ValueError, match="duplicate"):
        M.merge(target, twice, ["id"])


@settings(max_examples=8, deadline=None)
@given(t=st.dictionaries(st.integers(0, 9), st.text(max_size=3), max_size=6), d=st.dictionaries(st.integers(0, 9), st.text(max_size=3), max_size=6))
def test_merge_is_idempotent(spark, t, d):
    target, delta = _t(spark, [(k, v, 1) for k, v in t.items()]), _t(spark, [(k, v, 1) for k, v in d.items()])
    once = M.merge_upsert(target, delta, ["id"])
    assert {r["id"]: r["name"] for r in M.merge_upsert(once, delta, ["id"]).collect()} == t | d
    assert once.count() == len(t | d)


def test_history_survives_by_hash(spark):
    old = with_merge_hash(_t(spark, [(1, "a", 1)]), ["id", "branch_id"]).withColumn("insert_at", F.lit("2020-01-01"))
    new = with_merge_hash(_t(spark, [(1, "b", 1), (2, "c", 1)]), ["id", "branch_id"]).withColumn("insert_at", F.lit("2026-07-19"))
    assert {r["id"]: r["insert_at"] for r in M.merge_with_history(old, new, ["id", "branch_id"]).collect()} == {1: "2020-01-01", 2: "2026-07-19"}


@pytest.mark.parametrize(
    ("tdef", "mode", "ok", "run", "all_", "want"),
    [
        (TableDef("t"), "INITIAL", 3, 3, 3, "replace"), (TableDef("t"), "INITIAL", 1, 1, 3, "merge"), (TableDef("t"), "INCREMENTAL", 3, 3, 3, "replace"), (TableDef("t", cdc_column="c"), "INCREMENTAL", 3, 3, 3, "merge"),
        (TableDef("t", helper=HelperJoin("p", (), "c")), "INCREMENTAL", 3, 3, 3, "merge"), (TableDef("t", category="snapshots"), "INITIAL", 1, 1, 3, "append"), (TableDef("t"), "INITIAL", 0, 3, 3, "skip"),
    ],
)
def test_disposition(tdef, mode, ok, run, all_, want):
    assert M.choose_disposition(tdef, mode, ok, run, all_) == want


def test_lake_lifecycle(spark):
    lake = Lake(spark, fresh(spark, "lake"))
    rows = _t(spark, [(i, "a", i % 3) for i in range(9)])
    lake.replace("t", rows, "r1", NOW)
    lake.merge("t", _t(spark, [(0, "b", 0), (99, "n", 0)]), ["id", "branch_id"], "r2", NOW)
    assert lake.read("t").count() == 10 and lake.read("t", snapshot_id=1).count() == 9
    assert lake.read("t", branches=[1]).count() == 3
    assert [r["commit_id"] for r in lake.snapshots("t").collect()] == [2, 1]
    two = {r["branch_id"]: r["commit_id"] for r in lake.files("t").collect()}
    assert two == {0: 2, 1: 1, 2: 1}  # untouched branches keep their files
    from branchlake.sources.lake import expire_to_latest, snapshot_pair

    with pytest.raises(ValueError, match="latest"):
        snapshot_pair(lake.snapshots("t"), "2026-07-19")
    with pytest.raises(ValueError, match="no snapshot"):
        snapshot_pair(lake.snapshots("t"), "2020-01-01")
    assert lake.keep_snapshots("t", expire_to_latest(lake.snapshots("t"))) == 1
    assert lake.sweep("t") == (0, 0, [])  # what is younger than a day may belong to a commit under way
    files, size, failed = lake.sweep("t", older_than=timedelta(0))
    assert files >= 1 and size > 0 and not failed and lake.read("t").count() == 10
    assert lake.sweep("t", older_than=timedelta(0)) == (0, 0, [])
    with pytest.raises(ValueError):
        lake.drop_table("etl_control")
    assert lake.drop_all() == ["t"] and lake.tables() == []


def test_load_initial_then_incremental(spark):
    lake = Lake(spark, fresh(spark, "lake"))
    tdef = TableDef("APP.ORDERS", ("ID",), "transactions", cdc_column="CDC")
    src = lambda rows: spark.createDataFrame(rows, "ID bigint, CDC bigint, V string")
    first = load_table(lake, tdef, {1: src([(1, 1, "a"), (2, 2, "b")]), 2: src([(1, 5, "x")]), 3: None}, "INITIAL", NOW, 3, "r1")
    assert (first.disposition, first.status, first.rows, first.failed) == ("replace", "PARTIAL", 3, [3])
    marks = {r["BRANCH_ID"]: (r["cdc_value"], None) for r in first.marks.collect()}
    assert marks == {1: ("2", None), 2: ("5", None)}
    later = datetime(2026, 7, 20)
    second = load_table(lake, tdef, {1: src([(1, 1, "a"), (2, 3, "b2"), (4, 4, "n")]), 2: src([(1, 5, "x")])}, "INCREMENTAL", later, 3, "r2", marks)
    assert (second.disposition, second.rows) == ("merge", 2)
    got = {(r["branch_id"], r["id"]): (r["v"], r["insert_at"]) for r in lake.read("orders").collect()}
    assert got == {(1, 1): ("a", NOW), (1, 2): ("b2", NOW), (1, 4): ("n", later), (2, 1): ("x", NOW)}
    empty = load_table(lake, tdef, {1: src([(1, 1, "a")])}, "INCREMENTAL", later, 3, "r3", {1: ("9", None)})
    assert (empty.status, empty.rows, lake.snapshots("orders").count()) == ("SUCCESS", 0, 2)


def test_stage_keeps_wider_batches(spark):
    from branchlake.functions.schema import unify_branches

    a = spark.sql("SELECT 1L AS id, CAST(9999 AS DECIMAL(4,0)) AS amt")
    b = spark.sql("SELECT 2L AS id, CAST(123456 AS DECIMAL(6,0)) AS amt")
    out = X.stage(unify_branches([a, b]), fresh(spark, "stage"))
    assert sorted(int(r["amt"]) for r in out.collect()) == [9999, 123456]


def test_overflow_is_an_error(spark):
    from pyspark.sql import types as T

    from branchlake.functions.schema import cast_to

    with pytest.raises(PySparkException):
        cast_to(spark.sql("SELECT CAST(123456 AS DECIMAL(6,0)) AS a"), T.StructType().add("a", "decimal(4,0)")).collect()


def test_stream_upsert(spark, tmp_path):
    from branchlake.streaming.upsert import merge_stream

    lake, src = Lake(spark, fresh(spark, "lake")), str(tmp_path / "in")
    lake.replace("t", _t(spark, [(1, "old", 1)]).withColumn("seq", F.lit(0)), "r1", NOW)
    spark.createDataFrame([(1, "a", 1, 1), (1, "b", 1, 2), (2, "c", 1, 1)], "id bigint, name string, branch_id bigint, seq int").write.parquet(src)
    changes = spark.readStream.schema("id bigint, name string, branch_id bigint, seq int").parquet(src)
    merge_stream(changes, lake, "t", ["id", "branch_id"], "seq", str(tmp_path / "cp")).awaitTermination()
    assert sorted((r["id"], r["name"]) for r in lake.read("t").collect()) == [(1, "b"), (2, "c")]


def test_a_second_stream_and_expired_snapshots(spark, tmp_path):
    """Batches of another stream count by themselves, and a replay is known after its snapshot has gone."""
    from branchlake.sources.lake import expire_to_latest
    from branchlake.streaming.upsert import merge_stream

    kind = "id bigint, name string, branch_id bigint, seq int"
    lake = Lake(spark, fresh(spark, "lake"))
    lake.replace("t", _t(spark, [(1, "old", 1)]).withColumn("seq", F.lit(0)), "r1", NOW)
    for i in (1, 2):
        spark.createDataFrame([(i, f"s{i}", 1, 1)], kind).write.parquet(f"{tmp_path}/in{i}")
        merge_stream(spark.readStream.schema(kind).parquet(f"{tmp_path}/in{i}"), lake, "t", ["id", "branch_id"], "seq", f"{tmp_path}/cp{i}").awaitTermination()
    assert sorted((r["id"], r["name"]) for r in lake.read("t").collect()) == [(1, "s1"), (2, "s2")]
    runs = [r["run_id"] for r in lake.snapshots("t").collect()]
    assert lake.keep_snapshots("t", expire_to_latest(lake.snapshots("t"))) == 2
    assert all(lake.seen("t", r) for r in runs) and not lake.seen("t", "stream-x-0")


def test_lake_tables_survive_change(spark):
    lake = Lake(spark, fresh(spark, "lake"))
    lake.replace("t", _t(spark, [(1, "a", 1), (2, "b", 2), (3, "n", None)]), "r1", NOW)
    assert lake.read("t", branches=[None]).first()["id"] == 3 and lake.read("t").count() == 3
    lake.merge("t", spark.createDataFrame([("x1", 5.5, 1)], "id string, name double, branch_id bigint"), ["id", "branch_id"], "r2", NOW)
    assert {(r["id"], r["name"], r["branch_id"]) for r in lake.read("t").collect()} == {("1", "a", 1), ("x1", "5.5", 1), ("2", "b", 2), ("3", "n", None)}
    lake.append("t", spark.createDataFrame([("y", 2, True)], "id string, branch_id bigint, flag boolean"), "r3", NOW)
    assert {(r["id"], r["name"], r["flag"]) for r in lake.read("t", branches=[2]).collect()} == {("2", "b", None), ("y", None, True)}
    assert lake.read("t", snapshot_id=1).schema["id"].dataType.simpleString() == "bigint"
    with pytest.raises(ValueError, match="duplicate"):
        lake.merge("t", _t(spark, [(7, "p", 1), (7, "q", 1)]), ["id", "branch_id"])
    assert lake.read("t").count() == 5
    lake.replace("t", _t(spark, []), "r4", NOW)
    assert lake.read("t").count() == 0 and lake.snapshots("t").first()["total_records"] == 0
    lake.append("t", _t(spark, [(9, "z", 1)]), "r5", NOW)
    assert [tuple(r) for r in lake.read("t").select("id", "name", "branch_id").collect()] == [(9, "z", 1)]


def test_a_row_that_arrives_during_a_load_comes_with_the_next(spark, monkeypatch):
    from branchlake.plans import load

    url, driver = "jdbc:derby:memory:moving;create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    put = lambda i, cdc, mode: spark.createDataFrame([(i, cdc)], "ID int, CDC int").write.mode(mode).jdbc(url, "T", properties=driver)
    put(1, 10, "overwrite")
    tdef, lake = TableDef("T", ("ID",), "transactions", cdc_column="CDC"), Lake(spark, fresh(spark, "lake"))
    source = lambda: {1: X.read_source(spark, tdef, {"format": "jdbc", "url": url, **driver})}
    stage, arrived = load.stage, []

    def moving(df, path):
        out = stage(df, path)
        if not arrived:
            arrived.append(1)
            put(2, 99, "append")
        return out

    monkeypatch.setattr(load, "stage", moving)
    first = load.run_table(lake, tdef, source(), "INITIAL", NOW, 1, "r1")
    assert first.rows == 1 and lake.read("etl_control").first()["last_cdc_value"] == "10"
    second = load.run_table(lake, tdef, source(), "INCREMENTAL", NOW, 1, "r2")
    assert second.rows == 1 and sorted(r["id"] for r in lake.read("t").collect()) == [1, 2] and lake.read("etl_control").first()["last_cdc_value"] == "99"


def test_a_load_that_fails_is_recorded_and_advances_nothing(spark):
    from branchlake.plans.load import run_table

    lake, tdef = Lake(spark, fresh(spark, "lake")), TableDef("T", ("ID",), "transactions", cdc_column="CDC")
    src = lambda rows: spark.createDataFrame(rows, "ID bigint, CDC bigint")
    run_table(lake, tdef, {1: src([(1, 5)]), 2: None}, "INITIAL", NOW, 2, "r1")
    bad = run_table(lake, tdef, {1: src([(2, 9), (2, 9)]), 2: src([(3, 7)])}, "INCREMENTAL", NOW, 2, "r2")
    assert bad.status == "FAILED" and lake.read("t").count() == 1
    log = {(r["pipeline_run_id"], r["branch_id"]): (r["status"], r["load_status"], r["row_count"]) for r in lake.read("etl_run_log").collect()}
    assert log == {("r1", 1): ("SUCCESS", "LOADED", 1), ("r1", 2): ("FAILED", "LOADED", 0), ("r2", 1): ("SUCCESS", "FAILED", 0), ("r2", 2): ("SUCCESS", "FAILED", 0)}
    marks = {r["branch_id"]: (r["status"], r["last_cdc_value"]) for r in lake.read("etl_control").collect()}
    assert marks == {1: ("FAILED", "5"), 2: ("FAILED", None)}


def test_a_helper_driven_load(spark):
    from branchlake.plans.load import run_table

    helper = HelperJoin("p", (("PID", "ID"),), "CDC", None)
    lake, tdef = Lake(spark, fresh(spark, "lake")), TableDef("C", ("ID",), "transactions", helper=helper)
    child = spark.createDataFrame([(1, 10), (2, 20)], "ID bigint, PID bigint")
    parent = lambda cdc: spark.createDataFrame([(10, 1), (20, cdc)], "ID bigint, CDC bigint")
    assert run_table(lake, tdef, {1: child}, "INITIAL", NOW, 1, "r1", {1: parent(2)}).rows == 2
    assert run_table(lake, tdef, {1: child}, "INCREMENTAL", NOW, 1, "r2", {1: parent(7)}).rows == 1
    assert "etl_helper_cdc" not in lake.read("c").columns and lake.read("etl_control").first()["last_cdc_value"] == "7"
