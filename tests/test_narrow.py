"""What is read and shuffled: ranges of JDBC sources, digests before rows, hashes before values, one pass for profiles; and stored models."""

import random
import re
from collections import Counter, defaultdict
from datetime import date, datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from branchlake.defs import TableDef
from branchlake.functions import keys as K
from branchlake.operators import history as H
from branchlake.operators import merge as M
from branchlake.operators import profile as P
from branchlake.operators import reconcile as R
from branchlake.plans import models as MO
from branchlake.sources import extract as X
from branchlake.sources.scratch import fresh

DRIVER = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ---- JDBC
@pytest.fixture(scope="module")
def crowded(spark):
    """5 000 rows, most of them on few values: numbers, days, times and nulls."""
    url = "jdbc:derby:memory:crowded;create=true"
    rng = random.Random(7)
    rows = [(i, None if i % 50 == 0 else rng.choice([1, 1, 1, 2, rng.randint(3, 100_000)]), date(2020, 1, 1 + rng.choice([0, 0, 0, rng.randint(0, 27)])), datetime(2024, 1, 1, rng.randint(0, 23), rng.randint(0, 59), 1, 500_000), rng.random() * 10) for i in range(5000)]
    spark.createDataFrame(rows, "ID int, K int, D date, T timestamp_ntz, X double").write.mode("overwrite").jdbc(url, "CROWDED", properties=DRIVER)
    return url, rows


@pytest.mark.parametrize(("column", "i", "rows"), [("K", 1, 300), ("D", 2, 400), ("T", 3, 700), ("ID", 0, 999), ("X", 4, 1000), ("K", 1, 10_000)])
def test_ranges_are_disjoint_and_add_up(spark, crowded, column, i, rows):
    url, data = crowded
    found = X.split_ranges(X._jdbc(spark, {"url": url, **DRIVER}), "CROWDED", column, rows)
    df = spark.read.jdbc(url, "CROWDED", predicates=found, properties=DRIVER)
    assert sorted(r["ID"] for r in df.select("ID").collect()) == list(range(5000))
    sizes = [r["n"] for r in df.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    single = max(Counter(r[i] for r in data if r[i] is not None).values())
    nulls = sum(r[i] is None for r in data)
    assert len(sizes) == len(found) and max(sizes) <= max(rows, single, nulls) and len(found) <= 4 * (5000 // rows + 2)
    if rows < 5000:
        assert len(found) > 2


def test_a_source_is_read_in_ranges(spark, crowded):
    url, data = crowded
    tdef = TableDef("CROWDED", ("ID",), "transactions", date_column="D")
    whole = X.read_source(spark, tdef, {"format": "jdbc", "url": url, **DRIVER})
    split = X.read_source(spark, tdef, {"format": "jdbc", "url": url, **DRIVER, "split_column": "ID", "split_rows": 1000})
    assert whole.rdd.getNumPartitions() == 1 and split.rdd.getNumPartitions() >= 5
    assert sorted(map(tuple, whole.select("ID", "K").collect()), key=repr) == sorted(map(tuple, split.select("ID", "K").collect()), key=repr)
    some = X.read_source(spark, tdef, {"format": "jdbc", "url": url, **DRIVER, "split_column": "ID", "split_rows": 300, "where": "K = 1"})
    assert some.count() == sum(r[1] == 1 for r in data) and some.rdd.getNumPartitions() > 3
    query = X.read_source(spark, TableDef("(SELECT ID, K FROM CROWDED WHERE K > 2)", ("ID",), name="q"), {"format": "jdbc", "url": url, **DRIVER, "split_column": "K", "split_rows": 200})
    assert query.count() == sum((r[1] or 0) > 2 for r in data) and query.rdd.getNumPartitions() > 2


def test_both_parts_of_an_increment_are_split(spark, crowded):
    url, data = crowded
    new, updated = "D >= {d '2020-01-10'}", "K > 2 AND D < {d '2020-01-10'}"
    both = X.read_incremental_jdbc(spark, url, "CROWDED", new, updated, DRIVER, "ID", 400)
    want = [r[0] for r in data if r[2] >= date(2020, 1, 10) or (r[1] or 0) > 2]
    assert sorted(r["ID"] for r in both.collect()) == sorted(want) and both.rdd.getNumPartitions() > 4
    none = X.read_incremental_jdbc(spark, url, "CROWDED", "ID < 0", "ID > 9999", DRIVER, "ID", 400)
    assert none.count() == 0


# ---- reconciliation
def _kh(spark, rows):
    return R.keyed_hashes(spark.createDataFrame(rows, "id bigint, v string, branch_id bigint"), ["id"], ["v"])


def _counts(source, lake):
    out = {}
    h = lambda rows: {(b, i): [min((K_(v) for j, v, c in rows if (c, j) == (b, i))), sum((c, j) == (b, i) for j, _, c in rows)] for i, _, b in rows}
    import hashlib

    K_ = lambda v: hashlib.md5(("\x00\x00NULL" if v is None else v).encode()).digest()
    s, k = h(source), h(lake)
    for b, i in s.keys() | k.keys():
        row = out.setdefault(b, Counter())
        x, y = s.get((b, i)), k.get((b, i))
        row.update(source_rows=x[1] if x else 0, lake_rows=y[1] if y else 0, source_hashed=bool(x), lake_hashed=bool(y), only_source=not y, only_lake=not x)
        row.update(matched=bool(x and y and x[0] == y[0]), mismatch=bool(x and y and x[0] != y[0]))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_two_levels_give_what_one_gives(spark, seed):
    """Repeated keys, null branches and null keys, more and fewer buckets than keys, equal and unequal sides."""
    rng = random.Random(seed)
    rows = lambda n: [(rng.choice([None, *range(40)]), rng.choice("abc"), rng.choice([None, 1, 2])) for _ in range(n)]
    source = rows(60)
    lake = source[:] if seed == 0 else source[:40] + rows(20) if seed < 3 else []
    want = {b: dict(c) for b, c in _counts(source, lake).items()}
    for buckets in (1, 7, 4096):
        got = {r["branch_id"]: r for r in R.compare(_kh(spark, source), _kh(spark, lake), buckets).collect()}
        assert {b: {c: r[c] for c in want[b]} for b, r in got.items()} == {b: {c: int(n) for c, n in w.items()} for b, w in want.items()}


def test_equal_rows_of_a_null_branch_match(spark):
    kh = _kh(spark, [(1, "a", None), (2, "b", None)])
    r = R.compare(kh, kh).first()
    assert (r["branch_id"], r["matched"], r["only_source"], r["only_lake"]) == (None, 2, 0, 0)


def test_a_clean_table_shuffles_no_rows(spark, monkeypatch):
    rows = [(i, f"v{i}", i % 3) for i in range(500)]
    kh = _kh(spark, rows)
    monkeypatch.setattr(R, "_rows_apart", lambda *_: 1 / 0)
    clean = R.compare(kh, kh, 64, unique_keys=True)
    assert {r["branch_id"]: (r["matched"], r["source_rows"], r["lake_hashed"]) for r in clean.collect()} == {b: (n, n, n) for b, n in Counter(i % 3 for i in range(500)).items()}
    monkeypatch.undo()
    other = _kh(spark, [(i, "x" if i == 7 else v, b) for i, v, b in rows])
    near = R.compare(kh, other, 64, unique_keys=True)
    assert {r["branch_id"]: (r["matched"], r["mismatch"]) for r in near.collect()} == {0: (167, 0), 1: (166, 1), 2: (166, 0)}
    digests = R.bucket_digests(kh, other, 64)
    partial = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan(digests))
    assert partial and all("bucket" in p and "k#" not in p for p in partial)


def test_systimestamp_is_now():
    win = R.make_window(TableDef("t", date_column="day", date_max="SYSTIMESTAMP"), None, date(2026, 1, 1), None, date(2026, 7, 19))
    assert (win.upper, win.source_upper) == (datetime(2026, 7, 19), None)


# ---- diffs
def test_no_value_is_shuffled_before_its_key_is_known_to_differ(spark, tmp_path):
    old = spark.range(1000).select(F.col("id"), (F.col("id") % 7).alias("v"), F.concat(F.lit("long value "), F.col("id").cast("string")).alias("wide"))
    old.write.parquet(f"{tmp_path}/old")
    old.withColumn("v", F.when(F.col("id") == 5, 99).otherwise(F.col("v"))).write.parquet(f"{tmp_path}/new")
    a, b = spark.read.parquet(f"{tmp_path}/old"), spark.read.parquet(f"{tmp_path}/new")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        pairs = H.changed_pairs(a, b, ["id"])
        text = plan(pairs)
        # both sides meet the broadcast keys before any exchange
        assert text.count("BroadcastHashJoin") == 2 and text.count("LeftSemi") == 2
        assert [(r["id"], r["old_v"], r["new_v"]) for r in pairs.collect()] == [(5, 5, 99)]
        narrow = plan(H.snapshot_diff(a, b, ["id"]))
        for line in narrow.splitlines():
            if "Exchange hash" in line:
                assert "wide" not in line and "__k" in line
        assert re.search(r"Project \[coalesce\(unhex\(md5", narrow) and "isnotnull" not in narrow
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_more_changed_keys_than_are_broadcast(spark, monkeypatch):
    monkeypatch.setattr(H, "BROADCAST_KEYS", 2)
    a = spark.range(20).select("id", F.col("id").alias("v"))
    b = a.withColumn("v", F.when(F.col("id") < 6, -1).otherwise(F.col("v")))
    assert sorted(r["id"] for r in H.field_changes(a, b, ["id"]).collect()) == list(range(6))


def test_latest_change_of_rows_with_maps(spark):
    df = spark.sql("SELECT 1 AS id, 2 AS at, map('a', 1) AS m UNION ALL SELECT 1, 1, map('b', 2) UNION ALL SELECT 2, 5, NULL")
    assert sorted((r["id"], r["at"]) for r in M.dedupe_delta(df, ["id"], ["at"]).collect()) == [(1, 1), (2, 5)]


# ---- profiles
def test_profiles_take_one_pass(spark, tmp_path):
    rows = [(i, None if i % 9 == 0 else i % 5, f"s{i % 4}", i / 4) for i in range(90)]
    spark.createDataFrame(rows, "a bigint, b int, c string, x double").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    keys = P.key_profile(df, ["a", "b"], {"b+c": ["b", "c"]})
    assert plan(keys).count("FileScan parquet") == 1
    want = {"a": (90, 90, 0, "unique"), "b": (90, 5, 10, "has nulls"), "b+c": (90, 20, 10, "has nulls")}
    assert {r["candidate"]: (r["rows"], r["distinct_values"], r["nulls"], r["verdict"]) for r in keys.collect()} == want
    stats = P.column_stats(df, ["a", "b", "c", "x"])
    assert plan(stats).count("FileScan parquet") == 1
    assert {r["column"]: (r["rows"], r["distinct_values"], r["nulls"], r["low"], r["high"]) for r in stats.collect()} == {"a": (90, 90, 0, "0", "89"), "b": (90, 5, 10, "0", "4"), "c": (90, 4, 0, "s0", "s3"), "x": (90, 90, 0, "0.0", "22.25")}
    assert {r["candidate"]: r["rows"] for r in P.key_profile(df.limit(0), ["a"], {}).collect()} == {"a": 0}


def test_columns_that_sort_unlike_their_text(spark):
    df = spark.sql("SELECT * FROM VALUES (9, DATE'0999-01-01', 1.50BD, TIMESTAMP_NTZ'2024-01-01 00:00:00.25', true), (10, DATE'2020-01-01', 10.00BD, NULL, false), (-3, NULL, 9.99BD, NULL, NULL) AS t(i, d, p, t, b)")
    got = {r["column"]: (r["low"], r["high"], r["distinct_values"], r["nulls"]) for r in P.column_stats(df, ["i", "d", "p", "t", "b"]).collect()}
    assert got["i"] == ("-3", "10", 3, 0) and got["d"] == ("0999-01-01", "2020-01-01", 2, 1) and got["p"] == ("1.50", "10.00", 3, 0)
    assert got["t"] == ("2024-01-01 00:00:00.25",) * 2 + (1, 2) and got["b"] == ("false", "true", 2, 1)


# ---- lossless casts
@pytest.mark.parametrize(
    ("texts", "kind", "want"),
    [
        (["007", "010"], "date", "string"), (["007", "010"], "bigint", "bigint"), (["7", "10"], "date", "bigint"), (["0.12345678901234"], "date", "double"), (["1.50"], "bigint", "string"),
        (["0.123456789012345678901"], "date", "string"), (["1.5", "x"], "bigint", "string"), (["2026-01-02", None], "bigint", "date"), (["2026-01-02 03:04:05"], "bigint", "timestamp_ntz"), (["+7"], "date", "string"),
    ],
)
def test_inferred_types_lose_nothing(spark, texts, kind, want):
    df = K.safe_cast(spark.createDataFrame([(t,) for t in texts], "v string"), "v", kind)
    assert df.schema["v"].dataType.simpleString() == want
    if want == "string" or kind != want:
        assert [r["v"] for r in df.select(F.col("v").cast("string")).collect()] == texts or want.startswith("decimal")


# ---- models
def test_models_on_stored_parents_and_failing_rebuilds(spark):
    folder, good = fresh(spark, "models"), MO.Model("stored_a", "SELECT 1 AS x")
    child = MO.Model("stored_b", "SELECT x + 1 AS y FROM {{ ref('stored_a') }}")
    with pytest.raises(ValueError, match="stored_a has not been built"):
        MO.run_models(spark, [good, child], set(), {"stored_b"}, folder)
    MO.run_models(spark, [good, child], set(), {"stored_a"}, folder)
    spark.catalog.dropTempView("stored_a")
    assert MO.run_models(spark, [good, child], set(), {"stored_b"}, folder)["stored_b"].first()["y"] == 2
    reader = MO.Stored(spark, folder).read("stored_a")
    with pytest.raises(PySparkException):
        MO.run_models(spark, [MO.Model("stored_a", "SELECT raise_error('broken') AS x")], set(), folder=folder)
    assert MO.Stored(spark, folder).read("stored_a").first()["x"] == 1
    MO.run_models(spark, [MO.Model("stored_a", "SELECT 5 AS x")], set(), folder=folder)
    assert MO.Stored(spark, folder).read("stored_a").first()["x"] == 5 and reader.first()["x"] == 1  # who has opened the table before still reads it
    MO.run_models(spark, [MO.Model("stored_a", "SELECT 6 AS x")], set(), folder=folder)
    assert len(MO.Stored(spark, folder)._entries("stored_a")) == 2
