"""Queries on sources, extraction, keys, schemas and merges."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from branchlake.defs import HelperJoin, TableDef
from branchlake.functions import keys as K
from branchlake.functions import schema as S
from branchlake.operators import merge as M
from branchlake.plans.load import run_table
from branchlake.plans.tables import DELTA, DRIFTED, SRC, drifted, orders_delta, query, source_orders, table
from branchlake.sources import extract as X
from branchlake.sources.lake import Lake
from branchlake.sources.scratch import fresh

NOW = datetime(2026, 1, 2, 3, 4, 5)
ORDERS = TableDef("ORDERS", ("o_orderkey",), "transactions", cdc_column="o_orderdate", date_column="o_orderdate", date_value="1997-01-01", date_max="2000-12-31")
COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority", "branch_id"]
_COLS = ", ".join(COLS)


@query("s1_read_source", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders")
def s1(spark, d):
    return X.read_source(spark, TableDef("APP.orders", ("o_orderkey",)), {"path": d}).drop("o_orderdate")


@query("s2_query_source", "SELECT o_orderkey, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderdate >= DATE '1997-01-01' AND o_orderdate <= DATE '2000-12-31'")
def s2(spark, d):
    table(spark, d, "orders").createOrReplaceTempView("src_orders")
    table(spark, d, "customer").createOrReplaceTempView("src_customer")
    tdef = TableDef("(SELECT o.o_orderkey, c.c_name, c.c_mktsegment, o.o_orderdate FROM src_orders o JOIN src_customer c ON o.o_custkey = c.c_custkey)", ("o_orderkey",), "transactions", name="orders_named", date_column="o_orderdate", date_value="1997-01-01", date_max="2000-12-31")
    return X.initial_filter(X.read_source(spark, tdef, {}), tdef).drop("o_orderdate")


@query("s5_stage", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def s5(spark, d):
    return X.stage(table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment"), fresh(spark, "stage"))


@query("s6_read_staged", "SELECT c_custkey, c_mktsegment, CASE WHEN c_custkey % 2 = 0 THEN c_name END AS c_name FROM customer")
def s6(spark, d):
    c, paths = table(spark, d, "customer"), [fresh(spark, "staged") for _ in range(2)]
    X.stage(c.where("c_custkey % 2 = 0").select("c_custkey", "c_name", "c_mktsegment"), paths[0])
    X.stage(c.where("c_custkey % 2 <> 0").select("c_custkey", "c_mktsegment", "c_nationkey"), paths[1])
    return X.read_staged(spark, paths, ["C_CUSTKEY", "C_NAME", "C_MKTSEGMENT"]).toDF("c_custkey", "c_name", "c_mktsegment")


def _lake(spark, d):
    lake = Lake(spark, fresh(spark, "lake"))
    lake.replace("orders", source_orders(spark, d).select(*COLS), "r1", NOW)
    return lake


@query("s7_lake_scan", f"WITH {SRC} SELECT o_orderkey, o_totalprice, branch_id FROM src WHERE branch_id IN (1, 3)")
def s7(spark, d):
    return _lake(spark, d).read("orders", snapshot_id=1, branches=[1, 3], columns=["o_orderkey", "o_totalprice", "branch_id"])


@query("s8_lake_replace", f"WITH {SRC}, {DRIFTED} SELECT {_COLS} FROM lake")
def s8(spark, d):
    lake = _lake(spark, d)
    lake.replace("orders", drifted(source_orders(spark, d)).select(*COLS), "r2", NOW)
    return lake.read("orders").select(*COLS)


@query("s9_lake_append", f"WITH {SRC} SELECT {_COLS} FROM src UNION ALL SELECT {_COLS} FROM src WHERE branch_id < 3")
def s9(spark, d):
    lake = _lake(spark, d)
    lake.append("orders", source_orders(spark, d).where("branch_id < 3").select(*COLS), "r2", NOW)
    return lake.read("orders").select(*COLS)


_MERGED = f"WITH {SRC}, {DELTA} SELECT {_COLS} FROM src WHERE o_orderkey NOT IN (SELECT o_orderkey FROM delta) UNION ALL SELECT {_COLS} FROM delta"


@query("s10_lake_merge", _MERGED)
def s10(spark, d):
    lake = _lake(spark, d)
    lake.merge("orders", orders_delta(source_orders(spark, d)).select(*COLS), ["o_orderkey", "branch_id"], "r2", NOW)
    return lake.read("orders").select(*COLS)


@query("s10_widening_merge", f"WITH {SRC} SELECT o_orderkey, CASE WHEN branch_id IN (1, 2) AND o_orderkey % 50 = 0 THEN 'c' || o_custkey ELSE CAST(o_custkey AS VARCHAR) END AS o_custkey, branch_id FROM src")
def s10w(spark, d):
    """A merge whose column has become text, into two branches of seven: the other five keep their folders and read as text too."""
    lake = _lake(spark, d)
    some = source_orders(spark, d).where("branch_id IN (1, 2) AND o_orderkey % 50 = 0").select(*COLS).withColumn("o_custkey", F.concat(F.lit("c"), F.col("o_custkey").cast("string")))
    lake.merge("orders", some, ["o_orderkey", "branch_id"], "r2", NOW)
    return lake.read("orders").select("o_orderkey", "o_custkey", "branch_id")


@query("s9_append_without_column", f"WITH {SRC} SELECT o_orderkey, o_orderstatus, NULL AS note, branch_id FROM src UNION ALL SELECT o_orderkey + 30000000, NULL, 'late', branch_id FROM src WHERE branch_id = 3")
def s9w(spark, d):
    """Rows appended without a stored column, and with one of their own: both columns stay."""
    lake = _lake(spark, d)
    late = source_orders(spark, d).where("branch_id = 3").select((F.col("o_orderkey") + 30_000_000).alias("o_orderkey"), F.lit("late").alias("note"), "branch_id")
    lake.append("orders", late, "r2", NOW)
    return lake.read("orders").select("o_orderkey", "o_orderstatus", "note", "branch_id")


@query("s8_empty_replace", f"WITH {SRC} SELECT count(*) AS before, CAST(0 AS BIGINT) AS now, CAST(2 AS BIGINT) AS snapshots FROM src")
def s8e(spark, d):
    """Replacing by no rows leaves an empty table, and its former snapshot as it was."""
    lake = _lake(spark, d)
    lake.replace("orders", source_orders(spark, d).select(*COLS).where("o_orderkey < 0"), "r2", NOW)
    count = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    return count(lake.read("orders", 1), "before").crossJoin(count(lake.read("orders"), "now")).crossJoin(count(lake.snapshots("orders"), "snapshots"))  # single rows


@query("m8_recorded_load", f"WITH {SRC}, h AS (SELECT max(o_orderkey) // 2 AS half FROM src), r AS (SELECT 'r1' AS pipeline_run_id, branch_id, count(*) AS row_count FROM src, h WHERE o_orderkey <= half GROUP BY ALL UNION ALL SELECT 'r2', branch_id, count(*) FROM src, h WHERE o_orderkey > half GROUP BY ALL) SELECT pipeline_run_id, branch_id, row_count, CASE pipeline_run_id WHEN 'r1' THEN 'replace' ELSE 'merge' END AS write_disposition, (SELECT CAST(max(o_orderkey) AS VARCHAR) FROM src s WHERE s.branch_id = r.branch_id) AS mark, (SELECT count(*) FROM src s WHERE s.branch_id = r.branch_id) AS stored FROM r")
def m8(spark, d):
    """Two runs that record themselves: the second starts from the marks of the first and takes exactly the rows that came after it."""
    lake, src = Lake(spark, fresh(spark, "lake")), source_orders(spark, d)
    tdef = TableDef("APP.ORDERS", ("o_orderkey",), "transactions", cdc_column="o_orderkey")
    half = src.agg(F.max("o_orderkey").alias("m")).first()["m"] // 2
    for run, mode, seen in (("r1", "INITIAL", src.where(F.col("o_orderkey") <= half)), ("r2", "INCREMENTAL", src)):
        run_table(lake, tdef, {b: seen.where(F.col("branch_id") == b).drop("branch_id") for b in range(7)}, mode, NOW, 7, run)
    marks = lake.read("etl_control").select("branch_id", F.col("last_cdc_value").alias("mark"))
    rows = lake.read("orders").groupBy("branch_id").agg(F.count(F.lit(1)).alias("stored"))
    return lake.read("etl_run_log").select("pipeline_run_id", "branch_id", "row_count", "write_disposition").join(marks, "branch_id").join(rows, "branch_id")


@query("m9_partition_scoping", "SELECT CAST(2 AS BIGINT) AS commits, count(*) FILTER (b NOT IN (1, 2)) AS branches_kept, count(*) FILTER (b IN (1, 2)) AS branches_rewritten FROM (SELECT DISTINCT o_orderkey % 7 AS b FROM orders)")
def m9(spark, d):
    lake = _lake(spark, d)
    lake.merge("orders", orders_delta(source_orders(spark, d)).where("branch_id IN (1, 2)").select(*COLS), ["o_orderkey", "branch_id"], "r2", NOW)
    commits = lake.snapshots("orders").agg(F.count(F.lit(1)).alias("commits"))
    branches = lake.files("orders").groupBy("branch_id").agg(F.max("commit_id").alias("last"))
    return commits.join(branches.agg(F.count_if(F.col("last") == 1).alias("branches_kept"), F.count_if(F.col("last") == 2).alias("branches_rewritten")))  # single rows


@query("p1_initial_filter", "SELECT o_orderkey FROM orders WHERE o_orderdate >= DATE '1997-01-01' AND o_orderdate <= DATE '2000-12-31'")
def p1(spark, d):
    return X.initial_filter(table(spark, d, "orders"), ORDERS).select("o_orderkey")


@query("p2_date_ceiling", "SELECT o_orderkey FROM orders WHERE o_orderdate < DATE '1999-01-01'")
def p2(spark, d):
    return X.initial_filter(table(spark, d, "orders"), TableDef("orders", date_column="o_orderdate", date_max="1999-01-01", date_max_operator="<")).select("o_orderkey")


EVENTS = TableDef("events", ("event_id",), "transactions", cdc_column="event_id", date_column="day", date_value="2024-01-01", date_max="2024-01-25")


def _events(spark, d):
    day = F.when(F.col("event_id") % 11 != 0, F.to_date("ts"))
    return table(spark, d, "events").select("event_id", "event_type", day.alias("day"))


_EV = "ev AS (SELECT event_id, event_type, CASE WHEN event_id % 11 <> 0 THEN CAST(ts AS DATE) END AS day FROM events)"


@query("p4_incremental_filter", f"WITH {_EV} SELECT event_id, event_type FROM ev WHERE (day >= DATE '2024-01-20' AND day <= DATE '2024-01-25') OR (event_id > 500 AND (day < DATE '2024-01-20' OR day IS NULL))")
def p4(spark, d):
    return X.extract(_events(spark, d), EVENTS, "INCREMENTAL", "500", "2024-01-20").select("event_id", "event_type")


@query("p5_incremental_cdc_only", f"WITH {_EV} SELECT event_id, event_type FROM ev WHERE event_id > 500")
def p5(spark, d):
    return X.extract(_events(spark, d), EVENTS, "INCREMENTAL", "500", None).select("event_id", "event_type")


@query("p6_incremental_fallback", f"WITH {_EV} SELECT event_id, event_type FROM ev WHERE day >= DATE '2024-01-01' AND day <= DATE '2024-01-25'")
def p6(spark, d):
    return X.extract(_events(spark, d), EVENTS, "INCREMENTAL", None, "2024-01-20").select("event_id", "event_type")


@query("p7_snapshot_extract", f"WITH {_EV} SELECT event_id, event_type FROM ev")
def p7(spark, d):
    return X.extract(_events(spark, d), TableDef("events", category="snapshots", date_column="day", date_max="2024-01-05"), "INCREMENTAL", "500").select("event_id", "event_type")


@query("p8_derived_key", 'SELECT l_orderkey, l_linenumber, l_orderkey || \'-\' || l_linenumber AS "DERIVED_KEY" FROM lineitem')
def p8(spark, d):
    return X.with_derived_key(table(spark, d, "lineitem"), TableDef("lineitem", derived_key="concat(l_orderkey, '-', l_linenumber)")).select("l_orderkey", "l_linenumber", "DERIVED_KEY")


HELPER = HelperJoin("orders", (("l_orderkey", "o_orderkey"),), "o_orderdate", "o_orderdate")
LINES = TableDef("lineitem", ("l_orderkey", "l_linenumber"), "transactions", helper=HELPER, date_value="1999-06-01")


@query("j1_helper_join", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderdate >= DATE '1999-06-01'")
def j1(spark, d):
    joined = X.helper_join(table(spark, d, "lineitem"), table(spark, d, "orders"), HELPER)
    return X.extract(joined, LINES).select("l_orderkey", "l_linenumber", "l_quantity")


@query("p9_helper_columns", "SELECT l_orderkey, l_linenumber, strftime(o_orderdate, '%Y-%m-%d') AS borrowed FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderdate > DATE '2000-01-01'")
def p9(spark, d):
    joined = X.helper_join(table(spark, d, "lineitem"), table(spark, d, "orders"), HELPER)
    marked = X.extract(joined, LINES, "INCREMENTAL", "2000-01-01")
    return marked.select("l_orderkey", "l_linenumber", F.date_format("ETL_HELPER_CDC", "yyyy-MM-dd").alias("borrowed"))


@query("p10_strip_reserved", "SELECT l_orderkey, l_linenumber FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def p10(spark, d):
    joined = X.helper_join(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber"), table(spark, d, "orders"), HELPER)
    return S.strip_reserved(joined)


@query("p11_inject_columns", "SELECT c_custkey, CAST(c_custkey % 7 AS BIGINT) AS branch, '2026-01-02 03:04:05' AS inserted, '2026-01-02 03:04:05' AS updated, '2026-01-02 03:04:05' AS version, '2026-01-02' AS version_date FROM customer")
def p11(spark, d):
    out = X.inject_columns(table(spark, d, "customer"), F.col("c_custkey") % 7, TableDef("customer", category="snapshots"), NOW, NOW)
    text = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    return out.select("c_custkey", F.col("BRANCH_ID").alias("branch"), text("insert_at").alias("inserted"), text("Recorded_updated_at").alias("updated"), text("version").alias("version"), F.date_format("version_date", "yyyy-MM-dd").alias("version_date"))


@query("p12_collision_rename", "SELECT c_custkey, CAST(c_custkey + 500 AS BIGINT) AS kept, CAST(3 AS BIGINT) AS branch FROM customer")
def p12(spark, d):
    src = table(spark, d, "customer").select("c_custkey", (F.col("c_custkey") + 500).alias("Branch_Id"))
    out = X.inject_columns(src, 3, TableDef("customer"), NOW)
    return out.select("c_custkey", F.col("SRC_Branch_Id").alias("kept"), F.col("BRANCH_ID").alias("branch"))


@query("p14_branch_selection", f"WITH {SRC} SELECT o_orderkey, branch_id FROM src WHERE branch_id IN (2, 5)")
def p14(spark, d):
    return X.select_branches(source_orders(spark, d), [2, 5], known=list(range(7))).select("o_orderkey", "branch_id")


@query("p16_normalize_columns", 'SELECT c_custkey AS cust_key, c_name AS cust_name FROM customer')
def p16(spark, d):
    return S.normalize_columns(table(spark, d, "customer").select(F.col("c_custkey").alias("Cust-Key "), F.col("c_name").alias("_CUST  name_")))


@query("p17_business_columns", "SELECT c_custkey, c_name FROM customer")
def p17(spark, d):
    src = X.inject_columns(table(spark, d, "customer").select("c_custkey", "c_name"), 1, TableDef("customer"), NOW).withColumn("_dlt_id", F.lit("x"))
    return src.select(*S.business_columns(src))


@query("a1_watermarks", f"WITH {SRC} SELECT branch_id, strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S.%f') AS cdc_value, 'datetime' AS cdc_kind, strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S.%f') AS date_value, 'datetime' AS date_kind FROM src GROUP BY branch_id")
def a1(spark, d):
    return X.capture_watermarks(source_orders(spark, d), ORDERS)


@query("a15_matching_rows", f"WITH {_EV} SELECT count(*) AS matching_rows FROM ev WHERE (day >= DATE '2024-01-20' AND day <= DATE '2024-01-25') OR (event_id > 500 AND (day < DATE '2024-01-20' OR day IS NULL))")
def a15(spark, d):
    from branchlake.operators.profile import matching_rows

    return matching_rows(X.extract(_events(spark, d), EVENTS, "INCREMENTAL", "500", "2024-01-20"))


@query("u1_new_and_updated", f"WITH {_EV} SELECT event_id, 'new' AS part FROM ev WHERE day >= DATE '2024-01-20' AND day <= DATE '2024-01-25' UNION ALL SELECT event_id, 'updated' FROM ev WHERE event_id > 500 AND (day < DATE '2024-01-20' OR day IS NULL)")
def u1(spark, d):
    ev = _events(spark, d)
    new, updated = X.new_and_updated(EVENTS, F.lit(500), S.literal("2024-01-20"))
    part = lambda c, n: ev.where(c).select("event_id", F.lit(n).alias("part"))
    return part(new, "new").unionAll(part(updated, "updated"))


def _branches(spark, d):
    """The seven branches, dealt over three schemas."""
    o = table(spark, d, "orders")
    pick = lambda b: o.where(F.col("o_orderkey") % 7 == b)
    kinds = [
        lambda p: p.select("o_orderkey", F.col("o_totalprice").cast("decimal(18,2)").alias("price"), "o_orderstatus"),
        lambda p: p.select("o_orderkey", F.col("o_totalprice").cast("decimal(18,4)").alias("price"), F.lit("x").alias("extra_flag")),
        lambda p: p.select(F.col("o_orderkey").cast("string").alias("o_orderkey"), F.col("o_totalprice").cast("decimal(18,0)").alias("price"), "o_orderstatus"),
    ]
    return [kinds[b % 3](pick(b)) for b in range(7)]


_UNIFIED = """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(CASE WHEN o_orderkey % 7 % 3 = 2 THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DECIMAL(18,0)) ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS DECIMAL(22,4)) AS price,
CASE WHEN o_orderkey % 7 % 3 <> 1 THEN o_orderstatus END AS o_orderstatus, CASE WHEN o_orderkey % 7 % 3 = 1 THEN 'x' END AS extra_flag FROM orders"""


@query("u2_unify_branches", _UNIFIED)
def u2(spark, d):
    return S.unify_branches(_branches(spark, d))


@query("m7_rebuild", _UNIFIED + " WHERE o_orderkey % 7 <> 1")
def m7(spark, d):
    return M.rebuild([part for b, part in enumerate(_branches(spark, d)) if b != 1])  # branch 1 failed


@query("t8_batch_drift", "SELECT p_partkey, CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS DECIMAL(20,4)) AS price FROM part")
def t8(spark, d):
    p = table(spark, d, "part")
    early = p.where("p_partkey % 2 = 0").select("p_partkey", F.col("p_retailprice").cast("decimal(18,2)").alias("price"))
    late = p.where("p_partkey % 2 <> 0").select("p_partkey", F.col("p_retailprice").cast("decimal(18,4)").alias("price"))
    return X.stage(S.unify_branches([early, late]), fresh(spark, "drift"))


def _filled(df, name="filled"):
    """(column, rows that have a value) of every column."""
    one = df.agg(*[F.count(c).alias(c) for c in df.columns])
    return one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias(name)) for c in df.columns])).alias("x")).select("x.*")


@query("u3_column_drift", "SELECT c.\"column\", side, filled FROM (VALUES ('c_acctbal', 'both'), ('c_custkey', 'both'), ('c_mktsegment', 'source_only'), ('c_name', 'both'), ('c_nationkey', 'both'), ('c_region', 'lake_only')) c(\"column\", side) LEFT JOIN (UNPIVOT (SELECT count(c_acctbal) AS c_acctbal, count(c_custkey) AS c_custkey, count(c_mktsegment) AS c_mktsegment, count(c_name) AS c_name, count(c_nationkey) AS c_nationkey FROM customer) ON * INTO NAME \"column\" VALUE filled) u ON c.\"column\" = u.\"column\"")
def u3(spark, d):
    c = table(spark, d, "customer")
    return S.column_drift(c, c.columns, c.withColumn("C_REGION", F.lit(1)).drop("c_mktsegment").columns).join(_filled(c), "column", "left")


@query("t3_cast_to", "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DECIMAL(20,4)) AS c_acctbal, CAST(NULL AS VARCHAR) AS note FROM customer")
def t3(spark, d):
    src = table(spark, d, "customer").withColumn("c_acctbal", F.col("c_acctbal").cast("decimal(18,2)"))
    return S.cast_to(src, T.StructType().add("c_custkey", "string").add("c_acctbal", "decimal(20,4)").add("note", "string"))


@query("t4_schema_drift", """WITH r AS (SELECT o_orderkey % 7 AS b, count(*) AS rows FROM orders GROUP BY 1) SELECT CAST(b AS VARCHAR) AS branch, kind, "column", detail, rows FROM r JOIN (VALUES
(0, 'missing', 'extra_flag', NULL), (0, 'widened', 'o_orderkey', 'bigint -> string'), (0, 'widened', 'price', 'decimal(18,2) -> decimal(22,4)'), (1, 'missing', 'o_orderstatus', NULL), (1, 'widened', 'o_orderkey', 'bigint -> string'),
(1, 'widened', 'price', 'decimal(18,4) -> decimal(22,4)'), (2, 'missing', 'extra_flag', NULL), (2, 'widened', 'price', 'decimal(18,0) -> decimal(22,4)')) v(k, kind, "column", detail) ON b % 3 = k""")
def t4(spark, d):
    parts = _branches(spark, d)
    rows = M.rebuild([b.select(F.lit(str(i)).alias("branch")) for i, b in enumerate(parts)]).groupBy("branch").agg(F.count(F.lit(1)).alias("rows"))
    return S.drift_report(table(spark, d, "orders"), {str(i): b.schema for i, b in enumerate(parts)}).join(rows, "branch", "left")


@query("t6_widen_to_destination", "SELECT CAST(p_partkey AS DECIMAL(20,2)) AS p_partkey, CAST(p_size AS VARCHAR) AS p_size FROM part")
def t6(spark, d):
    src = table(spark, d, "part").select("p_partkey", "p_size")
    stored = T.StructType().add("p_partkey", "decimal(10,2)").add("p_size", "string").add("gone", "string")
    return S.cast_to(src, S.widen_to_destination(src.schema, stored))


@query("t7_schema_evolution", f"WITH {SRC}, {DELTA} SELECT o_orderkey, NULL AS note FROM src WHERE o_orderkey NOT IN (SELECT o_orderkey FROM delta) UNION ALL SELECT o_orderkey, 'new' FROM delta")
def t7(spark, d):
    src = source_orders(spark, d).select("o_orderkey")
    return M.merge_upsert(src, orders_delta(source_orders(spark, d)).select("o_orderkey", F.lit("new").alias("note")), ["o_orderkey"])


@query("t10_nested_types", "SELECT 'vec_id' AS \"column\", 'bigint' AS type, count(vec_id) AS filled FROM embeddings UNION ALL SELECT 'embedding', 'array<float>', count(embedding) FROM embeddings UNION ALL SELECT 'label', 'int', count(label) FROM embeddings")
def t10(spark, d):
    e = table(spark, d, "embeddings")
    kinds = spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in e.schema.fields], "column string, type string")
    return kinds.join(_filled(e), "column")


_PRICE = "regexp_replace(regexp_replace(CAST(CAST(o_totalprice AS DECIMAL(18,4)) AS VARCHAR), '(\\.[0-9]*?)0+$', '\\1'), '\\.$', '')"


@query("f1_canonical_text", f"SELECT o_orderkey, {_PRICE} AS price, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS at, CASE WHEN o_orderkey % 13 = 0 THEN chr(0) || chr(0) || 'NULL' ELSE o_orderstatus END AS status FROM orders".replace("chr(0) || chr(0) || 'NULL'", "'<null>'"))
def f1(spark, d):
    o = table(spark, d, "orders").withColumns({"o_totalprice": F.col("o_totalprice").cast("decimal(18,4)"), "o_orderstatus": F.when(F.col("o_orderkey") % 13 != 0, F.col("o_orderstatus"))})
    c = lambda n: K.canon(F.col(n), o.schema[n].dataType)
    status = F.when(c("o_orderstatus") == K.NULL, "<null>").otherwise(c("o_orderstatus"))
    return o.select("o_orderkey", c("o_totalprice").alias("price"), c("o_orderdate").alias("at"), status.alias("status"))


_FP = f"concat_ws(chr(31), CAST(o_orderkey AS VARCHAR), {_PRICE}, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), o_orderstatus)"


@query("f2_fingerprint", f"SELECT o_orderkey, {_FP} AS fp FROM orders")
def f2(spark, d):
    s = source_orders(spark, d)
    return s.select("o_orderkey", K.fingerprint(s, ["o_orderkey", "o_totalprice", "o_orderdate", "o_orderstatus"]).alias("fp"))


@query("f3_row_hash", f"SELECT o_orderkey, upper(md5({_FP})) AS h FROM orders")
def f3(spark, d):
    s = source_orders(spark, d)
    return s.select("o_orderkey", F.hex(K.row_hash(s, ["o_orderkey", "o_totalprice", "o_orderdate", "o_orderstatus"])).alias("h"))


_SER = "'00' || lpad(upper(to_hex(strlen(CAST(c_custkey AS VARCHAR)))), 8, '0') || hex(encode(CAST(c_custkey AS VARCHAR))) || CASE WHEN c_custkey % 5 = 0 THEN '01' ELSE '00' || lpad(upper(to_hex(strlen(c_name))), 8, '0') || hex(encode(c_name)) END"


def _keyed(spark, d):
    return table(spark, d, "customer").withColumn("c_name", F.when(F.col("c_custkey") % 5 != 0, F.col("c_name")))


@query("f4_serialize_keys", f"SELECT c_custkey, {_SER} AS s FROM customer")
def f4(spark, d):
    c = _keyed(spark, d)
    return c.select("c_custkey", F.hex(K.serialize_keys(c, ["c_custkey", "c_name"])).alias("s"))


@query("f5_merge_hash", f"SELECT c_custkey, upper(md5(unhex({_SER}))) AS h FROM customer")
def f5(spark, d):
    c = _keyed(spark, d)
    return K.with_merge_hash(c, ["c_custkey", "c_name"]).select("c_custkey", F.hex("merge_hash").alias("h"))


@query("f7_stabilize_keys", f"SELECT CAST(o_orderkey AS VARCHAR) AS k, {_PRICE} AS price FROM orders")
def f7(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").cast("double").alias("k"), F.col("o_totalprice").cast("decimal(18,4)").alias("price"))
    return K.stabilize_keys(o, ["k", "price"]).select(F.col("k").cast("string").alias("k"), "price")


@query("f8_canonical_decimal", f"SELECT o_orderkey, {_PRICE} AS price FROM orders")
def f8(spark, d):
    return table(spark, d, "orders").select("o_orderkey", K.canon_decimal(F.col("o_totalprice").cast("decimal(18,4)")).alias("price"))


@query("f9_julian", "SELECT o_orderkey, CAST(julian(CAST(o_orderdate AS DATE)) AS INTEGER) AS j, strftime(o_orderdate, '%Y-%m-%d') AS back FROM orders")
def f9(spark, d):
    j = K.julian_day(F.col("o_orderdate"))
    return table(spark, d, "orders").select("o_orderkey", j.alias("j"), F.date_format(K.from_julian(j), "yyyy-MM-dd").alias("back"))


@query("f10_naive_utc", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS at FROM events")
def f10(spark, d):
    return table(spark, d, "events").select("event_id", F.date_format(K.naive_utc(_zoned()), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("at"))


def _zoned():
    """The time of an event as an instant, whatever the session's zone."""
    return F.concat(F.col("ts").cast("string"), F.lit("Z")).cast("timestamp")


@query("f1_zoned_times", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS zoned, strftime(ts, '%Y-%m-%d %H:%M:%S') AS naive FROM events")
def f1z(spark, d):
    e = table(spark, d, "events").select("event_id", _zoned().alias("z"), "ts")
    return e.select("event_id", K.canon(F.col("z"), e.schema["z"].dataType).alias("zoned"), K.canon(F.col("ts"), e.schema["ts"].dataType).alias("naive"))


@query("f11_safe_cast", "SELECT event_id, CAST(props AS VARCHAR) AS kept, event_id AS number FROM events")
def f11(spark, d):
    e = table(spark, d, "events").select("event_id", F.col("props").alias("kept"), F.col("event_id").cast("string").alias("number"))
    return K.safe_cast(K.safe_cast(e, "kept", "bigint"), "number", "bigint")


@query("f12_display", "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN '' WHEN event_id % 3 = 1 THEN CAST(event_id AS VARCHAR) ELSE event_id || '.5' END AS shown FROM events")
def f12(spark, d):
    e = table(spark, d, "events").select("event_id", F.when(F.col("event_id") % 3 == 1, F.col("event_id").cast("double")).when(F.col("event_id") % 3 == 2, F.col("event_id") + 0.5).cast("double").alias("v"))
    return e.select("event_id", K.fmt(F.col("v"), e.schema["v"].dataType).alias("shown"))


@query("m1_upsert", _MERGED)
def m1(spark, d):
    s = source_orders(spark, d).select(*COLS)
    return M.merge(s, orders_delta(source_orders(spark, d)).select(*COLS), ["o_orderkey"])


@query("m2_insert_only", f"WITH {SRC}, {DELTA} SELECT {_COLS} FROM src UNION ALL SELECT {_COLS} FROM delta WHERE o_orderkey NOT IN (SELECT o_orderkey FROM src)")
def m2(spark, d):
    s = source_orders(spark, d).select(*COLS)
    return M.merge(s, orders_delta(source_orders(spark, d)).select(*COLS), ["o_orderkey"], "insert-only")


def _dated(df, day):
    return df.select("o_orderkey", "o_totalprice", F.lit(day).alias("insert_at"))


@query("m5_merge_with_history", f"WITH {SRC}, {DELTA} SELECT o_orderkey, o_totalprice, '2020-01-01' AS insert_at FROM src WHERE o_orderkey NOT IN (SELECT o_orderkey FROM delta) UNION ALL SELECT o_orderkey, o_totalprice, CASE WHEN o_orderkey IN (SELECT o_orderkey FROM src) THEN '2020-01-01' ELSE '2026-01-01' END FROM delta")
def m5(spark, d):
    s = source_orders(spark, d)
    return M.merge_with_history(_dated(s, "2020-01-01"), _dated(orders_delta(s), "2026-01-01"), ["o_orderkey"])


@query("j4_carry_forward", f"WITH {SRC}, {DELTA} SELECT o_orderkey, o_totalprice, CASE WHEN o_orderkey IN (SELECT o_orderkey FROM src) THEN '2020-01-01' ELSE '2026-01-01' END AS insert_at FROM delta")
def j4(spark, d):
    s = source_orders(spark, d)
    return M.carry_forward(_dated(orders_delta(s), "2026-01-01"), _dated(s, "2020-01-01"), ["o_orderkey"])


@query("j7_split_delta", f"WITH {SRC}, {DELTA} SELECT CASE WHEN o_orderkey IN (SELECT o_orderkey FROM src) THEN 'matched' ELSE 'new' END AS part, count(*) AS n FROM delta GROUP BY 1")
def j7(spark, d):
    s = source_orders(spark, d)
    hit, new = M.split_delta(s, orders_delta(s), ["o_orderkey"])
    return hit.select(F.lit("matched").alias("part")).unionAll(new.select(F.lit("new"))).groupBy("part").agg(F.count(F.lit(1)).alias("n"))


@query("m10_changed_rows", f"WITH {SRC}, {DRIFTED} SELECT lake.o_orderkey, lake.o_totalprice FROM lake JOIN src USING (o_orderkey) WHERE lake.o_totalprice <> src.o_totalprice")
def m10(spark, d):
    s = source_orders(spark, d)
    return M.changed_rows(s, drifted(s), ["o_orderkey"]).select("o_orderkey", "o_totalprice")


@query("m11_merge_impact", "SELECT CAST(2 * count(*) AS BIGINT) AS delta_rows, count(*) AS matched, count(*) AS changed, count(*) AS inserts, false AS duplicate_keys, true AS some_rewritten FROM orders WHERE o_orderkey % 50 = 0")
def m11(spark, d):
    s = table(spark, d, "orders")
    some = s.where("o_orderkey % 50 = 0").withColumn("o_totalprice", F.col("o_totalprice") + 5)
    out = M.merge_impact(s, some.unionByName(some.withColumn("o_orderkey", F.col("o_orderkey") + 20_000_000)), ["o_orderkey"])
    rewritten = F.col("files_rewritten").between(1, F.col("files")) & (F.col("bytes_rewritten") > 0) & (F.col("bytes_rewritten") <= F.col("bytes"))
    return out.select("delta_rows", "matched", "changed", "inserts", "duplicate_keys", rewritten.alias("some_rewritten"))


@query("m12_sample_delta", "SELECT o_orderkey, CAST(o_custkey + CASE WHEN r <= 50 THEN 1 ELSE 0 END AS BIGINT) AS o_custkey FROM (SELECT *, row_number() OVER (ORDER BY md5(o_orderkey || '|s1'), o_orderkey) AS r FROM orders) WHERE r <= 100")
def m12(spark, d):
    return M.sample_delta(table(spark, d, "orders"), ["o_orderkey"], 100, 0.5, "s1").select("o_orderkey", "o_custkey")


@query("w6_cluster_by_hash", f"WITH {SRC} SELECT o_orderkey, branch_id FROM src")
def w6(spark, d):
    return M.cluster_by_hash(K.with_merge_hash(source_orders(spark, d), ["o_orderkey"])).select("o_orderkey", "branch_id")


@query("w7_dedupe_delta", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey) AS r FROM lineitem) WHERE r = 1")
def w7(spark, d):
    return M.dedupe_delta(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey"]).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query("a16_collision_check", "SELECT count(DISTINCT o_orderkey) AS distinct_keys, count(DISTINCT o_orderkey) AS distinct_hashes FROM orders")
def a16(spark, d):
    return M.collision_check(K.with_merge_hash(table(spark, d, "orders"), ["o_orderkey"]), ["o_orderkey"])
