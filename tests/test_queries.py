"""Every registered query with SQL against DuckDB on the small tables."""

import math
from decimal import Decimal

import duckdb
import pytest

from branchlake.plans import queries

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return c


def plain(v):
    if isinstance(v, Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_against_sql(spark, sf, con, name):
    df = queries.QUERIES[name](spark, sf)
    found = con.execute(queries.ORACLE_SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.columns, df.collect()) == rows_of(names, found.fetchall())


@pytest.mark.parametrize("name", ["j8_run_detail", "p15_sample_rows"])
def test_more_than_a_thousand_rows(spark, tmp_path, name):
    """1500 log rows of one run, and as many events of one branch and day."""
    c = duckdb.connect()
    c.execute(f"COPY (SELECT 7 * i + 2 AS event_id, TIMESTAMP '2024-01-10 00:00:00' + i * INTERVAL 1 SECOND AS ts, 3 AS user_id, CASE WHEN i % 9 = 0 THEN 'error' ELSE 'view' END AS event_type, 0.5 AS value, NULL::VARCHAR AS props FROM range(1, 1651) t(i)) TO '{tmp_path}/events.parquet'")
    c.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{tmp_path}/events.parquet')")
    df = queries.QUERIES[name](spark, str(tmp_path))
    found = c.execute(queries.ORACLE_SQL[name])
    names, want = [d[0] for d in found.description], found.fetchall()
    assert len(want) >= 1500 and rows_of(df.columns, df.collect()) == rows_of(names, want)


def test_every_query_has_sql():
    assert set(queries.QUERIES) == set(queries.ORACLE_SQL)


def test_drift_of_all_branches(spark, sf):
    got = queries.QUERIES["t4_schema_drift"](spark, sf).select("branch", "rows").distinct().collect()
    assert sorted(r["branch"] for r in got) == [str(b) for b in range(7)]
    assert sum(r["rows"] for r in got) == spark.read.parquet(f"{sf}/orders.parquet").count()


def test_retention_without_a_global_window(spark):
    from datetime import datetime

    from branchlake.sources import lake

    rows = [(i, datetime(2024, 1, 1 + i % 5)) for i in range(40)] + [(50, None)]
    commits = spark.createDataFrame(rows, "commit_id bigint, committed_at timestamp_ntz")
    for days, least in ((1, 3), (4, 0), (0, 60), (2, 10)):
        out = lake.retain(commits, days, least, "2024-01-05 00:00:00")
        newest = {i for i, _ in sorted(rows, key=lambda r: (r[1] or datetime.min, r[0]), reverse=True)[: max(1, least)]}
        assert {r["commit_id"]: bool(r["keep"]) for r in out.collect()} == {i: i in newest or bool(at and (datetime(2024, 1, 5) - at).days <= days) for i, at in rows}
        assert out.columns == ["commit_id", "committed_at", "keep"] and "Window" not in out._jdf.queryExecution().executedPlan().toString()


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 7
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_pruning_and_pushdown(spark, sf):
    """A pruned scan reads two columns and gets the filter."""
    from branchlake.plans.q_load import p1

    plan = p1(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan and "GreaterThanOrEqual(o_orderdate" in plan
