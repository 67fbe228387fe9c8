"""Reading sources and deciding which of their rows a run takes."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from branchlake.defs import BRANCH, DERIVED_KEY, HELPER_CDC, HELPER_DATE, INJECTED, INSERTED, UPDATED, VERSION, VERSION_DATE, HelperJoin, TableDef
from branchlake.functions.schema import literal

FETCH = 50_000
#: rows of a range that one connection reads, and how often ranges with more are cut again
SPLIT_ROWS, ROUNDS = 1_000_000, 6
_COMPARE = {"<": Column.__lt__, "<=": Column.__le__, ">": Column.__gt__, ">=": Column.__ge__, "=": Column.__eq__}


def read_source(spark: SparkSession, tdef: TableDef, branch: dict) -> DataFrame:
    """A physical table or a query of one branch. ``branch``: format jdbc with its options, or parquet with the folder ``path``; in Parquet branches a query
    runs over views that the caller has registered.

    A JDBC branch with ``split_column`` (and ``split_rows``) is read in as many disjoint ranges of that column as its rows ask for; ``where`` bounds what is read, as SQL of the source.
    """
    if branch.get("format", "parquet") == "jdbc":
        options = {k: str(v) for k, v in branch.items() if k not in ("format", "path", "split_column", "split_rows", "where")} | {k: str(v) for k, v in tdef.options.items()}
        table = f"{tdef.table} t" if tdef.is_query else tdef.table
        wheres = [branch.get("where") or "1 = 1"]
        if branch.get("split_column"):
            reader = _jdbc(spark, options)
            wheres = [r for w in wheres for r in split_ranges(reader, table, branch["split_column"], int(branch.get("split_rows", SPLIT_ROWS)), w)]
        elif not branch.get("where"):
            return _jdbc(spark, options)(table)
        properties = {k: v for k, v in options.items() if k != "url"}
        return spark.read.jdbc(options["url"], table, predicates=wheres, properties={"fetchsize": str(FETCH)} | properties)
    if tdef.is_query:
        return spark.sql(tdef.table.strip()[1:-1])
    return spark.read.parquet(f"{branch['path']}/{tdef.table.rsplit('.', 1)[-1]}.parquet")


def _jdbc(spark: SparkSession, options: dict) -> Callable[[str], DataFrame]:
    return lambda table: spark.read.format("jdbc").option("fetchsize", FETCH).options(**options).option("dbtable", table).load()


def read_incremental_jdbc(
    spark: SparkSession, url: str, table: str, new: str, updated: str, properties: dict, split_column: str | None = None, split_rows: int = SPLIT_ROWS
) -> DataFrame:
    """New rows and updated old rows as disjoint source predicates, so that either can use its own index; each is split further by ranges of ``split_column``, where there is one."""
    predicates = [new, updated]
    if split_column:
        reader = _jdbc(spark, {"url": url} | properties)
        predicates = [r for p in predicates for r in split_ranges(reader, table, split_column, split_rows, p)]
    return spark.read.jdbc(url, table, predicates=predicates, properties={"fetchsize": str(FETCH)} | properties)


def split_ranges(reader: Callable[[str], DataFrame], table: str, column: str, rows: int, where: str = "1 = 1") -> list[str]:
    """Disjoint predicates that together are ``where``, with about ``rows`` rows each: ranges of a number or time column, and its nulls.

    The source tells the smallest and the largest value and the counts. Ranges of equal width that hold too many rows are cut again as wide as their share asks for, up to ``ROUNDS`` times, which follows a
    crowded stretch of the column down to single values. All ranges of a round are counted in one query, so a large table is looked through a few times by an index on the column, and never sorted.
    """
    def ask(select: str, more: str = "1 = 1"):
        return reader(f"(SELECT {select} FROM {table} WHERE ({where}) AND ({more})) bounds").first()

    low, high, known, every = ask(f"MIN({column}) AS lo, MAX({column}) AS hi, COUNT({column}) AS n, COUNT(*) AS m")
    nulls = [f"({where}) AND {column} IS NULL"] if every > known else []
    if not known:
        return nulls or [where]
    done, todo = [], [(low, None, int(known))]  # half open; the last one has no end
    for _ in range(ROUNDS):
        cut = [c for a, b, n in todo for c in _cut(a, high if b is None else b, b is None, -(-n // rows))]
        if len(cut) == len(todo):
            break
        counts = [c for k in range(0, len(cut), 200) for c in ask(", ".join(f"SUM(CASE WHEN {_between(column, a, b)} THEN 1 ELSE 0 END) AS c{i}" for i, (a, b) in enumerate(cut[k : k + 200])), _between(column, cut[k][0], cut[min(k + 200, len(cut)) - 1][1]))]
        found = [(a, b, int(n or 0)) for (a, b), n in zip(cut, counts, strict=True)]
        done += [f for f in found if f[2] <= rows]
        todo = [f for f in found if f[2] > rows]
        if not todo:
            break
    return [f"({where}) AND {_between(column, a, b)}" for a, b, n in sorted([*done, *todo], key=lambda f: f[0]) if n] + nulls


def _cut(low, high, last: bool, parts: int) -> list[tuple]:
    """``parts`` ranges of equal width from ``low`` to ``high``; of whole numbers and times no more than there are values."""
    edges = [low]
    for i in range(1, parts):
        if isinstance(low, datetime):
            edge = low + timedelta(microseconds=(high - low) // timedelta(microseconds=1) * i // parts)
        elif isinstance(low, date):
            edge = low + timedelta(days=(high - low).days * i // parts)
        else:
            edge = low + (high - low) * i // parts if isinstance(low, int) or low == int(low) and high == int(high) else low + (high - low) * i / parts
        if edges[-1] < edge and (edge < high or last and edge <= high):
            edges.append(edge)
    return list(zip(edges, [*edges[1:], None if last else high], strict=True))


def _between(column: str, low, high) -> str:
    return f"{column} >= {_sql(low)}" + ("" if high is None else f" AND {column} < {_sql(high)}")


def _sql(v) -> str:
    """A literal that every JDBC driver reads."""
    if isinstance(v, datetime):
        return f"{{ts '{v:%Y-%m-%d %H:%M:%S.%f}'}}"
    return f"{{d '{v:%Y-%m-%d}'}}" if isinstance(v, date) else f"{v:f}" if isinstance(v, (float, Decimal)) else str(v)


def stage(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def read_staged(spark: SparkSession, paths: list[str], columns: list[str]) -> DataFrame:
    """All staged branches of a table, with the wanted columns that each has."""

    def one(path: str) -> DataFrame:
        df = spark.read.parquet(path)
        have = {c.lower(): c for c in df.columns}
        return df.select(*[F.col(f"`{have[c.lower()]}`").alias(c) for c in columns if c.lower() in have])

    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), map(one, paths))


def select_branches(df: DataFrame, ids: list[int], known: list[int] | None = None, column: str = "branch_id") -> DataFrame:
    wrong = set(ids) - set(known) if known is not None else set()
    if wrong:
        raise ValueError(f"unknown branches: {sorted(wrong)}")
    return df.where(F.col(column).isin(*ids))


def ceiling(tdef: TableDef) -> Column | None:
    """date <= max, for any table with a date column and a maximum."""
    if not (tdef.time_column and tdef.date_max):
        return None
    return _COMPARE[tdef.date_max_operator](F.col(tdef.time_column), literal(tdef.date_max))


def initial_filter(df: DataFrame, tdef: TableDef) -> DataFrame:
    """The configured range of transactions, and the ceiling of whatever has a date."""
    if tdef.category == "transactions" and tdef.time_column and tdef.date_value:
        df = df.where(_COMPARE[tdef.date_operator](F.col(tdef.time_column), literal(tdef.date_value)))
    top = ceiling(tdef)
    return df if top is None else df.where(top)


def new_and_updated(tdef: TableDef, cdc: Column, date: Column | None) -> tuple[Column | None, Column]:
    """Disjoint predicates: new rows from the date mark on (under the ceiling), and older rows that changed since (without it)."""
    changed = F.col(tdef.change_column) > cdc
    if date is None or not tdef.time_column:
        return None, changed
    day, top = F.col(tdef.time_column), ceiling(tdef)
    new = day >= date
    return (new if top is None else new & top), changed & ((day < date) | day.isNull())


def incremental_filter(df: DataFrame, tdef: TableDef, cdc_mark: str, date_mark: str | None) -> DataFrame:
    """One OR filter over a file scan; with a change mark only, the changed rows without a ceiling."""
    new, updated = new_and_updated(tdef, literal(cdc_mark), literal(date_mark) if date_mark else None)
    return df.where(updated if new is None else new | updated)


def extract(df: DataFrame, tdef: TableDef, mode: str = "INITIAL", cdc_mark: str | None = None, date_mark: str | None = None) -> DataFrame:
    """Snapshots are always whole; incremental runs fall back to the initial range without a mark or a change column."""
    if tdef.is_snapshot:
        return df
    if mode == "INCREMENTAL" and tdef.change_column and cdc_mark:
        return incremental_filter(df, tdef, cdc_mark, date_mark)
    return initial_filter(df, tdef)


def with_derived_key(df: DataFrame, tdef: TableDef) -> DataFrame:
    return df.withColumn(DERIVED_KEY, F.expr(tdef.derived_key)) if tdef.derived_key else df


def helper_join(child: DataFrame, parent: DataFrame, helper: HelperJoin) -> DataFrame:
    """The child's columns plus the parent's change columns under reserved names. The parent's join columns are assumed unique."""
    lent = {HELPER_CDC: helper.cdc_column, HELPER_DATE: helper.date_column}
    cols = [F.col(p).alias(f"__p{i}") for i, (_, p) in enumerate(helper.pairs)] + [F.col(c).alias(a) for a, c in lent.items() if c]
    own = parent.select(*cols)
    on = reduce(Column.__and__, [child[c] == own[f"__p{i}"] for i, (c, _) in enumerate(helper.pairs)])
    return child.join(own, on, "inner").drop(*[f"__p{i}" for i in range(len(helper.pairs))])


def rename_collisions(df: DataFrame, injected: tuple[str, ...]) -> DataFrame:
    """A source column with an injected name becomes SRC_<name>, repeated while that is taken too."""
    taken = {c.lower() for c in df.columns} | {c.lower() for c in injected}
    new = {}
    for c in df.columns:
        if c.lower() in {i.lower() for i in injected}:
            name = f"SRC_{c}"
            while name.lower() in taken:
                name = f"SRC_{name}"
            taken.add(name.lower())
            new[c] = name
    return df.withColumnsRenamed(new)


def inject_columns(df: DataFrame, branch_id: int | Column, tdef: TableDef, now: datetime, version: datetime | None = None) -> DataFrame:
    """Branch, first and last load time; on snapshots the run's version as well. Collisions are renamed first."""
    stamps = (*INJECTED, VERSION, VERSION_DATE) if tdef.is_snapshot else INJECTED
    df = rename_collisions(df, stamps)
    at = F.lit(str(now)).cast("timestamp_ntz")
    more = {BRANCH: (branch_id if isinstance(branch_id, Column) else F.lit(branch_id)).cast("bigint"), INSERTED: at, UPDATED: at}
    if tdef.is_snapshot:
        v = F.lit(str(version or now)).cast("timestamp_ntz")
        more |= {VERSION: v, VERSION_DATE: v.cast("date")}
    return df.withColumns(more)


def _kind(kind: T.DataType) -> str:
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "datetime"
    return "number" if isinstance(kind, T.NumericType) else "string"


def capture_watermarks(df: DataFrame, tdef: TableDef, by: str = "branch_id") -> DataFrame:
    """(branch, cdc_value, cdc_kind, date_value, date_kind): the largest change and date value per branch, all branches in one job."""
    out = []
    for role, column in (("cdc", tdef.change_column), ("date", tdef.time_column)):
        if column and column in df.columns:
            kind = df.schema[column].dataType
            top = F.max(column)
            text = F.date_format(top, "yyyy-MM-dd HH:mm:ss.SSSSSS") if _kind(kind) == "datetime" else top.cast("string")
            out += [text.alias(f"{role}_value"), F.when(top.isNotNull(), F.lit(_kind(kind))).alias(f"{role}_kind")]
        else:
            out += [F.lit(None).cast("string").alias(f"{role}_value"), F.lit(None).cast("string").alias(f"{role}_kind")]
    return df.groupBy(by).agg(*out)
