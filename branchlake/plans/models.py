"""Named SQL models and SQL tests, run in order."""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from branchlake.sources.files import Files

_REF = re.compile(r"\{\{\s*ref\(\s*['\"](\w+)['\"]\s*\)\s*\}\}")


@dataclass(frozen=True)
class Model:
    """A SELECT that may use {{ ref('name') }} of models or sources; a table is built anew each time, a view is not stored."""

    name: str
    sql: str
    materialized: str = "table"


@dataclass(frozen=True)
class SqlTest:
    name: str
    sql: str


def resolve(sql: str, known: set[str]) -> str:
    def one(m: re.Match) -> str:
        if m[1] not in known:
            raise ValueError(f"unknown reference: {m[1]}")
        return m[1]

    return _REF.sub(one, sql)


def order(models: list[Model]) -> list[Model]:
    """Models after what they refer to; a cycle is an error."""
    names, done, out = {m.name for m in models}, set(), []
    left = list(models)
    while left:
        ready = [m for m in left if not (set(_REF.findall(m.sql)) & names - done)]
        if not ready:
            raise ValueError("the models refer to each other in a circle")
        out += ready
        done |= {m.name for m in ready}
        left = [m for m in left if m.name not in done]
    return out


class Stored(Files):
    """Tables of models in a folder. Each build has a folder of its own, and the model's manifest, whose entries are numbered and put whole, tells which one counts.

    So a rebuild that fails leaves the table as it was, one that succeeds swaps it whole, and a reader of the build before still finds it until the next one.
    """

    def __init__(self, spark: SparkSession, folder: str):
        super().__init__(spark)
        self.folder = folder.rstrip("/")

    def _entries(self, name: str) -> list[dict]:
        numbers = sorted(n for n in self._names(f"{self.folder}/_manifest/{name}") if n.isdigit())
        return [json.loads(self._text(f"{self.folder}/_manifest/{name}/{n}")) | {"n": int(n)} for n in numbers]

    def read(self, name: str) -> DataFrame | None:
        found = self._entries(name)
        return self.spark.read.parquet(f"{self.folder}/{found[-1]['path']}") if found else None

    def write(self, name: str, df: DataFrame) -> DataFrame:
        path = f"{name}/build={uuid.uuid4().hex}"
        df.write.parquet(f"{self.folder}/{path}")
        while True:
            before = self._entries(name)
            if self._put(f"{self.folder}/_manifest/{name}/{(before[-1]['n'] if before else 0) + 1:020d}", json.dumps({"path": path})):
                break
        for old in before[:-1]:  # the build before stays for its readers
            self.delete(f"{self.folder}/{old['path']}")
            self.delete(f"{self.folder}/_manifest/{name}/{old['n']:020d}")
        return self.spark.read.parquet(f"{self.folder}/{path}")


def run_models(spark: SparkSession, models: list[Model], sources: set[str], select: set[str] | None = None, folder: str | None = None) -> dict[str, DataFrame]:
    """Build the models, or those in ``select``; ``folder``: where tables are stored, else they are only named.

    What a selected model refers to is taken as it is stored, and a view is made anew on what it refers to; a table that has never been stored is an error, unless it is named in this session already.
    """
    built, known, by_name = {}, set(sources) | {m.name for m in models}, {m.name: m for m in models}
    stored = Stored(spark, folder) if folder else None
    wanted = {m.name for m in models} if select is None else set(select)
    named, new = set(wanted), set(wanted)
    while new:  # a stored table's own references are not needed again
        read = {r for n in new if n in by_name and (n in wanted or by_name[n].materialized != "table") for r in _REF.findall(by_name[n].sql)}
        new = (read & by_name.keys()) - named
        named |= new
    for m in order(models):
        if m.name not in named:
            continue
        if m.name not in wanted and m.materialized == "table":
            df = stored.read(m.name) if stored else None
            if df is None and not spark.catalog.tableExists(m.name):
                raise ValueError(f"{m.name} has not been built")
            if df is not None:
                df.createOrReplaceTempView(m.name)
            continue
        df = spark.sql(resolve(m.sql, known))
        if m.materialized == "table" and stored:
            df = stored.write(m.name, df)
        df.createOrReplaceTempView(m.name)
        if m.name in wanted:
            built[m.name] = df
    return built


def run_test(spark: SparkSession, test: SqlTest, known: set[str]) -> bool:
    """Passes if no row comes back."""
    return spark.sql(resolve(test.sql, known)).limit(1).isEmpty()


def failing_rows(spark: SparkSession, test: SqlTest, known: set[str]) -> DataFrame:
    return spark.sql(resolve(test.sql, known)).agg(F.count(F.lit(1)).alias("failing_rows")).select(F.lit(test.name).alias("test"), "failing_rows", (F.col("failing_rows") == 0).alias("passed"))


def build_models(spark: SparkSession, models: list[Model], tests: list[SqlTest], sources: set[str], select: set[str] | None = None, folder: str | None = None) -> DataFrame:
    """Models, then the tests that refer to what was built: (kind, name, passed)."""
    built = run_models(spark, models, sources, select, folder)
    known = set(sources) | {m.name for m in models}
    rows = [("model", n, True) for n in built]
    for t in tests:
        if select is None or set(_REF.findall(t.sql)) & set(built):
            rows.append(("test", t.name, run_test(spark, t, known)))
    return spark.createDataFrame(rows, "kind string, name string, passed boolean")
