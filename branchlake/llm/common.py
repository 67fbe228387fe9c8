"""Shared pieces: the shared scratch folder, lineage cuts and small column helpers."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from branchlake.sources.scratch import fresh

#: ASCII white space of the contracts: [\x20\x09-\x0D]
WHITE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """Write to the shared folder and read back: ends the lineage, fixes the rows against retries, survives lost executors.

    The driver's garbage is collected then, because Spark removes the shuffle files of a finished job only once its plan is collected.
    """
    spark = df.sparkSession
    path = fresh(spark, name)
    df.write.parquet(path)
    spark.sparkContext._jvm.System.gc()
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def release(*tables: DataFrame) -> None:
    """Delete written tables (results of ``cut``) that nothing will read again."""
    for df in tables:
        path = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(df._scratch_path)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


class Scratch:
    """Tables written on the way to a result. Leaving the block deletes them, so the result itself must be written (``cut``) before that."""

    def __init__(self):
        self.tables: list[DataFrame] = []

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        release(*self.tables)

    def cut(self, df: DataFrame, name: str) -> DataFrame:
        self.tables.append(out := cut(df, name))
        return out

    def drop(self, df: DataFrame) -> None:
        """Delete a table early."""
        self.tables = [t for t in self.tables if t is not df]
        release(df)


def small_side(df: DataFrame, limit: int = 500_000) -> DataFrame:
    """A narrow written table marked for broadcast if it has at most ``limit`` rows; else as it is, for a shuffled join."""
    return F.broadcast(df) if df.count() <= limit else df


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], rows: int = 256) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task function for mapInArrow that sees its batches in slices of at most ``rows`` rows, so its answers stay small too, and gives freed memory back to the system at its end.

    Python workers outlive their tasks, and what an idle one still holds is missing in the stages that follow.
    """

    @functools.wraps(run)
    def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(b.slice(low, rows) for b in batches for low in range(0, b.num_rows, rows))
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
            if trim:
                trim(0)

    return sliced


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def hash_share(h: Column, wanted: int, total: int) -> Column:
    """Whether a 64-bit hash is in the share that takes about ``wanted`` of ``total`` rows; all of them if there are no more."""
    return F.lit(True) if total <= wanted else F.pmod(F.shiftright(h, 8), F.lit(1 << 40)) < int((1 << 40) * wanted / total)
