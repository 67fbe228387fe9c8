"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix.

A first pass counts the rows of each input partition. The matrix entry (partition, cell) says how many rows of the partition go to a cell,
a cell being a block of consecutive slots of one shard. Rows of the matrix follow the multivariate hypergeometric law with the counts as row
sums and the cell sizes as column sums. No one holds the matrix: a binary tree over the partitions splits the cell counts by seeded draws, and each task walks
from the root to its own leaf. The task then permutes its rows over its cells, rows are exchanged by cell, and each cell is
permuted again. The result is a uniform permutation of all rows, cut into shards whose sizes differ by one at most.

The only thing sent to tasks is one count per input partition.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from branchlake.llm.common import cut

#: numpy draws hypergeometric numbers for populations below this only
NUMPY_LIMIT = 10**9


def hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """Number of good rows among ``n`` drawn without replacement; ratio of uniforms for large populations."""
    if n == 0 or good == 0:
        return 0
    if bad == 0 or n == good + bad:
        return min(n, good)
    if good < NUMPY_LIMIT and bad < NUMPY_LIMIT:
        return int(rng.hypergeometric(good, bad, n))
    total = good + bad
    mean = n * good / total
    sd = math.sqrt(max(mean * bad / total * (total - n) / max(total - 1, 1), 1e-12))
    low, high = max(0, n - bad), min(n, good)
    mode = min(high, max(low, (n + 1) * (good + 1) // (total + 2)))
    lf = math.lgamma

    def log_p(k: int) -> float:
        return -(lf(k + 1) + lf(good - k + 1) + lf(n - k + 1) + lf(bad - n + k + 1))

    top, width = log_p(mode), 1.72 * sd + 0.9  # the box of the ratio-of-uniforms method
    while True:
        u, v = rng.random(), rng.random()
        k = math.floor(mean + 0.5 + 2 * width * (v - 0.5) / max(u, 1e-300))
        if low <= k <= high and 2 * math.log(max(u, 1e-300)) <= log_p(k) - top:
            return k


def draw(rng: np.random.Generator, cells: np.ndarray, n: int) -> np.ndarray:
    """How many of ``n`` rows, drawn from all that ``cells`` will hold, belong to each cell."""
    total = int(cells.sum())
    if total < NUMPY_LIMIT:
        return rng.multivariate_hypergeometric(cells, n, method="marginals")
    out = np.zeros_like(cells)
    for i, c in enumerate(cells.tolist()):
        out[i] = hypergeometric(rng, c, total - c, n)
        n, total = n - int(out[i]), total - c
    return out


def matrix_row(counts: np.ndarray, cells: np.ndarray, part: int, seed: int) -> np.ndarray:
    """Row ``part`` of the communication matrix."""
    sums, lo, hi, node = np.concatenate([[0], np.cumsum(counts)]), 0, len(counts), 1
    while hi - lo > 1:
        mid = (lo + hi) // 2
        left = draw(np.random.default_rng([seed, node]), cells, int(sums[mid] - sums[lo]))
        lo, hi, cells, node = (lo, mid, left, 2 * node) if part < mid else (mid, hi, cells - left, 2 * node + 1)
    return cells


def cell_sizes(total: int, shards: int, per_shard: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shard, first slot and size of every cell; sizes of shards, and of the cells in one, differ by one at most."""
    shard = np.repeat(np.arange(shards), per_shard)
    of_shard = np.array([total // shards + (s < total % shards) for s in range(shards)], dtype=np.int64)
    edges = of_shard[:, None] * np.arange(per_shard + 1)[None, :] // per_shard
    return shard, edges[:, :-1].ravel(), np.diff(edges, axis=1).ravel()


def settled(df: DataFrame) -> DataFrame:
    """The rows in partitions that a retried task finds again in the same order: a plain scan is, anything behind an exchange is written first."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return cut(df, "shard-input") if any(x in plan for x in ("Exchange", "InMemory", "Sample", "rand(")) else df


def shuffle_into_shards(df: DataFrame, shards: int, seed: int = 0, per_shard: int | None = None) -> DataFrame:
    """The input's columns plus shard int and slot long (gapless from 0 within a shard), uniformly permuted.

    Values are never looked at, so nulls, ties, repeated rows and hot keys make no difference. An empty table gives no rows; with fewer rows than
    shards some shards stay empty. Columns named shard or slot are replaced. ``per_shard``: cells of each shard, by default about four cells per shuffle
    partition in all.
    """
    spark = df.sparkSession
    df = settled(df.drop("shard", "slot"))
    found = df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()  # one row per partition
    counts = np.zeros(max([r["p"] for r in found], default=0) + 1, dtype=np.int64)
    for r in found:
        counts[r["p"]] = r["n"]
    total = int(counts.sum())
    per_shard = per_shard or max(1, math.ceil(4 * int(spark.conf.get("spark.sql.shuffle.partitions")) / shards))
    shard, first, size = cell_sizes(total, shards, per_shard)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        mine = int(counts[part]) if part < len(counts) else 0
        rng = np.random.default_rng([seed, part, mine])
        cell = np.repeat(np.arange(len(size), dtype=np.int64), matrix_row(counts, size, part, seed)) if mine else np.zeros(0, dtype=np.int64)
        rng.shuffle(cell)
        for b in batches:
            n = b.num_rows
            if at + n > mine:
                raise RuntimeError("a partition has changed between the two passes")
            own = cell[at : at + n]
            at += n
            extra = [pa.array(own), pa.array(shard[own].astype(np.int32)), pa.array(first[own]), pa.array(rng.integers(0, 2**62, n))]
            yield pa.RecordBatch.from_arrays([*b.columns, *extra], names=[*b.schema.names, "__cell", "shard", "__first", "__key"])
        if at != mine:
            raise RuntimeError("a partition has changed between the two passes")

    kinds = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in df.schema)
    dealt = df.mapInArrow(assign, f"{kinds}, __cell bigint, shard int, __first bigint, __key bigint")
    rank = F.row_number().over(Window.partitionBy("__cell").orderBy("__key"))
    return dealt.withColumn("slot", F.col("__first") + rank - 1).drop("__cell", "__first", "__key")
