"""How quality filters overlap: sorted posting lists per part, merged by galloping.

Every document gets a bit per filter that it fails. Rows are then ordered by range of (part, identifier), so a part that holds a third of all documents spans several tasks, and cut
into ranges of at most ``RANGE`` rows of one part. A range keeps the sorted list of failing rows of each filter and of the labelled ones. For each subset of filters the union of its lists is
merged from the union of one filter less and that filter's difference to it; sizes of unions add up over ranges, so only (part, subset, counts) leave a task. All
that an order of filters removes, step by step, follows from sizes of unions.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from branchlake.llm.common import WHITE, cut, text_or_empty

RANGE = 4096
LETTERS = "ABCDE"
_SPACE = "[" + "".join(f"\\x{ord(c):02x}" for c in WHITE) + "]+"


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, _SPACE), "")


def base_filters(text: Column) -> list[Column]:
    """Failure conditions A to D: too few words, too many repeated ones, too many capitals, markup signs."""
    all_words = words(text)
    n, different = F.size(all_words), F.size(F.array_distinct(all_words))
    return [n < 200, 100 * different < 50 * n, 100 * F.length(F.regexp_replace(text, "[^A-Z]+", "")) > 2 * F.length(text), text.rlike("[#$%&*|]")]


def failures(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", part_col: str = "source") -> DataFrame:
    """(part, id, fails, good, toxic), a row per input row; bit i of ``fails`` is filter i, the last one is "a copy of a row with a smaller identifier".

    A null text or part is empty. A null identifier is a copy of nothing and makes nothing a copy; rows that share their identifier are no copies of each other. Of several labels of an
    identifier the largest counts, without a label a row is neither good nor toxic.
    """
    bits = [F.when(c, 1 << i).otherwise(0) for i, c in enumerate(base_filters(F.col("text")))]
    body = docs.select(F.coalesce(F.col(part_col), F.lit("")).alias("part"), F.col(id_col).alias("id"), text_or_empty().alias("text"))
    rows = cut(body.select("part", "id", F.unhex(F.sha2("text", 256)).alias("digest"), sum(bits[1:], bits[0]).alias("own")), "filter-bits")
    heads = rows.where("id IS NOT NULL").groupBy("digest").agg(F.min("id").alias("id")).withColumn("head", F.lit(True))
    marks = labels.groupBy(F.col("doc_id").alias("id")).agg(F.coalesce(F.max("quality"), F.lit(0)).alias("good"), F.coalesce(F.max("toxic"), F.lit(0)).alias("toxic"))
    # a pair (id, digest) is as rare as repeated rows are, so a text that a third of all rows share is spread
    joined = rows.join(heads, ["id", "digest"], "left").join(marks, "id", "left")
    copy = F.when(F.col("head").isNull() & F.col("id").isNotNull(), 1 << len(bits)).otherwise(0)
    return joined.select("part", "id", (F.col("own") + copy).alias("fails"), (F.col("good") == 1).alias("good"), (F.col("toxic") == 1).alias("toxic")).na.fill(False)


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Two sorted lists without a common entry as one: numpy's stable sort finds the two runs and merges them by galloping."""
    out = np.concatenate([a, b])
    out.sort(kind="stable")
    return out


def difference(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Entries of the sorted list ``a`` that the sorted list ``b`` lacks, each found by a search in the part of ``b`` that ``a`` spans."""
    if not len(a) or not len(b):
        return a
    b = b[np.searchsorted(b, a[0]) : np.searchsorted(b, a[-1], side="right")]
    return a[b[np.minimum(np.searchsorted(b, a), len(b) - 1)] != a] if len(b) else a


def union_sizes(lists: list[np.ndarray], marks: list[np.ndarray]) -> np.ndarray:
    """For each subset of ``lists`` (as a bit mask) the size of its union, and how much of it is in each list of ``marks``."""
    unions, sizes = [np.empty(0, np.int32)], np.zeros((1 << len(lists), 1 + len(marks)), np.int64)
    for mask in range(1, 1 << len(lists)):
        top = mask.bit_length() - 1
        less = unions[mask ^ (1 << top)]
        unions.append(merged(less, difference(lists[top], less)))
        sizes[mask] = [len(unions[mask]), *(len(m) - len(difference(m, unions[mask])) for m in marks)]
    return sizes


def subset_sizes(rows: DataFrame, filters: int = len(LETTERS)) -> DataFrame:
    """(part, subset, n_rows, failing, good, toxic) per part and subset of filters: rows in the part, and how many of them fail at least one filter of the subset, in all and with each label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, np.ndarray] = {}
        for b in batches:
            part = b.column(0).to_numpy(zero_copy_only=False)
            edges = np.flatnonzero(part[1:] != part[:-1]) + 1
            fails, *marks = (b.column(k).to_numpy(zero_copy_only=False) for k in (1, 2, 3))
            for low, high in zip([0, *edges], [*edges, len(part)], strict=True):
                for at in range(low, high, RANGE):
                    own = slice(at, min(at + RANGE, high))
                    postings = [np.flatnonzero(fails[own] >> i & 1).astype(np.int32) for i in range(filters)]
                    sizes = union_sizes(postings, [np.flatnonzero(m[own]).astype(np.int32) for m in marks])
                    n = np.full((len(sizes), 1), own.stop - own.start)
                    found[part[at]] = found.get(part[at], 0) + np.hstack([n, sizes])
        for p, sizes in found.items():
            cols = [pa.array([p] * len(sizes)), pa.array(np.arange(len(sizes), dtype=np.int32)), *(pa.array(sizes[:, k]) for k in range(sizes.shape[1]))]
            yield pa.RecordBatch.from_arrays(cols, names=["part", "subset", "n_rows", "failing", "good", "toxic"])

    ordered = rows.repartitionByRange("part", "id").sortWithinPartitions("part", "id").select("part", "fails", "good", "toxic")
    sizes = ordered.mapInArrow(run, "part string, subset int, n_rows long, failing long, good long, toxic long")
    return sizes.groupBy("part", "subset").agg(*[F.sum(c).alias(c) for c in ("n_rows", "failing", "good", "toxic")])


def interactions(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", part_col: str = "source") -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley for every order of the filters and every step in it.

    An empty table has no parts and gives no rows; other columns are not read. Repeated rows count as often as they come.
    """
    sizes = subset_sizes(failures(docs, labels, id_col, part_col))
    per = sizes.groupBy("part").agg(F.max("n_rows").alias("n"), F.array_sort(F.collect_list(F.struct("subset", "failing", "good", "toxic"))).alias("u"))
    n_filters, spark = len(LETTERS), docs.sparkSession
    steps = []
    for order in permutations(range(n_filters)):
        before = 0
        for k, f in enumerate(order):
            steps.append(("".join(LETTERS[i] for i in order), k + 1, f, before, before | 1 << f))
            before |= 1 << f
    table = F.broadcast(spark.createDataFrame(steps, "filter_order string, step int, f int, before int, after int"))  # 600 rows
    size = lambda mask, what="failing": F.element_at("u", mask + 1)[what]
    every, bit = F.lit((1 << n_filters) - 1), F.element_at(F.array(*[F.lit(1 << i) for i in range(n_filters)]), F.col("f") + 1)
    gain = lambda what="failing": size(F.col("after"), what) - size(F.col("before"), what)
    # a filter's gains over all orders: each (before, after) comes once for every order of what stands before and after it
    times = Counter((f, before, after) for _, _, f, before, after in steps)
    sums = [sum((n * (size(F.lit(a)) - size(F.lit(b))) for (g, b, a), n in times.items() if g == f), F.lit(0)) for f in range(n_filters)]
    per = per.withColumn("sums", F.array(*sums))
    return per.join(table).select(
        "part", "filter_order", "step", (F.col("n") - size(F.col("after"))).alias("kept"), gain().alias("removed"), (size(bit) - gain()).alias("redundant"),
        (size(every) - size(every - bit)).alias("unique_fails"), gain("good").alias("good_lost"), gain("toxic").alias("toxic_lost"), F.element_at("sums", F.col("f") + 1).cast("long").alias("shapley"),
    )
