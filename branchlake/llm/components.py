"""Connected components of an edge table by alternating large-star and small-star rounds.

Each round is joins and grouped minimums over edges, so a node with a third of all edges is pre-aggregated before it is shuffled. Rounds are written to the shared
folder; the only number that reaches the driver is a count of edges and a checksum of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from branchlake.llm.common import Scratch


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """large: link every larger neighbour to the smallest; small: link every smaller neighbour, and the node, to the smallest."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    if not large:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = both.join(least, "u")
    if large:
        out = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.where(F.col("u") != F.col("v")).distinct()


def components(edges: DataFrame, scratch: Scratch, rounds: int = 40) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v): root is the smallest node of its component.

    Loops (u = v) and nulls are ignored, repeated and reversed edges count once; without edges the result is empty. The result is read from a table in ``scratch``.
    """
    now = scratch.cut(edges.where(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    seen = None
    for _ in range(rounds):
        before, now = now, scratch.cut(_star(_star(now, True), False), "edges")
        scratch.drop(before)
        mark = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if mark == seen:
            break
        seen = mark
    else:
        raise RuntimeError("the components have not settled")
    roots = now.select(F.col("v").alias("node")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots.withColumn("root", F.col("node")))
