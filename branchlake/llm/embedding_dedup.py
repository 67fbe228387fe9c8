"""Near-duplicate vectors by sorted projection passes.

Vectors that are equal under one label are one class. A pass draws random hyperplanes, orders the classes of a label lexicographically by the
concatenated signs, and compares each with a bounded window of its predecessors in double precision. Verified pairs of all passes are united into components. Inside
each component the links are then counted exactly, block against block, so dense groups lose no link however narrow the window was; only counts
leave those tasks, never all pairs of a group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from branchlake.llm.common import Scratch, cut
from branchlake.llm.components import components

BLOCK = 1024


def classes_of(vectors: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """(cls, label, vec, copies, least): distinct usable vectors per label."""
    usable = F.col(label_col).isNotNull() & F.col(vec_col).isNotNull() & F.forall(vec_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(vec_col, lambda x: x != 0)
    own = vectors.where(usable).select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vec_col).cast("array<double>").alias("vec"))
    return own.withColumn("cls", class_key("label", "vec")).groupBy("cls").agg(F.first("label").alias("label"), F.first("vec").alias("vec"), F.count(F.lit(1)).alias("copies"), F.min("id").alias("least"))


def class_key(label: str, vec: str) -> Column:
    """Label and components as JSON, so that a label holding the separator is told apart."""
    return F.md5(F.to_json(F.struct(F.col(label).cast("string").alias("label"), F.transform(F.col(vec).cast("array<double>"), lambda x: F.coalesce(x.cast("string"), F.lit("null"))).alias("parts"))))


def _unit(vec: pa.Array) -> np.ndarray:
    x = vec.flatten().to_numpy(zero_copy_only=False).reshape(len(vec), -1)
    top = np.abs(x).max(axis=1, keepdims=True)  # scaling first keeps squares in range
    x = x / top
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def coded(classes: DataFrame, passes: int, bits: int, seed: int) -> DataFrame:
    """A row per class and pass: (pass, label, width, code, cls, vec); vectors of another width never meet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            width = np.array([len(v) for v in b.column(2)], dtype=np.int32)
            for w in np.unique(width):
                at = np.flatnonzero(width == w)
                cls, label, vec = (b.column(i).take(pa.array(at)) for i in range(3))
                x = _unit(vec)
                for p in range(passes):
                    planes = np.random.default_rng([seed, p, int(w)]).standard_normal((int(w), bits))
                    codes = np.packbits(x @ planes > 0, axis=1)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at), p, np.int32)), label, pa.array(np.full(len(at), w, np.int32)), pa.array([r.tobytes() for r in codes], pa.binary()), cls, vec],
                        names=["pass", "label", "width", "code", "cls", "vec"],
                    )

    kind = classes.schema["label"].dataType.simpleString()
    return classes.select("cls", "label", "vec").mapInArrow(run, f"pass int, label {kind}, width int, code binary, cls string, vec array<double>")


def window_pairs(sorted_rows: DataFrame, window: int, least: float) -> DataFrame:
    """(u, v) of verified pairs within ``window`` places of each other in one pass and label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail: dict = {"key": None}
        for b in batches:
            keys = list(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True))
            edges = [0, *[i for i in range(1, len(keys)) if keys[i] != keys[i - 1]], len(keys)]
            us, vs = [], []
            for lo, hi in zip(edges, edges[1:], strict=False):
                if lo == hi:
                    continue
                x, names = _unit(b.column(5).slice(lo, hi - lo)), b.column(4).slice(lo, hi - lo).to_pylist()
                before = 0
                if tail["key"] == keys[lo]:
                    x, names, before = np.vstack([tail["x"], x]), tail["names"] + names, len(tail["names"])
                for k in range(1, window + 1):
                    if k >= len(x):
                        break
                    near = np.flatnonzero((x[k:] * x[:-k]).sum(axis=1) >= least)
                    near = near[near + k >= before]
                    us += [names[i] for i in near]
                    vs += [names[i + k] for i in near]
                tail = {"key": keys[lo], "x": x[-window:], "names": names[-window:]}
            yield pa.RecordBatch.from_arrays([pa.array(us, pa.string()), pa.array(vs, pa.string())], names=["u", "v"])

    return sorted_rows.select("pass", "label", "width", "code", "cls", "vec").mapInArrow(run, "u string, v string")


def block_counts(members: DataFrame, least: float) -> DataFrame:
    """members (root, size, cls, vec, copies) -> (cls, n): linked vectors of other classes of the component, by blocks of about BLOCK classes."""
    blocks = F.greatest(F.lit(1), F.ceil(F.col("size") / BLOCK)).cast("int")
    own = members.withColumn("k", blocks).withColumn("b", F.pmod(F.xxhash64("cls"), F.col("k")).cast("int"))
    dealt = own.select("root", "cls", "vec", "copies", "b", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("o")).select(
        "root", F.least("b", "o").alias("lo"), F.greatest("b", "o").alias("hi"), "b", "cls", "vec", "copies"
    )
    placed = dealt.repartition("root", "lo", "hi").sortWithinPartitions("root", "lo", "hi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key = [], None
        for b in batches:
            keys = list(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True))
            edges = [0, *[i for i in range(1, len(keys)) if keys[i] != keys[i - 1]], len(keys)]
            for lo, hi in zip(edges, edges[1:], strict=False):
                if lo == hi:
                    continue
                if key is not None and keys[lo] != key:
                    yield _count(held, key, least)
                    held = []
                key = keys[lo]
                held.append(b.slice(lo, hi - lo))
        if held:
            yield _count(held, key, least)

    return placed.mapInArrow(run, "cls string, n long").groupBy("cls").agg(F.sum("n").alias("n"))


def _count(held: list[pa.RecordBatch], key: tuple, least: float) -> pa.RecordBatch:
    t = pa.Table.from_batches(held).combine_chunks()
    x, side = _unit(t["vec"].combine_chunks()), t["b"].to_numpy()
    copies, out = t["copies"].to_numpy().astype(np.int64), np.zeros(t.num_rows, np.int64)
    _, lo, hi = key
    left, right = (np.arange(t.num_rows),) * 2 if lo == hi else (np.flatnonzero(side == lo), np.flatnonzero(side == hi))
    for at in range(0, len(left), 256):
        rows = left[at : at + 256]
        near = x[rows] @ x[right].T >= least
        out[rows] += near @ copies[right]
        if lo != hi:
            out[right] += copies[rows] @ near
    if lo == hi:
        out -= copies  # a class links with itself here
    return pa.RecordBatch.from_arrays([t["cls"].combine_chunks(), pa.array(out)], names=["cls", "n"])


def near_duplicates(
    vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", least: float = 0.98,
    passes: int = 16, window: int = 16, bits: int = 64, seed: int = 7,
) -> DataFrame:
    """One row per input row: id, n_links, component_id, kept.

    Vectors link only under equal labels. A null label, a null, zero or empty vector, or one with a null or non-finite component links with nothing: its component is its own id. Repeated
    vectors are linked with one another and counted, never compared pairwise. Null ids keep their links and have the component of their vector. Empty input gives an empty result.
    """
    with Scratch() as scratch:
        classes = scratch.cut(classes_of(vectors, id_col, vec_col, label_col), "classes")
        rows = coded(classes, passes, bits, seed)
        placed = rows.repartitionByRange("pass", "label", "width", "code").sortWithinPartitions("pass", "label", "width", "code", "cls")
        roots = components(window_pairs(placed, window, least), scratch).withColumnsRenamed({"node": "cls"})
        sizes = roots.groupBy("root").agg(F.count(F.lit(1)).cast("int").alias("size"))
        members = scratch.cut(roots.join(sizes, "root").join(classes.select("cls", "vec", "copies", "least"), "cls"), "members")
        counts = block_counts(members, least)
        heads = members.groupBy("root").agg(F.min("least").alias("head"))
        found = members.select("cls", "root").join(heads, "root").join(counts, "cls").select("cls", "n", "head")
        per_class = classes.select("cls", "copies", "least").join(found, "cls", "left").select(
            "cls", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("head", "least").alias("component_id")
        )
        own = vectors.select(
            F.col(id_col).alias("id"),
            class_key(label_col, vec_col).alias("cls"),
            F.col(label_col).isNotNull().alias("labelled"),
        )
        # an unusable vector can share no class: its text form holds NaN, Infinity or only zeros, or its label is null
        out = cut(own.join(per_class, "cls", "left"), "vectors")
    component = F.when(F.col("labelled"), F.coalesce("component_id", "id")).otherwise(F.col("id"))
    return out.select(
        "id",
        F.when(F.col("labelled"), F.coalesce("n_links", F.lit(0))).otherwise(0).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )
