"""Line deduplication that returns compressed keep bitmaps instead of text.

Line hashes are range-partitioned by (hash, document), with a secondary sort by position, so a line that a third of all documents
share is spread over neighbouring partitions. Each partition streams its sorted rows, takes the first occurrence of a hash in each document and counts
them; only one count per hash and partition is shuffled further. Lines of common hashes are then found without gathering a hash in one task: the most frequent hashes, of which
there can only be ``HOT`` because of their frequency, are broadcast; the others are joined, and each has a hundred-thousandth of all lines at most. Documents that lose lines get a
keep bitmap in run-length form: the kept runs (start, length) of line numbers. A document without a bitmap keeps every line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from branchlake.llm.common import WHITE, ascii_lower, cut, release, text_or_empty

#: no more hashes than this can have a share of 1 / HOT of all lines
HOT = 100_000


def split_lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_key(line: Column) -> Column:
    """The line stripped of ASCII white space, A-Z in lower case."""
    return ascii_lower(F.btrim(line, F.lit(WHITE)))


def _named(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = text_or_empty(text_col)
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("version"), text.alias("body"))


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 1, min_docs: int = 10) -> DataFrame:
    """(id, version, n_dropped, keep_runs) of every document that loses lines.

    A document is a distinct (identifier, text); repeated rows count once and share a bitmap, a null identifier counts like any other. Null
    and empty texts are one empty line. Keys shorter than ``min_chars`` never count. ``keep_runs`` is ordered and empty if nothing stays.
    """
    lines = (
        _named(docs, id_col, text_col)
        .select("id", "version", F.posexplode(split_lines(F.col("body"))).alias("pos", "line"))
        .withColumn("key", line_key(F.col("line")))
        .where(F.length("key") >= min_chars)
        .select(F.unhex(F.md5("key")).alias("h"), "id", "version", "pos")
    )
    # the range partitioner samples its input and the joins below read it again: split and hash the texts once
    lines = cut(lines, "lines")
    ranged = lines.repartitionByRange("h", "id", "version")
    first = F.row_number().over(Window.partitionBy("h", "id", "version").orderBy("pos")) == 1
    counts = ranged.withColumn("first", first).groupBy("h").agg(F.count_if("first").alias("n_docs"), F.count(F.lit(1)).alias("n"))
    common = cut(counts.where(F.col("n_docs") >= min_docs).select("h", "n"), "common-lines")
    share = lines.count() / HOT
    hot, rest = F.broadcast(common.where(F.col("n") > share).select("h")), common.where(F.col("n") <= share).select("h")
    gone = lines.join(hot, "h", "left_semi").unionAll(lines.join(hot, "h", "left_anti").join(rest, "h", "left_semi"))
    # repeated rows bring a position several times
    dropped = gone.groupBy("id", "version").agg(F.array_sort(F.collect_set("pos")).alias("gone"))
    out = cut(dropped.select("id", "version", F.size("gone").cast("long").alias("n_dropped"), kept_runs(F.col("gone")).alias("keep_runs")), "bitmaps")
    release(lines, common)
    return out


def kept_runs(gone: Column) -> Column:
    """Runs between the dropped positions; the last one is open (length null)."""
    edges = F.concat(F.array(F.lit(-1)), gone)
    runs = F.transform(
        edges,
        lambda x, i: F.struct(
            (x + 1).alias("start"), F.when(i < F.size(edges) - 1, F.try_element_at(edges, (i + 2).cast("int")) - x - 1).alias("length")
        ),
    )
    return F.filter(runs, lambda r: r["length"].isNull() | (r["length"] > 0))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input's columns with the kept lines as text, plus n_lines and n_dropped; a text that loses nothing is left as it is."""
    own = docs.withColumns({"__id": F.col(id_col), "__body": text_or_empty(text_col), "__version": F.xxhash64(text_or_empty(text_col))})
    marks = bitmaps.select(F.col("id").alias("__id2"), F.col("version").alias("__version2"), F.col("n_dropped").alias("__gone"), F.col("keep_runs").alias("__runs"))
    both = own.join(marks, F.col("__id").eqNullSafe(F.col("__id2")) & (F.col("__version") == F.col("__version2")), "left")
    parts = split_lines(F.col("__body"))
    both = both.withColumn("__parts", parts)
    kept = F.flatten(
        F.transform("__runs", lambda r: F.slice("__parts", r["start"] + 1, F.greatest(F.lit(0), F.coalesce(r["length"], F.size("__parts") - r["start"]))))
    )
    out = F.when(F.col("__runs").isNull(), F.col(text_col)).otherwise(F.array_join(kept, "\n"))
    return both.select(
        *[F.col(f"`{c}`") for c in docs.columns if c not in (text_col, "n_lines", "n_dropped")],
        out.alias(text_col),
        F.size("__parts").cast("long").alias("n_lines"),
        F.coalesce("__gone", F.lit(0)).cast("long").alias("n_dropped"),
    )
