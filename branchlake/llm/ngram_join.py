"""Exact Jaccard self-join of word shingle sets, by token-combination prefixes, and its connected components.

n is a set's size, t the threshold, e(n) = n - ceil(t n) the most tokens a linked set may lack, p(n) = e(n) + 1.

1. Equal sets are one class, so copies are compared with nothing.
2. Classes without a partner leave early. The head of a class is its first tokens in hash order, long enough that a token among the first q(n) of one class is in the head of any linked class
   that has it. A class with p tokens among its first q that no other head has cannot be linked. Counting is done for a slice of the hashes at a time, to hold less on disk, and repeated
   among the classes that are left, since only these can be partners.
3. The rest count the exact frequency of their tokens and order them rare first, so two linked classes share a token within their first p places. Tokens in at most ``frequent`` classes are indexed one by
   one. Where a prefix reaches into more frequent tokens it is extended to 2e(n) + e(n/t) + 2 places, and two-token combinations of neighbours there are indexed: if the first common token is frequent, at most e tokens of either
   class are not shared from there on, so two common tokens must be neighbours in both that early. That is one combination per place, never all of them.
4. Each index entry verifies its members against its first. Entries that still hold several components are looked through once more, by size and by a sketch of each set that bounds from below how
   much two sets differ: what it can't tell apart is joined into clusters, which are then verified in blocks of whole sets, skipping pairs that are connected already. So a large
   group of near copies costs a pass of its members, texts that merely share passages never form a cluster, and no step emits all pairs of a group.

Overlaps are counted on whole sets of 64-bit shingle hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from branchlake.llm.common import Scratch, cut, lean, small_side
from branchlake.llm.components import components

BLOCK = 512
#: bits of a sketch
SKETCH = 2048


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a limit."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < 100_000:
            self[word] = value
        return value


def shingle_set(text: str | None, n: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the text's n-word shingles; of the whole sequence if it is shorter; empty without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z only, and exactly [\x20\x09-\x0D]
    if not words:
        return np.zeros(0, np.int64)
    w = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    width = min(n, len(w))
    h = np.full(len(w) - width + 1, 0x9E3779B97F4A7C15 * width % 2**64, np.uint64)
    for i in range(width):
        h = (h ^ (h >> np.uint64(31)) ^ w[i : len(w) - width + 1 + i]) * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(29)
    return np.unique(h.view(np.int64))


def spare(n: int, percent: int) -> int:
    return n - (percent * n + 99) // 100


def front(n: int, percent: int) -> int:
    """q(n): the places that count for leaving early."""
    return -(-3 * (spare(n, percent) + 1) // 2)


def allowance(n: Column, percent: int) -> Column:
    """e(n): how many of ``n`` tokens a linked set may lack."""
    return (n - F.floor((n * percent + 99) / 100)).cast("int")


def signatures(docs: DataFrame, id_col: str, text_col: str, width: int, percent: int) -> DataFrame:
    """(id, fp, n, head): fp is a 128-bit digest of the set, null for an empty one; a set that only equal ones can match has no head. One that may lack no token itself
    can still lie in a larger partner, so the partner's greatest size decides."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for b in batches:
            fps, ns, heads = [], [], []
            for t in b.column(1).to_pylist():
                s = shingle_set(t, width, hashes)
                n = len(s)
                fps.append(xxhash.xxh3_128_digest(s.tobytes()) if n else None)
                ns.append(n)
                most = n * 100 // percent
                heads.append(s[: front(most, percent) + spare(n, percent)] if most > n else s[:0])
            ends = np.cumsum([0, *map(len, heads)])
            flat = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int64), *heads])))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.binary()), pa.array(ns, pa.int64()), flat], names=["id", "fp", "n", "head"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(lean(run), f"id {kind}, fp binary, n long, head array<long>")


def sketch(tokens: np.ndarray) -> bytes:
    """The parity of the number of tokens in each of SKETCH cells: two sets differ in at least as many tokens as their sketches in bits."""
    return np.packbits(np.bincount(tokens & (SKETCH - 1), minlength=SKETCH) & 1).tobytes()


def whole_sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(cid, n, toks, sketch) of the classes ``wanted`` (cid, fp, least), from the texts of their smallest identifiers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for b in batches:
            sets = [shingle_set(t, width, hashes) for t in b.column(0).to_pylist()]
            # several texts may share an identifier: the digest tells which one is meant
            own = pa.array([i for i, (s, fp) in enumerate(zip(sets, b.column(1).to_pylist(), strict=True)) if xxhash.xxh3_128_digest(s.tobytes()) == fp], pa.int64())
            mine = [sets[i] for i in own.to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(2).take(own), pa.array(mine, pa.list_(pa.int64())), pa.array(list(map(sketch, mine)), pa.binary())], names=["cid", "toks", "sketch"])

    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    texts = own.join(small_side(wanted.select("least", "fp", "cid")), F.col("id").eqNullSafe(F.col("least"))).select("text", "fp", "cid")
    return texts.mapInArrow(lean(run), "cid long, toks array<long>, sketch binary").groupBy("cid").agg(F.first("toks").alias("toks"), F.first("sketch").alias("sketch")).withColumn("n", F.size("toks").cast("long"))


def lonely(heads: DataFrame, percent: int, slices: int, scratch: Scratch) -> DataFrame:
    """(own, alone) of the classes in heads (fp, n, head): how many of the first q tokens no other head has. Copies of a class count as one."""
    places = F.ceil((allowance(F.col("n"), percent) + 1) * 1.5)
    tokens = heads.select(owner(), places.alias("q"), F.posexplode("head").alias("pos", "tok"))
    # the last bit of a mark says whether the token is early in its class
    marked = tokens.select("tok", (F.shiftleft("own", 1) + (F.col("pos") < F.col("q")).cast("long")).alias("mark"))
    parts = []
    for i in range(slices):
        seen = marked.where(F.pmod("tok", F.lit(slices)) == i).groupBy("tok").agg(F.min("mark").alias("mark"), F.max("mark").alias("other"))
        alone = seen.where((F.col("mark") == F.col("other")) & (F.col("mark").bitwiseAND(F.lit(1)) == 1))
        parts.append(scratch.cut(alone.groupBy(F.shiftright("mark", 1).alias("own")).agg(F.count(F.lit(1)).alias("alone")), "alone"))
    return reduce(DataFrame.unionAll, parts).groupBy("own").agg(F.sum("alone").alias("alone"))


def owner() -> Column:
    """63 bits of a class's digest."""
    return F.shiftright(F.shiftleft(F.xxhash64("fp"), 1), 1).alias("own")


def possible(sig: DataFrame, percent: int, scratch: Scratch, rounds: int = 3, slices: int = 8) -> DataFrame:
    """(fp, least, n) of the classes in ``sig`` (a table in ``scratch``, used up) that step 2 can't rule out. Only these can be partners, so counting again among them rules out more."""
    heads = sig.where(F.size("head") > 0)
    left = heads.groupBy("fp").agg(F.min("id").alias("least"), F.first("n").alias("n"))
    table, heads = sig, heads.select("id", "fp", "n", "head")
    for i in range(rounds):
        counts = lonely(heads, percent, slices if i == 0 else 1, scratch)
        both = left.withColumn("own", owner()).join(counts, "own", "left")
        left = scratch.cut(both.where(F.coalesce("alone", F.lit(0)) <= allowance(F.col("n"), percent)).drop("own", "alone"), "possible")
        if i + 1 < rounds:
            wanted = small_side(left.select("fp", F.col("least").alias("id"))).alias("w")
            own = heads.alias("h").join(wanted, (F.col("h.fp") == F.col("w.fp")) & F.col("h.id").eqNullSafe(F.col("w.id")))
            heads = scratch.cut(own.select("h.id", "h.fp", "h.n", "h.head"), "heads")
            scratch.drop(table)
            table = heads
    scratch.drop(table)
    return left


def index_entries(sets: DataFrame, percent: int, frequent: int, scratch: Scratch) -> DataFrame:
    """sets (cid, n, toks) -> (key, cid, n): where each class is found. Tokens of a single class are only counted, they find nothing."""
    counts = sets.select(F.explode("toks").alias("tok"), "cid").groupBy("tok").agg(F.count(F.lit(1)).alias("df"), F.min("cid").alias("owner"))
    freq = scratch.cut(counts.select(F.when(F.col("df") > 1, F.col("tok")).alias("tok"), "df", F.when(F.col("df") == 1, F.col("owner")).alias("owner")), "frequency")
    before = scratch.cut(freq.where("df = 1").groupBy("owner").agg(F.count(F.lit(1)).alias("before")), "before")
    open_ = sets.join(small_side(before), F.col("cid") == F.col("owner"), "left").where(F.coalesce("before", F.lit(0)) <= allowance(F.col("n"), percent))
    shared = freq.where("df > 1").select("tok", "df")
    own = open_.select(F.explode("toks").alias("tok"), "cid").join(shared, "tok").groupBy("cid").agg(F.sort_array(F.collect_list(F.struct("df", "tok"))).alias("own"))
    ordered = own.join(small_side(sets.select("cid", "n")), "cid")
    prefix = allowance(F.col("n"), percent) + 1
    short = ordered.withColumn("before", F.col("n") - F.size("own")).withColumn("p", prefix).where("before < p")
    short = scratch.cut(short.withColumn("rare", F.filter("own", lambda x: x["df"] <= frequent)).withColumn("hot", F.filter("own", lambda x: x["df"] > frequent)).drop("own"), "prefixes")
    singles = short.select(F.explode(F.slice("rare", 1, (F.col("p") - F.col("before")).cast("int"))).alias("x"), "cid", "n").select(F.col("x.tok").alias("key"), "cid", "n")
    done = F.col("before") + F.size("rare")
    reach = (2 * allowance(F.col("n"), percent) + allowance(F.floor(F.col("n") * 100 / percent), percent) + 2 - done).cast("int")
    near = short.where(done < F.col("p")).select("cid", "n", F.slice("hot", 1, F.greatest(F.lit(0), reach)).alias("hot"))
    twos = F.transform(F.slice("hot", 1, F.greatest(F.lit(0), F.size("hot") - 1)), lambda x, i: F.xxhash64(F.lit("two"), x["tok"], F.get("hot", i + 1)["tok"]))
    return singles.unionByName(near.select(F.explode(twos).alias("key"), "cid", "n"))


def similar_sizes(a: str, b: str, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def linked(overlap: Column, a: Column, b: Column, percent: int) -> Column:
    return overlap * 100 >= (a + b - overlap) * percent


def size_class(n: Column, percent: int) -> Column:
    """Sizes of linked sets are in the same class or in neighbouring ones: a class spans the ratio that the threshold allows."""
    return F.floor(F.log(n.cast("double")) / float(np.log(100 / min(percent, 99))) + 1e-9).cast("int")


def in_blocks(members: DataFrame, group: str, columns: list[str], percent: int, whole: bool) -> DataFrame:
    """(u, v): pairs of members (cid) of a group that may be linked, or are (``whole``), and have different labels; a spanning set of them per pair of blocks of BLOCK members.

    columns: cid, label, n, sketch and, if ``whole``, toks. A group is dealt out by size first: members of a size class meet each other and those of the next one, and only among these are blocks
    paired. So a group of many sizes costs each of its members two visits, and the blocks of a few sizes.
    """
    named = members.withColumn("__g", F.col(group)).withColumn("c", size_class(F.col("n"), percent))
    sizes = named.groupBy("__g", "c").agg(F.count(F.lit(1)).alias("own"))
    near = sizes.select("__g", (F.col("c") - 1).alias("c"), F.col("own").alias("next"))
    slots = sizes.join(near, ["__g", "c"], "left").select("__g", F.col("c").alias("slot"), F.greatest(F.lit(1), F.ceil((F.col("own") + F.coalesce("next", F.lit(0))) / BLOCK)).cast("int").alias("k"))
    visits = named.select("__g", "c", *columns, F.explode(F.array("c", F.col("c") - 1)).alias("slot"))
    own = visits.join(slots, ["__g", "slot"]).withColumn("b", F.pmod(F.xxhash64("cid"), F.col("k")).cast("int"))  # a slot below the smallest class is none
    dealt = own.select("__g", "slot", "b", "c", *columns, F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("o"))
    dealt = dealt.select(F.col("__g").alias("g"), "slot", F.least("b", "o").alias("lo"), F.greatest("b", "o").alias("hi"), "b", "c", *columns)
    placed = dealt.repartition("g", "slot", "lo", "hi").sortWithinPartitions("g", "slot", "lo", "hi", "n", "cid")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key = [], None
        for b in batches:
            keys = list(zip(*(b.column(i).to_pylist() for i in range(4)), strict=True))
            edges = [0, *[i for i in range(1, len(keys)) if keys[i] != keys[i - 1]], len(keys)]
            for lo, hi in zip(edges, edges[1:], strict=False):
                if lo == hi:
                    continue
                if key is not None and keys[lo] != key:
                    yield _spanning(held, key, percent, whole)
                    held = []
                key = keys[lo]
                held.append(b.slice(lo, hi - lo))
        if held:
            yield _spanning(held, key, percent, whole)

    return placed.mapInArrow(lean(run), "u long, v long")


def _spanning(held: list[pa.RecordBatch], key: tuple, percent: int, whole: bool) -> pa.RecordBatch:
    """By size: only smaller sets that are large enough, of another label, and that the sketches don't tell apart are looked at; a pair found unites its labels."""
    t = pa.Table.from_batches(held).combine_chunks()
    cid, n, side, kind = (t[c].to_numpy() for c in ("cid", "n", "b", "c"))
    _, slot, low_block, high_block = key
    lab = np.unique(t["label"].to_numpy(), return_inverse=True)[1]
    bits = np.frombuffer(b"".join(t["sketch"].to_pylist()), np.uint64).reshape(len(n), -1)
    tokens = t["toks"].combine_chunks() if whole else None
    least = np.searchsorted(n, -(-n * percent // 100))
    sets: dict[int, set] = {}

    def tokens_of(i: int) -> set:
        if i not in sets:
            sets[i] = set(tokens[i].values.to_numpy().tolist())
        return sets[i]

    us, vs = [], []
    for j in range(1, len(n)):
        near = np.arange(least[j], j)
        near = near[(lab[near] != lab[j]) & ((side[near] != side[j]) if low_block != high_block else True) & ((kind[near] == slot) | (kind[j] == slot))]  # two of the next class meet in their own slot
        if not len(near):
            continue
        need = -(-percent * (n[near] + n[j]) // (100 + percent))
        some = np.bitwise_count(bits[near] ^ bits[j]).sum(axis=1, dtype=np.int64) <= n[near] + n[j] - 2 * need
        for i, least_shared in zip(near[some].tolist(), need[some].tolist(), strict=True):
            if lab[i] != lab[j] and (not whole or len(tokens_of(i) & tokens_of(j)) >= least_shared):
                lab[lab == lab[i]] = lab[j]
                us.append(cid[i])
                vs.append(cid[j])
    return pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], names=["u", "v"])


def ngram_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80, frequent: int = 64
) -> DataFrame:
    """One row per input row: id, n_shingles, component_id (smallest identifier reachable by links, itself included).

    Null, empty and wordless texts have an empty set, link with nothing and are their own component. Texts of fewer than ``width`` words have one shingle. Repeated rows and copies share a
    component. Null identifiers take part; a component of nothing else has a null id. Columns other than the two named are not read. An empty table gives no rows. ``percent`` is at least
    80, below which neighbouring combinations do not suffice.
    """
    if not 80 <= percent <= 100:
        raise ValueError("percent must be 80 to 100")
    with Scratch() as scratch:
        return _components(docs, id_col, text_col, width, percent, frequent, scratch)


def _components(docs: DataFrame, id_col: str, text_col: str, width: int, percent: int, frequent: int, scratch: Scratch) -> DataFrame:
    headed = scratch.cut(signatures(docs, id_col, text_col, width, percent), "heads")
    sig = scratch.cut(headed.select("id", "fp", "n"), "signatures")
    rest = scratch.cut(possible(headed, percent, scratch).withColumn("cid", F.monotonically_increasing_id()), "partners")
    sets = scratch.cut(whole_sets(docs, rest, id_col, text_col, width), "sets")
    index = scratch.cut(index_entries(sets, percent, frequent, scratch), "index")
    shared = scratch.cut(index.groupBy("key").agg(F.count(F.lit(1)).alias("many"), F.min(F.struct("cid", "n")).alias("first")).where(F.col("many") > 1), "shared")
    members = scratch.cut(index.join(shared, "key").select("key", "cid", "n", "many", F.col("first.cid").alias("pivot"), F.col("first.n").alias("pivot_n")), "members")

    star = members.where((F.col("cid") != F.col("pivot")) & similar_sizes("n", "pivot_n", percent)).select(F.col("pivot").alias("u"), F.col("cid").alias("v")).distinct()
    left, right = (sets.select(F.col("cid").alias(k), F.col("n").alias(f"n_{k}"), F.col("toks").alias(f"t_{k}")) for k in "uv")
    overlap = F.size(F.array_intersect("t_u", "t_v"))
    edges = scratch.cut(star.join(left, "u").join(right, "v").where(linked(overlap, F.col("n_u"), F.col("n_v"), percent)).select("u", "v"), "links")
    first = components(edges, scratch).withColumnsRenamed({"node": "cid", "root": "label"})

    labelled = members.where(F.col("many") > 2).join(first, "cid", "left").withColumn("label", F.coalesce("label", "cid"))
    open_keys = labelled.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.sum(F.xxhash64("cid").cast("decimal(38,0)")).alias("same")).where("lo <> hi")
    # entries of the very same members are looked through once
    unsure = scratch.cut(labelled.select("key", "cid", "many", "label").join(open_keys.groupBy("same").agg(F.min("key").alias("key")).select("key"), "key"), "open")
    roots = first.withColumnsRenamed({"label": "root"})
    if not unsure.isEmpty():
        sketched = unsure.join(sets.select("cid", "n", "sketch"), "cid")
        maybe = scratch.cut(in_blocks(sketched, "key", ["cid", "label", "n", "sketch"], percent, False), "maybe")
        clusters = components(maybe, scratch).withColumnsRenamed({"node": "cid", "root": "cluster"})
        inside = clusters.join(unsure.select("cid", "label").distinct(), "cid").join(sets, "cid")
        more = in_blocks(inside, "cluster", ["cid", "label", "n", "sketch", "toks"], percent, True)
        roots = components(edges.unionByName(more), scratch).withColumnsRenamed({"node": "cid"})
    named = rest.select("cid", "fp").join(roots, "cid").select("fp", "root")
    joined = sig.where(F.col("fp").isNotNull()).groupBy("fp").agg(F.min("id").alias("least")).join(named, "fp", "left")
    heads = joined.where(F.col("root").isNotNull()).groupBy("root").agg(F.min("least").alias("head"))
    found = joined.join(heads, "root", "left").select("fp", F.coalesce("head", "least").alias("component_id"))
    out = sig.select("id", "fp", "n").join(found, "fp", "left")
    return cut(out.select("id", F.col("n").alias("n_shingles"), F.when(F.col("fp").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id")), "ngram-components")
