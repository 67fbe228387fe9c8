"""Packing tokenised documents into fixed-length sequences by a configuration linear program.

Documents are tokenised once and cut into pieces; the pieces' lengths make a histogram of at most ``capacity`` numbers, which is all that the
solver sees. The linear program has a variable per configuration (a multiset of lengths that fits one sequence) and a covering
constraint per length. Multiplicative weights price the lengths, a knapsack dynamic program over the prices finds the best configurations and a dual bound, and the fractional
cover is rounded; what rounding leaves is packed best-fit decreasing on the histogram. Pieces then find their place from their rank among the pieces of
their length, which is a count per written partition plus a running number.
"""

from __future__ import annotations

import math
import re
import string
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from branchlake.llm.common import cut, lean

# The id that ends a document.
END = (1).to_bytes(4, "little")


#: chunks in a worker's cache; twice as many take a fifth off the time
CACHE = 150_000

#: letters whose lower case and composed form are the same everywhere
LATIN = "".join(c for c in map(chr, range(256)) if c.isalpha() and c not in "ªµº")
#: signs that are one word to the tokenizer when they stand together; ' starts words like 's, and < | > those that are added to the vocabulary
SIGNS = "".join(c for c in string.punctuation if c not in "'<|>")
PLAIN = re.compile(f"([{LATIN}]*)([{re.escape(SIGNS)}]{{0,8}})")


def ids_bytes(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class WordIds:
    """Token ids of a text as little-endian 32-bit bytes, from a cache of its chunks between ASCII white space.

    The tokenizer drops white space and no token crosses it, so a text's ids are its chunks' ids one after another. A full cache becomes the older one, from which
    chunks that are seen again come back; so frequent chunks stay, and those seen once, which are most, go. A chunk of Latin letters with a few signs behind them or none is one word and one run of
    signs to the tokenizer, which lower-cases, whatever its rules for others are. So the model behind it is asked once for the word in lower case, at a third of the cost, and chunks that differ from it in case or signs share
    the answer, which is kept as that of a chunk.
    """

    def __init__(self, path: str, limit: int = CACHE):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer, self.known, self.older, self.limit = Tokenizer.from_file(path), {}, {}, limit
        spelt = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.spelling = {ord(c): spelt.pre_tokenize_str(c)[0][0] for c in LATIN.lower()}
        self.signs: dict[str, bytes] = {"": b""}
        self.model = self.tokenizer.model

    def rest(self) -> None:
        """Between tasks the older cache goes, so a worker that turns to another stage holds less."""
        self.older = {}

    def __call__(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > self.limit:
            self.known, self.older = {}, self.known
        if len(self.signs) > self.limit:
            self.signs = {"": b""}
        known, older, signs = self.known, self.older, self.signs
        split = [t.replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\f", " ").replace("\v", " ").split(" ") for t in texts]
        new = set().union(*split).difference(known)
        again = new.intersection(older)
        known.update((w, older[w]) for w in again)
        others = []
        for w in new - again:
            if m := PLAIN.fullmatch(w):
                stem, tail = m[1].lower(), m[2]
                ids = known.get(stem)
                if ids is None:
                    ids = older.get(stem)
                    known[stem] = ids = self._word(stem) if ids is None else ids
                if tail and tail not in signs:
                    signs[tail] = ids_bytes(self.tokenizer.encode(tail, add_special_tokens=False).ids)
                known[w] = ids + signs[tail]
            else:
                others.append(w)
        new = others
        for i in range(0, len(new), 10_000):
            part = new[i : i + 10_000]
            for w, e in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False), strict=True):
                known[w] = ids_bytes(e.ids)
        get = known.__getitem__
        return [b"".join(map(get, words)) + END for words in split]

    def _word(self, stem: str) -> bytes:
        return ids_bytes([t.id for t in self.model.tokenize(stem.translate(self.spelling))]) if stem else b""


_ENCODERS: dict[tuple[str, int], WordIds] = {}


def encoder(path: str, limit: int = CACHE) -> WordIds:
    """One per Python worker, so that the tasks a worker runs share what it has learnt."""
    if (path, limit) not in _ENCODERS:
        _ENCODERS[path, limit] = WordIds(path, limit)
    return _ENCODERS[path, limit]


def pieces(docs: DataFrame, tokenizer: str, capacity: int, id_col: str = "doc_id", text_col: str = "text", cache: int = CACHE) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, plus (part, rank): the rank among pieces of this length in the partition ``part``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, seen = encoder(tokenizer, cache), TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for b in batches:
            rows = []
            for i, code in zip(b.column(0).to_pylist(), encode([t or "" for t in b.column(1).to_pylist()]), strict=True):
                for k, at in enumerate(range(0, len(code), 4 * capacity)):
                    own = code[at : at + 4 * capacity]
                    rows.append((i, k, at // 4, len(own) // 4, zlib.crc32(own), part, int(seen[len(own) // 4])))
                    seen[len(own) // 4] += 1
            cols = list(zip(*rows, strict=True))
            kinds = [b.schema.types[0], pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "rank"])
        encode.rest()

    kind = docs.schema[id_col].dataType.simpleString()
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return narrow.mapInArrow(lean(run), f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, part int, rank long")


def knapsack(sizes: np.ndarray, price: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Unbounded knapsack over all capacities: (best total price, index of the size to take last there, -1 for a unit of slack); ties to the larger size."""
    value, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1, np.int64)
    fits = np.searchsorted(sizes, np.arange(capacity + 1), side="right")
    for c in range(int(sizes[0]), capacity + 1):
        total = price[: fits[c]] + value[c - sizes[: fits[c]]]
        k = len(total) - 1 - int(total[::-1].argmax())
        if total[k] > value[c - 1]:
            value[c], choice[c] = total[k], k
        else:
            value[c] = value[c - 1]
    return value, choice


def configurations(first: np.ndarray, sizes: np.ndarray, choice: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """For each index in ``first`` the best configuration that holds that size, as (number of the configuration, index of a size) pairs, one per piece."""
    back = np.concatenate([[0], np.maximum.accumulate(np.where(choice >= 0, np.arange(capacity + 1), 0))[1:]])  # over slack, to where something is taken
    who, at = np.arange(len(first)), back[capacity - sizes[first]]
    owners, taken = [who], [first]
    while True:
        live = choice[at] >= 0
        who, at = who[live], at[live]
        if not len(who):
            break
        owners.append(who)
        taken.append(choice[at])
        at = back[at - sizes[choice[at]]]
    return np.concatenate(owners), np.concatenate(taken)


def fractional_covers(sizes: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = 64, near: float = 0.02) -> Iterator[tuple[list[tuple[np.ndarray, np.ndarray, float]], float]]:
    """Multiplicative weights for: the fewest sequences, in fractions, whose configurations cover ``demand``. Yields ([(indices, copies, amount)], a lower bound) after 4, 8, 16 ... rounds.

    Demand stays as it is. A size's price is its share of a sequence times exp(-times covered so far). A round solves the knapsack at these prices; the price of all demand
    over the best configuration's is a dual bound (weak duality). All best configurations through a size that come within ``near`` of the optimum enter together, in proportion
    to that size's demand, each scaled down so that no size is covered more than once in a round. Divided by its scarcest cover, the sum covers everything.
    """
    base, cover, bound, look = sizes / capacity, np.zeros(len(sizes)), 0.0, 4
    held: dict[tuple, float] = {}
    for n in range(1, rounds + 1):
        times = cover / demand
        price = base * np.exp(times.min() - times)
        value, choice = knapsack(sizes, price, capacity)
        bound = max(bound, float(price @ demand) / value[capacity])
        through = price + value[capacity - sizes]
        # the size that is furthest behind always takes part, else it could wait for ever
        first = np.flatnonzero((through >= (1 - near) * value[capacity]) | (times <= times.min()))
        owner, taken = configurations(first, sizes, choice, capacity)
        order = np.lexsort((taken, owner))
        cuts = np.searchsorted(owner[order], np.arange(len(first) + 1))
        amount = demand[first] / np.bincount(owner[taken == first[owner]], minlength=len(first))
        over = (np.bincount(taken, amount[owner], minlength=len(sizes)) / demand)[taken]
        amount /= np.maximum.reduceat(over[order], cuts[:-1])
        cover += np.bincount(taken, amount[owner], minlength=len(sizes))
        for k, x in enumerate(amount):
            key = tuple(taken[order[cuts[k] : cuts[k + 1]]].tolist())
            held[key] = held.get(key, 0.0) + x
        if n == look and cover.min() > 0 or n == rounds:
            least = (cover / demand).min() or 1.0
            yield sorted(((*np.unique(np.array(k), return_counts=True), x / least) for k, x in held.items()), key=lambda c: (-c[2], c[0].tolist())), bound
        look *= 2 if n == look else 1


@dataclass
class Plan:
    """For each length, runs of places: the run starting at rank ``low`` fills ``per`` places in each sequence from ``seq`` on, first offset ``at``."""

    length: np.ndarray
    low: np.ndarray
    per: np.ndarray
    seq: np.ndarray
    at: np.ndarray
    sequences: int
    bound: float = 0.0  # no packing takes fewer sequences
    left: float = 0.0  # share of the pieces that best fit has placed


class Rooms:
    """Groups of identical sequences by free room; a content is a list of (length, copies)."""

    def __init__(self, capacity: int):
        self.capacity, self.groups = capacity, {}

    def open(self, content: list[tuple[int, int]], times: int) -> None:
        free = self.capacity - sum(n * k for n, k in content)
        self.groups.setdefault(free, []).append([content, times])

    def count(self) -> int:
        return sum(times for group in self.groups.values() for _, times in group)

    def best_fit(self, n: int, todo: int) -> None:
        """Place ``todo`` pieces of length ``n`` where the least room is left, groups of equal sequences together; open new ones for the rest."""
        while todo > 0:
            free = min((r for r in self.groups if r >= n), default=None)
            if free is None:
                fits = self.capacity // n
                for copies, times in ((fits, todo // fits), (todo % fits, 1)):
                    if copies and times:
                        self.open([(n, copies)], times)
                return
            group = self.groups[free][-1]
            content, times = group
            copies = max(1, min(free // n, todo // times))
            use = min(times, todo // copies)
            group[1] -= use
            if not group[1]:
                self.groups[free].pop()
                if not self.groups[free]:
                    del self.groups[free]
            self.open([*content, (n, copies)], use)
            todo -= use * copies


def best_fit_decreasing(left: dict[int, int], rooms: Rooms) -> Rooms:
    for n in sorted((n for n in left if left[n]), reverse=True):
        rooms.best_fit(n, left[n])
    return rooms


def take_whole(left: dict[int, int], capacity: int, sizes: np.ndarray, cover: list[tuple[np.ndarray, np.ndarray, float]], rooms: Rooms, slack: float = 0.01) -> bool:
    """Whole sequences from a fractional cover, the fullest configurations first and of these the ones with the largest amounts: each as often as its amount says, at least once, as far as its
    pieces last. Configurations that are emptier than the fullest one that could be taken, by more than ``slack``, wait for another program. Tells whether any was taken."""
    contents = sorted(((int((sizes[at] * copies).sum()), x, [(int(sizes[i]), int(k)) for i, k in zip(at[::-1], copies[::-1], strict=True)]) for at, copies, x in cover), key=lambda c: (-c[0], -c[1], c[2]))
    fullest = None
    for fill, x, content in contents:
        if fullest is not None and fill < fullest - slack * capacity:
            break
        times = min(max(1, int(x)), *(left[n] // k for n, k in content))
        if times > 0:
            fullest = fill if fullest is None else fullest
            for n, k in content:
                left[n] -= k * times
            rooms.open(content, times)
    return fullest is not None


def plan(histogram: dict[int, int], capacity: int, programs: int = 24, rest: float = 0.1) -> Plan:
    """Every length takes part in the program. Its fractional cover is rounded to whole sequences, and the pieces that are left make the next program, until a tenth of them (``rest``) is left or
    ``programs`` have been solved; then best fit decreasing places what is left, in the rooms there are. Should that be worse than plain best fit decreasing, the latter is taken instead."""
    if not any(histogram.values()):
        return Plan(*np.zeros((5, 0), np.int64), 0)
    left, rooms, total, bound = dict(histogram), Rooms(capacity), sum(histogram.values()), 0.0
    for k in range(programs):
        if sum(left.values()) <= rest * total:
            break
        sizes = np.array(sorted(n for n in left if left[n]), dtype=np.int64)
        taken = False
        # with more rounds the amounts are spread over more configurations
        for cover, least in fractional_covers(sizes, np.array([left[n] for n in sizes.tolist()], float), capacity, rounds=16):
            bound = bound if k else least
            taken = take_whole(left, capacity, sizes, cover, rooms)
            if taken:
                break
        if not taken:
            break
    share = sum(left.values()) / total
    best_fit_decreasing(left, rooms)
    plain = best_fit_decreasing(dict(histogram), Rooms(capacity))
    if plain.count() < rooms.count():
        rooms, share = plain, 1.0
    runs, taken, count = [], dict.fromkeys(histogram, 0), 0
    for group in rooms.groups.values():
        for content, times in group:
            at = 0
            for n, copies in content:
                runs.append((n, taken[n], copies, count, at))
                taken[n] += copies * times
                at += n * copies
            count += times
    cols = np.array(sorted(runs), dtype=np.int64).reshape(-1, 5).T
    return Plan(*cols, count, bound, share)


def pack(
    docs: DataFrame, tokenizer: str, capacity: int = 4096, id_col: str = "doc_id", text_col: str = "text", cache: int = CACHE
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null text is empty: one piece that holds the end id alone. Texts of over ``capacity`` ids are cut, the last piece may be shorter. Repeated rows are packed
    as often as they come, null identifiers too. An empty table gives no rows. ``cache`` bounds what a worker remembers of the tokenizer's answers; it changes the time only.
    """
    spark = docs.sparkSession
    cutup = cut(pieces(docs, tokenizer, capacity, id_col, text_col, cache), "pieces")
    per_part = cutup.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_part.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    histogram = {r["length"]: r["n"] for r in cutup.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most `capacity` rows
    found = spark.sparkContext.broadcast(plan(histogram, capacity))
    ranked = cutup.join(starts.drop("n"), ["part", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("before")).alias("rank")
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = found.value
        # one sorted key for (length, rank): both stay below 2**20 and 2**43
        key = (p.length << 43) + p.low
        for b in batches:
            n, r = b.column(3).to_numpy(), b.column(5).to_numpy()
            k = np.searchsorted(key, (n << 43) + r, side="right") - 1
            nth = r - p.low[k]
            seq, offset = p.seq[k] + nth // p.per[k], p.at[k] + nth % p.per[k] * n
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(seq), pa.array(offset)], names=[*b.schema.names[:5], "sequence_id", "offset"])

    kind = docs.schema[id_col].dataType.simpleString()
    return ranked.mapInArrow(place, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
