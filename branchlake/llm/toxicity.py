"""Toxicity scores from gradient-boosted trees over dense text features, with isotonic calibration.

Fitting uses a bounded sample of labelled rows (``sample``, by hash of the identifier). Each half of it learns a lexicon of words and word stems by log-odds,
and the other half's features are computed with that one, so the densities that the trees see are those of unseen texts; scoring uses the lexicon of both. Trees grow on
four fifths of the rows, the rest fit the calibration. Scoring reads every whole text once, in Arrow batches; only the text is an input.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from branchlake.llm.common import Scratch, hash_share, lean

# Second-person pronouns of the four languages.
SECOND_PERSON = frozenset("you your yours yourself tu te toi ton ta tes vous votre vos du dich dir dein deine ihr euch euer ti tú tus usted ustedes vosotros".split())
# Signs that stand for letters in disguised words.
DISGUISE = str.maketrans("013457@$!|", "oieastasil")
EDGE = ".,;:!?\"'()[]{}<>|*%#$…«»¡¿-_~`“”‘’/\\"
STEMS = (4, 5, 6)
NEAR = 5
FEATURES = 13


def plain(word: str) -> str:
    return word.strip(EDGE)


def terms_of(text: str) -> set[str]:
    """Words, and the stems of longer words marked with a star."""
    words = {plain(w) for w in text.lower().split()}
    words.discard("")
    return words | {w[:k] + "*" for w in words for k in STEMS if len(w) > k}


@lean
def term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, toxic, half) to a row per term with its texts: clean and toxic ones of either half."""
    counts = [Counter() for _ in range(4)]
    for b in batches:
        for text, label, half in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
            counts[2 * half + bool(label)].update(terms_of(text or ""))
    terms = list(set().union(*counts))
    yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), *(pa.array([c[t] for t in terms], pa.int64()) for c in counts)], names=["term", "c0", "t0", "c1", "t1"])


class Lexicon:
    """Weight of a word: its own, else its longest known stem's; disguised spellings are read through DISGUISE."""

    def __init__(self, weights: dict[str, float]):
        self.weights, self.memo = weights, {}

    def __reduce__(self):
        return Lexicon, (self.weights,)

    def __call__(self, raw: str) -> tuple[float, bool, bool]:
        """Weight, whether only undoing a disguise found it, whether the word mixes letters with other signs."""
        found = self.memo.get(raw)
        if found is None:
            if len(self.memo) > 100_000:
                self.memo.clear()
            word = plain(raw)
            mixed = len(word) > 2 and any(c.isalpha() for c in word) and not word.isalpha()
            value, undone = self._look(word), False
            if not value and mixed:
                value = self._look("".join(c for c in word.translate(DISGUISE) if c.isalpha()))
                undone = value > 0
            found = self.memo[raw] = (value, undone, mixed)
        return found

    def _look(self, word: str) -> float:
        w = self.weights
        value = w.get(word, 0.0)
        for k in reversed(STEMS):
            if value or len(word) <= k:
                continue
            value = w.get(word[:k] + "*", 0.0)
        return value


_CAPITALS, _MARKS, _STRESS, _RUNS = re.compile(r"[A-ZÀ-ÖØ-Þ]"), re.compile(r"[^\w\s]"), re.compile(r"[!?]"), re.compile(r"(\w)\1\1")


def features(text: str, lexicon: Lexicon) -> list[float]:
    words = text.lower().split()
    n, size = max(len(words), 1), max(len(text), 1)
    hits, you, total, top, undone, mixed, kinds = [], [], 0.0, 0.0, 0, 0, set()
    for i, w in enumerate(words):
        value, u, m = lexicon(w)
        mixed += m
        if value:
            hits.append(i)
            kinds.add(w)
            total += value
            undone += u
            top = max(top, value)
        elif w in SECOND_PERSON:
            you.append(i)
    near = 0
    if hits and you:  # both in order: a hit is near if a pronoun lies in its window
        spots, at = np.asarray(you), np.asarray(hits)
        near = int((np.searchsorted(spots, at + NEAR, side="right") > np.searchsorted(spots, at - NEAR)).sum())
    return [
        len(hits) / n,
        math.log1p(len(hits)),
        total / n,
        math.log1p(total),
        top,
        math.log1p(len(kinds)),
        near / n,
        len(you) / n,
        len(_CAPITALS.findall(text)) / size,
        len(_MARKS.findall(text)) / size,
        len(_STRESS.findall(text)) / size,
        (undone + 0.0) / n,
        (mixed + len(_RUNS.findall(text))) / n,
    ]


def bins_of(x: np.ndarray, edges: np.ndarray) -> np.ndarray:
    return np.stack([np.searchsorted(edges[j], x[:, j], side="right") for j in range(x.shape[1])], axis=1)


@dataclass
class Trees:
    """Binned gradient-boosted trees with logistic loss; a tree is arrays of (feature, bin, value) in heap order."""

    edges: np.ndarray
    base: float
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]]
    depth: int

    def margin(self, x: np.ndarray) -> np.ndarray:
        binned, out = bins_of(x, self.edges), np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, cut, value in self.trees:
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (binned[rows, feature[node]] > cut[node])
            out += value[node]
        return out


def grow(x: np.ndarray, y: np.ndarray, rounds: int = 80, depth: int = 3, rate: float = 0.15, bins: int = 32, ridge: float = 1.0) -> Trees:
    edges = np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1], axis=0).T
    binned = bins_of(x, edges)
    p0 = min(max(y.mean(), 1e-3), 1 - 1e-3)
    model = Trees(edges, math.log(p0 / (1 - p0)), [], depth)
    margin = np.full(len(y), model.base)
    inner = 2**depth - 1
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = y - p, p * (1 - p)
        feature, cut, value = np.zeros(2 * inner + 1, np.int64), np.full(2 * inner + 1, bins, np.int64), np.zeros(2 * inner + 1)
        node = np.zeros(len(y), np.int64)
        for at in range(inner):
            own = node == at
            if own.sum() >= 20:
                b, g, h = binned[own], grad[own], hess[own]
                best = 1e-6
                for j in range(x.shape[1]):
                    gs, hs = np.cumsum(np.bincount(b[:, j], g, bins)), np.cumsum(np.bincount(b[:, j], h, bins))
                    gain = gs**2 / (hs + ridge) + (gs[-1] - gs) ** 2 / (hs[-1] - hs + ridge) - gs[-1] ** 2 / (hs[-1] + ridge)
                    k = int(np.argmax(gain))
                    if gain[k] > best:
                        best, feature[at], cut[at] = gain[k], j, k
            node[own] = 2 * at + 1 + (binned[own, feature[at]] > cut[at])
        g, h = np.bincount(node, grad, 2 * inner + 1), np.bincount(node, hess, 2 * inner + 1)
        value[inner:] = rate * g[inner:] / (h[inner:] + ridge)
        margin += value[node]
        model.trees.append((feature, cut, value))
    return model


def isotonic(scores: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators; a monotone step function as (knots, values), read by linear interpolation."""
    order = np.argsort(scores, kind="stable")
    blocks: list[list[float]] = []  # mean, weight, lowest and highest score
    for s, v in zip(scores[order].tolist(), y[order].tolist(), strict=True):
        if blocks and blocks[-1][3] == s:
            b = blocks[-1]
            b[0], b[1] = (b[0] * b[1] + v) / (b[1] + 1), b[1] + 1
        else:
            blocks.append([v, 1.0, s, s])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v2, w2, _, hi = blocks.pop()
            b = blocks[-1]
            b[0], b[1], b[3] = (b[0] * b[1] + v2 * w2) / (b[1] + w2), b[1] + w2, hi
    knots, values = [], []
    for m, _, lo, hi in blocks:
        knots += [lo] if lo == hi else [lo, hi]
        values += [m] if lo == hi else [m, m]
    return np.array(knots or [0.0]), np.array(values or [0.0])


@dataclass
class Model:
    lexicon: Lexicon
    trees: Trees
    knots: np.ndarray
    values: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        """Calibrated probability; a thousandth of the raw one keeps the order within a flat step."""
        if not len(x):
            return np.zeros(0)
        margin = self.trees.margin(x)
        return 0.999 * np.interp(margin, self.knots, self.values) + 0.001 / (1 + np.exp(-margin))


def fit(docs: DataFrame, labels: DataFrame, sample: int = 20_000, terms: int = 5_000, least: int = 5, odds: float = 2.5) -> Model:
    """``docs`` (doc_id, text), ``labels`` (doc_id, toxic); rows without a label or text are left out.

    About ``sample`` labelled rows are used, chosen by hash, and at most ``terms`` lexicon entries. Without any labelled row of a class the model scores the base rate.
    """
    with Scratch() as scratch:
        return _fit(docs, labels, sample, terms, least, odds, scratch)


def _fit(docs: DataFrame, labels: DataFrame, sample: int, terms: int, least: int, odds: float, scratch: Scratch) -> Model:
    rows = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = F.xxhash64(F.col("doc_id").cast("string"), F.lit("toxicity"))
    chosen = rows.withColumn("o", order).where(hash_share(F.col("o"), sample, rows.count())).withColumn("fold", F.pmod(F.shiftright("o", 50), F.lit(10)))
    known = docs.select("doc_id", "text").join(F.broadcast(chosen.select("doc_id", "toxic", "fold")), "doc_id").where(F.col("text").isNotNull())
    known = scratch.cut(known.groupBy("doc_id", "toxic", "fold").agg(F.min("text").alias("text")), "labelled")  # one text for each identifier
    rows_ = known.select("text", (F.col("toxic") > 0).alias("toxic"), (F.col("fold") % 2).cast("int").alias("half"), F.floor(F.col("fold") / 2).cast("int").alias("fifth"))
    counts = rows_.mapInArrow(term_counts, "term string, c0 long, t0 long, c1 long, t1 long").groupBy("term").agg(*[F.sum(c).alias(c) for c in ("c0", "t0", "c1", "t1")])
    counts = scratch.cut(counts.where(F.col("t0") + F.col("t1") >= min(least, 3)), "terms")
    size = {(r["half"], r["toxic"]): r["n"] for r in rows_.groupBy("half", "toxic").agg(F.count(F.lit(1)).alias("n")).collect()}

    def lexicon_of(halves: tuple[int, ...]) -> Lexicon:
        a, b = (sum((F.col(f"{k}{h}") for h in halves), F.lit(0)) for k in ("t", "c"))
        na, nb = (sum(size.get((h, k), 0) for h in halves) for k in (True, False))
        weight = F.log((a + 0.5) / (na + 1)) - F.log((b + 0.5) / (nb + 1))
        enough = least if len(halves) > 1 else max(2, least // 2)
        top = counts.where(a >= enough).select("term", weight.alias("w"), a.alias("a")).where(F.col("w") >= odds).orderBy(F.desc(F.col("w") * F.sqrt("a")), "term").limit(terms)
        return Lexicon({r["term"]: float(r["w"]) for r in top.collect()})

    lexicon, other = lexicon_of((0, 1)), {0: lexicon_of((1,)), 1: lexicon_of((0,))}

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [features(t, other[h]) for t, h in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), b.column(1), b.column(3)], names=["x", "toxic", "fifth"])

    got = rows_.mapInArrow(lean(vectors), "x array<double>, toxic boolean, fifth int").orderBy("x", "toxic").collect()
    x, y = np.array([r["x"] for r in got]).reshape(-1, FEATURES), np.array([float(r["toxic"]) for r in got])
    calib = np.array([r["fifth"] == 4 for r in got], dtype=bool)
    if not len(y) or y.min() == y.max() or calib.all() or not calib.any():
        rate = float(y.mean()) if len(y) else 0.0
        return Model(lexicon, Trees(np.zeros((FEATURES, 1)), 0.0, [], 3), np.array([0.0]), np.array([rate]))
    trees = grow(x[~calib], y[~calib])
    return Model(lexicon, trees, *isotonic(trees.margin(x[calib]), y[calib]))


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The input's columns plus score double; a column of that name is replaced. Null and empty texts get the score of an empty text."""
    docs = docs.drop("score")
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([features(t or "", model.lexicon) for t in b.column(at).to_pylist()]).reshape(-1, FEATURES)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(model.score(x), pa.float64())], names=[*b.schema.names, "score"])

    kinds = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(lean(run), f"{kinds}, score double")

