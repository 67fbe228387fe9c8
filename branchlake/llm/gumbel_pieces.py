"""Distinct sampled segmentations into pieces, by Gumbel top-k without replacement.

The lattice of a text is a chain of the lattices of its words, because no piece holds a space after another character. A backward pass gives every node the mass of
its ways to the end. The tree of segmentations is then searched best-first by perturbed log-probabilities: a region is all segmentations that leave a known
one at a given piece, its bound is the largest Gumbel-perturbed value inside, drawn exactly (a Gumbel of the region's mass, truncated at its parent's value), and
the best region is opened by drawing its segmentation. So the k results are the k largest perturbed values of all segmentations, that is a
sample without replacement, and the best bound left over is the threshold of the inclusion scores.

Random numbers are hashes of (row key, sample, word, step), so a row's samples depend on nothing but its key, its text and the seed.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
_WORDS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
_P = np.uint64(0x9E3779B97F4A7C15)
#: with no more characters than this before a word's end, only so many lengths are looked at
NEAR = 6


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hashed(*keys: np.ndarray | int) -> np.ndarray:
    h = np.zeros(1, np.uint64)
    with np.errstate(over="ignore"):  # arithmetic modulo 2**64
        for k in keys:
            h = mix(h + (_P + np.asarray(k).astype(np.uint64)))
    return h if any(np.ndim(k) for k in keys) else h[0]


def unit(h: np.ndarray) -> np.ndarray:
    """Hashes as numbers in (0, 1)."""
    return ((h >> np.uint64(11)).astype(float) + 0.5) / 2.0**53


def uniform(*keys: np.ndarray | int) -> np.ndarray:
    """Numbers in (0, 1) from integer keys."""
    return unit(hashed(*keys))


def gumbel(u: np.ndarray) -> np.ndarray:
    return -np.log(-np.log(u))


def below(bound: np.ndarray, mean: np.ndarray, u: np.ndarray) -> np.ndarray:
    """A Gumbel of location ``mean`` given that it is below ``bound``; minus infinity for an empty region."""
    with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
        v = -(mean + gumbel(u))
        out = -np.logaddexp(-bound, v)
    return np.where(np.isneginf(mean), -np.inf, out)


class Vocabulary:
    """Pieces by length, with log-probabilities: the scores of a unigram model, or a Zipf law over the ranks of a BPE model."""

    def __init__(self, path: str):
        import sentencepiece

        sp = self.processor = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.vocab_size()
        usable = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        score = np.array([sp.get_score(i) for i in usable])
        if len(score) and score.min() < -1000:  # merge ranks, not log-probabilities
            score = -np.log(np.argsort(np.argsort(-score, kind="stable"), kind="stable") + 10.0)
            score -= np.log(np.exp(score).sum())
        self.bytes_ = np.array([next((i for i in [sp.piece_to_id(f"<0x{b:02X}>")] if sp.is_byte(i)), sp.unk_id()) for b in range(256)], dtype=np.int64)
        self.text = [sp.id_to_piece(i).replace(SPACE, " ").encode() for i in range(n)]
        for b, i in enumerate(self.bytes_):
            self.text[i] = bytes([b])
        self.byte_score = float(score.min()) - 1.0 if len(score) else -10.0
        by: dict[int, list] = {}
        for i, s in zip(usable, score, strict=True):
            piece = sp.id_to_piece(i)
            by.setdefault(len(piece), []).append((int(self._hash(piece)), i, s))
        self.longest = max(by, default=1)
        self.tables, self.maybe = {}, np.zeros(1 << 22, bool)  # top bits of the hashes of all pieces
        for k, rows in by.items():
            rows.sort()
            self.tables[k] = (np.array([r[0] for r in rows], np.uint64), np.array([r[1] for r in rows], np.int64), np.array([r[2] for r in rows]))
            self.maybe[self.tables[k][0] >> np.uint64(42)] = True

    @staticmethod
    def _hash(piece: str) -> np.uint64:
        h = 0
        for c in piece:
            h = (h * int(_P) + ord(c) + 1) % 2**64
        return np.uint64(h)


@dataclass
class Lattices:
    """Of many words at once. Characters are numbered through; each has a cell per piece length, next to each other from ``place`` on."""

    first: np.ndarray  # each word's first character
    last: np.ndarray  # the one after its last
    chars: np.ndarray
    place: np.ndarray  # first cell of each character
    ids: np.ndarray  # cells: -1 none, -2 bytes of the character
    cdf: np.ndarray  # cells: chance that the next piece has this length or less


def lattices(words: list[str], vocab: Vocabulary) -> Lattices:
    size = np.array([len(w) for w in words], dtype=np.int64)
    chars = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    last = np.cumsum(size)
    first, n, wide = last - size, len(chars), vocab.longest
    left = np.repeat(last, size) - np.arange(n)  # characters to the word's end
    # cells are in order of that distance, so that those of one distance are a table
    order = np.argsort(left, kind="stable")
    cells = np.minimum(left[order], wide)
    at = np.cumsum(cells) - cells
    place = np.empty(n, np.int64)
    place[order] = at
    edges = np.searchsorted(left[order], np.arange(1, (left.max() if n else 0) + 2))
    total = int(cells.sum())
    ids, weight = np.full(total, -1, np.int32), np.full(total, -np.inf)
    codes = chars.astype(np.uint64) + np.uint64(1)
    h, low = np.zeros(n, np.uint64), 0
    for k in range(1, min(wide, len(edges) - 1) + 1):
        more, low = edges[k - 1] - low, edges[k - 1]
        h = h[more:] * _P + codes[order[low:] + (k - 1)]
        if k in vocab.tables:
            hashes, own, score = vocab.tables[k]
            some = np.flatnonzero(vocab.maybe[h >> np.uint64(42)])
            wanted = h[some]
            spot = np.searchsorted(hashes, wanted)
            spot[spot == len(hashes)] = 0
            hit = np.flatnonzero(hashes[spot] == wanted)
            cell, spot = at[low + some[hit]] + (k - 1), spot[hit]
            ids[cell], weight[cell] = own[spot], score[spot]
    bare = np.flatnonzero(ids[at] == -1)
    c = chars[order[bare]]
    ids[at[bare]] = -2
    weight[at[bare]] = vocab.byte_score * (1 + (c > 0x7F) + (c > 0x7FF) + (c > 0xFFFF))
    mass = np.zeros(n + 1)
    for j, (lo, hi) in enumerate(zip(edges, edges[1:], strict=False), 1):
        if lo == hi:
            continue
        own, w, m = order[lo:hi], min(j, wide), hi - lo
        table = weight[at[lo] : at[lo] + w * m].reshape(m, w)
        x = table.T.copy()  # by length, so that what follows runs along the characters
        for k in range(w - (w == j)):  # the longest piece ends the word: mass 1, whatever character follows
            x[k] += mass[own + (k + 1)]
        top = x.max(axis=0)
        x -= top
        np.exp(x, out=x)
        np.cumsum(x, axis=0, out=x)
        mass[own] = top + np.log(x[-1])
        x /= x[-1].copy()
        x[-1] = 1.0
        table[:] = x.T
    return Lattices(first, last, chars, place, ids, weight)


class Index(dict):
    """Numbers words as it meets them; ``new`` lists those without a lattice yet."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        self.new.append(word)
        return n


class Store:
    """Lattices of the words a worker has seen, in arrays that double; forgotten together once they hold ``limit`` cells."""

    def __init__(self, vocab: Vocabulary, limit: int = 12_000_000):
        self.vocab, self.limit, self.index, self.words, self.rows, self.cells = vocab, limit, Index(), 0, 0, 0
        self.all = lattices([], vocab)

    def find(self, words: list[str]) -> tuple[np.ndarray, Lattices]:
        """The word numbers, and lattices that hold them until the next call."""
        if self.cells > self.limit:
            self.words = self.rows = self.cells = 0
            self.index = Index()
        numbers = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        new, self.index.new = self.index.new, []
        if new:
            own = lattices(new, self.vocab)
            own.first += self.rows
            own.last += self.rows
            own.place += self.cells
            for names, low in ((("first", "last"), self.words), (("chars", "place"), self.rows), (("ids", "cdf"), self.cells)):
                for name in names:
                    setattr(self.all, name, _grown(getattr(self.all, name), low, getattr(own, name), self.vocab.longest))
            self.words, self.rows, self.cells = self.words + len(new), self.rows + len(own.chars), self.cells + len(own.ids)
        return numbers, self.all


def _grown(a: np.ndarray, low: int, more: np.ndarray, spare: int) -> np.ndarray:
    """``more`` written from ``low`` on; ``spare`` places stay behind it, so that a row may be read wider than it is."""
    if len(a) < low + len(more) + spare:
        a, old = np.zeros(2 * (low + len(more)) + spare, a.dtype), a
        a[:low] = old[:low]
    a[low : low + len(more)] = more
    return a


def rows_at(cells: np.ndarray, at: np.ndarray, wide: int) -> np.ndarray:
    """``wide`` cells from each of ``at`` on."""
    return np.lib.stride_tricks.as_strided(cells, (len(cells) - wide + 1, wide), cells.strides * 2, writeable=False)[at]


@dataclass
class Pieces:
    """The pieces of many walks, those of a walk in order next to each other."""

    walk: np.ndarray
    row: np.ndarray  # first character
    length: np.ndarray
    id: np.ndarray  # as in the lattice
    logp: np.ndarray  # log of the chance of this length there


def walk(lat: Lattices, row: np.ndarray, last: np.ndarray, keys: np.ndarray, longest: int) -> Pieces:
    """Draw a way from each ``row`` to ``last``; ``keys`` are hashes, a step adds its number to them."""
    who, now, end, key, out = np.arange(len(row)), row, last, keys, []
    step = 0
    while len(who):
        live = np.flatnonzero(now < end)
        if len(live) < len(who):
            who, now, end, key = who[live], now[live], end[live], key[live]
        u, at = unit(mix(key + np.uint64((step + 1) * int(_P) % 2**64))), lat.place[now]
        length, p = np.ones(len(now), np.int64), np.empty(len(now))
        near = end - now <= NEAR
        for some, wide in ((np.flatnonzero(near), min(NEAR, longest)), (np.flatnonzero(~near), longest)):
            c, v, under = rows_at(lat.cdf, at[some], wide), u[some], np.zeros(len(some))
            k, on = np.ones(len(some), np.int64), np.ones(len(some), bool)
            for j in range(wide - 1):  # as long as the chance so far is below v; what lies behind a row's end comes after a 1
                on &= c[:, j] <= v
                if not on.any():
                    break
                np.copyto(under, c[:, j], where=on)
                k += on
            length[some], p[some] = k, c[np.arange(len(some)), k - 1] - under
        out.append((who, np.full(len(who), step), now, length, at, p))
        now = now + length
        step += 1
    if not out:
        return Pieces(*(np.zeros(0, np.int64),) * 4, np.zeros(0))
    w, s, *cols = (np.concatenate(x) for x in zip(*out, strict=True))
    count = np.bincount(w, minlength=len(row))
    to = np.empty(len(w), np.int64)
    to[(np.cumsum(count) - count)[w] + s] = np.arange(len(w))  # a walk's steps come one after another
    r, k, at, p = (c[to] for c in cols)
    return Pieces(np.repeat(np.arange(len(row)), count), r, k, lat.ids[at + (k - 1)], np.log(p))


@dataclass
class Way:
    """A segmentation: word position, first character, length, lattice id and log-probability of its pieces; its perturbed value."""

    word: np.ndarray
    row: np.ndarray
    length: np.ndarray
    id: np.ndarray
    logp: np.ndarray
    value: float


def sample_batch(texts: list[str], keys: list, store: Store, k: int, seed: int) -> list[tuple[list[Way], float, "Lattices"]]:
    """For each text its ``k`` segmentations (fewer if there are no more), best perturbed value first, and the threshold."""
    spans, flat = [0], []
    for t in texts:
        if t:
            plain = "  " not in t and SPACE not in t and t[-1] != " "
            flat += map(SPACE.__add__, t.split(" ")) if plain and t[0] != " " else _WORDS.findall(SPACE + t.replace(" ", SPACE))
        spans.append(len(flat))
    (word, lat), longest = store.find(flat), store.vocab.longest
    seeds = np.array([xxhash.xxh3_64_intdigest(repr((seed, x)).encode()) for x in keys], np.uint64)
    span = np.array(spans)
    doc = np.repeat(np.arange(len(texts)), np.diff(span))
    place = np.arange(len(word)) - span[doc] if len(word) else np.zeros(0, np.int64)
    got = walk(lat, lat.first[word], lat.last[word], _word_keys(seeds, 0, doc, place), longest)
    of = doc[got.walk] if len(doc) else got.walk
    cuts = np.searchsorted(of, np.arange(len(texts) + 1))
    values = gumbel(uniform(seeds, 1_000_003))
    ways: list[list[Way]] = []
    # open regions of each text: (bound, way, piece, lengths already used there)
    regions: list[list[tuple]] = []
    step = np.arange(len(of)) - cuts[of] if len(of) else of
    # sums within each text, so that rounding does not depend on its neighbours in the batch
    before = np.concatenate([_sums_before(got.logp[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)] or [got.logp])
    bounds = _bounds(values[of], before, got.logp, uniform(seeds[of], 4_000_003, step))
    where = place[got.walk] if len(place) else got.walk
    for i in range(len(texts)):
        s = slice(cuts[i], cuts[i + 1])
        ways.append([Way(where[s], got.row[s], got.length[s], got.id[s], got.logp[s], float(values[i]))])
        regions.append([(bounds[s], ways[i][0], 0, None)] if cuts[i + 1] > cuts[i] else [])
    for r in range(1, k):
        todo = [(i, *found) for i in range(len(texts)) if (found := _best(regions[i])) is not None]
        if not todo:
            break
        who = np.array([t[0] for t in todo])
        draw, means = uniform(seeds[who], 2_000_003 + r), []
        starts, ends, owner, places, heads = [], [], [], [], []
        for n, (i, _, way, piece, used) in enumerate(todo):
            at, here = int(way.row[piece]), int(way.word[piece])
            cell = int(lat.place[at])
            p = np.diff(lat.cdf[cell : cell + min(longest, int(lat.last[word[span[i] + here]]) - at)], prepend=0.0)
            p[[u - 1 for u in used]] = 0.0
            c = np.cumsum(p)
            new = int(min(np.searchsorted(c, draw[n] * c[-1], side="right"), len(c) - 1)) + 1
            own = word[span[i] + here : span[i + 1]]
            starts += [[at + new], lat.first[own[1:]]]
            ends.append(lat.last[own])
            owner.append(np.full(len(own), n))
            places.append(np.arange(here, here + len(own)))
            heads.append((new, float(p[new - 1])))
            # what stays of the region, under the value that has just left it
            mass = c[-1] - p[new - 1]
            means.append(float(way.logp[:piece].sum()) + math.log(mass) if mass > 1e-300 and np.count_nonzero(p) > 1 else -np.inf)
        rest = below(np.array([t[1] for t in todo]), np.array(means), uniform(seeds[who], 3_000_003 + r))
        own, at_place = np.concatenate(owner), np.concatenate(places)
        more = walk(lat, np.concatenate(starts), np.concatenate(ends), _word_keys(seeds[who], r, own, at_place), longest)
        cuts2 = np.searchsorted(own[more.walk], np.arange(len(todo) + 1))
        where, spans2 = at_place[more.walk], [0]
        sums, logps = [], []
        for n, (i, bound, way, piece, used) in enumerate(todo):
            s, (new, p) = slice(cuts2[n], cuts2[n + 1]), heads[n]
            mine = (slice(0, piece), slice(piece, piece + 1))
            first = lat.ids[lat.place[way.row[piece]] + (new - 1)]
            made = Way(
                np.concatenate([way.word[mine[0]], way.word[mine[1]], where[s]]), np.concatenate([way.row[mine[0]], way.row[mine[1]], more.row[s]]), np.concatenate([way.length[mine[0]], [new], more.length[s]]),
                np.concatenate([way.id[mine[0]], [first], more.id[s]]), np.concatenate([way.logp[mine[0]], [math.log(p)], more.logp[s]]), bound,
            )
            ways[i].append(made)
            regions[i].append((float(rest[n]), way, piece, (*used, new)))
            sums.append(_sums_before(made.logp)[piece + 1 :])
            logps.append(made.logp[piece + 1 :])
            spans2.append(spans2[-1] + len(logps[-1]))
        size = np.diff(spans2)
        step = np.arange(spans2[-1]) - np.repeat(spans2[:-1], size) + np.repeat([t[3] + 1 for t in todo], size)
        bounds = _bounds(np.repeat([t[1] for t in todo], size), np.concatenate(sums), np.concatenate(logps), uniform(np.repeat(seeds[who], size), 4_000_003 + r, step))
        for n, (i, _, _, piece, _) in enumerate(todo):
            if size[n]:
                regions[i].append((bounds[spans2[n] : spans2[n + 1]], ways[i][-1], piece + 1, None))
    return [(w, max((x[0] if isinstance(x[0], float) else float(x[0].max(initial=-np.inf)) for x in g), default=-np.inf), lat) for w, g in zip(ways, regions, strict=True)]


def _word_keys(seeds: np.ndarray, r: int, text: np.ndarray, place: np.ndarray) -> np.ndarray:
    """A hash per word, of its text's seed, the sample and its place."""
    return mix(hashed(seeds, r)[text] + _P * place.astype(np.uint64)) if len(text) else np.zeros(0, np.uint64)


def _sums_before(logp: np.ndarray) -> np.ndarray:
    """Log-probability up to each piece."""
    out = np.zeros(len(logp))
    np.cumsum(logp[:-1], out=out[1:])
    return out


def _bounds(value: np.ndarray, before: np.ndarray, logp: np.ndarray, u: np.ndarray) -> np.ndarray:
    """The largest perturbed value of each region that leaves a way at a piece; ``before``: log-probability up to there."""
    with np.errstate(divide="ignore"):
        mean = before + np.log(np.where(logp > -1e-13, 0.0, -np.expm1(logp)))
    return below(np.asarray(value), mean, u)


def _best(regions: list[tuple]) -> tuple | None:
    """Take the region of the largest bound out; (bound, way, piece, lengths used there)."""
    best, where = -np.inf, None
    for n, (bound, *_rest) in enumerate(regions):
        top = bound if isinstance(bound, float) else float(bound.max())
        if top > best:
            best, where = top, n
    if where is None:
        return None
    bound, way, piece, used = regions[where]
    if isinstance(bound, float):
        regions.pop(where)
        return best, way, piece, used
    j = int(bound.argmax())
    bound[j] = -np.inf
    return best, way, piece + j, (int(way.length[piece + j]),)


def ids_of(way: Way, lat: Lattices, vocab: Vocabulary) -> np.ndarray:
    ids = way.id.astype(np.int64)
    bare = np.flatnonzero(ids < 0)
    if not len(bare):
        return ids
    chars = lat.chars[way.row[bare]]
    ids[bare] = vocab.bytes_[np.minimum(chars, 0x7F)]
    wide = bare[chars > 0x7F]
    if not len(wide):
        return ids
    more = [vocab.bytes_[list(chr(c).encode())] for c in chars[chars > 0x7F]]
    parts = np.split(ids, np.stack([wide, wide + 1], axis=1).ravel())
    parts[1::2] = more
    return np.concatenate(parts)


def decode(ids: np.ndarray, vocab: Vocabulary) -> str:
    """The text of piece ids: spaces for their marks, without the one that encoding puts in front."""
    return raw_text(ids, vocab).decode("utf-8", "replace")


def raw_text(ids: np.ndarray, vocab: Vocabulary) -> bytes:
    return b"".join(map(vocab.text.__getitem__, ids.tolist())).removeprefix(b" ")


def log_inclusion(logp: float, threshold: float) -> float:
    """log of 1 - exp(-exp(logp - threshold)): the chance that the perturbed value passes the threshold."""
    d = logp - threshold
    if d == math.inf or d > 3.6:
        return 0.0
    return d if d < -30 else math.log(-math.expm1(-math.exp(d)))


_STORES: dict[str, Store] = {}


def store_of(path: str) -> Store:
    """One per Python worker, so that its tasks share the words they have seen."""
    if path not in _STORES:
        _STORES[path] = Store(Vocabulary(path))
    return _STORES[path]


SAMPLE = "struct<ids:array<int>,log_prob:double,perturbed:double,log_inclusion:double>"


def encode(docs: DataFrame, model: str, k: int, seed: int = 0, id_col: str = "doc_id", text_col: str = "text", digest: bool = False) -> DataFrame:
    """The row key plus samples: array of (ids, log_prob, perturbed, log_inclusion), largest perturbed value first, all different.

    Null and empty texts have one segmentation, the empty one. A text with fewer than ``k`` segmentations returns them all, with inclusion 1. Rows of one key and text
    get equal samples. Texts may be of any length. With ``digest`` the ids are
    replaced by n_pieces, ids_crc32 (little-endian unsigned 32-bit) and decoded_crc32, of the UTF-8 text that they decode to.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = store_of(model)
        vocab = store.vocab
        for b in batches:
            for low in range(0, b.num_rows, 256):
                keys = b.column(0).slice(low, 256)
                texts = [t or "" for t in b.column(1).slice(low, 256).to_pylist()]
                rows = []
                for ways, threshold, lat in sample_batch(texts, keys.to_pylist(), store, k, seed):
                    mine = []
                    for w in ways:
                        ids, logp = ids_of(w, lat, vocab), float(w.logp.sum())
                        one = {"log_prob": logp, "perturbed": w.value, "log_inclusion": log_inclusion(logp, threshold)}
                        if digest:
                            one |= {"n_pieces": len(ids), "ids_crc32": zlib.crc32(ids.astype("<u4").tobytes()), "decoded_crc32": zlib.crc32(raw_text(ids, vocab))}
                        else:
                            one["ids"] = ids
                        mine.append(one)
                    rows.append(mine)
                yield pa.RecordBatch.from_arrays([keys, pa.array(rows, arrow)], names=["key", "samples"])

    numbers = [("log_prob", pa.float64()), ("perturbed", pa.float64()), ("log_inclusion", pa.float64())]
    if digest:
        arrow = pa.list_(pa.struct([("n_pieces", pa.int64()), ("ids_crc32", pa.int64()), ("decoded_crc32", pa.int64()), *numbers]))
        spark_kind = "array<struct<n_pieces:bigint,ids_crc32:bigint,decoded_crc32:bigint,log_prob:double,perturbed:double,log_inclusion:double>>"
    else:
        arrow, spark_kind = pa.list_(pa.struct([("ids", pa.list_(pa.int32())), *numbers])), f"array<{SAMPLE}>"
    return docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("text")).mapInArrow(run, f"key {kind}, samples {spark_kind}")


def decode_rows(rows: DataFrame, model: str, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """The input's columns plus the text of ``ids_col``; null ids give null, no ids the empty text. A column of that name is replaced."""
    rows = rows.drop(text_col)
    at = rows.columns.index(ids_col)
    kinds = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in rows.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = store_of(model).vocab
        for b in batches:
            out = [None if x is None else decode(np.array(x, np.int64), vocab) for x in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.string())], names=[*b.schema.names, text_col])

    return rows.mapInArrow(run, f"{kinds}, {text_col} string")
