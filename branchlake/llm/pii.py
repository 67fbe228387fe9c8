"""Personal data: exact base patterns plus spans that a linear-chain conditional random field adds.

The field works on segments: runs of tokens that hold a digit, "@" or "+", with one plain token of context on either side. Labels are OUT, and the first and further tokens of each kind. Features are the word
shapes of a token and its neighbours. Weights are learnt by gradient ascent on the exact log-likelihood (forward-backward) from a small written table of labelled lines (``LINES``), which holds
forms that the base patterns miss and look-alikes that are no personal data. Texts are decoded by Viterbi on numpy batches of segments of similar length. A decoded span counts
if the chain's probability of the whole span is high and it overlaps no base span.
"""

from __future__ import annotations

import random
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from branchlake.llm.common import WHITE, lean

KINDS = ("email", "ip", "card", "phone")
#: OUT, then the first token of a span of each kind and its further ones
LABELS = ("out", *(f"{part} {kind}" for kind in KINDS for part in ("first", "more")))
BUCKETS = 1 << 14

# The base patterns.
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGIT = re.compile("[0-9]")

Span = tuple[int, int, int]  # kind, start, end
#: least probability of an added span
SURE = 0.9
#: tokens of a segment decoded together; a longer one is cut into windows that look LAP tokens beyond either end
WINDOW, LAP = 512, 16
#: tokens whose features are held at once
HELD_TOKENS = 20_000


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping addresses: walk back from each "@", so long runs of letters cost nothing."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            out.append((start, domain.end()))
            done = domain.end()
        else:
            done = at + 1
        at = text.find("@", done)
    return out


def quads(dotted: str, at: int) -> list[tuple[int, int]]:
    """Four numbers at a time of a whole run of dotted numbers, those of at most 255 each; no digit is looked at again."""
    out, parts = [], dotted.split(".")
    for i in range(0, len(parts) - 3, 4):
        own = parts[i : i + 4]
        size = sum(map(len, own)) + 3
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in own):
            out.append((at, at + size))
        at += size + 1
    return out


def base_spans(text: str) -> list[Span]:
    out: list[Span] = [(0, s, e) for s, e in emails(text)]
    if not _DIGIT.search(text):
        return out
    if "." in text:
        out += [(1, s, e) for m in _DOTTED.finditer(text) if m[0].count(".") >= 3 for s, e in quads(m[0], m.start())]
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    if "+" in text:
        out += [(3, *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_DIGIT.findall(m[0])) <= 15]
    return out


_MARK = re.compile("[0-9@+]")
_REST = re.compile(r"[^\x20\x09-\x0D]*")
_NEXT = re.compile(r"[\x20\x09-\x0D]{1,2}([^\x20\x09-\x0D]+)")
_TABLE = str.maketrans({c: ("0" if c.isdigit() else "a" if c.islower() else "A") for c in map(chr, range(128)) if c.isalnum()})
_RUN = re.compile(r"(.)\1+")
_HEX_WORD = re.compile("(?:[0-9a-f]{0,4}:){2,7}[0-9a-f]{1,4}")
#: white space between tokens of one segment
GAP = 2


def shape(word: str) -> str:
    """Letters to a or A, digits to 0; runs of digits with their length up to 20, other runs as such."""
    return _RUN.sub(lambda m: m[1] + (str(min(len(m[0]), 20)) if m[1] == "0" else "*"), word.translate(_TABLE))


def bucket(feature: str) -> int:
    return zlib.crc32(feature.encode("utf-8", "replace")) % BUCKETS


def segments(text: str) -> list[list[tuple[int, int]]]:
    """Runs of neighbouring tokens (start, end): marked ones and the plain ones next to them. Every character is passed a fixed number of times, however long the tokens are."""
    out: list[list[tuple[int, int]]] = []
    done = 0  # end of the last token taken

    def take(start: int, end: int) -> None:
        nonlocal done
        if out and start - done <= GAP:
            out[-1].append((start, end))
        else:
            out.append([(start, end)])
        done = end

    def begin(at: int) -> int:
        """Where the token that ends at ``at`` begins."""
        return max(done, *(text.rfind(c, done, at) + 1 for c in WHITE))

    while m := _MARK.search(text, done):
        s, e = begin(m.start()), _REST.match(text, m.end()).end()
        k = s
        while k > done and s - k <= GAP and text[k - 1] in WHITE:
            k -= 1
        if done < k < s <= k + GAP:
            take(begin(k), k)
        take(s, e)
        after = _NEXT.match(text, e)
        if after and not _MARK.search(text, after.start(1), after.end(1)):
            take(*after.span(1))
    return out


_EDGES = ".,;!?\"'"
#: features that know a token's exact shape; half of the fillings are learnt without them
EXACT = (1, 2, 5, 6)


class Featurizer:
    """Hashed features of the tokens of a segment; those of short words are remembered."""

    def __init__(self):
        self.known: dict[str, tuple[str, ...]] = {}

    def _parts(self, word: str) -> tuple[str, ...]:
        found = self.known.get(word)
        if found is None:
            inner = word.strip(_EDGES) or word
            tail = word[len(word.rstrip(_EDGES)) :][:2] if inner != word else ""
            full = shape(inner)
            digits = "".join(c for c in word if "0" <= c <= "9")
            colons = "h" if _HEX_WORD.fullmatch(inner) else ""
            sum_ = "" if not 13 <= len(digits) <= 19 else "valid" if luhn(digits) else "invalid"
            flags = f"{'@' in inner}{'+' in inner}{min(inner.count('.'), 4)}{min(inner.count('-'), 4)}{min(inner.count(':'), 4)}{'(' in inner}{colons}"
            rough = re.sub("0[0-9]*", "0", full)
            signs = "".join(dict.fromkeys(c for c in inner if not c.isalnum())) + colons
            at = f"{word[:1] == '@'}{word[-1:] == '@'}{len(word)}" if len(word) < 3 or "@" in (word[0], word[-1]) else str("@" in word)
            few = str(len(digits)) if len(digits) < 5 else "5-8" if len(digits) < 9 else "9-15" if len(digits) < 16 else "16" if len(digits) == 16 else "more"
            found = full, rough, flags, f"{min(len(digits), 20)}{sum_}{tail}", signs, at, f"{few}{sum_}{'l' if any(c.isalpha() for c in word) else ''}"
            if len(word) <= 64:
                if len(self.known) > 100_000:
                    self.known.clear()
                self.known[word] = found
        return found

    def __call__(self, text: str, seg: list[tuple[int, int]]) -> list[list[int]]:
        parts = [self._parts(text[s:e]) for s, e in seg]
        rows = []
        none = ("^",) * 7
        for i, (full, rough, flags, digits, signs, at, few) in enumerate(parts):
            before, after = parts[i - 1] if i else none, parts[i + 1] if i + 1 < len(parts) else none
            rows.append(
                [0, *map(bucket, (
                    "s" + full, "r" + rough, "f" + flags, "n" + digits, f"b{before[0]}|{rough}", f"a{rough}|{after[0]}", f"d{digits}|{flags}", "p" + signs, f"q{signs}|{few}", f"@{before[5]}|{at}|{after[5]}",
                    f"B{before[6]}{before[4]}|{few}{signs}", f"A{few}{signs}|{after[6]}{after[4]}",
                ))]
            )
        return rows


def label_segment(seg: list[tuple[int, int]], spans: list[Span]) -> list[int]:
    out, last = [], None
    for s, e in seg:
        own = next((x for x in spans if x[1] < e and s < x[2]), None)
        out.append(0 if own is None else 2 * own[0] + (2 if own == last else 1))
        last = own
    return out


@dataclass
class Field:
    emit: np.ndarray  # BUCKETS x labels
    move: np.ndarray  # labels x labels

    def decode(self, feats: list[list[list[int]]]) -> list[list[tuple[int, int, int, float]]]:
        """Per segment the spans of its best path: (kind, first token, last token, the chain's probability of all their labels). Segments are padded together by length class."""
        out: list = [None] * len(feats)
        order = sorted(range(len(feats)), key=lambda i: len(feats[i]))
        low = 0
        while low < len(order):
            # no more than twice the shortest, so that padding stays small
            high = low + 1
            while high < min(len(order), low + 512) and len(feats[order[high]]) <= 2 * len(feats[order[low]]):
                high += 1
            for i, r in zip(order[low:high], self._runs([feats[i] for i in order[low:high]]), strict=True):
                out[i] = r
            low = high
        return out

    def scores(self, feats: list[list[list[int]]]) -> tuple[np.ndarray, np.ndarray]:
        """(emission scores padded to the longest segment, lengths)."""
        size = np.array([len(f) for f in feats])
        score = np.zeros((len(feats), size.max(), len(LABELS)))
        score[np.arange(size.max()) < size[:, None]] = self.emit[np.concatenate([np.array(f) for f in feats])].sum(1)
        return score, size

    def paths(self, score: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Viterbi: the best labels; what lies behind a segment's end is 0."""
        n, steps, _ = score.shape
        back, best = np.zeros(score.shape, np.int8), score[:, 0].copy()
        for t in range(1, steps):
            via = best[:, :, None] + self.move
            back[:, t] = via.argmax(1)
            best = np.where((size > t)[:, None], via.max(1) + score[:, t], best)
        path = np.zeros((n, steps), np.int64)
        now = best.argmax(1)
        for t in range(steps - 1, -1, -1):
            path[:, t] = np.where(size > t, now, 0)
            now = np.where(size > t, back[np.arange(n), t, now], now) if t else now
        return path

    def _runs(self, feats):
        score, size = self.scores(feats)
        path = self.paths(score, size)
        # forward and backward chances, scaled to a sum of 1 in each step; beyond a segment's end nothing changes
        n, steps, _ = score.shape
        move, emit = np.exp(self.move), np.exp(score - score.max(axis=2, keepdims=True))
        a, b, c = np.zeros(score.shape), np.ones(score.shape), np.ones((n, steps))
        live = (np.arange(steps) < size[:, None])[:, :, None]
        for t in range(steps):
            now = emit[:, 0] if not t else np.where(live[:, t], (a[:, t - 1] @ move) * emit[:, t], a[:, t - 1])
            c[:, t] = now.sum(axis=1)
            a[:, t] = now / c[:, t, None]
        for t in range(steps - 2, -1, -1):
            b[:, t] = np.where(live[:, t + 1], (emit[:, t + 1] * b[:, t + 1]) @ move.T / c[:, t + 1, None], 1.0)
        out = []
        for i, row in enumerate(path.tolist()):
            own, t = [], 0
            while t < size[i]:
                u, y = t, row[t]
                if y:
                    more = y + y % 2
                    chance = a[i, t, y]
                    while u + 1 < size[i] and row[u + 1] == more:
                        u += 1
                        chance *= move[row[u - 1], more] * emit[i, u, more] / c[i, u]
                    own.append(((y - 1) // 2, t, u, float(chance * b[i, u, row[u]])))
                t = u + 1
            out.append(own)
        return out


def train(table: list[tuple[list[list[int]], list[int]]], epochs: int = 150, rate: float = 0.5, ridge: float = 1e-4) -> Field:
    """Gradient ascent with Adagrad on the log-likelihood of (features, labels) segments; equal segments are weighted, not repeated."""
    k = len(LABELS)
    field = Field(np.zeros((BUCKETS, k)), np.zeros((k, k)))
    weights: dict = {}
    for f, y in table:
        key = (tuple(map(tuple, f)), tuple(y))
        weights[key] = weights.get(key, 0) + 1
    rows = [(np.array(f), np.array(y), w) for (f, y), w in sorted(weights.items())]
    total = sum(w for *_, w in rows) or 1
    ge, gm = np.full_like(field.emit, 1e-8), np.full_like(field.move, 1e-8)
    by_len: dict[int, list] = {}
    for r in rows:
        by_len.setdefault(len(r[1]), []).append(r)
    batches = [(np.stack([r[0] for r in g]), np.stack([r[1] for r in g]), np.array([r[2] for r in g], float)) for _, g in sorted(by_len.items())]
    for _ in range(epochs):
        de, dm = -ridge * field.emit, -ridge * field.move
        for f, y, w in batches:
            n, steps, _ = f.shape
            s = field.emit[f].sum(2)
            a, b = np.zeros((n, steps, k)), np.zeros((n, steps, k))
            a[:, 0] = s[:, 0]
            for t in range(1, steps):
                a[:, t] = s[:, t] + _lse(a[:, t - 1][:, :, None] + field.move[None], 1)
            for t in range(steps - 2, -1, -1):
                b[:, t] = _lse(field.move[None] + (s[:, t + 1] + b[:, t + 1])[:, None, :], 2)
            z = _lse(a[:, -1], 1)
            p = np.exp(a + b - z[:, None, None])
            diff = (np.eye(k)[y] - p) * w[:, None, None] / total
            for j in range(f.shape[2]):
                np.add.at(de, f[:, :, j].ravel(), diff.reshape(-1, k))
            for t in range(1, steps):
                pair = np.exp(a[:, t - 1][:, :, None] + field.move[None] + (s[:, t] + b[:, t])[:, None, :] - z[:, None, None])
                dm -= (pair * w[:, None, None]).sum(0) / total
                np.add.at(dm, (y[:, t - 1], y[:, t]), w / total)
        ge += de**2
        gm += dm**2
        field.emit += rate * de / np.sqrt(ge)
        field.move += rate * dm / np.sqrt(gm)
    return field


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + np.squeeze(top, axis)


# The labelled table: "#" is any digit, "h" in braces any hexadecimal one; [kind|...] is a span. A card's last digit makes its checksum right, {bad ...} is a number whose checksum is wrong.
LINES = (
    # forms that the base patterns know
    "[email|an.##@mail#.example.com]", "[email|joe_#@post.example.org].", "[email|info@shop##.test]", "[ip|1##.##.1##.##]", "[ip|##.#.#.1##]:80##", "[ip|#.#.#.#]", "[card|####-####-####-####]", "[card|################]", "[card|#### #### #### ####]",
    "[phone|+1 (###) 555-####]", "[phone|+4# ## #######]", "[phone|+3# ### ### ###]", "[phone|+49 (0)## ######]",
    # side by side, where a base pattern swallows both and drops them
    "[phone|+1 (###) 555-####] [ip|1##.##.1##.##]", "[phone|+1 (###) 555-####] [card|################]", "[card|################] ##", "[card|################] ###", "[phone|+1 (###) 555-####] [phone|+1 (###) 555-####]", "## [card|################]",
    "[card|################] [card|################]", "[ip|1##.##.1##.##] [card|################]", "[card|################] [ip|1##.##.1##.##]", "# [card|################]", "[card|################] #", "### [card|################]", "[phone|+1 (###) 555-####] ##",
    "[ip|1##.##.1##.##] [phone|+1 (###) 555-####]", "[card|################] [phone|+1 (###) 555-####]", "[card|####-####-####-####] [card|####-####-####-####]", "[phone|+4# ## #######] [phone|+4# ## #######]", "[ip|#.#.#.#] [ip|1##.##.1##.##]",
    # numbers to call without a country code, or with other separators
    "[phone|(###) 555-####]", "[phone|(###) ###-####]", "[phone|(0##) ###-####],", "[phone|(0###) ###-###]", "[phone|(0##) #######]", "[phone|(0###) ######]", "[phone|###-###-####]", "[phone|###-555-####].", "[phone|0##-###-####]", "[phone|0##/#######]", "[phone|0###/######]",
    "[phone|0##/######]", "[phone|0## ### ## ##]", "[phone|0# ## ## ## ##]", "[phone|0## ### ####]", "[phone|0## ## ## ##]", "[phone|0# ## ## ## ##]!", "[phone|0#-##-##-##-##]", "[phone|0##.###.####]", "[phone|0###/#######]", "[phone|0### ######]", "[phone|0#### #####]", "[phone|00## # ## ## ## ##]", "[phone|00## ### #######]", "[phone|(0####) #####]", "[phone|(0##) ### ####]", "tel. [phone|0##-#######]", "tel. [phone|0###-######]", "tel [phone|(0##) #######]", "tel: [phone|0##/#######]", "tel: [phone|(###) ###-####]", "phone [phone|###-###-####]",
    "[phone|00## ## #### ####]", "[phone|00## ### ### ###]", "[phone|00## ## #######]", "fax: [phone|(###) ###-####]", "fax: [phone|0##-#######]", "fax [phone|###-###-####]", "call [phone|(###) 555-####]",
    # addresses pulled apart or without a full domain
    "[email|ann @ mail#.example.com]", "[email|joe @ post.example.org]", "[email|an.## @ mail#.example.com]", "[email|an.## @mail#.example.com]", "[email|joe_# @post.example.org]", "[email|ann @post.example.org]", "[email|joe @mail#.example.com]", "[email|an.## @ post.example.org]", "[email|ann @ post.example.org]", "[email|ann@ mail#.example.com]", "[email|an.##@ mail#.example.com]", "[email|joe_#@ post.example.org]", "[email|ann##@mail#]", "[email|ann@mail#]",
    "[email|joe@host#]", "[email|root@host##]", "[email|root@localhost]", "[email|admin@server##]", "[email|ann@intranet]", "[email|ops@db#]", "[email|web.##@node##]", "[email|a.b@office]", "[email|joe_#@lab##]", "[email|an.##@@mail#.example.com]", "[email|joe_#@@post.example.org]",
    # other notations of addresses and cards
    "[ip|fe80::{hhh}:{hhhh}:{hhhh}]", "[ip|fe80::{hhhh}:{hhhh}:{hhhh}:{hhhh}]", "[ip|fe80::#]", "[ip|fe80::{hh}]", "[ip|::1]", "[ip|fe80::#:#]", "[ip|2001:db8::#]", "[ip|2001:{hhhh}:{hhhh}:{hhhh}:{hhhh}:{hhhh}:{hhhh}:{hhhh}]", "[ip|2a00:{hhhh}:{hhhh}:{hhhh}::{hhhh}]", "[ip|2a02:{hhhh}:{hhhh}::{hhhh}]", "[ip|2001:db8:{hhhh}:#::{hh}]", "[ip|2001:db8::{hhhh}:{hhhh}]", "[ip|2001:db8:{hhhh}:{hhhh}:{hhhh}:{hhhh}:{hhhh}:{hhhh}]", "[ip|2a02:{hhhh}:{hhhh}:{hhhh}:{hhhh}:{hhhh}:{hhhh}:{hhhh}]", "[ip|2a02:{hhhh}::{hhhh}]",
    "[card|####.####.####.####]", "[card|####_####_####_####]", "[card|####/####/####/####]", "[card|####.####.####.####].", "[card|####_####_####_####],", "card [card|####/####/####/####]", "card [card|####.####.####.####]",
    # what is none of these
    "{bad ################}", "{bad ################}!!", "{bad ################}$$$", "{bad ####-####-####-####}", "{bad #### #### #### ####}", "{bad ####.####.####.####}", "{bad ####_####_####_####}", "{bad ####/####/####/####}", "order {bad ################} of", "{bad ################} ##", "{bad ################} #",
    "## {bad ################}", "version #.", "version #.#.#", "4.#.", "BY-NC #.0.", "v#.##.#", "v##.#.#", "2.##.#-rc#", "20##-0#-1#", "1#:##:##", "0#:##", "20##-0#-1#T0#:##:##Z", "$##.99", "#.#####", "##%", "#,###,###", "###,###", "token = \"{hhhhhhhhhhhhhhhhhhhhhhhhhhhhhhhhhhhhhhhh}\"",
    "key={hhhhhhhhhhhhhhhh}", "sha {hhhhhhhhhhhhhhhhhhhhhhhhhhhhhhhh}", "AKIA########ABCD####", "{hhhhhhhh}-{hhhh}-{hhhh}-{hhhh}-{hhhhhhhhhhhh}", "ISBN 978-#-##-######-#", "ISBN 978-###-###-###-#", "§ ##", "#st", "#th", "room ###", "19##", "20##", "(20##)", "(19##)", "[##]", "[#]", "##.# km", "## km", "+#", "+##", "C++",
    "a+b", "@user##", "@ann_##", "@joe#", "@x.##", "@web", "@lab## and", "by @ann#", "@ ##", "# @ ##", "1+#=#", "## ###", "### ##", "# ### ###", "## ### ###", "##-##", "###-###", "19##-20##", "SKU-#####-####", "SKU-####-###", "##########", "########", "#######", "#/#", "##/##", "##/##/20##", "##x##", "###x###", "COVID-##", "| ## |", "| # | ## |", "no. ####", "no. ###",
    "{bad ################} [ip|1##.##.1##.##]", "[ip|1##.##.1##.##] {bad ################}", "[phone|+1 (###) 555-####] {bad ################}", "{bad ################} {bad ################}", "## ## ##", "### ### ###", "## ## ## ##", "# # #", "### ## ###", "#### ####", "## ### ##", "### ### ### ###", "###-##", "####-###", "##-##-##", "{bad #### #### #### ####}.", "{bad #### ####-#### ####}", "no {bad #### #### #### ####}", "#.#.#", "#.##.#", "##.##.20##", "#:#", "##:##:##:##", "aa:bb:{hh}",
)
_AROUND = "the and of with call to mail from at und die mit an bei von les des avec une sur pour los las con una para".split()
_PART = re.compile(r"\[(\w+)\|([^\]]*)\]|\{bad ([^}]*)\}|\{(h+)\}|#")


def _card(form: str, right: bool, rng: random.Random) -> str:
    out = "".join(str(rng.randrange(1, 10)) if c == "#" else c for c in form)
    digits = re.sub("[^0-9]", "", out)
    last = next(d for d in "0123456789" if luhn(digits[:-1] + d))
    return out[:-1] + (last if right else str((int(last) + rng.randrange(1, 10)) % 10))


def _fill(form: str, rng: random.Random) -> str:
    return re.sub(r"\{(h+)\}|#", lambda m: "".join(rng.choice("0123456789abcdef") for _ in m[1]) if m[1] else str(rng.randrange(10)), form)


def labelled(copies: int = 12, seed: int = 1) -> list[tuple[str, list[Span], int]]:
    """(text, spans, copy) for ``copies`` of each line, with other digits and other words around them each time."""
    rng, out = random.Random(seed), []
    for line in LINES:
        for copy in range(copies):
            text, spans = " ".join(rng.choices(_AROUND, k=rng.randrange(3))), []
            text += " " if text else ""
            at = 0
            for m in _PART.finditer(line):
                text += line[at : m.start()]
                at, start = m.end(), len(text)
                if m[1]:
                    text += _card(m[2], True, rng) if m[1] == "card" else _fill(m[2], rng)
                    spans.append((KINDS.index(m[1]), start, len(text)))
                else:
                    text += _card(m[3], False, rng) if m[3] else _fill(m[0], rng)
            text += line[at:] + (" " + " ".join(rng.choices(_AROUND, k=rng.randrange(1, 3))) if rng.random() < 0.8 else "")
            out.append((text, spans, copy))
    return out


def training_table(rows: list[tuple[str, list[Span], int]]) -> list[tuple[list[list[int]], list[int]]]:
    make = Featurizer()
    unsaid = bucket("unsaid")
    blurred = lambda feats: [[unsaid if j in EXACT else f for j, f in enumerate(row)] for row in feats]
    return [((blurred if copy % 2 else list)(make(t, seg)), label_segment(seg, spans)) for t, spans, copy in rows for seg in segments(t)]


def fit(copies: int = 12) -> Field:
    """From the written table alone: no label comes from the base patterns, and no text of the corpus is read."""
    return train(training_table(labelled(copies)))


def all_spans(texts: list[str], field: Field, make: Featurizer, sure: float) -> list[tuple[list[Span], list[Span]]]:
    """Base spans and added spans of each text."""
    base = [base_spans(t) for t in texts]
    added: list[list[Span]] = [[] for _ in texts]
    where, feats, held = [], [], 0

    def decode() -> None:
        for (i, seg, low, high), runs in zip(where, field.decode(feats), strict=True):
            for kind, first, last, chance in runs:
                if chance >= sure and low <= first < high:
                    s, e = _trim(texts[i], seg[first][0], seg[last][1])
                    if s < e:
                        added[i].append((kind, s, e))
        where.clear()
        feats.clear()

    for i, t in enumerate(texts):
        for seg in segments(t):
            for own, low, high in windows(seg):
                where.append((i, own, low, high))
                feats.append(make(t, own))
                held += len(own)
                if held > HELD_TOKENS:
                    decode()
                    held = 0
    decode()
    return [(own, _apart(more, own)) for own, more in zip(base, added, strict=True)]


def windows(seg: list[tuple[int, int]]) -> Iterator[tuple[list[tuple[int, int]], int, int]]:
    """(tokens, low, high): a span counts in the window that it begins in, between ``low`` and ``high``."""
    if len(seg) <= WINDOW:
        yield seg, 0, len(seg)
        return
    step = WINDOW - 2 * LAP
    for at in range(0, len(seg), step):
        before = min(LAP, at)
        yield seg[at - before : at + step + LAP], before, min(before + step, before + len(seg) - at)


def _apart(spans: list[Span], base: list[Span]) -> list[Span]:
    """The spans that overlap none of ``base``: both in order of start, in one pass."""
    taken, out, k = sorted((s, e) for _, s, e in base), [], 0
    reach = np.maximum.accumulate([e for _, e in taken]) if taken else []
    starts = [s for s, _ in taken]
    for span in sorted(spans, key=lambda x: x[1]):
        while k < len(starts) and starts[k] < span[2]:
            k += 1
        if not k or reach[k - 1] <= span[1]:
            out.append(span)
    return out


_OUTER = frozenset(".,;:!?\"'[]{}<>|*%#$")


def _trim(text: str, s: int, e: int) -> tuple[int, int]:
    while s < e and text[s] in _OUTER:
        s += 1
    while e > s and text[e - 1] in _OUTER:
        e -= 1
    return s, e


SPANS = "array<struct<kind:string,start:int,end:int,base:boolean>>"
_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))


def find(docs: DataFrame, field: Field, sure: float = SURE, text_col: str = "text") -> DataFrame:
    """The input's columns plus ``pii``: spans by kind as listed, then start, in code points with exclusive end.

    Null and empty texts have none. Repeated rows are handled one by one; a column named pii is replaced; very long texts are read whole.
    """
    docs = docs.drop("pii")
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Featurizer()
        for b in batches:
            rows = []
            for base, more in all_spans([t or "" for t in b.column(at).to_pylist()], field, make, sure):
                every = sorted([(*s, True) for s in base] + [(*s, False) for s in more])
                rows.append([{"kind": KINDS[k], "start": s, "end": e, "base": o} for k, s, e, o in every])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(rows, _ARROW)], names=[*b.schema.names, "pii"])

    kinds = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(lean(run), f"{kinds}, pii {SPANS}")


def redact(docs: DataFrame, field: Field, sure: float = SURE, text_col: str = "text") -> DataFrame:
    """The input's columns with each span replaced by its kind in angle brackets; overlapping spans are replaced together under the first's kind.

    Null and empty texts stay as they are; repeated rows are handled one by one, so equal ones stay equal; identifiers are not looked at.
    """
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Featurizer()
        for b in batches:
            texts = b.column(at).to_pylist()
            out = []
            for t, (base, more) in zip(texts, all_spans([t or "" for t in texts], field, make, sure), strict=True):
                merged: list[list[int]] = []
                for s, e, k in sorted((s, e, k) for k, s, e in base + more):
                    if merged and s < merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], e)
                    else:
                        merged.append([s, e, k])
                for s, e, k in reversed(merged):
                    t = f"{t[:s]}<{KINDS[k].upper()}>{t[e:]}"
                out.append(t)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()) if i == at else c for i, c in enumerate(b.columns)], names=b.schema.names)

    kinds = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(lean(run), kinds)
