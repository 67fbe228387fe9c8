"""Conversations as token ids with a loss mask that is aligned by character offsets.

A conversation is rendered whole: for each turn the start mark, the role, the head mark, the text, the end mark. It is encoded once, with the offset span of every token. The spans of
the assistant's texts, which are sorted as they are, are then laid over the token spans, which are sorted too: a binary search for either end of a text gives its tokens.

The marks are added tokens of the tokenizer, so no token reaches over one. Inside roles and texts every ``<`` that backslashes and ``|`` follow gets one more backslash, so none of them can
hold a mark (or any other ``<|...|>``), and taking one backslash away brings them back.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from branchlake.llm.common import lean

# The marks of the template.
START, HEAD, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
LEARNT = "assistant"
#: characters encoded at once, unless one conversation has more
BATCH = 1 << 20
_BARE, _ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<(\\*)\\\|")
FORMATTED = "text string, ids array<int>, starts array<int>, ends array<int>, loss array<boolean>"


def escape(text: str) -> str:
    return _BARE.sub(r"<\1\\|", text) if "<" in text else text


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text) if "<" in text else text


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The text of (role, text) turns and the spans, in code points, of what is to be learnt."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{START}{escape(role)}{HEAD}", escape(text)
        if role == LEARNT:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(parts), spans


def covered(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Whether a token shares a character with a span. Tokens of one character's bytes share its offsets; starts and ends never fall."""
    mask = np.zeros(len(starts), bool)
    if spans:
        low, high = np.array(spans).T
        first, last = np.searchsorted(ends, low, side="right"), np.searchsorted(starts, high, side="left")
        for a, b in zip(first[low < high].tolist(), last[low < high].tolist(), strict=True):
            mask[a:b] = True
    return mask


_TOKENIZERS: dict = {}


def tokenizer(path: str):
    """A byte-level tokenizer with the marks as tokens of their own; one per Python worker."""
    if path not in _TOKENIZERS:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import AddedToken, Tokenizer, processors

        t = Tokenizer.from_file(path)
        t.add_special_tokens([AddedToken(m, normalized=False) for m in (START, HEAD, END)])
        t.post_processor = processors.ByteLevel(trim_offsets=False)
        _TOKENIZERS[path] = t
    return _TOKENIZERS[path]


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns), strict=True)


def format_conversations(turns: DataFrame, tokenizer_path: str) -> DataFrame:
    """(conv_id, text, ids, starts, ends, loss), a row per conversation; starts and ends are the tokens' spans in code points of ``text``, ``loss`` marks the tokens to learn.

    Turns are taken in the order of turn, then role and text, nulls first; repeated rows are repeated turns. A null role or text is empty, a null identifier is one conversation of its own.
    A conversation is streamed through one task, which holds one batch of texts. An empty table gives no rows; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(tokenizer_path)
        waiting: list[tuple] = []

        def flush() -> pa.RecordBatch:
            found = []
            encoded = encode.encode_batch([text for _, text, _ in waiting], add_special_tokens=False)
            for (conv, text, spans), e in zip(waiting, encoded, strict=True):
                starts, ends = np.array(e.offsets, np.int32).reshape(-1, 2).T
                found.append((conv, text, e.ids, starts, ends, covered(starts, ends, spans)))
            waiting.clear()
            kinds = [kind, pa.string(), *[pa.list_(pa.int32())] * 3, pa.list_(pa.bool_())]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), kinds, strict=True)], names=["conv_id", "text", "ids", "starts", "ends", "loss"])

        kind, size = None, 0

        def typed() -> Iterator[pa.RecordBatch]:
            nonlocal kind
            for b in batches:
                kind = b.schema.types[0]
                yield b

        for conv, rows in groupby(_turns(typed()), itemgetter(0)):
            text, spans = render([(role, body) for _, role, body in rows])
            waiting.append((conv, text, spans))
            size += len(text)
            if size > BATCH:
                yield flush()
                size = 0
        if waiting:
            yield flush()

    clean = turns.select("conv_id", "turn", *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("role", "text")])
    ordered = clean.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")
    return ordered.mapInArrow(lean(run), f"conv_id {turns.schema['conv_id'].dataType.simpleString()}, {FORMATTED}")


def read_turns(text: str) -> list[tuple[str, str]]:
    """(role, text) of a rendered conversation."""
    found = []
    for turn in text.split(START)[1:]:
        head, _, body = turn.partition(HEAD)
        found.append((unescape(head), unescape(body.removesuffix(END))))
    return found


def masked_texts(text: str, starts: np.ndarray, ends: np.ndarray, loss: np.ndarray) -> list[str]:
    """The text under each unbroken run of masked tokens; marks stand between runs."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], loss.astype(np.int8), [0]])))
    return [unescape(text[starts[a] : ends[b - 1]]) for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)]


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation what its output holds: n_turns, turns_sha256 (role and text of every turn, each with a line feed), loss_chars, loss_sha256 (all texts under the mask), formatted_chars."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = []
            for text, starts, ends, loss in zip(b.column(1).to_pylist(), *(b.column(k) for k in (2, 3, 4)), strict=True):
                turns = read_turns(text)
                learnt = "".join(masked_texts(text, *(np.asarray(x.values) for x in (starts, ends)), np.array(loss.as_py(), bool)))
                whole = "".join(f"{role}\n{body}\n" for role, body in turns)
                found.append((len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(learnt), hashlib.sha256(learnt.encode()).hexdigest(), len(text)))
            if found:
                kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
                cols = [pa.array(c, t) for c, t in zip(zip(*found, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([b.column(0), *cols], names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    kind = formatted.schema["conv_id"].dataType.simpleString()
    kept = formatted.select("conv_id", "text", "starts", "ends", "loss")
    return kept.mapInArrow(lean(run), f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
