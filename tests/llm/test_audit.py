"""Source divergence audit, chat format, filter interaction audit."""

import hashlib
import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import duckdb
import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from branchlake.llm import chat_format, divergence_audit, filter_audit, queries

BYTES = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("name", ["op11_source_divergence", "op12_chat_format", "op13_filter_audit"])
def test_against_sql(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    df, found = queries.QUERIES[name](spark, sf), con.execute(queries.ORACLE_SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(df.columns) == sorted(names)
    assert sorted(map(repr, (tuple(r[n] for n in names) for r in df.collect()))) == sorted(map(repr, found.fetchall()))


# ---- divergence
def brute_audit(rows, min_docs=3, top=200):
    rows = [tuple(x or "" for x in r) for r in rows]
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = [(lang, source, [t.translate(lower) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text)]) for lang, source, text in rows]
    out = []
    for lang in {r[0] for r in found}:
        df = Counter(t for x, _, ts in found if x == lang for t in set(ts))
        kept = sorted(t for t, n in df.items() if n >= min_docs)
        n = defaultdict(Counter)
        for x, source, ts in found:
            if x == lang:
                n[source].update(t for t in ts if df[t] >= min_docs)
                n[None].update(t for t in ts if df[t] >= min_docs)
        p = {g: {t: 1 + 10**9 * (n[g][t] + 1) // (n[g].total() + len(kept)) for t in kept} for g in n}
        f = lambda a, b: (a - b) ** 2 // b
        for g in n.keys() - {None}:
            pairs = [(b, sum(f(p[g][t], p[b][t]) for t in kept)) for b in n.keys() - {None, g}]
            terms = [(t, f(p[g][t], p[None][t])) for t in kept if n[g][t] and p[g][t] > p[None][t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, top)):
                ordered = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, g, part, item, v, i + 1) for i, (item, v) in enumerate(ordered)]
    return sorted(out)


def said(df):
    return sorted(tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in df.collect())


def made(seed, n=120):
    rng = random.Random(seed)
    words = ["the", "THE", "a", "b'c", "é", "É", "zoo", "x1y", "naïve", "日本", "end", "_", "tie", "eit"]
    return [(rng.choice(["en", "fr", None]), rng.choice(["s", "s", "t", "", None, "u"]), rng.choice([None, ""] + [" ".join(rng.choices(words, k=rng.randint(1, 30))) for _ in range(9)])) for _ in range(n)]


@pytest.mark.parametrize(("seed", "bits", "top"), [(1, 64, 200), (2, 64, 3), (3, 2, 200), (4, 1, 4)])
def test_divergence_against_brute_force(spark, seed, bits, top):
    """Short digests put many terms behind one digest, which are then told apart by text."""
    rows = made(seed)
    assert said(divergence_audit.audit(spark.createDataFrame(rows, "lang string, source string, text string"), top=top, bits=bits)) == brute_audit(rows, top=top)


def test_shares_are_exact(spark):
    cases = [(0, 0, 1), (5, 5, 1), (10**15, 8 * 10**15, 10**9), (8 * 10**15, 8 * 10**15, 3), (2, 10**12 + 7, 999)]
    want = [1 + 10**9 * (n + 1) // (t + v) for n, t, v in cases]
    df = spark.createDataFrame(cases, "n long, total long, kinds long")
    assert [r["p"] for r in df.select(divergence_audit.share(F.col("n"), F.col("total"), F.col("kinds")).alias("p")).collect()] == want
    n, t, v = np.array(cases).T
    assert divergence_audit.shares(n, t + v).tolist() == want


def test_divergence_of_odd_and_empty_tables(spark, odd, none):
    named = odd.withColumns({"lang": F.col("id"), "source": F.col("version")})
    assert said(divergence_audit.audit(named)) == brute_audit([(r["lang"], r["source"], r["text"]) for r in named.collect()])
    assert divergence_audit.audit(none.withColumns({"lang": F.col("id"), "source": F.col("version")})).count() == 0
    alone = spark.createDataFrame([("en", "a", "one two"), ("en", "b", None), ("en", "c", "1 2")], "lang string, source string, text string")
    assert said(divergence_audit.audit(alone)) == brute_audit([tuple(r) for r in alone.collect()])  # no term is kept: distances of 0


def test_text_travels_once_per_task_and_term(spark, sf):
    """Counts are numbers; a term's text goes with the first of them only."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("lang", "source", F.col("text").cast("binary").alias("body")).coalesce(1)
    gids = {(lang, source): (g, 0) for g, (lang, source) in enumerate(sorted({(r["lang"], r["source"]) for r in docs.select("lang", "source").collect()}))}
    counts = divergence_audit.term_counts(docs, gids).collect()
    texts = [r["term"] for r in counts if r["term"] is not None]
    assert len(texts) == len(set(texts)) == len({r["digest"] for r in counts}) < len(counts)


def test_a_common_term_is_added_up_as_it_streams(spark, monkeypatch):
    """More counts of a digest than a batch holds are compacted, with nothing lost."""
    monkeypatch.setattr(divergence_audit, "HELD", 1)
    rows = [("en", "ab"[i % 2], "common " * (i % 3 + 1) + f"w{'xyz'[i % 3]}") for i in range(900)]
    df = spark.createDataFrame(rows, "lang string, source string, text string").coalesce(2)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 16)
    try:
        assert said(divergence_audit.audit(df)) == brute_audit(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


# ---- chat format
@given(st.text(alphabet="<|\\>ae\n🙂", max_size=30))
@settings(max_examples=300, deadline=None)
def test_escaping_is_reversible_and_hides_marks(text):
    hidden = chat_format.escape(text)
    assert chat_format.unescape(hidden) == text and "<|" not in hidden


def test_masks_against_a_token_by_token_loop():
    rng = random.Random(3)
    for _ in range(40):
        turns = [(rng.choice(["user", "assistant", "system", "", "<|im_end|>"]), rng.choice(["", " ", "\n\nx", "<|im_start|>", "naïve 🙂🙂", "a b  c " * rng.randint(1, 9), "<\\|x"])) for _ in range(rng.randint(1, 9))]
        text, spans = chat_format.render(turns)
        e = chat_format.tokenizer(BYTES).encode(text, add_special_tokens=False)
        starts, ends = np.array(e.offsets).reshape(-1, 2).T
        got = chat_format.covered(starts, ends, spans)
        assert got.tolist() == [any(s < high and e > low for low, high in spans) for s, e in e.offsets]
        assert chat_format.tokenizer(BYTES).decode(e.ids, skip_special_tokens=False) == text and chat_format.read_turns(text) == turns
        learnt = chat_format.tokenizer(BYTES).decode([i for i, m in zip(e.ids, got, strict=True) if m])
        assert learnt == "".join(chat_format.escape(t) for r, t in turns if r == "assistant")
        assert "".join(chat_format.masked_texts(text, starts, ends, got)) == "".join(t for r, t in turns if r == "assistant")


def test_chat_of_odd_and_empty_tables(spark):
    rows = [
        (1, 2, "assistant", "last", 9), (1, 0, "user", None, 9), (1, 1, None, "x", 9), (2, None, "assistant", "b", 9), (2, 0, "assistant", "", 9), (2, 0, "assistant", "", 9),
        (None, 0, "assistant", "lone", 9), (3, 0, "user", "long " * 300_000, 9), (3, 1, "assistant", "é" * 200_000, 9),
    ]
    df = spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string, ids int")
    out = {r["conv_id"]: r for r in chat_format.read_back(chat_format.format_conversations(df, BYTES)).collect()}
    want = {1: [("user", ""), ("", "x"), ("assistant", "last")], 2: [("assistant", "b"), ("assistant", ""), ("assistant", "")], None: [("assistant", "lone")], 3: [("user", "long " * 300_000), ("assistant", "é" * 200_000)]}
    assert set(out) == set(want)
    for conv, turns in want.items():
        r, learnt = out[conv], "".join(t for role, t in turns if role == "assistant")
        assert (r["n_turns"], r["turns_sha256"]) == (len(turns), hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest())
        assert (r["loss_chars"], r["loss_sha256"]) == (len(learnt), hashlib.sha256(learnt.encode()).hexdigest())
    assert chat_format.read_back(chat_format.format_conversations(df.limit(0), BYTES)).count() == 0


def test_formatted_rows_hold_real_tokens(spark, sf):
    turns = spark.read.parquet(f"{sf}/conversations.parquet")
    out = chat_format.format_conversations(turns, BYTES)
    assert out.columns == ["conv_id", "text", "ids", "starts", "ends", "loss"] and out.count() == turns.select("conv_id").distinct().count()
    t = chat_format.tokenizer(BYTES)
    for r in out.limit(20).collect():
        assert t.decode(r["ids"], skip_special_tokens=False) == r["text"] and len(r["ids"]) == len(r["loss"]) == len(r["starts"]) == len(r["ends"])


# ---- filter interactions
@given(st.lists(st.integers(0, 60)), st.lists(st.integers(0, 60)))
@settings(max_examples=300, deadline=None)
def test_galloping_lists(a, b):
    a, b = (np.array(sorted(set(x)), np.int32) for x in (a, b))
    less = filter_audit.difference(a, b)
    assert less.tolist() == sorted(set(a.tolist()) - set(b.tolist()))
    assert filter_audit.merged(b, less).tolist() == sorted(set(a.tolist()) | set(b.tolist()))


def brute_interactions(rows, labels):
    """rows: (doc_id, text, source)."""
    best = {}
    for i, q, t in labels:
        old = best.get(i, (0, 0))
        best[i] = (max(old[0], q or 0), max(old[1], t or 0))
    smallest = {}
    for i, text, _ in rows:
        if i is not None:
            smallest[text or ""] = min(i, smallest.get(text or "", i))
    parts = defaultdict(list)
    for i, text, source in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text), "D": bool(re.search(r"[#$%&*|]", text)), "E": i is not None and smallest[text] < i}
        parts[source or ""].append(({f for f, bad in fails.items() if bad}, best.get(i, (0, 0)) if i is not None else (0, 0)))
    out = []
    for part, docs in parts.items():
        total, made_ = Counter(), []
        for order in permutations("ABCDE"):
            left = docs
            for k, f in enumerate(order):
                gone, left = [d for d in left if f in d[0]], [d for d in left if f not in d[0]]
                total[f] += len(gone)
                made_.append((part, "".join(order), k + 1, len(left), len(gone), sum(f in d[0] for d in docs) - len(gone), sum(d[0] == {f} for d in docs), sum(d[1][0] == 1 for d in gone), sum(d[1][1] == 1 for d in gone), f))
        out += [(*r[:-1], total[r[-1]]) for r in made_]
    return sorted(out)


def counted(df):
    names = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return sorted(tuple(r[c] for c in names) for r in df.collect())


def test_interactions_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(filter_audit, "RANGE", 7)
    rng = random.Random(5)
    texts = [None, "", "word " * 250, "ONE Two three", " ".join(map(str, range(300))), " ".join(map(str, range(300))) + " #", "A" * 30, "\x0b\x1c a", "x|y " * 201]
    rows = [(rng.choice([None, *range(60)]), rng.choice(texts), rng.choice(["a", "a", "a", "b", "", None])) for _ in range(150)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 60, 2)] + [(4, 1, 1), (4, 0, 0), (None, 1, 1)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, source string, fails int")
    got = filter_audit.interactions(docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))
    assert counted(got) == brute_interactions(rows, labels)


def test_interactions_of_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string, source string")
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert filter_audit.interactions(docs, labels).count() == 0
    some = spark.createDataFrame([(1, "x", None)], docs.schema)
    assert counted(filter_audit.interactions(some, labels)) == brute_interactions([(1, "x", None)], [])
