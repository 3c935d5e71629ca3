from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np

from netzero.llm import op12_lexical as m

from .common import edge_docs, edge_rows, empty_docs, words

ITEMS = "item_id long, text string, doc_id long, rank int"
SPLIT = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(t):
    return SPLIT.findall((t or "").translate(FOLD))


def brute(docs, items, top=20):
    bags = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs]
    bags = [b for b in bags if b[2]]
    n, total = len(bags), sum(b[2] for b in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    out = []
    for item, text in items:
        q, found = Counter(terms(text)), []
        for i, b, size in bags:
            length = 100 - 25 + (25 * size * n) // total
            s = sum(c * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10 ** 9 * b[t]) // (1000 * b[t] + 12 * length))
                    for t, c in q.items() if t in b)
            if s > 0:
                found.append((-s, i is None, i or 0))
        out += [(item, r, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(found)[:top], 1)]
    return sorted(out, key=str)


def corpus(n, seed):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(120)]
    common = [1 / (i + 1) for i in range(120)]
    out = [(i, " ".join(rnd.choices(vocabulary, common, k=rnd.randint(1, 60)))) for i in range(n)]
    out += [(n + i, out[7][1]) for i in range(n // 3)]  # copies
    return out + [(n, "w3 w3  W3,w119"), (3 * n, " ".join(rnd.choices(vocabulary, k=5000)))]


def queries(n, seed):
    rnd = random.Random(seed)
    return [(i, " ".join(f"W{rnd.randrange(130)}" for _ in range(rnd.randint(1, 12)))) for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, None, None) for i, t in rows], ITEMS)


def test_terms_are_those_of_the_pattern():
    for t in [None, "", "A-b_c9 É日本\x7f𝄞\x80x\x00ÄZ"] + [words(50, s) for s in range(3)]:
        assert [w.decode() for w in m.terms(t)] == terms(t)


def test_equals_brute_force(spark, monkeypatch):
    docs, items = corpus(300, 1), queries(40, 2) + [(7, "w1 w2"), (7, "w1 w2"), (8, None), (9, ""), (None, "w5 nothing"), (10, "nothing")]
    monkeypatch.setattr(m, "SEEDS", 30)
    monkeypatch.setattr(m, "SHARD_DOCS", 70)
    for block in (10_000, 150):  # one block of items and many
        got = m.rank_documents(spark.createDataFrame(docs, "doc_id long, text string"), frame(spark, items), block_chars=block)
        assert sorted((tuple(r) for r in got.collect()), key=str) == brute(docs, items)


def test_edge_cases(spark):
    items = [(1, "the ing st"), (2, words(60, 2)), (3, "é日本 one TWO"), (4, words(4000, 1))]
    got = m.rank_documents(edge_docs(spark), frame(spark, items)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute([(r[0], r[1]) for r in edge_rows()], items)
    assert m.rank_documents(empty_docs(spark), frame(spark, items)).count() == 0
    assert m.rank_documents(edge_docs(spark), frame(spark, [])).count() == 0


def shard(docs, vocabulary):
    rows = [np.unique([vocabulary[w] for w in m.terms(t) if w in vocabulary], return_counts=True) for _, t in docs]
    at = np.concatenate([a for a, _ in rows]).astype(np.int64)
    value = np.concatenate([c for _, c in rows]).astype(np.float64)
    return m.Shard(np.arange(len(docs)), np.zeros(len(docs), bool), np.array([len(a) for a, _ in rows]), at, value, len(vocabulary))


def test_blocks_cover_lists_and_summaries_bound_them():
    docs = corpus(500, 3)
    vocabulary = {f"w{i}".encode(): i for i in range(120)}
    s = shard(docs, vocabulary)
    held = defaultdict(set)
    for i, (_, t) in enumerate(docs):
        for w in set(m.terms(t)):
            held[vocabulary[w]].add(i)
    for term in (0, 1, 5, 40, 119):
        d, block = s.blocks(term)
        assert sorted(d.tolist()) == sorted(held[term]) and (np.bincount(block) <= 2 * m.BLOCK).all()
        coordinate = np.arange(120, dtype=np.int32)
        summary = s.summaries(d, block, coordinate, 120)
        full = np.zeros((len(d), 120))
        row, entry = s.entries(d)
        full[row, s.at[entry]] = s.value[entry]
        for b in range(len(summary)):
            assert (summary[b] == full[block == b].max(0)).all()


def test_blocks_are_passed_over():
    docs = corpus(2000, 4)
    vocabulary = {f"w{i}".encode(): i for i in range(120)}
    s = shard(docs, vocabulary)
    items = [(np.array([vocabulary[b"w60"], vocabulary[b"w1"], vocabulary[b"w90"]]), np.ones(3))]
    first, counts = m.Best(1, 20, np.zeros(1)), {}
    m.search_shard(s, items, first)
    again = m.Best(1, 20, first.threshold)
    m.search_shard(s, items, again, counts)
    assert counts["opened"] < counts["blocks"]
    assert all((a == b).all() for a, b in zip(first.rows[0], again.rows[0]))
