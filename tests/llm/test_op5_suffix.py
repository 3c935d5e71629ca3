from __future__ import annotations

import collections
import hashlib
import random

import pytest

from netzero.llm import op5_suffix as m
from netzero.llm.common import ARROW_BYTES, small_batches

from .common import edge_docs, edge_rows, empty_docs, read

SF = "/root/testdata/sf0.001"


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = collections.Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(d), sum(gone), runs, hashlib.sha256(bytes(x for x, g in zip(d, gone) if not g)).hexdigest()))
    return out


def removed(spark, texts, **kw):
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    rows = sorted(m.remove_repeats(d, **kw).collect(), key=lambda r: r.doc_id)
    return [(r.n_bytes, sum(x.end - x.start for x in r.spans), len(r.spans), r.sha) for r in rows]


def test_deep_shallow_sorts():
    rnd = random.Random(3)
    for _ in range(300):
        s = [bytes(rnd.choice(b"ab\0") for _ in range(rnd.randint(0, 60))) for _ in range(rnd.randint(0, 40))]
        if rnd.random() < 0.5:
            s = [b"ababababab" * 3 + x for x in s]
        order, lcp = m.deep_shallow(s, 1)
        assert [s[i] for i in order] == sorted(s) and sorted(order) == list(range(len(s)))
        assert all(lcp[i] == m.common(s[order[i - 1]], s[order[i]]) for i in range(1, len(order)))


def test_repeated_starts_of_one_anchor():
    rnd = random.Random(4)
    for _ in range(300):
        length = rnd.randint(4, 12)
        contents = list({(bytes(rnd.choice(b"ab") for _ in range(a)) + b"X" + bytes(rnd.choice(b"ab") for _ in range(rnd.randint(0, length - 1))), a)
                         for a in (rnd.randint(0, length - 1) for _ in range(rnd.randint(1, 25)))})
        windows = collections.Counter()
        for c, a in contents:
            for s in range(max(0, a - length + 1), min(a, len(c) - length) + 1):
                windows[c[s:s + length]] += 1
        for (c, a), ranges in zip(contents, m.repeated_starts(contents, length)):
            want = {s for s in range(max(0, a - length + 1), min(a, len(c) - length) + 1) if windows[c[s:s + length]] > 1}
            assert {s for x, y in ranges for s in range(x, y + 1)} == want


@pytest.mark.parametrize("length,gram,limit", [(40, 20, 1000), (40, 20, 1), (40, 1, 1000), (40, 40, 3)])
def test_against_brute_force(spark, length, gram, limit):
    rnd = random.Random(length + gram)
    noise = lambda n: "".join(rnd.choice("abcdé \n") for _ in range(n))
    base = [noise(300) for _ in range(5)]
    texts = [None, "", "x" * 50, "aaaa" * 30, "x" * 39, "ab" * 40, base[0], base[0]]
    for k in range(30):
        t, a = rnd.choice(base), rnd.randrange(250)
        texts.append(noise(rnd.randrange(60)) + t[a:a + rnd.randrange(20, 200)] + noise(rnd.randrange(60)) + (base[1][:100] if k % 3 == 0 else ""))
    assert removed(spark, texts, length=length, gram=gram, limit=limit) == brute(texts, length)


def test_edge_cases(spark):
    rows = edge_rows()
    got = m.remove_repeats(edge_docs(spark), length=60, gram=30).collect()
    want = brute([r[1] for r in rows], 60)
    assert sorted((str(r.doc_id), r.n_bytes, r.sha) for r in got) == sorted((str(r[0]), w[0], w[3]) for r, w in zip(rows, want))
    assert m.remove_repeats(empty_docs(spark)).count() == 0


def test_query_against_brute_force(spark):
    texts = {r.doc_id: r.text for r in read(spark, SF, "documents").collect()}
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in m.op5_suffix(spark, SF).collect()}
    assert got == dict(zip(texts, brute(list(texts.values()), 400)))


def test_texts_reach_python_in_small_batches(spark):
    """Arrow batches are bounded by bytes: 40 texts of 100,000 bytes are not one batch."""
    import pandas as pd

    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    docs = spark.range(0, 40, 1, 1).selectExpr("id AS doc_id", "repeat(substr(sha(cast(id AS string)), 1, 10), 10000) AS text")

    def sizes(frames):
        for f in frames:
            yield pd.DataFrame({"n": [int(f["text"].str.len().sum())]})

    try:
        spark.conf.unset(name)
        m.remove_repeats(docs)
        seen = [r.n for r in docs.mapInPandas(sizes, "n long").collect()]
        assert sum(seen) == 4_000_000 and max(seen) <= ARROW_BYTES + 100_000
        for given, kept in (("64k", "64k"), ("3m", str(ARROW_BYTES)), ("1000000", "1000000"), ("1g", str(ARROW_BYTES))):
            spark.conf.set(name, given)
            small_batches(spark)
            assert spark.conf.get(name) == kept
    finally:
        spark.conf.unset(name)
