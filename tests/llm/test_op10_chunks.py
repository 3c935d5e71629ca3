from __future__ import annotations

import random
from collections import Counter

import pandas as pd

from netzero.llm import op10_chunks as m
from netzero.llm.common import ARROW_BYTES

from .common import edge_docs, edge_rows, empty_docs, read, words

SF = "/root/testdata/sf0.001"


def borders(data: bytes) -> list[int]:
    """Chunk borders with a plain rolling gear hash, byte by byte."""
    h, hashes = 0, []
    for i, b in enumerate(data):
        h = (h << 1) + int(m.GEAR[b]) & 0xFFFF
        inside = i + 1 < len(data) and data[i + 1] & 0xC0 == 0x80
        hashes.append(0xFFFF if inside else h)
    out, pos = [], 0
    while len(data) - pos > m.MIN_CHUNK:
        window = range(pos + m.MIN_CHUNK, min(pos + m.MAX_CHUNK, len(data)) + 1)
        cut = next((e for e in window if hashes[e - 1] >> 16 - m.MASK_BITS == 0), None)
        if cut is None:
            cut = min(window, key=lambda e: hashes[e - 1]) if len(data) - pos > m.MAX_CHUNK else len(data)
        out.append(cut)
        pos = cut
    return out + ([len(data)] if pos < len(data) else [])


def test_chunks_against_a_rolling_hash(monkeypatch):
    rnd = random.Random(1)
    texts = ["", "a" * 1000, "é" * 700, "x" * m.MIN_CHUNK, edge_rows()[6][1]] + [words(rnd.randint(1, 300), i) for i in range(50)]
    for step in (m.SCAN_BYTES, 40):
        monkeypatch.setattr(m, "SCAN_BYTES", step)
        for t in texts:
            data = t.encode()
            ends = m.chunk_ends(data)
            sizes = [b - a for a, b in zip([0, *ends], ends)]
            assert sum(sizes) == len(data) and all(s <= m.MAX_CHUNK for s in sizes)
            [data[a:b].decode() for a, b in zip([0, *ends], ends)]  # whole characters
            assert ends == borders(data)


def test_insertion_moves_nearby_borders_only():
    a = words(2000, 5).encode()
    b = a[:4000] + b"inserted words here" + a[4000:]
    x, y = (set(map(tuple, m.chunks(d)[1].tolist())) for d in (a, b))
    assert len(x - y) <= 6


def brute(docs: dict[int, str]) -> dict[int, tuple[int, list]]:
    data = {i: (t or "").encode() for i, t in docs.items()}
    cuts = {i: borders(d) for i, d in data.items()}
    parts = {i: [(a, data[i][a:b]) for a, b in zip([0, *e], e)] for i, e in cuts.items()}
    count, home = Counter(p for v in parts.values() for _, p in v), {}
    for i in sorted(parts):
        for a, p in parts[i]:
            home.setdefault(p, (i, a))
    whole = lambda d, at: at == len(d) or d[at] & 0xC0 != 0x80
    out = {}
    for i, v in parts.items():
        d, runs = data[i], []
        for a, p in v:
            if count[p] > 1 and home[p] != (i, a):
                if runs and runs[-1][1] == a:
                    runs[-1][1:] = [a + len(p), runs[-1][2], p]
                else:
                    runs.append([a, a + len(p), p, p])
        removed = set()
        for a, b, p, q in runs:
            (j, at), (k, end) = home[p], home[q]
            least = at + len(p) if j == i else 0
            grown = [n for n in range(m.REACH + 1) if n <= a - least and n <= at and d[a - n:a] == data[j][at - n:at] and whole(d, a - n)]
            end += len(q)
            after = [n for n in range(m.REACH + 1) if b + n <= len(d) and end + n <= len(data[k]) and d[b:b + n] == data[k][end:end + n] and whole(d, b + n)]
            a, b = a - max(grown), b + max(after)
            if b - a >= m.MIN_RUN:
                removed |= set(range(a, b))
        spans = []
        for x in sorted(removed):
            if spans and spans[-1][1] == x:
                spans[-1][1] = x + 1
            else:
                spans.append([x, x + 1])
        if spans:
            out[i] = (len(removed), [tuple(r) for r in spans])
    return out


def test_query_against_brute_force(spark):
    docs = {r.doc_id: r.text for r in read(spark, SF, "documents").collect()}
    rows = m.op10_chunks(spark, SF).collect()
    want = brute(docs)
    assert {r.doc_id: (r.n_removed, [(s.start, s.end) for s in r.spans]) for r in rows} == want
    for r in rows:
        data, left, pos = docs[r.doc_id].encode(), b"", 0
        for a, b in want[r.doc_id][1]:
            left, pos = left + data[pos:a], b
        assert r.text == (left + data[pos:]).decode() and r.n_bytes == len(data)
        assert all(f <= r.doc_id for f in r.first_doc_ids)


def test_shared_passage_is_cut_and_clean_texts_stay(spark):
    passage = words(55, 77)
    docs = spark.createDataFrame([(i, words(80, i) + " " + passage + " " + words(80, 500 + i)) for i in range(20)]
                                 + [(100 + i, words(150, 900 + i)) for i in range(20)], "doc_id long, text string")
    rows = m.cut_documents(docs).collect()
    assert {r.doc_id for r in rows} == set(range(1, 20))
    assert all(s.first_doc_id < r.doc_id for r in rows for s in r.spans)


def test_passage_is_cut_to_the_byte(spark):
    """Borders of a repeated passage are not those of chunks; ends are whole characters."""
    passage = words(51, 5)
    docs = [(i, words(40, 10 + i) + f" {i}é" + passage + f"ê{i}" + words(40, 60 + i)) for i in range(8)]
    rows = m.cut_documents(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id for r in rows} == set(range(1, 8))
    for r in rows:
        assert passage not in r.text and r.n_removed >= len(passage.encode())
        assert r.text.startswith(words(40, 10 + r.doc_id)) and r.text.endswith(words(40, 60 + r.doc_id))


def test_no_text_is_lost(spark):
    """Of every passage one copy stays, also of one that repeats inside a document."""
    a, b = words(60, 1), words(60, 2)
    docs = [(1, a + " " + words(30, 3)), (2, words(30, 4) + b + " " + a), (3, b + " " + b + " | " + b), (4, "la " * 300), (5, "x " + "la " * 200)]
    rows = {r.doc_id: r.text for r in m.cut_documents(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    left = {i: rows.get(i, t) for i, t in docs}
    assert left[1] == docs[0][1] and b in left[2] and a not in left[2] and b not in left[3]
    assert "la " * 8 in left[4] and len(left[5]) < 40


def test_edge_cases(spark):
    docs = edge_docs(spark).selectExpr("*", "1 AS n_bytes", "2 AS spans")
    out = m.cut_documents(docs)
    assert sorted(out.columns) == sorted(set(docs.columns) | {"n_removed"})
    rows = out.collect()
    assert {r.doc_id for r in rows} <= {2, 8} and {r.doc_id for r in rows} >= {2, 8}
    assert m.cut_documents(empty_docs(spark)).count() == 0


def test_texts_reach_python_in_small_batches(spark):
    """Arrow batches are bounded by bytes: 40 texts of 100,000 bytes are not one batch."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    docs = spark.range(0, 40, 1, 1).selectExpr("id AS doc_id", "repeat(substr(sha(cast(id AS string)), 1, 10), 10000) AS text")

    def sizes(frames):
        for f in frames:
            yield pd.DataFrame({"n": [int(f["text"].str.len().sum())]})

    try:
        spark.conf.unset(name)
        m.cut_documents(docs)
        seen = [r.n for r in docs.mapInPandas(sizes, "n long").collect()]
        assert sum(seen) == 4_000_000 and max(seen) <= ARROW_BYTES + 100_000
    finally:
        spark.conf.unset(name)


def test_ids_of_other_types(spark):
    """Owners of any id type come back as they were."""
    docs = [(i, words(40, 10 + i) + " " + words(60, 5) + " " + words(40, 60 + i)) for i in range(5)]
    want = {r.doc_id: (r.text, r.spans) for r in m.cut_documents(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert set(want) == {1, 2, 3, 4}
    for kind in ("string", "int"):
        rows = m.cut_documents(spark.createDataFrame(docs, "doc_id long, text string").selectExpr(f"cast(doc_id AS {kind}) AS doc_id", "text")).collect()
        assert {int(r.doc_id): r.text for r in rows} == {i: t for i, (t, _) in want.items()}
        assert all(int(s.first_doc_id) == x.first_doc_id and isinstance(s.first_doc_id, str if kind == "string" else int)
                   for r in rows for s, x in zip(r.spans, want[int(r.doc_id)][1]))
