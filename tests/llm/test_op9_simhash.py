from __future__ import annotations

import random
import re

import numpy as np
import xxhash

from netzero.llm import op9_simhash as m

from .common import edge_docs, edge_rows, empty_docs, read

SF = "/root/testdata/sf0.01"


def fp(t):
    b = bytes(c + 32 if 65 <= c <= 90 else c for c in (t or "").encode())
    w = [x for x in re.split(rb"[\x20\x09-\x0d]+", b) if x]
    if not w:
        return 0
    s = [b" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))]
    hs = [xxhash.xxh64(x, seed=42).intdigest() for x in s]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hs) > len(hs))


def components(fps: list[int], distance=3) -> dict[int, int]:
    u = np.array(sorted(set(fps)), np.uint64)
    up = list(range(len(u)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i
    for i in range(len(u)):
        for j in np.flatnonzero(np.bitwise_count(u[i + 1:] ^ u[i]) <= distance) + i + 1:
            up[find(int(j))] = find(i)
    return {int(x): find(i) for i, x in enumerate(u)}


def test_linked_halves_meet_at_an_anchor():
    rnd = random.Random(1)
    for radius, far in ((1, 0), (2, 1)):
        x = np.array([rnd.getrandbits(32) for _ in range(400)], np.uint64)
        y = x.copy()
        for i in range(len(y)):
            for b in rnd.sample(range(32), far):
                y[i] ^= np.uint64(1 << b)
        reach = lambda v: [set(a[r == i].tolist()) for i in range(1) for r, a in m.anchors(v, radius)]
        for p, q in zip(x, y):
            a, b = set().union(*reach(np.array([p]))), set().union(*reach(np.array([q])))
            assert a & b and len(a) <= 17
            assert all(bin(int(c) ^ int(p)).count("1") <= radius for c in a)


def test_links_of_planted_fingerprints(spark):
    rnd = random.Random(2)
    fps = [rnd.getrandbits(64) for _ in range(40)]
    for _ in range(300):  # chains and clusters, up to 5 bits away
        x = rnd.choice(fps)
        for b in rnd.sample(range(64), rnd.randint(1, 5)):
            x ^= 1 << b
        fps.append(x)
    want = components(fps)
    signed = [int(np.uint64(x).view(np.int64)) for x in set(fps)]
    nodes = spark.createDataFrame([(x,) for x in signed], "fp long")
    for limit in (20_000, 5):  # the second splits hot anchors
        found = {r.node: r.root for r in m.components(m.links(nodes, limit=limit)).collect()}
        groups = {}
        for x in set(fps):
            s = int(np.uint64(x).view(np.int64))
            groups.setdefault(want[x], set()).add(found.get(s, s))
        assert all(len(g) == 1 for g in groups.values()) and len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_forest_spans_large_runs():
    rnd = random.Random(3)
    x = rnd.getrandbits(64)
    near = np.unique(np.array([x ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(64)) for _ in range(300)], np.uint64))
    edges = m._forest(near, 3)
    assert sum(len(a) for a, _ in edges) <= len(near) - 1
    want = components([int(v) for v in near])
    assert len(near) - sum(len(a) for a, _ in edges) == len(set(want.values()))


def test_edge_cases(spark):
    rows = edge_rows()
    want = components([fp(r[1]) for r in rows])
    best = {}
    for r in rows:
        if r[0] is not None:
            g = want[fp(r[1])]
            best[g] = min(best.get(g, r[0]), r[0])
    got = m.simhash_components(edge_docs(spark)).collect()
    assert sorted(str(tuple(r)) for r in got) == sorted(str((r[0], f"{fp(r[1]):016x}", best.get(want[fp(r[1])]))) for r in rows)
    kept = m.drop_near_copies(edge_docs(spark))
    assert kept.columns == edge_docs(spark).columns
    assert {r.doc_id for r in kept.collect()} == {None, *best.values()}
    assert m.simhash_components(empty_docs(spark)).count() == 0
    assert m.drop_near_copies(empty_docs(spark)).count() == 0


def test_blocks_do_not_change_a_fingerprint(monkeypatch):
    text = edge_rows()[6][1]
    monkeypatch.setattr(m, "BLOCK", 7)
    assert m.fingerprint(text) == fp(text)


def test_query_against_brute_force(spark):
    docs = read(spark, SF, "documents").collect()
    want = components([fp(r.text) for r in docs])
    best = {}
    for r in docs:
        g = want[fp(r.text)]
        best[g] = min(best.get(g, r.doc_id), r.doc_id)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in m.op9_simhash(spark, SF).collect()}
    assert got == {r.doc_id: (f"{fp(r.text):016x}", best[want[fp(r.text)]]) for r in docs}
