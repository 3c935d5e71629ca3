from __future__ import annotations

import math
import re

from netzero.llm import op6_mixing as m

from .common import edge_docs, edge_rows, empty_docs, read

SF = "/root/testdata/sf0.01"


def targets(sizes: dict, share=1.5, cap=2.0) -> dict:
    """The contract's rule, step by step: deal, stop at the caps, deal the excess again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    out, left, free = dict.fromkeys(order, 0.0), share * sum(sizes.values()), set(order)
    while left > 1e-9 and free:
        total, rest = sum(weight[s] for s in free), left
        left = 0.0
        for s in list(free):
            out[s] += rest * weight[s] / total
            if out[s] >= cap * sizes[s]:
                left += out[s] - cap * sizes[s]
                out[s] = cap * sizes[s]
                free.discard(s)
    return out


def check(rows, near):
    sizes, taken, target = {}, {}, {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
        assert 0 <= r.taken <= 2 * r.size
    want = targets(sizes)
    for s in sizes:
        assert math.isclose(target[s], want[s], rel_tol=1e-9, abs_tol=1e-6)
        assert abs(taken[s] - target[s]) <= near * max(1, target[s])
    assert {(r.source, r.source_size) for r in rows} == set(sizes.items())


def test_query(spark):
    rows = m.op6_mixing(spark, SF).collect()
    texts = {r.doc_id: r for r in read(spark, SF, "documents").collect()}
    assert {r.doc_id for r in rows} == set(texts) and len(rows) == len(texts)
    assert all(r.size == len(re.findall(r"[^\x20\x09-\x0d]+", texts[r.doc_id].text or "")) for r in rows)
    check(rows, 0.01)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, m.op6_mixing(spark, SF).collect()))


def solved(cells, target, cap=2.0):
    """Multiplier of one source by plain bisection: cells are (size, rows)."""
    mean = sum(s * n for s, n in cells) / sum(n for _, n in cells)
    tokens = lambda x: sum(s * n * min(cap, math.exp(min(x * s / mean, 1))) for s, n in cells)
    low, high = -1e6, 1e6
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if tokens(mid) < target else (low, mid)
    return high, tokens


CELLS = [(3, 10), (7, 5), (900, 2), (0, 3)]


def test_newton_meets_the_targets(spark):
    """Many sources at once, from almost nothing to every document at the bound."""
    ratios = [0.0, 0.0001, 0.01, 0.5, 1.0, 1.3, 1.9999, 2.0]
    total = sum(s * n for s, n in CELLS)
    cells = spark.createDataFrame([(f"v{r}", s, n) for r in ratios for s, n in CELLS], "_nz_s string, _nz_size long, _nz_n long")
    t = spark.createDataFrame([(f"v{r}", total, total * r) for r in ratios], "_nz_s string, _nz_total long, _nz_target double")
    got = {r["_nz_s"]: r["_nz_lambda"] for r in m.newton(cells, t).collect()}
    assert got.pop("v0.0") is None
    for r in ratios[1:]:
        want, tokens = solved(CELLS, total * r)
        assert math.isclose(tokens(got[f"v{r}"]), total * r, rel_tol=1e-6)
        assert r in (1.0, 2.0) or math.isclose(got[f"v{r}"], want, rel_tol=1e-4)


def test_rates_are_tilted_by_size(spark):
    """Of a source that gives up tokens, long documents go first; of one that repeats, they come first."""
    docs = spark.range(4000).selectExpr("id AS doc_id", "CASE WHEN id % 20 = 0 THEN 'b' ELSE 'a' END AS source",
                                        "CAST(IF(id % 3 = 0, 20, IF(id % 3 = 1, 200, 1000)) AS LONG) AS size")
    rows = m.mix(docs, "size").selectExpr("*", "copies * size AS taken").collect()
    check(rows, 0.01)
    for source in ("a", "b"):
        mine = [r for r in rows if r.source == source]
        mean = [sum(r.copies for r in mine if r["size"] == n) / sum(r["size"] == n for r in mine) for n in (20, 200, 1000)]
        ratio = mine[0].target / mine[0].source_size
        cells = [(n, sum(r["size"] == n for r in mine)) for n in (20, 200, 1000)]
        x, _ = solved(cells, mine[0].target)
        average = sum(s * n for s, n in cells) / len(mine)
        assert all(abs(k - min(2.0, math.exp(min(x * n / average, 1)))) < 0.05 for k, n in zip(mean, (20, 200, 1000))), (ratio, mean)


def test_hot_cell_is_cut_evenly(spark):
    docs = spark.range(5000).selectExpr("id AS doc_id", "IF(id % 5 = 0, 'b', 'a') AS source", "10L AS size")
    rows = m.mix(docs, "size").selectExpr("*", "copies * size AS taken").collect()
    check(rows, 0.001)


def test_edge_cases(spark):
    docs = edge_docs(spark)
    rows = m.mix(docs.withColumn("size", m.word_count()), "size").selectExpr("*", "copies * size AS taken").collect()
    assert len(rows) == len(edge_rows())
    check(rows, 1.0)
    mixed = m.mixed_documents(docs)
    assert set(mixed.columns) == {*docs.columns, "source_size", "target", "copies", "copy", "size"}
    assert mixed.count() == sum(r.copies for r in m.mix(docs.withColumn("size", m.word_count()), "size").collect())
    assert m.mix(empty_docs(spark), "size").count() == 0
    assert m.mixed_documents(edge_docs(spark, [edge_rows()[4]])).count() in (0, 1)  # only an empty text
