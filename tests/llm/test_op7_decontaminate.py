from __future__ import annotations

import random

from netzero.llm import op7_decontaminate as m

from .common import edge_docs, edge_rows, empty_docs, read, words

SF = "/root/testdata/sf0.01"


def edits(p: str, t: str) -> int:
    """Least edits of all of p to any stretch of t."""
    row = [0] * (len(t) + 1)
    for i, c in enumerate(p, 1):
        prev, row[0] = row[0], i
        for j, x in enumerate(t, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (c != x))
    return min(row)


def distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, x in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (c != x))
    return row[-1]


def edited(t: str, n: int, rnd) -> str:
    s = list(t)
    for _ in range(n):
        i = rnd.randrange(len(s))
        kind = rnd.randrange(3)
        s[i:i + (kind != 1)] = [] if kind == 0 else [rnd.choice("xyzq")]
    return "".join(s)


def test_scan_against_brute_force():
    rnd = random.Random(5)
    items = [(i, words(rnd.randint(6, 30), 100 + i)) for i in range(12)]
    items = [x for x in items if len(x[1]) >= m.MIN_ITEM]
    index = m.Index(items)
    for trial in range(60):
        i, t = rnd.choice(items)
        text = words(rnd.randint(0, 12), trial) + " " + edited(t, rnd.randint(0, 2 * m.budget(len(t)) + 1), rnd) + words(rnd.randint(0, 12), trial + 999)
        if trial % 4 == 0:
            text = text.upper()
        norm = m.normal(text)
        want = {j for j, x in items if edits(m.normal(x), norm) <= m.budget(len(x))}
        found = m.scan(index, ["", text, "no"])
        assert found[0] == found[2] == []
        assert {f["item_id"] for f in found[1]} == want
        for f in found[1]:
            x = m.normal(dict(items)[f["item_id"]])
            assert distance(x, m.normal(text[f["start"]:f["end"]])) == f["edits"] == edits(x, norm)


def test_long_text_in_pieces(monkeypatch):
    items = [(1, words(20, 7)), (2, words(20, 8))]
    text = words(300, 9) + items[0][1] + words(300, 10) + items[1][1] + items[0][1]
    whole = m.scan(m.Index(items), [text])
    monkeypatch.setattr(m, "SCAN_CHARS", 64)
    assert m.scan(m.Index(items), [text]) == whole and len(whole[0]) == 3


def test_parts_of_long_items(spark):
    item = words(60, 7)
    half, n = len(item) // 2, len(item)
    around = lambda t: words(30, 8) + " " + t + " " + words(30, 9)
    texts = {1: around(item[:300]), 2: around(item[:half] + " " + words(25, 10) + " " + item[half:]), 3: around(item[:150] + item[n - 150:]),
             4: around(item[40:40 + m.PASSAGE + m.STRIDE - 1].upper()), 5: around(item), 6: around(item[:60]), 7: words(90, 11)}
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = m.contaminations(docs, bench).collect()
    assert {r.doc_id for r in rows} == {1, 2, 3, 4, 5}
    assert [(r.end - r.start, r.edits) for r in rows if r.doc_id == 5] == [(n, 0)]
    assert sum(r.doc_id == 2 for r in rows) == 2
    for r in rows:
        assert r.doc_id == 3 or m.normal(texts[r.doc_id])[r.start:r.end] in m.normal(item) or r.edits
    assert {r.doc_id for r in m.drop_contaminated(docs, bench).collect()} == {6, 7}


def test_edge_cases(spark):
    bench = spark.createDataFrame([(1, words(60, 2)), (2, None), (3, " one\ttwo "), (4, " \n"), (None, words(60, 4)), (1, words(60, 2))],
                                  "item_id long, text string")
    rows = m.contaminations(edge_docs(spark), bench).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == {(1, 1), (2, 1), (3, 1), (9, None), (10, 3), (11, 3)}
    kept = m.drop_contaminated(edge_docs(spark), bench)
    assert kept.columns == edge_docs(spark).columns and kept.count() == len(edge_rows()) - 7
    blocks = m.contaminations(edge_docs(spark), bench, block_chars=100)
    assert sorted(map(str, blocks.collect())) == sorted(map(str, rows))
    assert m.contaminations(empty_docs(spark), bench).count() == 0
    assert m.contaminations(edge_docs(spark), bench.where("false")).count() == 0
    assert m.drop_contaminated(edge_docs(spark), bench.where("false")).count() == len(edge_rows())


def test_white_space_costs_no_edits(spark):
    item = words(40, 7)
    ragged = " \n\t" + item.replace(" ", " \r\n   ") + "\t"
    text = "Before it. " + item.replace(" ", "  \n") + " After."
    bench = spark.createDataFrame([(1, item), (2, ragged)], "item_id long, text string")
    rows = m.contaminations(spark.createDataFrame([(1, text), (2, item), (3, words(40, 8))], "doc_id long, text string"), bench).collect()
    assert {(r.doc_id, r.item_id, r.edits) for r in rows} == {(d, i, 0) for d in (1, 2) for i in (1, 2)}
    assert all(m.normal(text[r.start:r.end]) == item for r in rows if r.doc_id == 1)


def test_short_items_stand_between_word_borders():
    index = m.Index([(1, "Ab c"), (2, "(x)"), (3, "é"), (4, "ab"), (5, "ab")])
    text = "ab  C, fab c; ab cd (X)y É1 é"
    got = {(f["item_id"], text[f["start"]:f["end"]]) for f in m.scan(index, [text])[0]}
    assert got == {(1, "ab  C"), (2, "(X)"), (3, "é"), (4, "ab"), (5, "ab")}
    starts = [f["start"] for f in m.scan(index, [text])[0] if f["item_id"] == 4]
    assert starts == [0, 14]  # not inside "fab"


def test_every_block_has_its_own_index(spark):
    """Many benchmarks in one reused worker: none is answered from another's index."""
    docs = spark.createDataFrame([(i, words(12, i)) for i in range(12)], "doc_id long, text string").coalesce(1)
    for i in range(12):
        bench = spark.createDataFrame([(i, words(12, i))], "item_id long, text string")
        assert [(r.doc_id, r.item_id) for r in m.contaminations(docs, bench).collect()] == [(i, i)]
    every = spark.createDataFrame([(i, words(12, i)) for i in range(12)], "item_id long, text string")
    rows = m.contaminations(docs, every, block_chars=60).collect()
    assert sorted((r.doc_id, r.item_id) for r in rows) == [(i, i) for i in range(12)]


def test_query_finds_exact_items(spark):
    docs = {r.doc_id: m.normal(r.text or "") for r in read(spark, SF, "documents").collect()}
    items = {r.item_id: m.normal(r.text) for r in read(spark, SF, "benchmark").collect()}
    want = {(d, i) for d, t in docs.items() for i, x in items.items() if x in t}
    rows = m.op7_decontaminate(spark, SF).collect()
    assert want and want <= {(r.doc_id, r.item_id) for r in rows}
    texts = {r.doc_id: r.text for r in read(spark, SF, "documents").collect()}
    for r in rows:
        assert distance(items[r.item_id], m.normal(texts[r.doc_id][r.start:r.end])) == r.edits <= m.budget(len(items[r.item_id]))
