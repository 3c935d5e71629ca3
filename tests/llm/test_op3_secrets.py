from __future__ import annotations

import hashlib
import math
import random
import re

from netzero.llm import op3_secrets as m

from .common import edge_docs, edge_rows, empty_docs, read

SF = "/root/testdata/sf0.001"


def base(t: str) -> list[tuple[str, int, int]]:
    out = []
    for x in re.finditer(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t):
        if len(x[2]) >= 8:
            out.append(("assign", *x.span()))
    out += [("access", *x.span()) for x in re.finditer("AKIA[A-Z0-9]+", t) if len(x[0]) >= 16]
    out += [("hex", *x.span()) for x in re.finditer("[0-9a-f]+", t) if len(x[0]) >= 32]
    return sorted(out, key=lambda r: (r[1], ("assign", "access", "hex").index(r[0])))


def entropy(w: str) -> float:
    return -sum(w.count(c) / len(w) * math.log2(w.count(c) / len(w)) for c in set(w))


def test_base_spans_on_random_strings():
    rnd = random.Random(1)
    parts = ["password", "PassWd", "secret", "token", "api_key", "APIKEY", "AKIA", "=", ":", " ", '"', "'", "ab12", "0123456789abcdef", "Z9", ".", "\n", "ſecret", "toKen"]
    for _ in range(3000):
        t = "".join(rnd.choice(parts) for _ in range(rnd.randint(1, 12)))
        assert [r[:3] for r in m.scan(t) if r[0] in m.BASE_KINDS] == base(t)


def test_incremental_entropy_is_the_direct_one():
    rnd = random.Random(2)
    for _ in range(200):
        s = "".join(rnd.choice("abcdef0123456789"[: rnd.randint(2, 16)]) for _ in range(rnd.randint(0, 70)))
        bits, w = rnd.uniform(1.5, 3.6), 20
        marks = set()
        for i in range(len(s) - w + 1):
            if entropy(s[i:i + w]) >= bits - 1e-9:
                marks |= set(range(i, i + w))
        assert {i for a, b, _ in m.entropy_spans(s, w, bits) for i in range(a, b)} == marks


def test_entropy_spans_and_allow_list():
    kinds = lambda t: [r[0] for r in m.scan(t)]
    assert "entropy_base64" in kinds("x wJalrXUtnFEMI/K7MDENG/bPxRfiCY93kq end")
    assert kinds("id 123e4567-e89b-12d3-a456-426614174000") == []
    assert kinds("wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY") == []
    assert kinds("this-is-a-long-joined-identifier-name") == []
    assert kinds("token=wJalrXUtnFEMI/EXAMPLE") == ["assign"]  # base spans stay


def test_placeholder_words_hide_their_neighbourhood_only():
    rnd = random.Random(4)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWabcdefghijklmnopqrstuvw23456789+/"
    key = "".join(rnd.choices(letters, k=40))
    for t in (f"db_sample_key={key}", f"sample={key}", f"sk_example_{key}", f"{key}=xxxx", f"{key}={'x' * 8}"):
        spans = [r for r in m.scan(t) if r[0] == "entropy_base64"]
        assert {i for r in spans for i in range(r[1], r[2])} >= set(range(t.find(key), t.find(key) + 40)), t
    run = "".join(rnd.choices(letters, k=3000))
    long = run[:1500] + "xxxx" + run[1500:]
    marks = {i for r in m.scan(long) if r[0] == "entropy_base64" for i in range(r[1], r[2])}
    assert len(marks) > 2800 and not marks & set(range(1500 - m.NEAR, 1504 + m.NEAR))
    assert m.scan("x" * 20 + "EXAMPLE1") == [] and m.scan("wJalrXUtnFEMI7MDENG_bPxRfiCYEXAMPLEKEY") == []


def test_edge_cases(spark):
    got = m.find_secrets(edge_docs(spark))
    assert got.count() == len(edge_rows())
    assert got.where("size(found) > 0").count() == 0
    assert m.find_secrets(empty_docs(spark)).count() == 0


def test_query_against_brute_force(spark):
    texts = {r.doc_id: r.text for r in read(spark, SF, "documents").collect()}
    rows = m.op3_secrets(spark, SF).collect()
    assert {r.doc_id for r in rows} == set(texts)
    for r in rows:
        want = base(texts[r.doc_id] or "")
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(x[0] == k for x in want) for k in m.BASE_KINDS]
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [s for s in r.spans.split(",") if s.split(":")[0] in m.BASE_KINDS] == ([joined] if joined.count(",") == 0 and joined else joined.split(",") if joined else [])
