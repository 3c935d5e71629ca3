from __future__ import annotations

import re

import pytest

from netzero.llm import op1_pii as m

from .common import edge_docs, empty_docs, read

SF = "/root/testdata/sf0.001"
LINE = ("card 4111 1111 1111 1111 and 4111-1111-1111-1111, number 4111111111111112, ssn 123-45-6789 on 2021-02-28, "
        "31.12.1999 02/29/2021 2021-02-30 ip 10.0.0.1 999.1.1.1 mail Jo.Smith7@mail3.example.com "
        "+1 (017) 555-7713 iban DE89 3704 0044 0532 0130 00 GB82WEST12345698765432 GB83WEST12345698765432 end")


def luhn(s: str) -> bool:
    d = [int(c) for c in re.sub(r"\D", "", s)][::-1]
    return sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(d)) % 10 == 0


def one(spark, text, **kw):
    return m.pseudonymise(spark.createDataFrame([(1, text)], "doc_id long, text string"), **kw).first()


def test_finds_and_formats(spark):
    r = one(spark, LINE)
    assert [p.kind for p in r.pii] == ["card", "card", "ssn", "date", "date", "ip", "email", "phone", "iban", "iban"]
    shape = lambda s: re.sub(r"[A-Z]", "A", re.sub(r"[a-z]", "a", re.sub(r"\d", "0", s)))
    assert re.sub(r"0+\.0+\.0+\.0+", "ip", shape(r.text)) == re.sub(r"0+\.0+\.0+\.0+", "ip", shape(LINE))
    cards = [p.value for p in r.pii if p.kind == "card"]
    assert all(map(luhn, cards)) and re.sub(r"\D", "", cards[0]) == re.sub(r"\D", "", cards[1])
    for iban in (p.value.replace(" ", "") for p in r.pii if p.kind == "iban"):
        assert int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1
    for kept in ("4111111111111112", "02/29/2021", "2021-02-30", "999.1.1.1", "GB83WEST12345698765432", "@mail3.example.com"):
        assert kept in r.text
    for gone in ("4111 1111", "123-45-6789", "2021-02-28", "10.0.0.1", "Smith", "555-7713", "0532 0130"):
        assert gone not in r.text


def test_round_trip_and_keys(spark):
    a, b = one(spark, LINE), one(spark, LINE, key="another")
    assert a.text != b.text
    assert one(spark, a.text, invert=True).text == LINE


NEAR = [  # (text, the kinds in it, what must stay, what must go)
    ("ES91 2100 0418 4502 0005 1332 EUR 50", ["iban"], " EUR 50", "2100 0418"),
    ("ES9121000418450200051332 BIC X", ["iban"], " BIC X", "21000418450200051332"),
    ("BE68 5390 0754 7034 AB12 x", ["iban"], " AB12 x", "5390 0754"),
    ("AB12 DE89 3704 0044 0532 0130 00 x", ["iban"], "AB12 DE", "3704 0044"),
    ("4111 1111 1111 1111 12/27", ["card"], " 12/27", "4111 1111"),
    ("4111111111111111 123", ["card"], " 123", "4111111111111111"),
    ("123 4111111111111111", ["card"], "123 ", "4111111111111111"),
    ("1234 4111 1111 1111 1111 end", ["card"], " end", "4111 1111 1111 1111"),
    ("No.4111111111111111, no-4111111111111111", ["card", "card"], "No.", "4111111111111111"),
    ("4111111111111111 10.0.0.1", ["card", "ip"], ".", "4111111111111111"),
    ("123 2021-02-28 4111 1111 1111 1111", ["date", "card"], "123 ", "4111 1111"),
    ("+1 (017) 555-7713 4111 1111 1111 1111", ["phone", "card"], "+1 (", "555-7713"),
]


def test_short_tokens_next_to_numbers(spark):
    rows = spark.createDataFrame([(i, x[0]) for i, x in enumerate(NEAR)], "doc_id long, text string")
    out = m.pseudonymise(rows)
    for r in out.collect():
        text, kinds, stays, gone = NEAR[r.doc_id]
        assert [p.kind for p in r.pii] == kinds and stays in r.text and gone not in r.text, (text, r.text)
        assert len(r.text) == len(text) or "ip" in kinds
    assert {r.doc_id: r.text for r in m.pseudonymise(out.select("doc_id", "text"), invert=True).collect()} == {i: x[0] for i, x in enumerate(NEAR)}


def test_round_trip_beside_groups(spark):
    import random
    rnd = random.Random(3)
    number = lambda n: next(x for x in iter(lambda: "".join(rnd.choices("0123456789", k=n)), "") if luhn(x))
    four = lambda x: " ".join(x[i:i + 4] for i in range(0, len(x), 4))
    texts = [f"{rnd.choice(['', 'x ', '1234 ', '12 '])}{four(number(16))} {rnd.choice(['123', '12/27', '1', '1234'])}" for _ in range(150)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = m.pseudonymise(rows)
    got = {r.doc_id: r.text for r in m.pseudonymise(out.select("doc_id", "text"), invert=True).collect()}
    assert got == dict(enumerate(texts)) and out.where("size(pii) = 0").count() == 0


@pytest.mark.parametrize("digits", [2, 3])
def test_permutation_of_all_values(spark, digits):
    from pyspark.sql import functions as F
    d = spark.range(10 ** digits).select(F.lpad(F.col("id").cast("string"), digits, "0").alias("d"))
    got = {r[0] for r in d.select(m.permute_digits("k", "t", F.col("d"))).collect()}
    assert got == {str(i).zfill(digits) for i in range(10 ** digits)}


def test_dates_are_a_permutation(spark):
    from pyspark.sql import functions as F
    n = m.DAY_LEFT * m.DAY_RIGHT
    d = spark.range(n).select(F.date_format(F.date_add(F.lit(m.FIRST_DAY).cast("date"), F.col("id").cast("int")), "yyyy-MM-dd").alias("d"))
    assert d.select(m._pseudo_date("k", F.col("d"), False).alias("x")).distinct().count() == n


def test_edge_cases(spark):
    before = edge_docs(spark)
    after = m.pseudonymise(before)
    assert after.columns == [*before.columns, "pii"]
    assert sorted(map(str, after.drop("pii").collect())) == sorted(map(str, before.collect()))
    assert m.pseudonymise(empty_docs(spark)).count() == 0


def test_query_reverses_to_the_table(spark):
    out = m.op1_pii(spark, SF)
    back = {r.doc_id: r.text for r in m.pseudonymise(out.select("doc_id", "text"), invert=True).collect()}
    assert back == {r.doc_id: r.text for r in read(spark, SF, "documents").collect()}
    assert out.where("n_found > 0").count() > 0
