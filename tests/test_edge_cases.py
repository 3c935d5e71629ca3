"""Golden edge cases of the netting rule (literal rows, expected statuses)."""

from __future__ import annotations

from decimal import Decimal

import pytest

from netzero.functions import group_uuid
from netzero.operators import normalize, reconcile, rejected_amounts

ROWS = [
    # (transactionID, raw amount) — one company E, one account C
    ("T1", "10.00"), ("T1", "-10.00"),        # base: reconciled, one shared id
    ("T2", "5.00"),                           # base: pending
    (None, "1.00"), (None, "-1.00"),          # null key never reconciles
    ("", "3.00"), ("", "-3.00"),              # empty string is an ordinary key
    ("T3", None),                             # all-null amounts: no balance
    ("T4", "0.00"),                           # lone zero
    ("T5", None), ("T5", "0.00"),             # null + zero
    ("T6", "0.004"),                          # rounds to 0.00 when typed
    (" t7 ", "1.00"), ("T7", "-1.00"),        # cleaning joins the spellings
    ("T8", "abc"), ("T8", "0.00"),            # bad amount is null, group balances
]
EXPECTED = {
    "T1": "CONCILIADO", "T2": "PENDENTE", None: "PENDENTE", "": "CONCILIADO",
    "T3": "PENDENTE", "T4": "CONCILIADO", "T5": "CONCILIADO", "T6": "CONCILIADO",
    "T7": "CONCILIADO", "T8": "CONCILIADO",
}


@pytest.fixture(scope="module")
def raw(spark):
    return spark.createDataFrame(
        [("E", "C", t, v) for t, v in ROWS],
        "empresa string, conta_contabil string, transactionID string, valor_net string")


@pytest.mark.parametrize("strategy", ["join", "salted"])
def test_statuses(spark, raw, strategy):
    out = reconcile(normalize(raw), strategy=strategy).collect()
    assert len(out) == len(ROWS)
    by_txn: dict = {}
    for r in out:
        by_txn.setdefault(r.transactionID, set()).add((r.reconciliation_status, r.conciliation_id))
    for txn, expected in EXPECTED.items():
        got = by_txn[txn]
        assert {s for s, _ in got} == {expected}, txn
        ids = {i for _, i in got}
        if expected == "CONCILIADO":
            assert len(ids) == 1 and None not in ids, txn
        else:
            assert ids == {None}, txn


def test_ids_distinct_and_deterministic(spark, raw):
    a = reconcile(normalize(raw)).where("conciliation_id is not null")
    ids = {(r.transactionID, r.conciliation_id) for r in a.collect()}
    assert len({i for _, i in ids}) == len({t for t, _ in ids})
    b = reconcile(normalize(raw), strategy="salted").where("conciliation_id is not null")
    assert ids == {(r.transactionID, r.conciliation_id) for r in b.collect()}


def test_uuid_shape_and_separator(spark):
    df = spark.createDataFrame([("A|B", "C"), ("A", "B|C")], "a string, b string")
    ids = [r[0] for r in df.select(group_uuid(["a", "b"])).collect()]
    assert ids[0] != ids[1]
    assert all([len(p) for p in i.split("-")] == [8, 4, 4, 4, 12] for i in ids)


def test_rejected_amounts(spark, raw):
    rej = rejected_amounts(raw).collect()
    assert [(r.transactionID, r.raw_amount) for r in rej] == [("T8", "abc")]


def test_overflow_is_rejected_not_raised(spark):
    df = spark.createDataFrame([("E", "C", "T", "12345678901234567890.00")],
                               "empresa string, conta_contabil string, transactionID string, valor_net string")
    assert normalize(df).first().valor_net is None
    assert rejected_amounts(df).count() == 1


def test_typed_amount_rounding(spark):
    df = spark.createDataFrame([("E", "C", "T", "1.005"), ("E", "C", "U", "-2.344")],
                               "empresa string, conta_contabil string, transactionID string, valor_net string")
    vals = sorted(r.valor_net for r in normalize(df).collect())
    assert vals == [Decimal("-2.34"), Decimal("1.01")]


def test_reconcile_results_again(spark, raw):
    """Earlier results plus a late entry: statuses are recomputed."""
    first = reconcile(normalize(raw))
    late = spark.createDataFrame([("E", "C", "T2", "-5.00")],
                                 "empresa string, conta_contabil string, transactionID string, valor_net string")
    again = reconcile(first.unionByName(normalize(late), allowMissingColumns=True))
    t2 = {r.reconciliation_status for r in again.where("transactionID = 'T2'").collect()}
    assert t2 == {"CONCILIADO"} and again.count() == len(ROWS) + 1
    assert again.columns == first.columns


def test_untyped_amounts_rejected(spark, raw):
    with pytest.raises(TypeError):
        reconcile(raw)  # amounts still text
    cents = spark.createDataFrame([("E", "C", "T", 100), ("E", "C", "T", -100)],
                                  "empresa string, conta_contabil string, transactionID string, valor_net bigint")
    assert {r.reconciliation_status for r in reconcile(cents).collect()} == {"CONCILIADO"}
