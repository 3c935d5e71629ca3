"""Invariants of reconciliation on the test-table ledger, and a property test
against a brute-force Python model on random small ledgers."""

from __future__ import annotations

from collections import defaultdict
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from netzero.operators import normalize, reconcile, txn_summary
from netzero.sources import ledger_from_tables

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def entries(spark):
    return normalize(ledger_from_tables(spark, SF_SMALL))


@pytest.fixture(scope="module")
def result(entries):
    return reconcile(entries).collect()


def test_row_count_kept(entries, result):
    assert len(result) == entries.count() == 6898


def test_fixture_counts(result):
    done = [r for r in result if r.reconciliation_status == "CONCILIADO"]
    nulls = [r for r in result if r.transactionID is None]
    assert len(done) == 2591 and len(nulls) == 81
    assert all(r.reconciliation_status == "PENDENTE" for r in nulls)


def test_groups_balance_and_ids(result):
    sums: dict = defaultdict(Decimal)
    ids: dict = defaultdict(set)
    for r in result:
        assert (r.conciliation_id is not None) == (r.reconciliation_status == "CONCILIADO")
        if r.conciliation_id is not None:
            key = (r.empresa, r.conta_contabil, r.transactionID)
            sums[key] += r.valor_net or Decimal(0)
            ids[key].add(r.conciliation_id)
    assert all(v == 0 for v in sums.values())
    assert all(len(v) == 1 for v in ids.values())
    flat = [next(iter(v)) for v in ids.values()]
    assert len(flat) == len(set(flat))


def test_strategies_and_partitioning_agree(spark, entries, result):
    base = sorted(map(tuple, result), key=repr)
    salted = sorted(map(tuple, reconcile(entries, strategy="salted", salts=3).collect()), key=repr)
    assert salted == base
    shuffled = reconcile(entries.repartition(3, "valor_net")).collect()
    assert sorted(map(tuple, shuffled), key=repr) == base


def test_summary_matches_entries(entries, result):
    summary = {(r.empresa, r.conta_contabil, r.transactionID): r
               for r in txn_summary(entries).collect()}
    assert sum(r.n_entries for r in summary.values()) == len(result)
    for r in result:
        s = summary[(r.empresa, r.conta_contabil, r.transactionID)]
        assert s.conciliation_id == r.conciliation_id


def test_bad_strategy(entries):
    with pytest.raises(ValueError):
        reconcile(entries, strategy="window")


# --- property test against a brute-force model --------------------------------

def model(rows):
    """Pure-Python statement of the rule."""
    bal: dict = {}
    for e, c, t, v in rows:
        k = (e, c, t)
        if v is not None:
            bal[k] = (bal.get(k) or Decimal(0)) + v
        else:
            bal.setdefault(k, None)
    return [
        (e, c, t, v, "CONCILIADO" if None not in (e, c, t) and bal[(e, c, t)] == 0 else "PENDENTE")
        for e, c, t, v in rows
    ]


amount = st.one_of(st.none(), st.integers(-3, 3).map(lambda i: Decimal(i).quantize(Decimal("0.01"))))
row = st.tuples(st.sampled_from(["A", "B", None]), st.sampled_from(["1", None]),
                st.sampled_from(["X", "Y", "Z", "", None]), amount)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row, min_size=0, max_size=30))
def test_property_vs_model(spark, rows):
    df = spark.createDataFrame(
        rows, "empresa string, conta_contabil string, transactionID string, valor_net decimal(18,2)")
    for strategy in ("join", "salted"):
        got = reconcile(df, strategy=strategy).select(
            "empresa", "conta_contabil", "transactionID", "valor_net", "reconciliation_status")
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(model(rows), key=repr)


def test_hot_group_spread(spark):
    """One group holding most rows still nets correctly under both plans."""
    hot = spark.range(20000).select(
        F.lit("E").alias("empresa"), F.lit("C").alias("conta_contabil"),
        F.when(F.col("id") < 15000, F.lit("HOT")).otherwise(F.col("id").cast("string")).alias("transactionID"),
        F.when(F.col("id") % 2 == 0, F.lit(1)).otherwise(F.lit(-1)).cast("decimal(18,2)").alias("valor_net"),
        F.col("id").alias("seq"))
    for strategy in ("join", "salted"):
        out = reconcile(hot, strategy=strategy)
        counts = {r[0]: r[1] for r in out.groupBy("reconciliation_status").count().collect()}
        assert counts == {"CONCILIADO": 15000, "PENDENTE": 5000}


def test_null_key_rows_are_spread(spark):
    """Rows with a null key (never reconciled) do not all go to one task."""
    import pandas as pd

    n = 40_000
    df = spark.range(0, n, 1, 4).select(
        F.lit("E").alias("empresa"), F.lit("C").alias("conta_contabil"),
        F.lit(None).cast("string").alias("transactionID"),
        (F.col("id") % 1000).cast("decimal(18,2)").alias("valor_net"), F.col("id").alias("seq"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = reconcile(df)

        def count(it):
            yield pd.DataFrame({"n": [sum(len(b) for b in it)]})
        sizes = [r.n for r in out.mapInPandas(count, "n long").collect()]
        assert sum(sizes) == n and max(sizes) < n / 2
        assert out.where("reconciliation_status = 'PENDENTE'").count() == n
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_salt_columns_spread_copies(spark, scratch):
    """Exact copies share a content hash; an entry id spreads them."""
    import pandas as pd

    n = 30_000
    path = scratch("copies")  # read back from files: literals would be constant-folded
    spark.range(0, n, 1, 4).select(
        F.lit("E").alias("empresa"), F.lit("C").alias("conta_contabil"), F.lit("HOT").alias("transactionID"),
        F.lit(0).cast("decimal(18,2)").alias("valor_net"), F.col("id").alias("entry_id")).write.parquet(path)
    df = spark.read.parquet(path)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        def count(it):
            yield pd.DataFrame({"n": [sum(len(b) for b in it)]})
        copies = df.drop("entry_id")
        by_content = reconcile(copies, strategy="salted")
        by_id = reconcile(df, strategy="salted", salt_columns=["entry_id"])
        assert max(r.n for r in by_content.mapInPandas(count, "n long").collect()) == n
        assert max(r.n for r in by_id.mapInPandas(count, "n long").collect()) < n / 4
        assert by_id.where("reconciliation_status = 'CONCILIADO'").count() == n
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
