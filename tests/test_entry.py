"""Driver contract: entry() runs; every query has an oracle and matches it
on the smallest tables (the driver's gate, in miniature)."""

from __future__ import annotations

import decimal
import os

import duckdb
import pytest

import __spark_entry__ as E
from netzero.plans import catalog

from .conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns[:3] == ["empresa", "conta_contabil", "transactionID"]
    assert df.count() == 6898


def test_every_query_has_oracle():
    assert set(catalog.QUERIES) <= set(E.oracle_sql())
    assert set(catalog.QUERIES) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def norm(v):
        if isinstance(v, decimal.Decimal):
            return f"{v:.6f}"
        return repr(v)
    return sorted(tuple(norm(r[i]) for i in order) for r in rows)


DUCK_TYPES = {"VARCHAR": "string", "BIGINT": "bigint", "INTEGER": "int", "DATE": "date",
              "BOOLEAN": "boolean", "DOUBLE": "double"}


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    rel = duck.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    duck_types = {c: DUCK_TYPES.get(str(t), str(t).lower().replace(" ", ""))
                  for c, t in zip(rel.columns, rel.types)}
    assert dict(df.dtypes) == duck_types
    assert canon(df.collect(), df.columns) == canon(rel.fetchall(), rel.columns)
