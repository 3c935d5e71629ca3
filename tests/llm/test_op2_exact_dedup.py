from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import duckdb

from netzero.llm import op2_exact_dedup as m

from .common import edge_docs, edge_rows, empty_docs

SF = "/root/testdata/sf0.001"


def sha(t):
    return hashlib.sha256(re.sub(r"[\x20\x09-\x0d]+", " ", t or "").encode()).hexdigest()


def test_edge_cases(spark):
    groups = defaultdict(list)
    for r in edge_rows():
        groups[sha(r[1])].append(r[0])
    got = defaultdict(list)
    for r in m.exact_dedup(edge_docs(spark)).collect():
        got[r.text_sha256].append(r)
    assert {k: sorted(map(str, v)) for k, v in groups.items()} == {k: sorted(str(r.doc_id) for r in v) for k, v in got.items()}
    for k, rows in got.items():
        ids = [i for i in groups[k] if i is not None]
        assert {r.keep_id for r in rows} == {min(ids) if ids else None}
        assert {r.group_size for r in rows} == {len(rows)}
        assert sum(r.kept for r in rows) == 1


def test_drop_keeps_one_row_and_all_columns(spark):
    out = m.drop_exact_copies(edge_docs(spark))
    assert out.columns == edge_docs(spark).columns
    kept = [sha(r.text) for r in out.collect()]
    assert len(kept) == len(set(kept)) == len({sha(r[1]) for r in edge_rows()})


def test_full_filter_changes_nothing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    tight = m.exact_dedup(docs, max_bits=1)  # one bit: every row may be a repeat
    assert sorted(map(tuple, tight.collect())) == sorted(map(tuple, m.exact_dedup(docs).collect()))


def test_unique_rows_pass_the_filter(spark):
    hashes = spark.range(20_000).selectExpr("sha2(cast(id % 19000 as string), 256) AS _nz_sha", "id AS _nz_id")
    bits = m.filter_bits(20_000)
    tagged = m.flag_possible_repeats(hashes, m.repeated_positions(hashes, bits), bits)
    rep = tagged.where("_nz_id < 1000 OR _nz_id >= 19000")
    assert rep.where("NOT _nz_maybe").count() == 0
    assert tagged.where("_nz_maybe").count() < 2_500


def test_empty(spark):
    assert m.exact_dedup(empty_docs(spark)).count() == 0
    assert m.drop_exact_copies(empty_docs(spark)).count() == 0


def test_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    assert sorted(map(tuple, m.op2_exact_dedup(spark, SF).collect())) == sorted(con.execute(m.ORACLE).fetchall())
