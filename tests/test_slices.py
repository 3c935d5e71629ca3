"""Slices read by their directories, isolation of a damaged slice, counts per request."""

from __future__ import annotations

import json
import os
from urllib.parse import unquote

import pytest

from netzero.operators import parse_requests
from netzero.plans.jobs import letters_of, process_requests, request_counts
from netzero.plans.sink import slice_counts
from netzero.plans.worker import origin_columns, requested_slices, slice_blocks
from netzero.sources import LEDGER_SCHEMA, MissingDataset, existing_slices, ledger_from_tables, read_ledger, read_slices
from netzero.sources.slices import slice_directory, wanted_directories

from .conftest import SF_SMALL

KEYS = "empresa string, conta_contabil string"


@pytest.fixture(scope="module")
def ledger(spark):
    from netzero.sources import scratch_path

    path = scratch_path(spark, "slices") + "/ledger"
    ledger_from_tables(spark, SF_SMALL).write.partitionBy("empresa", "conta_contabil").parquet(path)
    return path


def slices_of(df):
    return {tuple(unquote(p).split("=", 1)[1] for p in f.split("/")[-3:-1]) for f in df.inputFiles()}


def plan_of(df):
    return df._jdf.queryExecution().toString()


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def body(e, c, p="ledger", i="x"):
    return json.dumps({"partition_id": i, "data": {"empresa": e, "conta_contabil": c, "data_source_path": p}})


WANTED = [(" building ", "1-URGENT"), (" machinery ", "5-LOW")]


def test_only_requested_directories_are_in_the_index(spark, ledger):
    wanted = spark.createDataFrame(WANTED + [("nobody", "0"), (None, "5-LOW"), WANTED[0]], KEYS)
    out = read_slices(spark, ledger, wanted)
    assert slices_of(out) == set(WANTED) and "InMemoryFileIndex(2 paths)" in plan_of(out)
    assert rows(out) == rows(read_slices(spark, ledger, WANTED))
    none = read_slices(spark, ledger, wanted.where("empresa = 'nobody'"), LEDGER_SCHEMA)
    assert none.count() == 0 and set(none.columns) == set(out.columns)


def test_large_request_sets_are_joined_with_the_listing(spark, ledger):
    many = spark.createDataFrame(WANTED + [(f"absent{i}", "0") for i in range(500)], KEYS)
    assert wanted_directories(spark, ledger, many, direct=10) == sorted(WANTED) == wanted_directories(spark, ledger, many)
    plan = plan_of(read_slices(spark, ledger, many))
    assert "absent" not in plan and "InMemoryFileIndex(2 paths)" in plan  # no literals
    assert existing_slices(spark, ledger).count() == 25


def test_values_are_escaped_as_in_directory_names(spark, scratch):
    odd = [(" a/b ", "1-X"), ("c%d", "0011"), ("{q}", "é +"), ("[z]*?", "'\""), ("p:=#", "x\\y"), ("^~&;", "%20")]
    path = scratch("odd")
    spark.createDataFrame([(*k, i) for i, k in enumerate(odd)], KEYS + ", v int").write.partitionBy(
        "empresa", "conta_contabil").parquet(path)
    for k in odd:
        assert os.path.isdir(slice_directory(path, k))
    assert sorted(map(tuple, existing_slices(spark, path).collect())) == sorted(odd)
    keys = spark.createDataFrame(odd[1:], KEYS)
    for direct in (1000, 2):
        assert wanted_directories(spark, path, keys, direct=direct) == sorted(odd[1:])
    out = read_slices(spark, path, keys, "v int, " + KEYS)
    assert sorted((r.empresa, r.conta_contabil, r.v) for r in out.collect()) == sorted((*k, i) for i, k in enumerate(odd) if i)


def test_other_layouts_are_filtered(spark, scratch, ledger):
    """A dataset nested the other way round has no such directories: predicates instead."""
    path = scratch("swapped")
    read_ledger(spark, ledger).write.partitionBy("conta_contabil", "empresa").parquet(path)
    wanted = spark.createDataFrame(WANTED + [("absent", "0")], KEYS)
    out = read_slices(spark, path, wanted)
    assert rows(out) == rows(read_slices(spark, ledger, wanted)) and "absent" not in plan_of(out)


def test_missing_dataset(spark, ledger):
    with pytest.raises(MissingDataset):
        read_slices(spark, ledger + "-none", spark.createDataFrame(WANTED, KEYS))


@pytest.fixture(scope="module")
def damaged(spark, ledger):
    """Root with a dataset of 25 slices, one damaged."""
    from netzero.sources import scratch_path

    root = scratch_path(spark, "damaged")
    read_ledger(spark, ledger).write.partitionBy("empresa", "conta_contabil").parquet(f"{root}/ledger")
    with open(slice_directory(f"{root}/ledger", WANTED[0]) + "/part-99999.parquet", "w") as fh:
        fh.write("not parquet")
    return root


def all_requests(spark, ledger):
    keys = sorted(map(tuple, existing_slices(spark, ledger).collect()))
    bodies = [body(*k, i=f"r{j}") for j, k in enumerate(keys)]
    bodies += [body(*WANTED[0], i="again"), body(*WANTED[0], p="none", i="lost"), body("nobody", "0", i="empty"), "broken"]
    return parse_requests(spark.createDataFrame([(b,) for b in bodies], "body string")), keys


def test_a_damaged_slice_fails_alone(spark, scratch, ledger, damaged, monkeypatch):
    from netzero.plans import jobs

    parsed, keys = all_requests(spark, ledger)
    writes, sink = [], jobs.write_result
    monkeypatch.setattr(jobs, "write_result", lambda *a, **k: writes.append(1) or sink(*a, **k))
    out = scratch("isolated")
    metrics, failed = process_requests(spark, parsed, out, root=damaged, schema=LEDGER_SCHEMA)
    assert sorted(failed) == sorted([("ledger", *WANTED[0]), ("none", *WANTED[0])])
    assert len(writes) <= 11  # one block, halved down to the slice at fault: 2 log2(26) + 1
    letters = sorted((r.partition_id or "", r.reject_reason) for r in letters_of(parsed, failed).collect())
    bad = f"r{keys.index(WANTED[0])}"
    assert letters == sorted([("", "invalid_json"), ("again", "source_error"), (bad, "source_error"), ("lost", "source_error")])
    good = read_ledger(spark, ledger).where("not (empresa = ' building ' and conta_contabil = '1-URGENT')").count()
    assert metrics["rows"] == good == slice_counts(spark, out, origin_columns()).agg({"rows": "sum"}).first()[0]
    counts = {r.partition_id: r.rows for r in request_counts(spark, parsed, out).collect()}
    assert counts[bad] == counts["again"] == counts["lost"] == counts["empty"] == 0 and sum(counts.values()) == good


def test_block_sizes_do_not_change_the_result(spark, scratch, ledger):
    from netzero.operators import valid_requests
    from netzero.plans.worker import write_requested

    parsed, keys = all_requests(spark, ledger)
    slices = requested_slices(valid_requests(parsed))
    blocks = list(slice_blocks(slices, per_job=4))
    assert max(map(len, blocks)) == 4 and sorted(sum(blocks, [])) == sorted(map(tuple, slices.collect()))
    assert [len({s[0] for s in b}) for b in slice_blocks(slices, paths=1)] == [1, 1]
    seen = []
    for per_job in (1000, 9):
        out, root = [], os.path.dirname(ledger)
        write_requested(spark, valid_requests(parsed), lambda df: out.extend(map(str, df.collect())) or {}, root, LEDGER_SCHEMA,
                        slices_per_job=per_job)
        seen.append(sorted(out))
    assert seen[0] == seen[1] and len(seen[0]) == read_ledger(spark, ledger).count()


def test_counts_read_no_column(spark, scratch, ledger):
    plan = plan_of(slice_counts(spark, ledger, ["empresa", "conta_contabil"]))
    assert "ReadSchema: struct<>" in plan
    counts = {(r.empresa, r.conta_contabil): r.rows for r in slice_counts(spark, ledger, ["empresa", "conta_contabil"]).collect()}
    want = read_ledger(spark, ledger).groupBy("empresa", "conta_contabil").count().collect()
    assert counts == {(r.empresa, r.conta_contabil): r["count"] for r in want}
