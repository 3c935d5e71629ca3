"""Results whose slices are replaced by versions: no moment without a slice."""

from __future__ import annotations

import json

import pytest

from netzero.operators import normalize, parse_requests, reconcile
from netzero.plans import versions as v
from netzero.plans.catalog import RESULT_SCHEMA
from netzero.plans.jobs import process_requests
from netzero.plans.worker import origin_columns
from netzero.sources import ledger_from_tables
from netzero.spec import ReconSpec

PARTS = [c + "_part" for c in ReconSpec().partition_keys]
LEDGER = "empresa string, conta_contabil string, transactionID string, valor_net string"


def result(spark, *rows):
    return reconcile(normalize(spark.createDataFrame(rows, LEDGER)))


def current(spark, path, number=None):
    return sorted((r.empresa, r.conta_contabil, r.transactionID) for r in
                  v.read_current(spark, path, RESULT_SCHEMA, PARTS, number).collect())


FIRST = [("A", "1", "T", "5.00"), ("A", "2", "T", "5.00"), ("B", "0011", "T", "5.00")]


def test_a_write_lost_before_its_commit_changes_nothing(spark, scratch, monkeypatch):
    path = scratch("versions")
    v.write_version(result(spark, *FIRST), path)
    before = current(spark, path)
    assert before == [("A", "1", "T"), ("A", "2", "T"), ("B", "0011", "T")]

    def lost(*_):
        raise RuntimeError("driver lost")

    again = result(spark, ("A", "1", "U", "1.00"), ("C", "3", "U", "1.00"))
    for step in ("commit", "file_system"):  # after the data; after the manifest is written, at its rename
        with monkeypatch.context() as m:
            m.setattr(v, "commit", lost) if step == "commit" else m.setattr(v, "manifest_numbers", lost)
            with pytest.raises(RuntimeError):
                v.write_version(again, path)
        assert current(spark, path) == before
    assert v.superseded(spark, path, PARTS).count() == 4  # what the two lost writes left
    v.write_version(again, path)
    assert current(spark, path) == [("A", "1", "U"), ("A", "2", "T"), ("B", "0011", "T"), ("C", "3", "U")]
    assert current(spark, path, number=0) == before
    assert v.superseded(spark, path, PARTS).count() == 5  # and the replaced slice


def test_blank_keys_empty_results_and_no_result(spark, scratch):
    path = scratch("versions")
    assert current(spark, path) == []
    v.write_version(result(spark, ("A", "  ", "T", "0.00"), ("A", "1/2 +", "T", "0.00")), path)
    assert current(spark, path) == [("A", "", "T"), ("A", "1/2 +", "T")]
    v.write_version(result(spark, *FIRST).where("false"), path)
    assert current(spark, path) == [("A", "", "T"), ("A", "1/2 +", "T")] and v.manifest_numbers(spark, path) == [0]
    v.write_version(result(spark, ("A", " ", "U", "0.00")), path)
    assert current(spark, path) == [("A", "", "U"), ("A", "1/2 +", "T")]
    with pytest.raises(ValueError):
        v.write_version(result(spark, *FIRST), path, partition_by=())


def test_a_second_writer_is_refused(spark, scratch, monkeypatch):
    path = scratch("versions")
    v.write_version(result(spark, *FIRST), path)
    before = current(spark, path)
    monkeypatch.setattr(v, "manifest_numbers", lambda *_: [])  # a writer that has not seen the manifest
    with pytest.raises(RuntimeError):
        v.write_version(result(spark, ("A", "1", "U", "1.00")), path)
    monkeypatch.undo()
    assert current(spark, path) == before


def test_requests_written_as_versions(spark, scratch):
    from .conftest import SF_SMALL

    root, path = scratch("src"), scratch("versions")
    ledger_from_tables(spark, SF_SMALL).where("empresa = ' building '").write.partitionBy("empresa", "conta_contabil").parquet(f"{root}/ledger")
    parsed = parse_requests(spark.createDataFrame([(json.dumps({"data": {
        "empresa": " building ", "conta_contabil": c, "data_source_path": "ledger"}}),) for c in ("1-URGENT", "5-LOW")], "body string"))
    seen = []
    for _ in range(2):  # a replay
        process_requests(spark, parsed, path, root=root, versioned=True)
        seen.append(sorted(map(str, v.read_current(spark, path, RESULT_SCHEMA, origin_columns()).collect())))
    assert seen[0] == seen[1] and len(seen[0]) > 0
    assert v.manifest_numbers(spark, path) == [0, 1] and v.superseded(spark, path, origin_columns()).count() == 2
