"""A fixed number of writing tasks sorts a bounded number of rows at a time."""

from __future__ import annotations

from netzero.plans import sink
from netzero.plans.catalog import RESULT_SCHEMA


def test_rounds_of_whole_directories(spark, scratch, monkeypatch):
    rows = [(e, c, f"t{i}", "2024-01-01", None, "PENDENTE", None) for i in range(5)
            for e, c in (("A", "x"), ("A", "y"), ("B=%", "x"), (None, "x"), ("", "x"), ("", None))]
    df = spark.createDataFrame(rows, "empresa string, conta_contabil string, transactionID string, data_contabil string, "
                                     "valor_net decimal(18,2), reconciliation_status string, conciliation_id string")
    written = []
    one = sink._write
    monkeypatch.setattr(sink, "_write", lambda part, *a: written.append(part.rdd.getNumPartitions()) or one(part, *a))
    for options in ({"num_partitions": 3}, {"coalesce": 2}):
        out = scratch("rounds")
        monkeypatch.setattr(sink.directory_rounds, "__defaults__", (4,))
        written.clear()
        for _ in range(2):  # a replay replaces
            assert sink.write_result(df, out, **options) == {"rows": 30, "reconciled_rows": 0, "pending_rows": 30}
        assert len(written) > 2 and max(written) <= 3
        back = spark.read.schema(RESULT_SCHEMA).parquet(out).select("empresa", "conta_contabil", "transactionID").collect()
        assert sorted(map(str, map(tuple, back))) == sorted(str((r[0], r[1], r[2])) for r in rows)
