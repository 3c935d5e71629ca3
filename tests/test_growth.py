"""Steps whose work must follow the input: plans and layouts, on rows made here."""

from __future__ import annotations

import datetime
import glob
import json
import os
from decimal import Decimal

import pytest

from netzero.operators import parse_requests, valid_requests
from netzero.plans import catalog, sink
from netzero.plans.worker import write_requested
from netzero.sources import ledger_from_tables, text_ledger_from_tables


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Repeated and null keys, an order without lines, one without a customer, all three states."""
    d = str(tmp_path_factory.mktemp("tables"))
    day = datetime.datetime(2024, 1, 2)
    lines = [(1, 10.0, "F", day), (1, 10.0, "F", day), (1, 5.5, "O", None), (2, 3.0, "F", day), (2, 4.0, "O", day),
             (3, 1.0, "F", day), (4, 2.0, "O", day), (None, 9.0, "F", day), (5, None, "F", day), (6, 7.0, "F", day), (8, 1.0, "F", day)]
    orders = [(1, 1, "F", "1-URGENT", day), (2, 1, "P", "2-HIGH", day), (3, 2, "O", "2-HIGH", day), (4, 2, "P", None, day),
              (5, 1, "F", "1-URGENT", day), (6, 1, "F", "1-URGENT", day), (6, 2, "F", "2-HIGH", day), (7, 1, "F", "2-HIGH", day),
              (8, 9, "F", "2-HIGH", day), (None, 1, "F", "2-HIGH", day)]
    customers = [(1, "one", "BUILDING"), (2, "two", None), (2, "zwei", "MACHINERY"), (None, "none", "BUILDING")]
    for name, rows, schema in (
            ("lineitem", lines, "l_orderkey long, l_extendedprice double, l_linestatus string, l_shipdate timestamp"),
            ("orders", orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string, o_orderdate timestamp"),
            ("customer", customers, "c_custkey long, c_name string, c_mktsegment string")):
        spark.createDataFrame(rows, schema).write.parquet(f"{d}/{name}.parquet")
    return d


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))


def test_ledger_reads_every_table_once(spark, tables):
    for led in (ledger_from_tables(spark, tables), text_ledger_from_tables(spark, tables)):
        assert plan(led).count("FileScan") == 3


def test_ledger_rows_of_repeated_and_null_keys(spark, tables):
    """The rule of the SQL, by hand: each order row with its customers, a debit a line, a credit an order."""
    got = sorted(((r.transactionID, r.cliente_nome, r.valor_net) for r in ledger_from_tables(spark, tables).collect()), key=str)
    d = Decimal
    want = [("t1", "one", d("10.00"))] * 2 + [("t1", "one", d("5.50")), ("T1 ", "one", d("-25.50")),
            ("t2", "one", d("3.00")), ("t2", "one", d("4.00")), ("T2 ", "one", d("-3.00")),
            ("t5", "one", None), ("t6", "one", d("7.00")), ("T6 ", "one", d("-7.00"))]
    for name in ("two", "zwei"):
        want += [("t3", name, d("1.00")), ("t4", name, d("2.00")), ("t6", name, d("7.00")), ("T6 ", name, d("-7.00"))]
    assert got == sorted(want, key=str)


def test_requests_are_parsed_once_for_each_use(spark, scratch):
    path = scratch("bodies")
    bodies = [(json.dumps({"partition_id": "p", "data": {"empresa": "a", "conta_contabil": "b", "data_source_path": "c"}}),), ("no",), (None,)]
    spark.createDataFrame(bodies, "value string").write.text(path)
    parsed = parse_requests(spark.read.text(path).withColumnRenamed("value", "body"))
    assert plan(valid_requests(parsed).select("partition_id")).count("from_json") == 1
    assert plan(parsed.where("empresa = 'a'")).count("from_json") == 1
    rows = parse_requests(spark.createDataFrame(bodies, "body string")).collect()
    assert sorted(str(r.reject_reason) for r in rows) == ["None", "invalid_json", "invalid_json"]


def test_damaged_slice_costs_no_second_write(spark, scratch):
    """Damaged files are found by their footers, before the other slices are written."""
    root = scratch("damaged")
    rows = [(f"t{i}", "1.00", e, c) for i in range(3) for e in ("A", "B") for c in ("x", "y", "z")]
    (spark.createDataFrame(rows, "transactionID string, valor_net string, empresa string, conta_contabil string")
     .write.partitionBy("empresa", "conta_contabil").parquet(f"{root}/ledger"))
    spark.createDataFrame([("not parquet",)], "value string").write.mode("append").text(f"{root}/ledger/empresa=A/conta_contabil=y")
    valid = spark.createDataFrame([(e, c, "ledger") for e in "AB" for c in "xyz"], "empresa string, conta_contabil string, data_source_path string")
    writes = []

    def write(df):
        writes.append(1)
        return {"rows": len(df.collect())}

    total, failed = write_requested(spark, valid, write, root, "transactionID string, valor_net string, empresa string, conta_contabil string")
    assert (total, failed, len(writes)) == ({"rows": 15}, [("ledger", "A", "y")], 1)


def test_inbox_has_a_fixed_number_of_files(spark, tables):
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", 40)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.range(300).selectExpr("id as o_orderkey", "id as o_custkey", "'F' as o_orderstatus", "'1-URGENT' as o_orderpriority",
                                    "timestamp'2024-01-01' as o_orderdate").write.mode("overwrite").parquet(f"{tables}/many/orders.parquet")
        spark.range(300).selectExpr("id as c_custkey", "'n' as c_name", "'BUILDING' as c_mktsegment").write.mode("overwrite").parquet(f"{tables}/many/customer.parquet")
        spark.read.parquet(f"{tables}/lineitem.parquet").write.mode("overwrite").parquet(f"{tables}/many/lineitem.parquet")
        inbox = catalog.written_inbox(spark, f"{tables}/many")
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert len(glob.glob(os.path.join(inbox.removeprefix("file:"), "part-*"))) == catalog.INBOX_FILES
    assert spark.read.text(inbox).count() == 300


def test_versions_net_the_ledger_once(spark, tables, monkeypatch):
    """Later versions take their rows from the first one; the rows are those of netting each time."""
    rows = [tuple(r) for r in catalog.q_reconcile(spark, tables).select(*catalog.RESULT_SCHEMA.names).collect()]
    at = {c: catalog.RESULT_SCHEMA.names.index(c) for c in ("empresa", "conta_contabil", "reconciliation_status")}
    done = [r for r in rows if r[at["reconciliation_status"]] == "CONCILIADO"]
    replaced = {r[at["empresa"]] for r in done if r[at["conta_contabil"]] == "1-URGENT"}
    want = [r for r in rows if r in done or not (r[at["conta_contabil"]] == "1-URGENT" and r[at["empresa"]] in replaced)]
    joins = []
    for name in ("write_version", "write_result"):
        def kept(df, *args, _write=getattr(catalog, name), **options):
            joins.append(plan(df).count("Join"))
            return _write(df, *args, **options)
        monkeypatch.setattr(catalog, name, kept)
    got = [tuple(map(str, r)) for r in catalog.q_sink_versions(spark, tables).collect()]
    assert sorted(got) == sorted(tuple(map(str, r)) for r in want)
    assert replaced and len(want) < len(rows)
    assert joins == [1, 0, 0]


def test_copies_of_the_keys_are_sorted_once(spark, scratch, monkeypatch):
    orders = []

    def layout(df, part_cols, order_by, *args, _layout=sink.layout):
        orders.append([*part_cols, *order_by])
        return _layout(df, part_cols, order_by, *args)

    monkeypatch.setattr(sink, "layout", layout)
    rows = [(e, c, f"2024-01-0{d}", "T", "1.00", "PENDENTE", None) for d in (3, 1, 2) for e in ("A", " ", None) for c in ("x", "y")]
    names = catalog.RESULT_SCHEMA.names
    assert names[:3] == ["empresa", "conta_contabil", "data_contabil"]
    df = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))
    for copies in (True, False):
        path = scratch("copies")
        sink.write_result(df, path, copy_partition_columns=copies)
        for f in glob.glob(f"{path.removeprefix('file:')}/*/*/*.parquet"):
            got = [tuple(r) for r in spark.read.parquet(f).select("data_contabil").collect()]
            assert len(got) >= 3 and got == sorted(got)
    assert orders == [["empresa_part", "conta_contabil_part", "data_contabil"],
                      ["empresa", "conta_contabil", "empresa", "conta_contabil", "data_contabil"]]
