"""Config loading (S3), path resolution (S2), store settings (S4), batch jobs
and the command line."""

from __future__ import annotations

import json
import os

import pytest

from netzero.__main__ import main
from netzero.operators import apply_contract, project
from netzero.plans.catalog import RESULT_SCHEMA
from netzero.plans.jobs import reconcile_dataset, reconcile_request_log
from netzero.sources import ledger_from_tables, resolve_path
from netzero.sources.store import s3a_settings
from netzero.spec import DatasetMapping, dataset_mappings, load_json, output_contracts

from .conftest import SF_SMALL


def test_resolve_path():
    assert resolve_path("s3a://b/x") == "s3a://b/x"
    assert resolve_path("/data/x", "s3a://bucket") == "s3a://bucket/data/x"
    assert resolve_path("data/x", "s3a://bucket/") == "s3a://bucket/data/x"
    assert resolve_path("file:/tmp/x", "s3a://bucket") == "file:/tmp/x"
    assert resolve_path("data/x") == "data/x"


def test_mapping_from_json_file(tmp_path, spark):
    cfg = {"lancamentos_cj": {"columns": ["EMPRESA", "valor_net", "missing"], "order_by": ["empresa"]},
           "plain": ["valor_net"]}
    path = tmp_path / "mapping.json"
    path.write_text(json.dumps(cfg))
    maps = dataset_mappings(str(path))
    assert maps["plain"] == DatasetMapping(("valor_net",))
    df = spark.createDataFrame([("E", "1.00", "x")], "empresa string, valor_net string, other string")
    # case-insensitive, missing columns skipped, unknown dataset passes through
    assert project(df, "lancamentos_cj", maps).columns == ["empresa", "valor_net"]
    assert project(df, "plain", maps).columns == ["valor_net"]
    assert project(df, "nope", maps).columns == df.columns
    with pytest.raises(FileNotFoundError):
        load_json(str(tmp_path / "absent.json"))


def test_config_from_a_store(spark, scratch, tmp_path):
    """A config folder written by Spark, a file by URI, and the default mappings."""
    from netzero.plans.catalog import written_config

    cfg = {"a": {"columns": ["x", "é"], "order_by": ["x"]}}
    assert load_json(written_config(spark, "config", cfg)) == cfg
    path = tmp_path / "config.json"
    path.write_text(json.dumps(cfg, indent=2), encoding="utf-8")
    assert load_json(f"file://{path}") == cfg
    with pytest.raises(Exception):
        load_json(f"file://{tmp_path}/absent.json")
    assert set(dataset_mappings()) == {"lancamentos_cj", "clientes", "pagamentos"}
    df = spark.createDataFrame([(1, "n", 3)], "cliente_id int, nome string, z int")
    assert project(df, "clientes").columns == ["cliente_id", "nome"]


def test_contract_with_ddl_type(spark):
    contracts = output_contracts({"x": {"columns": ["a", "b"], "types": {"a": "int", "b": "decimal"}}})
    df = spark.createDataFrame([("7", "1.239")], "a string, b string")
    out = apply_contract(df, "x", contracts)
    assert dict(out.dtypes) == {"a": "int", "b": "decimal(18,2)"}


def test_store_settings():
    conf = s3a_settings("http://store:9000", ssl=False)
    assert conf["spark.hadoop.fs.s3a.endpoint"] == "http://store:9000"
    assert conf["spark.hadoop.fs.s3a.multipart.size"] == str(128 * 1024 * 1024)
    assert conf["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"


@pytest.fixture(scope="module")
def ledger_root(spark):
    from netzero.sources import scratch_path

    root = scratch_path(spark, "jobs")
    ledger_from_tables(spark, SF_SMALL).write.partitionBy("empresa", "conta_contabil").parquet(f"{root}/ledger")
    return root


def test_reconcile_dataset(spark, scratch, ledger_root):
    out = scratch("job-out")
    m = reconcile_dataset(spark, f"{ledger_root}/ledger", out)
    assert m == {"rows": 6898, "reconciled_rows": 2591, "pending_rows": 4307}
    assert spark.read.schema(RESULT_SCHEMA).parquet(out).count() == 6898


def test_request_log_and_cli(spark, scratch, ledger_root):
    inbox = scratch("inbox")
    os.makedirs(inbox)
    with open(os.path.join(inbox, "r.json"), "w") as fh:
        fh.write(json.dumps({"partition_id": "1", "data": {
            "empresa": " building ", "conta_contabil": "1-URGENT", "data_source_path": "ledger"}}) + "\n")
        fh.write("broken\n")
    out, dlq = scratch("log-out"), scratch("log-dlq")
    m = reconcile_request_log(spark, inbox, out, dlq, root=ledger_root)
    assert m["rows"] > 0
    assert [r.reject_reason for r in spark.read.parquet(dlq).collect()] == ["invalid_json"]
    reconcile_request_log(spark, inbox, out, dlq, root=ledger_root)  # letters of the first run stay
    assert spark.read.parquet(dlq).count() == 2
    reconcile_request_log(spark, inbox, out, dlq, root=ledger_root, run_id="r")
    reconcile_request_log(spark, inbox, out, dlq, root=ledger_root, run_id="r")  # a re-run replaces its own
    assert spark.read.parquet(dlq).count() == 3
    assert spark.read.schema(RESULT_SCHEMA).parquet(out).count() == m["rows"]

    from netzero.session import CLUSTER_SQL_CONF

    out2, dlq2, ck = scratch("cli-out"), scratch("cli-dlq"), scratch("cli-ck")
    saved = {k: spark.conf.get(k, None) for k in [*CLUSTER_SQL_CONF, "spark.sql.shuffle.partitions"]}
    try:
        assert main(["stream", "--inbox", inbox, "--output", out2, "--dead-letters", dlq2,
                     "--checkpoint", ck, "--root", ledger_root, "--once", "--input-bytes", "1000",
                     "--schema", "transactionID string, data_contabil date, valor_net decimal(18,2), "
                                 "empresa int, conta_contabil string"]) == 0
    finally:
        for k, v in saved.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert spark.read.schema(RESULT_SCHEMA).parquet(out2).count() == m["rows"]


def test_partition_sizing():
    from netzero.session import shuffle_partitions_for

    assert shuffle_partitions_for(10) == 200
    assert shuffle_partitions_for(2**40) == 8192  # 1 TiB / 128 MiB
    for tib in (10, 100):  # blocks of 16 KiB at least: bounded by split size / block size
        n = shuffle_partitions_for(tib * 2**40)
        assert n == 16384 and n * (tib * 2**40 // 2**28) * 16 * 1024 <= tib * 2**40


def test_configuration_from_files(spark, scratch, ledger_root, capsys, tmp_path):
    """Mappings, contracts, codec and writing tasks reach a job through the command line."""
    from netzero.session import CLUSTER_SQL_CONF

    (tmp_path / "m.json").write_text(json.dumps({"lancamentos_cj": {
        "columns": ["empresa", "conta_contabil", "transactionID", "valor_net"], "order_by": ["empresa"]}}))
    (tmp_path / "c.json").write_text(json.dumps({"audit": {
        "columns": ["transactionID", "valor_net", "empresa", "conta_contabil"], "types": {"valor_net": "decimal(20,4)"}}}))
    out = scratch("cli-config")
    saved = {k: spark.conf.get(k, None) for k in CLUSTER_SQL_CONF}
    try:
        assert main(["ledger", "--source", f"{ledger_root}/ledger", "--output", out, "--mappings", str(tmp_path / "m.json"),
                     "--contracts", str(tmp_path / "c.json"), "--output-schema", "audit", "--compression", "zstd",
                     "--num-partitions", "2", "--salt-column", "transactionID", "--strategy", "salted"]) == 0
    finally:
        for k, v in saved.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    back = spark.read.parquet(out)
    assert back.columns[:4] == ["transactionID", "valor_net", "empresa", "conta_contabil"]
    assert dict(back.dtypes)["valor_net"] == "decimal(20,4)" and back.count() == 6898
    assert all(".zstd." in f for f in back.inputFiles())


def test_reader_options_without_a_broker():
    from netzero.streaming.requests import KAFKA_OFFSETS_PER_TRIGGER, reader_options

    broker = {"kafka.bootstrap.servers": "b:9092", "subscribe": "requests"}
    assert reader_options("kafka", broker) == {**broker, "maxOffsetsPerTrigger": str(KAFKA_OFFSETS_PER_TRIGGER)}
    assert reader_options("kafka", broker, 7)["maxOffsetsPerTrigger"] == "7"
    assert reader_options("kafka", {"maxOffsetsPerTrigger": "3"})["maxOffsetsPerTrigger"] == "3"
    assert reader_options("text") == {"maxFilesPerTrigger": "1"}


def test_one_bad_dataset_among_many(spark, scratch, ledger_root):
    """65 datasets that do not exist and one that does: one result, 65 letters."""
    inbox = scratch("many-inbox")
    os.makedirs(inbox)
    with open(os.path.join(inbox, "r.json"), "w") as fh:
        for path in [f"none/{i}" for i in range(65)] + ["ledger"]:
            fh.write(json.dumps({"data": {"empresa": " building ", "conta_contabil": "1-URGENT",
                                          "data_source_path": path}}) + "\n")
    out, dlq = scratch("many-out"), scratch("many-dlq")
    assert reconcile_request_log(spark, inbox, out, dlq, root=ledger_root)["rows"] > 0
    assert [r.reject_reason for r in spark.read.parquet(dlq).collect()] == ["source_error"] * 65


def test_other_column_case(spark, scratch):
    """Columns in another case than the spec's go through the whole job (K17)."""
    from netzero.operators import normalize, reconcile
    from netzero.plans.sink import write_result

    raw = spark.createDataFrame([("E", "C", "T", "1.00", "d"), ("E", "C", "t ", "-1.00", "d")],
                                "EMPRESA string, Conta_Contabil string, TRANSACTIONID string, VALOR_NET string, data_contabil string")
    out = reconcile(normalize(raw))
    assert out.columns[:3] == ["empresa", "conta_contabil", "transactionID"] and len(out.columns) == len(set(map(str.lower, out.columns)))
    path = scratch("case")
    assert write_result(out, path)["reconciled_rows"] == 2
    assert {r.empresa for r in spark.read.schema(RESULT_SCHEMA).parquet(path).collect()} == {"E"}
    direct = reconcile(raw.withColumn("VALOR_NET", raw.VALOR_NET.cast("decimal(18,2)")))
    assert "EMPRESA" not in direct.columns and "valor_net" in direct.columns


def test_contract_schema(spark):
    from netzero.operators import contract_schema

    s = contract_schema()
    assert dict((f.name, f.dataType.simpleString()) for f in s.fields)["valor_net"] == "decimal(18,2)"
    custom = output_contracts({"x": {"columns": ["a", "b"], "types": {"a": "int"}}})
    assert contract_schema("x", custom).simpleString() == "struct<a:int,b:string>"
    with pytest.raises(KeyError):
        contract_schema("nope")


def test_cli_ledger_mode(spark, scratch, ledger_root, capsys):
    from netzero.session import CLUSTER_SQL_CONF

    out = scratch("cli-ledger")
    saved = {k: spark.conf.get(k, None) for k in CLUSTER_SQL_CONF}
    try:
        assert main(["ledger", "--source", f"{ledger_root}/ledger", "--output", out,
                     "--rows-per-file", "1000"]) == 0
    finally:
        for k, v in saved.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    metrics = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert metrics == {"rows": 6898, "reconciled_rows": 2591, "pending_rows": 4307}
    assert spark.read.schema(RESULT_SCHEMA).parquet(out).count() == 6898
