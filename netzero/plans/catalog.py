"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query starts from the test tables in ``sf_dir`` (the ledger and the
request messages are derived from them by Spark), so its work grows with the
tables.  Queries that exercise sinks or streams write to fresh folders under
the cluster's shared checkpoint dir and return a DataFrame reading them back.
"""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import all_present
from ..operators import (apply_contract, contract_schema, file_plan, normalize, order_entries, parse_requests, project,
                         reconcile, rejected_amounts, txn_summary, type_and_clean)
from ..sources import (LEDGER_SCHEMA, blank_account_ledger_from_tables, ledger_from_tables, read_ledger, read_slices,
                       requests_from_tables, scratch_path, spelled_ledger_from_tables, table, text_ledger_from_tables, written)
from ..sources.slices import existing_slices, slice_directory
from ..spec import ReconSpec, dataset_mappings, output_contracts
from ..streaming import publish_requests, start_request_stream
from .colocated import ColocatedLedger, reconcile_colocated, write_colocated
from .jobs import letters_of, process_requests, request_counts
from .sink import PART_SUFFIX, write_result
from .versions import read_current, write_version
from .worker import SOURCE, dead_letters, reconcile_default_source, reconcile_requested

SPEC = ReconSpec()
PARTS = SPEC.partition_keys
# Slices of one account: what a request for the urgent-orders account reads.
URGENT_ACCOUNT = "1-URGENT"
# Small file target so that the file plan differs from one file per slice at test scale.
SMALL_FILE_ROWS = 500

# Files of a derived inbox.  The stream takes some files at a time and reconciles the slices
# that they name: with files by the row count, ever more batches would each do every slice.
INBOX_FILES = 8

# Buckets of the co-located ledger, few enough for the test tables.
COLOCATED_BUCKETS = 16

# Written results read back: the contract's schema, partition keys as strings.
RESULT_SCHEMA = contract_schema()
TEXT_LEDGER_SCHEMA = T.StructType(
    [T.StructField(f.name, T.StringType()) if f.name == "valor_net" else f for f in LEDGER_SCHEMA.fields])


def read_result(spark: SparkSession, path: str, *extra: str) -> DataFrame:
    """A written result: the contract's columns (and ``extra`` directory columns as text)."""
    schema = T.StructType([*RESULT_SCHEMA.fields, *[T.StructField(c, T.StringType()) for c in extra]])
    return spark.read.schema(schema).parquet(path).select(*schema.names)


DEAD_LETTER_SCHEMA = T.StructType([
    T.StructField("partition_id", T.StringType()),
    T.StructField("reject_reason", T.StringType()),
    T.StructField("body", T.StringType()),
    T.StructField("batch_id", T.LongType()),
])


# Input datasets already written in this session, by application, kind and the
# table files they were made from.
_SOURCES: dict[tuple, str] = {}


def _table_files(spark: SparkSession, sf_dir: str) -> tuple:
    """Path, size and time of the files of the tables behind the ledger: from the
    file system where it is the local one, else by a listing in Spark."""
    paths = [f"{sf_dir}/{t}.parquet" for t in ("lineitem", "orders", "customer")]
    if "://" not in sf_dir and all(os.path.isfile(p) for p in paths):
        return tuple((p, os.path.getsize(p), os.path.getmtime(p)) for p in map(os.path.abspath, paths))
    files = spark.read.format("binaryFile").load(paths)
    return tuple(sorted(map(tuple, files.select("path", "length", F.col("modificationTime").cast("string")).collect())))


def _written_once(spark: SparkSession, sf_dir: str, kind: str, write) -> str:
    """Path of an input dataset derived from the tables, written on first use
    in this session (``write(path)``) under the shared checkpoint dir."""
    key = (spark.sparkContext.applicationId, kind, _table_files(spark, sf_dir))
    if key not in _SOURCES:
        path = scratch_path(spark, kind)
        write(path)
        _SOURCES[key] = path
    return _SOURCES[key]


def _write_partitioned(df: DataFrame, path: str) -> None:
    df.hint("rebalance", *PARTS).write.partitionBy(*PARTS).parquet(path)


def written_ledger(spark: SparkSession, sf_dir: str) -> str:
    """Root folder holding the raw ledger derived from the tables as a
    Hive-partitioned dataset named ``ledger`` — the layout the worker reads.

    Written once per session and tables dir: the ledger is the input dataset
    of every request, and deriving it (two large joins) inside each query
    would run those joins again for both sides of the reconcile plan.
    """
    return _written_once(spark, sf_dir, "source", lambda root: _write_partitioned(
        ledger_from_tables(spark, sf_dir), f"{root}/ledger"))


def written_text_ledger(spark: SparkSession, sf_dir: str) -> str:
    """Like ``written_ledger``, for the upstream text export (amounts as text)."""
    return _written_once(spark, sf_dir, "source-text", lambda root: _write_partitioned(
        text_ledger_from_tables(spark, sf_dir), f"{root}/ledger"))


def raw_text_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_ledger(spark, "ledger", TEXT_LEDGER_SCHEMA, root=written_text_ledger(spark, sf_dir))


def raw_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_ledger(spark, "ledger", LEDGER_SCHEMA, root=written_ledger(spark, sf_dir))


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed, cleaned ledger entries (mapping ``lancamentos_cj``)."""
    return normalize(raw_ledger(spark, sf_dir))


# --- operators over the whole ledger -----------------------------------------

def q_ledger_source(spark, sf_dir):
    return ledger_from_tables(spark, sf_dir)


def q_normalize(spark, sf_dir):
    return entries(spark, sf_dir)


def q_map_unknown_dataset(spark, sf_dir):
    # Unknown dataset name: projection keeps every column, cleaning still applies.
    return type_and_clean(project(raw_ledger(spark, sf_dir), "lancamentos"))


def q_txn_summary(spark, sf_dir):
    s = txn_summary(entries(spark, sf_dir))
    return s.withColumn(SPEC.balance, F.col(SPEC.balance).cast("decimal(38,2)"))


def q_reconcile(spark, sf_dir):
    return reconcile(entries(spark, sf_dir))


def q_reconcile_join(spark, sf_dir):
    # the at-scale plan shape: both sides shuffled, no broadcast, no sort of entries
    return reconcile(entries(spark, sf_dir), join_hint="shuffle_hash")


def q_reconcile_salted(spark, sf_dir):
    return reconcile(entries(spark, sf_dir), strategy="salted")


def q_reconcile_null_keys(spark, sf_dir):
    return reconcile(entries(spark, sf_dir)).where(~all_present(SPEC.keys))


def q_output_contract(spark, sf_dir):
    return apply_contract(reconcile(entries(spark, sf_dir)))


def q_ordered_entries(spark, sf_dir):
    return order_entries(entries(spark, sf_dir))


def q_rejected_amounts(spark, sf_dir):
    return rejected_amounts(raw_text_ledger(spark, sf_dir))


def q_reconcile_text_amounts(spark, sf_dir):
    return reconcile(normalize(raw_text_ledger(spark, sf_dir)))


def q_file_plan(spark, sf_dir):
    return file_plan(reconcile(entries(spark, sf_dir)), PARTS, SMALL_FILE_ROWS)


# --- sources and requests ----------------------------------------------------

def q_slice_scan(spark, sf_dir):
    root = written_ledger(spark, sf_dir)
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    cust = spark.read.parquet(f"{sf_dir}/customer.parquet")
    wanted = (
        orders.where(F.col("o_orderpriority") == URGENT_ACCOUNT)
        .join(cust, orders.o_custkey == cust.c_custkey)
        .select(F.concat(F.lit(" "), F.lower("c_mktsegment"), F.lit(" ")).alias("empresa"),
                F.col("o_orderpriority").alias("conta_contabil"))
    )
    return read_slices(spark, "ledger", wanted, LEDGER_SCHEMA, root=root)


def q_request_rejects(spark, sf_dir):
    return dead_letters(requests_from_tables(spark, sf_dir))


def q_reconcile_requested(spark, sf_dir):
    root = written_ledger(spark, sf_dir)
    return reconcile_requested(spark, requests_from_tables(spark, sf_dir), root=root,
                               schema=LEDGER_SCHEMA)


def q_reconcile_default_source(spark, sf_dir):
    root = written_ledger(spark, sf_dir)
    out = scratch_path(spark, "results")
    result = reconcile_default_source(spark, requests_from_tables(spark, sf_dir), "ledger",
                                      root=root, schema=LEDGER_SCHEMA)
    write_result(result, f"{out}/results_by_partition")
    return read_result(spark, f"{out}/results_by_partition")


def q_requested_spellings(spark, sf_dir):
    """Both raw spellings of every company are requested; each slice is netted on its own."""
    root = _written_once(spark, sf_dir, "source-spelled", lambda r: _write_partitioned(
        spelled_ledger_from_tables(spark, sf_dir), f"{r}/ledger"))
    both = requests_from_tables(spark, sf_dir).unionByName(requests_from_tables(spark, sf_dir, spelled=True))
    out = reconcile_requested(spark, both, root=root, schema=LEDGER_SCHEMA, keep_origin=True)
    return out.drop(SOURCE)


def parsed_requests(requests: DataFrame) -> DataFrame:
    """Parsed requests, written: those who use them several times parse them once."""
    return written(parse_requests(requests), "parsed")


def q_request_source_errors(spark, sf_dir):
    """Requests for a dataset that does not exist become dead letters; the others are written."""
    parsed = parsed_requests(requests_from_tables(spark, sf_dir).unionByName(
        requests_from_tables(spark, sf_dir, "no/such/dataset")))
    _, failed = process_requests(spark, parsed, scratch_path(spark, "errors"),
                                 root=written_ledger(spark, sf_dir), schema=LEDGER_SCHEMA)
    return letters_of(parsed, failed).select("partition_id", "reject_reason")


#: The slice whose files are damaged in ``damaged_ledger``.
DAMAGED = (" building ", URGENT_ACCOUNT)


def damaged_ledger(spark: SparkSession, sf_dir: str) -> str:
    """Like ``written_ledger``, with a file that is not Parquet in one slice."""
    def write(root: str) -> None:
        _write_partitioned(ledger_from_tables(spark, sf_dir), f"{root}/ledger")
        spark.createDataFrame([("not parquet",)], "value string").write.mode("append").text(
            slice_directory(f"{root}/ledger", DAMAGED))
    return _written_once(spark, sf_dir, "source-damaged", write)


def run_damaged(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list, str]:
    """Requests over the damaged ledger: (parsed requests, failed slices, result path)."""
    out = scratch_path(spark, "damaged")
    parsed = parsed_requests(requests_from_tables(spark, sf_dir))
    _, failed = process_requests(spark, parsed, out, root=damaged_ledger(spark, sf_dir), schema=LEDGER_SCHEMA)
    return parsed, failed, out


def q_request_slice_errors(spark, sf_dir):
    """One slice of the dataset is damaged: its requests become dead letters, no others do."""
    parsed, failed, _ = run_damaged(spark, sf_dir)
    return letters_of(parsed, failed).select("partition_id", "reject_reason")


def q_request_slice_results(spark, sf_dir):
    """The slices written beside a damaged one."""
    return read_result(spark, run_damaged(spark, sf_dir)[2])


def q_request_counts(spark, sf_dir):
    """Result rows of the slice of every valid request, from the footers of the files written."""
    out = scratch_path(spark, "counts")
    parsed = parsed_requests(requests_from_tables(spark, sf_dir))
    process_requests(spark, parsed, out, root=written_ledger(spark, sf_dir), schema=LEDGER_SCHEMA)
    return request_counts(spark, parsed, out)


def q_slice_listing(spark, sf_dir):
    """Raw key values of all slices, from the names of their directories."""
    return existing_slices(spark, "ledger", root=written_ledger(spark, sf_dir))


def q_slice_scan_many(spark, sf_dir):
    """Slices of all accounts but one, in a request set with one absent account per customer."""
    cust = table(spark, sf_dir, "customer")
    orders = table(spark, sf_dir, "orders").where("o_orderpriority <> '5-LOW'")
    company = F.concat(F.lit(" "), F.lower("c_mktsegment"), F.lit(" ")).alias("empresa")
    wanted = orders.join(cust, orders.o_custkey == cust.c_custkey).select(
        company, F.col("o_orderpriority").alias("conta_contabil")).distinct().unionByName(
        cust.select(company, F.col("c_custkey").cast("string").alias("conta_contabil")))
    return read_slices(spark, "ledger", wanted, LEDGER_SCHEMA, root=written_ledger(spark, sf_dir))


# --- sinks -------------------------------------------------------------------

def q_sink_roundtrip(spark, sf_dir):
    """Two writes into one folder (urgent account, then the others, then the
    urgent account again, as a replay): dynamic overwrite keeps all slices
    exactly once.  Keys also stay inside the files (``*_part`` directories)."""
    out = scratch_path(spark, "sink")
    result = reconcile(entries(spark, sf_dir))
    urgent = F.col("conta_contabil") == F.lit(URGENT_ACCOUNT)
    for batch in (result.where(urgent), result.where(~urgent), result.where(urgent)):
        write_result(batch, out, copy_partition_columns=True, compression="zstd")
    schema = T.StructType(
        [f for f in RESULT_SCHEMA.fields]
        + [T.StructField(c + "_part", T.StringType()) for c in PARTS])
    return spark.read.schema(schema).parquet(out)


def q_run_metrics(spark, sf_dir):
    out = scratch_path(spark, "metrics")
    m = write_result(reconcile(entries(spark, sf_dir)), out)
    return spark.createDataFrame(
        [(m["rows"], m["reconciled_rows"], m["pending_rows"])],
        "rows bigint, reconciled_rows bigint, pending_rows bigint")


def q_sink_blank_keys(spark, sf_dir):
    out = scratch_path(spark, "blank")
    write_result(reconcile(normalize(blank_account_ledger_from_tables(spark, sf_dir))), out)
    return read_result(spark, out)


def q_sink_empty_slice(spark, sf_dir):
    """An unpartitioned result survives a later write of nothing."""
    out = scratch_path(spark, "empty")
    result = reconcile(entries(spark, sf_dir))
    write_result(result, out, partition_by=())
    write_result(result.where(F.col("empresa") == "NO SUCH COMPANY"), out, partition_by=())
    return read_result(spark, out)


def q_sink_fixed_partitions(spark, sf_dir):
    """An exact number of writing tasks, then fewer tasks without a shuffle for one account."""
    out = scratch_path(spark, "fixed")
    result = reconcile(entries(spark, sf_dir))
    write_result(result, out, num_partitions=3)
    write_result(result.where(F.col("conta_contabil") == F.lit(URGENT_ACCOUNT)), out, coalesce=2)
    return read_result(spark, out)


def q_sink_versions(spark, sf_dir):
    """Slices replaced by versions: all of them, then the reconciled entries of one
    account, then a write that ends before its commit and so changes nothing."""
    out = scratch_path(spark, "versions")
    parts = [c + PART_SUFFIX for c in PARTS]
    urgent = F.col("conta_contabil") == F.lit(URGENT_ACCOUNT)
    write_version(reconcile(entries(spark, sf_dir)), out)
    # no write changes the first version: the later ones take their rows from it, netted once
    result = read_current(spark, out, RESULT_SCHEMA, parts).select(*RESULT_SCHEMA.names)
    write_version(result.where(urgent & (F.col(SPEC.status) == F.lit(SPEC.reconciled_label))), out)
    write_result(result.where(~urgent & (F.col(SPEC.status) == F.lit(SPEC.pending_label))), f"{out}/data/version=lost")
    return read_current(spark, out, RESULT_SCHEMA, parts).select(*RESULT_SCHEMA.names)


def q_sink_ordered(spark, sf_dir):
    """Files in order among each other, without directories."""
    out = scratch_path(spark, "ordered")
    write_result(reconcile(entries(spark, sf_dir)), out, partition_by=(), rows_per_file=SMALL_FILE_ROWS, ordered_files=True)
    return read_result(spark, out)


def q_sink_measured(spark, sf_dir):
    """A second write whose files are sized by the bytes of the first one's rows."""
    out = scratch_path(spark, "measured")
    result = reconcile(entries(spark, sf_dir))
    write_result(result.where(F.col("conta_contabil") == F.lit(URGENT_ACCOUNT)), out)
    write_result(result, out, target_bytes=64 * 1024)
    return read_result(spark, out)


def colocated_ledger(spark: SparkSession, sf_dir: str) -> ColocatedLedger:
    """The cleaned ledger bucketed on its keys, written once in this session."""
    root = _written_once(spark, sf_dir, "colocated", lambda path: write_colocated(
        entries(spark, sf_dir), path.rsplit("/", 1)[-1].replace("-", "_"), COLOCATED_BUCKETS, path))
    name = root.rsplit("/", 1)[-1].replace("-", "_")
    return ColocatedLedger(name, f"{name}_spread")


def q_reconcile_colocated(spark, sf_dir):
    """The same rule over a ledger bucketed on the keys: entries are not moved."""
    return reconcile_colocated(spark, colocated_ledger(spark, sf_dir))


# A contract as it would come from a JSON file.
AUDIT_CONTRACT = {"audit": {
    "columns": ["transactionID", "reconciliation_status", "valor_net", "empresa"],
    "types": {"valor_net": "decimal(20,4)", "empresa": "string"},
    "order_by": ["transactionID"],
}}


def q_custom_contract(spark, sf_dir):
    return apply_contract(reconcile(entries(spark, sf_dir)), "audit", output_contracts(AUDIT_CONTRACT), sort=False)


def written_config(spark: SparkSession, name: str, config: dict) -> str:
    """A JSON config in the shared folder, as a deployment would keep it beside its data."""
    path = scratch_path(spark, name)
    spark.createDataFrame([(json.dumps(config, indent=1),)], "value string").coalesce(1).write.text(path)
    return path


def q_config_files(spark, sf_dir):
    """Mapping and output contract read from JSON files: a dataset of payments with
    its own columns, one of them not in the data, written under another contract."""
    mappings = dataset_mappings(written_config(spark, "mappings", {
        "pagamentos": {"columns": ["transactionID", "valor_net", "data_pagamento", "data_contabil", "EMPRESA"], "order_by": ["data_contabil"]}}))
    contracts = output_contracts(written_config(spark, "contracts", {"payments": {
        "columns": ["empresa", "transactionID", "valor_net", "data_contabil"],
        "types": {"empresa": "string", "valor_net": "decimal", "data_contabil": "string"}, "order_by": ["empresa", "data_contabil"]}}))
    paid = normalize(raw_ledger(spark, sf_dir), "pagamentos", mappings=mappings).where("valor_net < 0")
    out = scratch_path(spark, "payments")
    write_result(paid, out, "payments", contracts=contracts, partition_by=["empresa"])
    schema = "empresa string, transactionID string, valor_net decimal(18,2), data_contabil string"
    return spark.read.schema(schema).parquet(out).select("empresa", "transactionID", "valor_net", "data_contabil")


# --- streaming ---------------------------------------------------------------

def written_inbox(spark: SparkSession, sf_dir: str) -> str:
    """Folder of request messages (text, one JSON body per line) derived from
    the tables — the stream's input, written once per session and tables dir."""
    return _written_once(spark, sf_dir, "inbox", lambda path: (
        requests_from_tables(spark, sf_dir).select("body").repartition(INBOX_FILES).write.text(path)))


def run_request_stream(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Feed the request messages through the streaming consumer until the
    input is drained (fresh checkpoint: every message is consumed once);
    returns (result path, dead-letter path)."""
    root = written_ledger(spark, sf_dir)
    inbox = written_inbox(spark, sf_dir)
    base = scratch_path(spark, "stream")
    q = start_request_stream(
        spark, inbox, f"{base}/results", f"{base}/dead_letters", f"{base}/_checkpoint",
        max_files_per_trigger=4, available_now=True, root=root, schema=LEDGER_SCHEMA)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return f"{base}/results", f"{base}/dead_letters"


def q_stream_requests(spark, sf_dir):
    results, _ = run_request_stream(spark, sf_dir)
    return read_result(spark, results)


def q_stream_two_sources(spark, sf_dir):
    """Two datasets holding some of the same slices, requested in different batches."""
    def sources(root: str) -> None:
        ledger = ledger_from_tables(spark, sf_dir)
        _write_partitioned(ledger, f"{root}/ledger")
        _write_partitioned(ledger.where(F.col("conta_contabil") == F.lit(URGENT_ACCOUNT)), f"{root}/copy")

    def inbox(path: str) -> None:
        for name in ("ledger", "copy"):
            requests_from_tables(spark, sf_dir, name).select("body").repartition(2).write.mode("append").text(path)

    root = _written_once(spark, sf_dir, "two-sources", sources)
    base = scratch_path(spark, "stream2")
    q = start_request_stream(
        spark, _written_once(spark, sf_dir, "two-inbox", inbox), f"{base}/results", f"{base}/dead_letters",
        f"{base}/_checkpoint", max_files_per_trigger=1, available_now=True, root=root, schema=LEDGER_SCHEMA)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return read_result(spark, f"{base}/results", SOURCE)


# Messages in flight in ``stream_messages``.
IN_FLIGHT = 9


def q_stream_messages(spark, sf_dir):
    """One message a file, a bounded number of them in flight: a request for every
    slice, derived from the directories of the ledger, and one for a slice that is not there."""
    base = scratch_path(spark, "messages")
    root = written_ledger(spark, sf_dir)
    slices = existing_slices(spark, "ledger", root=root)
    slices = slices.unionByName(slices.limit(1).withColumn("conta_contabil", F.lit("absent")))
    data = F.struct("empresa", "conta_contabil", F.lit("ledger").alias("data_source_path"))
    publish_requests(slices.select(F.to_json(F.struct(data.alias("data"))).alias("body")), f"{base}/inbox")
    q = start_request_stream(spark, f"{base}/inbox", f"{base}/results", f"{base}/dead_letters", f"{base}/_checkpoint",
                             max_files_per_trigger=IN_FLIGHT, available_now=True, root=root, schema=LEDGER_SCHEMA)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return read_result(spark, f"{base}/results")


def q_stream_dead_letters(spark, sf_dir):
    _, letters = run_request_stream(spark, sf_dir)
    return spark.read.schema(DEAD_LETTER_SCHEMA).parquet(letters).select("partition_id", "reject_reason")


QUERIES = {
    "ledger_source": q_ledger_source,
    "normalize": q_normalize,
    "map_unknown_dataset": q_map_unknown_dataset,
    "txn_summary": q_txn_summary,
    "reconcile": q_reconcile,
    "reconcile_join": q_reconcile_join,
    "reconcile_salted": q_reconcile_salted,
    "reconcile_null_keys": q_reconcile_null_keys,
    "output_contract": q_output_contract,
    "ordered_entries": q_ordered_entries,
    "rejected_amounts": q_rejected_amounts,
    "reconcile_text_amounts": q_reconcile_text_amounts,
    "file_plan": q_file_plan,
    "slice_scan": q_slice_scan,
    "request_rejects": q_request_rejects,
    "reconcile_requested": q_reconcile_requested,
    "reconcile_default_source": q_reconcile_default_source,
    "sink_roundtrip": q_sink_roundtrip,
    "run_metrics": q_run_metrics,
    "stream_requests": q_stream_requests,
    "stream_dead_letters": q_stream_dead_letters,
    "requested_spellings": q_requested_spellings,
    "request_source_errors": q_request_source_errors,
    "slice_scan_many": q_slice_scan_many,
    "slice_listing": q_slice_listing,
    "request_slice_errors": q_request_slice_errors,
    "request_slice_results": q_request_slice_results,
    "request_counts": q_request_counts,
    "sink_versions": q_sink_versions,
    "sink_ordered": q_sink_ordered,
    "sink_measured": q_sink_measured,
    "reconcile_colocated": q_reconcile_colocated,
    "sink_blank_keys": q_sink_blank_keys,
    "sink_empty_slice": q_sink_empty_slice,
    "sink_fixed_partitions": q_sink_fixed_partitions,
    "custom_contract": q_custom_contract,
    "config_files": q_config_files,
    "stream_two_sources": q_stream_two_sources,
    "stream_messages": q_stream_messages,
}
