"""Structured Streaming consumer: valid, incomplete, malformed, replayed and
unreadable-source requests."""

from __future__ import annotations

import json
import os

from netzero.plans.catalog import DEAD_LETTER_SCHEMA, RESULT_SCHEMA
from netzero.sources import ledger_from_tables
from netzero.streaming import start_request_stream

from .conftest import SF_SMALL


def req(e=None, c=None, p=None) -> str:
    data = {k: v for k, v in (("empresa", e), ("conta_contabil", c), ("data_source_path", p)) if v is not None}
    return json.dumps({"partition_id": f"{e}/{c}/{p}", "data": data})


def drop(folder: str, name: str, lines: list[str]) -> None:
    os.makedirs(folder, exist_ok=True)
    tmp = os.path.join(folder, f".{name}.tmp")
    with open(tmp, "w") as fh:
        fh.write("\n".join(lines) + "\n")
    os.rename(tmp, os.path.join(folder, name))  # atomic publish into the inbox


def run(spark, base, root):
    q = start_request_stream(spark, f"{base}/inbox", f"{base}/out", f"{base}/dlq", f"{base}/ckpt",
                             available_now=True, root=root)
    q.awaitTermination()
    assert q.exception() is None


def test_stream_end_to_end(spark, scratch):
    root = scratch("stream-src")
    ledger_from_tables(spark, SF_SMALL).write.partitionBy("empresa", "conta_contabil").parquet(f"{root}/ledger")
    base = scratch("stream")
    good = req(" building ", "1-URGENT", "ledger")
    drop(f"{base}/inbox", "a.json", [good, req(" building ", None, "ledger"), "not json",
                                     req(" furniture ", "2-HIGH", "missing_dataset")])
    run(spark, base, root)
    out = spark.read.schema(RESULT_SCHEMA).parquet(f"{base}/out")
    n1 = out.count()
    assert n1 > 0
    assert {(r.empresa, r.conta_contabil) for r in out.select("empresa", "conta_contabil").distinct().collect()} \
        == {("BUILDING", "1-URGENT")}
    dlq = spark.read.schema(DEAD_LETTER_SCHEMA).parquet(f"{base}/dlq")
    assert sorted(r.reject_reason for r in dlq.collect()) == \
        ["invalid_json", "missing_conta_contabil", "source_error"]

    # the same request again in a new file: result unchanged (idempotent overwrite)
    drop(f"{base}/inbox", "b.json", [good])
    run(spark, base, root)
    assert spark.read.schema(RESULT_SCHEMA).parquet(f"{base}/out").count() == n1
    # restart with nothing new: the checkpoint skips processed files
    run(spark, base, root)
    assert spark.read.schema(DEAD_LETTER_SCHEMA).parquet(f"{base}/dlq").count() == 3


def test_back_pressure_one_file_per_batch(spark, scratch):
    root = scratch("bp-src")
    ledger_from_tables(spark, SF_SMALL).where("conta_contabil = '5-LOW'") \
        .write.partitionBy("empresa", "conta_contabil").parquet(f"{root}/ledger")
    base = scratch("bp")
    for i, seg in enumerate([" building ", " machinery ", " household "]):
        drop(f"{base}/inbox", f"{i}.json", [req(seg, "5-LOW", "ledger")])
    q = start_request_stream(spark, f"{base}/inbox", f"{base}/out", f"{base}/dlq", f"{base}/ckpt",
                             max_files_per_trigger=1, available_now=True, root=root)
    q.awaitTermination()
    batches = [p for p in q.recentProgress if p["numInputRows"] > 0]
    assert len(batches) == 3 and all(p["numInputRows"] == 1 for p in batches)
    slices = {r[0] for r in spark.read.schema(RESULT_SCHEMA).parquet(f"{base}/out").select("empresa").distinct().collect()}
    assert slices == {"BUILDING", "MACHINERY", "HOUSEHOLD"}


def test_replay_after_failure_is_idempotent(spark, scratch):
    """The batch fails after writing (lost driver): the restart replays it from
    the checkpoint, and results and dead letters come out exactly once."""
    from netzero.streaming import process_batch, request_source

    root = scratch("replay-src")
    ledger_from_tables(spark, SF_SMALL).where("conta_contabil = '2-HIGH'") \
        .write.partitionBy("empresa", "conta_contabil").parquet(f"{root}/ledger")
    base = scratch("replay")
    drop(f"{base}/inbox", "a.json", [req(" building ", "2-HIGH", "ledger"), "oops"])
    state = {"fail": True}

    def handle(batch, batch_id):
        process_batch(batch, batch_id, output_path=f"{base}/out",
                      dead_letter_path=f"{base}/dlq", root=root)
        if state["fail"]:
            state["fail"] = False
            raise RuntimeError("lost after the write")

    def run_once():
        q = (request_source(spark, f"{base}/inbox").writeStream.foreachBatch(handle)
             .option("checkpointLocation", f"{base}/ckpt").trigger(availableNow=True).start())
        try:
            q.awaitTermination()
        except Exception:
            pass
        return q

    first = run_once()
    assert first.exception() is not None  # the batch was not committed
    second = run_once()
    assert second.exception() is None
    out = spark.read.schema(RESULT_SCHEMA).parquet(f"{base}/out")
    expected = ledger_from_tables(spark, SF_SMALL).where(
        "empresa = ' building ' and conta_contabil = '2-HIGH'").count()
    assert out.count() == expected
    assert spark.read.schema(DEAD_LETTER_SCHEMA).parquet(f"{base}/dlq").count() == 1


def test_messages_are_committed_one_by_one(spark, scratch):
    """One message in flight: after a failure only the message at hand is replayed."""
    from netzero.streaming import process_batch, publish_requests, request_source

    root, base = scratch("one-src"), scratch("one")
    ledger_from_tables(spark, SF_SMALL).where("conta_contabil = '2-HIGH'") \
        .write.partitionBy("empresa", "conta_contabil").parquet(f"{root}/ledger")
    names = [" building ", " machinery ", " household ", " furniture "]
    bodies = [json.dumps(json.loads(req(e, "2-HIGH", "ledger")), indent=1) for e in names]  # line ends inside
    publish_requests(spark.createDataFrame([(b,) for b in [*bodies, None]], "body string").coalesce(1), f"{base}/inbox")
    seen = []

    def handle(batch, batch_id):
        (row,) = batch.collect()
        seen.append(json.loads(row.body)["data"]["empresa"])
        process_batch(batch, batch_id, output_path=f"{base}/out", dead_letter_path=f"{base}/dlq", root=root)
        if len(seen) == 3:
            raise RuntimeError("lost after the write")

    for _ in range(2):
        q = (request_source(spark, f"{base}/inbox").writeStream.foreachBatch(handle)
             .option("checkpointLocation", f"{base}/ckpt").trigger(availableNow=True).start())
        try:
            q.awaitTermination()
        except Exception:
            pass
    assert q.exception() is None
    assert len(seen) == 5 and seen[2] == seen[3] and sorted(set(seen)) == sorted(names)
    expected = ledger_from_tables(spark, SF_SMALL).where("conta_contabil = '2-HIGH'").where(
        "empresa in (' building ', ' machinery ', ' household ', ' furniture ')").count()
    assert spark.read.schema(RESULT_SCHEMA).parquet(f"{base}/out").count() == expected
    assert spark.read.schema(DEAD_LETTER_SCHEMA).parquet(f"{base}/dlq").count() == 0


def test_shared_partitions_and_corrupt_dataset(spark, scratch):
    """Two datasets with the same (company, account) in one batch: both land in
    the output.  A dataset whose file is corrupt fails only at run time: it is
    dead-lettered, the others are written."""
    from netzero.plans.catalog import LEDGER_SCHEMA

    root = scratch("multi-src")
    part = ledger_from_tables(spark, SF_SMALL).where(
        "empresa = ' building ' and conta_contabil = '3-MEDIUM'")
    n = part.count()
    for name in ("a", "b", "bad"):
        part.write.partitionBy("empresa", "conta_contabil").parquet(f"{root}/{name}")
    bad_dir = f"{root}/bad/empresa= building /conta_contabil=3-MEDIUM"
    with open(os.path.join(bad_dir, "part-99999-corrupt.snappy.parquet"), "w") as fh:
        fh.write("not parquet")
    base = scratch("multi")
    drop(f"{base}/inbox", "a.json", [req(" building ", "3-MEDIUM", p) for p in ("a", "b", "bad")])
    q = start_request_stream(spark, f"{base}/inbox", f"{base}/out", f"{base}/dlq", f"{base}/ckpt",
                             available_now=True, root=root, schema=LEDGER_SCHEMA)
    q.awaitTermination()
    assert q.exception() is None
    assert spark.read.schema(RESULT_SCHEMA).parquet(f"{base}/out").count() == 2 * n
    dlq = spark.read.schema(DEAD_LETTER_SCHEMA).parquet(f"{base}/dlq").collect()
    assert [r.reject_reason for r in dlq] == ["source_error"]


def test_batches_do_not_change_the_result(spark, scratch):
    """One file per batch or all at once: the same rows, for two spellings of a
    company and two datasets with the same slices."""
    root = scratch("cut-src")
    raw = spark.createDataFrame([("acme", "1", "T", "10.00"), (" ACME ", "1", "T", "-10.00"), ("acme", "1", "U", "0.00")],
                                "empresa string, conta_contabil string, transactionID string, valor_net string")
    for name in ("x", "y"):
        raw.write.partitionBy("empresa", "conta_contabil").parquet(f"{root}/{name}")
    inbox, seen = scratch("cut") + "/inbox", []
    for i, (e, p) in enumerate((e, p) for e in ("acme", " ACME ") for p in ("x", "y")):
        drop(inbox, f"{i}.json", [req(e, "1", p)])
    for per in (1, 100):
        base, done = scratch("cut"), []
        q = start_request_stream(spark, inbox, f"{base}/out", f"{base}/dlq", f"{base}/ckpt", max_files_per_trigger=per,
                                 available_now=True, root=root, on_batch=done.append)
        q.awaitTermination()
        assert q.exception() is None and len(done) == (4 if per == 1 else 1)
        seen.append(sorted(map(str, spark.read.schema(RESULT_SCHEMA).parquet(f"{base}/out").collect())))
    assert seen[0] == seen[1] and len(seen[0]) == 6


def test_replay_replaces_letters(spark, scratch):
    """A dataset that appears between two runs of a batch leaves no stale letter."""
    from netzero.streaming import process_batch

    root, base = scratch("late-src"), scratch("late")
    batch = spark.createDataFrame([(req(" building ", "1-URGENT", "late"),)], "body string")
    letters = lambda: [r.reject_reason for r in spark.read.schema(DEAD_LETTER_SCHEMA).parquet(f"{base}/dlq").collect()]
    process_batch(batch, 3, output_path=f"{base}/out", dead_letter_path=f"{base}/dlq", root=root)
    assert letters() == ["source_error"]
    ledger_from_tables(spark, SF_SMALL).write.partitionBy("empresa", "conta_contabil").parquet(f"{root}/late")
    process_batch(batch, 3, output_path=f"{base}/out", dead_letter_path=f"{base}/dlq", root=root)
    assert letters() == [] and spark.read.schema(RESULT_SCHEMA).parquet(f"{base}/out").count() > 0
