"""Command line: ``python -m netzero <mode> …`` (or ``spark-submit netzero/__main__.py``).

Modes:
  ledger   --source PATH --output PATH            reconcile a whole ledger dataset
  requests --requests DIR --output PATH --dead-letters PATH [--root ROOT]
  stream   --inbox DIR --output PATH --dead-letters PATH --checkpoint PATH [--root ROOT]
           [--once] [--interval "30 seconds"] [--per-trigger N]
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from .plans.jobs import reconcile_dataset, reconcile_request_log
from .session import shuffle_partitions_for, tune
from .sources.store import parquet_settings, s3a_settings
from .spec import DEFAULT_OUTPUT, ROWS_PER_FILE, dataset_mappings, output_contracts
from .streaming import start_request_stream


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="netzero")
    sub = ap.add_subparsers(dest="mode", required=True)
    for name in ("ledger", "requests", "stream"):
        p = sub.add_parser(name)
        p.add_argument("--output", required=True)
        p.add_argument("--rows-per-file", type=int, default=ROWS_PER_FILE)
        p.add_argument("--strategy", choices=["join", "salted"], default="join")
        p.add_argument("--schema", default=None,
                       help="ledger schema as DDL (saves a listing + footer read)")
        p.add_argument("--output-schema", default=DEFAULT_OUTPUT, help="name of the output contract")
        p.add_argument("--mappings", default=None, help="JSON file of dataset mappings")
        p.add_argument("--contracts", default=None, help="JSON file of output contracts")
        p.add_argument("--compression", default="snappy")
        p.add_argument("--num-partitions", type=int, default=None, help="exact number of writing tasks")
        p.add_argument("--coalesce", type=int, default=None, help="most writing tasks, without a shuffle")
        p.add_argument("--salt-column", action="append", default=None, help="entry id columns (repeatable)")
        p.add_argument("--ordered-files", action="store_true", help="files of a directory sorted among each other")
        p.add_argument("--target-mb", type=int, default=None,
                       help="file size by the bytes of earlier files, instead of --rows-per-file")
        p.add_argument("--s3-endpoint", default=None, help="S3-compatible object store")
        p.add_argument("--input-bytes", type=int, default=None,
                       help="ledger size; sizes the initial shuffle partition count")
        if name == "ledger":
            p.add_argument("--source", required=True)
            p.add_argument("--keys-in-directories", action="store_true",
                           help="move the partition keys out of the files")
        else:
            p.add_argument("--dead-letters", required=True)
            p.add_argument("--root", default=None, help="base for relative dataset paths")
            p.add_argument("--versioned", action="store_true", help="replace slices by versions, with one rename")
        if name == "requests":
            p.add_argument("--requests", required=True)
        if name == "stream":
            p.add_argument("--inbox", default=None, help="folder of requests (file formats)")
            p.add_argument("--source-format", default="text", help="text, or kafka with --source-option")
            p.add_argument("--source-option", action="append", default=[], metavar="KEY=VALUE")
            p.add_argument("--checkpoint", required=True)
            p.add_argument("--once", action="store_true", help="drain the inbox and stop")
            p.add_argument("--interval", default=None)
            p.add_argument("--per-trigger", type=int, default=None,
                           help="files (text) or offsets (kafka) per micro-batch")
    args = ap.parse_args(argv)

    parts = shuffle_partitions_for(args.input_bytes) if args.input_bytes else None
    builder = SparkSession.builder.appName(f"netzero-{args.mode}")
    builder = builder.config(map=parquet_settings(args.compression))  # also for dead letters and intermediates
    if args.s3_endpoint:
        builder = builder.config(map=s3a_settings(args.s3_endpoint))
    spark = tune(builder.getOrCreate(),
                 shuffle_partitions=parts, cluster=True)
    common = {
        "rows_per_file": args.rows_per_file, "strategy": args.strategy, "schema": args.schema,
        "mappings": dataset_mappings(args.mappings) if args.mappings else None,
        "output_schema": args.output_schema,
        "contracts": output_contracts(args.contracts) if args.contracts else None,
        "compression": args.compression, "num_partitions": args.num_partitions, "coalesce": args.coalesce,
        "salt_columns": args.salt_column, "ordered_files": args.ordered_files,
        "target_bytes": args.target_mb and args.target_mb * 1024 * 1024,
    }
    if args.mode != "ledger":
        common["versioned"] = args.versioned
    if args.mode == "ledger":
        m = reconcile_dataset(spark, args.source, args.output,
                              copy_partition_columns=not args.keys_in_directories, **common)
    elif args.mode == "requests":
        m = reconcile_request_log(spark, args.requests, args.output, args.dead_letters,
                                  root=args.root, **common)
    else:
        done: set[int] = set()
        q = start_request_stream(spark, args.inbox, args.output, args.dead_letters, args.checkpoint,
                                 max_files_per_trigger=args.per_trigger, available_now=args.once,
                                 processing_time=args.interval, root=args.root,
                                 source_format=args.source_format,
                                 source_options=dict(x.split("=", 1) for x in args.source_option),
                                 on_batch=done.add, **common)
        q.awaitTermination()
        m = {"batches": len(done)}
    print(json.dumps(m))
    return 0


if __name__ == "__main__":
    sys.exit(main())
