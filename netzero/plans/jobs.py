"""End-to-end jobs: read, reconcile, write.  Each returns the write metrics.

``write_options`` go to the sink (``contracts``, ``compression``,
``num_partitions``, ``coalesce``, ``copy_partition_columns``).
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import normalize, parse_requests, reconcile, rejected_requests, valid_requests
from ..sources import read_ledger
from ..spec import DEFAULT_DATASET, DEFAULT_OUTPUT, ROWS_PER_FILE, DatasetMapping, ReconSpec
from .sink import METRICS, slice_counts, write_result
from .versions import write_version
from .worker import Slice, origin_columns, write_requested

# Fixed value: reason for requests whose dataset could not be processed.
REASON_SOURCE_ERROR = "source_error"
DEAD_LETTER_COLUMNS = ("partition_id", "reject_reason", "body")


def reconcile_dataset(spark: SparkSession, source: str, output: str, *, root: str | None = None,
                      schema: T.StructType | str | None = None, dataset: str = DEFAULT_DATASET,
                      output_schema: str = DEFAULT_OUTPUT,
                      partition_by: Sequence[str] | None = None,
                      rows_per_file: int = ROWS_PER_FILE, strategy: str = "join",
                      spec: ReconSpec = ReconSpec(),
                      mappings: Mapping[str, DatasetMapping] | None = None,
                      salt_columns: Sequence[str] | None = None, **write_options) -> dict:
    """Reconcile a whole ledger dataset and write it (dynamic overwrite)."""
    entries = normalize(read_ledger(spark, source, schema, spec, root), dataset, spec, mappings)
    return write_result(reconcile(entries, spec, strategy, salt_columns=salt_columns), output, output_schema,
                        partition_by, rows_per_file, spec=spec, **write_options)


def letters_of(parsed: DataFrame, failed: Sequence[Slice], spec: ReconSpec = ReconSpec()) -> DataFrame:
    """Dead letters: rejected requests, and those whose slice failed."""
    names = ["data_source_path", *spec.partition_keys]
    bad = parsed.sparkSession.createDataFrame(list(failed), T.StructType([T.StructField(n, T.StringType()) for n in names]))
    lost = valid_requests(parsed).join(bad, names, "left_semi").withColumn("reject_reason", F.lit(REASON_SOURCE_ERROR))
    return rejected_requests(parsed).unionByName(lost.select(*parsed.columns)).select(*DEAD_LETTER_COLUMNS)


def process_requests(spark: SparkSession, parsed: DataFrame, output: str, *, root: str | None = None,
                     schema: T.StructType | str | None = None, dataset: str = DEFAULT_DATASET,
                     output_schema: str = DEFAULT_OUTPUT, rows_per_file: int = ROWS_PER_FILE,
                     spec: ReconSpec = ReconSpec(), strategy: str = "join",
                     mappings: Mapping[str, DatasetMapping] | None = None,
                     salt_columns: Sequence[str] | None = None, versioned: bool = False,
                     **write_options) -> tuple[dict, list[Slice]]:
    """Write the slices of parsed requests under their origin directories;
    (metrics, failed slices).  ``versioned`` replaces slices by versions (see ``versions``)."""
    def write(result: DataFrame) -> dict:
        sink = write_version if versioned else write_result
        return sink(result, output, output_schema, rows_per_file=rows_per_file,
                    directories=origin_columns(spec), spec=spec, **write_options)

    total, failed = write_requested(spark, valid_requests(parsed), write, root, schema, dataset, spec, strategy,
                                    mappings, salt_columns=salt_columns)
    return {**dict.fromkeys(METRICS, 0), **total}, failed


def request_counts(spark: SparkSession, parsed: DataFrame, output: str, spec: ReconSpec = ReconSpec()) -> DataFrame:
    """(partition_id, rows): result rows of the slice of every valid request, 0
    for a slice without entries or one that failed.  Counts come from the footers of
    the files written."""
    origin = origin_columns(spec)
    counts = slice_counts(spark, output, origin)
    names = dict(zip(["data_source_path", *spec.partition_keys], origin))
    wanted = valid_requests(parsed).select("partition_id", *[F.col(a).alias(b) for a, b in names.items()])
    return wanted.join(counts, origin, "left").select("partition_id", F.coalesce("rows", F.lit(0).cast("long")).alias("rows"))


def reconcile_request_log(spark: SparkSession, requests: str, output: str, dead_letters: str, *,
                          run_id: str | None = None, spec: ReconSpec = ReconSpec(), **options) -> dict:
    """Batch form of the consumer: a folder of request messages (one JSON per
    line) is processed at once.  Invalid requests, and those whose slice
    cannot be read or processed, are written to ``dead_letters/run_id=…``: a run
    replaces its own letters and keeps those of others."""
    parsed = parse_requests(spark.read.text(requests).withColumnRenamed("value", "body"), spec=spec).persist()
    try:
        metrics, failed = process_requests(spark, parsed, output, spec=spec, **options)
        letters_of(parsed, failed, spec).write.mode("overwrite").parquet(
            f"{dead_letters.rstrip('/')}/run_id={run_id or uuid.uuid4().hex}")
    finally:
        parsed.unpersist()
    return metrics
