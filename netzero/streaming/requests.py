"""Structured Streaming consumer of reconciliation requests.

Source: text files, one JSON request per line, or Kafka (``source_format``).
Each micro-batch:

1. parses the bodies; malformed or incomplete requests go to the dead-letter
   sink with their reason;
2. reads only the requested slices and reconciles each on its own; results are
   written in blocks of datasets with dynamic partition overwrite, under
   directories of dataset path and raw slice, so the result of a slice does not
   depend on the batch it came in;
3. a slice that cannot be read or written dead-letters its own requests
   (reason ``source_error``) and no others; so does a dataset that is not there.

Delivery is at-least-once (the checkpoint commits a batch after
``foreachBatch`` returns).  Replays are harmless: a slice's directory is
overwritten with the same rows, and the dead letters of a batch are one folder
``batch_id=N``, replaced as a whole, also by none.
Back-pressure is ``maxFilesPerTrigger`` (``maxOffsetsPerTrigger`` on Kafka).  With
``publish_requests`` a file holds one message, so files per trigger are messages in
flight: with one, every message is committed, and replayed, on its own.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import parse_requests
from ..plans.jobs import REASON_SOURCE_ERROR, letters_of, process_requests
from ..spec import ReconSpec

__all__ = ["REASON_SOURCE_ERROR", "process_batch", "publish_requests", "request_source", "start_request_stream"]

# Offsets of a Kafka micro-batch unless the caller says otherwise.
KAFKA_OFFSETS_PER_TRIGGER = 1000


def process_batch(batch: DataFrame, batch_id: int, *, output_path: str, dead_letter_path: str,
                  spec: ReconSpec = ReconSpec(), **options) -> None:
    """Handle one micro-batch of request bodies (column ``body``).  ``options``
    are those of ``process_requests``."""
    parsed = parse_requests(batch, spec=spec).persist()
    try:
        _, failed = process_requests(batch.sparkSession, parsed, output_path, spec=spec, **options)
        letters_of(parsed, failed, spec).write.mode("overwrite").parquet(
            f"{dead_letter_path.rstrip('/')}/batch_id={batch_id}")
    finally:
        parsed.unpersist()


def reader_options(source_format: str, source_options: Mapping[str, str] | None = None,
                   max_per_trigger: int | None = None) -> dict[str, str]:
    """Options of the streaming reader, with the back-pressure default of the format."""
    opts = dict(source_options or {})
    if source_format == "kafka":
        opts.setdefault("maxOffsetsPerTrigger", str(max_per_trigger or KAFKA_OFFSETS_PER_TRIGGER))
    else:
        opts.setdefault("maxFilesPerTrigger", str(max_per_trigger or 1))
    return opts


def request_source(spark: SparkSession, source: str | None = None, *, source_format: str = "text",
                   source_options: Mapping[str, str] | None = None,
                   max_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of request bodies (column ``body``).

    ``text``: files under ``source``, one JSON request per line,
    ``max_per_trigger`` files per micro-batch (default 1).  ``kafka``: the
    message value (needs the Kafka connector on the classpath),
    ``max_per_trigger`` offsets per micro-batch (default
    ``KAFKA_OFFSETS_PER_TRIGGER``); ``source_options`` carries the broker and
    topic options.
    """
    opts = reader_options(source_format, source_options, max_per_trigger)
    if source_format == "kafka":
        raw = spark.readStream.format("kafka").options(**opts).load()
        return raw.select(F.col("value").cast("string").alias("body"))
    return (spark.readStream.format(source_format).options(**opts).load(source)
            .withColumnRenamed("value", "body"))


def publish_requests(requests: DataFrame, inbox: str, per_file: int = 1) -> None:
    """Add request bodies (column ``body``) to an inbox, ``per_file`` messages to a
    file.  Files appear whole; the stream commits and replays by file."""
    # line ends stand between the tokens of a JSON text, never inside its strings
    lines = requests.where(F.col("body").isNotNull()).select(F.translate("body", "\r\n", "  ").alias("value"))
    lines.write.mode("append").option("maxRecordsPerFile", per_file).text(inbox)


def start_request_stream(spark: SparkSession, source_dir: str | None, output_path: str,
                         dead_letter_path: str, checkpoint: str, *,
                         max_files_per_trigger: int | None = None, available_now: bool = False,
                         processing_time: str | None = None, source_format: str = "text",
                         source_options: Mapping[str, str] | None = None,
                         on_batch: Callable[[int], None] | None = None,
                         **batch_options) -> StreamingQuery:
    """Start the consumer; returns the running ``StreamingQuery``.

    ``checkpoint`` must be on storage shared by the cluster (it replaces the
    queue acknowledgement: a batch is committed only after it was written).
    ``on_batch`` is called with the id of every batch after it was written.
    """
    requests = request_source(spark, source_dir, source_format=source_format,
                              source_options=source_options, max_per_trigger=max_files_per_trigger)

    def handle(batch: DataFrame, batch_id: int) -> None:
        process_batch(batch, batch_id, output_path=output_path,
                      dead_letter_path=dead_letter_path, **batch_options)
        if on_batch is not None:
            on_batch(batch_id)

    writer = requests.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
