"""Output file sizing: how many files each written partition needs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..spec import ROWS_PER_FILE, TARGET_FILE_SIZE_MB


def files_needed(rows: int, rows_per_file: int = ROWS_PER_FILE) -> int:
    """``max(1, ceil(rows / rows_per_file))`` — at least one file per write."""
    return max(1, -(-rows // rows_per_file))


def rows_for_size(total_bytes: int, rows: int, target_bytes: int = TARGET_FILE_SIZE_MB * 1024 * 1024,
                  fallback: int = ROWS_PER_FILE) -> int:
    """Rows that fill a file of ``target_bytes``, at the bytes a row takes in
    files written before; ``fallback`` where there are none."""
    return max(1, target_bytes * rows // total_bytes) if rows and total_bytes else fallback


def file_plan(df: DataFrame, partition_by: Sequence[str],
              rows_per_file: int = ROWS_PER_FILE) -> DataFrame:
    """Per output partition: row count and the number of files the sink
    writes for it with ``maxRecordsPerFile = rows_per_file``.

    A distributed aggregate (partial counts per task), so it is as cheap as a
    count and never moves rows to the driver.
    """
    rows = F.count(F.lit(1))
    return df.groupBy(*partition_by).agg(
        rows.alias("n_rows"),
        F.greatest(F.lit(1), F.ceil(rows / F.lit(rows_per_file))).cast("bigint").alias("n_files"),
    )
