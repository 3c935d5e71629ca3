"""Writing reconciled entries as partitioned Parquet.

``write_result`` applies the output contract, lays rows out so that files
come out well sized, and replaces only the partitions it writes:

* ``rebalance`` on the partition columns — one shuffle that puts each output
  partition on few tasks; AQE splits a hot partition over several tasks and
  merges small ones, so a slice holding a third of the data does not end up
  in a single writer;
* ``sortWithinPartitions`` on partition columns + contract order, so the
  writer needs no extra sort and each file is ordered by date;
* with a fixed number of writing tasks, a large result is written in rounds of whole
  directories (``directory_rounds``), so what a task sorts is bounded;
* ``maxRecordsPerFile`` caps files at the target row count (128 MB / 40 B);
* optionally, files in order among each other (a range exchange over rows written
  once), and files sized by the bytes that rows take in earlier files;
* dynamic partition overwrite: partitions absent from the result keep their
  earlier files (an empty result writes nothing).

Row counts are collected with ``observe`` during the write — no extra job.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import spread_sort
from ..operators.contract import apply_contract, contract_order
from ..operators.files import rows_for_size
from ..sources.ledger import TABLE_PREFIX
from ..sources.paths import scratch_path, written
from ..sources.slices import file_system
from ..spec import DEFAULT_OUTPUT, ROWS_PER_FILE, OutputContract, ReconSpec

PART_SUFFIX = "_part"
#: Rows that a task of a fixed number of tasks sorts at a time.
ROWS_PER_TASK = ROWS_PER_FILE
METRICS = ("rows", "reconciled_rows", "pending_rows")


def run_metrics(df: DataFrame, spec: ReconSpec = ReconSpec()) -> list:
    """Aggregate expressions for ``observe``: rows, and reconciled / pending
    rows when the frame has a status column."""
    done = F.col(spec.status) == F.lit(spec.reconciled_label)
    cols = []
    if spec.status in df.columns:
        cols = [
            F.sum(F.when(done, 1).otherwise(0)).cast("bigint").alias("reconciled_rows"),
            F.sum(F.when(done, 0).otherwise(1)).cast("bigint").alias("pending_rows"),
        ]
    return [F.count(F.lit(1)).alias("rows"), *cols]


def layout(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[str] = (),
           num_partitions: int | None = None, coalesce: int | None = None, ranges: bool = False,
           range_tasks: int | None = None) -> DataFrame:
    """Distribute and order rows for a partitioned write: exactly
    ``num_partitions`` tasks (a shuffle), at most ``coalesce`` tasks (none here), an
    adaptive rebalance, or, with ``ranges``, a range of the order for each task.
    Writing tasks name their files by their number, so ranges put the files in order too;
    a key with very many rows is cut by the range bounds (see ``spread_sort``);
    ``range_tasks`` sets their number, else it is adaptive."""
    part_cols = list(partition_by)
    order = part_cols + [c for c in order_by if c not in part_cols]
    if ranges and order:
        return spread_sort(df, order, range_tasks)
    if num_partitions:
        out = df.repartition(num_partitions)
    elif coalesce:
        out = df.coalesce(coalesce)
    elif part_cols:
        out = df.hint("rebalance", *part_cols)
    else:
        out = df.hint("rebalance")
    return out.sortWithinPartitions(*order) if order else out


def write_result(
    df: DataFrame,
    path: str,
    schema: str = DEFAULT_OUTPUT,
    partition_by: Sequence[str] | None = None,
    rows_per_file: int = ROWS_PER_FILE,
    num_partitions: int | None = None,
    coalesce: int | None = None,
    copy_partition_columns: bool = True,
    compression: str = "snappy",
    directories: Sequence[str] | None = None,
    contracts: Mapping[str, OutputContract] | None = None,
    ordered_files: bool = False,
    target_bytes: int | None = None,
    spec: ReconSpec = ReconSpec(),
) -> dict:
    """Write ``df`` under ``path``; returns the observed row counts.

    ``path`` may be ``table:<name>``: the table is created partitioned on
    first write, later writes replace only their partitions (``insertInto``
    with dynamic overwrite), so readers get catalog partition pruning.
    The keys stay inside the files (a blank key would come back as null from a
    directory name) and the directories are built from ``<key>_part`` copies;
    ``copy_partition_columns=False`` moves the keys into the directory names.
    ``num_partitions`` forces an exact write parallelism, ``coalesce`` an upper
    bound, instead of the adaptive rebalance; a result of more rows than these tasks
    should sort at once is written in rounds of whole directories.  ``directories``
    names columns of ``df`` (outside the contract) to build the directories from
    instead.  An empty result writes nothing, also without partitions.
    ``ordered_files`` puts the files of a directory in the contract's order among each other:
    read by name, they are sorted.  ``target_bytes`` caps files at that size
    instead of a row count, by the bytes a row takes in the files already under
    ``path`` (``rows_per_file`` where there are none).
    """
    if directories:
        # columns of the contract, then the directory columns under names of their own
        kept = {c: f"_nz_dir{i}" for i, c in enumerate(directories)}
        held = df.withColumns({h: F.col(c) for c, h in kept.items()})
        cols = apply_contract(df, schema, contracts, sort=False)
        names = [c for c in cols.columns if c not in directories]
        typed = {f.name: f.dataType for f in cols.schema.fields}
        out = held.select(*[F.col(c).cast(typed[c]).alias(c) for c in names], *[F.col(h).alias(c) for c, h in kept.items()])
        part_cols = list(directories)
    else:
        out = apply_contract(df, schema, contracts, sort=False)
        part_cols = list(spec.partition_keys if partition_by is None else partition_by)
    if copy_partition_columns and not directories:
        out = out.withColumns({c + PART_SUFFIX: F.col(c) for c in part_cols})
        part_cols = [c + PART_SUFFIX for c in part_cols]
    if not part_cols and out.isEmpty():
        return dict.fromkeys(METRICS, 0)
    if target_bytes is not None and not path.startswith(TABLE_PREFIX):
        rows_per_file = measured_rows_per_file(df.sparkSession, path, target_bytes, rows_per_file)
    if (num_partitions or coalesce) and part_cols and not ordered_files and not path.startswith(TABLE_PREFIX):
        rounds = directory_rounds(out, part_cols, num_partitions or coalesce)
    else:
        rounds = [out]
    tasks = None
    if ordered_files:
        # range bounds are sampled: from written rows, not from a second run of the plan
        rounds = [written(out, "ordered-rows")]
        tasks = range_tasks(df.sparkSession, rounds[0].count(), rows_per_file)
    order = contract_order(out, schema, contracts)
    if copy_partition_columns and not directories:  # a copy sorts as its column does
        order = [c for c in order if c + PART_SUFFIX not in part_cols]
    metrics = [_write(layout(part, part_cols, order, num_partitions, coalesce, ordered_files, tasks), path, part_cols,
                      rows_per_file, compression, spec) for part in rounds]
    return metrics[0] if len(metrics) == 1 else {k: sum(m[k] for m in metrics) for k in metrics[0]}


def range_tasks(spark: SparkSession, rows: int, rows_per_file: int) -> int | None:
    """Writing tasks of an ordered result: all shuffle partitions where each has a file
    or more to fill.  AQE would merge them into about as many as there are cores, by
    bytes, and where files are small the last of these write thousands of files alone.
    None, with fewer rows, leaves the number to AQE."""
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return tasks if rows >= tasks * rows_per_file else None


def directory_rounds(df: DataFrame, part_cols: Sequence[str], tasks: int, per_task: int = ROWS_PER_TASK) -> list[DataFrame]:
    """``df``, computed once by all tasks, in parts of whole directories that a fixed
    number of tasks can sort: about ``per_task`` rows for each, or one directory.
    Every part is written by itself, so a directory is still replaced as a whole."""
    spark = df.sparkSession
    path = scratch_path(spark, "rounds")
    names = [f"_nz_dir{i}" for i in range(len(part_cols))]
    named = df.withColumns({n: F.col(c) for n, c in zip(names, part_cols)})
    named.hint("rebalance", *names).write.partitionBy(*names).parquet(path)
    counts = slice_counts(spark, path, names).collect()  # a row for each directory, as in a listing
    groups: list[list] = []
    rows = 0
    for r in sorted(counts, key=lambda r: [(v is not None, v or "") for v in r[:-1]]):
        if not groups or rows + r["rows"] > tasks * per_task:
            groups.append([])
            rows = 0
        groups[-1].append(r)
        rows += r["rows"]
    if not groups:
        return [df]
    schema = T.StructType([*df.schema.fields, *[T.StructField(n, T.StringType()) for n in names]])
    held = spark.read.schema(schema).parquet(path)
    # a blank value and a null one share a directory here as in the result
    one = lambda r: reduce(and_, [F.col(n).isNull() if r[n] is None else F.col(n) == F.lit(r[n]) for n in names])
    return [held.where(reduce(or_, map(one, g))).drop(*names) if len(groups) > 1 else held.drop(*names) for g in groups]


def _write(out: DataFrame, path: str, part_cols: Sequence[str], rows_per_file: int, compression: str, spec: ReconSpec) -> dict:
    # observed in the writing (result) stage: Spark applies its accumulator
    # updates once per partition even when map stages are re-run after a loss
    obs = Observation(f"netzero_write_{uuid.uuid4().hex[:12]}")  # unique per write
    out = out.observe(obs, *run_metrics(out, spec))
    table = path[len(TABLE_PREFIX):] if path.startswith(TABLE_PREFIX) else None
    spark = out.sparkSession
    if table is not None and spark.catalog.tableExists(table):
        out = out.select(*spark.table(table).columns)  # insertInto is by position
    writer = (
        out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", rows_per_file)
        .option("compression", compression)
    )
    if table is None:
        writer = writer.partitionBy(*part_cols) if part_cols else writer
        writer.parquet(path)
    elif spark.catalog.tableExists(table):
        writer.insertInto(table, overwrite=True)
    else:
        writer = writer.partitionBy(*part_cols) if part_cols else writer
        writer.format("parquet").saveAsTable(table)
    return observed(obs, out)


def measured_rows_per_file(spark: SparkSession, path: str, target_bytes: int, fallback: int = ROWS_PER_FILE) -> int:
    """Rows for a file of ``target_bytes``, from sizes and footers of the files under
    ``path``: their bytes come from the listing, their rows are counted without
    reading a column."""
    fs, to = file_system(spark, path)
    if not fs.exists(to(path)):
        return fallback
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path))
    total = files.agg(F.sum("length")).first()[0]
    if not total:
        return fallback
    rows = (spark.read.schema("_nz_none string").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
            .parquet(path).select(F.count(F.lit(1))).first()[0])
    return rows_for_size(total, rows, target_bytes, fallback)


def slice_counts(spark: SparkSession, path: str, directories: Sequence[str]) -> DataFrame:
    """(directories, rows) of a written result.  No column of the files is read:
    the scan takes the row counts from their footers."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in directories])
    return spark.read.schema(schema).parquet(path).groupBy(*directories).agg(F.count(F.lit(1)).alias("rows"))


def observed(obs: Observation, written: DataFrame) -> dict:
    """Metrics of a finished write.  Where the optimizer finds the input empty it
    drops the observing node with the rest of the plan and there is no value to
    read; zeros are reported only if the written frame is empty indeed."""
    try:
        return dict(obs.get)
    except Exception:
        if written.isEmpty():
            return dict.fromkeys(METRICS, 0)
        raise
