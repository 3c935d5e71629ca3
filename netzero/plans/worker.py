"""Request-driven reconciliation: a table of request messages in, the
reconciled entries of every requested ledger slice out.

A request names raw (company, account) partition values and a dataset path: its
slice.  Every slice is reconciled on its own, as one message would be: the
entries carry the slice they were read from (``origin_columns``), net only within
it, and their ids depend on it.  The result of a slice is therefore the same
whichever requests are handled together with it.  All slices of a job, of whatever
datasets, share one aggregate and one join.  Invalid requests are left out here
(see ``dead_letters``); repeated requests for one slice are read once.

Requests are parsed once, into a written table of the distinct slices they name
(``requested_slices``); everything after that reads this table.  Results are
written in blocks of slices.  A slice that cannot be read fails alone, as its
message would: a failing block is halved down to the slices at fault.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator, Mapping, Sequence
from itertools import groupby

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import present
from ..operators import normalize, parse_requests, reconcile, rejected_requests, valid_requests
from ..operators.requests import REASON_MISSING, REQUIRED_FIELDS
from ..sources import read_slices, resolve_path, written
from ..sources.ledger import LEDGER_SCHEMA, TABLE_PREFIX
from ..sources.slices import MissingDataset, existing_of, read_directories, sliced_by
from ..spec import DEFAULT_DATASET, DatasetMapping, ReconSpec

log = logging.getLogger("netzero")

#: Column holding the dataset path as requested; raw slice values are in
#: ``<key>_slice``.  Together they are the directories of a request result.
SOURCE = "request_source"
SLICE_SUFFIX = "_slice"
#: Dataset paths and slices planned in one job.  More take more jobs: this bounds
#: the size of a plan and what the driver holds, never the number of requests.
PATHS_PER_JOB = 32
SLICES_PER_JOB = 1000
#: Schema of a scan that takes nothing but row counts from the footers.
NO_COLUMN = "_nz_none string"
#: A requested slice: dataset path and raw key values.
Slice = tuple[str, str, str]


def origin_columns(spec: ReconSpec = ReconSpec()) -> list[str]:
    return [SOURCE, *[k + SLICE_SUFFIX for k in spec.partition_keys]]


def parsed(requests: DataFrame, spec: ReconSpec) -> DataFrame:
    return requests if "reject_reason" in requests.columns else parse_requests(requests, spec=spec)


def requested_slices(valid: DataFrame, spec: ReconSpec = ReconSpec()) -> DataFrame:
    """Distinct (data_source_path, partition keys) of valid requests, written:
    the requests are not parsed again for each use of it."""
    return written(valid.select("data_source_path", *spec.partition_keys).distinct(), "slices")


def slice_blocks(slices: DataFrame, paths: int = PATHS_PER_JOB, per_job: int = SLICES_PER_JOB) -> Iterator[list[Slice]]:
    """All slices in order, in blocks of at most ``per_job`` slices and ``paths``
    datasets; one block is on the driver."""
    block: list[Slice] = []
    seen: set[str] = set()
    for row in slices.orderBy(*slices.columns).toLocalIterator():
        if len(block) == per_job or (row[0] not in seen and len(seen) == paths):
            yield block
            block, seen = [], set()
        block.append(tuple(row))
        seen.add(row[0])
    if block:
        yield block


def requested_paths(slices: DataFrame) -> list[str]:
    """The datasets named by ``requested_slices``; each becomes a branch of the plan."""
    return sorted(r[0] for r in slices.select("data_source_path").distinct().toLocalIterator())


def slice_entries(spark: SparkSession, path: str, slices: DataFrame | Sequence[tuple[str, str]],
                  root: str | None = None, schema: T.StructType | str | None = None,
                  dataset: str = DEFAULT_DATASET, spec: ReconSpec = ReconSpec(),
                  mappings: Mapping[str, DatasetMapping] | None = None) -> DataFrame:
    """Typed, cleaned entries of the requested slices of one dataset, with the
    slice each was read from."""
    if not isinstance(slices, DataFrame) and not path.startswith(TABLE_PREFIX) and sliced_by(spark, resolve_path(path, root), spec):
        raw = read_directories(spark, path, existing_of(spark, resolve_path(path, root), slices, spec), schema, spec, root)
    else:
        raw = read_slices(spark, path, slices, schema, spec, root)
    keys = dict(zip(spec.partition_keys, present(raw, spec.partition_keys)))
    origin = {SOURCE: F.lit(path), **{k + SLICE_SUFFIX: F.col(a) for k, a in keys.items()}}
    mapped = normalize(raw.limit(0), dataset, spec, mappings).columns
    by_name = {c.lower(): c for c in raw.columns}
    kept = raw.select(*[F.col(by_name[c.lower()]) for c in mapped], *[c.alias(n) for n, c in origin.items()])
    return normalize(kept, "", spec, {"": DatasetMapping(tuple(kept.columns))})


def union_entries(frames: Sequence[DataFrame]) -> DataFrame:
    """Entries of several datasets; a column typed differently among them is text."""
    types: dict[str, set] = {}
    for f in frames:
        for n, t in f.dtypes:
            types.setdefault(n, set()).add(t)
    mixed = [n for n, t in types.items() if len(t) > 1]
    out = None
    for f in frames:
        f = f.withColumns({n: F.col(n).cast("string") for n in mixed if n in f.columns})
        out = f if out is None else out.unionByName(f, allowMissingColumns=True)
    return out


def reconcile_slices(frames: Sequence[DataFrame], spec: ReconSpec = ReconSpec(), strategy: str = "join",
                     **options) -> DataFrame:
    """Reconciled entries of ``slice_entries`` frames, with their origin columns."""
    return reconcile(union_entries(frames), spec, strategy, within=origin_columns(spec), **options)


def _no_entries(spark, schema, dataset, spec, mappings, strategy) -> DataFrame:
    """The empty result, with the origin columns."""
    empty = normalize(spark.createDataFrame([], schema or LEDGER_SCHEMA), dataset, spec, mappings)
    empty = empty.withColumns({c: F.lit(None).cast("string") for c in origin_columns(spec)})
    return reconcile(empty, spec, strategy, within=origin_columns(spec))


def reconcile_requested(spark: SparkSession, requests: DataFrame, root: str | None = None,
                        schema: T.StructType | str | None = None, dataset: str = DEFAULT_DATASET,
                        spec: ReconSpec = ReconSpec(), strategy: str = "join",
                        mappings: Mapping[str, DatasetMapping] | None = None,
                        keep_origin: bool = False, failed: list[str] | None = None) -> DataFrame:
    """Reconciled entries of all slices named by valid requests.

    ``requests`` holds message bodies (column ``body``) or already parsed
    requests.  Paths are resolved against ``root`` (see ``resolve_path``).
    ``keep_origin`` adds the origin columns.  A dataset that cannot be read raises,
    or, with a list in ``failed``, is left out and named there.  One lazy result needs one
    plan, with a branch for each dataset; ``write_requested`` has no such limit.
    """
    slices = requested_slices(valid_requests(parsed(requests, spec)), spec)
    frames = []
    for path in requested_paths(slices):
        wanted = slices.where(F.col("data_source_path") == F.lit(path)).select(*spec.partition_keys)
        try:
            frames.append(slice_entries(spark, path, wanted, root, schema, dataset, spec, mappings))
        except Exception as exc:
            if failed is None:
                raise
            log.error("dataset %s cannot be read: %s", path, exc)
            failed.append(path)
    out = (reconcile_slices(frames, spec, strategy) if frames
           else _no_entries(spark, schema, dataset, spec, mappings, strategy))
    return out if keep_origin else out.drop(*origin_columns(spec))


def reconcile_default_source(spark: SparkSession, requests: DataFrame, source_path: str,
                             root: str | None = None, schema: T.StructType | str | None = None,
                             dataset: str = DEFAULT_DATASET, spec: ReconSpec = ReconSpec(),
                             strategy: str = "join",
                             mappings: Mapping[str, DatasetMapping] | None = None,
                             keep_origin: bool = False) -> DataFrame:
    """Variant whose requests carry only company and account: every slice is
    read from the configured ``source_path``.  A request lacking either key is
    invalid; a ``data_source_path`` in the message is ignored."""
    p = parsed(requests, spec)
    ok = F.col("reject_reason").isNull() | (
        F.col("reject_reason") == F.lit(REASON_MISSING + REQUIRED_FIELDS[2]))
    slices = p.where(ok).select(*spec.partition_keys).distinct()
    out = reconcile_slices([slice_entries(spark, source_path, slices, root, schema, dataset, spec, mappings)],
                           spec, strategy)
    return out if keep_origin else out.drop(*origin_columns(spec))


def dead_letters(requests: DataFrame, spec: ReconSpec = ReconSpec()) -> DataFrame:
    """Requests that cannot be processed, with the reason; other input
    columns (not the body) are kept."""
    extra = [c for c in requests.columns if c not in ("body", "partition_id", "reject_reason")]
    return rejected_requests(parsed(requests, spec)).select(*extra, "partition_id", "reject_reason")


def write_requested(spark: SparkSession, valid: DataFrame, write, root: str | None = None,
                    schema: T.StructType | str | None = None, dataset: str = DEFAULT_DATASET,
                    spec: ReconSpec = ReconSpec(), strategy: str = "join",
                    mappings: Mapping[str, DatasetMapping] | None = None,
                    per_job: int = PATHS_PER_JOB, slices_per_job: int = SLICES_PER_JOB,
                    **options) -> tuple[dict, list[Slice]]:
    """Write the result of every requested slice; (summed metrics, failed slices).

    ``write(frame)`` writes reconciled entries with origin columns and returns its
    metrics.  Slices are written together in blocks of at most ``per_job`` datasets and
    ``slices_per_job`` slices, without those whose files have no footer (``readable``).  When a block cannot be planned or fails at run time
    its halves are written instead, down to the slices at fault, so a damaged
    file costs the requests for its own slice and no others; all slices of a dataset
    that is not there fail at once.  Every slice has its own result
    directory, so a second write of one replaces only its own.
    """
    total: dict[str, int] = {}
    failed: list[Slice] = []

    def planned(block: list[Slice]) -> list[DataFrame]:
        frames = []
        for path, part in groupby(block, key=lambda s: s[0]):
            part = list(part)
            try:
                frames.append(slice_entries(spark, path, [s[1:] for s in part], root, schema, dataset, spec, mappings))
            except MissingDataset as exc:
                log.error("%s", exc)
                failed.extend(part)
        return frames

    def readable(block: list[Slice]) -> list[Slice]:
        """Slices whose files have a footer, by a count that reads no column; the others
        fail before anything is written.  Halves are tried where a count fails."""
        try:
            for path, part in groupby(block, key=lambda s: s[0]):
                url = resolve_path(path, root)
                if path.startswith(TABLE_PREFIX) or not sliced_by(spark, url, spec):
                    continue
                there = existing_of(spark, url, [s[1:] for s in part], spec)
                read_directories(spark, path, there, NO_COLUMN, spec, root).count()
        except MissingDataset:
            pass  # told by the plan
        except Exception as exc:
            if spark.sparkContext._jsc.sc().isStopped():
                raise
            if len(block) == 1:
                log.error("slice %s cannot be read: %s", block[0], exc)
                failed.extend(block)
                return []
            half = len(block) // 2
            return readable(block[:half]) + readable(block[half:])
        return block

    def attempt(block: list[Slice]) -> None:
        before = len(failed)
        try:
            frames = planned(block)
            if frames:
                for k, v in write(reconcile_slices(frames, spec, strategy, **options)).items():
                    total[k] = total.get(k, 0) + v
        except Exception as exc:
            if spark.sparkContext._jsc.sc().isStopped():
                raise  # no fault of a slice
            lost = set(failed[before:])
            block = [s for s in block if s not in lost]
            if len(block) == 1:
                log.error("slice %s failed: %s", block[0], exc)
                failed.extend(block)
                return
            half = len(block) // 2
            attempt(block[:half])
            attempt(block[half:])

    for block in slice_blocks(requested_slices(valid, spec), per_job, slices_per_job):
        block = readable(block)
        if block:
            attempt(block)
    return total, failed
