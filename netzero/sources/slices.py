"""Reading requested slices of a ledger by their directories.

A slice of a Hive-partitioned ledger is one directory, named after the raw key
values.  Up to ``DIRECT_SLICES`` requested slices are looked up one by one in the
file system, so no other directory of the dataset is listed, however many it
has.  Larger request sets are joined in Spark with the partition values found by
one listing, and only the slices that exist come to the driver, so what it holds
is bounded by the partitions of the ledger, never by the requests.  Either way
the scan is over exactly the directories that were asked for and exist; there are no
literals in the plan.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import all_present
from ..spec import ReconSpec
from .paths import resolve_path

#: Requested slices looked up one by one; more are joined with a listing.
DIRECT_SLICES = 1000
LOOKUP_THREADS = 16

# Fixed value: characters that Hive partition directories hold as %XX (with the control characters).
ESCAPED = '"#%\'*/:=?\\{[]^\x7f'


class MissingDataset(FileNotFoundError):
    """No dataset at the requested path: none of its slices can be read."""


def directory_name(key: str, value: str) -> str:
    """Name of the directory of one partition value."""
    return f"{key}=" + "".join(f"%{ord(c):02X}" if c in ESCAPED or ord(c) < 32 else c for c in value)


def nested_directory(url: str, names: Sequence[str], values: Sequence[str]) -> str:
    return "/".join([url.rstrip("/"), *[directory_name(k, v) for k, v in zip(names, values)]])


def slice_directory(url: str, slice_: Sequence[str], spec: ReconSpec = ReconSpec()) -> str:
    return nested_directory(url, spec.partition_keys, slice_)


def file_system(spark: SparkSession, url: str):
    path = spark._jvm.org.apache.hadoop.fs.Path
    return path(url).getFileSystem(spark._jsc.hadoopConfiguration()), path


def sliced_by(spark: SparkSession, url: str, spec: ReconSpec = ReconSpec()) -> bool:
    """Whether the dataset has directories of the first partition key on top: its
    first entry tells.  Raises ``MissingDataset`` if there is nothing at ``url``."""
    fs, path = file_system(spark, url)
    if not fs.exists(path(url)):
        raise MissingDataset(f"no dataset at {url}")
    entries = fs.listStatusIterator(path(url))
    while entries.hasNext():
        name = entries.next().getPath().getName()
        if name[:1] not in "._":
            return name.startswith(f"{spec.partition_keys[0]}=")
    return True  # an empty folder has no slice


def existing_of(spark: SparkSession, url: str, slices: Sequence[tuple[str, str]], spec: ReconSpec = ReconSpec()) -> list[tuple[str, str]]:
    """Those of ``slices`` that have a directory; no directory is listed."""
    fs, path = file_system(spark, url)
    with ThreadPoolExecutor(LOOKUP_THREADS) as pool:
        there = list(pool.map(lambda s: fs.exists(path(slice_directory(url, s, spec))), slices))
    return [s for s, ok in zip(slices, there) if ok]


def partition_values(spark: SparkSession, url: str, names: Sequence[str]) -> DataFrame:
    """Distinct values of the partition columns ``names``, nested in this order, from
    one listing of the files below ``url`` (their content is not read)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(url).select("path")
    nested = "/" + "/".join(f"{re.escape(k)}=([^/]*)" for k in names) + "/"
    raw = lambda i: F.regexp_extract("path", nested, i)
    # a plus sign is itself in a directory name, not an encoded blank
    value = lambda i: F.try_url_decode(F.replace(raw(i), F.lit("+"), F.lit("%2B")))
    found = files.where(F.regexp_like("path", F.lit(nested)))
    return found.select(*[value(i).alias(k) for i, k in enumerate(names, 1)]).distinct()


def existing_slices(spark: SparkSession, path: str, spec: ReconSpec = ReconSpec(), root: str | None = None) -> DataFrame:
    """Raw key values of all slices of a dataset."""
    return partition_values(spark, resolve_path(path, root), spec.partition_keys)


def wanted_directories(spark: SparkSession, path: str, requested: DataFrame, spec: ReconSpec = ReconSpec(),
                       root: str | None = None, direct: int = DIRECT_SLICES) -> list[tuple[str, str]]:
    """The requested slices that exist, sorted."""
    keys = requested.select(*spec.partition_keys).where(all_present(spec.partition_keys)).distinct()
    rows = keys.limit(direct + 1).collect()
    if len(rows) > direct:
        there = existing_slices(spark, path, spec, root)
        return sorted((r[0], r[1]) for r in there.join(keys, spec.partition_keys, "left_semi").toLocalIterator())
    return existing_of(spark, resolve_path(path, root), sorted((r[0], r[1]) for r in rows), spec)


def read_directories(spark: SparkSession, path: str, slices: Sequence[tuple[str, str]],
                     schema: T.StructType | str | None = None, spec: ReconSpec = ReconSpec(),
                     root: str | None = None) -> DataFrame:
    """Scan of the directories of ``slices``, which exist.  Partition keys are
    text.  Without ``schema`` the data columns come from a footer of the first one."""
    url = resolve_path(path, root)
    reader = spark.read.option("mergeSchema", "false").option("basePath", url)
    dirs = [slice_directory(url, s, spec) for s in slices]
    if schema is None:
        schema = reader.parquet(dirs[0]).schema if dirs else reader.parquet(url).schema
    elif isinstance(schema, str):
        schema = T.DataType.fromDDL(schema)
    keys = {k.lower() for k in spec.partition_keys}
    data = [f for f in schema.fields if f.name.lower() not in keys]
    typed = T.StructType([*data, *[T.StructField(k, T.StringType()) for k in spec.partition_keys]])
    if not dirs:
        return spark.createDataFrame([], typed)
    return reader.schema(typed).parquet(*dirs)
