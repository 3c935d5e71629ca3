"""Replacing slices of a result without a moment in which they are gone.

Dynamic partition overwrite deletes a slice's old files and then moves the new
ones in; a driver lost in between leaves the slice empty.  Here every write goes to a
version directory of its own, and a manifest names the version that holds each
slice:

    <path>/data/version=<id>/<directories>/part-…   never changed once written
    <path>/manifests/<number>/part-…                (directories, version) of every slice

A write becomes visible when its manifest, complete and written elsewhere, is
renamed to the next number: one rename.  Before that, readers see the earlier
manifest and with it every earlier slice, whatever the failed write left behind.  A
result has one writer at a time (as a stream has); readers need no lock.  The new
manifest is the old one without the slices just written, plus those, a join
in Spark; readers hold the list of directories, as a listing does.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.slices import directory_name, file_system, nested_directory, partition_values
from ..spec import ReconSpec
from .sink import PART_SUFFIX, write_result

VERSION = "version"
#: Digits of a manifest's number, so that names sort as numbers do.
DIGITS = 12


def _manifests(path: str) -> str:
    return f"{path.rstrip('/')}/manifests"


def _data(path: str) -> str:
    return f"{path.rstrip('/')}/data"


def manifest_numbers(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the committed manifests, ascending."""
    fs, to = file_system(spark, path)
    if not fs.exists(to(_manifests(path))):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(to(_manifests(path)))]
    return sorted(int(n) for n in names if n.isdigit())


def manifest(spark: SparkSession, path: str, directories: Sequence[str], number: int | None = None) -> DataFrame:
    """(directories, version) of every slice, by the last manifest or that of ``number``."""
    numbers = manifest_numbers(spark, path)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*directories, VERSION)])
    if not numbers:
        return spark.createDataFrame([], schema)
    number = numbers[-1] if number is None else number
    return spark.read.schema(schema).parquet(f"{_manifests(path)}/{number:0{DIGITS}d}")


def commit(spark: SparkSession, path: str, version: str, directories: Sequence[str]) -> int | None:
    """Make the slices of ``version`` the current ones; the manifest's number, or
    None if the version has no slice."""
    folder = nested_directory(_data(path), [VERSION], [version])
    fs, to = file_system(spark, path)
    if not fs.exists(to(folder)):
        return None
    new = partition_values(spark, folder, directories).withColumn(VERSION, F.lit(version))
    if new.isEmpty():
        return None
    number = (manifest_numbers(spark, path) or [-1])[-1] + 1
    kept = manifest(spark, path, directories).join(new, list(directories), "left_anti")
    staged = f"{_manifests(path)}/.{number}-{uuid.uuid4().hex}"
    kept.unionByName(new).write.parquet(staged)
    name = to(f"{_manifests(path)}/{number:0{DIGITS}d}")
    if fs.exists(name) or not fs.rename(to(staged), name):
        raise RuntimeError(f"manifest {number} of {path} was written by another writer")
    return number


def write_version(df: DataFrame, path: str, *args, directories: Sequence[str] | None = None,
                  partition_by: Sequence[str] | None = None, **options) -> dict:
    """``write_result`` into a version of its own, then the commit.  An empty
    result changes nothing."""
    spec = options.get("spec") or ReconSpec()
    names = directory_columns(spec.partition_keys if partition_by is None else partition_by, directories,
                              options.get("copy_partition_columns", True))
    if not names:
        raise ValueError("versions replace slices: the result needs directories")
    version = uuid.uuid4().hex
    metrics = write_result(df, nested_directory(_data(path), [VERSION], [version]), *args, directories=directories,
                           partition_by=partition_by, **options)
    commit(df.sparkSession, path, version, names)
    return metrics


def directory_columns(partition_by: Sequence[str], directories: Sequence[str] | None, copies: bool = True) -> list[str]:
    """Names in the directories of a result, as ``write_result`` builds them."""
    if directories:
        return list(directories)
    return [c + PART_SUFFIX if copies else c for c in partition_by]


def read_current(spark: SparkSession, path: str, schema: T.StructType, directories: Sequence[str],
                 number: int | None = None) -> DataFrame:
    """The current slices (those of manifest ``number``, for a look back): columns of
    ``schema`` and the directory columns as text."""
    rows = manifest(spark, path, directories, number).collect()  # a row for each slice, as in a listing
    names = [VERSION, *directories]
    have = {f.name for f in schema.fields}
    full = T.StructType([*schema.fields, *[T.StructField(c, T.StringType()) for c in names if c not in have]])
    if not rows:
        return spark.createDataFrame([], full).drop(VERSION)
    data = _data(path)
    # a blank value has the same directory name as a null one
    dirs = sorted("/".join([data, *[directory_name(c, r[c] or "__HIVE_DEFAULT_PARTITION__") for c in names]]) for r in rows)
    return spark.read.option("basePath", data).schema(full).parquet(*dirs).drop(VERSION)


def superseded(spark: SparkSession, path: str, directories: Sequence[str]) -> DataFrame:
    """(directories, version) of slices on disk that the last manifest does not
    name: replaced ones, and what failed writes left."""
    on_disk = partition_values(spark, _data(path), [VERSION, *directories])
    return on_disk.join(manifest(spark, path, directories), [VERSION, *directories], "left_anti")
