"""Reading a partitioned ledger dataset (whole, or only requested slices)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import KEY_SEPARATOR, all_present
from ..spec import ReconSpec
from .paths import resolve_path
from .slices import read_directories, sliced_by, wanted_directories

# Ledger contract as written by the fixture and by upstream producers.
LEDGER_SCHEMA = T.StructType([
    T.StructField("transactionID", T.StringType()),
    T.StructField("data_contabil", T.DateType()),
    T.StructField("valor_net", T.DecimalType(18, 2)),
    T.StructField("cliente_nome", T.StringType()),
    T.StructField("empresa", T.StringType()),
    T.StructField("conta_contabil", T.StringType()),
])

# A dataset reference starting with this names a catalog table instead of a path.
TABLE_PREFIX = "table:"

# Up to this many requested slices the scan predicate lists the key pairs as
# structs; larger sets are listed as joined keys (one literal each, looked up by
# hash), in predicates of at most BLOCK_SLICES that share one file listing.
MAX_INLINE_SLICES = 1000
BLOCK_SLICES = 50_000


def _with_string_partitions(schema: T.StructType, partition_keys: Sequence[str]) -> T.StructType:
    """Same fields, partition keys typed as string so that ``0011`` stays ``0011``."""
    keys = {k.lower() for k in partition_keys}
    fields = [
        T.StructField(f.name, T.StringType(), True) if f.name.lower() in keys else f
        for f in schema.fields
    ]
    return T.StructType(fields)


def read_ledger(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    spec: ReconSpec = ReconSpec(),
    root: str | None = None,
) -> DataFrame:
    """Lazily scan a Hive-partitioned Parquet ledger.

    Partition keys are always read as strings (no type inference: leading
    zeros survive and a non-numeric key never fails a numeric cast).  Without
    an explicit ``schema`` the data columns come from one Parquet footer
    (no schema merge).

    ``path`` may instead be ``table:<name>``, a partitioned catalog table
    (types as declared there).  Slice filters on a table are pruned by the
    catalog, so only the requested partitions are listed — with a path, Spark
    lists the whole dataset tree before pruning, which dominates on a ledger
    with very many partition directories.
    """
    if path.startswith(TABLE_PREFIX):
        return spark.table(path[len(TABLE_PREFIX):])
    url = resolve_path(path, root)
    reader = spark.read.option("mergeSchema", "false")
    if schema is None:
        schema = reader.parquet(url).schema
    elif isinstance(schema, str):
        schema = T.DataType.fromDDL(schema)
    return reader.schema(_with_string_partitions(schema, spec.partition_keys)).parquet(url)


def slice_predicate(slices: Sequence[tuple[str, str]], spec: ReconSpec = ReconSpec()) -> Column:
    """Predicate on raw partition values selecting the given (company, account)
    pairs; it lands in the scan's ``PartitionFilters``."""
    c, a = spec.partition_keys
    if not slices:
        return F.lit(False)
    if len(slices) > MAX_INLINE_SLICES:
        joined = F.concat(F.col(c), F.lit(KEY_SEPARATOR), F.col(a))
        return joined.isin([f"{x}{KEY_SEPARATOR}{y}" for x, y in slices])
    return F.struct(F.col(c), F.col(a)).isin([F.struct(F.lit(x), F.lit(y)) for x, y in slices])


def read_slices(
    spark: SparkSession,
    path: str,
    requested: DataFrame | Sequence[tuple[str, str]],
    schema: T.StructType | str | None = None,
    spec: ReconSpec = ReconSpec(),
    root: str | None = None,
    block: int = BLOCK_SLICES,
) -> DataFrame:
    """Scan only the requested (company, account) slices of a ledger.

    ``requested`` is a DataFrame with the two partition key columns or a list of
    pairs.  Keys are compared on their raw values, as stored in the directory names.

    A DataFrame may hold any number of slices, existing or not: the scan is over
    the directories of those that exist (see ``slices``), so the driver holds no
    more than the ledger has partitions.  A list becomes partition-pruning
    predicates of at most ``block`` pairs each over one relation (one listing); so
    does, for a catalog table or a dataset laid out otherwise, the part of a
    DataFrame that its partitions have.
    """
    if isinstance(requested, DataFrame):
        if not path.startswith(TABLE_PREFIX) and sliced_by(spark, resolve_path(path, root), spec):
            return read_directories(spark, path, wanted_directories(spark, path, requested, spec, root), schema, spec, root)
        keys = requested.select(*spec.partition_keys).where(all_present(spec.partition_keys)).distinct()
        there = read_ledger(spark, path, schema, spec, root).select(*spec.partition_keys).distinct()
        requested = sorted((r[0], r[1]) for r in there.join(keys, spec.partition_keys, "left_semi").toLocalIterator())
    ledger = read_ledger(spark, path, schema, spec, root)
    pairs = list(dict.fromkeys(requested))
    out = ledger.where(slice_predicate(pairs[:block], spec))
    for at in range(block, len(pairs), block):
        out = out.union(ledger.where(slice_predicate(pairs[at:at + block], spec)))
    return out
