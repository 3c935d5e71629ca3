"""A ledger laid out so that reconciling it moves no entry.

Reconciling shuffles every entry twice by its keys: partial balances, and the
entries themselves for the join-back.  A ledger that is reconciled again and
again can be written once in the right places instead: a table bucketed on the three
(cleaned) keys.  Both the aggregate and the join-back then find the rows of a
group in one bucket, and the plan has no exchange.

Buckets cannot be split, so what would make one heavy is kept out of them: entries
with a null key (they never match) and groups of more than ``HOT_SHARE`` of an average
bucket.  Those go to a second, plain table with the same columns and are
reconciled by the default plan, whose exchanges split hot keys.  At most
``buckets / HOT_SHARE`` groups can be that large, so their keys are a
bounded set, broadcast when the ledger is written.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import all_present
from ..operators import reconcile
from ..spec import ReconSpec

DEFAULT_BUCKETS = 200
#: Groups larger than this share of an average bucket are kept out of the buckets.
HOT_SHARE = 0.25


@dataclass(frozen=True)
class ColocatedLedger:
    """Names of the two tables: entries in buckets, and the spread rest."""

    bucketed: str
    spread: str


def write_colocated(entries: DataFrame, name: str, buckets: int = DEFAULT_BUCKETS, path: str | None = None,
                    hot_share: float = HOT_SHARE, spec: ReconSpec = ReconSpec()) -> ColocatedLedger:
    """Write typed, cleaned entries (see ``normalize``) as tables ``name`` and
    ``name_spread``, under ``path`` if given.  One pass counts the groups, one writes."""
    keys = spec.keys
    total = entries.count()
    limit = max(1, int(total / buckets * hot_share))
    # fewer than buckets / hot_share rows
    hot = entries.where(all_present(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_nz_n")).where(F.col("_nz_n") > limit)
    marked = entries.join(F.broadcast(hot), keys, "left")
    cold = all_present(keys) & F.col("_nz_n").isNull()
    columns = entries.columns

    def saved(df: DataFrame, table: str) -> None:
        writer = df.select(*columns).write.format("parquet").mode("overwrite")
        if path is not None:
            writer = writer.option("path", f"{path.rstrip('/')}/{table}")
        if table == name:  # one file a bucket, sorted
            writer = writer.bucketBy(buckets, *keys).sortBy(*keys)
        writer.saveAsTable(table)

    ledger = ColocatedLedger(name, f"{name}_spread")
    saved(marked.where(cold).repartition(buckets, *keys), ledger.bucketed)
    saved(marked.where(~cold).hint("rebalance"), ledger.spread)
    return ledger


def reconcile_bucketed(spark: SparkSession, ledger: ColocatedLedger, spec: ReconSpec = ReconSpec()) -> DataFrame:
    """Reconciled entries of the bucketed table; no exchange."""
    return reconcile(spark.table(ledger.bucketed), spec, "colocated")


def reconcile_colocated(spark: SparkSession, ledger: ColocatedLedger, spec: ReconSpec = ReconSpec()) -> DataFrame:
    """Reconciled entries of the whole ledger: groups are wholly in one of its tables."""
    rest = reconcile(spark.table(ledger.spread), spec)
    return reconcile_bucketed(spark, ledger, spec).unionByName(rest)
