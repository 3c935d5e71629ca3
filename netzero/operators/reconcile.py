"""Netting of ledger entries per (company, account, transaction).

An entry is reconciled iff its three keys are present and the sum of the
non-null amounts of its key group exists and equals zero.  Reconciled entries
share one deterministic id per group; pending entries get a null id.  The
entry set is kept one-to-one.

Plan shape (``strategy="join"``, the default):

* the group balance is a hash aggregate on the keys with map-side partial
  sums, so a hot group reaches the final aggregate as at most one row per map
  task; only balanced groups are kept;
* the entries are joined back (left join) on (keys, spread).  Rows with a null
  key can never match; instead of all hashing to one task they carry a spread
  value (a content-hash bucket) as that extra join column, 0 for keyed rows;
* the balanced groups get their own narrow exchange for the join, so both
  join inputs are plain shuffle stages and AQE can split a hot entries
  partition (skew join).  Spark broadcasts the balanced side when its
  estimated or measured size allows; otherwise AQE picks a shuffled hash join
  when each measured build partition fits (no sort of the entries), else a
  sort-merge join.

``strategy="salted"`` spreads every group without relying on AQE: each entry
gets a salt from a hash of its own content, partial balances are summed per
(keys, salt), the group total is attached to each (keys, salt) row (a window
over at most ``salts`` rows per group) and the entries are joined back on
(keys, salt), so one hot group is spread over ``salts`` tasks.

``strategy="colocated"`` is for entries bucketed on the keys (see
``plans.colocated``): aggregate and join-back are on the keys alone, so the
buckets serve both and nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import all_present, canonical, group_uuid, is_zero, status_label
from ..spec import ReconSpec

DEFAULT_SALTS = 32
DEFAULT_NULL_SPREAD = 1024
_SALT = "_nz_salt"
_PART = "_nz_part"
_GID = "_nz_gid"


def txn_summary(entries: DataFrame, spec: ReconSpec = ReconSpec()) -> DataFrame:
    """One row per key group: keys, balance, entry count, reconciled flag, id.

    Null keys form their own groups (as a GROUP BY does) but are never
    reconciled.  The balance is the exact decimal sum of the typed amounts.
    """
    keys = spec.keys
    done = all_present(keys) & is_zero(spec.balance)
    return (
        entries.groupBy(*keys)
        .agg(F.sum(spec.amount).alias(spec.balance), F.count(F.lit(1)).alias("n_entries"))
        .withColumn("is_reconciled", done)
        .withColumn(spec.group_id, F.when(F.col("is_reconciled"), group_uuid(keys)))
    )


def _finish(df: DataFrame, spec: ReconSpec) -> DataFrame:
    return df.withColumn(
        spec.status,
        status_label(F.col(_GID).isNotNull(), spec.reconciled_label, spec.pending_label),
    ).withColumnRenamed(_GID, spec.group_id)


# Exact amount types: a balance of floating-point or text amounts would not
# be an exact sum, so "equals zero" would not mean balanced.
_EXACT_TYPES = ("decimal", "bigint", "int", "smallint", "tinyint")


def _check_amount_type(entries: DataFrame, spec: ReconSpec) -> None:
    dtype = dict(entries.dtypes).get(spec.amount)
    if dtype is None:
        raise ValueError(f"no amount column {spec.amount!r}")
    if not dtype.startswith(_EXACT_TYPES):
        raise TypeError(f"amount column {spec.amount!r} is {dtype}; type it first "
                        f"(normalize / to_money give {spec.money_type})")


def _spread(has_keys, cols: list[str], buckets: int):
    """0 for keyed rows; a content hash bucket for rows with a null key."""
    return F.when(has_keys, F.lit(0)).otherwise(F.pmod(F.xxhash64(*cols), F.lit(buckets)))


def reconcile(entries: DataFrame, spec: ReconSpec = ReconSpec(), strategy: str = "join",
              salts: int = DEFAULT_SALTS, null_spread: int = DEFAULT_NULL_SPREAD,
              join_hint: str | None = None,
              salt_columns: Sequence[str] | None = None,
              within: Sequence[str] = ()) -> DataFrame:
    """Entries with ``reconciliation_status`` and ``conciliation_id`` added.

    ``entries`` must already be typed and cleaned (see ``normalize``).
    Output columns: the group keys first, then the other entry columns, then
    status and id.  ``join_hint`` (``"shuffle_hash"``, ``"shuffle_merge"``)
    pins the join-back strategy; by default Spark chooses by size.  ``shuffle_hash`` is the at-scale plan: the balanced-group side is
    unique per key, so each task hashes its share of it and streams the
    entries through without sorting them.  ``salt_columns`` (default: every
    column) feed the salt and null-key spread hashes; pass an entry id to
    spread even exact duplicate rows.  ``within`` names further non-null
    columns (such as the slice a row was read from): entries net only within
    equal values of them, and the id depends on them.
    """
    if join_hint not in (None, "shuffle_hash", "shuffle_merge"):
        raise ValueError(f"join_hint {join_hint!r}: a forced broadcast has no size check")
    entries = canonical(entries, [*spec.keys, spec.amount])
    _check_amount_type(entries, spec)
    keys = [*spec.keys, *within]
    id_keys = [*within, *spec.keys]
    # a status from an earlier run (results fed back in) is recomputed
    entries = entries.drop(spec.status, spec.group_id)
    others = [c for c in entries.columns if c not in keys]
    has_keys = all_present(spec.keys)
    hashed = list(salt_columns or entries.columns)

    if strategy == "join":
        spread = entries.withColumn(_SALT, _spread(has_keys, hashed, null_spread))
        # Aggregated on the keys alone, so the join on (keys, spread) gets its
        # own exchange on this side: both join inputs are then plain shuffle
        # stages, which is what lets AQE split a hot entries partition.
        balanced = (
            entries.where(has_keys).groupBy(*keys).agg(F.sum(spec.amount).alias(spec.balance))
            .where(is_zero(spec.balance))
            .select(*keys, _spread(has_keys, keys, null_spread).alias(_SALT),
                    group_uuid(id_keys).alias(_GID))
        )
    elif strategy == "salted":
        spread = entries.withColumn(_SALT, F.pmod(F.xxhash64(*hashed), F.lit(salts)))
        balanced = (
            spread.where(has_keys)
            .groupBy(*keys, _SALT).agg(F.sum(spec.amount).alias(_PART))
            .withColumn(spec.balance, F.sum(_PART).over(Window.partitionBy(*keys)))
            .where(is_zero(spec.balance))
            .select(*keys, _SALT, group_uuid(id_keys).alias(_GID))
        )
    elif strategy == "colocated":
        spread = entries
        balanced = (
            entries.where(has_keys).groupBy(*keys).agg(F.sum(spec.amount).alias(spec.balance))
            .where(is_zero(spec.balance)).select(*keys, group_uuid(id_keys).alias(_GID))
        ).hint("shuffle_hash")  # never a broadcast; the balanced side of a bucket is hashed, entries stream
    else:
        raise ValueError(f"unknown strategy {strategy!r}; use 'join', 'salted' or 'colocated'")

    if join_hint:
        balanced = balanced.hint(join_hint)
    matched = spread.join(balanced, keys if strategy == "colocated" else keys + [_SALT], "left")
    return _finish(matched, spec).select(*keys, *others, spec.status, spec.group_id)
