"""Column expressions shared by the operators.

All are built from ``pyspark.sql.functions`` so they stay inside whole-stage
codegen; none of them needs Python at run time.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Unit separator: cannot be confused with text inside a key, so ("A|B", "C")
# and ("A", "B|C") hash differently.
KEY_SEPARATOR = "\x1f"


def col_of(name: str | Column) -> Column:
    return F.col(name) if isinstance(name, str) else name


def clean_text(c: str | Column) -> Column:
    """Trim blanks and upper-case (``upper(trim(x))``); null stays null."""
    return F.upper(F.trim(col_of(c)))


def to_money(c: str | Column, money_type: str = "decimal(18,2)") -> Column:
    """Typed amount: HALF_UP rounding to the scale, null for text that is not a
    number or does not fit (the non-ANSI cast result, without raising)."""
    return col_of(c).try_cast(money_type)


def all_present(cols: Iterable[str | Column]) -> Column:
    """True when every column is non-null; never null itself."""
    cond = None
    for c in cols:
        part = col_of(c).isNotNull()
        cond = part if cond is None else cond & part
    return cond if cond is not None else F.lit(True)


def is_zero(balance: str | Column) -> Column:
    """Balance equals exactly zero; a null balance is *not* zero (never null)."""
    return F.coalesce(col_of(balance) == F.lit(0), F.lit(False))


def group_uuid(keys: Sequence[str | Column]) -> Column:
    """Deterministic UUID-shaped id of a key group: md5 over the keys joined by
    a control character, split 8-4-4-4-12.  Same value on every retry, replay
    and engine (it is plain md5 text)."""
    h = F.md5(F.concat_ws(KEY_SEPARATOR, *[col_of(k) for k in keys]))
    return F.concat_ws(
        "-",
        F.substring(h, 1, 8),
        F.substring(h, 9, 4),
        F.substring(h, 13, 4),
        F.substring(h, 17, 4),
        F.substring(h, 21, 12),
    )


def status_label(is_reconciled: Column, reconciled: str, pending: str) -> Column:
    return F.when(is_reconciled, F.lit(reconciled)).otherwise(F.lit(pending))


_TIEBREAK = "_nz_tiebreak"


def spread_sort(df: DataFrame, cols: Sequence[str], tasks: int | None = None) -> DataFrame:
    """Global ascending sort on ``cols`` that a hot sort key cannot pin to one task.

    A range partitioner never splits equal keys, so a (company, account,
    date) holding a third of the rows would land in a single reduce task.
    Rows are tie-broken by the index of the input partition they come from
    (the same on a task retry), so the sampled range bounds can cut through a
    hot key and no sort key carries more than one input split per task.  The
    order on ``cols`` is unchanged.  ``tasks`` sets the number of ranges, which AQE
    then does not merge.
    """
    if not cols:
        return df
    tied = df.withColumn(_TIEBREAK, F.spark_partition_id())
    if tasks:
        ranges = tied.repartitionByRange(tasks, *cols, _TIEBREAK)
        return ranges.sortWithinPartitions(*cols, _TIEBREAK).drop(_TIEBREAK)
    return tied.orderBy(*cols, _TIEBREAK).drop(_TIEBREAK)


def resolve(df: DataFrame, name: str) -> str | None:
    """Actual column name in ``df`` matching ``name`` case-insensitively."""
    lowered = {c.lower(): c for c in df.columns}
    return lowered.get(name.lower())


def canonical(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Columns matching one of ``names`` in another case are renamed to it."""
    new = {resolve(df, n): n for n in names if resolve(df, n) not in (None, n)}
    return df.withColumnsRenamed(new) if new else df


def present(df: DataFrame, names: Iterable[str]) -> list[str]:
    """Actual names of the requested columns that exist in ``df``, in request order."""
    out = []
    for n in names:
        r = resolve(df, n)
        if r is not None and r not in out:
            out.append(r)
    return out
