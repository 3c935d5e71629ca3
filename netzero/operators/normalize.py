"""Projection, typing and cleaning of raw ledger entries."""

from __future__ import annotations

import logging
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import canonical, clean_text, present, spread_sort, to_money
from ..spec import DEFAULT_DATASET, DatasetMapping, ReconSpec, dataset_mappings

log = logging.getLogger("netzero")


def _mapping(dataset: str, mappings: Mapping[str, DatasetMapping] | None) -> DatasetMapping | None:
    return (mappings if mappings is not None else dataset_mappings()).get(dataset)


def project(df: DataFrame, dataset: str = DEFAULT_DATASET,
            mappings: Mapping[str, DatasetMapping] | None = None) -> DataFrame:
    """Keep the mapped columns of ``dataset`` that exist (case-insensitive),
    in mapping order.  An unknown dataset passes every column through."""
    m = _mapping(dataset, mappings)
    if m is None:
        log.warning("no mapping for dataset %r; keeping all columns", dataset)
        return df
    return df.select(*present(df, m.columns))


def type_and_clean(df: DataFrame, spec: ReconSpec = ReconSpec()) -> DataFrame:
    """Amount columns -> ``spec.money_type`` (null when not a number);
    key and name columns -> ``upper(trim(x))``.  Absent columns are skipped;
    columns the spec names get its spelling (``EMPRESA`` becomes ``empresa``)."""
    df = canonical(df, dict.fromkeys([*spec.keys, spec.booking_date, *spec.money_columns, *spec.text_columns]))
    changes = {c: to_money(c, spec.money_type) for c in present(df, spec.money_columns)}
    changes.update({c: clean_text(c) for c in present(df, spec.text_columns)})
    return df.withColumns(changes) if changes else df


def normalize(df: DataFrame, dataset: str = DEFAULT_DATASET, spec: ReconSpec = ReconSpec(),
              mappings: Mapping[str, DatasetMapping] | None = None) -> DataFrame:
    """Projection followed by typing and cleaning."""
    return type_and_clean(project(df, dataset, mappings), spec)


def order_entries(df: DataFrame, dataset: str = DEFAULT_DATASET,
                  mappings: Mapping[str, DatasetMapping] | None = None) -> DataFrame:
    """Global ascending sort by the dataset's ``order_by`` columns that exist.

    Meant as the last step of a returned result (any later shuffle drops the
    order); hot sort keys are split across tasks (see ``spread_sort``).
    """
    m = _mapping(dataset, mappings)
    return spread_sort(df, present(df, m.order_by) if m is not None else [])


def rejected_amounts(raw: DataFrame, spec: ReconSpec = ReconSpec()) -> DataFrame:
    """Entries whose raw amount is present but does not type: not a number, or
    too large for the money type.  One row per rejected (entry, column); these
    entries would otherwise count as a null amount in their group's balance."""
    cols = present(raw, spec.money_columns)
    keys = present(raw, spec.keys + [spec.booking_date])
    parts = [
        raw.where(F.col(c).isNotNull() & to_money(c, spec.money_type).isNull())
        .select(*keys, F.lit(c).alias("amount_column"), F.col(c).cast("string").alias("raw_amount"))
        for c in cols
    ]
    if not parts:
        return raw.select(*keys, F.lit(None).cast("string").alias("amount_column"),
                          F.lit(None).cast("string").alias("raw_amount")).where(F.lit(False))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
