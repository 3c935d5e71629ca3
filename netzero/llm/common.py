"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import scratch_path

#: ASCII white space, the word separators of every operator (Java and RE2 syntax).
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a new folder under the shared checkpoint dir and read
    back: cuts the lineage, is computed once, and survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(c: str | Column = "text") -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c, F.lit(""))


#: Bytes of an Arrow batch sent to Python; Spark's own bound is 64 MB.
ARROW_BYTES = 1 << 20
_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession, most: int = ARROW_BYTES) -> None:
    """Let Arrow batches end at ``most`` bytes (a smaller setting is kept), so that texts
    of any length are held in small parts on both sides.  Set for the session, as
    plans read it when they run; results do not depend on it."""
    now = spark.conf.get(_BYTES).strip().lower()
    # Spark gives the setting back as it was typed: bytes, or a number with a unit
    size = re.fullmatch(r"(\d+)\s*([kmgtp]?)(?:i?b)?", now)
    if not size or not 0 < int(size[1]) << 10 * " kmgtp".index(size[2] or " ") <= most:
        spark.conf.set(_BYTES, str(most))


def sized_chunks(frames: Iterable[pd.DataFrame], text: str, max_chars: int) -> Iterator[pd.DataFrame]:
    """Cut Arrow batches into frames of about ``max_chars`` characters of
    ``text`` (one row at least), so memory follows this bound, not the row
    count of a batch."""
    for f in frames:
        if f.empty:
            continue
        cum = f[text].str.len().fillna(0).astype("int64").cumsum() // max_chars
        for _, part in f.groupby(cum.to_numpy(), sort=False):
            yield part
