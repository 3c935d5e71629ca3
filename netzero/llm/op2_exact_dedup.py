"""Exact deduplication with two-pass Bloom filtering (DataFrame functions only).

Texts are equal when identical after every run of ASCII white space is
replaced by one space; a null text counts as empty.

Pass 1 maps each text hash to ``HASHES`` positions of a bit filter and counts
the positions with map-side partial sums; a position hit twice or more sets
its bit (kept as 4 KB bitmaps, one row per 32,768 positions).  Pass 2 looks
every row up: a row with one position not set is unique for certain and passes
straight through; only the others are shuffled and compared by SHA-256, so a
false positive costs a shuffled row and never changes the result.

The filter has 16 bits per row, at most ``max_bits`` (its broadcast size is
therefore bounded: ``max_bits / 8`` bytes).  Beyond that it fills up, more rows
take the exact path, and the result stays the same.

Edge cases: an empty table gives an empty result; ``doc_id`` null sorts after
every other id; a group of rows with only null ids keeps one of them, with
``keep_id`` null; of rows that repeat both id and text exactly one is kept.
Extra columns are carried by ``drop_exact_copies`` and ignored by
``exact_dedup``; internal columns start with ``_nz_``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACES, stored, table, text_or_empty

HASHES = 2
BITS_PER_ROW = 16
#: Largest filter: 2^30 bits are 128 MB to broadcast.
MAX_BITS = 1 << 30
_BITMAP_BITS = 32768  # fixed by Spark's bitmap functions


def text_sha256(text: str | Column = "text") -> Column:
    return F.sha2(F.regexp_replace(text_or_empty(text), SPACES, " "), 256)


def _positions(sha: Column, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(sha, F.lit(i)), F.lit(bits)) + F.lit(1) for i in range(HASHES)]


def filter_bits(rows: int, max_bits: int = MAX_BITS) -> int:
    """Power of two with at least ``BITS_PER_ROW`` bits a row, within bounds."""
    return min(max_bits, max(_BITMAP_BITS, 1 << (max(1, rows * BITS_PER_ROW) - 1).bit_length()))


def repeated_positions(hashes: DataFrame, bits: int) -> DataFrame:
    """Pass 1: (bucket, bitmap) of the filter positions hit at least twice."""
    hits = (
        hashes.select(F.explode(F.array_distinct(F.array(*_positions(F.col("_nz_sha"), bits)))).alias("p"))
        .groupBy("p").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    )
    return hits.groupBy(F.bitmap_bucket_number("p").alias("_nz_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("_nz_bitmap"))


def bit_is_set(bitmap: Column, position: Column) -> Column:
    """Bit of a 32,768-position bitmap; false where there is no bitmap."""
    at = F.bitmap_bit_position(position).cast("int")
    byte = F.conv(F.hex(bitmap.substr(F.shiftright(at, 3) + F.lit(1), F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.call_function("getbit", byte, at.bitwiseAND(F.lit(7))) == 1, F.lit(False))


def flag_possible_repeats(df: DataFrame, bitmaps: DataFrame, bits: int) -> DataFrame:
    """Pass 2: add ``_nz_maybe``, false only for rows whose hash is unique."""
    found = F.lit(True)
    for i, p in enumerate(_positions(F.col("_nz_sha"), bits)):
        side = F.broadcast(bitmaps.select(F.col("_nz_bucket").alias(f"_nz_k{i}"),
                                          F.col("_nz_bitmap").alias(f"_nz_b{i}")))
        df = df.withColumn(f"_nz_k{i}", F.bitmap_bucket_number(p)).join(side, f"_nz_k{i}", "left")
        found = found & bit_is_set(F.col(f"_nz_b{i}"), p)
    df = df.withColumn("_nz_maybe", found)
    return df.drop(*[f"_nz_{x}{i}" for x in "kb" for i in range(HASHES)])


def _hash_table(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    return stored(docs.select(F.col(doc_id).alias("_nz_id"), text_sha256(text).alias("_nz_sha"),
                              F.monotonically_increasing_id().alias("_nz_row")), "exact-hashes")


def _bitmaps(hashes: DataFrame, max_bits: int) -> tuple[DataFrame, int]:
    bits = filter_bits(hashes.count(), max_bits)
    return stored(repeated_positions(hashes, bits), "exact-bloom"), bits


def _groups(maybe: DataFrame) -> DataFrame:
    """(hash, first row by id with nulls last, rows): partial sums on the map side.
    Written, so that a join with it has two plain shuffle sides and a hot hash can be split."""
    first = F.min(F.struct(F.col("_nz_id").isNull().alias("none"), F.col("_nz_id").alias("id"),
                           F.col("_nz_row").alias("row")))
    return stored(maybe.groupBy("_nz_sha").agg(first.alias("_nz_first"), F.count(F.lit(1)).alias("_nz_n")), "exact-groups")


def exact_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
                max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    hashes = _hash_table(docs, text, doc_id)
    tagged = flag_possible_repeats(hashes, *_bitmaps(hashes, max_bits))
    single = tagged.where(~F.col("_nz_maybe")).select(
        F.col("_nz_id").alias("doc_id"), F.col("_nz_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"),
        F.col("_nz_sha").alias("text_sha256"))
    maybe = tagged.where("_nz_maybe")
    multi = maybe.join(_groups(maybe), "_nz_sha").select(
        F.col("_nz_id").alias("doc_id"), F.col("_nz_first.id").alias("keep_id"),
        F.col("_nz_n").alias("group_size"),
        (F.col("_nz_row") == F.col("_nz_first.row")).alias("kept"),
        F.col("_nz_sha").alias("text_sha256"))
    return single.unionByName(multi)


def drop_exact_copies(docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
                      max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` without exact copies, all columns kept.

    Rows that cannot be repeated are not shuffled; of the others, the row with
    the group's smallest id is found on hashes alone and only its text moves on.
    """
    hashes = _hash_table(docs, text, doc_id)
    bitmaps, bits = _bitmaps(hashes, max_bits)
    maybe = flag_possible_repeats(hashes, bitmaps, bits).where("_nz_maybe")
    keep = _groups(maybe).select("_nz_sha", F.col("_nz_first.id").alias("_nz_keep"))
    full = flag_possible_repeats(docs.withColumn("_nz_sha", text_sha256(text)), bitmaps, bits)
    winners = full.where("_nz_maybe").join(
        keep.withColumnRenamed("_nz_sha", "_nz_sha2"),
        (F.col("_nz_sha") == F.col("_nz_sha2")) & F.col(doc_id).eqNullSafe(F.col("_nz_keep")), "left_semi",
    ).dropDuplicates(["_nz_sha"])
    return full.where(~F.col("_nz_maybe")).unionByName(winners).select(*[F.col(f"`{c}`") for c in docs.columns])


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS h
  FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY h) AS keep_id,
       count(*) OVER (PARTITION BY h) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY h) AS kept, h AS text_sha256
FROM d
"""
