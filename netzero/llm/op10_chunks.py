"""Substring deduplication by content-defined chunking.

A gear rolling hash runs over the UTF-8 bytes of every text: 16 bits, shifted
left by one for each byte, so it depends on the last 16 bytes alone.  A chunk
ends where the top bits of the hash are zero, not before ``MIN_CHUNK`` bytes, and
never inside a character; where ``MAX_CHUNK`` bytes hold no such place, it ends
at the leftmost least hash among them.  Both depend on content, so an insertion
moves the chunk borders near it and no others, and texts that repeat a few words
are cut in step.  Chunks are equal when their 128-bit digests are.

Chunks of a digest are counted with map-side partial sums over the narrow
table (doc_id, digest); the document with the smallest doc_id owns a repeated
chunk and keeps its first occurrence.  Only repeated chunks are sent back to
their documents, which are chunked again: adjacent repeated chunks form runs.

A repeated passage seldom begins and ends at chunk borders.  So every owner
hands out the ``REACH`` bytes before and after its repeated chunks, every run asks
for those at its first and last chunk, and the run is extended byte by byte as
far as both agree.  Runs that then have ``MIN_RUN`` bytes are cut; shorter ones (stock
phrases, single lines) stay.  Every removed byte has an equal one at a smaller
(doc_id, position), so one copy of everything is kept.

Rows that a join would drop are mostly held back before its shuffle by a bit filter of
the other side's keys, of a bounded size; a full filter moves more rows and
changes nothing.

Edge cases: null and empty texts have no chunks and stay as they are; rows
with null doc_id are left alone and own nothing; rows repeating a doc_id are
versions of one document and do not cut each other; extra columns are kept by
``cut_documents``; empty tables give empty results.  A text is cut whole; the
chunk list of one document is the largest thing in a task.  Texts reach Python in
Arrow batches of ``ARROW_BYTES``, chunk lists as arrays of numbers, not of rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import sized_chunks, small_batches, stored, table
from .op2_exact_dedup import bit_is_set, filter_bits
from .op5_suffix import common

MIN_CHUNK = 24
MAX_CHUNK = 64
#: One position in 2^MASK_BITS ends a chunk.
MASK_BITS = 5
MIN_RUN = 100
#: Bytes around a repeated chunk by which a run can grow on either side.
REACH = 128
BATCH_CHARS = 1 << 22
MAX_FILTER_BITS = 1 << 30
SCAN_BYTES = 1 << 20

#: Gear values by rule: two bytes of the digest of the byte.
GEAR = np.array([int.from_bytes(hashlib.blake2b(bytes([b]), digest_size=2).digest(), "big") for b in range(256)], np.uint16)


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """Hash after every byte; inside a character the greatest value, which ends no chunk."""
    out = np.empty(len(data), np.uint16)
    for a in range(0, len(data), SCAN_BYTES):
        lead = min(a, 15)
        x = data[a - lead:a + SCAN_BYTES]
        h = GEAR[x]
        for s in (1, 2, 4, 8):  # h over s bytes -> over 2 s bytes
            more = h.copy()
            more[s:] += h[:-s] << np.uint16(s)
            h = more
        out[a:a + SCAN_BYTES] = h[lead:]
    out[:-1][(data[1:] & 0xC0) == 0x80] = 0xFFFF
    return out


def chunk_ends(data: bytes) -> list[int]:
    """End of every chunk of ``data``."""
    n = len(data)
    h = gear_hashes(np.frombuffer(data, np.uint8))
    marks = (np.flatnonzero(h >> np.uint16(16 - MASK_BITS) == 0) + 1).tolist()
    ends, pos, i, last = [], 0, 0, len(marks)
    while n - pos > MIN_CHUNK:
        while i < last and marks[i] < pos + MIN_CHUNK:
            i += 1
        cut = marks[i] if i < last else n
        if cut - pos > MAX_CHUNK:
            cut = pos + MIN_CHUNK + int(h[pos + MIN_CHUNK - 1:pos + MAX_CHUNK].argmin())
        ends.append(cut)
        pos = cut
    if pos < n:
        ends.append(n)
    return ends


def chunks(data: bytes) -> tuple[list[int], np.ndarray]:
    """Ends and digests (n x 2 signed longs) of the chunks."""
    ends = chunk_ends(data)
    d = xxhash.xxh3_128_digest
    raw = b"".join([d(data[a:b]) for a, b in zip([0, *ends], ends)])
    return ends, np.frombuffer(raw, np.int64).reshape(-1, 2)


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def chunk_table(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, d1, d2, n): the distinct chunks of every row and how often it has them."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in sized_chunks(frames, "text", BATCH_CHARS):
            ids, parts, counts = [], [], []
            for i, t in zip(f["doc_id"], f["text"]):
                _, d = chunks(_bytes(t))
                if len(d):
                    u, n = np.unique(d, axis=0, return_counts=True) if len(d) > 1 else (d, np.ones(1, np.int64))
                    ids.append(np.full(len(u), i, object))
                    parts.append(u)
                    counts.append(n)
            if parts:
                d = np.concatenate(parts)
                yield pd.DataFrame({"doc_id": np.concatenate(ids), "d1": d[:, 0], "d2": d[:, 1],
                                    "n": np.concatenate(counts).astype(np.int32)})

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).where("doc_id IS NOT NULL")
    return rows.mapInPandas(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, d1 long, d2 long, n int")


def let_through(rows: DataFrame, key: Column, keys: DataFrame, max_bits: int = MAX_FILTER_BITS) -> DataFrame:
    """``rows`` without most of those whose ``key`` (a long) is not in the one
    column of ``keys``, by a broadcast of at most ``max_bits`` / 8 bytes."""
    bits = filter_bits(keys.count(), max_bits)
    at = lambda c: F.pmod(c, F.lit(bits)) + F.lit(1)
    place = at(F.col(keys.columns[0]))
    maps = stored(keys.select(place.alias("p")).groupBy(F.bitmap_bucket_number("p").alias("_nz_b")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("_nz_m")), "chunks-filter")
    found = rows.withColumn("_nz_b", F.bitmap_bucket_number(at(key))).join(F.broadcast(maps), "_nz_b")
    return found.where(bit_is_set(F.col("_nz_m"), at(key))).drop("_nz_b", "_nz_m")


def repeated_chunks(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, d1, d2, owner): the chunks of every document that occur more
    than once, with the document that owns them."""
    each = stored(chunk_table(docs, text, doc_id), "chunks")
    # written, so that the join has two plain shuffle sides and a hot chunk can be split
    again = stored(each.groupBy("d1", "d2").agg(F.sum("n").alias("n"), F.min("doc_id").alias("owner"))
                   .where("n > 1").drop("n"), "chunks-again")
    return let_through(each.drop("n"), F.col("d1"), again.select("d1")).join(again, ["d1", "d2"])


def runs_of(data: bytes, owners: dict[tuple[int, int], object], doc_id) -> tuple[list[tuple], list[tuple]]:
    """(runs, own) of one document.

    runs: (start, end, owner of the first chunk, its digest, bytes before, digest
    of the last chunk, bytes after) of each run of adjacent chunks that another
    place owns.  own: (digest, bytes before, bytes after) of the repeated chunks that this
    document owns, at their first place."""
    ends, digests = chunks(data)
    runs: list[list] = []
    own, first, start = [], {}, 0
    for end, key in zip(ends, map(tuple, digests.tolist())):
        owner = owners.get(key)
        if owner is not None:
            if owner == doc_id and key not in first:
                first[key] = end
                own.append((key, data[max(0, start - REACH):start], data[end:end + REACH]))
            elif runs and runs[-1][1] == start:
                runs[-1][1], runs[-1][5] = end, key
            else:
                low = max(start - REACH, first.get(key, 0))  # not into the copy that stays
                runs.append([start, end, owner, key, data[low:start], key])
        start = end
    return [(*r, data[r[1]:r[1] + REACH + 1]) for r in runs], own


def common_after(mine: bytes, theirs: bytes) -> int:
    """Equal first bytes, whole characters of ``mine``, which has one byte more than counts."""
    n = min(common(mine, theirs), REACH)
    while n and n < len(mine) and mine[n] & 0xC0 == 0x80:
        n -= 1
    return n


def common_before(mine: bytes, theirs: bytes) -> int:
    """Equal last bytes, whole characters."""
    n = common(mine[::-1], theirs[::-1])
    while n and mine[len(mine) - n] & 0xC0 == 0x80:
        n -= 1
    return n


EDGES = ("start long, end long, k1 long, b1 long, b2 long, before binary, a1 long, a2 long, after binary")


def repeated_spans(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, k1, spans): the spans to cut of every text (hash ``k1``) that has any."""
    small_batches(docs.sparkSession)
    kind = docs.schema[doc_id].dataType.simpleString()
    found = stored(repeated_chunks(docs, text, doc_id).groupBy(F.col("doc_id").alias("_nz_id")).agg(
        F.collect_list(F.struct("d1", "d2", "owner")).alias("chunks")), "chunks-lists")
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = let_through(rows.withColumn("k1", F.xxhash64("text")), F.xxhash64("doc_id"), found.select(F.xxhash64("_nz_id").alias("k")))
    rows = rows.join(found, F.col("doc_id") == F.col("_nz_id")).drop("_nz_id")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in sized_chunks(frames, "text", BATCH_CHARS):
            out = []
            for i, k, t, d1, d2, o in zip(f["doc_id"], f["k1"], f["text"], f["d1"], f["d2"], f["owner"]):
                runs, own = runs_of(_bytes(t), dict(zip(zip(d1.tolist(), d2.tolist()), o.tolist())), i)
                out += [(i, o, a, b, k, *d, x, *e, y) for a, b, o, d, x, e, y in runs]
                out += [(i, None, None, None, k, *d, x, *d, y) for d, x, y in own]
            names = ["doc_id", "owner", "start", "end", "k1", "b1", "b2", "before", "a1", "a2", "after"]
            done = pd.DataFrame(out, columns=names)
            yield done.astype({"start": "Int64", "end": "Int64"})

    edges = stored(rows.select("doc_id", "k1", "text", "chunks.d1", "chunks.d2", "chunks.owner").mapInPandas(run, f"doc_id {kind}, owner {kind}, {EDGES}"), "chunks-edges")
    own = edges.where("start IS NULL")
    # only of chunks at which a run begins or ends
    runs = edges.where("start IS NOT NULL")
    asked = runs.select("b1").unionByName(runs.select(F.col("a1").alias("b1"))).distinct()
    own = let_through(own, F.col("b1"), asked)
    # versions of one document may own a chunk each: one row for every digest
    own = own.groupBy(F.col("b1").alias("d1"), F.col("b2").alias("d2")).agg(F.min(F.struct("before", "after")).alias("o"))
    own = stored(own.select("d1", "d2", "o.before", "o.after"), "chunks-own")

    @F.pandas_udf("long")
    def grow_before(mine: pd.Series, theirs: pd.Series) -> pd.Series:
        return pd.Series([common_before(bytes(a), bytes(b)) for a, b in zip(mine, theirs)], dtype="int64")

    @F.pandas_udf("long")
    def grow_after(mine: pd.Series, theirs: pd.Series) -> pd.Series:
        return pd.Series([common_after(bytes(a), bytes(b)) for a, b in zip(mine, theirs)], dtype="int64")

    left = own.select(F.col("d1").alias("b1"), F.col("d2").alias("b2"), F.col("before").alias("_b"))
    runs = runs.join(left, ["b1", "b2"]).withColumn("start", F.col("start") - grow_before("before", "_b"))
    runs = runs.select("doc_id", "k1", "owner", "start", "end", "a1", "a2", "after")
    right = own.select(F.col("d1").alias("a1"), F.col("d2").alias("a2"), F.col("after").alias("_a"))
    runs = runs.join(right, ["a1", "a2"]).withColumn("end", F.col("end") + grow_after("after", "_a"))
    runs = runs.where(F.col("end") - F.col("start") >= MIN_RUN)
    return runs.groupBy("doc_id", "k1").agg(F.array_sort(F.collect_set(F.struct("start", "end", "owner"))).alias("spans"))


def cut(data: bytes, spans: list[tuple[int, int, object]]) -> tuple[list[tuple[int, int, object]], bytes]:
    """Maximal removed (start, end, owner of its first part) runs and the bytes left."""
    runs: list[list] = []
    for a, b, o in sorted(spans, key=lambda s: s[:2]):
        if runs and a <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], b)
        else:
            runs.append([a, b, o])
    kept, pos = [], 0
    for a, b, _ in runs:
        kept.append(data[pos:a])
        pos = b
    return [tuple(r) for r in runs], b"".join([*kept, data[pos:]])


_ADDED = ("n_bytes", "n_removed", "spans")


def cut_documents(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The documents that lose text: all columns, ``text`` after the cut, and
    ``n_bytes``, ``n_removed`` and ``spans`` of (start, end, first_doc_id), byte
    offsets of the original text; columns of those names are replaced."""
    names, kind = [c for c in docs.columns if c not in _ADDED], docs.schema[doc_id].dataType.simpleString()
    # written, so that the join has two plain shuffle sides
    found = stored(repeated_spans(docs, text, doc_id).select(F.col("doc_id").alias("_nz_id"), F.col("k1").alias("_nz_k"), F.col("spans").alias("_nz_spans")), "chunks-spans")
    rows = docs.select(F.col(doc_id).alias("_nz_key"), F.coalesce(F.col(text), F.lit("")).alias("_nz_text"),
                       F.struct(*[F.col(f"`{c}`") for c in names if c != text]).alias("_nz_rest"))
    rows = let_through(rows, F.xxhash64("_nz_text"), found.select("_nz_k"))
    rows = rows.join(found, (F.col("_nz_key") == F.col("_nz_id")) & (F.xxhash64("_nz_text") == F.col("_nz_k")))
    spans = f"array<struct<start:long,end:long,first_doc_id:{kind}>>"

    @F.pandas_udf(f"text string, n_bytes long, n_removed long, spans {spans}")
    def run(texts: pd.Series, lists: pd.Series) -> pd.DataFrame:
        out = []
        for t, found in zip(texts, lists):
            data = _bytes(t)
            gone, left = cut(data, [(s["start"], s["end"], s["owner"]) for s in found])
            out.append((left.decode("utf-8", "replace"), len(data), len(data) - len(left),
                        [{"start": a, "end": b, "first_doc_id": o} for a, b, o in gone]))
        return pd.DataFrame(out, columns=["text", "n_bytes", "n_removed", "spans"])

    done = rows.select("_nz_rest", run("_nz_text", "_nz_spans").alias("_nz_cut"))
    return done.select(*[F.col("_nz_cut.text").alias(c) if c == text else F.col(f"_nz_rest.`{c}`") for c in names],
                       "_nz_cut.n_bytes", "_nz_cut.n_removed", "_nz_cut.spans")


def op10_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return cut_documents(docs).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
        F.array_sort(F.array_distinct("spans.first_doc_id")).alias("first_doc_ids"), "spans", "text")
