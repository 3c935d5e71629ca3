"""SimHash near-duplicates by anchor-point covering.

Fingerprint: lower-cased (A-Z) words, shingles of ``SHINGLE`` words, XXH64
(seed 42) of each; a bit is 1 if set in over half of the hashes.

Linking: two fingerprints link at ``distance`` or fewer differing bits.  The 64
bits are two halves of 32; of two linked fingerprints one half differs in at
most ``distance // 2`` bits.  The anchors of a half are the words of a covering
code: the perfect [31, 26] Hamming code on 31 bits, the last bit free, 2^27
anchors with covering radius 1.  Every fingerprint is replicated to each anchor
within covering radius + the half's threshold (at most 17 a half for distance 3):
the anchor nearest to one fingerprint is then within reach of the other, so
every linked pair meets at an anchor, and fingerprints are compared there on
all 64 bits.  Equal fingerprints are one node before that, so copies cost
nothing, and an anchor emits a spanning forest of its links, not all pairs.

An anchor met by more than ``limit`` fingerprints is split by the bytes of the
other half (at most ``distance`` = 3 of its 4 bytes can differ, so linked pairs
still meet at one of them) and compared in blocks; nothing is dropped.

Components: alternating large-star / small-star rounds, each written to the
shared folder; nothing but a checksum comes to the driver.

Edge cases: null text counts as empty; texts without words have fingerprint
zero and link like any other; fewer words than a shingle: one shingle of all
words.  Long texts are hashed in blocks of words.  ``doc_id`` null is ignored as
a component id (null only if a component has no other).  Rows repeating an id
are rows of one document.  An empty table gives an empty result; extra columns
are ignored by ``simhash_components`` and kept by ``drop_near_copies``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import sized_chunks, stored, table

SHINGLE = 3
DISTANCE = 3
#: Hashes turned to bits at once, and characters of a batch.
BLOCK = 1 << 15
BATCH_CHARS = 1 << 22
#: Fingerprints compared at an anchor before it is split.
LIMIT = 20_000
#: Runs up to this size are compared by shifting, larger ones by growing components.
SMALL_RUN = 24


# --- fingerprints ------------------------------------------------------------

def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of one text, unsigned."""
    data = (text or "").encode("utf-8", "surrogatepass").lower()  # bytes: A-Z only
    words = data.split()  # bytes: exactly \x20 and \x09-\x0D
    if not words:
        return 0
    k = min(shingle, len(words))
    total, ones = len(words) - k + 1, np.zeros(64, np.int64)
    for at in range(0, total, BLOCK):
        part = words[at:min(at + BLOCK, total) + k - 1]
        line = b" ".join(part)
        ends = np.cumsum(np.fromiter(map(len, part), np.int64, len(part)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))[: len(part) - k + 1].tolist()
        h = xxhash.xxh64_intdigest
        hashes = np.array([h(line[a:b], 42) for a, b in zip(starts, ends[k - 1:].tolist())], np.uint64)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > total).view(np.uint64)[0])


def fingerprints(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): one row per row of ``docs``, ``fp`` as signed long."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in sized_chunks(frames, "text", BATCH_CHARS):
            fps = np.fromiter((fingerprint(t, shingle) for t in f["text"]), np.uint64, len(f))
            yield pd.DataFrame({"doc_id": f["doc_id"], "fp": fps.view(np.int64)})

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInPandas(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fp long")


# --- anchors -----------------------------------------------------------------

def anchors(half: np.ndarray, radius: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """[(rows, anchors)] of all code words within ``radius`` of each 32-bit
    ``half``: a code word has syndrome 0 on bits 0-30 (the xor of the positions
    1-31 of its set bits); bit 31 is free."""
    syndrome = np.zeros(len(half), np.uint64)
    for i in range(31):
        syndrome ^= ((half >> np.uint64(i)) & np.uint64(1)) * np.uint64(i + 1)
    rows, free, out = np.arange(len(half)), np.uint64(1 << 31), []
    flip = lambda pos: np.where(pos > 0, np.uint64(1) << (pos - np.uint64(1)) % np.uint64(64), np.uint64(0))
    near, cost = half ^ flip(syndrome), (syndrome > 0).astype(int)
    out.append((rows[cost <= radius], near[cost <= radius]))
    ok = cost + 1 <= radius
    out.append((rows[ok], near[ok] ^ free))
    if radius >= 2:  # two flips whose positions xor to the syndrome
        for a in range(1, 32):
            b = syndrome ^ np.uint64(a)
            ok = (syndrome > 0) & (b > a)
            out.append((rows[ok], half[ok] ^ flip(np.full(ok.sum(), a, np.uint64)) ^ flip(b[ok])))
    return out


def replicate(nodes: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(anchor, fp) of every fingerprint at every anchor within reach."""
    if not 0 <= distance <= 3:
        raise ValueError("distance must be 0 to 3: beyond, a half needs anchors at a larger radius")
    radius = 1 + distance // 2

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            fp = f["fp"].to_numpy(np.int64).view(np.uint64)
            for side, half in enumerate((fp & np.uint64(0xFFFFFFFF), fp >> np.uint64(32))):
                found = anchors(half, radius)
                rows = np.concatenate([r for r, _ in found])
                at = np.concatenate([a for _, a in found]) | np.uint64(side << 32)
                yield pd.DataFrame({"anchor": at.view(np.int64), "fp": fp[rows].view(np.int64)})

    return nodes.select("fp").mapInPandas(run, "anchor long, fp long")


def _forest(fp: np.ndarray, distance: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Spanning forest of the links among distinct ``fp``: components are grown
    from a frontier over the rest, in blocks, so each link is looked at once
    and memory follows the number of fingerprints."""
    out, rest = [], fp
    while len(rest):
        frontier, rest = rest[:1], rest[1:]
        while len(frontier) and len(rest):
            grown = []
            for x in frontier:
                hit = np.bitwise_count(rest ^ x) <= distance
                if hit.any():
                    new = rest[hit]
                    out.append((np.full(len(new), x), new))
                    grown.append(new)
                    rest = rest[~hit]
                    if not len(rest):
                        break
            frontier = np.concatenate(grown) if grown else rest[:0]
    return out


def _links_of_runs(key: np.ndarray, fp: np.ndarray, distance: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links among equal adjacent ``key``: by shifting in short runs, as a forest in long ones."""
    cut = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1], [True])))
    length = np.diff(cut)
    out = []
    short = np.repeat(length <= SMALL_RUN, length)
    k, f = key[short], fp[short]
    for d in range(1, SMALL_RUN):
        same = k[d:] == k[:-d]
        if not same.any():
            break
        a, b = f[d:][same], f[:-d][same]
        ok = (np.bitwise_count(a ^ b) <= distance) & (a != b)
        out.append((a[ok], b[ok]))
    for i in np.flatnonzero(length > SMALL_RUN):
        out += _forest(np.unique(fp[cut[i]:cut[i + 1]]), distance)
    return out


def compare(replicas: DataFrame, keys: list[str], distance: int, limit: int | None) -> DataFrame:
    """Links (a, b) found at each group of ``keys``, b null for the rows (a = fp)
    of groups over ``limit``, which the caller splits.  Groups arrive as sorted
    runs; only one run is held, and with a limit no more than ``limit`` rows."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        left_key, left_fp, over = np.empty(0, np.int64), np.empty(0, np.uint64), None

        def made(pairs, spill_key=None, spill=None):
            a = np.concatenate([x for x, _ in pairs] or [left_fp[:0]])
            b = np.concatenate([y for _, y in pairs] or [left_fp[:0]])
            both = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0) if len(a) else np.empty((0, 2), np.uint64)
            res = pd.DataFrame({"a": both[:, 0].view(np.int64) if len(both) else np.empty(0, np.int64),
                                "b": pd.array(np.ascontiguousarray(both[:, 1]).view(np.int64), "Int64"),
                                "anchor": pd.array([None] * len(both), "Int64")})
            if spill is not None and len(spill):
                more = pd.DataFrame({"a": spill.view(np.int64), "b": pd.array([None] * len(spill), "Int64"),
                                     "anchor": pd.array(spill_key, "Int64")})
                res = pd.concat([res, more], ignore_index=True)
            return res

        for f in frames:
            if f.empty:
                continue
            key, fp = f["key"].to_numpy(np.int64), f["fp"].to_numpy(np.int64).view(np.uint64)
            if over is not None:  # the rest of a group already over the limit
                n = int(np.searchsorted(key != over, True)) if (key != over).any() else len(key)
                yield made([], key[:n], fp[:n])
                key, fp = key[n:], fp[n:]
                if not len(key):
                    continue
                over = None
            key, fp = np.concatenate([left_key, key]), np.concatenate([left_fp, fp])
            last = int(np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))[-1])
            done_key, done_fp, left_key, left_fp = key[:last], fp[:last], key[last:], fp[last:]
            if limit and len(left_key) > limit:
                yield made([], left_key, left_fp)
                over, left_key, left_fp = int(left_key[0]), left_key[:0], left_fp[:0]
            if limit and len(done_key):
                start = np.flatnonzero(np.concatenate(([True], done_key[1:] != done_key[:-1])))
                size = np.diff(np.append(start, len(done_key)))
                big = np.repeat(size > limit, size)
                if big.any():
                    yield made([], done_key[big], done_fp[big])
                    done_key, done_fp = done_key[~big], done_fp[~big]
            if len(done_key):
                yield made(_links_of_runs(done_key, done_fp, distance))
        if len(left_key):
            yield made(_links_of_runs(left_key, left_fp, distance))

    key = F.col(keys[0]) if len(keys) == 1 else F.xxhash64(*keys)
    rows = replicas.select(key.alias("key"), "fp").repartition("key").sortWithinPartitions("key")
    return rows.mapInPandas(run, "a long, b long, anchor long")


def links(nodes: DataFrame, distance: int = DISTANCE, limit: int = LIMIT) -> DataFrame:
    """Links (a, b), a < b as unsigned, whose components are those of all links."""
    first = stored(compare(replicate(nodes, distance), ["anchor"], distance, limit), "simhash-links")
    over = first.where("b IS NULL").select("anchor", F.col("a").alias("fp"))
    found = first.where("b IS NOT NULL").select("a", "b")
    if not over.isEmpty():
        other = F.when(F.shiftright("anchor", 32) == 0, F.shiftrightunsigned("fp", 32)).otherwise(
            F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)))
        split = over.withColumn("_h", other).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(3)))).withColumn(
            "byte", F.expr("shiftright(_h, 8 * part)").bitwiseAND(F.lit(255)))
        more = compare(split, ["anchor", "part", "byte"], distance, None)
        found = found.unionByName(more.select("a", "b"))
    return found.distinct()


# --- components --------------------------------------------------------------

def _checksum(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
    return tuple(r)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with a link; root is the smallest node reachable.

    Large-star links each node's larger neighbours to its smallest one,
    small-star the smaller ones; rounds repeat until nothing changes.
    """
    e = stored(edges.select(F.col("a").alias("u"), F.col("b").alias("v")), "cc-edges")
    before = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        large = stored(large, "cc-large")
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        e = stored(down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                   .unionByName(low.select("u", F.col("m").alias("v"))).where("u != v").distinct(), "cc-edges")
        now = _checksum(e)
        if now == before:
            return e.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
        before = now


def simhash_components(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = SHINGLE,
                       distance: int = DISTANCE, limit: int = LIMIT) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row."""
    fps = stored(fingerprints(docs, text, doc_id, shingle), "simhash-fps")
    nodes = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-nodes")
    roots = components(links(nodes, distance, limit)).withColumnRenamed("node", "fp")
    rooted = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    labels = rooted.join(least, "root").select("fp", "component_id")
    return fps.join(labels, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_copies(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = SHINGLE,
                     distance: int = DISTANCE) -> DataFrame:
    """``docs`` with one document of each component, that of the smallest id.
    Rows without an id are kept; rows repeating an id stay or go together."""
    found = simhash_components(docs, text, doc_id, shingle, distance).where(F.col("doc_id").isNotNull())
    gone = found.groupBy("doc_id").agg(F.min(F.col("doc_id") != F.col("component_id")).alias("gone")).where("gone")
    gone = gone.select(F.col("doc_id").alias("_nz_gone"))
    return docs.join(gone, F.col(doc_id) == F.col("_nz_gone"), "left_anti")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))
