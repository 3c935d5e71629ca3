"""Suffix-array deduplication with deep-shallow sorting.

Every byte covered by a ``LENGTH``-byte string that also starts anywhere else
(any document, or another place of the same one) is removed; strings are judged
on the input.

Suffixes are sorted at content-defined places only.  The anchor of a window of
``LENGTH`` bytes is its ``GRAM``-byte substring of least hash (leftmost of
ties): equal windows have equal anchors at equal offsets, and neighbouring
windows share theirs.  A segment is a run of window starts with one anchor, about
100 starts.

1.  Segments are counted by anchor hash (partial sums on the map side); only
    anchors met twice or more go on, as narrow rows without text.
2.  Segments of equal content (128-bit digest): all their windows repeat.
3.  Of every different content at one anchor, one representative is sent with its
    bytes to the task of that anchor.  There the suffixes starting at the anchors
    are sorted by deep-shallow sorting: multikey quicksort (8 bytes to a
    character) to a shallow depth, then a blind trie for each group that still
    shares a prefix: it stores branching positions only, so an insertion reads a
    path of single bytes and one long comparison.  The bytes before the anchors,
    reversed, are sorted in the same way.  With R the common bytes from two
    anchors on and L those before them, the windows that start L .. LENGTH - R
    bytes before the anchor are equal; merging the suffix array's intervals from
    the deepest, small into large, needs only the neighbours in the second order,
    so a group of m contents costs O(m log m) comparisons, not m^2.
4.  Anchors with more than ``limit`` different contents are not gathered: their
    windows are counted by a 128-bit digest of the window itself.
5.  Repeated starts go back to the texts, which are cut.  The texts moved for
    steps 3 and 5 are those that a bit filter of bounded size lets through.

Edge cases: null text counts as empty; texts shorter than ``LENGTH`` lose
nothing; equal rows are separate documents, so they remove each other; null
ids are documents like others; extra columns are ignored; an empty table gives
an empty result.  The working set is a batch of ``BATCH_BYTES``, one text, or
one anchor's ``limit`` contents; texts reach Python in Arrow batches of ``ARROW_BYTES``.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import sized_chunks, small_batches, stored, table, text_or_empty
from .op2_exact_dedup import bit_is_set, filter_bits

LENGTH = 400
GRAM = 200
#: Depth of the multikey quicksort, in characters of 8 bytes.
SHALLOW = 3
#: Different contents of one anchor gathered in a task.
LIMIT = 20_000
BATCH_BYTES = 1 << 18
MAX_FILTER_BITS = 1 << 30

_POS_BITS = 32
#: Byte values by rule, for the gram hash: eight bytes of the digest of the byte.
_BYTE = np.array([int.from_bytes(hashlib.blake2b(bytes([b]), digest_size=8).digest(), "big") for b in range(256)], np.uint64)
_BASE = 0x9E3779B97F4A7C15
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_BASE ** i and its inverse modulo 2^64, for i < n."""
    if not _POWERS or len(_POWERS[0]) < n:
        inverse = pow(_BASE, -1, 1 << 64)
        _POWERS[:] = [np.concatenate([np.ones(1, np.uint64), np.multiply.accumulate(np.full(n, b, np.uint64))]) for b in (_BASE, inverse)]
    return _POWERS[0][:n], _POWERS[1][:n]


def gram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k bytes from every position on: differences of a running sum."""
    n = len(data)
    power, inverse = _powers(n)
    run = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * power, out=run[1:])
    h = (run[k:] - run[:-k]) * inverse[: n - k + 1]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of x[i : i + w] for every i, by block prefix and suffix minima."""
    n = len(x) - w + 1
    padded = np.concatenate([x, np.full(-len(x) % w, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, w)
    before = np.minimum.accumulate(padded, axis=1).ravel()
    after = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[:n], before[w - 1:w - 1 + n])


def segments(texts: list[bytes], length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(text, first start, last start, anchor, anchor hash) of all segments; positions within the text."""
    texts_at = np.cumsum([0] + [len(t) for t in texts])
    data = np.frombuffer(b"".join(texts), np.uint8)
    if len(data) < length:
        return tuple(np.empty(0, np.int64) for _ in range(4)) + (np.empty(0, np.uint64),)
    h = gram_hashes(data, gram)
    key = (h >> np.uint64(_POS_BITS) << np.uint64(_POS_BITS)) | np.arange(len(h), dtype=np.uint64)
    anchor = (_sliding_min(key, length - gram + 1) & np.uint64((1 << _POS_BITS) - 1)).astype(np.int64)
    sizes = np.diff(texts_at)
    left = np.repeat(texts_at[1:], sizes)[: len(anchor)] - np.arange(len(anchor))  # bytes up to the text's end
    start = np.flatnonzero(left >= length)  # windows within one text
    anchor, doc = anchor[start], np.repeat(np.arange(len(texts)), sizes)[start]
    if not len(start):
        return tuple(np.empty(0, np.int64) for _ in range(4)) + (np.empty(0, np.uint64),)
    new = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1))))
    last = np.append(new[1:], len(start)) - 1
    base = texts_at[doc[new]]
    return doc[new], start[new] - base, start[last] - base, anchor[new] - base, h[anchor[new]]


# --- deep-shallow sorting ----------------------------------------------------

def common(x: bytes, y: bytes) -> int:
    """Length of the longest common prefix."""
    n = min(len(x), len(y))
    if x[:n] == y[:n]:
        return n
    low, high = 0, n  # x[:low] equal, x[:high] not
    while high - low > 1:
        mid = (low + high) // 2
        if x[low:mid] == y[low:mid]:
            low = mid
        else:
            high = mid
    return low


def multikey_quicksort(strings: list[bytes], ids: list[int], depth: int = SHALLOW) -> Iterator[list[int]]:
    """Groups of ``ids`` in order; strings of a group agree in the first
    ``depth`` characters of 8 bytes (or are at their end)."""
    stack = [(ids, 0)]
    while stack:
        part, d = stack.pop()
        if len(part) == 1 or d == depth:
            yield part
            continue
        chars = [strings[i][8 * d:8 * d + 8] for i in part]
        pivot = chars[len(chars) // 2]
        equal = [i for i, c in zip(part, chars) if c == pivot]
        if len(equal) < len(part):
            less, more = [i for i, c in zip(part, chars) if c < pivot], [i for i, c in zip(part, chars) if c > pivot]
            if more:
                stack.append((more, d))
            stack.append((equal, d + 1 if len(pivot) == 8 else depth))
            if less:
                stack.append((less, d))
        else:
            stack.append((equal, d + 1 if len(pivot) == 8 else depth))


def blind_trie(strings: list[bytes], ids: list[int]) -> tuple[list[int], list[int]]:
    """(order, lcp): ``ids`` sorted by their strings; lcp[i] belongs to
    order[i - 1] and order[i].  Inner nodes are [position, children by byte, -1 for
    the end]; leaves are lists of ids with equal strings."""
    root: list = [ids[0]]  # a leaf is a flat list of ids, an inner node a tuple
    for new in ids[1:]:
        s = strings[new]
        node = root
        while isinstance(node, tuple):  # any leaf below will do where no child fits
            child = node[1].get(s[node[0]] if node[0] < len(s) else -1)
            node = child if child is not None else next(iter(node[1].values()))
        other = strings[node[0]]
        n = common(s, other)
        if n == len(s) == len(other):
            node.append(new)
            continue
        at, way = root, None
        while isinstance(at, tuple) and at[0] < n:
            way = (at, s[at[0]])
            at = at[1][way[1]]
        if isinstance(at, tuple) and at[0] == n:
            at[1][s[n] if n < len(s) else -1] = [new]
            continue
        made = (n, {other[n] if n < len(other) else -1: at, s[n] if n < len(s) else -1: [new]})
        if way is None:
            root = made
        else:
            way[0][1][way[1]] = made
    order: list[int] = []
    lcp: list[int] = []
    stack: list = [(root, 0)]
    while stack:
        node, up = stack.pop()
        if isinstance(node, tuple):
            for j, c in sorted(enumerate(sorted(node[1])), reverse=True):
                stack.append((node[1][c], node[0] if j else up))
        else:
            n = len(strings[node[0]])
            order += node
            lcp += [up] + [n] * (len(node) - 1)
    return order, lcp


def deep_shallow(strings: list[bytes], depth: int = SHALLOW) -> tuple[list[int], list[int]]:
    """(suffix array, lcp) of ``strings``; lcp[0] is 0."""
    order: list[int] = []
    lcp: list[int] = []
    if not strings:
        return order, lcp
    for group in multikey_quicksort(strings, list(range(len(strings))), depth):
        o, n = (group, [0]) if len(group) == 1 else blind_trie(strings, group)
        n[0] = common(strings[order[-1]], strings[o[0]]) if order else 0
        order += o
        lcp += n
    return order, lcp


def repeated_starts(contents: list[tuple[bytes, int]], length: int = LENGTH) -> list[list[tuple[int, int]]]:
    """For the different contents (bytes, anchor in them) of one anchor: the
    (first, last) starts, counted from the content's, of windows that another one has."""
    right = [c[a:] for c, a in contents]
    left = [c[:a][::-1] for c, a in contents]
    order, lcp = deep_shallow(right)
    rank = [0] * len(contents)
    by_left, _ = deep_shallow(left)
    for r, i in enumerate(by_left):
        rank[i] = r
    out: list[list[tuple[int, int]]] = [[] for _ in contents]

    def pair(x: int, y: int, r: int) -> None:
        n = common(left[x], left[y])
        if n + r >= length:  # windows from n to length - r bytes before the anchor
            for i in (x, y):
                a = contents[i][1]
                out[i].append((a - n, a - length + r))

    group = [[rank[i]] for i in order]  # sorted ranks of a run of the suffix array
    home = list(range(len(order)))

    def find(i: int) -> int:
        while home[i] != i:
            home[i] = home[home[i]]
            i = home[i]
        return i

    for i in sorted(range(1, len(order)), key=lambda j: -lcp[j]):
        a, b = find(i - 1), find(i)
        if len(group[a]) < len(group[b]):
            a, b = b, a
        large, small = group[a], group[b]
        if lcp[i]:
            for x in small:
                j = bisect_left(large, x)
                for y in large[max(0, j - 1):j + 1]:
                    pair(by_left[x], by_left[y], lcp[i])
        if 16 * len(small) < len(large):
            for x in small:
                insort(large, x)
        else:
            group[a] = sorted(large + small)  # two sorted runs: a linear merge
        group[b], home[b] = [], a
    return out


# --- Spark -------------------------------------------------------------------

def content_key(text: Column) -> list[Column]:
    """Two longs that identify a text (64 + 32 hash bits and the length)."""
    k2 = F.shiftleft(F.hash(text).cast("long"), 32).bitwiseOR(F.octet_length(text).cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))
    return [F.xxhash64(text).alias("k1"), k2.alias("k2")]


def _encode(t: str) -> bytes:
    return t.encode("utf-8", "surrogatepass")


def segment_table(texts: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(h, d1, d2, k1, k2, first, last, off): the segments of all texts, with the
    digest of their content and the anchor's offset in it."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in sized_chunks(frames, "text", BATCH_BYTES):
            data = [_encode(t) for t in f["text"]]
            doc, first, last, anchor, h = segments(data, length, gram)
            digest = xxhash.xxh3_128_digest
            raw = b"".join([digest(data[d][a:b + length], c - a) for d, a, b, c in zip(doc.tolist(), first.tolist(), last.tolist(), anchor.tolist())])
            d = np.frombuffer(raw, np.int64).reshape(-1, 2)
            yield pd.DataFrame({"h": h.view(np.int64), "d1": d[:, 0], "d2": d[:, 1], "k1": f["k1"].to_numpy()[doc],
                                "k2": f["k2"].to_numpy()[doc], "first": first.astype(np.int32), "last": last.astype(np.int32),
                                "off": (anchor - first).astype(np.int32)})

    return texts.where(F.octet_length("text") >= length).mapInPandas(
        run, "h long, d1 long, d2 long, k1 long, k2 long, first int, last int, off int")


def _let_through(texts: DataFrame, keys: DataFrame, max_bits: int) -> DataFrame:
    """``texts`` with ``_in``, false only for rows whose k1 is not among ``keys``:
    a bit filter of at most ``max_bits`` (4 KB bitmaps, max_bits / 8 bytes to broadcast)."""
    bits = filter_bits(keys.count(), max_bits)
    at = lambda c: F.pmod(c, F.lit(bits)) + F.lit(1)
    maps = stored(keys.select(at(F.col("k1")).alias("p")).groupBy(F.bitmap_bucket_number("p").alias("_b")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("_m")), "suffix-filter")
    with_map = texts.withColumn("_b", F.bitmap_bucket_number(at(F.col("k1")))).join(F.broadcast(maps), "_b", "left")
    return with_map.withColumn("_in", bit_is_set(F.col("_m"), at(F.col("k1")))).drop("_b", "_m")


def repeated_ranges(texts: DataFrame, length: int = LENGTH, gram: int = GRAM, limit: int = LIMIT,
                    max_bits: int = MAX_FILTER_BITS) -> DataFrame:
    """(k1, k2, first, last): ranges of repeated window starts of the texts (k1, k2, text)."""
    every = stored(segment_table(texts, length, gram), "suffix-segments")
    # written, so that the join has two plain shuffle sides and a hot anchor can be split
    again = stored(every.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h"), "suffix-again")
    some = stored(every.join(again, "h"), "suffix-repeated")
    place = F.struct("k1", "k2", "first", "last", "off")
    contents = stored(some.groupBy("h", "d1", "d2").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("p")), "suffix-contents")
    whole = some.join(contents.where("n > 1").select("h", "d1", "d2"), ["h", "d1", "d2"]).select("k1", "k2", "first", "last")

    mixed = contents.groupBy("h").agg(F.count(F.lit(1)).alias("m"), F.min("n").alias("least")).where("m > 1 AND least = 1")
    wanted = stored(contents.join(mixed.select("h", (F.col("m") > limit).alias("hot")), "h").select(
        "h", "hot", (F.col("n") == 1).alias("single"), "p.*"), "suffix-wanted")
    lists = wanted.groupBy("k1", "k2").agg(F.collect_list(F.struct("h", "hot", "single", "first", "last", "off")).alias("parts"))
    # equal texts are one here: combined before they are moved
    source = (_let_through(texts, wanted.select("k1").distinct(), max_bits).where("_in")
              .groupBy("k1", "k2").agg(F.first("text").alias("text")))

    def fetch(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in sized_chunks(frames, "text", BATCH_BYTES):
            rows = []
            for k1, k2, t, parts in zip(f["k1"], f["k2"], f["text"], f["parts"]):
                data = _encode(t)
                for x in parts:
                    a, b = x["first"], x["last"]
                    if not x["hot"]:
                        rows.append((x["h"], x["single"], k1, k2, a, x["off"], data[a:b + length], 0, 0))
                        continue
                    raw = b"".join([xxhash.xxh3_128_digest(data[s:s + length]) for s in range(a, b + 1)])
                    rows += [(x["h"], x["single"], k1, k2, a + i, -1, None, *w)
                             for i, w in enumerate(np.frombuffer(raw, np.int64).reshape(-1, 2).tolist())]
            yield pd.DataFrame(rows, columns=["h", "single", "k1", "k2", "first", "off", "content", "w1", "w2"])

    parts = stored(source.join(lists, ["k1", "k2"]).mapInPandas(
        fetch, "h long, single boolean, k1 long, k2 long, first int, off int, content binary, w1 long, w2 long"), "suffix-parts")

    def match(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def done(rows: list[tuple]) -> list[tuple]:
            found: list[tuple] = []
            for r, ranges in zip(rows, repeated_starts([(bytes(r[6]), r[5]) for r in rows], length)):
                if r[1]:
                    found += [(r[2], r[3], r[4] + a, r[4] + b) for a, b in ranges]
            return found

        group: list[tuple] = []
        for f in frames:
            out: list[tuple] = []
            for r in f.itertuples(index=False, name=None):
                if group and group[-1][0] != r[0]:
                    out += done(group)
                    group = []
                group.append(r)
            yield pd.DataFrame(out, columns=["k1", "k2", "first", "last"])
        yield pd.DataFrame(done(group) if group else [], columns=["k1", "k2", "first", "last"])

    cold = parts.where("content IS NOT NULL").select("h", "single", "k1", "k2", "first", "off", "content").repartition("h").sortWithinPartitions(
        "h").mapInPandas(match, "k1 long, k2 long, first int, last int")
    hot = parts.where("content IS NULL")
    equal = hot.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    hot_starts = hot.where("single").join(equal, ["w1", "w2"]).select("k1", "k2", "first", F.col("first").alias("last"))
    return whole.unionByName(cold).unionByName(hot_starts)


def _cut(data: bytes, ranges: list[tuple[int, int]], length: int) -> tuple[list[tuple[int, int]], bytes]:
    """Maximal removed (start, end) runs and the bytes left."""
    runs: list[list[int]] = []
    for a, b in sorted(ranges):
        if runs and a <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], b + length)
        else:
            runs.append([a, b + length])
    kept, pos = [], 0
    for a, b in runs:
        kept.append(data[pos:a])
        pos = b
    return [(a, b) for a, b in runs], b"".join([*kept, data[pos:]])


def remove_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", length: int = LENGTH, gram: int = GRAM,
                   limit: int = LIMIT, max_bits: int = MAX_FILTER_BITS) -> DataFrame:
    """(doc_id, n_bytes, spans, kept): removed (start, end) byte runs and the
    bytes left of every row; ``kept`` is null where nothing is removed."""
    if not 0 < gram <= length:
        raise ValueError("a gram must fit into a window")
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_or_empty(text).alias("text"))
    rows = rows.select("doc_id", *content_key(F.col("text")), "text")
    ranges = stored(repeated_ranges(rows.select("k1", "k2", "text"), length, gram, limit, max_bits), "suffix-ranges")
    lists = ranges.groupBy("k1", "k2").agg(F.collect_set(F.struct("first", "last")).alias("ranges"))
    tagged = _let_through(rows, ranges.select("k1").distinct(), max_bits)

    @F.pandas_udf("spans array<struct<start:long,end:long>>, kept binary")
    def cut(texts: pd.Series, found: pd.Series) -> pd.DataFrame:
        out = []
        for t, r in zip(texts, found):
            spans, kept = _cut(_encode(t), [(x["first"], x["last"]) for x in r], length)
            out.append(([{"start": a, "end": b} for a, b in spans], kept))
        return pd.DataFrame(out, columns=["spans", "kept"])

    size = F.octet_length("text").cast("long").alias("n_bytes")
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    rest = tagged.where(~F.col("_in")).select("doc_id", size, none.alias("spans"), F.sha2("text", 256).alias("sha"), F.lit(None).cast("binary").alias("kept"))
    moved = tagged.where("_in").join(lists, ["k1", "k2"], "left").withColumn("ranges", F.coalesce(
        "ranges", F.array().cast("array<struct<first:int,last:int>>"))).withColumn("_c", cut("text", "ranges"))
    moved = moved.select("doc_id", size, F.col("_c.spans").alias("spans"), F.sha2(F.col("_c.kept"), 256).alias("sha"), F.col("_c.kept").alias("kept"))
    return rest.unionByName(moved)


def op5_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"])
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                      F.col("sha").alias("kept_sha256"))
