"""Benchmark decontamination by q-gram lemma filtering.

A benchmark item of m characters counts as found where some stretch of a
document is within ``k`` edits of it (``budget``: 8 % of m).  By the q-gram
lemma such a stretch shares at least ``m - q + 1 - q * k`` q-grams with the
item, and their diagonals (text position minus item position) lie within k of
each other.  Diagonals are cut into overlapping bands of 2 (k + 1), so the
whole set falls into one band; shared q-grams are counted per band, bands that
reach the bound are kept, and each is verified by a banded alignment.  The
filter drops no stretch that the alignment would accept.

An item of two passages (2 ``PASSAGE``) or more also counts as found where one of
its passages is: stretches of ``PASSAGE`` characters, one every ``STRIDE``, each
with a budget of its own, through the same bands and alignment.  So any
``PASSAGE + STRIDE - 1`` characters of it are found, whatever stands before,
between or after.  Passages of an item that touch or overlap are one find, with
the most edits that one of them has; beside a find of the whole item they are
not reported.

Items shorter than ``MIN_ITEM`` characters are too short for a set of q-grams;
they count as found where they stand verbatim between word borders (one
automaton of all of them runs over the text).

Texts are compared lower-cased, every run of ASCII white space as one space, items
without white space at their ends, so a reflowed or re-indented copy costs no
edits; offsets are code points of the original text, end exclusive.

The items are the stated query set: they are shipped to the tasks in blocks of
``BLOCK_CHARS`` characters, and each block is run against all documents, so
neither the broadcast nor the index grows with the benchmark.  Documents are
never shuffled.

Edge cases: null and empty texts hold nothing; items that are null or only white
space are no evidence and match nothing; repeated items are reported each; overlapping finds of one item are one find, the best;
extra columns are kept by ``drop_contaminated``; an empty documents or
benchmark table gives no finds.  Long texts are scanned in pieces that overlap by
a gram, counted together.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD, table

Q = 10
EDIT_RATE = 0.08
MIN_ITEM = 20
#: Length of the passages of long items, and the characters from one to the next.
PASSAGE = 112
STRIDE = 28
#: Benchmark characters to a block, and document characters hashed at once.
BLOCK_CHARS = 4_000_000
SCAN_CHARS = 1 << 19
_TABLE_BITS = 22
_SEP = "\x00"


def spaced(text: str) -> str:
    """Lower case without a change of length; white space as spaces."""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c if len(c.lower()) != 1 else c.lower() for c in text)
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    return low


def normal(text: str) -> str:
    """``spaced`` with every run of spaces as one."""
    low = spaced(text)
    while "  " in low:
        low = low.replace("  ", " ")
    return low


def places(text: str) -> np.ndarray:
    """Offset in ``text`` of every character of ``normal(text)``."""
    space = _codes(spaced(text)) == 32
    return np.flatnonzero(~(space & np.concatenate(([False], space[:-1]))))


def budget(m: int, q: int = Q, rate: float = EDIT_RATE) -> int:
    """Edits allowed in an item of m characters: such that at least one q-gram must be shared."""
    return max(0, min(int(m * rate), (m - q) // q))


def passages(text: str) -> list[str]:
    """The overlapping passages of a long item, the last one at its end."""
    if len(text) < 2 * PASSAGE:
        return []
    last = len(text) - PASSAGE
    return [text[a:a + PASSAGE] for a in [*range(0, last, STRIDE), last]]


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def gram_hashes(codes: np.ndarray, q: int) -> np.ndarray:
    """Polynomial hash (mod 2^64) of every q-gram, by doubling."""
    if len(codes) < q:
        return np.empty(0, np.uint64)
    power = np.full(1, 0x9E3779B97F4A7C15, np.uint64)  # an array: its products wrap silently
    block = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    block ^= block >> np.uint64(32)
    size, out, done = 1, None, 0
    while True:
        if q & size:
            out = block if out is None else out[: len(block) - done] * power + block[done:]
            done += size
        if size * 2 > q:
            return out[: len(codes) - q + 1]
        n = len(block) - size
        block = block[:n] * power + block[size:size + n]
        power = power * power
        size *= 2


def short_items(items: list[tuple[int, str]]) -> ahocorasick.Automaton | None:
    """Automaton of short items, to (length, ids) of each."""
    if not items:
        return None
    ids: dict[str, list] = {}
    for i, t in items:
        ids.setdefault(t, []).append(i)
    out = ahocorasick.Automaton()
    for t, held in ids.items():
        out.add_word(t, (len(t), held))
    out.make_automaton()
    return out


def verbatim(short: ahocorasick.Automaton, text: str) -> Iterator[tuple[int, int, int]]:
    """(item id, start, end) of the short items that stand between word borders."""
    for last, (n, ids) in short.iter(text):
        a, b = last + 1 - n, last + 1
        cut = lambda i: 0 < i < len(text) and text[i - 1].isalnum() and text[i].isalnum()
        if not cut(a) and not cut(b):
            for i in ids:
                yield i, a, b


class Index:
    """Q-grams of a block of items: of the whole items, then of their passages.
    ``whole`` has the position of the item of each pattern.  Short items are in
    ``short``, an automaton to the ids of each."""

    def __init__(self, items: list[tuple[int, str]], q: int = Q, rate: float = EDIT_RATE):
        items = [(i, normal(t).strip(" ")) for i, t in items]
        self.short = short_items([(i, t) for i, t in items if 0 < len(t) < MIN_ITEM])
        items = [(i, t) for i, t in items if len(t) >= MIN_ITEM]
        self.ids = [i for i, _ in items]
        self.texts = [t for _, t in items]
        parts = [(i, p) for i, t in enumerate(self.texts) for p in passages(t)]
        self.whole = [*range(len(items)), *[i for i, _ in parts]]
        self.texts += [p for _, p in parts]
        self.codes = [_codes(t) for t in self.texts]
        self.q = q
        self.k = np.array([budget(len(t), q, rate) for t in self.texts], np.int64)
        self.bound = np.array([len(t) - q + 1 - q * int(k) for t, k in zip(self.texts, self.k)], np.int64)
        grams = [gram_hashes(c, q) for c in self.codes]
        h = np.concatenate(grams or [np.empty(0, np.uint64)])
        item = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        off = np.concatenate([np.arange(len(g)) for g in grams] or [np.empty(0, np.int64)])
        order = np.argsort(h, kind="stable")
        self.hash, first = np.unique(h[order], return_index=True)
        self.first = np.append(first, len(h)).astype(np.int64)
        self.item, self.off = item[order], off[order].astype(np.int64)
        self.seen = np.zeros(1 << _TABLE_BITS, bool)
        self.seen[self._slot(self.hash)] = True

    @staticmethod
    def _slot(h: np.ndarray) -> np.ndarray:
        return (h * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(64 - _TABLE_BITS)

    def shared(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position, index of the gram) where the text has a gram of the items."""
        h = gram_hashes(codes, self.q)
        at = np.flatnonzero(self.seen[self._slot(h)])
        if not len(at):
            return at, at
        i = np.minimum(np.searchsorted(self.hash, h[at]), len(self.hash) - 1)
        ok = self.hash[i] == h[at]
        return at[ok], i[ok]


def _align(pattern: np.ndarray, text: np.ndarray, low: int, high: int, anchored: bool) -> tuple[int, int]:
    """(edits, end): best alignment of the whole pattern to a stretch of
    ``text`` on diagonals low..high; the stretch starts anywhere, or at 0 if
    ``anchored``."""
    width = np.arange(low, high + 1)
    big = len(pattern) + len(text) + 1
    cost = np.where(width < 0, big, width if anchored else 0)
    padded = np.concatenate([np.full(max(0, -low), 2 ** 32 - 1, np.uint32), text,
                             np.full(len(pattern) + len(width), 2 ** 32 - 1, np.uint32)])
    shift = low + max(0, -low)
    for i, c in enumerate(pattern):
        step = cost + (padded[shift + i: shift + i + len(width)] != c)
        step[:-1] = np.minimum(step[:-1], cost[1:] + 1)  # item character missing in the text
        if i + 1 + low <= 0 and 0 <= -low - i - 1 < len(width):  # before the text: the item so far is missing
            step[-low - i - 1] = min(step[-low - i - 1], i + 1)
        cost = np.minimum.accumulate(step - width) + width  # extra characters in the text
        ends = i + 1 + width
        cost[(ends < 0) | (ends > len(text))] = big
    best = int(np.argmin(cost))
    return int(cost[best]), len(pattern) + int(width[best])


def verify(pattern: str, text: str, low: int, high: int, k: int) -> tuple[int, int, int] | None:
    """(start, end, edits) of the best stretch within k edits whose diagonals
    lie in low - k .. high + k, else None."""
    a, b = max(0, low - k), min(len(text), high + len(pattern) + k + 1)
    piece = text[a:b]
    at = piece.find(pattern)
    if at >= 0:
        return a + at, a + at + len(pattern), 0
    if k == 0:
        return None
    p, t = _codes(pattern), _codes(piece)
    edits, end = _align(p, t, low - k - a, high + k - a, False)
    if edits > k:
        return None
    _, length = _align(p[::-1], t[:end][::-1], -k, k, True)
    return a + end - length, a + end, edits


def _best(found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    out: list[tuple[int, int, int]] = []
    for f in sorted(found):
        if out and f[0] < out[-1][1]:
            out[-1] = min(out[-1], f, key=lambda x: (x[2], x[0]))
        else:
            out.append(f)
    return out


def _merged(found: list[tuple[int, int, int]], whole: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Finds of passages joined where they touch, without those that overlap a find of the whole item."""
    out: list[tuple[int, int, int]] = []
    for a, b, e in sorted(found):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]), max(e, out[-1][2]))
        else:
            out.append((a, b, e))
    return [f for f in out if not any(f[0] < b and a < f[1] for a, b, _ in whole)]


def _candidates(index: Index, pos: np.ndarray, gram: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(item, lowest, highest diagonal) of the bands that reach the bound, for
    the hits of one document."""
    n = index.first[gram + 1] - index.first[gram]
    at = np.repeat(index.first[gram] - np.cumsum(n) + n, n) + np.arange(n.sum())
    item, diag = index.item[at], np.repeat(pos, n) - index.off[at]
    step = index.k[item] + 1
    band = np.floor_divide(diag, step)
    key = (np.concatenate([item, item]) << 40) + np.concatenate([band, band - 1]) + (1 << 39)
    keys, count = np.unique(key, return_counts=True)
    items = keys >> 40
    ok = count >= index.bound[items]
    for i, b in zip(items[ok].tolist(), ((keys[ok] & ((1 << 40) - 1)) - (1 << 39)).tolist()):
        s = int(index.k[i]) + 1
        yield i, b * s, (b + 2) * s - 1


def scan(index: Index, texts: list[str]) -> list[list[dict]]:
    """Finds of each text."""
    out: list[list[dict]] = [[] for _ in texts]
    if not index.ids and not index.short:
        return out
    least = int(index.bound.min()) if index.ids else 0
    batch: list[int] = []
    size = 0

    def finds(i: int, text: str, found: dict[int, list]) -> None:
        """Adds (start, end, edits) of items by their ids, offsets turned to those of the original text."""
        if found:
            to = None if len(text) == len(texts[i]) else places(texts[i])
            at = (lambda a, b: (a, b)) if to is None else (lambda a, b: (int(to[a]), int(to[b - 1]) + 1 if b > a else int(to[a])))
            for item in sorted(found, key=lambda x: (x is None, x)):
                out[i] += [dict(zip(("item_id", "start", "end", "edits"), (item, *at(a, b), e))) for a, b, e in found[item]]

    def run() -> None:
        norm = [normal(texts[i]) for i in batch]
        if index.short:
            for i, t in zip(batch, norm):
                short: dict[int, list] = {}
                for item, a, b in verbatim(index.short, t):
                    short.setdefault(item, []).append((a, b, 0))
                finds(i, t, {item: _best(hits) for item, hits in short.items()})
        if not index.ids:
            return
        starts = np.cumsum([0] + [len(t) + 1 for t in norm])
        codes = _codes(_SEP.join(norm))
        parts = [index.shared(codes[a:a + SCAN_CHARS + index.q - 1]) for a in range(0, len(codes), SCAN_CHARS)]
        pos = np.concatenate([p + j * SCAN_CHARS for j, (p, _) in enumerate(parts)] or [np.empty(0, np.int64)])
        gram = np.concatenate([g for _, g in parts] or [np.empty(0, np.int64)])
        cut = np.searchsorted(pos, starts)
        for j, i in enumerate(batch):
            if cut[j + 1] - cut[j] < least:
                continue
            found: dict[int, list] = {}
            pieces: dict[int, list] = {}
            for item, low, high in _candidates(index, pos[cut[j]:cut[j + 1]] - starts[j], gram[cut[j]:cut[j + 1]]):
                owner = index.whole[item]
                if item >= len(index.ids) and any(a - index.k[item] <= low and high + len(index.texts[item]) <= b + index.k[item] + 1
                                                  for a, b, _ in found.get(owner, ())):
                    continue  # inside a find of the whole item
                hit = verify(index.texts[item], norm[j], low, high, int(index.k[item]))
                if hit:
                    (found if item < len(index.ids) else pieces).setdefault(owner, []).append(hit)
            for item in sorted({*found, *pieces}):
                whole = _best(found.get(item, []))
                finds(i, norm[j], {index.ids[item]: sorted(whole + _merged(pieces.get(item, []), whole))})

    for i, t in enumerate(texts):
        batch.append(i)
        size += len(t)
        if size >= SCAN_CHARS:
            run()
            batch, size = [], 0
    if batch:
        run()
    return out


FINDS = "array<struct<item_id:long,start:int,end:int,edits:int>>"
#: The index in use in a Python worker, by the name given to its block on the driver.
_INDEX: dict[str, Index] = {}


def benchmark_blocks(benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
                     block_chars: int = BLOCK_CHARS) -> Iterator[list[tuple[int, str]]]:
    """The usable items, block by block; only one block is on the driver."""
    items = benchmark.select(F.col(item_id).cast("long").alias("i"), F.col(text).alias("t")).where(
        F.regexp_like("t", F.lit(WORD)))
    # passages have their grams in the index as well
    grams = F.length("t") * F.when(F.length("t") < 2 * PASSAGE, 1).otherwise(1 + -(-PASSAGE // STRIDE))
    total = items.agg(F.sum(grams)).first()[0] or 0
    blocks = -(-total // block_chars)
    for b in range(blocks):
        mine = items.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == b)
        yield sorted(((r.i, r.t) for r in mine.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def finder(spark: SparkSession, items: list[tuple[int, str]], q: int = Q, rate: float = EDIT_RATE):
    """Column function: text to its finds in one block of items."""
    shared, key = spark.sparkContext.broadcast(items), uuid.uuid4().hex

    @F.pandas_udf(FINDS)
    def find(texts: pd.Series) -> pd.Series:
        if key not in _INDEX:
            _INDEX.clear()
            _INDEX[key] = Index(shared.value, q, rate)
        return pd.Series(scan(_INDEX[key], texts.fillna("").tolist()))

    return find


def contaminations(docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id",
                   block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, item_id, start, end, edits): every find."""
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    out = None
    for items in benchmark_blocks(benchmark, block_chars=block_chars):
        found = rows.select("doc_id", F.explode(finder(spark, items)("text")).alias("f")).select(
            "doc_id", "f.item_id", "f.start", "f.end", "f.edits")
        out = found if out is None else out.unionByName(found)
    if out is None:
        kind = rows.schema["doc_id"].dataType.simpleString()
        return spark.createDataFrame([], f"doc_id {kind}, item_id long, start int, end int, edits int")
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text",
                      block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` without the documents in which an item is found."""
    out = docs
    for items in benchmark_blocks(benchmark, block_chars=block_chars):
        found: Column = finder(docs.sparkSession, items)(F.col(text))
        out = out.where(F.size(found) == 0)
    return out


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
