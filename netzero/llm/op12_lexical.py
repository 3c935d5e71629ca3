"""Ranked lexical search with per-term geometric blocking.

A document's score for an item sums, over the item's terms, the term's weight
times its saturated frequency in the document.  Texts are read once: every
document becomes a sparse vector over the items' terms, written with its length.
Counts of documents, terms and postings come from Spark aggregates over all of them.

Search is sharded by documents, a shard being up to ``SHARD_DOCS`` vectors of one
task, so a term held by most documents is spread over all tasks.  In a shard the
posting list of a term is clustered by document similarity (representatives of
the list, cosine of sign projections) into blocks of about ``BLOCK`` postings, and
every block stores the coordinatewise maximum of its documents' vectors.  The
maximum times the item bounds the score of every document of the block, exactly
and without pruned coordinates, so a block is passed over only if its bound stays
below the item's threshold; otherwise its documents are scored in full.

Thresholds start with the best ``top`` scores among the ``SEEDS`` documents with
most different terms and rise with every document found.  Lists are opened
rarest first; the most frequent terms of an item whose greatest values together
stay below its threshold are not opened, since documents with no other term
cannot reach it.  Lists are built when they are opened and dropped afterwards.
Tasks hand on ``top`` rows per item.  Which documents are scored depends on the
clusters, what is returned does not.

Weights and scores are integers; they are added as doubles while sums stay below
2^53, as 64-bit integers beyond.  Items are taken in blocks of ``BLOCK_CHARS``
characters, each searched over all documents, so no table grows with the items.

Edge cases: null texts have no terms; items without terms, or whose terms no
document holds, have no rows; a text held by several items is searched once, and
every row of ``items`` gets its own result; null doc_ids rank after others of equal
score; rows repeating a doc_id are ranked as rows of their own; long texts count
whole; empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources import scratch_path
from .common import sized_chunks, stored, table

TOP = 20
BATCH_CHARS = 1 << 22
#: Characters of items searched at once.
BLOCK_CHARS = 200_000
SEEDS = 4096
#: Documents and vector entries of a shard; postings of a block; sides of the projection.
SHARD_DOCS = 8192
SHARD_ENTRIES = 1_500_000
BLOCK = 32
SKETCH = 32
#: Items bounded together, and parts in which an item's documents are first ranked.
ITEMS = 128
PARTS = 64

_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms(text: str | None) -> list[bytes]:
    """Maximal runs of ASCII letters, digits and code points from 128 on; A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Saturated frequency, rounded down."""
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def length_factor(n: int, n_docs: int, n_terms: int) -> int:
    return 75 + (25 * n * n_docs) // n_terms


# --- vectors -----------------------------------------------------------------

def forward(docs: DataFrame, vocabulary: dict[bytes, int], text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, no_id, n, size, at, tf) of every document with a term: its
    number of terms, and number and frequency of those in ``vocabulary``."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = shared.value
        for f in sized_chunks(frames, "text", BATCH_CHARS):
            n, at, tf = [], [], []
            for t in f["text"]:
                found = terms(t)
                n.append(len(found))
                a, c = np.unique(np.array([i for i in map(known.get, found) if i is not None], np.int32), return_counts=True)
                at.append(a)
                tf.append(c)
            out = pd.DataFrame({"doc_id": f["doc_id"].to_numpy(), "no_id": f["no_id"].to_numpy(), "n": n,
                                "size": [len(a) for a in at], "at": at, "tf": tf})
            yield out[out["n"] > 0]

    rows = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(0)).alias("doc_id"), F.col(doc_id).isNull().alias("no_id"),
                       F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInPandas(run, "doc_id long, no_id boolean, n long, size int, at array<int>, tf array<long>")


class Shard:
    """Vectors of some documents as rows of (term, value), and the posting lists of their terms."""

    def __init__(self, doc_id: np.ndarray, no_id: np.ndarray, length: np.ndarray, at: np.ndarray, value: np.ndarray, n_terms: int):
        self.doc_id, self.no_id, self.at, self.value = doc_id, no_id, at, value
        self.ptr = np.concatenate(([0], np.cumsum(length)))
        order = np.argsort(at, kind="stable")
        self.posting = np.repeat(np.arange(len(length), dtype=np.int32), length)[order]
        self.order = order
        self.list_ptr = np.searchsorted(at[order], np.arange(n_terms + 1))
        self.top = np.zeros(n_terms, value.dtype)
        np.maximum.at(self.top, at, value)
        sides = np.random.default_rng(1).choice(np.array([-1, 1], np.float32), (n_terms, SKETCH))
        self.sketch = np.zeros((len(length), SKETCH), np.float32)
        if len(at):
            rows = np.flatnonzero(length)
            for i in range(SKETCH):
                self.sketch[rows, i] = np.add.reduceat(value * sides[at, i], self.ptr[rows])
            self.sketch /= np.maximum(np.sqrt((self.sketch ** 2).sum(1, keepdims=True)), 1e-30)

    def docs_of(self, term: int) -> np.ndarray:
        return self.posting[self.list_ptr[term]:self.list_ptr[term + 1]]

    def all_scores(self, item: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """Scores of all documents, list by list."""
        out = np.zeros(len(self.doc_id), self.value.dtype)
        for t, c in zip(*item):
            a, b = self.list_ptr[t], self.list_ptr[t + 1]
            out[self.posting[a:b]] += c * self.value[self.order[a:b]]
        return out

    def entries(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position among ``docs``, index of the entry) of all their vector entries."""
        size = self.ptr[docs + 1] - self.ptr[docs]
        first = np.repeat(self.ptr[docs] - np.cumsum(size) + size, size)
        return np.repeat(np.arange(len(docs)), size), first + np.arange(size.sum())

    def blocks(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents of the posting list, their block): clusters of similar
        documents, long ones cut."""
        docs = self.docs_of(term)
        if len(docs) <= BLOCK:
            return docs, np.zeros(len(docs), np.int64)
        heads = docs[:: BLOCK]
        near = (self.sketch[docs] @ self.sketch[heads].T).argmax(1)
        order = np.argsort(near, kind="stable")
        near = near[order]
        start = np.concatenate(([True], near[1:] != near[:-1]))
        first = np.flatnonzero(start)
        inside = np.arange(len(docs)) - np.repeat(first, np.diff(np.append(first, len(docs))))
        start |= inside % (2 * BLOCK) == 0
        return docs[order], np.cumsum(start) - 1

    def summaries(self, docs: np.ndarray, block: np.ndarray, coordinate: np.ndarray, width: int) -> np.ndarray:
        """Coordinatewise maxima of the blocks; ``coordinate`` maps terms to columns, -1 to none."""
        row, entry = self.entries(docs)
        col = coordinate[self.at[entry]]
        keep = col >= 0
        out = np.zeros((int(block[-1]) + 1, width), self.value.dtype)
        np.maximum.at(out.reshape(-1), block[row[keep]] * width + col[keep], self.value[entry[keep]])
        return out

    def scores(self, docs: np.ndarray, item: np.ndarray) -> np.ndarray:
        """Scores of documents for an item given as counts over all terms."""
        row, entry = self.entries(docs)
        found = self.value[entry] * item[self.at[entry]]
        out = np.zeros(len(docs), found.dtype)
        size = np.bincount(row, minlength=len(docs))
        has = np.flatnonzero(size)
        if len(has):
            out[has] = np.add.reduceat(found, (np.cumsum(size) - size)[has])
        return out


class Best:
    """The best documents of every item, and its threshold."""

    def __init__(self, n: int, top: int, threshold: np.ndarray):
        self.top, self.threshold = top, threshold.copy()
        self.rows: list[tuple] = [(np.empty(0), np.empty(0, np.int64), np.empty(0, bool)) for _ in range(n)]

    def add(self, item: int, score: np.ndarray, doc_id: np.ndarray, no_id: np.ndarray) -> None:
        ok = (score >= self.threshold[item]) & (score > 0)
        if not ok.any():
            return
        s, d, e = (np.concatenate([old, new[ok]]) for old, new in zip(self.rows[item], (score, doc_id, no_id)))
        keep = np.lexsort((d, e, -s))[: self.top]
        self.rows[item] = (s[keep], d[keep], e[keep])
        if len(keep) == self.top:
            self.threshold[item] = max(self.threshold[item], s[keep[-1]])


def open_lists(shard: Shard, items: list[tuple[np.ndarray, np.ndarray]], threshold: np.ndarray) -> dict[int, list[int]]:
    """Items by the terms whose lists they open: all but the most frequent ones
    that together stay below the threshold."""
    size = np.diff(shard.list_ptr)
    out: dict[int, list[int]] = {}
    for i, (at, count) in enumerate(items):
        order = np.argsort(-size[at], kind="stable")
        least = np.cumsum((shard.top[at] * count)[order])
        for t in at[order[least >= threshold[i]]].tolist():
            if size[t]:
                out.setdefault(t, []).append(i)
    return out


def search_shard(shard: Shard, items: list[tuple[np.ndarray, np.ndarray]], best: Best, counts: dict | None = None) -> None:
    """Every item against the documents of a shard; ``best`` is updated."""
    n_terms, size = len(shard.list_ptr) - 1, np.diff(shard.list_ptr)
    dense = np.zeros(n_terms, shard.value.dtype)
    seen: dict[int, np.ndarray] = {}
    opened = open_lists(shard, items, best.threshold)
    for term in sorted(opened, key=lambda t: (size[t], t)):
        docs, block = shard.blocks(term)
        for a in range(0, len(opened[term]), ITEMS):
            mine = opened[term][a:a + ITEMS]
            used = np.unique(np.concatenate([items[i][0] for i in mine]))
            coordinate = np.full(n_terms, -1, np.int32)
            coordinate[used] = np.arange(len(used))
            weights = np.zeros((len(used), len(mine)), shard.value.dtype)
            for j, i in enumerate(mine):
                weights[coordinate[items[i][0]], j] = items[i][1]
            bound = shard.summaries(docs, block, coordinate, len(used)) @ weights
            for j, i in enumerate(mine):
                opens = bound[:, j] >= best.threshold[i]
                if counts is not None:
                    counts["blocks"] = counts.get("blocks", 0) + len(opens)
                    counts["opened"] = counts.get("opened", 0) + int(opens.sum())
                if not opens.any():
                    continue
                met = seen.setdefault(i, np.zeros(len(shard.doc_id), bool))
                new = docs[opens[block]]
                new = new[~met[new]]
                met[new] = True
                dense[items[i][0]] = items[i][1]
                best.add(i, shard.scores(new, dense), shard.doc_id[new], shard.no_id[new])
                dense[items[i][0]] = 0


def _shards(frames: Iterator[pd.DataFrame], weights: np.ndarray, n_docs: int, n_terms: int, kind) -> Iterator[Shard]:
    held: list[pd.DataFrame] = []
    docs = entries = 0

    def build() -> Shard:
        f = pd.concat(held)
        length = f["size"].to_numpy(np.int64)
        at = np.concatenate(f["at"].to_list()).astype(np.int64) if len(f) else np.empty(0, np.int64)
        tf = np.concatenate(f["tf"].to_list()).astype(np.int64) if len(f) else np.empty(0, np.int64)
        m = np.array([length_factor(n, n_docs, n_terms) for n in f["n"].tolist()], np.int64)
        value = (weights[at] * impact(tf, np.repeat(m, length))).astype(kind)
        return Shard(f["doc_id"].to_numpy(np.int64), f["no_id"].to_numpy(bool), length, at, value, len(weights))

    for f in frames:
        at = 0
        while at < len(f):
            size = f["size"].to_numpy()[at:]
            fit = int(np.searchsorted(np.cumsum(size), SHARD_ENTRIES - entries, side="right"))
            n = max(0 if held else 1, min(len(size), SHARD_DOCS - docs, fit))
            held.append(f.iloc[at:at + n])
            docs, entries, at = docs + n, entries + int(size[:n].sum()), at + n
            if at < len(f) or docs >= SHARD_DOCS:
                yield build()
                held, docs, entries = [], 0, 0
    if held:
        yield build()


def seed_documents(vectors: DataFrame, n: int) -> DataFrame:
    """About ``n`` documents, those with most different terms, by a cut-off from
    the counts per size; of equal sizes at the cut-off a share by hash."""
    taken, size = 0, F.col("size")
    # a row for each size, so at most one for each term of the block
    for s, held in sorted(map(tuple, vectors.groupBy("size").agg(F.count(F.lit(1))).collect()), reverse=True):
        if taken + held > n:
            share = -(-held // max(n - taken, 1))
            return vectors.where((size > s) | ((size == s) & (F.pmod(F.xxhash64("doc_id", "no_id"), F.lit(share)) == 0)))
        taken += held
    return vectors


def first_thresholds(seeds: DataFrame, items: list[tuple[np.ndarray, np.ndarray]], weights: np.ndarray, n_docs: int, n_terms: int,
                     top: int = TOP) -> np.ndarray:
    """Score of the ``top``-th best of the seeds for every item, 0 where fewer have one."""
    kind = _kind(items, weights)
    shared = seeds.sparkSession.sparkContext.broadcast((items, weights))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        items, weights = shared.value
        best = np.zeros((len(items), top), kind)
        for shard in _shards(frames, weights, n_docs, n_terms, kind):
            for i, (at, count) in enumerate(items):
                both = np.concatenate([best[i], shard.all_scores((at, count.astype(kind)))])
                best[i] = np.partition(both, len(both) - top)[-top:]
        yield pd.DataFrame({"item": np.repeat(np.arange(len(items), dtype=np.int32), top), "score": best.ravel().astype(np.int64)})

    found = seeds.select("doc_id", "no_id", "n", "size", "at", "tf").mapInPandas(run, "item int, score long").where("score > 0")
    each = F.row_number().over(Window.partitionBy("item").orderBy(F.col("score").desc()))
    out = np.zeros(len(items))
    for r in found.withColumn("r", each).where(F.col("r") == top).collect():  # a row for each item of the block
        out[r.item] = r.score
    return out


def _kind(items: list[tuple[np.ndarray, np.ndarray]], weights: np.ndarray):
    """Type that holds every sum exactly: a score is below 10^6 times the weights of the item's terms."""
    most = max([float((weights[at] * count).sum()) for at, count in items], default=0.0) * 1e6
    return np.float64 if most < 2 ** 53 else np.int64


def search(vectors: DataFrame, items: list[tuple[np.ndarray, np.ndarray]], weights: np.ndarray, n_docs: int, n_terms: int,
           threshold: np.ndarray, top: int = TOP) -> DataFrame:
    """(item, doc_id, no_id, score): the best ``top`` of every item in each task."""
    kind = _kind(items, weights)
    shared = vectors.sparkSession.sparkContext.broadcast((items, weights, threshold))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        items, weights, threshold = shared.value
        best = Best(len(items), top, threshold)
        items = [(at, count.astype(kind)) for at, count in items]
        for shard in _shards(frames, weights, n_docs, n_terms, kind):
            search_shard(shard, items, best)
        out = [pd.DataFrame({"item": np.int32(i), "doc_id": d, "no_id": e, "score": s.astype(np.int64)})
               for i, (s, d, e) in enumerate(best.rows) if len(s)]
        if out:
            yield pd.concat(out)

    return vectors.select("doc_id", "no_id", "n", "size", "at", "tf").mapInPandas(run, "item int, doc_id long, no_id boolean, score long")


def item_blocks(items: DataFrame, text: str, block_chars: int) -> Iterator[list[str]]:
    """The different texts of the items, block by block; one block is on the driver."""
    texts = items.where(F.col(text).isNotNull()).select(F.col(text).alias("t")).distinct()
    blocks = -(-(texts.agg(F.sum(F.length("t") + 1)).first()[0] or 0) // block_chars)
    for b in range(blocks):
        yield sorted(r.t for r in texts.where(F.pmod(F.xxhash64("t"), F.lit(blocks)) == b).collect())


def rank_documents(docs: DataFrame, items: DataFrame, text: str = "text", doc_id: str = "doc_id", item_text: str = "text",
                   item_id: str = "item_id", top: int = TOP, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` best documents of every item."""
    spark = docs.sparkSession
    found, wrote = scratch_path(spark, "lexical-found"), False
    by = [F.col("score").desc(), "no_id", "doc_id"]
    for b, texts in enumerate(item_blocks(items, item_text, block_chars)):
        bags = [terms(t) for t in texts]
        vocabulary = {w: i for i, w in enumerate(sorted({w for bag in bags for w in bag}))}
        if not vocabulary:
            continue
        vectors = stored(forward(docs, vocabulary, text, doc_id), "lexical-vectors")
        n_docs, n_terms = vectors.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = np.zeros(len(vocabulary), np.int64)
        for r in vectors.select(F.explode("at").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")).collect():  # a row for each term of the block
            df[r.t] = r.df
        weights = np.array([weight(n_docs, int(d)) for d in df], np.int64)
        bagged = []
        for bag in bags:
            at, count = np.unique(np.array([vocabulary[w] for w in bag], np.int64), return_counts=True)
            held = df[at] > 0
            bagged.append((at[held], count[held]))
        args = (bagged, weights, int(n_docs), int(n_terms))
        vectors = vectors.where("size > 0")
        seeds = seed_documents(vectors, SEEDS)
        best = search(vectors, *args, first_thresholds(seeds, *args, top), top)
        part = F.pmod(F.xxhash64("doc_id", "no_id"), F.lit(PARTS))
        best = best.withColumn("rank", F.row_number().over(Window.partitionBy("item", part).orderBy(*by))).where(F.col("rank") <= top)
        best = best.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*by))).where(F.col("rank") <= top)
        names = spark.createDataFrame(list(enumerate(texts)), "item int, t string")
        best.join(F.broadcast(names), "item").select("t", "rank", F.when(~F.col("no_id"), F.col("doc_id")).alias("doc_id"), "score").write.parquet(f"{found}/block={b}")
        wrote = True
    kind = items.schema[item_id].dataType.simpleString()
    if not wrote:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    ranked = spark.read.schema("t string, rank int, doc_id long, score long").parquet(found)
    return items.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("_t")).join(ranked, F.col("_t") == F.col("t")).select(
        "item_id", "rank", "doc_id", "score")


def op12_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")
ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_TERMS} AS terms FROM documents),
t AS (SELECT rid, unnest(terms) AS term FROM d),
p AS (SELECT rid, term, count(*) AS tf FROM t GROUP BY ALL),
g AS (SELECT count(*) AS nn, CAST(sum(len(terms)) AS BIGINT) AS ll FROM d WHERE len(terms) > 0),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * nn + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM p GROUP BY term), g),
m AS (SELECT rid, doc_id, 75 + (25 * len(terms) * nn) // ll AS m FROM d, g WHERE len(terms) > 0),
i AS (SELECT row_number() OVER () AS iid, item_id, {_TERMS} AS terms FROM benchmark),
q AS (SELECT iid, item_id, unnest(terms) AS term FROM i),
s AS (SELECT iid, item_id, rid, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
  FROM q JOIN p USING (term) JOIN w USING (term) JOIN m USING (rid) GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id) <= {TOP}
"""
