"""Exact top-k inner products over vectors sorted by length.

Vectors become integers (``floor(scale * x)``), are sorted by descending length
with a range shuffle and written.  Their Gram matrix is summed in the tasks; its
eigenvectors (the right singular vectors of all vectors) rotate queries and
vectors so that the first coordinates hold most of a product.

Queries are taken in blocks.  For a block, about ``HEADS`` of the longest vectors give each
query a first threshold: the score of its k-th best of them.  All vectors are
then read in chunks of descending length.  Queries whose length times the chunk's
greatest stays below their threshold are out; for the others partial sums over the
first rotated coordinates are taken, and a pair goes on only while partial sum +
|rest of the query| * |rest of the vector| (Cauchy-Schwarz) reaches the threshold.
What is left is scored in exact integers.  Thresholds rise with every chunk; a
task hands on its best k per query, so no shuffle carries more than that.

The rotation is floating point: bounds get a margin far above its error, so
pruning never loses a vector that ties with the k-th.

Edge cases: vectors that are null or hold null or non-finite components take no
part, as query or candidate; vectors of different lengths are taken as padded
with zeros, the empty vector scores 0; components are clipped so that a product
fits 64 bits (beyond +-2^27 for 64 components); null ids are candidates, after
all others of equal score; rows repeating an id are rows of their own: a query leaves out
one row equal to itself, and equal query rows each get their result; fewer
candidates than k: all; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources import scratch_path
from .common import stored, table
from .op11_centroids import grid, usable

TOP = 10
SCALE = 1024
EVERY = 100
#: Queries in a broadcast block, longest vectors for the first thresholds, vectors in a chunk.
QUERY_BLOCK = 4096
HEADS = 2048
CHUNK = 1024
#: Shares of the coordinates after which bounds are tested.
TESTS = (0.125, 0.25, 0.5, 0.75)
SLACK = 1e-9
#: Exact products computed at once, and parts in which a query's candidates are first ranked.
PAIRS = 1 << 16
PARTS = 64

FOUND = "query int, vec_id long, no_id boolean, same boolean, score long"


def integer_vectors(vectors: DataFrame, embedding: str = "embedding", vec_id: str = "vec_id", scale: int = SCALE) -> DataFrame:
    """(vec_id, no_id, x, norm) of the usable vectors by descending length, written."""
    rows = vectors.where(usable(F.col(embedding))).select(F.col(vec_id).cast("long").alias("id"), F.col(embedding).alias("e"))
    dim = rows.agg(F.max(F.size("e"))).first()[0] or 0
    limit = int((2 ** 62 / max(dim, 1)) ** 0.5)
    rows = rows.select(F.coalesce("id", F.lit(0)).alias("vec_id"), F.col("id").isNull().alias("no_id"), grid(F.col("e"), scale, min(limit, 2 ** 30)).alias("x"))
    norm = F.sqrt(F.aggregate("x", F.lit(0.0), lambda a, v: a + v.cast("double") * v))
    rows = rows.withColumn("norm", norm)
    order = [F.col("norm").desc(), F.xxhash64("vec_id", "x")]  # the hash cuts a length that many vectors have
    return stored(rows.repartitionByRange(*order).sortWithinPartitions(*order), "topk-vectors")


def matrix(col: pd.Series, dim: int) -> np.ndarray:
    """Rows padded with zeros to ``dim``."""
    out = np.zeros((len(col), dim), np.int64)
    for i, v in enumerate(col):
        out[i, : len(v)] = v
    return out


def rotation(rows: DataFrame, dim: int) -> np.ndarray:
    """Right singular vectors of all rows, by descending singular value: the
    eigenvectors of the Gram matrix, which is summed in the tasks."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        gram = np.zeros((dim, dim))
        for f in frames:
            if not f.empty:
                x = matrix(f["x"], dim).astype(np.float64)
                gram += x.T @ x
        yield pd.DataFrame({"at": np.arange(dim * dim), "s": gram.ravel()})

    parts = rows.select("x").mapInPandas(run, "at int, s double").groupBy("at").agg(F.sum("s").alias("s"))
    gram = np.zeros(dim * dim)
    for r in parts.collect():  # dim * dim numbers
        gram[r.at] = r.s
    return np.linalg.eigh(gram.reshape(dim, dim))[1][:, ::-1]


def ranked(query: np.ndarray, score: np.ndarray, vec_id: np.ndarray, no_id: np.ndarray, k: int) -> np.ndarray:
    """Positions of the best ``k`` of every query."""
    order = np.lexsort((vec_id, no_id, -score, query))
    q = query[order]
    start = np.flatnonzero(np.concatenate(([True], q[1:] != q[:-1])))
    rank = np.arange(len(q)) - np.repeat(start, np.diff(np.append(start, len(q))))
    return order[rank < k]


class Search:
    """Best ``k`` of a block of queries over chunks of vectors."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, basis: np.ndarray, k: int, threshold: np.ndarray | None = None):
        self.ids, self.x, self.basis, self.k = ids, x, basis, k
        self.y = x @ basis
        self.cuts = sorted({max(1, int(basis.shape[0] * t)) for t in TESTS}) if basis.shape[0] else []
        self.norm = np.sqrt((self.y * self.y).sum(1))
        self.threshold = np.full(len(x), np.iinfo(np.int64).min) if threshold is None else threshold.copy()
        self.best = {c: np.empty(0, t) for c, t in (("query", np.int64), ("vec_id", np.int64), ("no_id", bool), ("same", bool), ("score", np.int64))}
        self.most = np.abs(x).max(initial=0)
        self.scored = 0

    def _survivors(self, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, row) whose bound reaches the threshold at every test."""
        norm = np.sqrt((y * y).sum(1))
        floor = self.threshold.astype(np.float64)
        reach = norm.max() * self.norm * (1 + SLACK) + 1
        q, r = np.flatnonzero(reach >= floor), np.arange(len(y))
        low, part = 0, None
        for cut in [*self.cuts, None]:
            if not len(q) or not len(r):
                return q[:0], r[:0]
            if cut is None:
                if part is None:
                    return np.repeat(q, len(r)), np.tile(r, len(q))
                return q[ok[0]], r[ok[1]]
            more = self.y[np.ix_(q, range(low, cut))] @ y[np.ix_(r, range(low, cut))].T
            part = more if part is None else part + more
            left_q = np.sqrt((self.y[q, cut:] ** 2).sum(1))
            left_r = np.sqrt((y[r, cut:] ** 2).sum(1))
            bound = part + np.outer(left_q, left_r)
            bound += np.outer(self.norm[q], norm[r]) * SLACK + 1
            hit = bound >= floor[q][:, None]
            low = cut
            keep_q, keep_r = hit.any(1), hit.any(0)
            q, r, part, hit = q[keep_q], r[keep_r], part[np.ix_(keep_q, keep_r)], hit[np.ix_(keep_q, keep_r)]
            ok = np.nonzero(hit)
            if len(ok[0]) * 8 < hit.size:  # few are left: score them
                return q[ok[0]], r[ok[1]]
        return q[:0], r[:0]

    def _scores(self, x: np.ndarray, q: np.ndarray, r: np.ndarray) -> np.ndarray:
        """Exact products of the pairs; where most pairs of a block are wanted and
        doubles hold the sums exactly, by one product of matrices."""
        uq, ur = np.unique(q), np.unique(r)
        if len(q) * 4 > len(uq) * len(ur) and float(self.most) * np.abs(x).max(initial=0) * x.shape[1] < 2 ** 53:
            dense = self.x[uq].astype(np.float64) @ x[ur].astype(np.float64).T
            return dense[np.searchsorted(uq, q), np.searchsorted(ur, r)].astype(np.int64)
        score = np.empty(len(q), np.int64)
        for a in range(0, len(q), PAIRS):
            score[a:a + PAIRS] = np.einsum("ij,ij->i", self.x[q[a:a + PAIRS]], x[r[a:a + PAIRS]])
        return score

    def add(self, x: np.ndarray, vec_id: np.ndarray, no_id: np.ndarray) -> None:
        q, r = self._survivors(x @ self.basis)
        if not len(q):
            return
        score = self._scores(x, q, r)
        self.scored += len(q)
        ok = score >= self.threshold[q]
        q, r, score = q[ok], r[ok], score[ok]
        same = (self.ids[q] == vec_id[r]) & ~no_id[r]
        same[same] = (self.x[q[same]] == x[r[same]]).all(1)
        new = {"query": q, "vec_id": vec_id[r], "no_id": no_id[r], "same": same, "score": score}
        both = {c: np.concatenate([v, new[c]]) for c, v in self.best.items()}
        top = ranked(both["query"], both["score"], both["vec_id"], both["no_id"], self.k)
        self.best = {c: v[top] for c, v in both.items()}
        at, n = np.unique(self.best["query"], return_counts=True)
        last = np.cumsum(n) - 1
        full = n == self.k
        self.threshold[at[full]] = np.maximum(self.threshold[at[full]], self.best["score"][last[full]])


def search(rows: DataFrame, ids: np.ndarray, x: np.ndarray, basis: np.ndarray, k: int, threshold: np.ndarray | None = None) -> DataFrame:
    """(query, vec_id, no_id, same, score): the best ``k`` of each query in every task."""
    shared = rows.sparkSession.sparkContext.broadcast((ids, x, basis, threshold))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, x, basis, threshold = shared.value
        found = Search(ids, x, basis, k, threshold)
        for f in frames:
            for a in range(0, len(f), CHUNK):
                g = f.iloc[a:a + CHUNK]
                found.add(matrix(g["x"], x.shape[1]), g["vec_id"].to_numpy(np.int64), g["no_id"].to_numpy(bool))
        yield pd.DataFrame(found.best)

    return rows.select("vec_id", "no_id", "x").mapInPandas(run, FOUND)


def longest(rows: DataFrame, n: int) -> DataFrame:
    """About ``n`` of the longest vectors (a ten-thousandth of all, if that is
    more), by a cut-off; of equal lengths at the cut-off a share by hash."""
    total = rows.count()
    if total <= n:
        return rows
    least = rows.agg(F.percentile_approx("norm", F.lit(1 - n / total), F.lit(10_000))).first()[0]
    norm = F.col("norm")
    above, tied = rows.where(norm >= least).agg(F.sum(F.when(norm > least, 1).otherwise(0)), F.sum(F.when(norm == least, 1).otherwise(0))).first()
    share = -(-tied // max(n - above, 1))
    return rows.where((norm > least) | ((norm == least) & (F.pmod(F.xxhash64("vec_id", "x"), F.lit(share)) == 0)))


def top_products(vectors: DataFrame, embedding: str = "embedding", vec_id: str = "vec_id", every: int = EVERY, top: int = TOP,
                 scale: int = SCALE, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``top`` best of every query, the rows
    whose id is divisible by ``every``."""
    spark = vectors.sparkSession
    rows = integer_vectors(vectors, embedding, vec_id, scale)
    dim = rows.agg(F.max(F.size("x"))).first()[0] or 0
    basis = rotation(rows, dim)
    k = top + 1  # a query meets itself
    heads = longest(rows, HEADS)
    # equal query rows have equal results: searched once, counted in ``copies``
    queries = stored(rows.where(~F.col("no_id") & (F.pmod("vec_id", F.lit(every)) == 0)).groupBy("vec_id", "x").agg(
        F.count(F.lit(1)).alias("copies")), "topk-queries")
    blocks, done = -(-queries.count() // query_block), scratch_path(spark, "topk-blocks")
    wrote = False
    for b in range(blocks):
        block = queries.where(F.pmod(F.xxhash64("vec_id", "x"), F.lit(blocks)) == b).collect()  # about query_block rows
        if not block:
            continue
        block.sort(key=lambda r: (r.vec_id, r.x))
        ids = np.array([r.vec_id for r in block], np.int64)
        x = matrix(pd.Series([r.x for r in block]), dim)
        first = search(heads, ids, x, basis, k)
        order = F.row_number().over(Window.partitionBy("query").orderBy(F.col("score").desc()))
        threshold = np.full(len(ids), np.iinfo(np.int64).min)
        for r in first.withColumn("n", order).where(F.col("n") == k).collect():  # a row for each query of the block
            threshold[r.query] = r.score
        copies = spark.createDataFrame([(i, r.vec_id, r.copies) for i, r in enumerate(block)], "query int, query_id long, copies long")
        best = search(rows, ids, x, basis, k, threshold)
        by = [F.col("score").desc(), "no_id", "vec_id"]
        part = F.pmod(F.xxhash64("vec_id", "no_id"), F.lit(PARTS))
        best = best.withColumn("_n", F.row_number().over(Window.partitionBy("query", part).orderBy(*by))).where(F.col("_n") <= k)
        best = best.withColumn("_n", F.row_number().over(Window.partitionBy("query").orderBy(*by))).where(F.col("_n") <= k)
        own = F.row_number().over(Window.partitionBy("query", "same").orderBy(*by))
        best = best.withColumn("_own", own).where(~(F.col("same") & (F.col("_own") == 1)))
        rank = F.row_number().over(Window.partitionBy("query").orderBy(*by))
        best = best.withColumn("rank", rank).where(F.col("rank") <= top).join(F.broadcast(copies), "query")
        best.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select(
            "query_id", "rank", F.when(~F.col("no_id"), F.col("vec_id")).alias("vec_id"), "score").write.parquet(f"{done}/block={b}")
        wrote = True
    result = "query_id long, rank int, vec_id long, score long"
    return spark.read.schema(result).parquet(done).drop("block") if wrote else spark.createDataFrame([], result)


def op13_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_products(table(spark, sf_dir, "embeddings"))


ORACLE = f"""
WITH v AS (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
e AS (SELECT rid, vec_id, unnest(generate_series(1, len(x))) AS pos, unnest(x) AS x FROM v),
s AS (
  SELECT q.rid, q.vec_id AS query_id, c.rid AS other, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
  FROM e q JOIN e c USING (pos) WHERE q.vec_id % {EVERY} = 0 AND q.rid <> c.rid GROUP BY ALL)
SELECT query_id, CAST(row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= {TOP}
"""
