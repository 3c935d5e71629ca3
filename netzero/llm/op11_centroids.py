"""Centroid clustering (Lloyd rounds) with ns-bounds.

Every vector keeps, for each centroid, the squared distance at its last
evaluation and the round of it.  The centroids of all rounds are retained, so
the bound of a pair is loosened by the norm of the *total* displacement of the
centroid since that round, ``|c_now - c_then|``, not by the sum of its drifts
round by round, which is never smaller.  A centroid whose lower bound lies
above the upper bound of the assigned one is passed over; every pair that fails
the test is evaluated again in exact integers, so assignments, ties included, are
those of a full scan.

A round is one pass over the vectors, written to the shared folder.  New
centroids come from the vectors that moved: their components are added to the
new cluster and taken from the old one, summed per task and then in Spark, so a
cluster holding most rows costs no more than another.  The driver and the tasks
hold the centroids of the rounds, ``k * dim * (rounds + 1)`` integers, and the sums.

Components are ``floor(scale * x)``, x as double, clipped so that a squared
distance fits 64 bits (beyond +-2^27 for 64 components).

Edge cases: vectors that are null, of another length, or hold null or non-finite
components take no part; null ids are clustered but seed last; equal ids or
equal vectors are separate rows, equal hashes seed in order of components;
fewer vectors than ``k``: as many centroids; equal centroids: the smaller number
takes the vectors, the other stays as it is; an empty table gives an empty
result; a sum of distances beyond 64 bits is null; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, table

K = 16
DIM = 64
ROUNDS = 3
SCALE = 64
SEED = 1
#: Exact distances computed at once in a task.
PAIRS = 1 << 15
#: Room for rounding of the floating bounds; pairs inside it are evaluated.
SLACK = 1e-9

STATE = "vec_id long, no_id boolean, x array<int>, dist array<long>, seen array<short>, before int, cluster int, evaluated int"


def usable(embedding: Column, dim: int | None = None) -> Column:
    """Vectors without null or non-finite components, of ``dim`` components if given."""
    # NaN and infinities are the values that a difference with themselves does not cancel
    ok = F.forall(embedding, lambda v: v.isNotNull() & ((v - v) == F.lit(0.0)))
    ok = embedding.isNotNull() & ok
    return F.coalesce(ok & (F.size(embedding) == dim) if dim is not None else ok, F.lit(False))


def grid(embedding: Column, scale: int, limit: int) -> Column:
    """Integer components floor(scale * x), clipped to +-limit."""
    def one(v: Column) -> Column:
        return F.greatest(F.least(F.floor(F.least(F.greatest(v.cast("double") * scale, F.lit(-1e18)), F.lit(1e18))), F.lit(limit)),
                          F.lit(-limit)).cast("int")
    return F.transform(embedding, one)


def integer_vectors(vectors: DataFrame, embedding: str = "embedding", vec_id: str = "vec_id", dim: int = DIM,
                    scale: int = SCALE) -> DataFrame:
    """(vec_id, x) of the usable vectors."""
    limit = int((2 ** 62 / max(dim, 1)) ** 0.5) // 2  # differences up to 2 * limit
    return vectors.where(usable(F.col(embedding), dim)).select(
        F.col(vec_id).cast("long").alias("vec_id"), grid(F.col(embedding), scale, min(limit, 2 ** 30)).alias("x"))


def first_centroids(rows: DataFrame, k: int = K, seed: int = SEED) -> np.ndarray:
    """The k vectors with the smallest hashes of ``seed:vec_id``, in their order."""
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    top = rows.withColumn("_h", mark).orderBy(F.col("_h").asc_nulls_last(), "x").limit(k).select("x").collect()
    return np.array([r.x for r in top], np.int64)


def exact(x: np.ndarray, c: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Squared distances of the pairs (x[i], c[j])."""
    out = np.empty(len(i), np.int64)
    for a in range(0, len(i), PAIRS):
        d = x[i[a:a + PAIRS]] - c[j[a:a + PAIRS]]
        out[a:a + PAIRS] = np.einsum("ij,ij->i", d, d)
    return out


def displacements(history: np.ndarray) -> np.ndarray:
    """[t, j]: norm of the way of centroid j from round t to the last one."""
    way = (history[-1][None] - history).astype(np.float64)
    return np.sqrt((way * way).sum(2))


def reassign(x: np.ndarray, dist: np.ndarray, seen: np.ndarray, cluster: np.ndarray, history: np.ndarray,
             settle: bool) -> tuple[np.ndarray, np.ndarray]:
    """(cluster, number of evaluations) under the last centroids; ``dist`` and
    ``seen`` are updated in place.  With ``settle`` the distance to the
    assigned centroid is evaluated in any case."""
    now, centroids = len(history) - 1, history[-1]
    n, k = len(x), len(centroids)
    rows = np.arange(n)
    away = displacements(history)
    loose = away[seen, np.arange(k)[None, :]]
    root = np.sqrt(dist.astype(np.float64))
    lower = (root - loose) * (1 - SLACK) - SLACK
    upper = (root[rows, cluster] + loose[rows, cluster]) * (1 + SLACK) + SLACK
    fails = lower <= upper[:, None]
    fails[rows, cluster] = False
    count = np.zeros(n, np.int32)
    again = np.flatnonzero(fails.any(1) | (settle & (seen[rows, cluster] < now)))
    if len(again):  # the assigned centroid first: its exact distance may do
        own = cluster[again]
        dist[again, own] = exact(x, centroids, again, own)
        seen[again, own] = now
        count[again] += 1
        upper[again] = np.sqrt(dist[again, own].astype(np.float64)) * (1 + SLACK) + SLACK
        fails[again] &= lower[again] <= upper[again][:, None]
    i, j = np.nonzero(fails)
    dist[i, j] = exact(x, centroids, i, j)
    seen[i, j] = now
    count += np.bincount(i, minlength=n).astype(np.int32)
    known = np.where(fails, dist, np.iinfo(np.int64).max)
    known[rows, cluster] = dist[rows, cluster]
    out = cluster.copy()
    out[again] = known[again].argmin(1)  # first of equal distances: the smaller number
    return out, count


def _matrix(col: pd.Series, kind) -> np.ndarray:
    return np.stack(col.to_numpy()).astype(kind)


def assign(rows: DataFrame, history: np.ndarray, settle: bool) -> DataFrame:
    """State after one pass; ``rows`` is (vec_id, x) in the first one."""
    k, first = history.shape[1], len(history) == 1

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if f.empty:
                continue
            x = _matrix(f["x"], np.int64)
            n = len(x)
            if first:
                i = np.repeat(np.arange(n), k)
                dist = exact(x, history[0], i, np.tile(np.arange(k), n)).reshape(n, k)
                seen, before = np.zeros((n, k), np.int16), np.full(n, -1, np.int32)
                cluster, count = dist.argmin(1).astype(np.int32), np.full(n, k, np.int32)
            else:
                dist, seen = _matrix(f["dist"], np.int64), _matrix(f["seen"], np.int16)
                before = f["cluster"].to_numpy(np.int32)
                cluster, count = reassign(x, dist, seen, before, history, settle)
                count = count + f["evaluated"].to_numpy(np.int32)
            yield pd.DataFrame({"vec_id": f["vec_id"], "no_id": f["no_id"], "x": f["x"], "dist": list(dist), "seen": list(seen),
                                "before": before, "cluster": cluster.astype(np.int32), "evaluated": count})

    if first:
        rows = rows.select(F.coalesce("vec_id", F.lit(0)).alias("vec_id"), F.col("vec_id").isNull().alias("no_id"), "x")
    return rows.mapInPandas(run, STATE)


def moved_sums(state: DataFrame, dim: int) -> list[tuple[int, int, int]]:
    """(cluster, component, change of its sum) by the vectors that moved; component ``dim`` is the count."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if f.empty:
                continue
            x = np.concatenate([_matrix(f["x"], np.int64), np.ones((len(f), 1), np.int64)], axis=1)
            out = []
            for col, sign in (("cluster", 1), ("before", -1)):
                to = f[col].to_numpy()
                for c in np.unique(to[to >= 0]):
                    out.append(pd.DataFrame({"cluster": np.int32(c), "at": np.arange(dim + 1, dtype=np.int32), "s": sign * x[to == c].sum(0)}))
            yield pd.concat(out)

    parts = state.where("cluster != before").select("x", "before", "cluster").mapInPandas(run, "cluster int, at int, s long")
    return [(r.cluster, r.at, int(r.s)) for r in parts.groupBy("cluster", "at").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()]


def cluster_vectors(vectors: DataFrame, embedding: str = "embedding", vec_id: str = "vec_id", dim: int = DIM, k: int = K,
                    rounds: int = ROUNDS, scale: int = SCALE, seed: int = SEED) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance, evaluated) of every usable vector, and the final centroids."""
    rows = stored(integer_vectors(vectors, embedding, vec_id, dim, scale), "centroids-vectors")
    centroids = first_centroids(rows, k, seed)
    if not len(centroids):
        empty = rows.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"), F.lit(0).alias("evaluated"))
        return empty.where(F.lit(False)), centroids
    history, sums = [centroids], {}
    state = rows
    for r in range(rounds + 1):
        state = stored(assign(state, np.array(history), settle=r == rounds), "centroids-round")
        if r == rounds:
            break
        for c, at, s in moved_sums(state, dim):
            sums[c, at] = sums.get((c, at), 0) + s
        new = history[-1].copy()
        for c in range(len(new)):
            if sums.get((c, dim), 0):
                new[c] = [sums.get((c, at), 0) // sums[c, dim] for at in range(dim)]
        history.append(new)
    out = state.select(F.when(~F.col("no_id"), F.col("vec_id")).alias("vec_id"), "cluster",
                       F.element_at("dist", F.col("cluster") + 1).alias("distance"), "evaluated")
    return out, history[-1]


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, centroids = cluster_vectors(table(spark, sf_dir, "embeddings"))
    # k rows: one for each centroid
    inertia = {r.cluster: r.s for r in out.groupBy("cluster").agg(F.try_sum("distance").alias("s")).collect()}
    total = sum(v or 0 for v in inertia.values())
    total = None if None in inertia.values() or total >= 2 ** 63 else total
    rows = [(c, inertia.get(c), hashlib.sha256(",".join(map(str, v)).encode()).hexdigest()) for c, v in enumerate(centroids.tolist())]
    known = spark.createDataFrame(rows, "cluster int, cluster_inertia long, centroid_sha256 string")
    return out.join(F.broadcast(known), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", F.lit(total).cast("long").alias("inertia"), "centroid_sha256")


def _oracle(k: int = K, dim: int = DIM, rounds: int = ROUNDS) -> str:
    out = [f"""v AS (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dim})""",
           f"e AS (SELECT rid, unnest(generate_series(1, {dim})) AS pos, unnest(x) AS x FROM v)",
           f"""s AS (SELECT rid, CAST(row_number() OVER (ORDER BY sha256('{SEED}:' || CAST(vec_id AS VARCHAR)), x) - 1 AS INTEGER) AS cluster FROM v)""",
           f"c0 AS (SELECT s.cluster, e.pos, e.x FROM s JOIN e USING (rid) WHERE s.cluster < {k})"]
    for r in range(rounds + 1):
        out.append(f"""d{r} AS (SELECT e.rid, c.cluster, sum((e.x - c.x) * (e.x - c.x)) AS d FROM e JOIN c{r} c USING (pos) GROUP BY ALL),
a{r} AS (SELECT rid, cluster, CAST(d AS BIGINT) AS distance FROM d{r} QUALIFY row_number() OVER (PARTITION BY rid ORDER BY d, cluster) = 1)""")
        if r < rounds:
            out.append(f"""t{r} AS (SELECT a.cluster, e.pos, sum(e.x) AS s, count(*) AS n FROM a{r} a JOIN e USING (rid) GROUP BY ALL),
c{r + 1} AS (SELECT c.cluster, c.pos, CASE WHEN n IS NULL THEN c.x ELSE CAST((s - ((s % n) + n) % n) // n AS BIGINT) END AS x
  FROM c{r} c LEFT JOIN t{r} t USING (cluster, pos))""")
    out.append(f"h AS (SELECT cluster, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY pos)) AS centroid_sha256 FROM c{rounds} GROUP BY cluster)")
    return "WITH " + ",\n".join(out) + f"""
SELECT v.vec_id, a.cluster, a.distance, CAST(sum(a.distance) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(a.distance) OVER () AS BIGINT) AS inertia, h.centroid_sha256
FROM a{rounds} a JOIN v USING (rid) JOIN h USING (cluster)"""


ORACLE = _oracle()
