from __future__ import annotations

import hashlib
import math

import numpy as np

from netzero.llm import op11_centroids as m

SCHEMA = "vec_id long, embedding array<double>, label int, cluster int, x string"


def vectors(n: int, dim: int, seed: int) -> list[list[float]]:
    rnd = np.random.default_rng(seed)
    centers = rnd.normal(size=(5, dim))
    return [(centers[i % 5] + 0.3 * rnd.normal(size=dim)).tolist() for i in range(n)]


def brute(rows, dim, k, rounds, scale=64, seed=1):
    kept = [(i, [math.floor(scale * v) for v in e]) for i, e, *_ in rows
            if e is not None and len(e) == dim and all(v is not None and math.isfinite(v) for v in e)]
    mark = lambda i: hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()
    seeds = sorted(kept, key=lambda r: (r[0] is None, mark(r[0]), r[1]))[:k]
    c = [x for _, x in seeds]
    near = lambda x: min((sum((a - b) ** 2 for a, b in zip(x, y)), j) for j, y in enumerate(c))
    for _ in range(rounds):
        own = [near(x)[1] for _, x in kept]
        for j in range(len(c)):
            mine = [x for (_, x), o in zip(kept, own) if o == j]
            if mine:
                c[j] = [sum(v) // len(mine) for v in zip(*mine)]
    return sorted((str(i), near(x)[1], near(x)[0]) for i, x in kept), c


def edge_rows(dim=4):
    e = vectors(60, dim, 1)
    rows = [(i, v, 0, 7, "q") for i, v in enumerate(e)]
    rows += [(60, None, 0, 7, "q"), (61, [1.0] * (dim - 1), 0, 7, "q"), (62, [None] * dim, 0, 7, "q"), (63, [], 0, 7, "q"),
             (64, [float("nan")] * dim, 0, 7, "q"), (65, [float("inf")] + [0.0] * (dim - 1), 0, 7, "q"),
             (None, e[3], None, None, None), (None, e[4], None, None, None), (5, e[5], 1, 1, "q"), (5, e[6], 1, 1, "q")]
    return rows + [(100 + i, e[0], 0, 7, "q") for i in range(40)]  # one vector with a third of all rows


def test_equals_a_full_scan(spark):
    rows = edge_rows()
    for k, rounds in ((16, 3), (3, 6), (200, 2)):
        out, c = m.cluster_vectors(spark.createDataFrame(rows, SCHEMA), dim=4, k=k, rounds=rounds)
        expected, centroids = brute(rows, 4, k, rounds)
        assert sorted((str(r.vec_id), r.cluster, r.distance) for r in out.collect()) == expected
        assert c.tolist() == centroids


def test_bounds_spare_evaluations(spark):
    rows = [(i, v, 0, 0, "") for i, v in enumerate(vectors(400, 8, 3))]
    out, _ = m.cluster_vectors(spark.createDataFrame(rows, SCHEMA), dim=8, k=8, rounds=6)
    assert sum(r.evaluated for r in out.collect()) < 0.5 * 400 * 8 * 7


def test_total_displacement_is_the_bound():
    """A centroid that goes away and comes back has moved by nothing, although its drifts add up."""
    home, away = np.array([[0, 0], [100, 0]]), np.array([[0, 0], [5000, 0]])
    history = np.array([home, away, home])
    assert m.displacements(history)[0].tolist() == [0, 0]
    x, dist = np.array([[3, 4]]), np.array([[25, 97 * 97 + 16]])
    cluster, count = m.reassign(x, dist, np.zeros((1, 2), np.int16), np.zeros(1, np.int32), history, False)
    assert cluster.tolist() == [0] and count.tolist() == [0]


def test_ties_go_to_the_smaller_number():
    history = np.array([[[0, 0], [9, 9]], [[2, 0], [-2, 0]]])
    x, dist = np.array([[0, 7]]), np.array([[49, 81 + 4]])
    cluster, _ = m.reassign(x, dist, np.zeros((1, 2), np.int16), np.ones(1, np.int32), history, True)
    assert cluster.tolist() == [0] and dist[0, 0] == 53


def test_large_components_are_clipped(spark):
    rows = [(1, [1e30] * 64, 0, 0, ""), (2, [-1e30] * 64, 0, 0, ""), (3, [0.0] * 64, 0, 0, "")]
    out, _ = m.cluster_vectors(spark.createDataFrame(rows, SCHEMA), k=2)
    assert len(out.collect()) == 3


def test_empty_table(spark):
    out, c = m.cluster_vectors(spark.createDataFrame([], SCHEMA))
    assert out.count() == 0 and len(c) == 0


def test_query_columns(spark, tmp_path):
    rows = [(i, v, 0, 0, "") for i, v in enumerate(vectors(50, 64, 5))]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    out = m.op11_centroids(spark, str(tmp_path)).collect()
    expected, c = brute(rows, 64, 16, 3)
    assert sorted((str(r.vec_id), r.cluster, r.distance) for r in out) == expected
    assert {r.inertia for r in out} == {sum(d for _, _, d in expected)}
    assert {(r.cluster, r.centroid_sha256) for r in out} <= {(j, hashlib.sha256(",".join(map(str, v)).encode()).hexdigest()) for j, v in enumerate(c)}
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/none/embeddings.parquet")
    assert m.op11_centroids(spark, f"{tmp_path}/none").columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
