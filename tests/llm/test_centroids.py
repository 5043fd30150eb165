"""Clustering in whole numbers against a plain version, and the bounds of the projection."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbtide.llm import centroids

SCHEMA = "vec_id long, embedding array<float>"


def plain(rows, clusters, rounds, dim):
    kept = []
    for vec_id, v in rows:
        if v is not None and len(v) == dim and all(x is not None and np.isfinite(x) for x in v):
            kept.append((vec_id, [int(np.floor(256 * float(np.float32(x)))) for x in v]))

    def key(row):
        return hashlib.sha256(f"2:{'' if row[0] is None else row[0]}".encode()).hexdigest(), row[1]

    centres = [list(v) for _, v in sorted(kept, key=key)[:clusters]]

    def nearest(v):
        return min((sum((x - y) ** 2 for x, y in zip(v, c)), i) for i, c in enumerate(centres))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for i, members in groups.items():
            centres[i] = [sum(column) // len(members) for column in zip(*members)]
    found = [(vec_id, *reversed(nearest(v))) for vec_id, v in kept]
    inertia = {}
    for _, cluster, distance in found:
        inertia[cluster] = inertia.get(cluster, 0) + distance
    whole = sum(inertia.values())
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((v, c, d, inertia[c], whole, digests[c]) for v, c, d in found), key=str)


ODD = [(1, None), (2, []), (3, [0.0] * 7), (4, [None] + [1.0] * 7), (5, [float("nan")] + [1.0] * 7),
       (6, [float("-inf")] + [1.0] * 7), (7, [0.0] * 8), (7, [0.0] * 8), (None, [0.5] * 8), (None, [-0.5] * 8)]


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(5, 8))
    # Coarse values, so that many distances tie.
    return ODD + [(10 + i, [float(x) for x in np.round(2 * (centres[i % 5] + rng.normal(size=8) * 0.6)) / 2]) for i in range(300)]


@pytest.mark.parametrize("clusters, pivots", [(7, 3), (12, 12), (400, 5)])
def test_clusters(spark, rows, clusters, pivots):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumns({c: F.lit(1) for c in ("cluster", "apex", "blur")})
    got = centroids.cluster_vectors(df, clusters, 3, 8, pivots=pivots).drop("centroid")
    assert sorted(map(tuple, got.collect()), key=str) == plain(rows, clusters, 3, 8)


def test_without_kept_vectors(spark, rows):
    df = spark.createDataFrame(ODD[:6], SCHEMA)
    assert centroids.cluster_vectors(df, dim=8).collect() == []
    assert centroids.cluster_vectors(df.where("vec_id < 0"), dim=8).collect() == []


def test_huge_components_are_an_error(spark):
    df = spark.createDataFrame([(1, [1e30] * 8)], SCHEMA)
    with pytest.raises(Exception, match="do not fit a long"):
        centroids.cluster_vectors(df, dim=8).collect()


@pytest.mark.parametrize("spread", [0, 1, 1000, 1 << 20])
def test_bounds_hold(spread):
    rng = np.random.default_rng(spread)
    for dim, pivots in ((2, 5), (8, 8), (64, 24)):
        points = rng.integers(-(1 << 22), 1 << 22, (1, dim)) + rng.integers(-spread, spread + 1, (200, dim))
        centres = np.r_[points[:30], points[:5] + 1]
        simplex = centroids.Simplex(np.r_[points[:pivots], points[:2]])
        assert len(simplex.pivots) <= dim + 1
        low, high = centroids.bounds(*simplex.project(points), *simplex.project(centres))
        apart = np.sqrt(((points[:, None] - centres[None]).astype(object) ** 2).sum(-1).astype(float))
        assert (low <= apart).all() and (apart <= high).all()


def test_candidates_are_cut():
    rng = np.random.default_rng(9)
    middles = rng.integers(-1000, 1000, (40, 64))
    points = np.repeat(middles, 50, axis=0) + rng.integers(-30, 31, (2000, 64))
    simplex = centroids.Simplex(middles[: centroids.PIVOTS])
    low, high = centroids.bounds(*simplex.project(points), *simplex.project(middles))
    assert (low <= high.min(axis=1, keepdims=True)).mean() < 0.25
