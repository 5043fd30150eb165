"""Near-duplicate vectors against all pairs in double precision."""

import numpy as np
import pytest

from ebbtide.llm import embeddings
from tests.llm.brute import vector_links

ODD = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]),
       (7, [1e-30, 1e-30]), (8, [1e30, 1e30]), (8, [1e30, 1e30]), (None, [1.0, 1.0]), (None, [-1.0, 1.0]), (9, [1.0, 0.0]),
       (10, [0.9, float(np.sqrt(1 - 0.81))]), (11, [1.0])]


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(6, 16))
    clouds = [centres[i % 6] + rng.normal(size=16) * rng.choice([0, 0.2, 0.3, 0.5]) for i in range(150)]
    return ODD + [(100 + i, [float(np.float32(x)) for x in v]) for i, v in enumerate(clouds)]


@pytest.mark.parametrize("block", [4096, 40])
def test_links_and_components(spark, rows, block):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3).selectExpr("*", "0 AS node")
    held = [(r.vec_id, r.embedding) for r in df.collect()]
    got = sorted((tuple(r) for r in embeddings.near_vectors(df, block=block).collect()), key=str)
    assert got == vector_links(held, 0.9)


def test_bounds_hold():
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(200, 24)) * 10.0 ** rng.integers(-20, 20, (200, 1))
    codes, scales, errors = embeddings.quantise(vectors)
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    rough = (codes * scales[:, None]) @ (codes * scales[:, None]).T
    bound = errors[:, None] + (1 + errors[:, None]) * errors[None]
    assert (np.abs(unit @ unit.T - rough) <= bound).all()


def test_without_usable_vectors(spark):
    df = spark.createDataFrame(ODD[:3], "vec_id long, embedding array<float>")
    assert sorted(tuple(r)[1:] for r in embeddings.near_vectors(df).collect()) == [(0, 1, True), (0, 2, True), (0, 3, True)]
    assert embeddings.near_vectors(df.where("vec_id < 0")).collect() == []
