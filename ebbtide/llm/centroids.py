"""Clustering around centroids in whole numbers, with candidates cut by an n-simplex projection.

The distances of a point to n pivots fix the place of an apex above the simplex that the pivots span: n - 1 coordinates in
its plane and one altitude.  For two apexes the Euclidean distance is a lower bound of the distance of the points, and
with one altitude turned downwards it is an upper bound.  The apex of every vector is computed once and written beside
the vector; a round projects the centroids, drops for each vector those whose lower bound lies above the least upper
bound, and compares the rest in exact integers.  Bounds are widened by what rounding can have done to them.

Centroids are read by the driver, which holds as many numbers as there are centroids times components; vectors are
never moved: tasks return one sum per cluster and component.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.scratch import require, store
from ebbtide.llm.shipping import ship_package

SCALE = 256
PIVOTS = 24
ROWS = 4096
# Squared distances of vectors with larger components would not fit a long.
LARGEST = 1 << 26
KEPT = "vec_id long, components array<long>, apex array<double>, blur double"
SUMS = "cluster int, place int, total long"
ASSIGNED = "vec_id long, cluster int, distance long"


class Simplex:
    """The pivots' simplex with its base point in the origin; rows of ``pivots`` are whole numbers.

    Pivots that lie in the plane of earlier ones (or nearly) tell nothing new and are left out.
    """

    def __init__(self, pivots: np.ndarray):
        chosen, corners = [pivots[0].astype(np.float64)], np.zeros((1, 0))
        for pivot in pivots[1:].astype(np.float64):
            self.pivots, self.corners = np.stack(chosen), corners
            self._prepare()
            apex, _ = self.project(pivot[None])
            reach = np.sqrt(((pivot - chosen[0]) ** 2).sum())
            if apex[0, -1] > 0.05 * reach:
                corners = np.pad(corners, ((0, 1), (0, 1)))
                corners[-1] = apex[0]
                chosen.append(pivot)
        self.pivots, self.corners = np.stack(chosen), corners
        self._prepare()

    def _prepare(self) -> None:
        base = self.corners[1:]
        self.inverse = np.linalg.inv(base) if len(base) else np.zeros((0, 0))
        self.squares = (base**2).sum(axis=1)
        # How much an error in the right-hand side of the triangular system can grow, with the error of the corners.
        self.growth = np.abs(self.inverse).sum(axis=1).max(initial=0.0) * (1 + np.abs(base).sum(axis=1).max(initial=0.0))

    def project(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Apex coordinates of each row (altitude last) and a bound on the length of their error."""
        x = points.astype(np.float64)
        squares = np.stack([((x - p) ** 2).sum(axis=1) for p in self.pivots], 1)
        n = self.pivots.shape[0]
        right = (squares[:, :1] - squares[:, 1:] + self.squares) / 2
        plane = right @ self.inverse.T
        rest = squares[:, 0] - (plane**2).sum(axis=1)
        altitude = np.sqrt(np.maximum(rest, 0))
        unit = 2.0**-50 * (n + points.shape[1])
        size = squares.max(axis=1) + self.squares.max(initial=0)
        off = unit * size * (1 + self.growth) ** 2 * np.sqrt(n)
        off = off / np.maximum(np.sqrt(size), 1) + unit * np.sqrt(size) * (1 + self.growth)
        square_off = 2 * np.sqrt(size) * off + off**2 + unit * size
        # A root moves by no more than the root of what its square moves by.
        return np.c_[plane, altitude], off + np.sqrt(square_off)


def bounds(apex: np.ndarray, blur: np.ndarray, centres: np.ndarray, centre_blur: np.ndarray):
    """Lower and upper bounds of the distances of all rows to all centres."""
    plane = np.zeros((len(apex), len(centres)))
    for k in range(apex.shape[1] - 1):
        plane += (apex[:, k, None] - centres[None, :, k]) ** 2
    up, down = apex[:, -1, None], centres[None, :, -1]
    slack = blur[:, None] + centre_blur[None]
    low, high = np.sqrt(plane + (up - down) ** 2), np.sqrt(plane + (up + down) ** 2)
    return np.maximum(low * (1 - 1e-12) - slack, 0), high * (1 + 1e-12) + slack


def nearest(vectors: np.ndarray, apex: np.ndarray, blur: np.ndarray, centroids: np.ndarray, simplex: Simplex):
    """Number of and exact squared distance to the nearest centroid of each row; of equal ones the smaller number."""
    centres, centre_blur = simplex.project(centroids)
    low, high = bounds(apex, blur, centres, centre_blur)
    row, number = np.nonzero(low <= high.min(axis=1, keepdims=True))
    exact = np.empty(len(row), np.int64)
    for i in range(0, len(row), ROWS):
        part = slice(i, i + ROWS)
        apart = vectors[row[part]] - centroids[number[part]]
        exact[part] = np.einsum("ij,ij->i", apart, apart)
    best = np.lexsort((number, exact, row))
    first = best[np.r_[True, row[best][1:] != row[best][:-1]]] if len(best) else best
    return number[first].astype(np.int32), exact[first]


def _whole_numbers(batch: pa.RecordBatch, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows with exactly ``dim`` finite components, and floor(256 x) of each component."""
    column = batch.column(1)
    lengths = np.array(column.value_lengths().fill_null(0))
    begins = np.cumsum(lengths) - lengths
    values = column.flatten()
    missing = np.array(values.is_null()) if len(values) else np.zeros(0, bool)
    values = np.array(values.fill_null(0)).astype(np.float64)
    rows = np.flatnonzero(lengths == dim)
    at = begins[rows][:, None] + np.arange(dim)
    good = ~(missing[at].any(axis=1) | ~np.isfinite(values[at]).all(axis=1))
    with np.errstate(over="ignore"):
        floors = np.floor(values[at[good]] * SCALE)
    if (np.abs(floors) > LARGEST).any():
        raise ValueError(f"a component beyond {LARGEST // SCALE} has squared distances that do not fit a long")
    return rows[good], floors.astype(np.int64)


def _lists(values: np.ndarray) -> pa.ListArray:
    ends = np.arange(len(values) + 1) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values.ravel()))


def _floored(dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, vectors = _whole_numbers(batch, dim)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows)), _lists(vectors)], ["vec_id", "components"]
            )

    return run


def _projected(simplex: Simplex, dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = np.array(batch.column(1).flatten()).reshape(-1, dim)
            apex, blur = simplex.project(vectors)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), _lists(apex), pa.array(blur)],
                ["vec_id", "components", "apex", "blur"],
            )

    return run


def _read(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, components, apexes and error bounds, some rows at a time."""
    for batch in batches:
        for i in range(0, batch.num_rows, ROWS):
            part = batch.slice(i, ROWS)
            vectors = np.array(part.column(1).flatten()).reshape(-1, dim)
            apex = np.array(part.column(2).flatten()).reshape(len(vectors), -1)
            yield part.column(0), vectors, apex, np.array(part.column(3))


def _sums(centroids: np.ndarray, simplex: Simplex):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, dim = centroids.shape
        for _, vectors, apex, blur in _read(batches, dim):
            number, _ = nearest(vectors, apex, blur, centroids, simplex)
            # Place ``dim`` holds the count.
            total = np.zeros((k, dim + 1), np.int64)
            np.add.at(total, number, np.c_[vectors, np.ones(len(vectors), np.int64)])
            used = np.flatnonzero(total[:, dim])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(used, dim + 1), pa.int32()),
                    pa.array(np.tile(np.arange(dim + 1), len(used)), pa.int32()),
                    pa.array(total[used].ravel()),
                ],
                ["cluster", "place", "total"],
            )

    return run


def _assigned(centroids: np.ndarray, simplex: Simplex):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, vectors, apex, blur in _read(batches, centroids.shape[1]):
            number, distance = nearest(vectors, apex, blur, centroids, simplex)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(number), pa.array(distance)], ["vec_id", "cluster", "distance"]
            )

    return run


def digest_of(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def cluster_vectors(
    vectors: DataFrame,
    clusters: int = 40,
    rounds: int = 5,
    dim: int = 64,
    salt: str = "2:",
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    pivots: int = PIVOTS,
) -> DataFrame:
    """``vec_id``, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia``, ``centroid``, ``centroid_sha256``.

    Kept are vectors of exactly ``dim`` components, none null or non-finite; a component x counts as floor(256 x).
    Centroids start as the ``clusters`` kept vectors with the smallest SHA-256 of salt and id (a null id adds nothing to
    the salt; rows with one id go by their components), fewer if fewer vectors are kept.  In each of ``rounds`` rounds
    every vector goes to the nearest one (squared Euclidean distance, ties to the smaller number) and every centroid with
    vectors becomes the exact floor of their mean.  Then all are assigned once more.  Repeated rows all count; other
    columns are not read; no kept vectors give no rows.  Components beyond 262,144 are an error.

    ``clusters``, ``dim`` and ``pivots`` bound what the driver and every task hold.  Sums are formed in each task and
    added by cluster and component, so a cluster with most of the vectors is no hot key.
    """
    require(vectors, id_col, vector_col)
    spark = vectors.sparkSession
    ship_package(spark)
    rows = vectors.select(
        F.col(f"`{id_col}`").cast("long").alias("vec_id"),
        F.col(f"`{vector_col}`").cast("array<double>").alias("vector"),
    )
    floored = store(rows.mapInArrow(_floored(dim), "vec_id long, components array<long>"), "floored")
    drawn = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    # As many rows as there are centroids; each task keeps no more than that.
    first = floored.withColumn("drawn", drawn).orderBy("drawn", "components").limit(clusters).collect()
    result = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long"
    result += ", centroid array<long>, centroid_sha256 string"
    if not first:
        return spark.createDataFrame([], result)
    centroids = np.array([r["components"] for r in first], np.int64)
    simplex = Simplex(centroids[:pivots])
    kept = store(floored.mapInArrow(_projected(simplex, dim), KEPT), "apexes")
    for _ in range(rounds):
        # Totals of all rows in exact decimals: clusters times components rows.
        totals = (
            kept.mapInArrow(_sums(centroids, simplex), SUMS)
            .groupBy("cluster", "place")
            .agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
            .collect()
        )
        table: dict[int, dict[int, int]] = {}
        for r in totals:
            table.setdefault(r["cluster"], {})[r["place"]] = int(r["total"])
        centroids = centroids.copy()
        for number, sums in table.items():
            centroids[number] = [sums[i] // sums[dim] for i in range(dim)]
    assigned = store(kept.mapInArrow(_assigned(centroids, simplex), ASSIGNED), "assigned")
    exact = F.sum(F.col("distance").cast("decimal(38,0)"))
    inertia = assigned.groupBy("cluster").agg(exact.alias("total")).collect()
    whole = sum(int(r["total"]) for r in inertia)
    described = [
        (r["cluster"], int(r["total"]), whole, centroids[r["cluster"]].tolist(), digest_of(centroids[r["cluster"]]))
        for r in inertia
    ]
    schema = "cluster int, cluster_inertia long, inertia long, centroid array<long>, centroid_sha256 string"
    # One row per cluster.
    return assigned.join(F.broadcast(spark.createDataFrame(described, schema)), "cluster").select(
        *(c.split(" ")[0] for c in result.split(", "))
    )
