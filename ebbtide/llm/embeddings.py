"""Near-duplicate vectors by cosine: int8 tile products with rigorous error bounds, exact recomputation behind them.

A unit vector x is stored as ``s q`` with whole numbers q of one byte and ``e = |x - s q|``.  For two of them

    |x y - s q t r| <= |x - s q| |y| + |s q| |y - t r| <= e + (1 + e) f,

so a tile of products of the bytes (exact in single precision up to the scales, whose rounding is bounded too) shows
which pairs can reach the threshold; only those are computed again from the original components in double precision.

Equal vectors are one class with a multiplicity.  Every pair of blocks of classes is one tile: the work is quadratic in
the number of distinct vectors, with a small factor, and a task holds two blocks.  A tile returns at most one count and
one edge per vector, never its pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.llm.components import connected_components
from ebbtide.llm.scratch import require, store

BLOCK = 4096
STEP = 1024
DENSE = 0.02
PAIRS = 1 << 17
NO_ID = (1 << 63) - 1
QUANTISED = "order long, vec_id long, node binary, dim int, vector binary, codes binary, scale double, error double"
PACKED = "dim int, block int, nodes binary, weights binary, vectors binary, codes binary, scales binary, errors binary"
FOUND = "a binary, b binary, links long"


def quantise(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes, scales and error bounds of the unit vectors along ``vectors`` (rows of doubles, none of them zero)."""
    # The largest component is taken out first, so that neither huge nor tiny components leave the range of doubles.
    unit = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    unit /= np.sqrt(np.einsum("ij,ij->i", unit, unit))[:, None]
    scales = np.abs(unit).max(axis=1) / 127
    codes = np.rint(unit / scales[:, None]).astype(np.int8)
    rest = unit - codes * scales[:, None]
    # Room for the rounding of these very computations.
    return codes, scales, np.sqrt(np.einsum("ij,ij->i", rest, rest)) + 1e-12 * vectors.shape[1]


def _quantise_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = batch.column(2)
        lengths = np.array(column.value_lengths().fill_null(0))
        begins = np.r_[0, np.cumsum(lengths)]
        values = column.flatten()
        missing = np.array(values.is_null()) if len(values) else np.zeros(0, bool)
        values = np.array(values.fill_null(0)).astype(np.float64)
        for dim in np.unique(lengths):
            rows = np.flatnonzero(lengths == dim)
            at = begins[rows][:, None] + np.arange(dim)
            vectors, bad = values[at], missing[at].any(axis=1)
            bad |= ~np.isfinite(vectors).all(axis=1) | ~(vectors != 0).any(axis=1)
            good = ~bad
            n = len(rows)
            codes, scales, errors = np.zeros((n, dim), np.int8), np.zeros(n), np.zeros(n)
            if good.any():
                codes[good], scales[good], errors[good] = quantise(vectors[good])
            raw = [v.tobytes() if ok else None for v, ok in zip(vectors, good)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows)),
                    batch.column(1).take(pa.array(rows)),
                    pa.array([None if r is None else hashlib.md5(r).digest() for r in raw], pa.binary()),
                    pa.array(np.full(n, dim, np.int32)),
                    pa.array(raw, pa.binary()),
                    pa.array([c.tobytes() for c in codes], pa.binary()),
                    pa.array(scales),
                    pa.array(errors),
                ],
                ["order", "vec_id", "node", "dim", "vector", "codes", "scale", "error"],
            )


def _pack(key: tuple, table: pa.Table) -> pa.Table:
    def joined(name: str) -> bytes:
        return b"".join(table.column(name).to_pylist())

    return pa.Table.from_pylist(
        [
            {
                "dim": key[0].as_py(),
                "block": key[1].as_py(),
                "nodes": joined("node"),
                "weights": np.array(table.column("weight"), "<i8").tobytes(),
                "vectors": joined("vector"),
                "codes": joined("codes"),
                "scales": np.array(table.column("scale"), "<f8").tobytes(),
                "errors": np.array(table.column("error"), "<f8").tobytes(),
            }
        ],
        schema=pa.schema(
            [("dim", pa.int32()), ("block", pa.int32())]
            + [(n, pa.binary()) for n in ("nodes", "weights", "vectors", "codes", "scales", "errors")]
        ),
    )


class _Block:
    def __init__(self, row: dict, dim: int):
        self.nodes = row["nodes"]
        self.weights = np.frombuffer(row["weights"], "<i8")
        self.vectors = np.frombuffer(row["vectors"], "<f8").reshape(-1, dim)
        self.codes = np.frombuffer(row["codes"], np.int8).reshape(-1, dim)
        self.scales = np.frombuffer(row["scales"], "<f8")
        self.errors = np.frombuffer(row["errors"], "<f8")

    def node(self, i: int) -> bytes:
        return self.nodes[16 * i : 16 * i + 16]


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Row by row, in double precision."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    y = y / np.abs(y).max(axis=1, keepdims=True)
    dot = np.einsum("ij,ij->i", x, y)
    return dot / np.sqrt(np.einsum("ij,ij->i", x, x) * np.einsum("ij,ij->i", y, y))


def linked_pairs(a: _Block, b: _Block, same: bool, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of the tile with a cosine of at least ``threshold``, a part at a time."""
    dim = a.codes.shape[1]
    # Single precision holds the sums of products of bytes to a few units of 2^-24 per component.
    slack = (dim + 4) * 2.0**-22 + 1e-9
    worst = b.errors.max(initial=0)
    bound = (threshold - a.errors - (1 + a.errors) * worst - slack) / a.scales
    right = (b.codes * b.scales[:, None]).astype(np.float32)
    for i in range(0, len(a.codes), STEP):
        left = a.codes[i : i + STEP].astype(np.float32)
        for j in range(i if same else 0, len(b.codes), STEP):
            product = left @ right[j : j + STEP].T
            hit = np.flatnonzero(product.ravel() >= np.repeat(bound[i : i + STEP], product.shape[1]).astype(np.float32))
            x, y = np.divmod(hit, product.shape[1])
            x, y = x + i, y + j
            if same:
                x, y = x[x < y], y[x < y]
            for k in range(0, len(x), PAIRS):
                p, q = x[k : k + PAIRS], y[k : k + PAIRS]
                near = cosines(a.vectors[p], b.vectors[q]) >= threshold
                yield p[near], q[near]


class _Forest:
    """Connectivity of the vectors of a tile."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def _roots(self) -> None:
        while True:
            up = self.parent[self.parent]
            if (up == self.parent).all():
                return
            self.parent = up

    def join(self, x: np.ndarray, y: np.ndarray) -> None:
        while len(x):
            p, q = self.parent[x], self.parent[y]
            low, high = np.minimum(p, q), np.maximum(p, q)
            apart = low != high
            x, y, low, high = x[apart], y[apart], low[apart], high[apart]
            np.minimum.at(self.parent, high, low)
            self._roots()


def _tile(threshold: float):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        dim, i, j = (k.as_py() for k in key)
        rows = sorted(table.to_pylist(), key=lambda r: r["block"])
        blocks = [_Block(r, dim) for r in rows]
        a, b = blocks[0], blocks[-1]
        same, n = i == j, len(blocks[0].scales)
        shift = 0 if same else n
        links = np.zeros(n + (0 if same else len(b.scales)), np.int64)
        forest = _Forest(len(links))
        for x, y in linked_pairs(a, b, same, threshold):
            np.add.at(links, x, b.weights[y])
            np.add.at(links, y + shift, a.weights[x])
            forest.join(x, y + shift)

        def node(k: int) -> bytes:
            return a.node(k) if k < n else b.node(k - n)

        out = [{"a": node(k), "b": None, "links": int(links[k])} for k in np.flatnonzero(links).tolist()]
        inner = np.flatnonzero(forest.parent != np.arange(len(links))).tolist()
        out += [{"a": node(k), "b": node(int(forest.parent[k])), "links": None} for k in inner]
        return pa.Table.from_pylist(
            out, schema=pa.schema([("a", pa.binary()), ("b", pa.binary()), ("links", pa.int64())])
        )

    return run


def near_vectors(
    vectors: DataFrame, threshold: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding", block: int = BLOCK
) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id``, ``kept`` of each row.

    Two rows are linked if their cosine is at least ``threshold`` (above 0).  Null, empty and zero vectors and vectors
    with a null or non-finite component have no links, nor have vectors of different length with each other.
    ``component_id`` is the smallest id reachable by links; a null id is larger than every id, so a component of null
    ids only has a null id.  ``kept``: the row's id is its component's.  Repeated rows are linked with each other.
    Other columns are not read.
    """
    require(vectors, id_col, vector_col)
    spark: SparkSession = vectors.sparkSession
    vec_id = F.col(id_col).cast("long")
    rows = vectors.select(
        F.coalesce(vec_id, F.lit(NO_ID)).alias("order"),
        vec_id.alias("vec_id"),
        F.col(vector_col).cast("array<double>").alias("vector"),
    )
    quantised = store(rows.mapInArrow(_quantise_batches, QUANTISED), "quantised")
    members = quantised.select("order", "vec_id", "node")
    valid = quantised.where("node IS NOT NULL")
    classes = valid.groupBy("node", "dim").agg(
        F.count(F.lit(1)).alias("weight"), *(F.first(c).alias(c) for c in ("vector", "codes", "scale", "error"))
    )
    classes = store(classes, "classes")
    # One count for each length of vectors in the table.
    sizes = {r["dim"]: r["count"] for r in classes.groupBy("dim").count().collect()}
    blocks = {dim: -(-count // block) for dim, count in sizes.items()}
    if not blocks:
        return members.select(
            "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept")
        )
    count_of = F.create_map(*(F.lit(x).cast("int") for pair in blocks.items() for x in pair))
    packed = (
        classes.withColumn("block", F.pmod(F.xxhash64("node"), count_of[F.col("dim")]).cast("int"))
        .groupBy("dim", "block")
        .applyInArrow(_pack, PACKED)
    )
    packed = store(packed, "blocks")
    partner = F.explode(F.sequence(F.lit(0), count_of[F.col("dim")] - 1))
    tiles = packed.withColumn("partner", partner).select(
        "*", F.least("block", "partner").alias("i"), F.greatest("block", "partner").alias("j")
    )
    found = store(tiles.groupBy("dim", "i", "j").applyInArrow(_tile(threshold), FOUND), "found")
    labels = store(connected_components(found.where("b IS NOT NULL").select("a", "b")), "labels")
    links = found.where("links IS NOT NULL").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    first = valid.groupBy("node").agg(F.min("order").alias("first"))
    nodes = (
        classes.select("node", "weight")
        .join(first, "node")
        .join(links, "node", "left")
        .join(labels, "node", "left")
        .select(
            "node",
            (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            "first",
            F.coalesce("component", "node").alias("component"),
        )
    )
    nodes = store(nodes, "nodes")
    least = store(nodes.groupBy("component").agg(F.min("first").alias("least")), "least")
    nodes = store(nodes.join(least, "component").select("node", "n_links", "least"), "verdict")
    linked = members.where("node IS NOT NULL").join(nodes, "node")
    component = F.when(F.col("least") < NO_ID, F.col("least"))
    alone = members.where("node IS NULL").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept")
    )
    return linked.select(
        "vec_id", "n_links", component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept")
    ).unionByName(alone)
