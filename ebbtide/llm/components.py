"""Connected components of an edge table, by alternating star steps with one aggregation and one join each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.scratch import store

LARGE, SMALL = "large", "small"
# Edges that a file of a round holds, at least on average.
EDGES = 20_000


def _star(edges: DataFrame, kind: str, files: int) -> DataFrame:
    """Reconnect the neighbours of each node to the smallest one.

    ``large``: the larger neighbours of every node; ``small``: the node itself and its smaller neighbours.  Minima are
    pre-aggregated before the shuffle and written, so that both sides of the join are plain shuffles, which adaptive
    execution can split: a hub with very many neighbours is no hot task.  They are written to ``files`` files.
    """
    if kind == LARGE:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = store(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")).coalesce(files), "least")
        out = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = store(down.groupBy("a").agg(F.min("b").alias("m")).coalesce(files), "least")
        out = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        out = out.unionByName(least.select("a", F.col("m").alias("b")))
    return out.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges``: longs ``a``, ``b``.  Returns ``node``, ``component`` (smallest node reachable) of all linked nodes.

    Nodes without an edge to another node are not listed.  Every round is written to the shared folder; the rounds end
    when a pair of steps changes nothing, which takes about the logarithm of the longest path.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    edges = store(edges, "edges")
    seen = None
    while True:
        state = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.countDistinct("a")
        ).first()
        if state[0] == 0 or state == seen:
            break
        seen = state
        # Few edges in as many files as there are shuffle partitions would cost more to write than to connect.
        files = -(-state[0] // EDGES)
        edges = store(_star(edges, LARGE, files).coalesce(files), "large")
        edges = store(_star(edges, SMALL, files).coalesce(files), "small")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
