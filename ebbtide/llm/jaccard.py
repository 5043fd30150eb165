"""Exact Jaccard self-join of word shingle sets as a metric-space join: pivots, regions, windows, recursion.

Jaccard distance is a metric.  A document lies in the region of its nearest pivot, and by the triangle inequality a
partner within ``eps`` of it can lie no further from that pivot than a bounded window, so copying the documents of the
windows into the region makes the regions independent: each is joined on its own, recursively.

* First level.  Document pivots cannot part a corpus: two unrelated texts share nothing, so nearly all documents are at
  distance 1 from every pivot and inside every window.  The pivots of this level are single shingles, in one global
  order.  The nearest pivot of a set (equal distances are decided by the order) is its first shingle.  If x and y are
  within ``eps``, then |y \\ x| is at most ``w(y) = |y| - ceil((1 - eps) |y|)``; of the pivots before the first one they
  share, y can hold at most ``w(y)``.  So y is copied into the regions of its first ``w(y) + 1`` shingles and no other.
  With ``SHARED`` - 1 shingles more, partners meet in ``SHARED`` regions (or in as many as they must share at all), so a
  pair that meets less often is dropped before its sets are looked at.  Shingles that a count-min sketch calls frequent
  come last in the order, so almost all regions are small.  The sketch tells more: a shingle that it counts once is in no
  other document.  A document with more than ``w`` of them is at a distance over ``eps`` from every other one and is in
  no region; of the others the number bounds what a pair can share, and so how near it can be.
* Second level.  The documents of the large regions stand once each, and their shingles are counted among them exactly,
  whatever the sketch took for frequent.  The same windows apply in the order of these counts; a shingle that no other
  one of these documents has is no pivot.  A document's place in the order bounds what it shares with the partners of a
  region, because they share nothing that stands before the first region they meet in.
* Further levels.  What is still large holds groups of near copies.  There distances say much:
  documents are compared with a few document pivots, go to the region of the nearest one and to those within
  ``2 eps``, and are cut into rings of width ``eps`` around it, copied into the next ring.  Documents within ``eps`` of
  the pivot are linked with it and so with each other, and need no more comparisons among themselves: a ring whose
  documents (with those of the rings beside it) are all connected already is dropped.
* A level that does not halve the rows is the last.  Any set may be a pivot, also one that no document has: the shingles
  that most documents of a region hold.  Seen from there documents are short lists of differences, and their lengths and
  the first ones that two lists share say which pairs can be near (see ``templates``).

Links are decided with whole numbers from whole sets.  Sets are compared by 64-bit hashes of shingles and documents
with equal sets stand as one node, named by a 64-bit number; should two 128-bit digests of sets get one number, all are
numbered anew.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.llm import words as W
from ebbtide.llm.components import connected_components
from ebbtide.llm.scratch import require, store, text_key
from ebbtide.llm.sketch import Sketch, row_bits

# A shingle of at least so many documents is frequent; regions of others are smaller than this.
FREQUENT = 8
PIVOTS = 2
SHARED = 4
# A region of at most so many documents is compared pair by pair where components differ, in one row.
SMALL_REGION = 64
MEMBERS = (
    "doc_id long, order long, text_key long, n_shingles int, own int, node long, digest binary, "
    "rare array<long>, frequent array<long>"
)
SETS = "node long, shingles array<long>"


def shingle_sets(array: pa.Array, size: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For ranges of documents: first, last, sorted shingle hashes of all, and where each document's begin.

    ``size`` words make a shingle; a text with fewer words is one shingle, a text without words has none.
    """
    data, offsets = W.flat(array)
    for first, last in W.pieces(offsets):
        part = offsets[first : last + 1]
        words = W.split_words(data[part[0] : part[-1]], part - part[0], lower=True)
        hashes, owner = W.word_hashes(words), words.documents()
        starts = np.flatnonzero(W.window_starts(words, size))
        found, owners = [W.window_hashes(hashes, size)[starts]], [owner[starts]]
        for fewer in range(1, size):
            docs = np.flatnonzero(words.counts == fewer)
            if len(docs):
                found.append(W.mix(W.window_hashes(hashes, fewer)[words.offsets[docs]] + W.U64(fewer)))
                owners.append(docs)
        keys, owner = np.concatenate(found), np.concatenate(owners)
        order = np.lexsort((keys, owner))
        keys, owner = keys[order], owner[order]
        if len(keys):
            new = np.r_[True, (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])]
            keys, owner = keys[new], owner[new]
        yield first, last, keys, np.searchsorted(owner, np.arange(last - first + 1))


def _digests(keys: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """128 bits for each set: two sums of differently mixed hashes, with its size in the mix."""
    with np.errstate(over="ignore"):
        sizes = np.diff(begins).astype(W.U64)
        halves = []
        for salt in W.BASES:
            sums = np.r_[W.U64(0), np.cumsum(W.mix(keys * W.U64(salt) + W.U64(salt)))]
            halves.append(W.mix(sums[begins[1:]] - sums[begins[:-1]] + sizes * W.U64(salt)))
    return np.stack(halves, 1)


def _nodes(digests: np.ndarray, salt: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return W.signed(W.mix(digests[:, 0] ^ W.mix(digests[:, 1] + W.U64(salt))))


def _place(nodes: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Key of a node together with the document that stands for it."""
    with np.errstate(over="ignore"):
        return W.mix(nodes.astype(np.int64).view(W.U64) + W.mix(order.astype(np.int64).view(W.U64)))


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32)), pa.array(W.signed(values)))


def _members(shared, size: int, percent: int, salt: int):
    """Node, set size and the first shingles of each document, the rare and the frequent ones apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = shared.value
        for batch in batches:
            for first, last, keys, begins in shingle_sets(batch.column(3), size):
                sizes = np.diff(begins)
                frequent = sketch.reaches(keys, FREQUENT)
                owner = np.repeat(np.arange(len(sizes)), sizes)
                order = np.lexsort((frequent, owner))
                spare = sizes - -(-sizes * percent // 100)
                own = np.bincount(owner[~sketch.reaches(keys, 2)], minlength=len(sizes))
                # Documents that are far from all others have no place in any region.
                wanted = np.where(own > spare, 0, spare + SHARED)
                ahead = np.arange(len(keys)) - begins[:-1][owner] < wanted[owner]
                taken = order[ahead]
                part, cold = owner[taken], ~frequent[taken]
                digests = _digests(keys, begins)
                raw = digests.astype(">u8").tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first),
                        batch.column(1).slice(first, last - first),
                        batch.column(2).slice(first, last - first),
                        pa.array(sizes.astype(np.int32)),
                        pa.array(own.astype(np.int32)),
                        pa.array(_nodes(digests, salt)),
                        pa.array([raw[16 * i : 16 * i + 16] for i in range(len(sizes))], pa.binary()),
                        _lists(keys[taken][cold], np.bincount(part[cold], minlength=len(sizes))),
                        _lists(keys[taken][~cold], np.bincount(part[~cold], minlength=len(sizes))),
                    ],
                    ["doc_id", "order", "text_key", "n_shingles", "own", "node", "digest", "rare", "frequent"],
                )

    return run


def _sets_of(shared, size: int, salt: int):
    """Whole sets of the documents that stand for a wanted node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value
        for batch in batches:
            order = batch.column(0).to_numpy()
            for first, last, keys, begins in shingle_sets(batch.column(1), size):
                nodes = _nodes(_digests(keys, begins), salt)
                rows = np.flatnonzero(wanted.reaches(_place(nodes, order[first:last])) & (np.diff(begins) > 0))
                counts = np.diff(begins)[rows]
                ends = np.cumsum(counts)
                at = np.repeat(begins[:-1][rows] - (ends - counts), counts) + np.arange(counts.sum())
                yield pa.RecordBatch.from_arrays([pa.array(nodes[rows]), _lists(keys[at], counts)], ["node", "shingles"])

    return run


def _near(inter: Column, a: Column, b: Column, percent: int) -> Column:
    return inter * 100 >= (a + b - inter) * percent


def _may_be_near(p: Column, q: Column, percent: int) -> Column:
    """Whether two documents with sizes ``n`` and ``own`` shingles that no other one has can be near."""
    most = F.least(p["n"] - p["own"], q["n"] - q["own"])
    return _near(most.cast("long"), p["n"], q["n"], percent)


def _signature() -> list[Column]:
    """Two sums that tell apart regions with different documents."""
    return [F.sum(F.xxhash64("node", F.lit(i)).cast("decimal(38,0)")).alias(f"sum{i}") for i in (1, 2)]


def _one_of_each(spans: DataFrame) -> DataFrame:
    """``region`` and ``size`` of one of all regions with the same documents, as those of near copies often are."""
    return spans.groupBy("size", "sum1", "sum2").agg(F.min("region").alias("region")).select("region", "size")


class _Join:
    """State of one run: sets, links found so far, and what the next level has to look at."""

    def __init__(self, percent: int):
        self.sets: DataFrame | None = None
        self.percent = percent
        self.eps = 1 - percent / 100
        self.links: list[DataFrame] = []

    def measure(self, pairs: DataFrame, name: str) -> DataFrame:
        """``pairs`` (a, b), distinct, with ``distance`` and ``near``; near ones become links."""
        left = self.sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
        right = self.sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
        inter = F.size(F.array_intersect("x", "y")).cast("long")
        sizes = F.size("x").cast("long"), F.size("y").cast("long")
        both = pairs.join(left, "a").join(right, "b").select(
            "a", "b", inter.alias("i"), sizes[0].alias("n"), sizes[1].alias("m")
        )
        measured = store(
            both.select(
                "a",
                "b",
                (1 - F.col("i") / (F.col("n") + F.col("m") - F.col("i"))).alias("distance"),
                _near(F.col("i"), F.col("n"), F.col("m"), self.percent).alias("near"),
            ),
            name,
        )
        self.links.append(measured.where("near").select("a", "b"))
        return measured

    def labels(self) -> DataFrame:
        """``node`` and ``component`` by the links so far, which from then on stand for them."""
        labels = store(connected_components(reduce(DataFrame.unionByName, self.links)), "labels")
        self.links = [labels.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))]
        return labels

    def small_pairs(
        self, regions: DataFrame, *more: str, also: Callable[[Column, Column], Column] | None = None
    ) -> DataFrame:
        """Pairs ``p``, ``q`` of members of each region that can be near (and fulfil ``also``); regions are bounded.

        Only pairs that pass leave the expression over a region's list.
        """
        member = F.struct("node", "n", "own", *more)
        members = regions.groupBy("region").agg(F.sort_array(F.collect_list(member)).alias("m")).where("size(m) > 1")

        def fits(p: Column, q: Column) -> Column:
            near = (p["node"] != q["node"]) & _may_be_near(p, q, self.percent)
            return near if also is None else also(p, q) & near

        def partners(p: Column, i: Column) -> Column:
            later = F.filter(F.slice("m", i + 2, F.size("m")), lambda q: fits(p, q))
            return F.transform(later, lambda q: F.struct(p.alias("p"), q.alias("q")))

        return members.select(F.explode(F.flatten(F.transform("m", partners))).alias("pair")).select("pair.p", "pair.q")

    def met_often(self, rare: DataFrame) -> DataFrame:
        """Pairs that meet in as many regions of rare shingles as partners must.

        Shingles that both could share among their frequent ones are taken as shared.
        """
        must = F.ceil(F.greatest("p.n", "q.n") * self.percent / 100)
        need = F.least(F.lit(SHARED), must) - F.least("p.f", "q.f")
        met = self.small_pairs(rare, "f").select(
            F.col("p.node").alias("a"), F.col("q.node").alias("b"), need.cast("int").alias("need")
        )
        met = met.groupBy("a", "b").agg(F.count(F.lit(1)).alias("met"), F.first("need").alias("need"))
        return met.where("met >= need").select("a", "b")

    def apart(self, regions: DataFrame) -> DataFrame:
        """Distinct pairs inside regions whose documents are not connected yet."""
        pairs = self.small_pairs(regions, "label", also=lambda p, q: p["label"] != q["label"])
        return pairs.select(F.col("p.node").alias("a"), F.col("q.node").alias("b")).distinct()

    def labelled(self, rows: DataFrame, labels: DataFrame) -> DataFrame:
        """``rows`` with the ``label`` of each node: its component, or itself."""
        rows = rows.join(labels.select("node", F.col("component").alias("label")), "node", "left")
        return rows.withColumn("label", F.coalesce("label", "node"))

    def windows(self, nodes: DataFrame) -> DataFrame | None:
        """The first level again over ``nodes`` (node), in the order of the exact counts of shingles among them.

        Small regions are compared; returns the rows of the large ones (region, node, n, own, label).
        """
        labels = self.labels()
        size = F.size("shingles")
        held = self.sets.join(nodes, "node", "left_semi").select("node", size.alias("n"), F.explode("shingles").alias("shingle"))
        counts = store(held.groupBy("shingle").agg(F.count(F.lit(1)).alias("count")).where("count > 1"), "counts")
        shared = held.join(counts, "shingle").groupBy("node").agg(
            F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("count", "shingle"))).alias("shared")
        )
        own, spare = F.col("n") - F.size("shared"), F.floor(F.col("n") * (100 - self.percent) / 100).cast("int")
        ahead = shared.select("node", "n", own.alias("own"), "shared", (spare - own + 1).alias("ahead")).where("ahead > 0")
        first = F.slice("shared", F.lit(1), F.col("ahead"))
        placed = ahead.select("node", "n", "own", F.posexplode(first).alias("i", "s"))
        placed = placed.select(F.col("s.shingle").alias("region"), "node", "n", "own", (F.col("own") + F.col("i")).alias("at"))
        placed = store(self.labelled(placed, labels), "windows")
        spans = placed.groupBy("region").agg(
            F.count(F.lit(1)).alias("size"), F.min("label").alias("low"), F.max("label").alias("high"), *_signature()
        )
        open_ = store(spans.where("low <> high"), "window-sizes")
        small = placed.join(open_.where(F.col("size") <= SMALL_REGION).select("region"), "region", "left_semi")
        self.measure(self.apart(small.select("region", "node", "n", F.col("at").alias("own"), "label")), "window-pairs")
        # Places differ between regions with the same documents, own shingles do not.
        large = placed.join(_one_of_each(open_.where(F.col("size") > SMALL_REGION)).select("region"), "region", "left_semi")
        large = store(large.select("region", "node", "n", "own", "label"), "large")
        return None if large.isEmpty() else large

    def templates(self, regions: DataFrame) -> None:
        """Links and compares the documents of ``regions`` that pivots do not part, however many they are.

        The pivot is the majority set of a region, the shingles that more than half of its documents hold.  A document
        becomes its difference d from that set, lost and gained shingles alike, so two documents differ in
        ``|d(x)| + |d(y)| - 2 |d(x) and d(y)|`` shingles, and are near when that is at most c (n + m) for the c of
        ``percent``.  With e = |d| - c n: if e(x) + e(y) <= 0 they are near for certain, and then both are near the document
        with the smallest e, so one link a document is enough.  All other near pairs share at least (e(x) + e(y)) / 2
        elements of d.  In a common order, rare ones first, the first element they share must leave that many to both.
        No element of d stands in more than half of the documents.

        Regions that share documents are taken as one, named by their smallest node, so that a document is listed once:
        the step is exact in any set of documents, and a set that holds several regions finds all their pairs.
        """
        plus, minus = 100 + self.percent, 100 - self.percent
        anchors = regions.groupBy("region").agg(F.min("node").alias("b"))
        joined = connected_components(regions.select("region", F.col("node").alias("a")).join(anchors, "region"))
        regions = store(
            regions.select("node").distinct().join(joined, "node", "left")
            .select(F.coalesce("component", "node").alias("region"), "node"),
            "merged-regions",
        )
        held = regions.select("region", "node").join(self.sets, "node")
        held = store(held.select("region", "node", "shingles"), "template-sets")
        members = held.groupBy("region").agg(F.count(F.lit(1)).alias("members"))
        counts = held.select("region", F.explode("shingles").alias("shingle")).groupBy("region", "shingle")
        counts = counts.agg(F.count(F.lit(1)).alias("count")).join(members, "region")
        counts = store(counts.where("count > 1 AND count < members OR 2 * count > members"), "template-counts")
        major = F.col("count") * 2 > F.col("members")
        common = counts.where(major).groupBy("region").agg(F.collect_list("shingle").alias("common"))
        lost, gained = F.array_except("common", "shingles"), F.array_except("shingles", "common")
        apart = held.join(store(common, "templates"), "region", "left").withColumn(
            "common", F.coalesce("common", F.array().cast("array<long>"))
        )
        apart = apart.select("region", "node", F.size("shingles").alias("n"), F.concat(lost, gained).alias("d"))
        excess = plus * F.size("d").cast("long") - minus * F.col("n").cast("long")
        apart = store(apart.withColumn("e", excess), "differences")
        best = apart.groupBy("region").agg(F.min(F.struct("e", "node")).alias("best"))
        best = store(best.select("region", F.col("best.e").alias("least"), F.col("best.node").alias("head")), "heads")
        reached = apart.select("region", "node", "e").join(best, "region")
        self.links.append(
            store(
                reached.where("e + least <= 0 AND node <> head").select(F.col("node").alias("a"), F.col("head").alias("b")),
                "certain",
            )
        )
        labels = self.labels()
        # How many documents have the element in their d; one that only one has is never shared.
        held_by = F.when(major, F.col("members") - F.col("count")).otherwise(F.col("count"))
        shared_by = counts.select("region", "shingle", held_by.alias("f")).where("f > 1")
        listed = apart.select("region", "node", "n", "e", F.size("d").alias("size"), F.explode("d").alias("shingle"))
        shared = listed.join(shared_by, ["region", "shingle"]).groupBy("region", "node").agg(
            *(F.first(c).alias(c) for c in ("n", "e", "size")),
            F.sort_array(F.collect_list(F.struct("f", "shingle"))).alias("shared"),
        )
        placed = shared.select("region", "node", "n", "e", F.size("shared").alias("m"), F.posexplode("shared").alias("i", "s"))
        # Elements that only one document has come first, so what is left from here on is m - i.
        placed = placed.select("region", "s.shingle", "node", "n", "e", (F.col("m") - F.col("i")).alias("rest"))
        placed = placed.join(best.select("region", "least"), "region").where(F.col("e") + F.col("least") <= 2 * plus * F.col("rest"))
        placed = store(self.labelled(placed.drop("least"), labels), "elements")
        spans = placed.groupBy("region", "shingle").agg(F.min("label").alias("low"), F.max("label").alias("high"))
        open_ = store(spans.where("low <> high").select("region", "shingle"), "open-elements")
        placed = placed.join(open_, ["region", "shingle"], "left_semi")
        p, q = placed.alias("p"), placed.alias("q")
        met = p.join(q, ["region", "shingle"]).where(
            (F.col("p.node") < F.col("q.node"))
            & (F.col("p.label") != F.col("q.label"))
            & (100 * F.least("p.n", "q.n") >= self.percent * F.greatest("p.n", "q.n"))
            & (F.col("p.e") + F.col("q.e") <= 2 * plus * F.least("p.rest", "q.rest"))
        )
        pairs = met.select(F.col("p.node").alias("a"), F.col("q.node").alias("b")).distinct()
        self.measure(store(pairs, "template-pairs"), "template-distances")

    def level(self, regions: DataFrame, level: int) -> DataFrame | None:
        """One level over ``regions`` (region, node, n, own), a row per document and region; the rows of the next level."""
        # The same few documents are pivots in all regions of a group of near copies, so distances are shared.
        chance = F.xxhash64("node", F.lit(level))
        pivots = regions.groupBy("region", F.pmod(chance, F.lit(PIVOTS)).alias("k")).agg(
            F.min(F.struct(chance.alias("h"), "node")).alias("p")
        )
        pivots = store(pivots.select("region", F.col("p.node").alias("pivot")), "pivots")
        near_pivots = store(
            regions.join(pivots, "region").where("node <> pivot").select("region", "node", "n", "own", "pivot"), "to-pivots"
        )
        pairs = near_pivots.select(F.col("node").alias("a"), F.col("pivot").alias("b")).distinct()
        measured = self.measure(pairs, "pivot-distances")
        labels = self.labels()
        # Pivots were compared with their whole region and leave it.
        rest = near_pivots.join(pivots.withColumnRenamed("pivot", "node"), ["region", "node"], "left_anti")
        rest = rest.join(
            measured.select(F.col("a").alias("node"), F.col("b").alias("pivot"), "distance"), ["node", "pivot"]
        )
        nearest = store(rest.groupBy("region", "node").agg(F.min("distance").alias("nearest")), "nearest")
        ring = F.floor(F.col("distance") / self.eps).cast("int")
        # A little more than the window: a rounded distance must not cut a document off.
        inside = (
            rest.join(nearest, ["region", "node"])
            .where(F.col("distance") <= F.col("nearest") + 2 * self.eps + 1e-9)
            .select("region", "pivot", "node", "n", "own", ring.alias("ring"), (F.col("distance") / self.eps).alias("at"))
        )
        # Rings overlap by the next one; at a rounded border a document counts as on both sides.
        rings = inside.select(
            "*",
            F.explode(
                F.array_distinct(
                    F.array(
                        F.floor(F.col("at") - 1e-6).cast("int"),
                        "ring",
                        (F.col("ring") + 1),
                        F.floor(F.col("at") + 1e-6).cast("int") + 1,
                    )
                )
            ).alias("part"),
        )
        named = rings.select(F.xxhash64("region", "pivot", "part").alias("region"), "node", "n", "own").distinct()
        named = store(self.labelled(named, labels), "rings")
        spans = named.groupBy("region").agg(
            F.count(F.lit(1)).alias("size"),
            F.min("label").alias("low"),
            F.max("label").alias("high"),
            *_signature(),
        )
        open_ = store(_one_of_each(spans.where("low <> high")), "open")
        small = named.join(open_.where(F.col("size") <= SMALL_REGION).select("region"), "region", "left_semi")
        self.measure(self.apart(small), "ring-pairs")
        large = named.join(open_.where(F.col("size") > SMALL_REGION).select("region"), "region", "left_semi")
        large = store(large.select("region", "node", "n", "own", "label"), "large")
        return None if large.isEmpty() else large


def near_duplicates(
    docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", salt: int = 0
) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``, ``kept``, ``text_key`` of each row.

    Letters A-Z are lowered; a set holds the distinct shingles of ``size`` words, or the whole text if it has fewer.
    Two rows are linked if ``100 |x and y| >= percent |x or y|``; ``component_id`` is the smallest id reachable by links.
    Null and empty texts have no shingles and no links: their component is their own id.  A null id is larger than every
    id; a component of null ids only has a null id.  ``kept`` marks one row of each component, the one with the smallest
    id (of equal ids the one with the smallest node; rows repeated with one id and set are all marked).  ``text_key`` is a hash of the text.  Other
    columns are not read.

    ``percent`` is 50 to 99.  Passes over the texts: their length, the sketch, the members, the sets of candidates.
    """
    require(docs, id_col, text_col)
    if not 50 <= percent <= 99:
        raise ValueError("percent must be 50 to 99")
    spark: SparkSession = docs.sparkSession
    broadcast = spark.sparkContext.broadcast
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(id_col).cast("long"), F.lit((1 << 63) - 1)).alias("order"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        text_key(text_col).alias("text_key"),
    )
    texts = rows.select("text")
    letters = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    shingles = Sketch(row_bits(letters / 6), 2, 2, FREQUENT).gather(
        texts, lambda batch: (keys for _, _, keys, _ in shingle_sets(batch.column(0), size))
    )
    members = store(
        rows.select("doc_id", "order", "text_key", "text").mapInArrow(
            _members(broadcast(shingles), size, percent, salt), MEMBERS
        ),
        "members",
    )
    # One document stands for all with its set, the first; the others are narrow rows until the end.
    who = F.struct("order", "text_key")
    classes = members.where("n_shingles > 0").groupBy("node").agg(
        F.min(who).alias("who"), F.min("digest").alias("low"), F.max("digest").alias("high")
    )
    classes = store(classes, "classes")
    if not classes.where("low <> high").isEmpty():
        return near_duplicates(docs, size, percent, id_col, text_col, salt + 1)
    firsts = members.join(classes.select("node", "who"), "node").where(who == F.col("who"))
    firsts = firsts.where(F.size("rare") + F.size("frequent") > 0)
    near = firsts.select("node", "order", F.col("n_shingles").alias("n"), "own", "rare", "frequent")
    near = store(near.dropDuplicates(["node"]), "near")
    # A rare shingle stands in fewer than FREQUENT documents, so its region is a short list.
    rare = near.select(F.explode("rare").alias("region"), "node", "n", "own", F.size("frequent").alias("f"))
    frequent = store(near.select(F.explode("frequent").alias("region"), "node", "n", "own"), "frequent")
    sizes = frequent.groupBy("region").agg(F.count(F.lit(1)).alias("size"), *_signature()).where("size > 1")
    sizes = store(_one_of_each(sizes), "sizes")
    tiny = frequent.join(sizes.where(F.col("size") <= SMALL_REGION).select("region"), "region", "left_semi")
    large = frequent.join(sizes.where(F.col("size") > SMALL_REGION).select("region"), "region", "left_semi")
    large = store(large.select("node").distinct(), "large")

    run = _Join(percent)
    first_pairs = run.met_often(rare).unionByName(run.apart(tiny.withColumn("label", F.col("node"))))
    first_pairs = store(first_pairs.distinct(), "pairs")
    nodes = first_pairs.select(F.col("a").alias("node")).unionByName(first_pairs.select(F.col("b").alias("node")))
    nodes = nodes.unionByName(large).distinct()
    nodes = store(near.select("node", "order").join(nodes, "node", "left_semi"), "wanted")
    wanted = Sketch(row_bits(8 * nodes.count()), 1, 1).gather(
        nodes, lambda batch: iter([_place(batch.column(0).to_numpy(), batch.column(1).to_numpy())])
    )
    sets = rows.select("order", "text").mapInArrow(_sets_of(broadcast(wanted), size, salt), SETS)
    run.sets = store(sets.groupBy("node").agg(F.first("shingles").alias("shingles")), "sets")
    run.measure(first_pairs, "distances")
    level, regions = 0, None if large.isEmpty() else run.windows(large)
    while regions is not None:
        deeper = run.level(regions, level)
        if deeper is not None and 2 * deeper.count() > regions.count():
            run.templates(deeper)
            deeper = None
        level, regions = level + 1, deeper
    labels = run.labels()
    verdict = members.select("doc_id", "order", "text_key", "n_shingles", "node").join(labels, "node", "left")
    # Sets without a link stand for their copies; rows without shingles stand alone.
    verdict = verdict.withColumn("component", F.coalesce("component", "node"))
    verdict = store(verdict, "verdict")
    linked = verdict.where("n_shingles > 0")
    best = store(linked.groupBy("component").agg(F.min(F.struct("order", "node")).alias("best")), "best")
    alone = verdict.where("n_shingles = 0").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"), "text_key"
    )
    grouped = linked.join(best, "component").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("best.order") < (1 << 63) - 1, F.col("best.order")).alias("component_id"),
        (F.struct("order", "node") == F.col("best")).alias("kept"),
        "text_key",
    )
    return grouped.unionByName(alone).withColumn("n_shingles", F.col("n_shingles").cast("long"))
