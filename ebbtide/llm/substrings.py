"""Removal of word sequences that repeat across documents, with a count-min prefilter.

A first pass sketches how often window keys occur; merged sketches overestimate and never underestimate.  A second
pass groups exactly, by two independent hashes of the words, only those windows whose estimate says "repeated"; so none
is lost, and a unique window is grouped only by the sketch's error.

The sketched key of a window is its minimiser: the smallest hash among the runs of ``ANCHOR`` words in it.  Equal
windows have equal minimisers, and neighbouring windows share them, so the sketch takes in about one key for four words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.llm import words as W
from ebbtide.llm.scratch import require, store
from ebbtide.llm.sketch import Sketch, row_bits

WINDOW, ANCHOR = 13, 6
DEPTH = 3
# Windows of a segment: on average and at most.
MEAN, LONGEST = 16, 64
SEGMENTS = (
    "s1 long, s2 long, order long, spare long, mark long, at int, size int, keys array<long>, checks array<int>"
)
NO_ID = np.iinfo(np.int64).max


def _minimisers(hashes: np.ndarray, starts: np.ndarray, window: int, anchor: int) -> np.ndarray:
    """Minimiser of the window at each word of ``starts``."""
    runs = W.window_hashes(hashes, anchor, W.BASES[0])
    least = runs.copy()
    span = window - anchor
    for i in range(1, span + 1):
        np.minimum(least[: len(runs) - i], runs[i:], out=least[: len(runs) - i])
    return least[starts]


def _pieces(array: pa.Array) -> Iterator[tuple[int, int, W.Words]]:
    data, offsets = W.flat(array)
    for first, last in W.pieces(offsets):
        part = offsets[first : last + 1]
        yield first, last, W.split_words(data[part[0] : part[-1]], part - part[0])


def _minimiser_keys(window: int, anchor: int):
    def keys_of(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for _, _, words in _pieces(batch.column(0)):
            starts = np.flatnonzero(W.window_starts(words, window))
            if len(starts):
                keys = _minimisers(W.word_hashes(words), starts, window, anchor)
                # A document counts a run of windows with one minimiser once.
                owner = words.documents()[starts]
                yield keys[np.r_[True, (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])]]

    return keys_of


def _segments(shared, window: int, anchor: int):
    """Segments of consecutive windows that the sketch calls repeated, with the two hashes of every window.

    A segment ends where the windows do, before a window whose hash says so, and after ``LONGEST`` windows.  The cuts
    depend on the words alone, so documents that share a passage have most of its segments in common.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = shared.value
        for batch in batches:
            ids = [batch.column(i).to_numpy() for i in range(3)]
            for first, last, words in _pieces(batch.column(3)):
                starts = np.flatnonzero(W.window_starts(words, window))
                if not len(starts):
                    continue
                hashes = W.word_hashes(words)
                starts = starts[sketch.reaches(_minimisers(hashes, starts, window, anchor))]
                if not len(starts):
                    continue
                key = W.window_hashes(hashes, window)[starts]
                check = W.window_hashes(W.word_hashes(words, W.BASES[1]), window, W.BASES[0])[starts] >> W.U64(32)
                owner = words.documents()[starts]
                cut = np.r_[True, (np.diff(starts) != 1) | (np.diff(owner) != 0)] | (key % W.U64(MEAN) == 0)
                begin = np.maximum.accumulate(np.where(cut, np.arange(len(cut)), 0))
                cut |= (np.arange(len(cut)) - begin) % LONGEST == 0
                begins = np.flatnonzero(cut)
                sizes = np.diff(np.r_[begins, len(cut)])
                place = (np.arange(len(cut)) - np.repeat(begins, sizes)).astype(W.U64)
                with np.errstate(over="ignore"):
                    names = [
                        W.mix(np.add.reduceat(W.mix(x + place * W.U64(salt)), begins) + sizes.astype(W.U64))
                        for x, salt in ((key, W.BASES[0]), (key ^ check, W.BASES[1]))
                    ]
                at = owner[begins]
                offsets = pa.array(np.r_[begins, len(cut)].astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(pa.array(W.signed(n)) for n in names),
                        *(pa.array(x[at + first]) for x in ids),
                        pa.array((starts[begins] - words.offsets[at]).astype(np.int32)),
                        pa.array(sizes.astype(np.int32)),
                        pa.ListArray.from_arrays(offsets, pa.array(W.signed(key))),
                        pa.ListArray.from_arrays(offsets, pa.array(check.astype(np.uint32).view(np.int32))),
                    ],
                    ["s1", "s2", "order", "spare", "mark", "at", "size", "keys", "checks"],
                )

    return run


def _windows(hits: np.ndarray, mark: int, ranges: list[dict], key: np.ndarray, within: np.ndarray) -> np.ndarray:
    """Which windows of one document go, given its window hashes and their places in the document."""
    bad = np.isin(key, hits)
    for r in ranges:
        if r["mark"] == mark:
            a, b = np.searchsorted(within, [r["at"], r["at"] + r["size"]])
            bad[a:b] = True
    return bad


def _remove(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, ranges, marks = batch.column(1), batch.column(2), batch.column(3)
            touched = np.array(found.value_lengths().fill_null(0)) + np.array(ranges.value_lengths().fill_null(0)) > 0
            for first, last, words in _pieces(batch.column(0)):
                drop = np.zeros(len(words.starts) + 1, np.int64)
                starts = np.flatnonzero(W.window_starts(words, window))
                docs = np.flatnonzero(touched[first:last])
                if len(starts) and len(docs):
                    key = W.window_hashes(W.word_hashes(words), window)[starts]
                    owner = words.documents()[starts]
                    bad = np.zeros(len(starts), bool)
                    for doc in docs:
                        a, b = np.searchsorted(owner, [doc, doc + 1])
                        row = int(first + doc)
                        hits = np.array(found[row].values).astype(np.int64).view(W.U64)
                        bad[a:b] = _windows(
                            hits, marks[row].as_py(), ranges[row].as_py(), key[a:b], starts[a:b] - words.offsets[doc]
                        )
                    starts = starts[bad]
                    np.add.at(drop, starts, 1)
                    np.add.at(drop, starts + window, -1)
                keep = np.cumsum(drop)[:-1] == 0
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(4).slice(first, last - first),
                        pa.array(words.counts),
                        pa.array(np.bincount(words.documents()[~keep], minlength=last - first).astype(np.int64)),
                        pa.array(_join(words, keep), pa.string()),
                    ],
                    ["doc_id", "n_words", "n_removed", "kept_text"],
                )

    return run


def _join(words: W.Words, keep: np.ndarray) -> list[str]:
    """Kept words of each document joined by one space."""
    n = len(words.offsets) - 1
    starts, lengths = words.starts[keep], (words.ends - words.starts)[keep]
    kept = np.r_[0, np.cumsum(keep)][words.offsets]
    out = np.full(int(lengths.sum()) + len(lengths), 0x20, np.uint8)
    at = np.cumsum(lengths + 1) - lengths - 1
    lanes = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[np.repeat(at, lengths) + lanes] = words.data[np.repeat(starts, lengths) + lanes]
    ends = np.r_[at, len(out)]
    raw = out.tobytes()
    return [raw[ends[kept[i]] : max(ends[kept[i + 1]] - 1, ends[kept[i]])].decode() for i in range(n)]


def remove_repeats(
    docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", anchor: int = ANCHOR
) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed``, ``kept_text`` of each row.

    A word goes if a window of ``window`` words covers it whose words also start a window in a document with a smaller
    id.  Null texts have no words.  A null id is larger than every id: such rows remove nothing elsewhere, and two of
    them nothing from each other.  Rows with one id remove nothing from each other.  Other columns are not read.

    Passes over the texts: their total length, the sketch, the segments (twice: for grouping and for the join), the
    removal.  Windows are grouped in two steps.  Whole segments first: whoever holds a segment behind its first holder
    loses all its windows, and only the first holder sends them on one by one.  (The first document of a window is the
    first holder of its segment there, else an earlier one had the window.)  A segment or window that very many
    documents share is one row per task after partial aggregation and is joined back from a written table, so that
    adaptive execution can split the key.
    """
    require(docs, id_col, text_col)
    spark: SparkSession = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        text.alias("text"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(int(NO_ID))).alias("order"),
        # Rows without an id are told apart by their text, rows with one id by the mark.
        F.when(F.col(id_col).isNull(), F.xxhash64(text)).otherwise(F.lit(0)).alias("spare"),
        F.xxhash64(text).alias("mark"),
    )
    letters = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    # About one minimiser in (window - anchor + 2) / 2 words of six letters.
    sketch = Sketch(row_bits(letters / 3 / (window - anchor + 2)), DEPTH, 2)
    shared = spark.sparkContext.broadcast(sketch.gather(rows.select("text"), _minimiser_keys(window, anchor)))
    segments = rows.select("order", "spare", "mark", "text").mapInArrow(_segments(shared, window, anchor), SEGMENTS)
    holders = segments.groupBy("s1", "s2", "spare").agg(
        F.min("order").alias("first"), F.first("keys").alias("keys"), F.first("checks").alias("checks")
    )
    holders = store(holders, "segments")
    later = segments.select("s1", "s2", "spare", "order", "mark", "at", "size").join(
        holders.select("s1", "s2", "spare", "first"), ["s1", "s2", "spare"]
    )
    later = later.where("order > first").select(
        "order", "spare", F.lit(None).cast("long").alias("key"), F.struct("mark", "at", "size").alias("range")
    )
    windows = holders.select(
        F.col("first").alias("order"), "spare", F.explode(F.arrays_zip("keys", "checks")).alias("w")
    ).select(F.col("w.keys").alias("key"), F.col("w.checks").alias("check"), "order", "spare")
    groups = windows.groupBy("key", "check").agg(F.min("order").alias("first"), F.max("order").alias("last"))
    groups = store(groups.where("first < last").select("key", "check", "first"), "windows")
    single = windows.join(groups, ["key", "check"]).where("order > first")
    single = single.select("order", "spare", "key", F.lit(None).cast(later.schema["range"].dataType).alias("range"))
    hits = (
        later.unionByName(single)
        .groupBy("order", "spare")
        .agg(F.collect_set("key").alias("hits"), F.collect_list("range").alias("ranges"))
    )
    return (
        rows.join(hits, ["order", "spare"], "left")
        .select("text", "hits", "ranges", "mark", "doc_id")
        .mapInArrow(_remove(window), "doc_id long, n_words long, n_removed long, kept_text string")
    )
