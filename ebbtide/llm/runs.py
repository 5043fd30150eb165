"""Periodic runs of words, found online by catchers over completed power-of-two blocks.

A run of period p that reaches 2 p words repeats its first half.  A stretch of p words holds a whole aligned block of m
words when p >= 2 m, so the *catcher* of that block, made when the block is complete, sees its block again p words
later.  Blocks of m words catch the periods from 2 m to 4 m - 1 (blocks of two words those below eight as well).  Every
appended word completes one window of each length m, and that suffix is compared with the two blocks in reach: a word
costs two comparisons per length, whatever the text.

What a catcher reports is extended to both sides by comparing windows of falling lengths.  Stretches that touch the end
of the text stay open and are taken up again by the next append; squares of one period that meet are one run.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.scratch import require
from ebbtide.llm.shipping import ship_package
from ebbtide.llm.words import U64, flat, mix, pieces

SHORTEST = 12
# Longer windows only serve to catch; extensions go by steps of this length (as a power of two) and less.
STEP_LEVEL = 13
RUNS = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


class _Column:
    """An array that grows by doubling."""

    def __init__(self, dtype: type):
        self.data, self.n = np.zeros(1024, dtype), 0

    def extend(self, values: np.ndarray) -> None:
        need = self.n + len(values)
        if need > len(self.data):
            grown = np.zeros(max(need, 2 * len(self.data)), self.data.dtype)
            grown[: self.n] = self.data[: self.n]
            self.data = grown
        self.data[self.n : need] = values
        self.n = need

    @property
    def view(self) -> np.ndarray:
        return self.data[: self.n]


class RunCatcher:
    """Takes words as numbers by ``append`` and knows the runs of what it has seen so far.

    A run has at least ``shortest`` words and two periods.  Windows are compared by 64-bit names, each made from the
    names of its halves by a nonlinear step; ``sound`` compares every run word by word.
    """

    def __init__(self, shortest: int = SHORTEST, seed: int = 0):
        if shortest < 7:
            raise ValueError("runs of fewer than seven words may hold no block of two words")
        self.shortest, self.seed = shortest, seed
        self.words = _Column(np.int64)
        self.names: list[_Column] = []
        self.open = np.zeros((0, 2), np.int64)
        self.found: list[np.ndarray] = []

    def _extend_names(self) -> None:
        n = self.words.n
        while 1 << len(self.names) <= max(n, 1):
            self.names.append(_Column(U64))
        with np.errstate(over="ignore"):
            for level, column in enumerate(self.names):
                if level == 0:
                    fresh = self.words.view[column.n :].astype(U64)
                    column.extend(mix(fresh * U64(0x9E3779B97F4A7C15) + U64(self.seed)))
                    continue
                half, below = 1 << (level - 1), self.names[level - 1].view
                first, last = column.n, n - 2 * half + 1
                if last > first:
                    left, right = below[first:last], below[first + half : last + half]
                    column.extend(mix(left * U64(0xD6E8FEB86659FD93) + (right ^ U64(level))))

    def _reach(self, at: np.ndarray, period: np.ndarray, forward: bool) -> np.ndarray:
        """How many words from ``at`` on (or before it) equal those ``period`` earlier."""
        n, here = self.words.n, at.copy()
        top = min(len(self.names) - 1, STEP_LEVEL)
        for level in range(top, -1, -1):
            size, name = 1 << level, self.names[level].view
            live = np.arange(len(here))
            while len(live):
                first = here[live] if forward else here[live] - size
                inside = (first + size <= n) & (first >= period[live])
                live, first = live[inside], first[inside]
                same = name[first] == name[first - period[live]]
                live = live[same]
                here[live] += size if forward else -size
                if level < top:
                    break
        return np.abs(here - at)

    def _caught(self, level: int, seen: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and periods of blocks of ``2 ** level`` words met again by windows that end after ``seen`` words."""
        size, name = 1 << level, self.names[level].view
        places, periods = [], []
        for back in range(0 if level == 1 else 2, 4):
            low, high = max(back * size, seen - size + 1, 0), len(name)
            if low >= high:
                continue
            first = low >> level
            blocks = name[(first - back) * size : high - back * size : size]
            match = name[low:high] == np.repeat(blocks, size)[low - first * size :][: high - low]
            place = low + np.flatnonzero(match)
            block = ((place >> level) - back) << level
            period = place - block
            place, block, period = place[period > 0], block[period > 0], period[period > 0]
            # The block before was met at the same distance: this one continues what that one reported.
            chained = block >= size
            chained[chained] = name[place[chained] - size] == name[block[chained] - size]
            places.append(place[~chained])
            periods.append(period[~chained])
        if not places:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(places), np.concatenate(periods)

    def _settle(self, left: np.ndarray, right: np.ndarray, period: np.ndarray) -> np.ndarray:
        """Note stretches that ended as runs if they are long enough; returns those that reach the end of the text."""
        done = right < self.words.n
        self.found.append(self._long(left[done], right[done], period[done]))
        return np.stack([left[~done], period[~done]], 1)

    def _long(self, left: np.ndarray, right: np.ndarray, period: np.ndarray) -> np.ndarray:
        fits = right - left + period >= np.maximum(self.shortest, 2 * period)
        return np.stack([left - period, right, period], 1)[fits]

    def append(self, words: np.ndarray) -> None:
        """The next words of the text; equal words are equal numbers."""
        seen = self.words.n
        self.words.extend(np.asarray(words, np.int64))
        if self.words.n == seen:
            return
        self._extend_names()
        left, period = self.open[:, 0], self.open[:, 1]
        begin = np.full(len(left), seen)
        still = [self._settle(left, begin + self._reach(begin, period, True), period)]
        for level in range(1, len(self.names)):
            place, period = self._caught(level, seen)
            left = place - self._reach(place, period, False)
            still.append(self._settle(left, place + self._reach(place, period, True), period))
        self.open = np.concatenate(still)

    def runs(self) -> np.ndarray:
        """Start, end and smallest period of every run, by start and period.

        Of the periods of one stretch the smallest counts: with two periods in it all its other ones are multiples,
        and each of those ends where it ends.
        """
        left, period = self.open[:, 0], self.open[:, 1]
        ending = self._long(left, np.full(len(left), self.words.n), period)
        rows = np.concatenate([*self.found, ending, np.zeros((0, 3), np.int64)])
        rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
        first = np.ones(len(rows), bool)
        first[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
        rows = rows[first]
        return rows[np.lexsort((rows[:, 2], rows[:, 0]))]

    def sound(self, runs: np.ndarray) -> bool:
        """Whether the words themselves have these periods."""
        words = self.words.view
        return all(np.array_equal(words[a + p : b], words[a : b - p]) for a, b, p in runs.tolist())


def runs_of(words: np.ndarray, shortest: int = SHORTEST) -> np.ndarray:
    """Start, end and period of the runs of ``words``; names that betray themselves are drawn anew."""
    for seed in count():
        catcher = RunCatcher(shortest, seed)
        catcher.append(words)
        runs = catcher.runs()
        if catcher.sound(runs):
            return runs
    raise AssertionError


def _piece(data: np.ndarray, offsets: np.ndarray, shortest: int) -> tuple[list[int], np.ndarray, list[bytes]]:
    """Of some texts: words of each, rows of text number, start, length and period of all runs, and collapsed texts."""
    numbers: dict[bytes, int] = {}
    fresh = count()
    texts, parts = [], []
    for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        # Without an argument bytes are split at exactly the six white space characters.
        words = data[a:b].tobytes().split()
        texts.append(words)
        parts.append(np.fromiter(map(numbers.setdefault, words, fresh), np.int64, len(words)))
        # A word of its own ends every text, so no run crosses it.
        parts.append(np.array([-1 - i], np.int64))
    sizes = [len(x) for x in texts]
    starts = np.r_[0, np.cumsum(np.array(sizes, np.int64) + 1)]
    runs = runs_of(np.concatenate([*parts, np.zeros(0, np.int64)]), shortest)
    of = np.searchsorted(starts, runs[:, 0], side="right") - 1
    change = np.zeros(starts[-1] + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 1], -1)
    kept = np.cumsum(change) == 0
    collapsed = []
    touched = set(of.tolist())
    for i, words in enumerate(texts):
        if i in touched:
            words = [words[k] for k in np.flatnonzero(kept[starts[i] : starts[i] + sizes[i]]).tolist()]
        collapsed.append(b" ".join(words))
    rows = np.stack([of, runs[:, 0] - starts[of], runs[:, 1] - runs[:, 0], runs[:, 2]], 1)
    return sizes, rows, collapsed


def _find(shortest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat(batch.column(1))
            for a, b in pieces(offsets):
                sizes, rows, collapsed = _piece(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], shortest)
                ends = np.r_[0, np.cumsum(np.bincount(rows[:, 0], minlength=b - a))]
                found = pa.StructArray.from_arrays(
                    [pa.array(rows[:, k]) for k in (1, 2, 3)], ["start", "length", "period"]
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        pa.array(sizes, pa.int64()),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), found),
                        pa.array(collapsed, pa.binary()).cast(pa.string()),
                    ],
                    ["doc_id", "n_words", "runs", "collapsed"],
                )

    return run


def find_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = SHORTEST
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_words``, ``runs``, ``collapsed``.

    Words are runs of bytes other than white space (``\\x20 \\x09-\\x0D``).  ``runs`` has start (word number from 0),
    length and smallest period of every stretch of at least ``shortest`` words and two periods that no neighbouring word
    extends, by start and period.  ``collapsed`` has the words, joined by single spaces, that are in no run or among the
    first period of every run they are in.

    Null and empty texts have no words, no runs and an empty ``collapsed``; null and repeated ids are kept as they are;
    other columns are not read.  Rows do not move: a task reads its texts about a megabyte at a time, and a longer text
    alone (some 150 bytes for each of its words while it is read).
    """
    require(docs, id_col, text_col)
    ship_package(docs.sparkSession)
    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text")
    )
    return rows.mapInArrow(_find(shortest), RUNS)
