"""Count-min sketches of 64-bit keys over a whole corpus, merged by slices and reduced to a bit per counter and limit.

Counters only ever overestimate, so "below the limit" is certain and "at the limit or more" may be wrong.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ebbtide.llm import words as W

SLICE_BITS = 18
SLICE = 1 << SLICE_BITS
# Keys a task gathers before it sends them on.
GATHERED = 1 << 21
# Bounds of a row's size; merged counters are one bit each when they are sent to the tasks.
LEAST_BITS, MOST_BITS = 18, 27
SALTS = (0x51ED270B7A4C9E35, 0x2545F4914F6CDD1D, 0xA0761D6478BD642F)
Keys = Callable[[pa.RecordBatch], Iterator[np.ndarray]]


def row_bits(keys: float) -> int:
    """Bits of the size of a row for so many keys: twice as many counters, within the bounds.

    Beyond the upper bound the sketch takes no more memory but overestimates more keys.
    """
    return int(min(max(int(2 * keys).bit_length(), LEAST_BITS), MOST_BITS))


def _gaps(cells: np.ndarray) -> bytes:
    """Sorted numbers as differences of one byte; 255 adds to the one behind it."""
    gaps = np.diff(cells, prepend=0)
    out = np.full(int((gaps // 255).sum()) + len(gaps), 255, np.uint8)
    out[np.cumsum(gaps // 255 + 1) - 1] = gaps % 255
    return out.tobytes()


def _positions(gaps: pa.Buffer) -> np.ndarray:
    steps = np.frombuffer(gaps, np.uint8)
    return np.cumsum(steps, dtype=np.int64)[steps != 255]


class Sketch:
    """``depth`` rows of ``1 << bits`` counters; after ``gather`` one bit each for every limit (up to 255): reached it."""

    def __init__(self, bits: int, depth: int, *limits: int):
        self.bits, self.depth, self.limits = bits, depth, limits
        self.reached: dict[int, np.ndarray] = {}

    def cells(self, keys: np.ndarray, row: int) -> np.ndarray:
        spread = W.mix(keys ^ W.U64(SALTS[row])) >> W.U64(64 - self.bits)
        return (row << self.bits) + spread.astype(np.int64)

    def _count(self, keys_of: Keys) -> Callable:
        def sparse(parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            """Touched counters, one entry for each count, as gaps within their slice."""
            keys = np.concatenate(parts)
            cells = np.sort(np.concatenate([self.cells(keys, row) for row in range(self.depth)]))
            slices, begins = np.unique(cells >> SLICE_BITS, return_index=True)
            for index, part in zip(slices.tolist(), np.split(cells & (SLICE - 1), begins[1:])):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([index], pa.int32()), pa.array([_gaps(part)])], ["slice", "counts"]
                )

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            parts, size = [], 0
            for batch in batches:
                for keys in keys_of(batch):
                    parts.append(keys)
                    size += len(keys)
                    if size >= GATHERED:
                        yield from sparse(parts)
                        parts, size = [], 0
            if size:
                yield from sparse(parts)

        return run

    def _merge(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums the partial counts of each slice, which come in a row; one slice is held at a time."""
        current, total, limits = None, None, self.limits

        def finished() -> pa.RecordBatch:
            bits = b"".join(np.packbits(total >= limit).tobytes() for limit in limits)
            return pa.RecordBatch.from_arrays([pa.array([current], pa.int32()), pa.array([bits])], ["slice", "bits"])

        for batch in batches:
            for index, counts in zip(batch.column(0).to_pylist(), batch.column(1)):
                if index != current:
                    if current is not None:
                        yield finished()
                    current, total = index, np.zeros(SLICE, np.int32)
                total += np.bincount(_positions(counts.as_buffer()), minlength=SLICE).astype(np.int32)
                np.minimum(total, 255, out=total)
        if current is not None:
            yield finished()

    def gather(self, df: DataFrame, keys_of: Keys) -> Sketch:
        """Count the keys that ``keys_of`` finds in the batches of ``df``.

        A task sends about a byte for each key and row; the driver gets a bit per counter and limit.
        """
        merged = (
            df.mapInArrow(self._count(keys_of), "slice int, counts binary")
            .repartition("slice")
            .sortWithinPartitions("slice")
            .mapInArrow(self._merge, "slice int, bits binary")
        )
        self.reached = {limit: np.zeros((self.depth << self.bits) // 8, np.uint8) for limit in self.limits}
        step = SLICE // 8
        for row in merged.toLocalIterator():
            planes = np.frombuffer(row["bits"], np.uint8).reshape(len(self.limits), step)
            for limit, plane in zip(self.limits, planes):
                self.reached[limit][row["slice"] * step : (row["slice"] + 1) * step] = plane
        return self

    def reaches(self, keys: np.ndarray, limit: int | None = None) -> np.ndarray:
        """False where the count is certainly below the limit (the first one if none is named)."""
        bits = self.reached[self.limits[0] if limit is None else limit]
        out = np.ones(len(keys), bool)
        for row in range(self.depth):
            rows = np.flatnonzero(out)
            at = self.cells(keys[rows], row)
            out[rows] = (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
        return out
