"""Words, word hashes and windows of words of many texts at once, on the byte buffers of Arrow batches.

A word is a run of bytes other than ``\\x20 \\x09-\\x0D``.  All functions work on one flat byte array with document
offsets, so a batch costs a few numpy passes and no loop over words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
# Odd numbers, so that they have an inverse modulo 2^64.
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
PIECE_BYTES = 1 << 20
LONG_WORD = 256


def flat(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string array; null counts as empty."""
    array = pc.fill_null(array.cast(pa.large_string()), "")
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    if not len(array):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(array.buffers()[1], np.int64)[array.offset : array.offset + len(array) + 1]
    data = array.buffers()[2]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(offsets: np.ndarray, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of whole documents of about ``limit`` bytes; a longer document stands alone."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


@dataclass
class Words:
    """``starts``/``ends``: byte ranges of all words; ``offsets``: first word of each document."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    offsets: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)

    def documents(self) -> np.ndarray:
        """Document number of each word."""
        return np.repeat(np.arange(len(self.offsets) - 1), self.counts)


def split_words(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> Words:
    """``lower``: A-Z become a-z before anything else."""
    if lower:
        data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
    solid = np.ones(256, bool)
    solid[list(SPACES)] = False
    inside = solid[data]
    before = np.empty_like(inside)
    after = np.empty_like(inside)
    if len(data):
        before[0], before[1:] = False, inside[:-1]
        after[-1], after[:-1] = False, inside[1:]
        edges = offsets[1:-1]
        edges = edges[(edges > 0) & (edges < len(data))]
        before[edges] = False
        after[edges - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return Words(data, starts, ends, np.searchsorted(starts, offsets))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def word_hashes(words: Words, base: int = BASES[0]) -> np.ndarray:
    """64-bit hash of each word's bytes, eight at a time with a nonlinear step after each; long words by BLAKE2b."""
    lengths = words.ends - words.starts
    out = np.full(len(lengths), U64(base))
    if not len(lengths):
        return out
    padded = np.r_[words.data, np.zeros(8, np.uint8)]
    # The eight bytes from every position on.
    lanes = np.ndarray(len(padded) - 7, "<u8", padded, strides=(1,))
    long = np.flatnonzero(lengths > LONG_WORD)
    live = np.arange(len(lengths)) if not len(long) else np.flatnonzero(lengths <= LONG_WORD)
    with np.errstate(over="ignore"):
        done = 0
        while len(live):
            rest = lengths[live] - done
            lane = lanes[words.starts[live] + done].astype(U64)
            lane &= ~U64(0) >> (U64(8) * (8 - np.minimum(rest, 8)).astype(U64))
            out[live] = mix(out[live] * U64(BASES[1]) + lane)
            done += 8
            live = live[rest > 8]
        key = base.to_bytes(8, "little")
        for i in long.tolist():
            raw = words.data[words.starts[i] : words.ends[i]].tobytes()
            out[i] = int.from_bytes(hashlib.blake2b(raw, digest_size=8, key=key).digest(), "little")
        # Words that end in zero bytes differ in their lengths.
        return mix(out + lengths.astype(U64) * U64(BASES[1]))


def window_hashes(hashes: np.ndarray, size: int, base: int = BASES[1]) -> np.ndarray:
    """Hash of the ``size`` words from each position on, as far as the flat array reaches."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, U64)
    with np.errstate(over="ignore"):
        total = np.zeros(n, U64)
        for i in range(size):
            total = total * U64(base) + hashes[i : i + n]
        return mix(total)


def window_starts(words: Words, size: int) -> np.ndarray:
    """Whether ``size`` words of one document start at each word."""
    room = np.repeat(words.offsets[1:], words.counts) - np.arange(len(words.starts))
    return room >= size


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
