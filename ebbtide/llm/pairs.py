"""Vectorised lookup of pairs of numbers."""

from __future__ import annotations

import numpy as np

NO_RANK = np.iinfo(np.int32).max


class PairTable:
    """Pairs of small numbers to a rank (their place in the list) and a value, in an open-addressing numpy table."""

    def __init__(self, pairs: np.ndarray, values: np.ndarray):
        """``pairs``: (n, 2) distinct pairs in the order of their ranks; ``values``: one number for each."""
        self.bits = max(4, int(2 * max(len(pairs), 1)).bit_length() + 1)
        size = 1 << self.bits
        self.keys = np.full(size, -1, np.int64)
        self.ranks = np.full(size, NO_RANK, np.int32)
        self.values = np.zeros(size, np.int32)
        keys = (pairs[:, 0].astype(np.int64) << 32) | pairs[:, 1]
        ranks = np.arange(len(keys), dtype=np.int32)
        self.probes = 0
        offset = 0
        while len(keys):
            slot = (self._slot(keys) + offset) & (size - 1)
            free = self.keys[slot] == -1
            slots, first = np.unique(slot[free], return_index=True)
            chosen = np.flatnonzero(free)[first]
            self.keys[slots] = keys[chosen]
            self.ranks[slots] = ranks[chosen]
            self.values[slots] = values[chosen]
            left = np.ones(len(keys), bool)
            left[chosen] = False
            keys, ranks, values = keys[left], ranks[left], values[left]
            offset += 1
        self.probes = offset

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Slot of each pair, or -1."""
        keys = (left.astype(np.int64) << 32) | right
        slot = self._slot(keys)
        out = np.where(self.keys[slot] == keys, slot, -1)
        open_ = np.flatnonzero((out < 0) & (self.keys[slot] != -1))
        for step in range(1, self.probes):
            if not len(open_):
                break
            at = (slot[open_] + step) & (len(self.keys) - 1)
            hit = self.keys[at] == keys[open_]
            out[open_[hit]] = at[hit]
            open_ = open_[~hit & (self.keys[at] != -1)]
        return out
