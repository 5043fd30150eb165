"""Simple-8b words: 4 bits of selector and 60 bits holding 1 to 60 numbers of equal width, in blocks of numbers.

Selector 0 is the escape for numbers of more than 60 bits: the next word is the number itself.  The last word of a
block may be short of numbers; the block's count tells how many it holds.
"""

from __future__ import annotations

import numpy as np

BLOCK = 512
ESCAPE = 0
# (numbers, bits of each) of selectors 1 to 14: the packings of 60 bits, fixed by the format.
PACKINGS = (
    (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60),
)
HELD = np.zeros(16, np.int64)
HELD[ESCAPE] = 1
HELD[1:15] = [n for n, _ in PACKINGS]
PAD = PACKINGS[0][0]
U64 = np.uint64


_WIDTH_OF = np.frexp(np.arange(1 << 16, dtype=np.float64))[1].astype(np.uint8)


def _widths(values: np.ndarray) -> np.ndarray:
    """Bits each number needs, by its four 16-bit quarters."""
    out = _WIDTH_OF[values & U64(0xFFFF)]
    top = int(values.max(initial=0)).bit_length()
    for shift in range(16, top, 16):
        quarter = _WIDTH_OF[(values >> U64(shift)) & U64(0xFFFF)]
        out = np.where(quarter > 0, quarter + np.uint8(shift), out)
    return out


def block_counts(lengths: np.ndarray, size: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """Blocks of each sequence, and numbers of each block; a sequence starts a block, an empty one has none."""
    blocks = -(-lengths // size)
    counts = np.full(int(blocks.sum()), size, np.int64)
    ends = np.cumsum(blocks)[blocks > 0] - 1
    counts[ends] = (lengths - (blocks - 1) * size)[blocks > 0]
    return blocks, counts


def encode(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of all blocks, and words of each block.  ``values`` holds ``counts`` numbers of each block in a row.

    All blocks are packed side by side: in a step each takes the selector that covers most of its next numbers.
    """
    if not len(counts):
        return np.zeros(0, U64), np.zeros(0, np.int64)
    begins = np.cumsum(counts + PAD) - counts - PAD
    room = np.zeros(int((counts + PAD).sum()) + PAD, U64)
    room[np.repeat(begins - (np.cumsum(counts) - counts), counts) + np.arange(len(values))] = values
    width = _widths(room)
    fitting = np.zeros(len(room), np.uint8)
    most = width.copy()
    reach = 1
    # From the packing of one number to that of sixty; what stands behind a block is zero and fits everything.
    for code in range(len(PACKINGS), 0, -1):
        held, bits = PACKINGS[code - 1]
        while reach < held:
            most[:-reach] = np.maximum(most[:-reach], width[reach:])
            reach += 1
        fitting += most <= bits
    # What fits a packing fits every one of fewer and wider numbers, so the count tells the first that fits.
    selector = np.where(fitting > 0, len(PACKINGS) + 1 - fitting, ESCAPE).astype(np.uint8)
    at, ends = begins, begins + counts
    taken = np.zeros(len(room), bool)
    while len(at):
        taken[at] = True
        at = at + HELD[selector[at]]
        more = at < ends
        at, ends = at[more], ends[more]
    starts = np.flatnonzero(taken)
    per_block = np.diff(np.searchsorted(starts, np.r_[begins, len(room)]))
    chosen = selector[starts]
    words = chosen.astype(U64) << U64(60)
    for code in np.unique(chosen):
        rows = np.flatnonzero(chosen == code)
        if code == ESCAPE:
            continue
        held, bits = PACKINGS[code - 1]
        lanes = np.arange(held)
        packed = room[starts[rows][:, None] + lanes] << (lanes * bits).astype(U64)
        words[rows] |= np.bitwise_or.reduce(packed, axis=1)
    escapes = np.flatnonzero(chosen == ESCAPE)
    if len(escapes):
        words = np.insert(words, escapes + 1, room[starts[escapes]])
    if len(escapes):
        per_block = per_block + np.bincount(
            np.searchsorted(begins, starts[escapes], side="right") - 1, minlength=len(counts)
        )
    return words, per_block


def decode(words: np.ndarray, per_block: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers of all blocks, given words and numbers of each block."""
    owner = np.repeat(np.arange(len(counts)), per_block)
    chosen = (words >> U64(60)).astype(np.int64)
    raw = np.zeros(len(words), bool)
    for i in np.flatnonzero(chosen == ESCAPE):  # escapes are rare; a word behind one is no header
        if not raw[i]:
            raw[i + 1] = True
    heads = np.flatnonzero(~raw)
    chosen, owner = chosen[heads], owner[heads]
    held = HELD[chosen]
    before = np.cumsum(held) - held
    first = np.searchsorted(owner, np.arange(len(counts)))
    inside = before - before[np.minimum(first, max(len(before) - 1, 0))][owner] if len(heads) else before
    held = np.minimum(held, counts[owner] - inside)
    at = np.cumsum(counts)[owner] - counts[owner] + inside
    out = np.zeros(int(counts.sum()), U64)
    for code in np.unique(chosen):
        rows = np.flatnonzero(chosen == code)
        if code == ESCAPE:
            out[at[rows]] = words[heads[rows] + 1]
            continue
        size, bits = PACKINGS[code - 1]
        lanes = np.arange(size)
        unpacked = (words[heads[rows]][:, None] >> (lanes * bits).astype(U64)) & U64((1 << bits) - 1)
        valid = lanes < held[rows][:, None]
        out[(at[rows][:, None] + lanes)[valid]] = unpacked[valid]
    return out
