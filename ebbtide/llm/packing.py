"""Packing of documents into training sequences in bounded space.

Each task keeps a fixed number of open windows.  A document's full stretches of one window's length are sequences by
themselves; what is left goes into the open window that it leaves the least room in.  When it fits none and no further
window may be opened, the fullest window is filled to the brim with its first tokens and emitted, and the rest is placed
again.  The windows that a task still holds at its end are merged, the windows of some tasks at a time, by the same
rule until one group is left; its last window is cut into stretches whose lengths are powers of two, which need no padding.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ebbtide.llm.scratch import require, store
from ebbtide.llm.shipping import ship_package

WINDOW = 1024
OPEN = 64
GROUP = 64
# Sequences of a merge get numbers of their own: the round in the upper bits, then the task, then the count.
ROUND_BITS, TASK_BITS = 58, 32
PIECES = (
    "doc_id long, start long, length long, doc_tokens long, ids binary, "
    "sequence_id long, offset long, task int, window int"
)

Piece = tuple  # (doc_id, start, doc_tokens, ids as little-endian unsigned 32-bit numbers)


def _byte_of_letter() -> dict[str, int]:
    """The letters that a byte-level file writes for bytes: printable ones for themselves, the rest from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class TextEncoder:
    """Encodes texts as the ``tokenizers`` library does by a byte-level BPE file, without added special tokens.

    Where ids are the order of merges, as is checked, ``tiktoken`` gives the same ids in less time.  Strings of added
    tokens inside texts become those tokens, which is the library's default.
    """

    def __init__(self, path: str, pattern: str):
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        model, split = parts["model"], parts["pre_tokenizer"]
        byte_of = _byte_of_letter()
        ranks = {bytes(map(byte_of.__getitem__, token)): number for token, number in model["vocab"].items()}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        made = [model["vocab"][a + b] for a, b in merges]
        singles = sorted(number for token, number in ranks.items() if len(token) == 1)
        plain_tokens = not any(t.get(k) for t in parts["added_tokens"] for k in ("single_word", "lstrip", "rstrip"))
        in_order = made == sorted(made) and len(singles) == 256 and len(ranks) == 256 + len(made)
        if parts["normalizer"] or split["type"] != "ByteLevel" or split["add_prefix_space"] or not split["use_regex"]:
            raise ValueError("a byte-level tokenizer without normaliser and prefix space is needed")
        if not in_order or singles[-1] > min(made, default=256) or not plain_tokens:
            raise ValueError("ids must follow the order of merges, and added tokens be matched plainly")
        special = {t["content"]: t["id"] for t in parts["added_tokens"]}
        self.fast = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)
        # Characters that regular expressions of different libraries need not all take for white space.
        self.odd = re.compile("[\x1c-\x1f\x85\u180e\u200b\ufeff]")
        for probe in ("it's  12\t!? ", "\n\n a\u00a0\u3000b c", "\u00e9\u0301x\u00b2\u0664 \u4e2d\u6587\U0001f600", "'S 'LL"):
            if self.encode(probe) != self._whole(probe):
                raise ValueError("the pattern does not part texts as the file does")

    def _whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        if self.odd.search(text):
            return self._whole(text)
        try:
            return self.fast.encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False).tobytes()
        except ValueError:  # a run of more than a million white space characters is too deep for its pattern matcher
            return self._whole(text)


@lru_cache(maxsize=2)
def load(path: str, pattern: str) -> TextEncoder:
    return TextEncoder(path, pattern)


class Packer:
    """Places pieces into at most ``windows`` open windows of ``size`` tokens."""

    def __init__(self, size: int = WINDOW, windows: int = OPEN):
        if size < 1 or windows < 1:
            raise ValueError("a window needs a length and one window must be open")
        self.size, self.windows = size, windows
        # Room left and number of each open window, by room.
        self.rooms: list[tuple[int, int]] = []
        self.held: dict[int, list[Piece]] = {}
        self.next = 0

    def _head(self, piece: Piece, tokens: int) -> tuple[Piece, Piece]:
        doc, start, total, ids = piece
        return (doc, start, total, ids[: 4 * tokens]), (doc, start + tokens, total, ids[4 * tokens :])

    def place(self, piece: Piece) -> Iterator[list[Piece]]:
        """Yields the windows that this piece makes full."""
        while len(piece[3]) >= 4 * self.size:
            full, piece = self._head(piece, self.size)
            yield [full]
        length = len(piece[3]) // 4
        if not length:
            return
        at = bisect_left(self.rooms, (length, -1))
        if at < len(self.rooms):
            room, number = self.rooms.pop(at)
        elif len(self.rooms) < self.windows:
            room, number = self.size, self.next
            self.next += 1
            self.held[number] = []
        else:
            room, number = self.rooms.pop(0)
            head, rest = self._head(piece, room)
            yield [*self.held.pop(number), head]
            yield from self.place(rest)
            return
        self.held[number].append(piece)
        if room > length:
            insort(self.rooms, (room - length, number))
        else:
            yield self.held.pop(number)

    def left(self) -> list[list[Piece]]:
        """The open windows, in the order in which they were opened."""
        return [self.held[number] for _, number in sorted((n, n) for n in self.held)]


def close(windows: Iterable[list[Piece]], size: int) -> Iterator[list[Piece]]:
    """All that is left as full windows, and at the end windows whose lengths are powers of two."""
    packer = Packer(size, 1)
    for window in windows:
        for piece in window:
            yield from packer.place(piece)
    rest = [p for window in packer.left() for p in window]
    while rest:
        room = 1 << ((sum(len(p[3]) for p in rest) // 4).bit_length() - 1)
        out = []
        while room:
            head, tail = packer._head(rest.pop(0), room)
            room -= len(head[3]) // 4
            out.append(head)
            if tail[3]:
                rest.insert(0, tail)
        yield out


class _Rows:
    """Output rows, a few megabytes at a time."""

    def __init__(self, turn: int, task: int):
        self.base, self.count, self.task = (turn << ROUND_BITS) + (task << TASK_BITS), 0, task
        self.rows: list[tuple] = []
        self.size = 0

    def add(self, window: list[Piece], number: int | None = None) -> None:
        """A sequence, or the open window ``number``."""
        sequence, offset = (self.base + self.count if number is None else None), 0
        for doc, start, total, ids in window:
            length = len(ids) // 4
            at = offset if number is None else None
            self.rows.append((doc, start, length, total, ids, sequence, at, self.task, number))
            offset += length
            self.size += len(ids)
        self.count += number is None

    def flush(self, least: int = 0) -> Iterator[pa.RecordBatch]:
        if len(self.rows) > least or self.size > 1000 * least:
            names = [c.strip().split(" ")[0] for c in PIECES.split(",")]
            kinds = [*[pa.int64()] * 4, pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]
            columns = zip(*self.rows) if self.rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)
            self.rows, self.size = [], 0


def _pack(path: str, pattern: str, end_id: int, size: int, windows: int):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        out, packer = _Rows(0, TaskContext.get().partitionId()), Packer(size, windows)
        encoder = load(path, pattern)
        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1)):
                tokens = encoder.encode(text.as_py() or "") + end
                for window in packer.place((doc.as_py(), 0, len(tokens) // 4, tokens)):
                    out.add(window)
                yield from out.flush(4096)
        for number, window in enumerate(packer.left()):
            out.add(window, number)
        yield from out.flush()

    return run


def _merge(turn: int, size: int, windows: int, last: bool):
    def run(key: tuple, tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = key[0].as_py()
        held: dict[tuple, list[tuple]] = {}
        for table in tables:
            for r in table.to_pylist():
                order = (r["start"], -1 if r["doc_id"] is None else r["doc_id"], r["ids"])
                piece = (r["doc_id"], r["start"], r["doc_tokens"], r["ids"])
                held.setdefault((r["task"], r["window"]), []).append((order, piece))
        out, packer = _Rows(turn, group), Packer(size, windows)
        # The fullest windows first; rows come in any order, so a repeated attempt sorts them to the same windows.
        filled = [[p for _, p in sorted(held[k], key=lambda x: x[0])] for k in sorted(held)]
        for window in sorted(filled, key=lambda w: -sum(len(p[3]) for p in w)):
            for piece in window:
                for full in packer.place(piece):
                    out.add(full)
        if last:
            for window in close(packer.left(), size):
                out.add(window)
        else:
            for number, window in enumerate(packer.left()):
                out.add(window, number)
        yield from out.flush()

    return run


def pack_documents(
    docs: DataFrame,
    path: str,
    pattern: str,
    end_id: int,
    size: int = WINDOW,
    windows: int = OPEN,
    id_col: str = "doc_id",
    text_col: str = "text",
    group: int = GROUP,
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, doc_tokens, ids, sequence_id, offset``.

    A document is its token ids by the ``tokenizers`` file at ``path`` (byte-level, with the splitting rule ``pattern``) and
    ``end_id``; null and empty texts are ``end_id`` alone.  ``start`` is the piece's
    first token in its document, ``offset`` its place in the sequence, without gaps.  All sequences have ``size`` tokens
    but the last ones of the whole corpus, whose lengths are powers of two.  Null and repeated ids are kept as they are
    (rows of one id are told apart by their sequences only); other columns are not read; no rows give no sequences.

    Documents stay in their task: only open windows move, at most ``windows`` a task, and ``group`` tasks meet in one
    task of the next round, so no task sees more than ``group * windows`` windows.
    """
    require(docs, id_col, text_col)
    spark = docs.sparkSession
    ship_package(spark)
    if group < 2:
        raise ValueError("groups of at least two tasks are needed")
    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text")
    )
    done = []
    packed = store(rows.mapInArrow(_pack(path, pattern, end_id, size, windows), PIECES), "packed")
    turn = 0
    while True:
        done.append(packed.where("sequence_id IS NOT NULL"))
        turn += 1
        open_windows = packed.where("sequence_id IS NULL")
        tasks = open_windows.agg(F.max("task")).first()[0]
        if tasks is None:
            break
        merged = open_windows.withColumn("group", F.floor(F.col("task") / group).cast("int"))
        packed = store(
            merged.groupBy("group").applyInArrow(_merge(turn, size, windows, tasks < group), PIECES), "merged"
        )
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out.select("doc_id", "start", "length", "doc_tokens", "ids", "sequence_id", "offset")
