"""Byte-level BPE by dynamic programming over prefixes.

The encoding of a byte string ends in one token, and what stands before it is the encoding of the shorter prefix.  So
it is enough to store, for every prefix, its last token: of the tokens that end there exactly one forms a valid pair
with the last token of the prefix before it.  A pair is valid if merging its bytes gives the pair back.  The table of
an encoded string stays right when bytes are appended, and up to the place of an edit when it is edited.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache
from itertools import chain, filterfalse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.llm.pairs import PairTable
from ebbtide.llm.scratch import fresh, require

CACHE_ENTRIES = 500_000
PAIRS = 500_000
TOGETHER = 20_000
DECODED_IDS = 1 << 18
RESOLVE_CHARS = 2_000_000


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


class PrefixTable:
    """Last tokens of all prefixes of one byte string, extended or edited in place."""

    def __init__(self, bpe: PrefixBPE, data: bytes = b""):
        self.bpe, self.data, self.last = bpe, b"", [-1]
        self.append(data)

    def append(self, data: bytes) -> None:
        """Exact, and no earlier prefix is looked at again but for the last bytes of a possible token."""
        begin = len(self.data)
        self.data += data
        self.bpe.fill(self.data, self.last, begin)

    def replace(self, start: int, stop: int, data: bytes) -> None:
        """Re-encode from the edit on; the table before ``start`` is kept."""
        tail = self.data[stop:]
        del self.last[start + 1 :]
        self.data = self.data[:start]
        self.append(data + tail)

    def tokens(self) -> list[int]:
        out, at = [], len(self.data)
        while at:
            out.append(self.last[at])
            at -= self.bpe.lengths[self.last[at]]
        return out[::-1]


class PrefixBPE:
    """Ranks with the tables that tell whether two tokens may stand side by side."""

    def __init__(self, ranks: dict[bytes, int]):
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("every single byte must be a token")
        self.ranks = ranks
        self.bytes_of = dict(zip(ranks.values(), ranks))
        self.lengths = {rank: len(token) for token, rank in ranks.items()}
        self.longest = max(map(len, ranks))
        size = max(self.bytes_of) + 1
        self.length_of = np.zeros(size, np.int64)
        # The two parts of each token's last merge; a single byte is its own part.
        self.left, self.right = np.arange(size), np.arange(size)
        pairs, values = [], []
        self.usable = set()
        for token, rank in ranks.items():
            self.length_of[rank] = len(token)
            if len(token) == 1:
                self.usable.add(rank)
                continue
            for i in range(1, len(token)):
                if token[:i] in ranks and token[i:] in ranks:
                    pairs.append((ranks[token[:i]], ranks[token[i:]]))
                    values.append(rank)
            parts = self.merge(token, rank)
            if len(parts) == 2:
                self.left[rank], self.right[rank] = parts
                self.usable.add(rank)
        self.pairs = PairTable(np.array(pairs, np.int64).reshape(-1, 2), np.array(values, np.int32))
        self.known: dict[tuple[int, int], bool] = {}
        self._build_trie()

    def _build_trie(self) -> None:
        """Nodes are the beginnings of usable tokens; 0 is the root."""
        nodes: dict[bytes, int] = {b"": 0}
        edges, children = [], []
        for rank in self.usable:
            token = self.bytes_of[rank]
            for i in range(1, len(token) + 1):
                if token[:i] not in nodes:
                    nodes[token[:i]] = len(nodes)
                    edges.append((nodes[token[: i - 1]], token[i - 1]))
                    children.append(nodes[token[:i]])
        self.trie = PairTable(np.array(edges, np.int64), np.array(children, np.int32))
        self.token_at = np.full(len(nodes), -1, np.int64)
        for token, node in nodes.items():
            rank = self.ranks.get(token)
            if rank in self.usable:
                self.token_at[node] = rank

    def merge(self, data: bytes, below: int | None = None) -> list[int]:
        """Plain merging, lowest rank first and leftmost of equals, of a few bytes; ``below``: only with lower ranks."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            found = [self.ranks.get(a + b, -1) for a, b in zip(parts, parts[1:])]
            best = min((r for r in found if r >= 0 and (below is None or r < below)), default=None)
            if best is None:
                break
            at = found.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def valid(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether merging would keep the border between each two tokens.

        The merges that made the two tokens are undone along the border, latest first.  If at some stage the parts on
        both sides are a token together, and a token merged earlier than what was undone, merging would have crossed
        the border.
        """
        out = np.ones(len(left), bool)
        rows = np.arange(len(left))
        limit = np.full(len(left), np.iinfo(np.int64).max)
        while len(rows):
            slot = self.pairs.find(left, right)
            crossed = (slot >= 0) & (self.pairs.values[slot] < limit)
            out[rows[crossed]] = False
            # The later merge is undone; if that side is a single byte, the other one.
            whole_left, whole_right = self.left[left] == left, self.left[right] == right
            on_left = ((left > right) & ~whole_left) | whole_right
            # On equal ranks the place further left goes first, which is the one that crosses the border.
            limit = np.where(on_left, left, right + 1)
            left, right = np.where(on_left, self.right[left], left), np.where(on_left, right, self.left[right])
            go = ~crossed & ~(whole_left & whole_right)
            rows, left, right, limit = rows[go], left[go], right[go], limit[go]
        return out

    def _valid_one(self, left: int, right: int) -> bool:
        if left < 0:
            return True
        key = (left, right)
        if key not in self.known:
            if len(self.known) > PAIRS:
                self.known.clear()
            self.known[key] = bool(self.valid(np.array([left]), np.array([right]))[0])
        return self.known[key]

    def fill(self, data: bytes, last: list[int], begin: int) -> None:
        """Last tokens of the prefixes longer than ``begin`` bytes, one by one."""
        find, usable = self.ranks.get, self.usable
        for end in range(begin + 1, len(data) + 1):
            for at in range(max(0, end - self.longest), end):
                token = find(data[at:end])
                if token in usable and self._valid_one(last[at], token):
                    last.append(token)
                    break
            else:
                raise ValueError("the ranks are not those of a byte-pair encoding")

    def encode_many(self, pieces: list[bytes]) -> list[bytes]:
        """Tokens of each piece, as little-endian 32-bit numbers; the prefix tables of all are filled side by side.

        First all tokens at all places are found by walking the trie from every byte at once.  Then the prefixes of
        length 1 of all pieces get their last token, those of length 2, and so on.
        """
        lengths = np.array([len(p) for p in pieces], np.int64)
        ends = np.cumsum(lengths)
        begins = ends - lengths
        data = np.frombuffer(b"".join(pieces), np.uint8)
        piece_end = np.repeat(ends, lengths)
        at, node = np.arange(len(data)), np.zeros(len(data), np.int64)
        places, stops, tokens = [], [], []
        depth = 0
        while len(at):
            slot = self.trie.find(node, data[at + depth].astype(np.int64))
            depth += 1
            go = slot >= 0
            at, node = at[go], self.trie.values[slot[go]]
            token = self.token_at[node]
            hit = token >= 0
            places.append(at[hit])
            stops.append(at[hit] + depth)
            tokens.append(token[hit])
            go = at + depth < piece_end[at]
            at, node = at[go], node[go]
        place, stop, token = map(np.concatenate, (places, stops, tokens))
        # Table entries stand one behind their byte: entry begin + k + piece number is the prefix of k bytes.
        number = np.repeat(np.arange(len(pieces)), lengths)[place]
        size = stop - begins[number]
        order = np.argsort(size, kind="stable")
        place, stop, token, number, size = place[order], stop[order], token[order], number[order], size[order]
        last = np.full(len(data) + len(pieces), -1, np.int64)
        cuts = np.searchsorted(size, np.arange(1, int(lengths.max(initial=0)) + 2))
        for a, b in zip(cuts, cuts[1:]):
            before = last[place[a:b] + number[a:b]]
            good = before < 0
            inner = np.flatnonzero(~good)
            good[inner] = self.valid(before[inner], token[a:b][inner])
            last[stop[a:b][good] + number[a:b][good]] = token[a:b][good]
        # Read the tokens off from the ends.
        out_at, out_token = [], []
        at, number = ends.copy(), np.arange(len(pieces))
        while len(at):
            found = last[at + number]
            if (found < 0).any():
                raise ValueError("the ranks are not those of a byte-pair encoding")
            at = at - self.length_of[found]
            out_at.append(at)
            out_token.append(found)
            go = at > begins[number]
            at, number = at[go], number[go]
        at = np.concatenate(out_at)
        flat = np.zeros(len(data), "<u4")
        used = np.zeros(len(data), bool)
        flat[at], used[at] = np.concatenate(out_token), True
        counts = np.r_[0, np.cumsum(used)]
        raw = flat[used].tobytes()
        return [raw[a:b] for a, b in zip((4 * counts[begins]).tolist(), (4 * counts[ends]).tolist())]


class EditableText:
    """A text with its tokens, for appends and edits that encode only what they touch.

    Matches of the pattern are encoded on their own.  An edit is matched anew from shortly before it until a match
    begins where an old one began; the tables of matches cut short or extended are edited, not filled again.
    """

    def __init__(self, codec: Codec, text: str = ""):
        self.codec, self.text = codec, text
        self.starts, self.tables = self._match(0)

    def _match(self, begin: int) -> tuple[list[int], list[PrefixTable]]:
        starts, tables = [], []
        for found in self.codec.pattern.finditer(self.text, begin):
            starts.append(found.start())
            tables.append(PrefixTable(self.codec.bpe, found.group().encode()))
        return starts, tables

    def append(self, text: str) -> None:
        self.replace(len(self.text), len(self.text), text)

    def replace(self, start: int, stop: int, text: str) -> None:
        shift = len(text) - (stop - start)
        keep = int(np.searchsorted(self.starts, start, side="right"))
        # The match at the edit, and before it a run of white space, which is one or two matches, may match otherwise.
        keep = max(0, keep - 3)
        old_starts, old_tables = self.starts[keep:], self.tables[keep:]
        begin = old_starts[0] if old_starts else 0
        self.text = self.text[:start] + text + self.text[stop:]
        place = {s + shift: i for i, s in enumerate(old_starts) if s >= stop}
        del self.starts[keep:], self.tables[keep:]
        reuse = iter(zip(old_starts, old_tables))
        for found in self.codec.pattern.finditer(self.text, begin):
            at = found.start()
            if at >= start + len(text) and at in place and at > begin:
                i = place[at]
                self.starts.extend(s + shift for s in old_starts[i:])
                self.tables.extend(old_tables[i:])
                return
            data = found.group().encode()
            old = next(((s, t) for s, t in reuse if s >= at), None)
            self.starts.append(at)
            self.tables.append(self._adapt(old[1], data) if old and old[0] == at < start else PrefixTable(self.codec.bpe, data))

    @staticmethod
    def _adapt(table: PrefixTable, data: bytes) -> PrefixTable:
        """Edit the table of the match that stood here: only bytes after the common beginning are looked at."""
        if table.data != data:
            same = next((i for i, (a, b) in enumerate(zip(table.data, data)) if a != b), min(len(table.data), len(data)))
            table.replace(same, len(table.data), data[same:])
        return table

    def tokens(self) -> list[int]:
        return list(
            chain.from_iterable(
                [self.codec.bpe.ranks[t.data]] if t.data in self.codec.bpe.ranks else t.tokens() for t in self.tables
            )
        )


class Codec:
    """Encodes and decodes texts; one per worker process, with a bounded cache of encoded pieces of text."""

    def __init__(self, path: str, pattern: str):
        self.bpe = PrefixBPE(read_ranks(path))
        self.pattern = regex.compile(pattern)
        self.cache: dict[str, bytes | None] = {}
        self.unsafe: set[str] = set()  # chunks of the cache that must not be cut
        self.pieces: dict[str, bytes] = {}
        size = max(self.bpe.bytes_of) + 1
        self.token_bytes = [self.bpe.bytes_of.get(i, b"") for i in range(size)]
        self.token_lengths = np.array([len(t) for t in self.token_bytes], np.int64)
        # Cutting before single spaces and line ends is right only for patterns that treat white space like this.
        probes = ("a bc.\nd'll e", "a\tb c", " a", "x\ny 1")
        self.cut = all(self._pieces(p) == list(chain(*map(self._pieces, self._cut(p)))) for p in probes)

    def _pieces(self, text: str) -> list[str]:
        return self.pattern.findall(text)

    @staticmethod
    def _cut(text: str) -> list[str]:
        first, *rest = text.replace("\n", " \n").split(" ")
        return [first, *(c if c[:1] == "\n" else " " + c for c in rest)]

    def _resolve(self, pieces: set[str]) -> None:
        """Encode new matches together; a match that is a token is that token."""
        long = []
        direct = self.bpe.ranks.get
        for piece in pieces:
            data = piece.encode()
            rank = direct(data)
            if rank is None:
                long.append((piece, data))
            else:
                self.pieces[piece] = rank.to_bytes(4, "little")
        for i in range(0, len(long), TOGETHER):
            part = long[i : i + TOGETHER]
            self.pieces.update(zip((p for p, _ in part), self.bpe.encode_many([d for _, d in part])))

    def _chunk(self, chunk: str) -> list[str] | None:
        """Matches of ``chunk`` behind a space or, if it begins with a line end, as it stands; None: cutting is unsafe."""
        body = chunk[1:] if chunk[:1] == "\n" else chunk
        if not body or body[0].isspace() or body[-1].isspace():
            return None
        return self._pieces(chunk if chunk[:1] == "\n" else " " + chunk)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers.

        Runs of one space or line end always begin a match, so what stands between is encoded on its own and
        remembered; a text with any other run at a cut is matched whole.
        """
        if len(self.cache) > CACHE_ENTRIES:
            self.cache.clear()
            self.unsafe.clear()
        if len(self.pieces) > CACHE_ENTRIES:
            self.pieces.clear()
        cut: list[list[str] | None] = []
        new: set[str] = set()
        for text in texts:
            chunks = text.replace("\n", " \n").split(" ") if self.cut else [""]
            if not chunks[0] or chunks[0][0].isspace() or chunks[0][-1].isspace():
                cut.append(None)
            else:
                cut.append(chunks)
                new.update(filterfalse(self.cache.__contains__, chunks[1:]))
        matched = {c: self._chunk(c) for c in new}
        self.unsafe.update(c for c, matches in matched.items() if matches is None)
        unsafe = self.unsafe
        whole: dict[int, list[str]] = {}
        for i, (text, chunks) in enumerate(zip(texts, cut)):
            if chunks is None or not unsafe.isdisjoint(chunks[1:]):
                whole[i] = self._pieces(text)
        firsts = [None if i in whole else self._pieces(c[0]) for i, c in enumerate(cut)]
        wanted = chain(*whole.values(), *(m for m in matched.values() if m), *(f for f in firsts if f))
        unknown = set(filterfalse(self.pieces.__contains__, wanted))
        self._resolve(unknown)
        piece = self.pieces.__getitem__
        once = {}
        for chunk, matches in matched.items():
            # A chunk with a match never met before is not likely to come back; it is remembered when it does.
            into = self.cache if matches is None or unknown.isdisjoint(matches) else once
            into[chunk] = None if matches is None else b"".join(map(piece, matches))
        if once:
            known = self.cache.get

            def chunk(c: str) -> bytes:
                return known(c) or once[c]
        else:
            chunk = self.cache.__getitem__
        return [
            b"".join(map(piece, whole[i])) if i in whole else b"".join([*map(piece, firsts[i]), *map(chunk, cut[i][1:])])
            for i in range(len(texts))
        ]

    def forget(self) -> None:
        """Empty the caches of encoded text; the tables of the ranks stay."""
        self.cache.clear()
        self.unsafe.clear()
        self.pieces.clear()
        self.bpe.known.clear()

    def decode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Bytes of all ids in a row, and the length of each."""
        return b"".join(map(self.token_bytes.__getitem__, ids.tolist())), self.token_lengths[ids]


@lru_cache(maxsize=2)
def load(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


@contextmanager
def task_codec(path: str, pattern: str) -> Iterator[Codec]:
    """The worker's codec for one task; its caches of encoded text are emptied when the task ends, so that an idle
    worker holds only the ranks and the stages after this one do not run beside them."""
    codec = load(path, pattern)
    try:
        yield codec
    finally:
        codec.forget()


def _slices(texts: list[str], limit: int = RESOLVE_CHARS) -> Iterator[tuple[int, int]]:
    first, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= limit or i == len(texts) - 1:
            yield first, i + 1
            first, size = i + 1, 0


def _text_slices(column: pa.Array, limit: int = RESOLVE_CHARS) -> Iterator[tuple[int, list[str]]]:
    """Where each part of ``column`` begins, and its texts (null: empty) of about ``limit`` characters; only one part
    at a time is held as Python strings."""
    sizes = pc.fill_null(pc.utf8_length(column), 0).to_numpy(zero_copy_only=False)
    first, size = 0, 0
    for i, n in enumerate(sizes.tolist()):
        size += n
        if size >= limit or i == len(sizes) - 1:
            yield first, [t or "" for t in column.slice(first, i + 1 - first).to_pylist()]
            first, size = i + 1, 0


def encode_documents(
    docs: DataFrame,
    path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    decode: bool = False,
) -> DataFrame:
    """``doc_id``, ``n_tokens`` and ``ids`` (array of int) of each row, without special tokens.

    ``decode`` adds ``decoded``, the bytes that the ids stand for, by the same worker process.

    ``path``: a rank file that every executor has; ``pattern`` cuts texts into the matches that are encoded one by one.
    Null and empty texts have no ids.  Ids may be null or repeated; every row gives one row.  Other columns are not
    read.  No shuffle; a task holds one Arrow batch and about two million characters of encoded text.
    """
    require(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with task_codec(path, pattern) as codec:
            for batch in batches:
                for first, texts in _text_slices(batch.column(1)):
                    keys = batch.column(0).slice(first, len(texts))
                    counts, ids = _id_lists(codec.encode(texts))
                    out = pa.RecordBatch.from_arrays([keys, counts, ids], ["doc_id", "n_tokens", "ids"])
                    yield from _decoded(codec, out, "ids") if decode else [out]

    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids array<int>" + ", decoded binary" * decode)


def add_ids(docs: DataFrame, path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """``docs`` with all its columns, and ``n_tokens`` and ``ids`` (under longer names if it has such columns)."""
    require(docs, text_col)
    names = fresh(docs, "n_tokens"), fresh(docs, "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with task_codec(path, pattern) as codec:
            for batch in batches:
                for first, texts in _text_slices(batch.column(batch.schema.get_field_index(text_col))):
                    counts, ids = _id_lists(codec.encode(texts))
                    out = batch.slice(first, len(texts))
                    yield pa.RecordBatch.from_arrays(
                        [*out.columns, counts, ids], [*batch.schema.names, *names]
                    )

    schema = T.StructType([*docs.schema.fields, T.StructField(names[0], T.LongType())])
    return docs.mapInArrow(run, schema.add(names[1], T.ArrayType(T.IntegerType())))


def _id_lists(parts: list[bytes]) -> tuple[pa.Array, pa.Array]:
    """Numbers of ids, and the ids, of encoded texts."""
    counts = np.array([len(p) // 4 for p in parts], np.int64)
    values = pa.array(np.frombuffer(b"".join(parts), "<i4"))
    return pa.array(counts), pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32)), values)


def _decoded(codec: Codec, batch: pa.RecordBatch, ids_col: str) -> Iterator[pa.RecordBatch]:
    """The rows of ``batch`` with ``decoded``, about ``DECODED_IDS`` ids at a time."""
    column = batch.column(batch.schema.get_field_index(ids_col))
    begins = np.r_[0, np.cumsum(np.array(column.value_lengths().fill_null(0)))]
    ids = np.array(column.flatten())
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(begins, begins[first] + DECODED_IDS, side="right")) - 1)
        data, sizes = codec.decode(ids[begins[first] : begins[last]])
        cuts = np.r_[0, np.cumsum(sizes)][begins[first : last + 1] - begins[first]].tolist()
        decoded = pa.array([data[a:b] for a, b in zip(cuts, cuts[1:])], pa.binary())
        yield batch.slice(first, last - first).append_column("decoded", decoded)
        first = last


def decode_documents(encoded: DataFrame, path: str, pattern: str, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded``: the bytes its ids stand for; null ids decode to no bytes."""
    require(encoded, ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = load(path, pattern)
        for batch in batches:
            yield from _decoded(codec, batch, ids_col)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields)
    return encoded.mapInArrow(run, f"{fields}, decoded binary")
