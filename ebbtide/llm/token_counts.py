"""Token counts by rank-synchronous merging.

Texts are cut into the tokenizer's pre-tokens.  The distinct ones of a batch lie in one ragged array of symbol ids; in
each round every pre-token merges all places of its own lowest-rank pair at once, and when no pair has a rank left the
surviving symbols are counted.  A round is a few numpy passes over all pre-tokens still at work.

One pair per pre-token and round gives what merging place by place gives, provided that a symbol takes part only in
merges ranked after the one that makes it (checked when the file is loaded).
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import filterfalse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ebbtide.llm.pairs import NO_RANK, PairTable
from ebbtide.llm.scratch import require

CACHE_ENTRIES = 400_000
RESOLVE_CHARS = 2_000_000
# White space to str.split() but not to the tokenizer; a text with one of them is cut by the tokenizer's own rules.
ODD_SPACES = ("\x1c", "\x1d", "\x1e", "\x1f")


def merge_synchronously(symbols: np.ndarray, offsets: np.ndarray, table: PairTable) -> np.ndarray:
    """Number of symbols left of each sequence ``symbols[offsets[i]:offsets[i + 1]]``."""
    counts = np.diff(offsets).astype(np.int64)
    owner = np.repeat(np.arange(len(counts)), counts)
    left = counts.copy()
    while len(symbols) > 1:
        same = owner[:-1] == owner[1:]
        slot = np.full(len(symbols), -1, np.int64)
        where = np.flatnonzero(same)
        slot[where] = table.find(symbols[where], symbols[where + 1])
        rank = np.where(slot >= 0, table.ranks[slot], NO_RANK)
        begins = np.flatnonzero(np.r_[True, ~same])
        best = np.minimum.reduceat(rank, begins)
        lengths = np.diff(np.r_[begins, len(symbols)])
        alive = best != NO_RANK
        best_of = np.repeat(best, lengths)
        take = (rank == best_of) & (best_of != NO_RANK)
        # Of overlapping places (a a a) every second one from the left is taken.
        run = take & np.r_[False, take[:-1]]
        if run.any():
            index = np.arange(len(take))
            start = np.maximum.accumulate(np.where(take & ~run, index, 0))
            take &= (index - start) % 2 == 0
        places = np.flatnonzero(take)
        symbols[places] = table.values[slot[places]]
        keep = np.repeat(alive, lengths)
        keep[places + 1] = False
        np.subtract.at(left, owner[places], 1)
        symbols, owner = symbols[keep], owner[keep]
    return left


class RankTokenizer:
    """Counts tokens as the library does for a BPE file with a normalizer and a byte-level pre-tokenizer."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.library = Tokenizer.from_file(path)
        model, vocab = spec["model"], spec["model"]["vocab"]
        if model["type"] != "BPE" or model.get("ignore_merges") or model.get("continuing_subword_prefix"):
            raise ValueError("a BPE file without ignore_merges and subword prefixes is needed")
        if spec["pre_tokenizer"] is None:
            raise ValueError("a pre-tokenizer is needed")
        end = model.get("end_of_word_suffix") or ""
        self.specials = [t["content"] for t in spec["added_tokens"]]
        if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("added tokens must be matched plainly in the raw text")
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        ids = np.array([(vocab[a], vocab[b]) for a, b in pairs], np.int64).reshape(-1, 2)
        merged = np.array([vocab[a + b] for a, b in pairs], np.int32)
        made = {int(m): r for r, m in reversed(list(enumerate(merged)))}
        early = [r for r, (a, b) in enumerate(ids) if made.get(int(a), -1) >= r or made.get(int(b), -1) >= r]
        if early:
            raise ValueError(f"merge {early[0]} uses a symbol made by a later merge")
        self.table = PairTable(ids, merged)
        # Symbols by code point of the byte-level letters: inside a pre-token and at its end.
        self.inner = np.full(512, -1, np.int32)
        self.final = np.full(512, -1, np.int32)
        for token, i in vocab.items():
            if len(token) == 1 and ord(token) < 512:
                self.inner[ord(token)] = i
            if len(token) == 1 + len(end) and token.endswith(end) and ord(token[0]) < 512:
                self.final[ord(token[0])] = i
        self.cache: dict[str, int] = {}

    def _pieces(self, chunks: list[str]) -> tuple[list[str], np.ndarray]:
        """Pre-tokens of all chunks and the chunk of each; chunks hold no white space and no special token."""
        text = " ".join(chunks)
        normal = self.library.normalizer.normalize_str(text) if self.library.normalizer else text
        found = self.library.pre_tokenizer.pre_tokenize_str(normal)
        parts = normal.split(" ")
        if len(parts) != len(chunks):
            raise ValueError("the normalizer changes white space inside chunks")
        begins = np.cumsum([0] + [len(p) + 1 for p in parts])
        places = np.array([span[0] for _, span in found], np.int64)
        return [p for p, _ in found], np.searchsorted(begins, places, side="right") - 1

    def resolve(self, chunks: list[str]) -> None:
        """Put the counts of new chunks into the cache."""
        special = {c for c in chunks if any(s in c for s in self.specials)}
        plain = [c for c in chunks if c not in special]
        if plain:
            pieces, owner = self._pieces(plain)
            counts = np.bincount(owner, weights=self.count_pieces(pieces), minlength=len(plain)).astype(np.int64)
            self.cache.update(zip(plain, counts.tolist()))
        for chunk in special:
            self.cache[chunk] = self._with_specials(chunk)

    def _with_specials(self, chunk: str) -> int:
        """A special token is one token; what stands between is counted on its own."""
        places = [(chunk.find(s), -len(s), s) for s in self.specials if s in chunk]
        if not places:
            return self.count(chunk) if chunk else 0
        at, _, special = min(places)
        return 1 + sum(self._with_specials(x) for x in (chunk[:at], chunk[at + len(special) :]))

    def count_pieces(self, pieces: list[str]) -> np.ndarray:
        distinct = list(dict.fromkeys(pieces))
        if not distinct:
            return np.zeros(0, np.int64)
        letters = np.frombuffer("".join(distinct).encode("utf-32-le"), np.uint32)
        offsets = np.cumsum([0] + [len(p) for p in distinct])
        symbols = self.inner[letters]
        symbols[offsets[1:] - 1] = self.final[letters[offsets[1:] - 1]]
        counts = dict(zip(distinct, merge_synchronously(symbols, offsets, self.table).tolist()))
        return np.fromiter(map(counts.__getitem__, pieces), np.int64, len(pieces))

    def count(self, text: str) -> int:
        return self.counts([text])[0]

    def counts(self, texts: list[str]) -> list[int]:
        """Tokens of each text.  Chunks between white space are looked up; the new ones of a batch are merged together."""
        out: list[int] = []
        for batch in _by_size(texts, RESOLVE_CHARS):
            # A pre-token never holds white space, so the chunks can be counted one by one.
            chunked = [_chunks(t) for t in batch]
            if len(self.cache) > CACHE_ENTRIES:
                self.cache.clear()
            new: set[str] = set()
            for chunks in chunked:
                new.update(filterfalse(self.cache.__contains__, chunks))
            if new:
                self.resolve(list(new))
            out.extend(sum(map(self.cache.__getitem__, c)) for c in chunked)
        return out


def _chunks(text: str) -> list[str]:
    chunks = text.split()
    if any(s in text for s in ODD_SPACES):
        # str.split() also cuts at the four separators; put them back where they were.
        chunks, keep = [], []
        for letter in text:
            if letter.isspace() and letter not in ODD_SPACES:
                if keep:
                    chunks.append("".join(keep))
                keep = []
            else:
                keep.append(letter)
        if keep:
            chunks.append("".join(keep))
    return chunks


def _by_size(texts: list[str], limit: int) -> Iterator[list[str]]:
    batch, size = [], 0
    for text in texts:
        batch.append(text)
        size += len(text)
        if size >= limit:
            yield batch
            batch, size = [], 0
    if batch:
        yield batch


@lru_cache(maxsize=2)
def load(path: str) -> RankTokenizer:
    """One tokenizer per worker process."""
    return RankTokenizer(path)


def count_tokens(
    docs: DataFrame, path: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id``, ``n_bytes`` (UTF-8), ``n_tokens``, ``over_limit`` (more than ``limit`` tokens) of each row.

    ``path``: a tokenizer file that every executor has.  Null texts are empty: no bytes, no tokens.  Ids may be null or
    repeated; every row gives one row.  Other columns are not read.  No shuffle; a task holds one Arrow batch, and of
    the batch the chunks of about two million characters at a time.
    """
    require(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load(path)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            counts = pa.array(tokenizer.counts(texts), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), counts], ["doc_id", "n_bytes", "n_tokens"])

    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"), text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes")
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    counted = rows.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
