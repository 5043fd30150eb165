"""Token ids of a corpus in binary shards of Simple-8b blocks, in ascending order of document ids.

A shard file is::

    8 bytes   magic
    words     little-endian 64-bit Simple-8b words; every document starts a block
    blocks    per block: words before it in the shard (int64), ids in it (int64)
    documents per document: id (int64), whether it has one (int64), blocks before it (int64), ids in it (int64)
    24 bytes  number of words, blocks and documents (int64 each)

so any document is found with two reads and decoded without touching the rest.  Files are written and read through
``pyarrow.fs`` at the folder's URI.  Every attempt of a task writes a file of its own name and reports it; the manifest,
a Parquet table, names the files that count, so a lost executor or a second attempt leaves at most an unused file.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import filterfalse

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ebbtide.llm import simple8b
from ebbtide.llm.scratch import require

MAGIC = b"EBBT8B01"
CACHE_ENTRIES = 1_500_000
GROUP = 200
RESOLVE_CHARS = 2_000_000
READ_WORDS = 1 << 20
ODD_SPACES = ("\x1c", "\x1d", "\x1e", "\x1f")
MANIFEST = "shard long, file string, n_docs long, n_tokens long"


class ChunkEncoder:
    """Encodes texts with the ``tokenizers`` library, once per distinct chunk between white space.

    Needs a file whose pre-tokens hold no white space and whose added tokens are matched plainly in the raw text; a
    text with white space that ``str.split`` and the library see differently goes through the library whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task has one core
        self.library = Tokenizer.from_file(path)
        probe = [len(self.library.encode(x, add_special_tokens=False).ids) for x in ("a b", "a", "b", "\n a ")]
        if probe[0] != probe[1] + probe[2] or probe[3] != probe[1]:
            raise ValueError("a tokenizer that drops white space is needed")
        self.cache: dict[str, bytes] = {}

    def _resolve(self, chunks: list[str]) -> None:
        groups = [chunks[i : i + GROUP] for i in range(0, len(chunks), GROUP)]
        encodings = self.library.encode_batch([" ".join(g) for g in groups], add_special_tokens=False)
        for group, encoding in zip(groups, encodings):
            begins = np.cumsum([0] + [len(c) + 1 for c in group])
            places = np.array([span[0] for span in encoding.offsets], np.int64)
            cuts = (4 * np.searchsorted(places, begins)).tolist()
            ids = np.array(encoding.ids, "<u4").tobytes()
            self.cache.update(zip(group, (ids[a:b] for a, b in zip(cuts, cuts[1:]))))

    def _whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        first = 0
        while first < len(texts):
            last, size = first, 0
            while last < len(texts) and size < RESOLVE_CHARS:
                size += len(texts[last])
                last += 1
            batch = [None if any(s in t for s in ODD_SPACES) else t.split() for t in texts[first:last]]
            if len(self.cache) > CACHE_ENTRIES:
                self.cache.clear()
            new: set[str] = set()
            for chunks in batch:
                if chunks:
                    new.update(filterfalse(self.cache.__contains__, chunks))
            if new:
                self._resolve(list(new))
            ids_of = self.cache.__getitem__
            for text, chunks in zip(texts[first:last], batch):
                yield self._whole(text) if chunks is None else b"".join(map(ids_of, chunks))
            first = last


@lru_cache(maxsize=2)
def load(path: str) -> ChunkEncoder:
    return ChunkEncoder(path)


def _encoded(texts: list[str], path: str, end_id: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For parts of ``texts``: their number, ids per text, Simple-8b words, words per block."""
    encoder, end = load(path), np.array([end_id], "<u4").tobytes()
    step = max(1, int(len(texts) * RESOLVE_CHARS / (1 + sum(map(len, texts)))))
    for i in range(0, len(texts), step):
        part = [ids + end for ids in encoder.encode(texts[i : i + step])]
        lengths = np.array([len(x) // 4 for x in part], np.int64)
        _, counts = simple8b.block_counts(lengths)
        words, per_block = simple8b.encode(np.frombuffer(b"".join(part), "<u4").astype(np.uint64), counts)
        yield len(part), lengths, words, per_block


def _write_shard(folder: str, path: str, end_id: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    shard, name = TaskContext.get().partitionId(), f"ids-{uuid.uuid4().hex}.s8b"
    sink, n_words, n_blocks, blocks, docs = None, 0, 0, [], []
    for batch in batches:
        if not batch.num_rows:
            continue
        if sink is None:
            system, root = fs.FileSystem.from_uri(folder)
            system.create_dir(root, recursive=True)
            sink = system.open_output_stream(f"{root}/{name}")
            sink.write(MAGIC)
        has_id = batch.column(0).is_valid().to_numpy(zero_copy_only=False).astype(np.int64)
        ids = batch.column(0).fill_null(0).to_numpy()
        first = 0
        for n, lengths, words, per_block in _encoded(batch.column(1).to_pylist(), path, end_id):
            of_doc, counts = simple8b.block_counts(lengths)
            sink.write(words.astype("<u8").tobytes())
            blocks.append(np.stack([n_words + np.cumsum(per_block) - per_block, counts], 1))
            rows = slice(first, first + n)
            docs.append(np.stack([ids[rows], has_id[rows], n_blocks + np.cumsum(of_doc) - of_doc, lengths], 1))
            n_words, n_blocks, first = n_words + len(words), n_blocks + len(per_block), first + n
    if sink is None:
        return
    table = np.concatenate(docs)
    sink.write(np.concatenate(blocks).astype("<i8").tobytes())
    sink.write(table.astype("<i8").tobytes())
    sink.write(np.array([n_words, n_blocks, len(table)], "<i8").tobytes())
    sink.close()
    yield pa.RecordBatch.from_pylist(
        [{"shard": shard, "file": name, "n_docs": len(table), "n_tokens": int(table[:, 3].sum())}]
    )


def write_token_files(
    docs: DataFrame, folder: str, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Write shards and ``_manifest`` below ``folder``; returns the manifest with each shard's ``start``.

    Null texts are empty and hold only ``end_id``.  Rows without an id come first, rows with one id in the order of
    a hash of their texts; every row is written.  No rows give no shard.  Texts are sent by ranges of ids (only ids and
    texts are read to find the ranges) and encoded once, by the task that writes the shard.
    """
    require(docs, id_col, text_col)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("tie"))
    ordered = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text")
    manifest = ordered.mapInArrow(lambda batches: _write_shard(folder, path, end_id, batches), MANIFEST)
    manifest.write.parquet(f"{folder}/_manifest")
    return read_manifest(docs.sparkSession, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """One row per shard, so one task can add up what comes before each."""
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/_manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


class Shard:
    """Random access to one shard file."""

    def __init__(self, folder: str, name: str):
        system, root = fs.FileSystem.from_uri(folder)
        self.file = system.open_input_file(f"{root}/{name}")
        size = self.file.size()
        n_words, n_blocks, n_docs = np.frombuffer(self.file.read_at(24, size - 24), "<i8").tolist()
        docs_at = size - 24 - 32 * n_docs
        blocks_at = docs_at - 16 * n_blocks
        if self.file.read_at(8, 0) != MAGIC or blocks_at != 8 + 8 * n_words:
            raise ValueError(f"{name} is no shard of token ids")
        self.blocks = np.frombuffer(self.file.read_at(16 * n_blocks, blocks_at), "<i8").reshape(-1, 2)
        self.docs = np.frombuffer(self.file.read_at(32 * n_docs, docs_at), "<i8").reshape(-1, 4)
        self.word_ends = np.r_[self.blocks[1:, 0], n_words]
        self.block_ends = np.r_[self.docs[1:, 2], n_blocks]

    def ids(self, first: int, last: int) -> np.ndarray:
        """Ids of documents ``first`` to ``last`` (exclusive) of the shard."""
        a, b = int(self.docs[first, 2]), int(self.block_ends[last - 1])
        if a == b:
            return np.zeros(0, np.uint64)
        begin, end = int(self.blocks[a, 0]), int(self.word_ends[b - 1])
        words = np.frombuffer(self.file.read_at(8 * (end - begin), 8 + 8 * begin), "<u8")
        return simple8b.decode(words, self.word_ends[a:b] - self.blocks[a:b, 0], self.blocks[a:b, 1])

    def slices(self, limit: int = READ_WORDS) -> Iterator[tuple[int, int]]:
        """Ranges of documents with about ``limit`` words each."""
        begins = np.r_[self.blocks[:, 0], self.word_ends[-1:]][self.docs[:, 2]]
        first = 0
        while first < len(self.docs):
            last = max(first + 1, int(np.searchsorted(begins, begins[first] + limit)))
            yield first, last
            first = last


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before it), ``n_tokens``, ``ids_crc32`` (of little-endian uint32)."""
    manifest = read_manifest(spark, folder)
    shards = max(1, manifest.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard, start = Shard(folder, row["file"]), row["start"]
                for first, last in shard.slices():
                    table = shard.docs[first:last]
                    raw = shard.ids(first, last).astype("<u4").tobytes()
                    ends = np.cumsum(table[:, 3])
                    cuts = zip((4 * (ends - table[:, 3])).tolist(), (4 * ends).tolist())
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(table[:, 0], mask=table[:, 1] == 0),
                            pa.array(start + ends - table[:, 3]),
                            pa.array(table[:, 3]),
                            pa.array([zlib.crc32(raw[a:b]) for a, b in cuts], pa.int64()),
                        ],
                        ["doc_id", "start", "n_tokens", "ids_crc32"],
                    )
                    start += int(ends[-1])

    result = "doc_id long, start long, n_tokens long, ids_crc32 long"
    return manifest.select("file", "start").repartition(shards).mapInArrow(run, result)
