"""Packing: every token of every document lies in exactly one piece, and almost nothing is padded."""

import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ebbtide.llm import packing
from ebbtide.llm.queries import BYTE_BPE, QUERIES

FOLDER = "/root/testdata/sf0.001"
LIBRARY = Tokenizer.from_file(BYTE_BPE)


def tokens_of(text):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 0]


def check_pieces(rows, texts, size):
    """Pieces ``(doc_id, start, length, doc_tokens, ids, sequence_id, offset)`` against texts by id (all distinct)."""
    docs, sequences = {}, {}
    for doc, start, length, total, ids, sequence, offset in rows:
        numbers = np.frombuffer(bytes(ids), "<u4").tolist()
        assert len(numbers) == length > 0
        docs.setdefault(doc, []).append((start, numbers, total))
        sequences.setdefault(sequence, []).append((offset, length))
    assert set(docs) == set(texts)
    for doc, parts in docs.items():
        want, at = tokens_of(texts[doc]), 0
        for start, numbers, total in sorted(parts):
            assert start == at and total == len(want) and numbers == want[at : at + len(numbers)]
            at += len(numbers)
        assert at == len(want)
    short = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size and at & (at - 1) == 0 or at == size
        short += at < size
    assert short <= size.bit_length()


def odd_texts(n):
    rnd = random.Random(n)
    texts = {1: None, 2: "", 3: " ", 4: "<|endoftext|> a <|endoftext|>", 5: "x" * 50_000, 6: "word " * 9000, 7: "\x1c \x85\n﻿",
             8: "é́ 中文 \U0001f600", None: "no id"}
    return texts | {10 + i: "token " * rnd.choice([1, 3, 30, 200, 500]) + str(i) for i in range(n)}


@pytest.mark.parametrize("size, windows, partitions, group", [(1024, 64, 3, 64), (64, 2, 9, 2), (100, 1, 5, 3), (1, 1, 1, 2)])
def test_pieces(spark, size, windows, partitions, group):
    texts = odd_texts(120) if size > 1 else {1: None, 2: "a b c", None: "d"}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(partitions)
    df = df.withColumns({c: F.lit(1) for c in ("start", "task", "window", "group", "sequence_id")})
    packed = packing.pack_documents(df, BYTE_BPE, public_tokenizers.PATTERN, 0, size, windows, group=group)
    check_pieces(packed.collect(), texts, size)


def test_repeated_rows_and_no_rows(spark):
    df = spark.createDataFrame([(1, "a b")] * 5, "doc_id long, text string")
    packed = packing.pack_documents(df, BYTE_BPE, public_tokenizers.PATTERN, 0)
    assert packed.agg(F.sum("length")).first()[0] == 5 * len(tokens_of("a b"))
    assert packing.pack_documents(df.where("doc_id > 1"), BYTE_BPE, public_tokenizers.PATTERN, 0).collect() == []


def test_best_fit_and_the_fullest():
    packer = packing.Packer(10, 2)

    def place(doc, n):
        return [[(p[0], p[1], len(p[3]) // 4) for p in w] for w in packer.place((doc, 0, n, bytes(4 * n)))]

    assert place("a", 6) == [] and place("b", 7) == []
    # Room is 4 and 3: three words fit best into the second window, which is full then.
    assert place("c", 3) == [[("b", 0, 7), ("c", 0, 3)]]
    assert place("d", 8) == []
    # None has room for five; the fullest takes two of them, and the rest fits into the other.
    assert place("e", 5) == [[("d", 0, 8), ("e", 0, 2)]]
    assert [[(p[0], p[1]) for p in w] for w in packer.left()] == [[("a", 0), ("e", 2)]]
    assert place("f", 25) == [[("f", 0, 10)], [("f", 10, 10)]]


def test_encoder_equals_the_library():
    encoder, rnd = packing.load(BYTE_BPE, public_tokenizers.PATTERN), random.Random(8)
    pool = [chr(c) for c in [*range(0x250), *range(0x2000, 0x2070), 0x3000, 0x180E, 0xFEFF, 0x4E2D, 0x661, 0x300, 0xE000]]
    for _ in range(5000):
        text = "".join(rnd.choice(pool) if rnd.random() < 0.5 else rnd.choice(" \n'sab1<|>") for _ in range(rnd.randrange(14)))
        text += "<|endoftext|>" if rnd.random() < 0.05 else ""
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == tokens_of(text)[:-1]


def test_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()}
    packed = packing.pack_documents(
        spark.read.parquet(f"{FOLDER}/documents.parquet"), BYTE_BPE, public_tokenizers.PATTERN, 0
    )
    rows = packed.collect()
    check_pieces(rows, texts, 1024)
    import zlib

    got = {(r.doc_id, r.start): r.ids_crc32 for r in QUERIES["op13_packing"](spark, FOLDER).collect()}
    for doc, start, _, _, ids, _, _ in rows:
        assert got.get((doc, start), zlib.crc32(ids)) == zlib.crc32(ids)
