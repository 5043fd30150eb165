"""Tokenizers and codecs against the libraries, on difficult texts."""

import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ebbtide.llm import byte_bpe, simple8b, token_counts, token_files
from ebbtide.llm.queries import BYTE_RANKS, WORD_BPE

SPECIAL = ["<|endoftext|>", "x<|startoftext|>y <|endoftext|>", "I'LL it's 'S", "日本語 テスト 123,456.78", "ΑΣ ΟΔΟΣ Σ İ ǅ",
           "a" * 3000, "aaa aaaa aaaaa", "é ́x", " x y​z", "😀😀 👩‍👧", "ﬁ ½ ² Ⅷ", "\x00\x01",
           "x\x85y", "a\x1cb c\x1f", "", " ", "  ", "\n", "a\n\nb", "a \n b", "a\t b\n", "\na", "a  b", "   \n\n  x", "a\r\nb c",
           "ab" * 2000]
LETTERS = ["a", "b", " ", "\n", "'s", "1", "é", ".", "\t", "\xa0", "日", " the", "\r", "\x1c", "'"]


def random_texts(n):
    rnd = random.Random(1)
    return ["".join(rnd.choice(LETTERS) for _ in range(rnd.randrange(1, 40))) for _ in range(n)]


def test_counts_and_ids_of_the_word_tokenizer():
    library, texts = Tokenizer.from_file(WORD_BPE), SPECIAL + random_texts(500)
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert token_counts.RankTokenizer(WORD_BPE).counts(texts) == [len(x) for x in want]
    got = token_files.ChunkEncoder(WORD_BPE).encode(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == want


@pytest.fixture(scope="module")
def codec():
    return byte_bpe.Codec(BYTE_RANKS, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library(codec):
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.bpe.ranks, special_tokens={}
    )


def test_byte_bpe(codec, library):
    texts = SPECIAL + random_texts(3000)
    got = [np.frombuffer(x, "<u4").tolist() for x in codec.encode(texts)]
    assert got == [library.encode_ordinary(t) for t in texts]
    assert [codec.decode(np.array(x, np.int64))[0].decode() for x in got] == texts


def test_prefix_table_grows_and_changes(codec):
    rnd = random.Random(2)
    for _ in range(200):
        data = bytes(rnd.choice(b"abcdefthe ing") for _ in range(30))
        table = byte_bpe.PrefixTable(codec.bpe, data[:10])
        table.append(data[10:])
        assert table.tokens() == codec.bpe.merge(data)
        i, j = sorted((rnd.randrange(31), rnd.randrange(31)))
        table.replace(i, j, b"the")
        assert table.tokens() == codec.bpe.merge(data[:i] + b"the" + data[j:])


def test_edits_encode_as_the_whole_text_would(codec, library):
    rnd = random.Random(3)
    for text in random_texts(300):
        edited = byte_bpe.EditableText(codec, text)
        for _ in range(4):
            i = rnd.randrange(len(edited.text) + 1)
            edited.replace(i, min(len(edited.text), i + rnd.randrange(4)), rnd.choice(["", "a", " ", "\n", "the ", "'ll"]))
            edited.append(rnd.choice(["", " x", "\n", "ing"]))
            assert edited.tokens() == library.encode_ordinary(edited.text)


def test_ranks_that_lack_a_byte_are_refused():
    with pytest.raises(ValueError, match="byte"):
        byte_bpe.PrefixBPE({b"a": 0})


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**64 - 1) | st.integers(0, 60000) | st.just(0), max_size=700), max_size=6))
def test_simple8b_round_trip(sequences):
    lengths = np.array([len(s) for s in sequences], np.int64)
    values = np.array([v for s in sequences for v in s], np.uint64)
    _, counts = simple8b.block_counts(lengths)
    encoded, per_block = simple8b.encode(values, counts)
    assert per_block.sum() == len(encoded)
    assert (simple8b.decode(encoded, per_block, counts) == values).all()


def test_small_numbers_are_packed_tightly():
    _, counts = simple8b.block_counts(np.array([600]))
    assert len(simple8b.encode(np.ones(600, np.uint64), counts)[0]) == 9 + 2


def test_files_with_odd_rows(spark, tmp_path):
    rows = [(3, "b"), (None, "no id"), (1, None), (3, "a"), (3, "a"), (-5, ""), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    folder = f"file://{tmp_path}/out"
    token_files.write_token_files(df, folder, WORD_BPE, 2)
    got = token_files.read_token_files(spark, folder).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, None, -5, 1, 3, 3, 3]
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got])[:-1].tolist()
    token_files.write_token_files(df.where("doc_id > 99"), folder + "2", WORD_BPE, 2)
    assert token_files.read_token_files(spark, folder + "2").collect() == []


def test_rows_without_text(spark):
    df = spark.createDataFrame([(None, None), (1, ""), (1, "a")], "doc_id long, text string")
    df = df.selectExpr("*", "1 AS ids", "2 AS N_TOKENS", "3 AS n_bytes", "4 AS decoded")
    counts = sorted(tuple(r)[1:] for r in token_counts.count_tokens(df, WORD_BPE).collect())
    assert counts == [(0, 0, False), (0, 0, False), (1, 1, False)]
    pattern = public_tokenizers.PATTERN
    encoded = byte_bpe.encode_documents(df, BYTE_RANKS, pattern)
    decoded = byte_bpe.decode_documents(encoded, BYTE_RANKS, pattern).collect()
    assert sorted((r.n_tokens, bytes(r.decoded)) for r in decoded) == [(0, b""), (0, b""), (1, b"a")]
    assert byte_bpe.add_ids(df, BYTE_RANKS, pattern).columns == [*df.columns, "n_tokens_", "ids_"]
    assert byte_bpe.encode_documents(df.where("doc_id > 1"), BYTE_RANKS, pattern).collect() == []


def test_a_batch_is_held_as_python_strings_one_part_at_a_time():
    import pyarrow as pa

    texts = ["ab" * 30, None, "é" * 50, "", "x" * 120, "日本" * 10]
    parts = list(byte_bpe._text_slices(pa.array(texts, pa.string()), limit=100))
    assert [t for _, part in parts for t in part] == [t or "" for t in texts]
    assert [first for first, _ in parts] == np.cumsum([0] + [len(p) for _, p in parts])[:-1].tolist()
    assert all(sum(map(len, part[:-1])) < 100 for _, part in parts) and len(parts) == 3


def test_a_task_leaves_no_encoded_text_in_the_worker():
    with byte_bpe.task_codec(BYTE_RANKS, public_tokenizers.PATTERN) as codec:
        want = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.bpe.ranks, special_tokens={})
        texts = ["the cat sat on the mat", "a  b\n\tc quixotic zyzzyva"]
        assert [np.frombuffer(x, "<u4").tolist() for x in codec.encode(texts)] == [want.encode_ordinary(t) for t in texts]
        assert codec.cache or codec.pieces
    assert not (codec.cache or codec.pieces or codec.unsafe or codec.bpe.known)
    assert byte_bpe.load(BYTE_RANKS, public_tokenizers.PATTERN) is codec
