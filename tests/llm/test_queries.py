"""Registered queries against their SQL or against the libraries, on whole tables."""

import base64
import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from ebbtide.llm.queries import BYTE_RANKS, END_ID, QUERIES, SQL, TOKEN_LIMIT, WORD_BPE, site_columns
from tests.compare import connect, differences

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    assert differences(QUERIES[name](spark, FOLDER), connect(FOLDER), SQL[name]) == []


def texts(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    return [(r.doc_id, r.text or "") for r in rows]


def test_token_counts(spark):
    tokenizer = Tokenizer.from_file(WORD_BPE)
    want = {}
    for doc, text in texts(spark):
        n = len(tokenizer.encode(text, add_special_tokens=False).ids)
        want[doc] = (len(text.encode()), n, n > TOKEN_LIMIT)
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in QUERIES["op3_token_counts"](spark, FOLDER).collect()}
    assert got == want


def test_byte_bpe(spark):
    with open(BYTE_RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = {}
    for doc, text in texts(spark):
        ids = library.encode_ordinary(text)
        digest = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        want[doc] = (len(ids), digest, hashlib.sha256(text.encode()).hexdigest())
    rows = QUERIES["op4_byte_bpe"](spark, FOLDER).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows} == want


def test_token_files(spark):
    tokenizer, start, want = Tokenizer.from_file(WORD_BPE), 0, {}
    for doc, text in texts(spark):
        ids = tokenizer.encode(text, add_special_tokens=False).ids + [END_ID]
        want[doc] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    rows = QUERIES["op7_token_files"](spark, FOLDER).collect()
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in rows} == want


def test_quality_on_held_out_labels(spark):
    from ebbtide.llm import quality

    folder = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    judged = quality.classify(docs, labels.where("doc_id % 4 < 2"), *site_columns())
    rows = judged.join(labels.where("doc_id % 4 >= 2"), "doc_id").groupBy("quality", "toxic", "kept").count().collect()
    clean = {r["kept"]: r["count"] for r in rows if r.quality == 1 and r.toxic == 0}
    bad = {}
    for r in rows:
        if r.quality == 0 or r.toxic == 1:
            bad[r["kept"]] = bad.get(r["kept"], 0) + r["count"]
    assert clean[True] / sum(clean.values()) > 0.98
    assert bad[False] / sum(bad.values()) > 0.9


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline
    from ebbtide.llm import quality
    from tests.llm.brute import components, words

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, kept = docs.columns, docs
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r for r in kept.collect()}
        stage(spark, kept, FOLDER).write.parquet(str(tmp_path / str(i)))
        kept = spark.read.parquet(str(tmp_path / str(i)))
        rows = kept.collect()
        assert kept.columns[: len(columns)] == columns
        assert len({r.doc_id for r in rows}) == len(rows)
        assert all(tuple(r)[: len(columns)] == tuple(before[r.doc_id])[: len(columns)] for r in rows)
        ids = {r.doc_id for r in rows}
        if i == 0:
            labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
            verdict = quality.classify(docs, labels, *site_columns())
            assert ids == {r.doc_id for r in verdict.where("kept").collect()}
        if i == 1:
            first = {}
            for doc, r in sorted(before.items()):
                first.setdefault(" ".join(words(r.text)) if r.text.strip() == r.text else r.text, doc)
            assert ids == set(first.values())
        if i == 2:
            found = components([(d, r.text) for d, r in before.items()], 5, 80)
            assert ids == {component for _, _, component in found}
        if i == 4:
            assert ids == set(before) and kept.columns[len(columns) :] == ["n_tokens", "ids"]
            assert all(len(r["ids"]) == r.n_tokens for r in rows)


def test_run(spark):
    import corpus_pipeline

    rows = corpus_pipeline.run(spark, FOLDER).collect()
    assert 0 < len(rows) < 200
