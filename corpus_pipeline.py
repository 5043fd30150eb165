"""A corpus from raw documents to token ids: filter, deduplicate, mix, encode.

Every stage takes the rows that the one before it kept and returns them with all their columns; the last one adds
``n_tokens`` and ``ids``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ebbtide.llm import byte_bpe, exact_dedup, jaccard, mixing, quality
from ebbtide.llm.queries import BYTE_RANKS, MIX_FRACTION, MIX_POWERS, mix_dimensions, site_columns
from ebbtide.llm.scratch import keep_rows, store
from ebbtide.llm.shipping import ship_package


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier calls neither of low quality nor toxic."""
    ship_package(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep_good(docs, labels, *site_columns())


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest id."""
    return exact_dedup.keep_first(docs, exact_dedup.temporary_index(spark), sf_dir)


def unlike_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity of 0.8 or more."""
    ship_package(spark)
    verdict = store(jaccard.near_duplicates(docs, size=5, percent=80).where("kept"), "unlike")
    return keep_rows(docs, verdict, "doc_id", "text")


def mixed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose tokens follow tempered shares of sources, languages and topics."""
    decided, _ = mixing.mixture(docs, mix_dimensions(), MIX_POWERS, fraction=MIX_FRACTION)
    return decided.where("kept").select("row.*")


def encoded_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their byte-level BPE ids."""
    ship_package(spark)
    return byte_bpe.add_ids(docs, BYTE_RANKS, public_tokenizers.PATTERN)


STAGES = [
    ("quality classifier", good_documents),
    ("exact dedup", distinct_documents),
    ("n-gram Jaccard join", unlike_documents),
    ("mixing sources to target weights", mixed_documents),
    ("byte-level BPE encoding and decoding", encoded_documents),
]

# The classifier is a fitted model, which SQL cannot express; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; what each keeps is written to the shared folder and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = store(docs, "stage")
    return docs
