"""Exact deduplication against a persistent digest index, a table bucketed and sorted by digest."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.llm.scratch import fresh, require, store
from ebbtide.session import scratch_path

WHITESPACE = r"[\x20\x09-\x0D]+"
BUCKETS = 64
INDEX_SCHEMA = "digest BINARY, keep_id BIGINT, batch STRING"


def digest(text: Column) -> Column:
    """SHA-256 of the text with every run of white space as one space, as 32 bytes; null counts as empty."""
    return F.unhex(F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), WHITESPACE, " "), 256))


@dataclass(frozen=True)
class DigestIndex:
    """Digests of all texts seen so far, with the id of the row that stays.

    The files lie at ``path`` in buckets by digest, sorted within each file, so a batch is compared by a sort-merge
    join in which only the batch's narrow rows are shuffled, and an append rewrites nothing.
    """

    spark: SparkSession
    path: str
    buckets: int
    table: str

    @classmethod
    def open(cls, spark: SparkSession, path: str, buckets: int | None = None) -> DigestIndex:
        """Create the index or reopen one.

        The number of buckets is written beside the files when the index is created (``BUCKETS`` unless given).  An index
        that is reopened keeps its own; asking for another number is an error, because digests would be looked for in
        buckets where they are not.
        """
        path = path.rstrip("/")
        kept = f"{path}/_buckets"
        spark.createDataFrame([(buckets or BUCKETS,)], "buckets int").coalesce(1).write.mode("ignore").parquet(kept)
        held = spark.read.schema("buckets int").parquet(kept).first()[0]
        if buckets is not None and buckets != held:
            raise ValueError(f"the index at {path} has {held} buckets, not {buckets}")
        # The same in every process, so a lasting catalogue holds one table of these files.
        table = f"digest_index_{hashlib.sha256(path.encode()).hexdigest()[:16]}"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} ({INDEX_SCHEMA}) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {held} BUCKETS LOCATION '{path}'"
        )
        return cls(spark, path, held, table)

    def read(self) -> DataFrame:
        return self.spark.table(self.table)

    def add(self, groups: DataFrame, batch: str) -> DataFrame:
        """Append what is new in ``groups`` (digest, first_id, group_size); returns every group with its ``keep_id``.

        A batch whose earlier attempt was cut short can be added again: digests already there are not appended twice.
        """
        known = self.read().select("digest", "keep_id")
        # The anti-join's hint keeps the index side in its buckets instead of sending it to every executor.
        fresh = groups.join(known.hint("merge"), "digest", "left_anti")
        fresh = fresh.select("digest", F.col("first_id").alias("keep_id"), F.lit(batch).alias("batch"))
        (
            fresh.repartition(self.buckets, "digest")
            .write.mode("append")
            .format("parquet")
            .bucketBy(self.buckets, "digest")
            .sortBy("digest")
            .option("path", self.path)
            .saveAsTable(self.table)
        )
        self.spark.catalog.refreshTable(self.table)
        return groups.join(self.read().select("digest", "keep_id", "batch").hint("merge"), "digest")


def deduplicate(
    docs: DataFrame,
    index: DigestIndex,
    batch: str,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size (rows of this batch), kept, text_sha256.

    Of equal texts the row already in the index stays, else the one with the smallest id of the batch.  Null texts are
    empty texts and form one group.  A null id is larger than every id, so such a row stays only if no row of its group
    has an id; then ``keep_id`` is null.  Of rows repeated with the id that stays all are marked ``kept`` (they cannot
    be told apart; ``keep_first`` drops the surplus).  Other columns of ``docs`` are not read.

    Digests are computed once and written; groups are counted with partial sums before the shuffle.  A text that a
    third of all rows share is one row of the group table, and the join of rows with groups reads two written tables,
    so adaptive execution splits that key.
    """
    require(docs, id_col, text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), digest(F.col(f"`{text_col}`")).alias("digest"))
    rows = store(rows, "digests")
    groups = rows.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("group_size"))
    decided = store(index.add(store(groups, "groups"), batch), "decided")
    return rows.join(decided, "digest").select(
        "doc_id",
        "keep_id",
        "group_size",
        ((F.col("batch") == batch) & F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def temporary_index(spark: SparkSession) -> DigestIndex:
    """An empty index in the shared folder, for one run."""
    return DigestIndex.open(spark, scratch_path(spark, "digest-index"))


def keep_first(
    docs: DataFrame, index: DigestIndex, batch: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; of several rows that tie for a group, any one."""
    verdict = deduplicate(docs, index, batch, id_col, text_col).where("kept")
    verdict = verdict.groupBy("doc_id", F.unhex("text_sha256").alias("digest")).agg(F.count(F.lit(1)).alias("rows"))
    verdict = store(verdict, "kept").withColumnsRenamed({"doc_id": "kept_id", "digest": "kept_digest"})
    name = fresh(docs, "digest")
    marked = docs.withColumn(name, digest(F.col(f"`{text_col}`")))

    def rows(of: DataFrame) -> DataFrame:
        same = marked[id_col].cast("long").eqNullSafe(of["kept_id"]) & (marked[name] == of["kept_digest"])
        return marked.join(of, same, "left_semi")

    single, ties = rows(verdict.where("rows = 1")), verdict.where("rows > 1")
    if ties.isEmpty():
        return single.drop(name)
    return single.unionByName(rows(ties).dropDuplicates([name])).drop(name)
