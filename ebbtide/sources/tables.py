"""Catalogue tables and SQL over them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ebbtide.schemas import CUSTOMERS, EVENTS
from ebbtide.sources.raw import export_features

BASE_TABLES: dict[str, StructType] = {"customers": CUSTOMERS, "events": EVENTS}


def create_base_tables(spark: SparkSession) -> None:
    """Empty base tables with the declared schemas, left alone when they exist."""
    for name, schema in BASE_TABLES.items():
        if not spark.catalog.tableExists(name):
            spark.createDataFrame([], schema).write.format("parquet").saveAsTable(name)


def register_views(frames: Mapping[str, DataFrame]) -> None:
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)


def run_sql(
    spark: SparkSession,
    statements: str | Sequence[str],
    args: Mapping[str, Any] | None = None,
    output_path: str | None = None,
) -> DataFrame | None:
    """Run the statements in turn with named parameters; the last result is returned and may be saved.

    One text is one statement, of which Spark's parser understands every comment and literal.  Each statement gets the
    parameters whose names occur in it.
    """
    result = None
    for statement in [statements] if isinstance(statements, str) else statements:
        used = {k: v for k, v in (args or {}).items() if f":{k}" in statement}
        result = spark.sql(statement, args=used or None)
    if output_path is not None and result is not None:
        export_features(result, output_path)
    return result


def run_sql_file(
    spark: SparkSession,
    paths: str | Sequence[str],
    args: Mapping[str, Any] | None = None,
    output_path: str | None = None,
) -> DataFrame | None:
    """As ``run_sql`` for files that Spark can read, one statement in each, in the order given."""
    reader = spark.read.option("wholetext", "true")
    texts = [reader.text(p).first()[0] for p in ([paths] if isinstance(paths, str) else paths)]
    return run_sql(spark, texts, args, output_path)


def execute_query(spark: SparkSession, query: str, **args) -> DataFrame:
    """The result of one query with named parameters."""
    return spark.sql(query, args=args or None)


def save_table(df: DataFrame, name: str = "features", path: str | None = None) -> DataFrame:
    """Create or replace a catalogue table and return it; ``path`` keeps its files outside the warehouse."""
    writer = df.write.mode("overwrite").format("parquet")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def save_bucketed(
    df: DataFrame, name: str, key: str = "customer_id", buckets: int = 64, path: str | None = None
) -> DataFrame:
    """Create or replace a catalogue table whose files are dealt by ``key`` and sorted within a bucket.

    Tables with the same number of buckets join and aggregate by ``key`` without moving rows: give customers, snapshots
    and whatever meets them the same ``buckets``.  One file is written per bucket.  A key with very many rows makes one
    large file, so this is for tables with a bounded number of rows per key.
    """
    writer = df.repartition(buckets, key).write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def load_table(spark: SparkSession, name: str = "features") -> DataFrame:
    return spark.table(name)
