"""Intermediate tables in the folder that all executors share, and joins of verdicts with whole rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.session import scratch_path


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage: a lost executor costs the reading of a file, not the recomputation of the plan.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def require(df: DataFrame, *columns: str) -> None:
    """Fail early, naming the missing columns."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns {missing} are not in {df.columns}")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_key(text: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit("")))


def keep_rows(docs: DataFrame, verdict: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows of ``docs`` whose id and text are among ``doc_id`` and ``text_key`` of ``verdict``; null ids match.

    The keys are made distinct and narrow; the texts move once, by a key that no two different rows share.
    """
    keys = verdict.select(F.col("doc_id").alias("kept_id"), F.col("text_key").alias("kept_key")).distinct()
    same = docs[id_col].cast("long").eqNullSafe(keys["kept_id"]) & (text_key(text_col) == keys["kept_key"])
    return docs.join(keys, same, "left_semi")
