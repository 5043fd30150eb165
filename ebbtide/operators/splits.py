"""Time-ordered splits and stratified folds."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.operators.ranking import rank_rows
from ebbtide.operators.selection import keys_at_ranks, literal, sortable

SPLITS = ("train", "validation", "test")


def _order_key(df: DataFrame, date_col: str | None, id_col: str) -> Column:
    """Total order as one comparable struct: missing dates last, ties by id."""
    parts = [sortable(df, id_col)]
    if date_col and date_col in df.columns:
        parts = [F.col(date_col).isNull(), sortable(df, date_col), *parts]
    return F.struct(*[p.alias(f"k{i}") for i, p in enumerate(parts)])


def temporal_split(
    df: DataFrame,
    train_pct: float = 0.6,
    valid_pct: float = 0.2,
    test_pct: float = 0.2,
    date_col: str | None = None,
    id_col: str = "customer_id",
) -> DataFrame:
    """Add ``split``: the first share of rows in time order is train, the next validation, the rest test.

    Rows are ordered by ``date_col`` and ``id_col`` (only ``id_col`` without a date column).  The two boundary keys are
    selected from these columns, which are cached meanwhile; no row is sorted or moved, and the wide rows are labelled by
    comparison.  ``df`` is read for that when this is called.
    """
    if abs(train_pct + valid_pct + test_pct - 1.0) > 1e-6:
        raise ValueError("train, validation and test shares must sum to 1")
    key = _order_key(df, date_col, id_col)
    keys = df.select(key.alias("key")).persist()

    def ranks(rows: int) -> list[int]:
        # Truncation in double arithmetic, as for any float share.
        n_train = math.floor(rows * float(train_pct))
        return [n_train, n_train + math.floor(rows * float(valid_pct))]

    _, bounds = keys_at_ranks(keys, ranks)
    kind = keys.schema["key"].dataType
    keys.unpersist()
    # Without a key nothing comes before the bound.
    last_train, last_valid = (None if b is None else literal(b, kind) for b in bounds)
    split = (
        F.when(F.lit(False) if last_train is None else key <= last_train, F.lit(SPLITS[0]))
        .when(F.lit(False) if last_valid is None else key <= last_valid, F.lit(SPLITS[1]))
        .otherwise(F.lit(SPLITS[2]))
    )
    return df.withColumn("split", split)


def select_split(df: DataFrame, name: str) -> DataFrame:
    if name not in SPLITS:
        raise ValueError(f"unknown split {name!r}: expected one of {', '.join(SPLITS)}")
    return df.filter(F.col("split") == name)


def split_frames(df: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    return tuple(select_split(df, s) for s in SPLITS)


def stratified_folds(
    df: DataFrame, folds: int = 5, label_col: str = "label", order: Sequence[str] = ("customer_id",)
) -> DataFrame:
    """Keys with a ``fold`` of 0..k-1: contiguous blocks per class in row order, sizes differing by one at most."""
    ranked = rank_rows(df.select(label_col, *order), [F.asc(c) for c in order], group=[label_col])
    position, rows = F.col("rank") - 1, F.col("group_rows")
    small, longer = F.floor(rows / folds), rows % folds
    # The first ``longer`` blocks hold one row more than the others.
    head = longer * (small + 1)
    fold = F.when(position < head, F.floor(position / (small + 1))).otherwise(
        longer + F.floor((position - head) / F.greatest(small, F.lit(1)))
    )
    return ranked.select(*order, label_col, fold.cast("int").alias("fold"))
