"""Scalar column expressions: dates, safe ratios, defaults and type selection."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values that stand for "no such value" in the feature table.
DEFAULT_DAYS_AGO = 999
DEFAULT_NUMBER = 0
DEFAULT_TEXT = "unknown"


def days_between(later: Column, earlier: Column) -> Column:
    return F.datediff(later, earlier).cast("bigint")


def midnight(day: date) -> Column:
    """A day as a zone-free timestamp literal, comparable with raw timestamps in the scan."""
    return F.lit(day).cast("timestamp_ntz")


def day_of_week(ts: Column) -> Column:
    """Day of week with Sunday as 0."""
    return F.dayofweek(ts) - 1


def safe_ratio(numerator: Column, denominator: Column, default: float | None = 0.0) -> Column:
    """Double division; the default replaces an undefined quotient."""
    value = F.try_divide(numerator.cast("double"), denominator.cast("double"))
    return value if default is None else F.coalesce(value, F.lit(default))


def positive_ratio(numerator: Column, denominator: Column) -> Column:
    """Share of a positive total, 0 when the total is not positive."""
    return F.when(denominator > 0, F.try_divide(numerator.cast("double"), denominator.cast("double"))).otherwise(0.0)


def total_when(condition: Column, value: Column) -> Column:
    """Sum of ``value`` over the rows meeting the condition."""
    return F.sum(F.when(condition, value).otherwise(F.lit(0)))


def _is_floating(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType))


def is_missing(df: DataFrame, name: str) -> Column:
    """Null, or NaN for a floating-point column."""
    missing = F.col(name).isNull()
    return missing | F.isnan(name) if _is_floating(df, name) else missing


def present_double(df: DataFrame, name: str) -> Column:
    """The column as a double, null where it is missing."""
    value = F.col(name).cast("double")
    return F.nanvl(value, F.lit(None).cast("double")) if _is_floating(df, name) else value


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ("customer_id", "label")) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def text_columns(df: DataFrame, exclude: Iterable[str] = ("customer_id",)) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in skip]


def align_columns(df: DataFrame, expected: Sequence[str], fill: float = 0.0) -> DataFrame:
    """Exactly the expected columns in their order; absent ones get the fill value."""
    present = set(df.columns)
    return df.select(*[F.col(c) if c in present else F.lit(fill).alias(c) for c in expected])
