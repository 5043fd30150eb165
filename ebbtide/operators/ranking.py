"""Global ranks and running totals without a one-task window.

For ranks, a range sort by a unique key gives balanced, ordered partitions even when one key
value holds a large share of the rows, because the tie-break column is part of the
sort.  The sorted narrow frame is checkpointed, which fixes partition numbers and
positions; the totals of whole partitions then give each partition its offset.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.session import materialise

# monotonically_increasing_id keeps the position within the partition in its low 33 bits.
_POSITION_BITS = 33
# The cuts between ranges are held by the driver and every task.
MOST_RANGES = 10_000


def _sorted_positions(df: DataFrame, order: Sequence[Column], group: Sequence[str]) -> DataFrame:
    position = F.monotonically_increasing_id()
    return materialise(
        df.orderBy(*group, *order)
        .withColumn("_position", position)
        .withColumn("_part", F.shiftrightunsigned("_position", _POSITION_BITS))
    )


def rank_rows(df: DataFrame, order: Sequence[Column], group: Sequence[str] = ()) -> DataFrame:
    """Add ``rank`` (1-based within the group) and ``group_rows``; ``order`` must be unique in a group.

    Pass only the columns that are needed: all of them are sorted and written once.
    """
    placed = _sorted_positions(df, order, group)
    segment = [*group, "_part"]
    sizes = placed.groupBy(*segment).agg(F.count(F.lit(1)).alias("_n"), F.min("_position").alias("_first"))
    # At most one row per partition, plus one per group that starts inside a partition.
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        *segment,
        "_first",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy(*group)).alias("group_rows"),
    )
    rank = F.col("_position") - F.col("_first") + F.col("_before") + 1
    return (
        placed.join(offsets, segment)
        .withColumn("rank", rank)
        .drop("_position", "_part", "_first", "_before")
    )


def running_totals(
    df: DataFrame,
    order: str,
    sums: Sequence[str],
    group: Sequence[str] = (),
    following: Sequence[str] = (),
    like: tuple[DataFrame, str] | None = None,
    ascending: bool = False,
) -> DataFrame:
    """Add ``cum_<c>`` and ``all_<c>`` for each summed column, and ``next_<c>`` for the following row.

    ``order`` is a number, not null and unique in a group.  A sketch of it cuts the numbers into as many ranges as there
    are shuffle partitions; rows move once, by group and range, running sums are taken within a range and shifted by the
    totals of the ranges before it.  ``like`` names a frame and column with the same distribution that are cheaper to
    read for the sketch.  Ranges only decide where rows go: the sums are exact however good the sketch is.
    """
    ranged = _ranged(df, order, like or (df, order))
    segment = [*group, "_range"]
    sign = 1 if ascending else -1
    firsts = [(F.min_by if ascending else F.max_by)(c, order).alias(f"_first_{c}") for c in following]
    totals = ranged.groupBy(*segment).agg(*[F.sum(c).alias(f"_sum_{c}") for c in sums], *firsts)
    # At most one row per group and range.
    by_range = Window.partitionBy(*group).orderBy(F.col("_range") * sign)
    before = by_range.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    offsets = totals.select(
        *segment,
        *[F.coalesce(F.sum(f"_sum_{c}").over(before), F.lit(0)).alias(f"_before_{c}") for c in sums],
        *[F.sum(f"_sum_{c}").over(whole).alias(f"all_{c}") for c in sums],
        *[F.lead(f"_first_{c}").over(by_range).alias(f"_after_{c}") for c in following],
    )
    local = Window.partitionBy(*segment).orderBy(F.asc(order) if ascending else F.desc(order))
    running = local.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = ranged.select(
        "*",
        *[F.sum(c).over(running).alias(f"_local_{c}") for c in sums],
        *[F.lead(c).over(local).alias(f"_lead_{c}") for c in following],
        F.lead(F.lit(1)).over(local).isNull().alias("_last"),
    )
    joined = summed.join(offsets, segment)
    return joined.select(
        *df.columns,
        *[(F.col(f"_local_{c}") + F.col(f"_before_{c}")).alias(f"cum_{c}") for c in sums],
        *[F.col(f"all_{c}") for c in sums],
        *[F.when(F.col("_last"), F.col(f"_after_{c}")).otherwise(F.col(f"_lead_{c}")).alias(f"next_{c}")
          for c in following],
    )


def _ranged(df: DataFrame, column: str, like: tuple[DataFrame, str]) -> DataFrame:
    """Add ``_range``, the number of the range that ``column`` lies in, by the quantiles of ``like``."""
    ranges = min(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), MOST_RANGES)
    shares = [i / ranges for i in range(1, ranges)]
    cuts = []
    if shares:
        frame, name = like
        sketch = F.percentile_approx(F.col(name).cast("double"), shares, 10 * ranges)
        cuts = sorted({c for c in frame.agg(sketch).first()[0] or [] if abs(c) < float("inf")})
    if not cuts:
        return df.withColumn("_range", F.lit(0))
    # The search for the range runs in the JVM.
    splits = [-float("inf"), *cuts, float("inf")]
    number = df.withColumn("_number", F.col(column).cast("double"))
    found = Bucketizer(splits=splits, inputCol="_number", outputCol="_bucket").transform(number)
    return found.withColumn("_range", F.col("_bucket").cast("int")).drop("_number", "_bucket")
