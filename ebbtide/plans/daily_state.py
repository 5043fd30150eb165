"""Daily state of customers: what a snapshot needs of the event log, kept by day and merged when it is read.

One row holds the additive measures of a customer, day and type.  Batches of events are collapsed to such rows once and
written as dated partitions in a folder of their own; a snapshot of any window reads the days it needs and no raw event.
Rows of one customer, day and type from several batches (late events) add up, because the feature operators take partial
sums of any grain.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.operators.features import (
    EVENT_TYPES,
    VALUED_TYPES,
    ObservationWindow,
    daily_type_activity,
    features_of_activity,
    log_activity,
)

# Registers of the sketch of a customer's types, as a power of two; its error is about 1.04 / 2^(this / 2).
SKETCH_BITS = 12


@dataclass(frozen=True)
class DailyState:
    """The state below ``path``: ``batch=<name>/event_date=<day>/`` files."""

    spark: SparkSession
    path: str

    def _stored(self) -> T.StructType | None:
        try:
            return self.spark.read.parquet(self.path).schema
        except AnalysisException as error:
            if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise

    def add(self, events: DataFrame, batch: str) -> None:
        """Collapse ``events`` and write them as ``batch``; a batch of that name is replaced, so adding it again is safe.

        Events without a timestamp belong to no day and to no window.  Events collapse with partial sums before they
        move, and rows of a day are written by a few tasks however many tasks have read them; a busy day is split.
        """
        if not batch or not batch.replace("-", "").replace("_", "").isalnum():
            raise ValueError(f"batch name {batch!r}: letters, digits, - and _ are possible")
        daily = daily_type_activity(log_activity(events.filter(F.col("event_timestamp").isNotNull())))
        stored = self._stored()
        for field in daily.schema:
            if stored is not None and field.name in stored.names and stored[field.name].dataType != field.dataType:
                kind = stored[field.name].dataType.simpleString()
                raise ValueError(f"{field.name} is {kind} in the state and {field.dataType.simpleString()} in the batch")
        rows = daily.hint("rebalance", F.col("event_date"))
        rows.write.mode("overwrite").partitionBy("event_date").parquet(f"{self.path}/batch={batch}")

    def read(self, start: date | None = None, end: date | None = None) -> DataFrame:
        """Activity relation of the half-open range of days; files of other days are not read."""
        stored = self._stored()
        if stored is None:
            raise ValueError(f"no batch was added to {self.path}")
        # The day is a date whatever the folder names look like, and a batch name is a text.
        kinds = {"event_date": T.DateType(), "batch": T.StringType()}
        schema = T.StructType([T.StructField(f.name, kinds.get(f.name, f.dataType)) for f in stored])
        rows = self.spark.read.schema(schema).parquet(self.path)
        day = F.col("event_date")
        if start is not None:
            rows = rows.filter(day >= F.lit(start))
        if end is not None:
            rows = rows.filter(day < F.lit(end))
        return rows.drop("batch")

    def batches(self) -> DataFrame:
        """Batches with their first and last day and events, from the narrow columns only."""
        stored = self._stored()
        if stored is None:
            return self.spark.createDataFrame([], "batch string, first_day date, last_day date, events long")
        rows = self.spark.read.parquet(self.path)
        day = F.col("event_date").cast("date")
        return rows.groupBy(F.col("batch").cast("string").alias("batch")).agg(
            F.min(day).alias("first_day"), F.max(day).alias("last_day"), F.sum("events").alias("events")
        )

    def snapshot(
        self,
        customers: DataFrame,
        window: ObservationWindow,
        event_types=EVENT_TYPES,
        valued_types=VALUED_TYPES,
        require_signup: bool = False,
        carry=(),
    ) -> DataFrame:
        """The feature table of ``compute_features`` at ``window.end``, from days instead of events."""
        activity = self.read(window.start, window.end)
        return features_of_activity(customers, activity, window, event_types, valued_types, require_signup, carry)

    def compact(self, path: str, before: date | None = None) -> DailyState:
        """A new state at ``path`` with one row per customer, day and type and one batch; this one is left as it is."""
        merged = daily_type_activity(self.read(end=before)).hint("rebalance", F.col("event_date"))
        merged.write.mode("overwrite").partitionBy("event_date").parquet(f"{path}/batch=merged")
        return DailyState(self.spark, path)


def type_sketches(activity: DataFrame, bits: int = SKETCH_BITS) -> DataFrame:
    """One HyperLogLog sketch of types per customer and day, to be stored beside the state.

    Sketches of any days merge, so distinct types of any window cost one small row per customer and day however many
    types there are.  ``distinct_types`` stays the exact form.
    """
    return activity.groupBy("customer_id", "event_date").agg(
        F.hll_sketch_agg("event_type", bits).alias("types")
    )


def estimated_types(sketches: DataFrame, window: ObservationWindow) -> DataFrame:
    """``estimated_event_types`` per customer in the window, by merging the sketches of its days."""
    day = F.col("event_date")
    kept = sketches.filter((day >= F.lit(window.start)) & (day < F.lit(window.end)))
    merged = kept.groupBy("customer_id").agg(F.hll_union_agg("types").alias("types"))
    return merged.select("customer_id", F.hll_sketch_estimate("types").alias("estimated_event_types"))
