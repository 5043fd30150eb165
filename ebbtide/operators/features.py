"""Behavioural features and inactivity labels from customers and an event log.

Everything is computed from an *activity* relation: ``customer_id, event_date,
event_type`` with the additive measures ``events, value, peak_events`` and the
maximum ``value_max``.  One row per raw event and one row per (customer, day,
type) are both valid grains, so the same aggregates run over either.

The full table first collapses events to (customer, day) with map-side partial
sums, and only then moves rows by customer.  A customer therefore never brings more
than one row per day to one task, however many events it has.  Distinct types are
counted beside it from (customer, type) pairs.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.functions.expressions import (
    DEFAULT_DAYS_AGO,
    DEFAULT_NUMBER,
    DEFAULT_TEXT,
    day_of_week,
    days_between,
    midnight,
    positive_ratio,
    safe_ratio,
    total_when,
)

# Look-backs, weekend days (Sunday is 0), inclusive peak hours, pivoted types.
ROLLING_DAYS = (7, 14, 30)
WEEKEND = (0, 6)
PEAK_HOURS = (9, 17)
EVENT_TYPES = ("purchase", "login", "page_view")
VALUED_TYPES = ("purchase",)

MEASURES = ("events", "value", "value_max", "peak_events")


@dataclass(frozen=True)
class ObservationWindow:
    """Look-back of ``days`` ending before ``end``; inactive after ``churn_days`` without events."""

    end: date
    days: int = 90
    churn_days: int = 30

    @property
    def start(self) -> date:
        return self.end - timedelta(days=self.days)

    def cut(self, days: int) -> Column:
        return F.lit(self.end - timedelta(days=days))

    def days_since(self, day: Column) -> Column:
        return days_between(F.lit(self.end), day)


def window_events(events: DataFrame, window: ObservationWindow, partition_column: str | None = None) -> DataFrame:
    """Events of the half-open window.  The bounds apply to the raw timestamp, so the scan gets them.

    ``partition_column`` names a date column the log is partitioned by; whole partitions are skipped.
    """
    stamp = F.col("event_timestamp")
    kept = events.filter((stamp >= midnight(window.start)) & (stamp < midnight(window.end)))
    if partition_column:
        day = F.col(partition_column)
        kept = kept.filter((day >= F.lit(window.start)) & (day < F.lit(window.end)))
    return kept


def _minor_units(events: DataFrame) -> Column:
    """The value with 0 for a missing one; exact amounts become whole hundredths.

    Sums of long integers stay exact and in generated code, unlike sums of wide decimals.
    """
    kind = events.schema["event_value"].dataType
    value = F.coalesce("event_value", F.lit(DEFAULT_NUMBER).cast(kind))
    if isinstance(kind, T.DecimalType) and kind.scale <= 2 and kind.precision <= 18:
        return (value * 100).cast("bigint")
    if isinstance(kind, T.IntegralType):
        return value.cast("bigint") * 100
    return value


def value_unit(activity: DataFrame) -> float:
    """How many units of the ``value`` measure make one unit of money."""
    return 100.0 if isinstance(activity.schema["value"].dataType, T.LongType) else 1.0


def _amount(value: Column, unit: float) -> Column:
    return value.cast("double") / F.lit(unit)


def event_activity(events: DataFrame, window: ObservationWindow, partition_column: str | None = None) -> DataFrame:
    """Activity relation with one row per event of the window; a missing value counts as 0."""
    return log_activity(window_events(events, window, partition_column))


def log_activity(events: DataFrame) -> DataFrame:
    """The same for all events of the log."""
    value = _minor_units(events)
    hour = F.hour("event_timestamp")
    return events.select(
        "customer_id",
        F.to_date("event_timestamp").alias("event_date"),
        "event_type",
        F.lit(1).cast("bigint").alias("events"),
        value.alias("value"),
        value.alias("value_max"),
        F.when(hour.between(*PEAK_HOURS), 1).otherwise(0).cast("bigint").alias("peak_events"),
    )


def _combine() -> list[Column]:
    return [F.max(m).alias(m) if m == "value_max" else F.sum(m).alias(m) for m in MEASURES]


def daily_type_activity(activity: DataFrame) -> DataFrame:
    """Activity at (customer, day, type) grain: bounded rows per customer."""
    return activity.groupBy("customer_id", "event_date", "event_type").agg(*_combine())


def daily_activity(activity: DataFrame) -> DataFrame:
    """Number of events per customer and active day."""
    return activity.groupBy("customer_id", "event_date").agg(F.sum("events").alias("daily_events"))


# --- aggregates over the activity relation, grouped by customer -------------------------------


def recency(window: ObservationWindow) -> list[Column]:
    return [
        window.days_since(F.max("event_date")).alias("days_since_last_event"),
        window.days_since(F.min("event_date")).alias("days_since_first_event"),
    ]


def frequency(window: ObservationWindow) -> list[Column]:
    total = F.sum("events")
    return [
        total.alias("total_events"),
        (total.cast("double") / F.lit(float(window.days))).alias("events_per_day"),
    ]


def monetary(unit: float) -> list[Column]:
    total = _amount(F.sum("value"), unit)
    return [
        total.alias("total_revenue"),
        safe_ratio(total, F.sum("events")).alias("avg_event_value"),
        _amount(F.max("value_max"), unit).alias("max_event_value"),
    ]


def rolling(window: ObservationWindow, unit: float, days: Sequence[int] = ROLLING_DAYS) -> list[Column]:
    """Counts and revenue of the last n days; days start at midnight, so the date decides."""
    day = F.col("event_date")
    counts = [total_when(day >= window.cut(n), F.col("events")).alias(f"events_last_{n}d") for n in days]
    money = [
        _amount(total_when(day >= window.cut(n), F.col("value")), unit).alias(f"revenue_last_{n}d") for n in days
    ]
    return counts + money


def patterns() -> list[Column]:
    weekend = total_when(day_of_week(F.col("event_date")).isin(*WEEKEND), F.col("events"))
    return [
        safe_ratio(weekend, F.sum("events")).alias("weekend_activity_ratio"),
        F.sum("peak_events").alias("peak_hour_activity"),
    ]


def type_suffix(event_type: str | None) -> str:
    """Letters and digits of any alphabet stay; a missing type and one without letters have names of their own."""
    if event_type is None:
        return "missing_type"
    return re.sub(r"[\W_]+", "_", event_type.lower()).strip("_") or "unnamed_type"


def type_suffixes(event_types: Sequence[str | None]) -> list[str]:
    """Column suffixes of the listed types; two types with one suffix are an error."""
    suffixes = [type_suffix(name) for name in event_types]
    clashing = sorted({s for s in suffixes if suffixes.count(s) > 1})
    if clashing:
        raise ValueError(f"event types share the column suffix {', '.join(clashing)}: pass types that differ")
    return suffixes


def is_type(name: str | None) -> Column:
    return F.col("event_type").eqNullSafe(F.lit(name).cast("string"))


def per_type(
    window: ObservationWindow,
    unit: float,
    event_types: Sequence[str] = EVENT_TYPES,
    valued_types: Sequence[str] = VALUED_TYPES,
) -> list[Column]:
    """Count, mean value and days since the last event for each listed type."""
    out = []
    for name, suffix in zip(event_types, type_suffixes(event_types)):
        hit = is_type(name)
        count = total_when(hit, F.col("events"))
        out.append(count.alias(f"count_{suffix}"))
        if name in valued_types:
            total = _amount(total_when(hit, F.col("value")), unit)
            out.append(safe_ratio(total, count).alias(f"avg_{suffix}_value"))
        last = window.days_since(F.max(F.when(hit, F.col("event_date"))))
        out.append(F.coalesce(last, F.lit(DEFAULT_DAYS_AGO).cast("bigint")).alias(f"last_{suffix}_days_ago"))
    return out


def inactivity_label(window: ObservationWindow) -> Column:
    """1 when the last event is before the start of the churn look-back, else 0."""
    return F.when(F.max("event_date") < window.cut(window.churn_days), 1).otherwise(0)


def trend_ratios(days: Sequence[int] = ROLLING_DAYS) -> list[Column]:
    """Shorter look-backs as a share of the longest one, for counts and revenue."""
    *short, longest = sorted(days)
    return [
        positive_ratio(F.col(f"{kind}s_last_{n}d" if kind == "event" else f"{kind}_last_{n}d"),
                       F.col(f"{kind}s_last_{longest}d" if kind == "event" else f"{kind}_last_{longest}d"))
        .alias(f"{kind}_trend_{n}d_{longest}d")
        for kind in ("event", "revenue")
        for n in short
    ]


def activity_slope(x: Column, y: Column) -> Column:
    """Least-squares slope of y over x (whole days), 0 with a single active day.

    The sums are whole numbers, so the result does not depend on the order of rows.
    """
    n = F.count(F.lit(1))
    top = n * F.sum(x * y) - F.sum(x) * F.sum(y)
    bottom = n * F.sum(x * x) - F.sum(x) * F.sum(x)
    return safe_ratio(top, bottom)


def activity_consistency(daily: Column) -> Column:
    """Coefficient of variation over active days, 0 with a single active day."""
    return safe_ratio(F.stddev_samp(daily), F.avg(daily))


# --- single-purpose operators: one shuffle by customer with map-side partial sums -------------


def per_customer(activity: DataFrame, *columns: Column) -> DataFrame:
    return activity.groupBy("customer_id").agg(*columns)


def rolling_windows(activity: DataFrame, window: ObservationWindow, days: Sequence[int] = ROLLING_DAYS) -> DataFrame:
    return per_customer(activity, *rolling(window, value_unit(activity), days)).select("*", *trend_ratios(days))


def time_patterns(activity: DataFrame) -> DataFrame:
    return per_customer(activity, *patterns())


def event_type_features(
    activity: DataFrame,
    window: ObservationWindow,
    event_types: Sequence[str] = EVENT_TYPES,
    valued_types: Sequence[str] = VALUED_TYPES,
) -> DataFrame:
    return per_customer(activity, *per_type(window, value_unit(activity), event_types, valued_types))


def event_type_long(activity: DataFrame, window: ObservationWindow) -> DataFrame:
    """Count, mean value and days since the last event for every type, one row per customer and type.

    The form for any number of types; ``event_type_features`` makes columns of the types that are listed.
    """
    unit, total = value_unit(activity), F.sum("events")
    return activity.groupBy("customer_id", "event_type").agg(
        total.alias("n_events"),
        safe_ratio(_amount(F.sum("value"), unit), total).alias("avg_value"),
        window.days_since(F.max("event_date")).alias("last_days_ago"),
    )


def event_types(activity: DataFrame) -> DataFrame:
    """The types of the window with their events, from which a caller picks the ones to make columns of."""
    return activity.groupBy("event_type").agg(F.sum("events").alias("n_events"))


def churn_labels(activity: DataFrame, window: ObservationWindow) -> DataFrame:
    return per_customer(activity, inactivity_label(window).alias("label"))


def activity_trend(activity: DataFrame, window: ObservationWindow) -> DataFrame:
    """Slope and consistency of the daily counts."""
    x = days_between(F.col("event_date"), F.lit(window.start))
    y = F.col("daily_events")
    return (
        daily_activity(activity)
        .groupBy("customer_id")
        .agg(
            F.min("event_date").alias("first_active_date"),
            activity_slope(x, y).alias("activity_slope"),
            activity_consistency(y).alias("activity_consistency"),
        )
    )


def _type_columns(event_types: Sequence[str], valued_types: Sequence[str]) -> list[tuple[str, Column]]:
    """Per-type count and value measures carried along with the daily rows."""
    out = []
    for i, name in enumerate(event_types):
        hit = is_type(name)
        out.append((f"_n{i}", F.coalesce(F.sum(F.when(hit, F.col("events"))), F.lit(0))))
        if name in valued_types:
            out.append((f"_v{i}", F.sum(F.when(hit, F.col("value")))))
    return out


def _customer_days(activity: DataFrame, event_types: Sequence[str | None], valued_types: Sequence[str]) -> DataFrame:
    """One row per customer and active day, placed by customer."""
    carried = [column.alias(name) for name, column in _type_columns(event_types, valued_types)]
    return activity.groupBy("customer_id", "event_date").agg(*_combine(), *carried).repartition("customer_id")


def distinct_types(activity: DataFrame) -> DataFrame:
    """``unique_event_types`` per customer, for any number of types; a missing type is none.

    Repeated types collapse before anything moves, and (customer, type) pairs are spread by both, so neither a busy
    customer nor one with very many types is a hot task.
    """
    pairs = activity.select("customer_id", "event_type").distinct()
    return pairs.groupBy("customer_id").agg(F.count("event_type").alias("unique_event_types"))


def rfm_features(activity: DataFrame, window: ObservationWindow) -> DataFrame:
    """Recency, frequency (with distinct types and days) and monetary value per customer."""
    by_day = _customer_days(activity, (), ())
    measures = by_day.groupBy("customer_id").agg(
        *recency(window),
        *frequency(window),
        F.count(F.lit(1)).alias("active_days"),
        *monetary(value_unit(activity)),
    )
    return _with_types(measures, activity)


def _with_types(measures: DataFrame, activity: DataFrame) -> DataFrame:
    """Both sides are placed by customer, so the join moves nothing; a null customer is one customer."""
    types = distinct_types(activity).withColumnRenamed("customer_id", "_customer")
    joined = measures.join(types, F.col("customer_id").eqNullSafe(F.col("_customer")))
    return joined.drop("_customer")


def customer_rollup(
    activity: DataFrame,
    window: ObservationWindow,
    event_types: Sequence[str | None] = EVENT_TYPES,
    valued_types: Sequence[str] = VALUED_TYPES,
) -> DataFrame:
    """All event-based features and the label, one row per active customer."""
    unit = value_unit(activity)
    by_day = _customer_days(activity, event_types, valued_types)
    suffixes = type_suffixes(event_types)

    by_type = []
    for i, name in enumerate(event_types):
        suffix = suffixes[i]
        count = F.sum(f"_n{i}")
        by_type.append(count.alias(f"count_{suffix}"))
        if name in valued_types:
            by_type.append(safe_ratio(_amount(F.sum(f"_v{i}"), unit), count).alias(f"avg_{suffix}_value"))
        last = window.days_since(F.max(F.when(F.col(f"_n{i}") > 0, F.col("event_date"))))
        by_type.append(F.coalesce(last, F.lit(DEFAULT_DAYS_AGO).cast("bigint")).alias(f"last_{suffix}_days_ago"))

    x = days_between(F.col("event_date"), F.lit(window.start))
    y = F.col("events")
    measures = by_day.groupBy("customer_id").agg(
        inactivity_label(window).alias("label"),
        *recency(window),
        *frequency(window),
        F.count(F.lit(1)).alias("active_days"),
        *monetary(unit),
        *rolling(window, unit),
        activity_slope(x, y).alias("activity_slope"),
        *patterns(),
        activity_consistency(y).alias("activity_consistency"),
        *by_type,
    )
    return _with_types(measures, activity)


def compute_features(
    customers: DataFrame,
    events: DataFrame,
    window: ObservationWindow,
    event_types: Sequence[str] = EVENT_TYPES,
    valued_types: Sequence[str] = VALUED_TYPES,
    partition_column: str | None = None,
    require_signup: bool = False,
    carry: Sequence[str] = (),
) -> DataFrame:
    """One row per customer with activity in the window: profile, label and all features.

    ``require_signup`` drops customers without a signup date instead of leaving their age null.
    ``carry`` names columns of ``customers`` to add at the end, such as the date to split by.
    """
    activity = event_activity(events, window, partition_column)
    return features_of_activity(customers, activity, window, event_types, valued_types, require_signup, carry)


def features_of_activity(
    customers: DataFrame,
    activity: DataFrame,
    window: ObservationWindow,
    event_types: Sequence[str] = EVENT_TYPES,
    valued_types: Sequence[str] = VALUED_TYPES,
    require_signup: bool = False,
    carry: Sequence[str] = (),
) -> DataFrame:
    """The feature table from an activity relation that holds the days of the window, at any grain."""
    rollup = customer_rollup(activity, window, event_types, valued_types)
    profiles = customers.select(
        "customer_id",
        F.coalesce("country", F.lit(DEFAULT_TEXT)).alias("country"),
        F.coalesce("plan_type", F.lit(DEFAULT_TEXT)).alias("plan_type"),
        window.days_since(F.col("signup_date")).alias("customer_age_days"),
        F.coalesce(F.col("monthly_revenue").cast("double"), F.lit(0.0)).alias("monthly_revenue"),
        *carry,
    )
    if require_signup:
        profiles = profiles.filter(F.col("customer_age_days").isNotNull())

    typed = []
    for name, suffix in zip(event_types, type_suffixes(event_types)):
        typed.append(f"count_{suffix}")
        if name in valued_types:
            typed.append(f"avg_{suffix}_value")
        typed.append(f"last_{suffix}_days_ago")

    return profiles.join(rollup, "customer_id").select(
        "customer_id",
        "label",
        "country",
        "plan_type",
        "customer_age_days",
        "monthly_revenue",
        "days_since_last_event",
        "days_since_first_event",
        "total_events",
        "unique_event_types",
        "events_per_day",
        "active_days",
        "total_revenue",
        "avg_event_value",
        "max_event_value",
        *[f"events_last_{n}d" for n in ROLLING_DAYS],
        *[f"revenue_last_{n}d" for n in ROLLING_DAYS],
        *trend_ratios(),
        "activity_slope",
        "weekend_activity_ratio",
        "peak_hour_activity",
        "activity_consistency",
        *typed,
        *carry,
    )
