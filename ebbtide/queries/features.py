"""Feature queries."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.operators import features as ft
from ebbtide.plans.daily_state import DailyState, type_sketches
from ebbtide.plans.daily_state import estimated_types as type_estimates
from ebbtide.queries.common import (
    ACTIVITY_LOG_SQL,
    ACTIVITY_TYPES,
    ACTIVITY_WINDOW,
    CUSTOMERS_SQL,
    ORDER_LOG_SQL,
    ORDER_TYPES,
    ORDER_WINDOW,
    activity,
    activity_features,
    activity_log,
    age,
    customers,
    day,
    finish,
    labels_sql,
    order_features,
    order_log,
    rounded,
    share,
    whole,
    window_sql,
)
from ebbtide.session import scratch_path
from ebbtide.sources.tables import save_bucketed

W = ACTIVITY_WINDOW
BASE_SQL = f"WITH {ACTIVITY_LOG_SQL}, {window_sql(W)}"


def rfm_features(spark: SparkSession, folder: str) -> DataFrame:
    return finish(ft.rfm_features(activity(spark, folder), W))


def rfm_columns(window: ft.ObservationWindow) -> list[str]:
    return [
        whole(age(window, "max(d)"), "days_since_last_event"),
        whole(age(window, "min(d)"), "days_since_first_event"),
        whole("count(*)", "total_events"),
        whole("count(DISTINCT event_type)", "unique_event_types"),
        rounded(f"count(*) / CAST({window.days} AS DOUBLE)", "events_per_day"),
        whole("count(DISTINCT d)", "active_days"),
        rounded("sum(v)", "total_revenue"),
        rounded("CAST(sum(v) AS DOUBLE) / count(*)", "avg_event_value"),
        rounded("max(v)", "max_event_value"),
    ]


def rolling_columns(window: ft.ObservationWindow) -> list[str]:
    def last(n: int, value: str) -> str:
        return f"sum(CASE WHEN ts >= {day(window.end)} - INTERVAL {n} DAY THEN {value} ELSE 0 END)"

    out = [whole(last(n, "1"), f"events_last_{n}d") for n in (7, 14, 30)]
    out += [rounded(last(n, "v"), f"revenue_last_{n}d") for n in (7, 14, 30)]
    for kind, value in (("event", "1"), ("revenue", "v")):
        for n in (7, 14):
            ratio = (
                f"CASE WHEN {last(30, value)} > 0 THEN CAST({last(n, value)} AS DOUBLE) / "
                f"CAST({last(30, value)} AS DOUBLE) ELSE 0 END"
            )
            out.append(rounded(ratio, f"{kind}_trend_{n}d_30d"))
    return out


PATTERN_COLUMNS = [
    rounded("CAST(count(*) FILTER (WHERE dow IN (0, 6)) AS DOUBLE) / count(*)", "weekend_activity_ratio"),
    whole("count(*) FILTER (WHERE h BETWEEN 9 AND 17)", "peak_hour_activity"),
]


def type_columns(window: ft.ObservationWindow, types: Sequence[str], valued: Sequence[str]) -> list[str]:
    out = []
    for t in types:
        hit, suffix = f"FILTER (WHERE event_type = '{t}')", ft.type_suffix(t)
        out.append(whole(f"count(*) {hit}", f"count_{suffix}"))
        if t in valued:
            out.append(rounded(share(f"sum(v) {hit}", f"count(*) {hit}"), f"avg_{suffix}_value"))
        out.append(whole(f"coalesce({age(window, f'max(d) {hit}')}, 999)", f"last_{suffix}_days_ago"))
    return out


def per_customer_sql(columns: Sequence[str]) -> str:
    return f"{BASE_SQL} SELECT customer_id, {', '.join(columns)} FROM w GROUP BY customer_id"


def trend_sql(window: ft.ObservationWindow) -> str:
    return f"""dly AS (SELECT customer_id, d, count(*) AS n FROM w GROUP BY customer_id, d),
tr AS (
  SELECT customer_id, min(d) AS first_day,
         CASE WHEN count(*) > 1 THEN regr_slope(n, d - {day(window.start)}) ELSE 0 END AS slope,
         coalesce(stddev_samp(n) / avg(n), 0) AS consistency
  FROM dly GROUP BY customer_id)"""


def rolling_windows(spark: SparkSession, folder: str) -> DataFrame:
    return finish(ft.rolling_windows(activity(spark, folder), W))


def time_patterns(spark: SparkSession, folder: str) -> DataFrame:
    return finish(ft.time_patterns(activity(spark, folder)))


def daily_activity(spark: SparkSession, folder: str) -> DataFrame:
    return finish(ft.daily_activity(activity(spark, folder)))


def activity_trend(spark: SparkSession, folder: str) -> DataFrame:
    return finish(ft.activity_trend(activity(spark, folder), W))


def event_type_pivot(spark: SparkSession, folder: str) -> DataFrame:
    return finish(ft.event_type_features(activity(spark, folder), W, ACTIVITY_TYPES, ("purchase",)))


def event_type_pivot_all(spark: SparkSession, folder: str) -> DataFrame:
    return finish(ft.event_type_features(activity(spark, folder), W, ALL_TYPES, ALL_TYPES))


def event_type_long(spark: SparkSession, folder: str) -> DataFrame:
    return finish(ft.event_type_long(_with_odd_types(activity(spark, folder)), W))


def _with_odd_types(events: DataFrame) -> DataFrame:
    """Every seventh customer's types are missing, those of the next are one per customer, far over a hundred in all."""
    key = F.col("customer_id") % 7
    kind = F.when(key == 0, F.lit(None)).when(key == 1, F.concat(F.lit("only for "), "customer_id"))
    return events.withColumn("event_type", F.when(key > 1, F.col("event_type")).otherwise(kind))


def odd_event_types(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct types with missing and very many types, and columns for a missing type."""
    events = _with_odd_types(activity(spark, folder))
    rfm = ft.rfm_features(events, W).select("customer_id", "unique_event_types")
    return finish(rfm.join(ft.event_type_features(events, W, (None, "view"), ()), "customer_id"))


def churn_labels(spark: SparkSession, folder: str) -> DataFrame:
    labels = ft.churn_labels(activity(spark, folder), W)
    return finish(customers(spark, folder).select("customer_id", "country", "plan_type").join(labels, "customer_id"))


def customer_tenure(spark: SparkSession, folder: str) -> DataFrame:
    return finish(
        customers(spark, folder).select(
            "customer_id", ORDER_WINDOW.days_since(F.col("signup_date")).alias("customer_age_days")
        )
    )


def feature_table(spark: SparkSession, folder: str) -> DataFrame:
    return finish(activity_features(spark, folder))


def order_feature_table(spark: SparkSession, folder: str) -> DataFrame:
    return finish(order_features(spark, folder))


def _daily_state(spark: SparkSession, folder: str) -> DailyState:
    """The log added in two halves that share all days: first the mornings, then what came late, which is sent twice."""
    log = activity_log(spark, folder)
    state, late = DailyState(spark, scratch_path(spark, "daily-state")), F.hour("event_timestamp") >= 12
    state.add(log.filter(~late), "mornings")
    for _ in range(2):
        state.add(log.filter(late), "late")
    return state


def incremental_features(spark: SparkSession, folder: str) -> DataFrame:
    """The feature table from the daily state instead of the log."""
    state = _daily_state(spark, folder)
    return finish(state.snapshot(customers(spark, folder), W, ACTIVITY_TYPES, ("purchase",)))


def compacted_state(spark: SparkSession, folder: str) -> DataFrame:
    """The state of the month before the observation date, merged to one row per customer, day and type."""
    state = _daily_state(spark, folder).compact(scratch_path(spark, "compacted"), before=W.end)
    return finish(
        state.read(start=W.start).select(
            "customer_id", "event_date", "event_type", "events", (F.col("value") / 100).alias("value"), "peak_events"
        )
    )


def snapshot_changes(spark: SparkSession, folder: str) -> DataFrame:
    """What changed between two snapshots, from bucketed tables of snapshots and customers that are joined in place."""
    log, known = order_log(spark, folder), customers(spark, folder)
    earlier = ft.ObservationWindow(ORDER_WINDOW.end - timedelta(days=30), ORDER_WINDOW.days, ORDER_WINDOW.churn_days)
    tables = {"known": known.select("customer_id", "country")}
    for name, window in (("before", earlier), ("after", ORDER_WINDOW)):
        tables[name] = ft.compute_features(known, log, window, ORDER_TYPES, ()).select("customer_id", "total_events", "label")
    saved = {k: save_bucketed(v, f"ebbtide_{k}", "customer_id", 8, scratch_path(spark, k)) for k, v in tables.items()}
    return finish(changes(saved["known"], saved["before"], saved["after"]))


def changes(known: DataFrame, before: DataFrame, after: DataFrame) -> DataFrame:
    """Customers of both or either snapshot with the change of their events and whether they became inactive."""
    # From the customers on: a full join of the snapshots would have a key that lies in no bucket.
    earlier = before.withColumnsRenamed({"total_events": "events_before", "label": "label_before"})
    joined = known.join(earlier, "customer_id", "left").join(after, "customer_id", "left")
    joined = joined.where("total_events IS NOT NULL OR events_before IS NOT NULL")
    more = F.coalesce("total_events", F.lit(0)) - F.coalesce("events_before", F.lit(0))
    became = (F.coalesce("label", F.lit(1)) == 1) & (F.coalesce("label_before", F.lit(1)) == 0)
    return joined.select(
        "customer_id", "country", more.alias("more_events"), became.alias("became_inactive")
    )


def estimated_types(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct types by merged sketches, with very many types; how far the estimate may be off is part of the result."""
    odd = _with_odd_types(activity_log(spark, folder).withColumn("event_date", F.to_date("event_timestamp")))
    # Every event of the customers with types of their own is a type of its own.
    kind = F.when(F.col("customer_id") % 7 == 1, F.concat_ws(" ", "event_type", "event_id")).otherwise(F.col("event_type"))
    sketches = scratch_path(spark, "sketches")
    type_sketches(odd.withColumn("event_type", kind)).write.parquet(sketches)
    found = type_estimates(spark.read.parquet(sketches), W)
    exact = ft.distinct_types(ft.event_activity(odd.withColumn("event_type", kind), W))
    off = F.abs(F.col("estimated_event_types") - F.col("unique_event_types"))
    joined = found.join(exact, "customer_id")
    close = off <= F.greatest(F.lit(1.0), F.col("unique_event_types") * 0.08)
    return finish(joined.select("customer_id", "unique_event_types", close.alias("close")))


def features_cte(log: str, window: ft.ObservationWindow, types: Sequence[str], valued: Sequence[str]) -> str:
    """CTEs ending in ``ft``, the feature table with rounded columns."""
    columns = rfm_columns(window) + rolling_columns(window) + PATTERN_COLUMNS + type_columns(window, types, valued)
    return f"""WITH {log}, {CUSTOMERS_SQL}, {window_sql(window)}, {labels_sql(window)}, {trend_sql(window)},
agg AS (SELECT customer_id, {', '.join(columns)} FROM w GROUP BY customer_id),
ft AS (
  SELECT cu.customer_id, CAST(lab.label AS BIGINT) AS label, coalesce(cu.country, 'unknown') AS country,
         coalesce(cu.plan_type, 'unknown') AS plan_type,
         {whole(age(window, "cu.signup_date"), "customer_age_days")},
         {rounded("coalesce(cu.monthly_revenue, 0)", "monthly_revenue")},
         agg.* EXCLUDE (customer_id), {rounded("tr.slope", "activity_slope")},
         {rounded("tr.consistency", "activity_consistency")}
  FROM cu JOIN lab USING (customer_id) JOIN agg USING (customer_id) JOIN tr USING (customer_id))"""


ACTIVITY_FEATURES_SQL = features_cte(ACTIVITY_LOG_SQL, W, ACTIVITY_TYPES, ("purchase",))
ORDER_FEATURES_SQL = features_cte(ORDER_LOG_SQL, ORDER_WINDOW, ORDER_TYPES, ("1-URGENT",))
ALL_TYPES = ("click", "error", "purchase", "signup", "view")
ODD_TYPES_SQL = f"""{BASE_SQL}, o AS (
  SELECT *, CASE WHEN customer_id % 7 = 0 THEN NULL WHEN customer_id % 7 = 1 THEN 'only for ' || customer_id
            ELSE event_type END AS kind FROM w)"""



def _snapshot_sql(end: date) -> str:
    start, late = end - timedelta(days=ORDER_WINDOW.days), end - timedelta(days=ORDER_WINDOW.churn_days)
    return f"""SELECT customer_id, count(*) AS n, CASE WHEN max(event_timestamp) < {day(late)} THEN 1 ELSE 0 END AS label
FROM ev JOIN cu USING (customer_id) WHERE event_timestamp >= {day(start)} AND event_timestamp < {day(end)}
GROUP BY customer_id"""


QUERIES = {
    "rfm_features": rfm_features,
    "rolling_windows": rolling_windows,
    "time_patterns": time_patterns,
    "daily_activity": daily_activity,
    "activity_trend": activity_trend,
    "event_type_pivot": event_type_pivot,
    "event_type_pivot_all": event_type_pivot_all,
    "event_type_long": event_type_long,
    "odd_event_types": odd_event_types,
    "churn_labels": churn_labels,
    "customer_tenure": customer_tenure,
    "feature_table": feature_table,
    "order_feature_table": order_feature_table,
    "incremental_features": incremental_features,
    "compacted_state": compacted_state,
    "estimated_types": estimated_types,
    "snapshot_changes": snapshot_changes,
}

SQL = {
    "rfm_features": per_customer_sql(rfm_columns(W)),
    "rolling_windows": per_customer_sql(rolling_columns(W)),
    "time_patterns": per_customer_sql(PATTERN_COLUMNS),
    "daily_activity": f"""{BASE_SQL}
SELECT customer_id, CAST(d AS VARCHAR) AS event_date, count(*) AS daily_events FROM w GROUP BY customer_id, d""",
    "activity_trend": f"""{BASE_SQL}, {trend_sql(W)}
SELECT customer_id, CAST(first_day AS VARCHAR) AS first_active_date, {rounded("slope", "activity_slope")},
       {rounded("consistency", "activity_consistency")} FROM tr""",
    "event_type_pivot": per_customer_sql(type_columns(W, ACTIVITY_TYPES, ("purchase",))),
    "event_type_pivot_all": per_customer_sql(type_columns(W, ALL_TYPES, ALL_TYPES)),
    "event_type_long": f"""{ODD_TYPES_SQL}
SELECT customer_id, kind AS event_type, count(*) AS n_events,
       {rounded("CAST(sum(v) AS DOUBLE) / count(*)", "avg_value")}, {whole(age(W, "max(d)"), "last_days_ago")}
FROM o GROUP BY customer_id, kind""",
    "odd_event_types": f"""{ODD_TYPES_SQL}
SELECT customer_id, count(DISTINCT kind) AS unique_event_types,
       count(*) FILTER (WHERE kind IS NULL) AS count_missing_type,
       {whole(f"coalesce({age(W, 'max(d) FILTER (WHERE kind IS NULL)')}, 999)", "last_missing_type_days_ago")},
       count(*) FILTER (WHERE kind = 'view') AS count_view,
       {whole(f"coalesce({age(W, 'max(d) FILTER (WHERE kind = $$view$$)')}, 999)", "last_view_days_ago")}
FROM o GROUP BY customer_id""",
    "churn_labels": f"""{BASE_SQL}, {CUSTOMERS_SQL}, {labels_sql(W)}
SELECT customer_id, country, plan_type, CAST(label AS BIGINT) AS label FROM cu JOIN lab USING (customer_id)""",
    "customer_tenure": f"""WITH {CUSTOMERS_SQL}
SELECT customer_id, {whole(age(ORDER_WINDOW, "signup_date"), "customer_age_days")} FROM cu""",
    "feature_table": f"{ACTIVITY_FEATURES_SQL} SELECT * FROM ft",
    "order_feature_table": f"{ORDER_FEATURES_SQL} SELECT * FROM ft",
    "incremental_features": f"{ACTIVITY_FEATURES_SQL} SELECT * FROM ft",
    "compacted_state": f"""{BASE_SQL}
SELECT customer_id, CAST(d AS VARCHAR) AS event_date, event_type, count(*) AS events, {rounded("sum(v)", "value")},
       count(*) FILTER (WHERE h BETWEEN 9 AND 17) AS peak_events
FROM w GROUP BY customer_id, d, event_type""",
    "snapshot_changes": f"""WITH {ORDER_LOG_SQL}, {CUSTOMERS_SQL},
a AS ({_snapshot_sql(ORDER_WINDOW.end)}),
b AS ({_snapshot_sql(ORDER_WINDOW.end - timedelta(days=30))})
SELECT cu.customer_id, cu.country, coalesce(a.n, 0) - coalesce(b.n, 0) AS more_events,
       coalesce(a.label, 1) = 1 AND coalesce(b.label, 1) = 0 AS became_inactive
FROM a FULL JOIN b USING (customer_id) JOIN cu USING (customer_id)""",
    "estimated_types": f"""WITH {ACTIVITY_LOG_SQL}
SELECT customer_id, count(DISTINCT CASE WHEN customer_id % 7 = 0 THEN NULL
         WHEN customer_id % 7 = 1 THEN 'only for ' || customer_id || ' ' || event_id ELSE event_type END)
         AS unique_event_types, true AS close
FROM ev WHERE event_timestamp >= {day(W.start)} AND event_timestamp < {day(W.end)} GROUP BY customer_id""",
}
