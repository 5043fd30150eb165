from datetime import date, datetime, timedelta
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbtide.operators import features as ft
from ebbtide.schemas import CUSTOMERS, EVENTS

END = date(2024, 4, 1)
WINDOW = ft.ObservationWindow(END)


def at(days_before, hour=0, minute=0):
    return datetime.combine(END - timedelta(days=days_before), datetime.min.time()) + timedelta(
        hours=hour, minutes=minute
    )


def make_events(spark, rows):
    """Rows of (customer, type, timestamp, value)."""
    full = [
        (i, c, t, ts, None if v is None else Decimal(str(v)).quantize(Decimal("0.01")), None)
        for i, (c, t, ts, v) in enumerate(rows)
    ]
    return spark.createDataFrame(full, EVENTS)


def make_customers(spark, ids, **columns):
    rows = [
        (
            c,
            columns.get("signup", date(2023, 1, 1)),
            columns.get("country", "NL"),
            columns.get("plan", "pro"),
            columns.get("revenue", Decimal("9.50")),
            None,
        )
        for c in ids
    ]
    return spark.createDataFrame(rows, CUSTOMERS)


def features_of(spark, rows, ids=None, **columns):
    ids = ids or sorted({r[0] for r in rows})
    out = ft.compute_features(make_customers(spark, ids, **columns), make_events(spark, rows), WINDOW)
    return {r["customer_id"]: r for r in out.collect()}


def test_window_is_half_open(spark):
    rows = [
        ("a", "login", at(90), 1),
        ("a", "login", at(90) - timedelta(microseconds=1), 1),
        ("a", "login", at(0), 1),
        ("a", "login", at(0) - timedelta(microseconds=1), 1),
    ]
    row = features_of(spark, rows)["a"]
    assert row["total_events"] == 2
    assert row["days_since_first_event"] == 90 and row["days_since_last_event"] == 1


def test_rolling_bounds_at_midnight(spark):
    rows = [("a", "login", at(n), n) for n in (7, 14, 30)]
    rows += [("a", "login", at(n) - timedelta(microseconds=1), 100 * n) for n in (7, 14, 30)]
    row = features_of(spark, rows)["a"]
    assert (row["events_last_7d"], row["events_last_14d"], row["events_last_30d"]) == (1, 3, 5)
    assert (row["revenue_last_7d"], row["revenue_last_14d"], row["revenue_last_30d"]) == (7.0, 721.0, 2151.0)
    assert row["event_trend_7d_30d"] == 1 / 5 and row["revenue_trend_14d_30d"] == 721 / 2151


def test_label_is_strict_at_the_bound(spark):
    rows = [
        ("edge", "login", at(30), 1),
        ("before", "login", at(30) - timedelta(microseconds=1), 1),
        ("after", "login", at(3), 1),
    ]
    found = features_of(spark, rows)
    assert {c: r["label"] for c, r in found.items()} == {"edge": 0, "before": 1, "after": 0}


def test_single_active_day(spark):
    row = features_of(spark, [("a", "login", at(5, 3), 1), ("a", "login", at(5, 4), 1)])["a"]
    assert row["activity_slope"] == 0.0 and row["activity_consistency"] == 0.0 and row["active_days"] == 1


def test_missing_values_profile_and_unknown_customers(spark):
    rows = [("a", "purchase", at(5), None), ("ghost", "login", at(5), 1)]
    found = features_of(spark, rows, ids=["a", "idle"], country=None, plan=None, revenue=None, signup=None)
    assert set(found) == {"a"}
    row = found["a"]
    assert (row["country"], row["plan_type"], row["monthly_revenue"]) == ("unknown", "unknown", 0.0)
    assert row["customer_age_days"] is None
    assert (row["total_revenue"], row["avg_purchase_value"], row["count_purchase"]) == (0.0, 0.0, 1)
    assert (row["last_purchase_days_ago"], row["last_login_days_ago"], row["count_login"]) == (5, 999, 0)
    assert row["revenue_trend_7d_30d"] == 0.0


def test_customers_without_signup_can_be_left_out(spark):
    events = make_events(spark, [("a", "login", at(5), 1)])
    out = ft.compute_features(make_customers(spark, ["a"], signup=None), events, WINDOW, require_signup=True)
    assert out.isEmpty()


def test_weekend_and_peak_hours(spark):
    monday = date(2024, 3, 25)
    stamps = [datetime(2024, 3, 23, 12), datetime(2024, 3, 24, 12), datetime(monday.year, 3, 25, 12)]
    stamps += [datetime(2024, 3, 26, h, m) for h, m in ((8, 59), (9, 0), (17, 59), (18, 0))]
    row = features_of(spark, [("a", "login", s, 1) for s in stamps])["a"]
    assert row["weekend_activity_ratio"] == 2 / 7
    assert row["peak_hour_activity"] == 5


def test_columns_and_order(spark):
    out = ft.compute_features(make_customers(spark, ["a"]), make_events(spark, [("a", "login", at(1), 1)]), WINDOW)
    assert len(out.columns) == 36
    assert out.columns[:4] == ["customer_id", "label", "country", "plan_type"]
    assert out.columns[-7:] == [
        "count_purchase",
        "avg_purchase_value",
        "last_purchase_days_ago",
        "count_login",
        "last_login_days_ago",
        "count_page_view",
        "last_page_view_days_ago",
    ]


def test_slope_consistency_and_distinct_counts_match_numpy(spark):
    rng = np.random.default_rng(5)
    types = ["purchase", "login", "page_view", "other"]
    rows = [
        (f"c{rng.integers(0, 6) % 5 if rng.random() > 0.35 else 0}", types[rng.integers(0, 4)],
         at(int(rng.integers(1, 91)), int(rng.integers(0, 24))), round(float(rng.random() * 50), 2))
        for _ in range(1500)
    ]
    found = features_of(spark, rows)
    for customer, row in found.items():
        mine = [r for r in rows if r[0] == customer]
        days = sorted({r[2].date() for r in mine})
        daily = np.array([sum(r[2].date() == d for r in mine) for d in days], dtype=float)
        x = np.array([(d - days[0]).days for d in days], dtype=float)
        assert row["activity_slope"] == pytest.approx(np.polyfit(x, daily, 1)[0])
        assert row["activity_consistency"] == pytest.approx(daily.std(ddof=1) / daily.mean())
        assert row["active_days"] == len(days) and row["total_events"] == len(mine)
        assert row["unique_event_types"] == len({r[1] for r in mine})
        assert row["total_revenue"] == pytest.approx(sum(r[3] for r in mine))
        bought = [r[3] for r in mine if r[1] == "purchase"]
        assert row["count_purchase"] == len(bought)
        assert row["avg_purchase_value"] == pytest.approx(np.mean(bought))
        assert row["max_event_value"] == max(r[3] for r in mine)


def test_single_purpose_operators_agree_with_the_table(spark):
    rng = np.random.default_rng(6)
    rows = [
        (f"c{rng.integers(0, 4)}", ["purchase", "login"][rng.integers(0, 2)], at(int(rng.integers(1, 91)), 10), 2.5)
        for _ in range(200)
    ]
    events = make_events(spark, rows)
    activity = ft.event_activity(events, WINDOW)
    table = ft.compute_features(make_customers(spark, [f"c{i}" for i in range(4)]), events, WINDOW)
    for part in (
        ft.rfm_features(activity, WINDOW),
        ft.rolling_windows(activity, WINDOW),
        ft.time_patterns(activity),
        ft.event_type_features(activity, WINDOW),
        ft.churn_labels(activity, WINDOW),
        ft.activity_trend(activity, WINDOW).drop("first_active_date"),
    ):
        columns = part.columns[1:]
        left, right = (
            {r["customer_id"]: [r[c] for c in columns] for r in df.select(part.columns).collect()}
            for df in (part, table)
        )
        assert left.keys() == right.keys() and len(left) == 4
        for c in left:
            # The order of partial sums may change the last digit of a deviation.
            assert left[c] == pytest.approx(right[c], rel=1e-12)


def test_pivot_over_every_type(spark):
    activity = ft.event_activity(make_events(spark, [("a", t, at(3), 4) for t in ("B two", "a-1")]), WINDOW)
    types = sorted(r["event_type"] for r in ft.event_types(activity).collect())
    assert types == ["B two", "a-1"]
    row = ft.event_type_features(activity, WINDOW, types, types).first()
    assert (row["count_b_two"], row["avg_a_1_value"], row["last_a_1_days_ago"]) == (1, 4.0, 3)
    long = {r["event_type"]: tuple(r)[2:] for r in ft.event_type_long(activity, WINDOW).collect()}
    assert long == {"B two": (1, 4.0, 3), "a-1": (1, 4.0, 3)}


def test_missing_clashing_and_foreign_types(spark):
    events = make_events(spark, [("a", t, at(3), 4) for t in ("Page view", "page_view", "купить", "!!", "gone")])
    events = events.withColumn("event_type", F.expr("nullif(event_type, 'gone')"))
    activity = ft.event_activity(events, WINDOW)
    with pytest.raises(ValueError, match="page_view"):
        ft.event_type_features(activity, WINDOW, ("Page view", "page_view"))
    row = ft.event_type_features(activity, WINDOW, ("page_view", "купить", "!!", None), (None,)).first()
    assert (row["count_page_view"], row["count_купить"], row["count_unnamed_type"], row["count_missing_type"]) == (1,) * 4
    assert row["avg_missing_type_value"] == 4.0
    assert ft.rfm_features(activity, WINDOW).first()["unique_event_types"] == 4


def test_bounds_reach_the_scan_and_partitions(spark, tmp_path):
    events = make_events(spark, [("a", "login", at(n), 1) for n in (1, 50, 120, 200)])
    path = str(tmp_path / "log")
    events.withColumn("day", F.to_date("event_timestamp")).write.partitionBy("day").parquet(path)
    activity = ft.event_activity(spark.read.parquet(path), WINDOW, partition_column="day")
    plan = activity._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    assert "GreaterThanOrEqual(event_timestamp" in plan and "LessThan(event_timestamp" in plan
    assert "metadata" not in plan
    assert activity.count() == 2


def test_feature_table_shuffles_events_twice(spark, tmp_path):
    """One shuffle of days, one by customer that later groupings reuse, and two of (customer, type) pairs."""
    path = str(tmp_path / "e")
    make_events(spark, [("a", "login", at(1), 1)]).write.parquet(path)
    activity = ft.event_activity(spark.read.parquet(path), WINDOW)
    plan = ft.customer_rollup(activity, WINDOW)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 4


@pytest.mark.parametrize("n_types", [5, 63, 64, 700])
def test_distinct_types_for_few_and_many_types(spark, n_types):
    rng = np.random.default_rng(n_types)
    rows = [(f"c{i % 3}", f"type {rng.integers(0, n_types)}", at(int(rng.integers(1, 91))), 1.25) for i in range(400)]
    rows += [("c0", f"type {i}", at(4), 2) for i in range(n_types)]
    activity = ft.event_activity(make_events(spark, rows), WINDOW)
    out = {r["customer_id"]: r for r in ft.rfm_features(activity, WINDOW).collect()}
    for c, row in out.items():
        mine = [r for r in rows if r[0] == c]
        assert row["unique_event_types"] == len({r[1] for r in mine}) and row["total_events"] == len(mine)
        assert row["active_days"] == len({r[2].date() for r in mine})
        assert row["total_revenue"] == pytest.approx(sum(r[3] for r in mine))
    table = ft.customer_rollup(activity, WINDOW, ("type 1", "type 2"), ("type 2",))
    for r in table.collect():
        mine = [x for x in rows if x[0] == r["customer_id"]]
        assert r["count_type_1"] == sum(x[1] == "type 1" for x in mine)
        assert r["avg_type_2_value"] == pytest.approx(np.mean([x[3] for x in mine if x[1] == "type 2"] or [0]))


def test_types_without_a_name_are_not_counted(spark):
    events = make_events(spark, [("a", "login", at(3), 1), ("a", "x", at(3), 1)])
    unnamed = events.withColumn("event_type", F.expr("nullif(event_type, 'x')"))
    activity = ft.event_activity(unnamed, WINDOW)
    assert ft.rfm_features(activity, WINDOW).first()["unique_event_types"] == 1


@pytest.mark.parametrize("kind, total", [("decimal(10,2)", 3.75), ("decimal(20,3)", 3.75), ("double", 3.75), ("int", 3.0)])
def test_values_of_any_numeric_type(spark, kind, total):
    events = make_events(spark, [("a", "login", at(3), 1.25), ("a", "login", at(4), 2.5), ("a", "login", at(4), None)])
    typed = events.withColumn("event_value", F.col("event_value").cast(kind))
    row = ft.rfm_features(ft.event_activity(typed, WINDOW), WINDOW).first()
    assert row["total_revenue"] == total and row["avg_event_value"] == total / 3
