"""The daily state against features from the whole log."""

from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ebbtide.operators.features import ObservationWindow, compute_features, event_activity, distinct_types
from ebbtide.plans.daily_state import DailyState, estimated_types, type_sketches
from tests.test_features import make_customers

END = date(2024, 4, 1)
WINDOW = ObservationWindow(END)
SCHEMA = "event_id long, customer_id string, event_type string, event_timestamp timestamp_ntz, event_value decimal(10,2)"


@pytest.fixture(scope="module")
def log(spark):
    rows = []
    for i in range(600):
        stamp = datetime(2023, 12, 29) + timedelta(hours=97 * i % 480, minutes=i) + timedelta(days=75 * (i % 2))
        kind = ["login", "purchase", "page_view", None][i % 4]
        value = None if i % 5 == 0 else Decimal(i) / 4
        rows.append((i, f"c{i % 7}", kind, stamp, value))
    # A busy customer, the window's edges, and an event without a time.
    rows += [(1000 + i, "c1", "login", datetime(2024, 3, 31, 23, 59), Decimal(1)) for i in range(50)]
    rows += [(2000, "c2", "login", datetime(2024, 4, 1), Decimal(9)), (2001, "c2", "login", None, Decimal(9))]
    rows += [(2002, None, "login", datetime(2024, 3, 3), Decimal(9))]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def customers(spark):
    return make_customers(spark, [f"c{i}" for i in range(6)])


def rows_of(df):
    """Standard deviations are merged in any order, so their last digits may differ."""
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def state(spark, log, tmp_path_factory):
    state = DailyState(spark, str(tmp_path_factory.mktemp("daily") / "state"))
    state.add(log.where("event_id % 3 = 0"), "a")
    state.add(log.where("event_id % 3 > 0"), "b-late")
    return state


def test_snapshots_equal_the_whole_log(log, customers, state):
    for end in (END, date(2024, 2, 1), date(2024, 3, 31)):
        window = ObservationWindow(end)
        want = rows_of(compute_features(customers, log, window))
        assert rows_of(state.snapshot(customers, window)) == want and len(want) == 6


def test_a_batch_sent_again_counts_once(log, customers, state):
    before = rows_of(state.snapshot(customers, WINDOW))
    state.add(log.where("event_id % 3 = 0"), "a")
    assert rows_of(state.snapshot(customers, WINDOW)) == before
    # A corrected batch leaves nothing of the days it no longer has.
    state.add(log.where("event_id = 3"), "a")
    state.add(log.where("event_id % 3 = 0 AND event_id <> 3"), "rest")
    assert rows_of(state.snapshot(customers, WINDOW)) == before
    assert state.batches().where("batch = 'a'").first()["events"] == 1


def test_compaction_has_one_row_per_customer_day_and_type(spark, customers, state, tmp_path):
    merged = state.compact(str(tmp_path / "merged"))
    rows = merged.read()
    assert rows.count() == rows.select("customer_id", "event_date", "event_type").distinct().count()
    assert rows.count() < state.read().count()
    assert rows_of(merged.snapshot(customers, WINDOW)) == rows_of(state.snapshot(customers, WINDOW))


def test_a_snapshot_reads_the_days_of_its_window_only(spark, log, customers, state, capsys):
    read = state.read(WINDOW.start, WINDOW.end)
    days = {date.fromisoformat(f.split("event_date=")[1].split("/")[0]) for f in read.inputFiles()}
    assert min(days) < WINDOW.start
    capsys.readouterr()
    state.snapshot(customers, WINDOW).explain("formatted")
    plan = capsys.readouterr().out
    assert plan.count("PartitionFilters: [isnotnull(event_date") == 2 and "event_timestamp" not in plan
    late = log.where("event_id % 3 > 0 AND event_timestamp IS NOT NULL").count()
    assert state.batches().where("batch = 'b-late'").first()["events"] == late


def test_a_new_day_adds_one_partition(spark, log, customers, tmp_path):
    state = DailyState(spark, str(tmp_path / "grown"))
    state.add(log, "whole")
    day = log.where("event_timestamp < '2024-01-02'").withColumn("event_timestamp", F.expr("timestamp_ntz'2024-04-01 10:00:00'"))
    before = set(state.read().inputFiles())
    state.add(day, "2024-04-01")
    added = set(state.read().inputFiles()) - before
    assert {f.split("batch=")[1].rsplit("/", 1)[0] for f in added} == {"2024-04-01/event_date=2024-04-01"}
    window = ObservationWindow(date(2024, 4, 2))
    whole = log.unionByName(day)
    assert rows_of(state.snapshot(customers, window)) == rows_of(compute_features(customers, whole, window))


def test_what_does_not_fit_is_an_error(spark, log, tmp_path):
    state = DailyState(spark, str(tmp_path / "other"))
    with pytest.raises(ValueError, match="no batch"):
        state.read()
    assert state.batches().count() == 0
    with pytest.raises(ValueError, match="batch name"):
        state.add(log, "a/b")
    state.add(log, "a")
    with pytest.raises(ValueError, match="value is bigint in the state and double in the batch"):
        state.add(log.withColumn("event_value", F.col("event_value").cast("double")), "b")


def test_sketches_of_days_merge(spark, log):
    dated = log.where("event_timestamp IS NOT NULL").withColumn("event_date", F.to_date("event_timestamp"))
    many = dated.withColumn("event_type", F.when(F.col("customer_id") == "c1", F.col("event_id").cast("string")).otherwise(F.col("event_type")))
    got = {r[0]: r[1] for r in estimated_types(type_sketches(many), WINDOW).collect()}
    exact = {r[0]: r[1] for r in distinct_types(event_activity(many, WINDOW)).collect()}
    assert set(got) == set(exact)
    assert all(abs(got[c] - exact[c]) <= max(1, 0.08 * exact[c]) for c in exact)
