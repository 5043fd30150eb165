"""Thresholds, top-k targeting, business scenarios, segments and actions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbtide.operators import business as bz
from ebbtide.operators import segments as sg
from ebbtide.operators import thresholds as th
from ebbtide.operators.scoring import DecisionParameters, decide


def scored(spark, n=400, seed=3):
    rng = np.random.default_rng(seed)
    label = rng.integers(0, 2, n)
    grid = th.default_grid()
    # A third of the rows share one score, some lie exactly on grid points.
    score = np.where(rng.random(n) < 0.33, 0.5, np.round(rng.random(n), 3))
    score = np.where(rng.random(n) < 0.1, np.array(grid)[rng.integers(0, 100, n)], score)
    rows = [(i, int(y), float(s), int(s >= 0.5)) for i, (y, s) in enumerate(zip(label, score))]
    return spark.createDataFrame(rows, "customer_id long, label int, score double, prediction int").repartition(5)


def test_sweep_matches_brute_force(spark):
    df = scored(spark)
    pdf = df.toPandas()
    rows = th.analyze_thresholds(df).orderBy("threshold").collect()
    assert len(rows) == 100
    last = None
    for row, t in zip(rows, th.default_grid()):
        hit = pdf["score"] >= t
        tp, fp = int((hit & (pdf.label == 1)).sum()), int((hit & (pdf.label == 0)).sum())
        assert row["threshold"] == t and (row["true_positives"], row["false_positives"]) == (tp, fp)
        total = row["true_positives"] + row["true_negatives"] + row["false_positives"] + row["false_negatives"]
        assert total == len(pdf)
        assert row["total_cost"] == fp + 5 * row["false_negatives"]
        assert row["precision"] == (tp / (tp + fp) if tp + fp else 0.0)
        assert last is None or (tp <= last[0] and fp <= last[1])
        last = (tp, fp)


@pytest.mark.parametrize("grid", [[0.5], [0.9, 0.1, 0.1], [-1.0, 0.2, 0.2000001, 2.0], list(np.linspace(-3, 7, 331))])
def test_points_reached_for_any_grid(spark, grid):
    grid = sorted(set(float(g) for g in grid))
    near = [float(v) for g in grid for v in (g, np.nextafter(g, -9), np.nextafter(g, 9))]
    values = near + [-9.0, 9.0, 0.3, float("inf"), float("-inf")]
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "s double")
    found = [r[0] for r in df.select(th.points_reached(F.col("s"), grid)).collect()]
    assert found == [sum(g <= v for g in grid) for v in values] + [0, 0]


def test_sweep_of_an_empty_frame_and_of_groups(spark):
    df = scored(spark)
    assert th.analyze_thresholds(df.limit(0)).isEmpty()
    grouped = th.threshold_counts(df.withColumn("half", F.col("customer_id") % 2), [0.0, 0.4, 2.0], group=["half"])
    assert grouped.count() == 6
    top = {r["half"]: r["true_positives"] for r in grouped.filter("threshold = 2").collect()}
    assert top == {0: 0, 1: 0}


def test_first_threshold_wins_a_tie(spark):
    sweep = spark.createDataFrame([(0.1, 5.0), (0.2, 3.0), (0.3, 3.0), (0.4, 5.0)], "threshold double, total_cost double")
    assert th.find_optimal_threshold(sweep) == 0.2
    assert th.find_optimal_threshold(sweep, minimize=False) == 0.1


def test_total_cost(spark):
    df = spark.createDataFrame([(0, 1), (1, 0), (1, 1), (0, 0), (1, 0)], "label int, prediction int")
    assert th.total_cost(df, 2.0, 7.0).first()[0] == 16.0


def test_top_k_with_ties_across_the_cut(spark):
    df = scored(spark)
    order = df.toPandas().sort_values(["score", "customer_id"], ascending=[False, True])
    rows = {r["k_percent"]: r for r in th.top_k_targeting(df, [10, 33, 50, 100]).collect()}
    for k, row in rows.items():
        size = int(len(order) * (k / 100.0))
        top = order.head(size)
        assert row["k_absolute"] == size
        assert row["true_positives"] == (top.label == 1).sum()
        assert row["false_negatives"] == order.label.sum() - (top.label == 1).sum()
        assert row["precision"] == pytest.approx(top.label.mean()) == row["churn_rate_in_top_k"]
    tiny = th.top_k_targeting(df.limit(3), [10]).first()
    assert (tiny["k_absolute"], tiny["precision"], tiny["churn_rate_in_top_k"]) == (0, 0.0, 0.0)


def test_business_outcome_and_budget(spark):
    df = scored(spark)
    pdf = df.toPandas()
    scenarios = [
        bz.BusinessScenario(),
        bz.BusinessScenario(10.0, 100.0, 700.0, "tight"),
        bz.BusinessScenario(10.0, 100.0, -1.0, "none"),
        bz.BusinessScenario(0.0, 100.0, None, "free"),
    ]
    sweep = bz.evaluate_business_scenario(df, scenarios).toPandas()
    assert len(sweep) == 400
    best = {r["scenario"]: r for r in bz.best_under_budget(bz.evaluate_business_scenario(df, scenarios)).collect()}
    for s in scenarios:
        rows = []
        for t in th.default_grid():
            hit = pdf.score >= t
            tp, n = int((hit & (pdf.label == 1)).sum()), int(hit.sum())
            rows.append((t, tp * s.churn_loss - n * s.retention_cost, n * s.retention_cost))
        allowed = [r for r in rows if s.budget is None or r[2] <= s.budget]
        expected = max(allowed, key=lambda r: (r[1], -r[0])) if allowed else min(rows, key=lambda r: (r[2], r[0]))
        assert best[s.name]["threshold"] == expected[0] and best[s.name]["net_gain"] == expected[1]
        assert best[s.name]["within_budget"] == bool(allowed)
    assert (sweep[sweep.scenario == "free"].roi_percent == 0).all()


def test_strategy_comparison(spark):
    rows = [(i, int(i < 3), 0.9 if i < 3 else 0.1, 0) for i in range(7)]
    df = spark.createDataFrame(rows, "customer_id long, label int, score double, prediction int")
    best = bz.best_under_budget(bz.evaluate_business_scenario(df, bz.BusinessScenario()))
    none = {r["strategy"]: r for r in bz.compare_strategies(best).collect()}
    assert none["optimized"]["net_gain"] == 270.0 and none["optimized"]["roi_percent"] == 900.0
    assert none["incremental"]["net_gain"] == 270.0 and none["baseline"]["investment"] == 0.0
    random = {r["strategy"]: r for r in bz.compare_strategies(best, "random").collect()}
    assert (random["baseline"]["interventions"], random["baseline"]["net_gain"]) == (3, 70.0)
    # No additional investment: the incremental return is 0.
    assert random["incremental"]["investment"] == 0.0 and random["incremental"]["roi_percent"] == 0.0
    with pytest.raises(ValueError):
        bz.compare_strategies(best, "everyone")
    report = bz.business_report(best, "random").first()
    assert report["summary"]["total_churned"] == 3 and report["scenario"]["intervention_budget"] is None


def test_segments_by_columns_at_hand(spark):
    df = spark.createDataFrame(
        [(1, 5, 10, 1, 0), (2, 6, 20, 0, 2), (3, 7, 30, 0, 0), (4, 8, None, 0, 1)],
        "customer_id int, total_events int, customer_age_days int, count_purchase int, count_login int",
    )
    out = {r["customer_id"]: tuple(r[c] for c in sg.SEGMENTS) for r in sg.create_segments(df).collect()}
    assert out[1] == ("low", "new", "purchaser") and out[2] == ("low", "established", "browser")
    assert out[3] == ("high", "established", "inactive") and out[4] == ("high", "established", "browser")
    other = df.select("customer_id", F.col("total_events").alias("events_last_30d"),
                      F.col("customer_age_days").alias("days_since_signup"), F.col("total_events").alias("total_revenue"))
    row = sg.create_segments(other).filter("customer_id = 4").first()
    assert tuple(row[c] for c in sg.SEGMENTS) == ("high", "established", "high_value")
    row = sg.create_segments(df.select("customer_id")).first()
    assert tuple(row[c] for c in sg.SEGMENTS) == ("unknown",) * 3


def test_segment_errors(spark):
    rows = [("high", "new", 1, 1)] * 12 + [("low", "new", 1, 0)] * 9 + [("low", "old", 0, 1)] * 3 + [("low", "old", 1, 1)]
    df = spark.createDataFrame(rows, "activity_segment string, tenure_segment string, label int, prediction int")
    errors = sg.analyze_errors_by_segment(df)
    found = {(r["segment_type"], r["segment_value"]): r for r in errors.collect()}
    assert len(found) == 5
    # All true and all predicted 1: these are hits, not misses.
    high = found["activity_segment", "high"]
    assert (high["true_positives"], high["false_negatives"], high["false_negative_rate"]) == (12, 0, 0.0)
    assert found["activity_segment", "low"]["false_negative_rate"] == pytest.approx(0.9)
    for kind in ("activity_segment", "tenure_segment"):
        for column in ("n_samples", "n_churned", "true_positives", "false_positives"):
            assert sum(r[column] for k, r in found.items() if k[0] == kind) == found["overall", "all"][column]
    failures = sg.identify_failure_segments(errors)
    assert [(r["segment_type"], r["segment_value"]) for r in failures.collect()] == [
        ("activity_segment", "low"),
        ("tenure_segment", "new"),
    ]
    assert sg.identify_failure_segments(errors, min_samples=20).count() == 1
    assert sg.analyze_errors_by_segment(df.select("label", "prediction")) is None


def test_behavioural_segments(spark):
    rows = [(i, i, 100 - i, float(100 - i), (100 - i) / 90) for i in range(1, 101)]
    df = spark.createDataFrame(
        rows, "customer_id int, days_since_last_event int, total_events int, total_revenue double, events_per_day double"
    )
    out = {r["customer_id"]: r for r in sg.behavioural_segments(df).collect()}
    assert out[1]["customer_segment"] == "champion" and out[1]["engagement_level"] == "high"
    assert out[100]["customer_segment"] == "lost" and out[100]["engagement_level"] == "low"
    assert out[50]["customer_segment"] == "regular" and out[50]["engagement_level"] == "medium"


def test_actions_and_confidence(spark):
    probabilities = [0.65, 0.75, 0.5, 0.05, 0.3, 0.45]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(probabilities)], "customer_id int, score double")
    out = [tuple(r)[2:] for r in decide(df).orderBy("customer_id").collect()]
    assert out[0] == (0.65, True, 55.0, "intervene", "medium")
    assert out[1][3:] == ("intervene", "high") and out[2][3:] == ("intervene", "low")
    assert out[3][3:] == ("no_action", "high") and out[4][3:] == ("no_action", "medium")
    dear = [tuple(r)[2:] for r in decide(df, DecisionParameters(0.4, 50.0, 100.0)).orderBy("customer_id").collect()]
    assert dear[2][1:] == (True, 0.0, "monitor", "low") and dear[5][3:] == ("monitor", "low")
