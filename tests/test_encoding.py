"""Target encoding out of fold, and correlations of all pairs in one scan."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbtide.operators import quality as q
from ebbtide.operators.preparation import out_of_fold_means
from ebbtide.operators.scoring import add_scores
from ebbtide.plans import training
from ebbtide.sources.models import load_model, save_model

ROWS = [(i, i % 3, ["a", "b", None, "rare"][0 if i % 2 else 1 if i % 4 else 2] if i != 7 else "only here",
         None if i == 5 else int(i % 5 < 2)) for i in range(40)]


def test_means_leave_out_the_own_fold(spark):
    df = spark.createDataFrame(ROWS, "customer_id long, fold int, kind string, label int").repartition(3)
    for smoothing in (0.0, 4.0):
        got = {r.customer_id: r.kind_target for r in out_of_fold_means(df, ["kind"], smoothing=smoothing).collect()}
        assert len(got) == len(ROWS)
        for i, fold, kind, _ in ROWS:
            others = [y for _, f, _, y in ROWS if f != fold and y is not None]
            prior = sum(others) / len(others)
            same = [y for _, f, k, y in ROWS if f != fold and k == kind and y is not None]
            want = (sum(same) + smoothing * prior) / (len(same) + smoothing) if len(same) + smoothing else 0.0
            assert got[i] == pytest.approx(want)


def test_a_label_never_enters_its_own_encoding(spark):
    df = spark.createDataFrame(ROWS, "customer_id long, fold int, kind string, label int")
    other = df.withColumn("label", F.when(F.col("fold") == 1, 1 - F.col("label")).otherwise(F.col("label")))
    means = [
        {r.customer_id: r.kind_target for r in out_of_fold_means(x, ["kind"]).where("fold = 1").collect()} for x in (df, other)
    ]
    assert means[0] == means[1]


@pytest.fixture(scope="module")
def wide(spark):
    """Noise in a column with very many categories; the label depends on another."""
    rng = np.random.default_rng(3)
    rows = []
    for i in range(900):
        plan = ["basic", "pro", None][int(rng.integers(0, 3))]
        chance = {"basic": 0.2, "pro": 0.8, None: 0.5}[plan]
        rows.append((i, int(rng.random() < chance), plan, f"city {int(rng.integers(0, 400))}", float(rng.random())))
    return spark.createDataFrame(rows, "customer_id long, label int, plan string, city string, x double").repartition(3)


@pytest.mark.parametrize("model_type", ["logistic_regression", "random_forest"])
def test_training_with_target_means(spark, wide, tmp_path, model_type):
    params = {"max_iter": 20} if model_type == "logistic_regression" else {"n_estimators": 10, "max_depth": 4}
    trained = training.train_model(wide, model_type, params, encoding="target")
    metrics = {r["split"]: r["roc_auc"] for r in trained.metrics.collect()}
    assert metrics["test"] > 0.65
    # Three features, whatever the number of cities.
    assert trained.model.stages[-1].numFeatures == 3
    again = load_model(save_model(trained.model, str(tmp_path / "model")))
    rows = spark.createDataFrame([(1, "pro", "never seen", 0.5), (2, "basic", "never seen", None), (3, "gone", None, 0.5)],
                                 "customer_id long, plan string, city string, x double")
    scores = {r.customer_id: r.score for r in add_scores(again, rows).collect()}
    assert scores[1] > scores[2] and 0 <= scores[3] <= 1
    with pytest.raises(ValueError, match="unknown encoding"):
        training.train_model(wide, model_type, params, encoding="hash")


def test_all_pairs_equal_correlation(spark):
    n = 12
    columns = []
    for i in range(n):
        value = F.rand(i) * (10.0 ** (i - 3)) + 10.0 ** (i % 5) + F.col("id") * (i % 3)
        columns.append(F.when(F.rand(100 + i) < 0.2 * (i % 4), None).otherwise(value).alias(f"v{i}"))
    df = spark.range(0, 3000, 1, 6).select(
        *columns,
        F.lit(4.0).alias("same"),
        F.lit(None).cast("double").alias("none"),
        F.when(F.col("id") < 1500, F.rand(7)).alias("first"),
        F.when(F.col("id") >= 1500, F.rand(8)).alias("second"),
        F.when(F.col("id") < 1, 1.0).alias("single"),
    ).checkpoint()
    names = df.columns
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i + 1 :]]
    want = df.agg(*[q.correlation(F.col(a), F.col(b)).alias(f"r{k}") for k, (a, b) in enumerate(pairs)]).first()
    rows = {(r.kept, r.dropped): r for r in q.pair_correlations(df).collect()}
    assert set(rows) == set(pairs)
    for pair, r in zip(pairs, want):
        if "same" in pair:  # of a constant the single sums may leave a little noise, which has no correlation
            r = None
        assert rows[pair].correlation == (None if r is None else pytest.approx(r, abs=1e-9)), pair
    assert rows["first", "second"].n_rows == 0 and rows["v0", "single"].n_rows == 1


def test_four_hundred_columns_in_one_scan(spark, capsys):
    df = spark.range(0, 500, 1, 3).select(*[(F.rand(i) + F.col("id") * (i % 2)).alias(f"v{i}") for i in range(400)])
    found = q.pair_correlations(df)
    found.explain("formatted")
    assert capsys.readouterr().out.count("MapInArrow") > 0
    assert found.count() == 400 * 399 // 2
    assert found._jdf.queryExecution().executedPlan().toString().count("Range (0, 500") == 1
    assert q.pair_correlations(df.select("v0")).count() == 0
