import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel

from ebbtide.operators import preparation as prep
from ebbtide.operators.quality import label_correlations
from ebbtide.operators.scoring import DecisionParameters, add_scores, score_customers
from ebbtide.operators.splits import select_split
from ebbtide.plans import jobs, training, tuning
from ebbtide.queries.common import ORDER_TYPES, ORDER_WINDOW, customers, order_features, order_log
from ebbtide.sources.models import load_model, save_model
from ebbtide.sources.reports import load_decision_parameters, save_json
from ebbtide.streaming.scoring import read_feature_stream, start_reloading, start_scoring, write_scored_batch
from tests.test_features import WINDOW, at, make_customers, make_events


@pytest.fixture(scope="module")
def features(spark):
    """Labels depend on x and the plan; y is noise and partly missing; ids shuffle the order."""
    rng = np.random.default_rng(11)
    rows = []
    for i in range(600):
        x, plan = float(rng.normal()), ["basic", "pro", None][int(rng.integers(0, 3))]
        chance = 1 / (1 + np.exp(-(2 * x + (1.5 if plan == "pro" else -0.5))))
        y = None if i % 9 == 0 else float(rng.random())
        rows.append((i, int(rng.random() < chance), plan or "unknown", x, y, int(rng.integers(0, 5))))
    df = spark.createDataFrame(
        rows, "customer_id long, label int, plan_type string, x double, y double, total_events int"
    )
    return df.repartition(3).checkpoint()


SMALL = {
    "logistic_regression": {"max_iter": 30},
    "random_forest": {"n_estimators": 8, "max_depth": 5},
    "xgboost": {"n_estimators": 5, "max_depth": 3},
    "lightgbm": {"n_estimators": 5, "max_depth": 3},
}


def test_median_imputer_is_exact_saved_and_applied(spark, tmp_path):
    df = spark.createDataFrame([(1.0, 1), (2.0, None), (9.0, 4), (float("nan"), 8), (None, 5)], "a double, b int")
    imputer = prep.MedianImputer(inputCols=["a", "b"], outputCols=["a2", "b2"])
    model = Pipeline(stages=[imputer]).fit(df)
    path = save_model(model, str(tmp_path / "m"))
    out = load_model(path).transform(df).collect()
    assert [r["a2"] for r in out] == [1.0, 2.0, 9.0, 2.0, 2.0]
    assert [r["b2"] for r in out] == [1.0, 4.5, 4.0, 8.0, 5.0]
    assert [r["a"] for r in prep.impute_median(df, ["a"]).collect()] == [1.0, 2.0, 9.0, 2.0, 2.0]


def test_feature_columns_and_target(spark, features):
    assert prep.feature_columns(features) == (["x", "y", "total_events"], ["plan_type"])
    assert prep.feature_columns(features, exclude=["x"])[0] == ["y", "total_events"]
    assert prep.prepare_features(features).columns == ["plan_type", "x", "y", "total_events", "label"]
    with pytest.raises(ValueError):
        prep.prepare_features(features, "missing")


def test_class_weights(spark):
    df = spark.createDataFrame([(0,)] * 6 + [(1,)] * 2, "label int")
    rows = {r["label"]: r for r in prep.class_weights(df).collect()}
    assert (rows[0]["balanced_weight"], rows[1]["balanced_weight"]) == (8 / 12, 2.0)
    assert (rows[0]["boosting_weight"], rows[1]["boosting_weight"]) == (1.0, 3.0)


@pytest.mark.parametrize("model_type", sorted(SMALL))
def test_models_train_score_and_reload(spark, features, tmp_path, model_type):
    trained = training.train_model(features, model_type, SMALL[model_type])
    rows = {r["split"]: r for r in trained.metrics.collect()}
    assert {s: r["total"] for s, r in rows.items()} == {"train": 360, "validation": 120, "test": 120}
    assert rows["test"]["roc_auc"] > 0.75
    again = load_model(save_model(trained.model, str(tmp_path / model_type)))
    first, second = (
        [r["score"] for r in add_scores(m, features).orderBy("customer_id").collect()] for m in (trained.model, again)
    )
    assert first == second
    importance = training.feature_importance(trained.model, features).collect()
    assert importance[0]["feature"] in ("x", "plan_type_onehot_pro") and len(importance) >= 5
    report = trained.report().first()
    assert report["model"] == model_type and report["splits"]["test"]["roc_auc"] == rows["test"]["roc_auc"]


def test_unknown_model(spark, features):
    with pytest.raises(ValueError):
        training.train_model(features, "svm")
    with pytest.raises(ValueError):
        tuning.get_param_grid("xgboost")
    with pytest.raises(ValueError):
        tuning.tune_model(features, scoring="speed")


def test_unlimited_depth_is_the_deepest_tree_allowed(spark):
    assert training.create_classifier("random_forest").getMaxDepth() == 30
    assert training.create_classifier("random_forest", {"max_depth": 3}).getMaxDepth() == 3


def test_inverse_penalty_becomes_an_averaged_one(spark):
    lasso = training.create_classifier("logistic_regression", {"C": 0.5, "penalty": "l1"}, total_weight=100.0)
    assert lasso.getRegParam() == 0.02 and lasso.getElasticNetParam() == 1.0


def test_unseen_categories_and_missing_values_are_scored(spark, features):
    model = training.fit_model(features, "logistic_regression", SMALL["logistic_regression"])
    odd = spark.createDataFrame([(1, "gold", None, float("nan"), None)],
                                "customer_id long, plan_type string, x double, y double, total_events int")
    assert 0 <= score_customers(model, odd).first()["churn_probability"] <= 1


def test_sampled_settings_are_distinct_and_repeatable():
    grid = tuning.get_param_grid("random_forest")
    drawn = tuning.sample_settings(grid, 30, 42)
    assert len({str(d) for d in drawn}) == 30 and drawn == tuning.sample_settings(grid, 30, 42)
    assert len(tuning.sample_settings({"a": [1, 2]}, 30)) == 2


def test_tuning(spark, features, tmp_path):
    grid = {"n_estimators": [2, 6], "max_depth": [1, 4]}
    tuned = jobs.tune_and_report(features, "random_forest", str(tmp_path), n_iter=3, cv=3, grid=grid)
    rows = tuned.cv_results.orderBy("rank").collect()
    assert len(rows) == 3 and rows[0]["mean_test_score"] == tuned.best_score
    assert [r["mean_test_score"] for r in rows] == sorted((r["mean_test_score"] for r in rows), reverse=True)
    assert all(r["mean_train_score"] is not None and r["std_test_score"] >= 0 for r in rows)
    assert rows[0]["params"] == ", ".join(f"{k}={v}" for k, v in tuned.best_params.items())
    test = tuned.test_metrics.first()
    assert test["total"] == 120 and test["roc_auc"] > 0.7
    saved = spark.read.json(str(tmp_path / "reports/tuning_summary_random_forest")).first()
    assert saved["best_params"].asDict() == {k: str(v) for k, v in tuned.best_params.items()}
    assert saved["test_metrics"]["roc_auc"] == pytest.approx(test["roc_auc"])
    assert saved["best_cv_score"] == pytest.approx(tuned.best_score) and len(saved["cv_results"]) == 3
    assert isinstance(load_model(str(tmp_path / "models/random_forest_tuned")), PipelineModel)


def test_stream_gives_the_batch_result_across_restarts(spark, features, tmp_path):
    model = training.fit_model(features, "logistic_regression", SMALL["logistic_regression"])
    parameters = DecisionParameters(0.4, 20.0, 60.0)
    source, sink, offsets = (str(tmp_path / n) for n in ("in", "out", "offsets"))

    def run():
        stream = read_feature_stream(spark, source, features.schema, max_files=1)
        start_scoring(model, stream, sink, offsets, parameters, available_now=True).awaitTermination()

    features.filter("customer_id % 2 = 0").write.parquet(source)
    run()
    assert spark.read.parquet(sink).count() == 300
    features.filter("customer_id % 2 = 1").write.mode("append").parquet(source)
    run()
    run()
    batch = score_customers(model, features, parameters)
    streamed = spark.read.parquet(sink)
    assert streamed.count() == 600 and streamed.exceptAll(batch).isEmpty()


def test_a_running_stream_follows_the_reports_and_repeats_batches_safely(spark, features, tmp_path):
    model = training.fit_model(features, "logistic_regression", SMALL["logistic_regression"])
    source, sink, offsets, report = (str(tmp_path / n) for n in ("in", "out", "offsets", "report"))
    features.limit(0).write.parquet(source)
    stream = read_feature_stream(spark, source, features.schema)
    # No report yet: the defaults.
    query = start_reloading(model, stream, sink, offsets, lambda: load_decision_parameters(spark, report))
    try:
        features.filter("customer_id % 2 = 0").write.mode("append").parquet(source)
        query.processAllAvailable()
        save_json(spark.range(1).selectExpr("0.9D AS optimal_threshold"), report)
        features.filter("customer_id % 2 = 1").write.mode("append").parquet(source)
        query.processAllAvailable()
    finally:
        query.stop()
    rows = spark.read.parquet(sink)
    counts = {(r["threshold"], r["n"]) for r in rows.groupBy("threshold").agg({"*": "count"}).toDF("threshold", "n").collect()}
    assert counts == {(0.5, 300), (0.9, 300)}
    assert rows.where("predicted_churn <> (churn_probability >= threshold)").isEmpty()
    last = rows.agg({"batch": "max"}).first()[0]
    write_scored_batch(model, features.filter("customer_id % 2 = 1"), last, sink, DecisionParameters(0.9))
    assert spark.read.parquet(sink).count() == 600


def test_full_run_writes_every_output(spark, tmp_path):
    folder = "/root/testdata/sf0.01"
    result = jobs.full_run(
        customers(spark, folder),
        order_log(spark, folder),
        ORDER_WINDOW,
        str(tmp_path),
        params={"max_iter": 20},
        event_types=ORDER_TYPES,
        valued_types=("1-URGENT",),
        exclude=["days_since_last_event"],
    )
    assert result.valid
    total = select_split(result.trained.scored, "test").count()
    assert result.business.first()["summary"]["total_customers"] == total
    assert result.errors.filter("segment_type = 'overall'").first()["n_samples"] == total
    assert result.thresholds.count() == 1
    for name in ("features", "models/logistic_regression", "reports/logistic_regression_metrics",
                 "reports/threshold_analysis", "reports/business_evaluation", "reports/error_analysis",
                 "reports/failure_segments", "reports/error_analysis_report"):
        assert (tmp_path / name).exists(), name


def test_leaky_label_is_reported(spark):
    """The label is a function of recency, so recency is correlated with it."""
    found = label_correlations(order_features(spark, "/root/testdata/sf0.01"))
    rows = {r["column"]: r["correlation"] for r in found.collect()}
    assert rows["days_since_last_event"] > 0.8


def test_run_from_raw_csv_files(spark, tmp_path):
    rng = np.random.default_rng(2)
    ids = [f"c{i}" for i in range(120)]
    rows = []
    for i, c in enumerate(ids):
        last = int(rng.integers(31, 80)) if i % 3 == 0 else int(rng.integers(1, 25))
        rows += [(c, ["login", "purchase"][k % 2], at(last + k, 10), 5) for k in range(int(rng.integers(2, 9)))]
    paths = {}
    for name, df in (("customers", make_customers(spark, ids)), ("events", make_events(spark, rows))):
        paths[name] = str(tmp_path / "raw" / f"{name}.csv")
        df.write.option("header", True).csv(paths[name])
    result = jobs.run_from_raw(
        spark, paths["customers"], paths["events"], WINDOW, str(tmp_path / "out"), params={"max_iter": 10}
    )
    assert result.features.count() == 120 and result.valid
    assert result.features.agg({"label": "sum"}).first()[0] == 40
    profile = spark.read.json(str(tmp_path / "out/reports/events_profile"))
    assert profile.filter("column = 'metadata'").first()["missing_pct"] == 100.0


def test_settings_that_cannot_be_met_are_refused():
    with pytest.raises(ValueError, match="n_estimator"):
        training.create_classifier("random_forest", {"n_estimator": 5})
    with pytest.raises(ValueError, match="min_samples_split"):
        training.create_classifier("random_forest", {"min_samples_split": 10})
    with pytest.raises(ValueError, match="30"):
        training.create_classifier("random_forest", {"max_depth": 64})
    assert training.create_classifier("random_forest", {"max_depth": None}).getMaxDepth() == 30


def test_imputing_with_an_infinite_median(spark):
    df = spark.createDataFrame([(float("inf"),), (float("inf"),), (None,), (1.0,)], "a double")
    fitted = prep.MedianImputer(inputCols=["a"], outputCols=["b"]).fit(df)
    assert sorted(r["b"] for r in fitted.transform(df).collect()) == [1.0] + [float("inf")] * 3


def test_queries_use_the_reference_sizes(monkeypatch):
    from ebbtide.queries import modelling

    asked = []

    class Stop(Exception):
        pass

    def stop(*args, **options):
        asked.append((args[1:], options))
        raise Stop

    monkeypatch.setattr(modelling, "_training_features", lambda spark, folder: None)
    monkeypatch.setattr(modelling.training, "train_model", stop)
    monkeypatch.setattr(modelling.tuning, "tune_model", stop)
    for query in ("train_boosting", "feature_importance", "tune_full_space"):
        with pytest.raises(Stop):
            modelling.QUERIES[query](None, "")
    (boosting, _), (forest, _), (_, search) = asked
    assert boosting == ("xgboost", None) and forest == ("random_forest", None)
    assert not {"n_iter", "cv", "grid"} & set(search)
