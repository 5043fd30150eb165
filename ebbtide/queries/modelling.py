"""Source, model and streaming queries.

SQL cannot fit models; it knows the rows they see and what has to hold of them.  A rule model stands in for scoring.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbtide.operators.scoring import DecisionParameters, score_customers
from ebbtide.operators.splits import select_split
from ebbtide.plans import jobs, training, tuning
from ebbtide.queries.common import (
    CUSTOMERS_SQL,
    ORDER_TYPES,
    ORDER_WINDOW,
    SCORED_SQL,
    SCORE_SQL,
    activity_features,
    customers,
    finish,
    order_features,
    order_log,
    rounded,
)
from ebbtide.queries.features import ACTIVITY_FEATURES_SQL, ORDER_FEATURES_SQL
from ebbtide.session import materialise, scratch_path
from ebbtide.sources.models import load_model, save_model
from ebbtide.sources.raw import export_features, ingest, load_features
from ebbtide.sources.reports import load_decision_parameters, load_metrics, save_csv, save_json
from ebbtide.sources.tables import execute_query, register_views, run_sql, save_table
from ebbtide.streaming.scoring import read_feature_stream, start_reloading, start_scoring, write_scored_batch

# Recency decides the label, so it is left out of the models; a duplicate of it stays out as well.
LEAKING = ("days_since_last_event", "days_since_first_event", "events_last_30d", "revenue_last_30d",
           "last_1_urgent_days_ago", "last_2_high_days_ago", "last_5_low_days_ago",
           "event_trend_7d_30d", "event_trend_14d_30d", "revenue_trend_7d_30d", "revenue_trend_14d_30d",
           "events_last_7d", "events_last_14d", "revenue_last_7d", "revenue_last_14d")
PARAMETERS = DecisionParameters(threshold=0.4, retention_cost=20.0, churn_loss=60.0)

# A small search beside the one with the defaults: 30 settings of the full space and 5 folds.
SEARCHED = 3
FULL_SEARCH = 30
GRID = {"n_estimators": [5, 10], "max_depth": [3, 5], "min_samples_leaf": [1, 4]}

SUMMARY_SCRIPT = (
    """-- Customers per plan with a first order before the given day; a comment with a separator.
CREATE OR REPLACE TEMPORARY VIEW early_customer_plans AS
SELECT plan_type, monthly_revenue FROM customer_plans WHERE signup_date < DATE'1996-01-01' -- and; another""",
    """SELECT concat(plan_type, ';\n') AS plan_type, count(*) AS n_customers, CAST(sum(monthly_revenue) AS DOUBLE) AS revenue
FROM early_customer_plans WHERE monthly_revenue >= :floor GROUP BY plan_type""",
)


# --- sources ----------------------------------------------------------------------------------


def staged_customers(spark: SparkSession, folder: str) -> DataFrame:
    """Customers written as CSV, found in their folder, staged as Parquet and read back."""
    source = customers(spark, folder)
    raw = scratch_path(spark, "raw")
    save_csv(source, raw)
    staged, _, _ = ingest(spark, scratch_path(spark, "staging"), raw_folder=raw, schema=source.schema)
    return finish(staged)


def saved_features(spark: SparkSession, folder: str) -> DataFrame:
    """The feature table exported to Parquet by observation date and read back."""
    snapshot = activity_features(spark, folder).withColumn("observation_date", F.lit("2024-01-31"))
    path = export_features(snapshot, scratch_path(spark, "features"), partition_by="observation_date")
    return finish(load_features(spark, path).drop("observation_date"))


def saved_table(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as a catalogue table, queried by SQL with a parameter."""
    save_table(customers(spark, folder), "ebbtide_customers", scratch_path(spark, "table"))
    query = "SELECT country, count(*) AS n FROM ebbtide_customers WHERE monthly_revenue > :low GROUP BY country"
    return finish(execute_query(spark, query, low=5000))


def sql_script(spark: SparkSession, folder: str) -> DataFrame:
    register_views({"customer_plans": customers(spark, folder)})
    return finish(run_sql(spark, SUMMARY_SCRIPT, {"floor": 1000}))


# --- scoring with a rule model ----------------------------------------------------------------


def rule_model() -> PipelineModel:
    """A pipeline whose probability is the fixed score of the evaluation queries."""
    statement = (
        "SELECT *, ((customer_id * 7919) % 1000 * 7 + label * 2500) / CAST(10000 AS DOUBLE) AS probability "
        "FROM __THIS__"
    )
    return PipelineModel(stages=[SQLTransformer(statement=statement)])


def _saved_parameters(spark: SparkSession) -> DecisionParameters:
    """Decision parameters written as the two reports and looked up again."""
    threshold = scratch_path(spark, "threshold")
    save_json(spark.range(1).select(F.lit(PARAMETERS.threshold).alias("optimal_threshold")), threshold)
    scenario = F.struct(
        F.lit(PARAMETERS.retention_cost).alias("retention_cost_per_customer"),
        F.lit(PARAMETERS.churn_loss).alias("churn_loss_per_customer"),
    )
    business = scratch_path(spark, "business")
    save_json(spark.range(1).select(scenario.alias("scenario")), business)
    return load_decision_parameters(spark, threshold, business)


def batch_scores(spark: SparkSession, folder: str) -> DataFrame:
    model = load_model(save_model(rule_model(), scratch_path(spark, "model")))
    return finish(score_customers(model, order_features(spark, folder), _saved_parameters(spark)))


def stream_scores(spark: SparkSession, folder: str) -> DataFrame:
    """The whole feature table scored as a file stream and read back from the sink."""
    source, sink = scratch_path(spark, "stream"), scratch_path(spark, "sink")
    export_features(order_features(spark, folder), source)
    stream = read_feature_stream(spark, source, load_features(spark, source).schema)
    query = start_scoring(
        rule_model(), stream, sink, scratch_path(spark, "offsets"), PARAMETERS, available_now=True
    )
    query.awaitTermination()
    return finish(spark.read.parquet(sink))


# --- fitted models ----------------------------------------------------------------------------


def _training_features(spark: SparkSession, folder: str) -> DataFrame:
    signup = customers(spark, folder).select("customer_id", "signup_date")
    return materialise(order_features(spark, folder).join(signup, "customer_id"))


def _trained(spark: SparkSession, folder: str, model_type: str, params=None) -> training.TrainedModel:
    return training.train_model(
        _training_features(spark, folder), model_type, params, date_col="signup_date", exclude=LEAKING
    )


def _outcome(trained: training.TrainedModel) -> DataFrame:
    """What SQL knows about a trained model: rows and classes of each split, and statements that have to hold."""
    score = F.col("score")
    ranges = trained.scored.groupBy("split").agg(
        F.count(score).alias("n_scored"), (F.min(score) >= 0).alias("from_0"), (F.max(score) <= 1).alias("to_1")
    )
    better = (F.col("split") != "train") | (F.col("roc_auc") > 0.6)
    return finish(
        trained.metrics.join(ranges, "split").select(
            "split", "total", "class_0", "class_1", "n_scored", "from_0", "to_1", better.alias("better_than_chance")
        )
    )


def _gradient_vanishes(trained: training.TrainedModel) -> bool:
    """Whether the penalised weighted log-loss is flat at the fitted coefficients."""
    train = select_split(trained.scored, "train").drop("score", "prediction")
    weighted, total = training.weigh_classes(train, "logistic_regression")
    classifier = trained.model.stages[-1]
    shaped = weighted
    for stage in trained.model.stages[:-1]:
        shaped = stage.transform(shaped)
    scored = classifier.transform(shaped)
    error = F.col("weight") * (vector_to_array("probability")[1] - F.col("label"))
    x = vector_to_array("features")
    sums = scored.agg(F.sum(error), *[F.sum(error * x[i]) for i in range(classifier.numFeatures)]).first()
    penalty = classifier.getRegParam()
    slopes = [s / total + penalty * c for s, c in zip(sums[1:], classifier.coefficients)]
    return max(map(abs, [sums[0] / total, *slopes])) < 1e-3


def train_logistic_regression(spark: SparkSession, folder: str) -> DataFrame:
    trained = _trained(spark, folder, "logistic_regression")
    return _outcome(trained).withColumn("gradient_vanishes", F.lit(_gradient_vanishes(trained)))


def train_random_forest(spark: SparkSession, folder: str) -> DataFrame:
    return _outcome(_trained(spark, folder, "random_forest"))


def train_boosting(spark: SparkSession, folder: str) -> DataFrame:
    return _outcome(_trained(spark, folder, "xgboost"))


def feature_importance(spark: SparkSession, folder: str) -> DataFrame:
    """Numeric features named, and what importances add up to."""
    trained = _trained(spark, folder, "random_forest")
    found = training.feature_importance(trained.model, trained.scored.drop("score", "prediction"))
    return finish(
        found.agg(
            F.count_if(~F.col("feature").contains("onehot")).alias("n_numeric"),
            (F.abs(F.sum("importance") - 1) < 1e-6).alias("sum_to_one"),
            (F.min("importance") >= 0).alias("none_negative"),
            (F.countDistinct("feature") == F.count("feature")).alias("names_differ"),
        )
    )


def reloaded_stream(spark: SparkSession, folder: str) -> DataFrame:
    """A fitted model on a stream whose reports change between two drops of files: rows by the parameters that decided.

    The last batch is written twice, as after a failure.  Decisions and scores are held against the batch scoring.
    """
    features = _training_features(spark, folder)
    model = training.train_model(features, "logistic_regression", date_col="signup_date", exclude=LEAKING).model
    source, sink, offsets = (scratch_path(spark, n) for n in ("reload-in", "reload-out", "reload-offsets"))
    threshold = scratch_path(spark, "reload-threshold")
    drops = ((F.col("customer_id") % 3 == 0, 0.4), (F.col("customer_id") % 3 > 0, 0.6))
    for drop, value in drops:
        save_json(spark.range(1).select(F.lit(value).alias("optimal_threshold")), threshold)
        features.filter(drop).write.mode("append").parquet(source)
        start_reloading(
            model, read_feature_stream(spark, source, features.schema), sink, offsets,
            lambda: load_decision_parameters(spark, threshold), available_now=True,
        ).awaitTermination()
    last = features.filter(drops[-1][0])
    write_scored_batch(model, last, 1, sink, load_decision_parameters(spark, threshold))
    written = spark.read.parquet(sink)
    again = DecisionParameters()
    whole = score_customers(model, features, again).select("customer_id", F.col("churn_probability").alias("p"))
    decided = F.col("predicted_churn") == (F.col("churn_probability") >= F.col("threshold"))
    same = F.abs(F.col("p") - F.col("churn_probability")) < 1e-9
    return finish(
        written.join(whole, "customer_id").groupBy("batch", "threshold").agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.countDistinct("customer_id").alias("n_customers"),
            F.bool_and(decided & same).alias("as_in_batch"),
        )
    )


def _search(spark: SparkSession, folder: str, settings: int, **options) -> DataFrame:
    """A search over forests with stratified cross-validation: every setting, its trials, rows and ranks."""
    result = tuning.tune_model(
        _training_features(spark, folder), "random_forest", date_col="signup_date", exclude=LEAKING, **options
    )
    # What the trials have counted: every searched row is kept out once, and fitted in all other folds.
    counted = result.trials.select(F.col("setting").alias("params"), "fold", F.inline("histogram"))
    test, rows = F.col("part") == "test", F.col("positives") + F.col("negatives")
    held = counted.groupBy("params").agg(
        F.countDistinct("fold").alias("folds"),
        F.sum(F.when(test, rows)).alias("test_rows"),
        F.sum(F.when(test, F.col("positives"))).alias("test_positives"),
        F.sum(F.when(~test, rows)).alias("train_rows"),
    )
    score = F.col("mean_test_score")
    # At most as many rows as settings.
    better = F.sum(F.lit(1)).over(Window.orderBy(score.desc()).rangeBetween(Window.unboundedPreceding, Window.currentRow))
    return finish(
        result.cv_results.withColumn("_better", better)
        .join(held, "params")
        .select(
            "params",
            "folds",
            "test_rows",
            "test_positives",
            "train_rows",
            (F.col("rank").between(1, settings) & (F.col("rank") <= F.col("_better"))).alias("ranked"),
            ((score > 0.0) & (score <= 1.0)).alias("score_in_range"),
            (F.col("mean_train_score") >= score).alias("train_not_worse"),
            ((F.col("rank") > 1) | (score == F.lit(result.best_score))).alias("best_is_first"),
        )
    )


def tune(spark: SparkSession, folder: str) -> DataFrame:
    return _search(spark, folder, SEARCHED, n_iter=SEARCHED, cv=3, grid=GRID)


def tune_full_space(spark: SparkSession, folder: str) -> DataFrame:
    """The search with its defaults."""
    return _search(spark, folder, FULL_SEARCH)


def full_run(spark: SparkSession, folder: str) -> DataFrame:
    """Every step from events to reports, and the saved model evaluated again: figures read back from all files."""
    out, again = scratch_path(spark, "run"), scratch_path(spark, "again")
    jobs.full_run(
        customers(spark, folder),
        order_log(spark, folder),
        ORDER_WINDOW,
        out,
        event_types=ORDER_TYPES,
        valued_types=("1-URGENT",),
        exclude=LEAKING,
        date_col="signup_date",
    )
    name = "logistic_regression"
    jobs.evaluate_saved_model(
        spark, f"{out}/models/{name}", f"{out}/features", again, name, date_col="signup_date"
    )
    rows = []
    for run, path in (("trained", out), ("loaded", again)):
        reports = f"{path}/reports"
        splits = load_metrics(spark, f"{reports}/{name}_metrics").first()["splits"]
        thresholds = spark.read.json(f"{reports}/threshold_analysis").first()
        business = spark.read.json(f"{reports}/business_evaluation").first()
        overall = spark.read.json(f"{reports}/error_analysis").where("segment_type = 'overall'").first()
        curves = [spark.read.parquet(f"{reports}/{name}_{c}").select("split").distinct().count() for c in ("roc_curve", "pr_curve")]
        counts = [splits[s]["confusion_matrix"] for s in ("train", "validation", "test")]
        rows.append(
            (
                run,
                *[sum(c[k] for k in ("true_positives", "true_negatives", "false_positives", "false_negatives")) for c in counts],
                len(thresholds["threshold_analysis"]),
                business["summary"]["total_customers"],
                overall["n_samples"],
                *curves,
                spark.read.option("header", "true").csv(f"{reports}/business_evaluation_strategies").count() > 1,
            )
        )
    schema = (
        "run string, train long, validation long, test long, thresholds long, customers long, samples long, "
        "roc_splits long, pr_splits long, strategies boolean"
    )
    return spark.createDataFrame(rows, schema)


QUERIES = {
    "staged_customers": staged_customers,
    "saved_features": saved_features,
    "saved_table": saved_table,
    "sql_script": sql_script,
    "batch_scores": batch_scores,
    "stream_scores": stream_scores,
    "reloaded_stream": reloaded_stream,
    "train_logistic_regression": train_logistic_regression,
    "train_random_forest": train_random_forest,
    "train_boosting": train_boosting,
    "feature_importance": feature_importance,
    "tune": tune,
    "tune_full_space": tune_full_space,
    "full_run": full_run,
}

_VALUE = f"(p * {PARAMETERS.churn_loss}e0 - {PARAMETERS.retention_cost}e0)"
_PREDICTED = f"(p >= {PARAMETERS.threshold}e0)"
DECISIONS_SQL = f"""{ORDER_FEATURES_SQL}, pr AS (SELECT customer_id, {SCORE_SQL} AS p FROM ft)
SELECT customer_id, {rounded("p", "churn_probability")}, {_PREDICTED} AS predicted_churn,
       CASE WHEN NOT {_PREDICTED} THEN 'no_action' WHEN {_VALUE} > 0 THEN 'intervene' ELSE 'monitor' END
         AS recommended_action,
       CASE WHEN NOT {_PREDICTED} THEN CASE WHEN p < 0.3 THEN 'high' ELSE 'medium' END
            WHEN {_VALUE} > 0 THEN CASE WHEN p > 0.7 THEN 'high' WHEN p > 0.5 THEN 'medium' ELSE 'low' END
            ELSE 'low' END AS confidence,
       {rounded(_VALUE, "expected_value")} FROM pr"""

OUTCOME_COLUMNS = """split, count(*) AS total, count(*) FILTER (WHERE label = 0) AS class_0,
       count(*) FILTER (WHERE label = 1) AS class_1, count(*) AS n_scored, true AS from_0, true AS to_1,
       true AS better_than_chance"""



def _search_sql(settings, folds: int) -> str:
    listed = ", ".join(f"('{', '.join(f'{k}={v}' for k, v in x.items())}')" for x in settings)
    return f"""{SCORED_SQL},
n AS (SELECT count(*) AS n, count(*) FILTER (WHERE label = 1) AS p FROM s WHERE split <> 'test')
SELECT params, CAST({folds} AS BIGINT) AS folds, n AS test_rows, p AS test_positives, {folds - 1} * n AS train_rows,
       true AS ranked, true AS score_in_range, true AS train_not_worse, true AS best_is_first
FROM n, (VALUES {listed}) AS v(params)"""


SQL = {
    "staged_customers": f"""WITH {CUSTOMERS_SQL}
SELECT customer_id, country, plan_type, {rounded("monthly_revenue", "monthly_revenue")},
       CAST(signup_date AS VARCHAR) AS signup_date FROM cu""",
    "saved_features": f"{ACTIVITY_FEATURES_SQL} SELECT * FROM ft",
    "saved_table": f"""WITH {CUSTOMERS_SQL}
SELECT country, count(*) AS n FROM cu WHERE monthly_revenue > 5000 GROUP BY country""",
    "sql_script": f"""WITH {CUSTOMERS_SQL}
SELECT plan_type || ';' || chr(10) AS plan_type, count(*) AS n_customers, {rounded("sum(monthly_revenue)", "revenue")}
FROM cu WHERE signup_date < DATE '1996-01-01' AND monthly_revenue >= 1000 GROUP BY plan_type""",
    "batch_scores": DECISIONS_SQL,
    "stream_scores": DECISIONS_SQL,
    "reloaded_stream": f"""{SCORED_SQL}
SELECT CAST(CASE WHEN customer_id % 3 = 0 THEN 0 ELSE 1 END AS BIGINT) AS batch,
       CASE WHEN customer_id % 3 = 0 THEN CAST(0.4 AS DOUBLE) ELSE CAST(0.6 AS DOUBLE) END AS threshold,
       count(*) AS n_rows, count(*) AS n_customers, true AS as_in_batch
FROM s GROUP BY ALL""",
    "train_logistic_regression": f"""{SCORED_SQL}
SELECT {OUTCOME_COLUMNS}, true AS gradient_vanishes FROM s GROUP BY split""",
    "train_random_forest": f"{SCORED_SQL} SELECT {OUTCOME_COLUMNS} FROM s GROUP BY split",
    "train_boosting": f"{SCORED_SQL} SELECT {OUTCOME_COLUMNS} FROM s GROUP BY split",
    "feature_importance": f"""SELECT CAST({32 - len(LEAKING)} AS BIGINT) AS n_numeric, true AS sum_to_one,
       true AS none_negative, true AS names_differ""",
    "tune": _search_sql(tuning.sample_settings(GRID, SEARCHED), 3),
    "tune_full_space": _search_sql(tuning.sample_settings(tuning.get_param_grid("random_forest"), FULL_SEARCH), 5),
    "full_run": f"""{SCORED_SQL},
n AS (SELECT count(*) FILTER (WHERE split = 'train') AS train, count(*) FILTER (WHERE split = 'validation') AS validation,
             count(*) FILTER (WHERE split = 'test') AS test FROM s)
SELECT run, train, validation, test, CAST(100 AS BIGINT) AS thresholds, test AS customers, test AS samples,
       CAST(3 AS BIGINT) AS roc_splits, CAST(3 AS BIGINT) AS pr_splits, true AS strategies
FROM n, (VALUES ('trained'), ('loaded')) AS r(run)""",
}
