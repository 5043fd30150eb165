"""Split, evaluation, business and segment queries over a fixed score."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.operators import business as bz
from ebbtide.operators import curves, evaluation, preparation, segments, splits
from ebbtide.operators import thresholds as th
from ebbtide.operators.quantiles import exact_median
from ebbtide.operators.scoring import DecisionParameters, decide
from ebbtide.plans import jobs
from ebbtide.queries.common import (
    COUNTS_SQL,
    SCORE_SQL,
    SCORED_SQL,
    activity_features,
    customers,
    finish,
    order_features,
    rounded,
    scored_labels,
    scored_splits,
    share,
    whole,
    with_score,
)
from ebbtide.queries.features import ACTIVITY_FEATURES_SQL, ORDER_FEATURES_SQL
from ebbtide.session import materialise, scratch_path
from ebbtide.sources.reports import error_report_lines, load_csv, load_json, load_metrics, save_csv, save_json

SCENARIOS = (
    bz.BusinessScenario(),
    bz.BusinessScenario(25.0, 60.0, 2000.0, "campaign"),
    bz.BusinessScenario(10.0, 100.0, 0.0, "frozen"),
)
PARAMETERS = DecisionParameters(threshold=0.15, retention_cost=20.0, churn_loss=60.0)
DEFAULT_DECISION = DecisionParameters()
FILLED = ("customer_age_days", "total_revenue", "activity_slope")


def temporal_split(spark: SparkSession, folder: str) -> DataFrame:
    return finish(scored_splits(spark, folder).select("customer_id", "signup_date", "label", "split"))


def stratified_folds(spark: SparkSession, folder: str) -> DataFrame:
    return finish(splits.stratified_folds(scored_labels(spark, folder), 5))


def target_encoding(spark: SparkSession, folder: str) -> DataFrame:
    """Country and plan as the mean labels of the other folds; some plans are missing."""
    labels = scored_labels(spark, folder).select("customer_id", "label")
    folds = splits.stratified_folds(labels, 5).select("customer_id", "fold")
    plan = F.when(F.col("customer_id") % 9 > 0, F.col("plan_type")).alias("plan_type")
    known = customers(spark, folder).select("customer_id", "country", plan)
    rows = materialise(labels.join(folds, "customer_id").join(known, "customer_id"))
    return finish(preparation.out_of_fold_means(rows, ["country", "plan_type"], smoothing=20.0))


def class_weights(spark: SparkSession, folder: str) -> DataFrame:
    return finish(preparation.class_weights(scored_labels(spark, folder)))


def impute_median(spark: SparkSession, folder: str) -> DataFrame:
    """Feature values with the ones of some customers blanked and filled again."""
    features = order_features(spark, folder).select("customer_id", *FILLED)
    blank = F.col("customer_id") % 7 == 0
    holes = materialise(features.select("customer_id", *[F.when(~blank, F.col(c)).alias(c) for c in FILLED]))
    return finish(preparation.impute_median(holes, FILLED))


def column_medians(spark: SparkSession, folder: str) -> DataFrame:
    features = materialise(order_features(spark, folder).select("total_events", *FILLED))
    medians = exact_median(features, ["total_events", *FILLED])
    return finish(spark.createDataFrame(list(medians.items()), "column string, median double"))


def classification_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return finish(evaluation.classification_metrics(scored_splits(spark, folder), group=("split",)))


def classification_report(spark: SparkSession, folder: str) -> DataFrame:
    return finish(evaluation.classification_report(scored_labels(spark, folder)))


def model_evaluation(spark: SparkSession, folder: str) -> DataFrame:
    return finish(evaluation.evaluate(materialise(scored_splits(spark, folder))))


def compare_metrics(spark: SparkSession, folder: str) -> DataFrame:
    parts = materialise(scored_splits(spark, folder))
    frames = [evaluation.evaluate(splits.select_split(parts, s)) for s in ("validation", "test")]
    return finish(evaluation.compare_metrics(frames))


def total_cost(spark: SparkSession, folder: str) -> DataFrame:
    return finish(th.total_cost(scored_labels(spark, folder), th.COST_FP, th.COST_FN))


def threshold_sweep(spark: SparkSession, folder: str) -> DataFrame:
    return finish(th.analyze_thresholds(scored_labels(spark, folder)))


def threshold_sweep_by_split(spark: SparkSession, folder: str) -> DataFrame:
    return finish(th.threshold_counts(scored_splits(spark, folder), group=("split",)))


def optimal_threshold(spark: SparkSession, folder: str) -> DataFrame:
    sweep = materialise(th.analyze_thresholds(scored_labels(spark, folder)))
    cheapest = th.optimal_threshold(sweep).select(
        F.lit("total_cost").alias("metric"), "threshold", F.col("total_cost").alias("value")
    )
    best_f1 = th.optimal_threshold(sweep, "f1", minimize=False).select(
        F.lit("f1").alias("metric"), "threshold", F.col("f1").alias("value")
    )
    return finish(cheapest.unionByName(best_f1))


def topk_targeting(spark: SparkSession, folder: str) -> DataFrame:
    return finish(th.top_k_targeting(scored_labels(spark, folder)))


def roc_curve(spark: SparkSession, folder: str) -> DataFrame:
    return finish(curves.roc_curve(scored_labels(spark, folder)))


def pr_curve(spark: SparkSession, folder: str) -> DataFrame:
    return finish(curves.pr_curve(scored_labels(spark, folder)))


def auc(spark: SparkSession, folder: str) -> DataFrame:
    return finish(curves.areas(scored_splits(spark, folder), group=("split",)))


def business_sweep(spark: SparkSession, folder: str) -> DataFrame:
    return finish(bz.evaluate_business_scenario(scored_labels(spark, folder), SCENARIOS))


def _best(spark: SparkSession, folder: str) -> DataFrame:
    return bz.best_under_budget(bz.evaluate_business_scenario(scored_labels(spark, folder), SCENARIOS))


def budget_threshold(spark: SparkSession, folder: str) -> DataFrame:
    return finish(_best(spark, folder))


def strategy_comparison(spark: SparkSession, folder: str) -> DataFrame:
    best = materialise(_best(spark, folder))
    both = [bz.compare_strategies(best, b).withColumn("baseline", F.lit(b)) for b in bz.BASELINES]
    return finish(both[0].unionByName(both[1]))


def business_evaluation(spark: SparkSession, folder: str) -> DataFrame:
    """The nested report as written to and read back from JSON, flattened."""
    path = scratch_path(spark, "business")
    written = jobs.business_evaluation(scored_labels(spark, folder), SCENARIOS, path, "random")
    report = load_json(spark, path, written.schema)
    return finish(report.select("scenario.name", "best_threshold.threshold", "baseline_strategy", "summary.*"))


def threshold_report(spark: SparkSession, folder: str) -> DataFrame:
    """The threshold report as written to and read back from JSON: one row per targeted share."""
    path = scratch_path(spark, "thresholds")
    written = jobs.threshold_analysis(materialise(scored_labels(spark, folder)), path)
    report = load_json(spark, path, written.schema)
    return finish(
        report.select(
            "optimal_threshold",
            F.col("optimal_threshold_metrics.total_cost").alias("total_cost"),
            F.size("threshold_analysis").alias("n_thresholds"),
            F.inline("top_k_analysis"),
        )
    )


def _second_score(df: DataFrame) -> DataFrame:
    score = ((F.col("customer_id") * 104729) % 1000 * 8 + F.col("label") * 1500) / F.lit(10000.0)
    return df.withColumn("score", score).withColumn("prediction", (F.col("score") >= 0.5).cast("int"))


def _saved_reports(spark: SparkSession, folder: str) -> DataFrame:
    """Two model reports written as JSON and read back."""
    base = materialise(scored_splits(spark, folder))
    path = scratch_path(spark, "metrics")
    for name, frame in (("first", base), ("second", _second_score(base))):
        save_json(evaluation.model_report(evaluation.evaluate(frame), name), f"{path}/model={name}")
    reports = [load_metrics(spark, f"{path}/model={name}") for name in ("first", "second")]
    return evaluation.compare_models(reports[0].unionByName(reports[1]))


def compare_models(spark: SparkSession, folder: str) -> DataFrame:
    """The comparison as written to and read back from CSV."""
    compared = _saved_reports(spark, folder)
    path = save_csv(compared, scratch_path(spark, "comparison"))
    return finish(load_csv(spark, path, compared.schema))


def best_model(spark: SparkSession, folder: str) -> DataFrame:
    return finish(evaluation.best_model(_saved_reports(spark, folder)))


def _segmented(spark: SparkSession, folder: str) -> DataFrame:
    return segments.create_segments(materialise(with_score(order_features(spark, folder))))


def customer_segments(spark: SparkSession, folder: str) -> DataFrame:
    return finish(_segmented(spark, folder).select("customer_id", *segments.SEGMENTS))


def usage_segments(spark: SparkSession, folder: str) -> DataFrame:
    """Usage by event counts, with clicks taken as logins."""
    features = activity_features(spark, folder).withColumnRenamed("count_click", "count_login")
    used = materialise(features.select("customer_id", "total_events", "count_purchase", "count_login"))
    return finish(segments.create_segments(used).select("customer_id", *segments.SEGMENTS))


def segment_errors(spark: SparkSession, folder: str) -> DataFrame:
    return finish(segments.analyze_errors_by_segment(_segmented(spark, folder)))


def failure_segments(spark: SparkSession, folder: str) -> DataFrame:
    errors = segments.analyze_errors_by_segment(_segmented(spark, folder))
    return finish(segments.identify_failure_segments(errors, fnr_threshold=0.33))


def error_report(spark: SparkSession, folder: str) -> DataFrame:
    errors = materialise(segments.analyze_errors_by_segment(_segmented(spark, folder)))
    failures = segments.identify_failure_segments(errors, fnr_threshold=0.33)
    return error_report_lines(errors, failures, 0.33).select("section", "line").select(
        F.col("section").cast("bigint").alias("section"), "line"
    )


def behaviour_segments(spark: SparkSession, folder: str) -> DataFrame:
    features = materialise(activity_features(spark, folder))
    out = segments.behavioural_segments(features)
    return finish(out.select("customer_id", "customer_segment", "engagement_level"))


def score_actions(spark: SparkSession, folder: str) -> DataFrame:
    """Decisions at the default parameters and at others that leave customers to monitor."""
    scored = materialise(scored_labels(spark, folder).select("customer_id", "score"))
    wanted = (
        "customer_id",
        "churn_probability",
        "predicted_churn",
        "expected_value",
        "recommended_action",
        "confidence",
    )
    parts = [
        decide(scored, p).select(*wanted, F.lit(name).alias("parameters"))
        for name, p in (("default", DEFAULT_DECISION), ("other", PARAMETERS))
    ]
    return finish(parts[0].unionByName(parts[1]))


def inactive_customers(spark: SparkSession, folder: str) -> DataFrame:
    """Customers without activity in the window, which the feature table leaves out."""
    active = scored_labels(spark, folder).select("customer_id")
    return finish(customers(spark, folder).select("customer_id", "plan_type").join(active, "customer_id", "left_anti"))


QUERIES = {
    "temporal_split": temporal_split,
    "stratified_folds": stratified_folds,
    "target_encoding": target_encoding,
    "class_weights": class_weights,
    "impute_median": impute_median,
    "column_medians": column_medians,
    "classification_metrics": classification_metrics,
    "classification_report": classification_report,
    "model_evaluation": model_evaluation,
    "compare_metrics": compare_metrics,
    "total_cost": total_cost,
    "threshold_sweep": threshold_sweep,
    "threshold_sweep_by_split": threshold_sweep_by_split,
    "optimal_threshold": optimal_threshold,
    "topk_targeting": topk_targeting,
    "roc_curve": roc_curve,
    "pr_curve": pr_curve,
    "auc": auc,
    "business_sweep": business_sweep,
    "budget_threshold": budget_threshold,
    "strategy_comparison": strategy_comparison,
    "business_evaluation": business_evaluation,
    "threshold_report": threshold_report,
    "compare_models": compare_models,
    "best_model": best_model,
    "customer_segments": customer_segments,
    "usage_segments": usage_segments,
    "segment_errors": segment_errors,
    "failure_segments": failure_segments,
    "error_report": error_report,
    "behaviour_segments": behaviour_segments,
    "score_actions": score_actions,
    "inactive_customers": inactive_customers,
}

# --- SQL ---------------------------------------------------------------------------------------


def _double(value: float) -> str:
    text = repr(float(value))
    return text if "e" in text else f"{text}e0"


GRID_SQL = "gr AS (SELECT unnest([" + ", ".join(_double(t) for t in th.default_grid()) + "]) AS threshold)"

# Brute force: every row at every threshold.
SWEEP_SQL = f"""{SCORED_SQL}, {GRID_SQL},
sw AS (
  SELECT threshold,
         count(*) FILTER (WHERE label = 1 AND score >= threshold) AS tp,
         count(*) FILTER (WHERE label = 0 AND score < threshold) AS tn,
         count(*) FILTER (WHERE label = 0 AND score >= threshold) AS fp,
         count(*) FILTER (WHERE label = 1 AND score < threshold) AS fn
  FROM s CROSS JOIN gr GROUP BY threshold)"""

COUNT_COLUMNS = "tp AS true_positives, tn AS true_negatives, fp AS false_positives, fn AS false_negatives"
PRECISION, RECALL = share("tp", "tp + fp"), share("tp", "tp + fn")
F1 = share("2 * tp", "2 * tp + fp + fn")
FPR, FNR = share("fp", "fp + tn"), share("fn", "fn + tp")
SPECIFICITY, ACCURACY = share("tn", "tn + fp"), share("tp + tn", "tp + tn + fp + fn")
RATES = ", ".join(
    rounded(e, n)
    for e, n in (
        (ACCURACY, "accuracy"),
        (PRECISION, "precision"),
        (RECALL, "recall"),
        (F1, "f1"),
        (FPR, "false_positive_rate"),
        (RECALL, "true_positive_rate"),
        (SPECIFICITY, "specificity"),
    )
)
CLASS_COLUMNS = "tn + fp AS class_0, tp + fn AS class_1, tp + tn + fp + fn AS total"


def area_ctes(source: str, suffix: str = "") -> str:
    """``ar``: areas per split; ROC by mid-ranks, PR by trapezoids over distinct scores."""
    return f"""rk{suffix} AS (
  SELECT split, label, rank() OVER (PARTITION BY split ORDER BY score)
         + (count(*) OVER (PARTITION BY split, score) - 1) / CAST(2 AS DOUBLE) AS r FROM {source}),
ra{suffix} AS (
  SELECT split, (sum(r) FILTER (WHERE label = 1) - p * (p + 1) / CAST(2 AS DOUBLE)) / (p * n) AS roc_auc
  FROM rk{suffix} JOIN (SELECT split, CAST(count(*) FILTER (WHERE label = 1) AS DOUBLE) AS p,
                       CAST(count(*) FILTER (WHERE label = 0) AS DOUBLE) AS n FROM {source} GROUP BY split)
       USING (split) GROUP BY split, p, n),
ds{suffix} AS (
  SELECT split, score, CAST(sum(label) AS DOUBLE) AS pos, CAST(count(*) AS DOUBLE) AS cnt
  FROM {source} GROUP BY split, score),
cs{suffix} AS (
  SELECT split, score, pos, sum(pos) OVER d / sum(cnt) OVER d AS prec, sum(pos) OVER (PARTITION BY split) AS p
  FROM ds{suffix} WINDOW d AS (PARTITION BY split ORDER BY score DESC)),
pa{suffix} AS (
  SELECT split, sum(pos / p * (prec + before) / 2) AS pr_auc
  FROM (SELECT *, coalesce(lag(prec) OVER (PARTITION BY split ORDER BY score DESC), 1) AS before FROM cs{suffix})
  GROUP BY split),
ar{suffix} AS (SELECT split, roc_auc, pr_auc FROM ra{suffix} JOIN pa{suffix} USING (split))"""


AREA_COLUMNS = f"{rounded('roc_auc', 'roc_auc')}, {rounded('pr_auc', 'pr_auc')}"
BY_SPLIT = f"ct AS (SELECT split, {COUNTS_SQL} FROM s GROUP BY split)"

CURVE_SQL = f"""{SCORED_SQL},
ds AS (SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM s GROUP BY score),
cu2 AS (
  SELECT score, sum(pos) OVER d AS tps, sum(neg) OVER d AS fps, row_number() OVER d AS i,
         sum(pos) OVER () AS p, sum(neg) OVER () AS n, count(*) OVER () AS points
  FROM ds WINDOW d AS (ORDER BY score DESC)),
cv AS (
  SELECT *, lead(tps) OVER o - 2 * tps + lag(tps) OVER o AS bend_t,
         lead(fps) OVER o - 2 * fps + lag(fps) OVER o AS bend_f
  FROM cu2 WINDOW o AS (ORDER BY i))"""


def _scenarios_sql() -> str:
    rows = [
        f"('{s.name}', {_double(s.retention_cost)}, {_double(s.churn_loss)}, "
        f"CAST({'NULL' if s.budget is None else _double(s.budget)} AS DOUBLE))"
        for s in SCENARIOS
    ]
    return f"sc(scenario, retention_cost, churn_loss, budget) AS (VALUES {', '.join(rows)})"


BUSINESS_SQL = f"""{SWEEP_SQL}, {_scenarios_sql()},
bz AS (
  SELECT scenario, threshold, tp, tn, fp, fn, tp + fp AS targeted, (tp + fp) * retention_cost AS cost,
         tp * churn_loss - (tp + fp) * retention_cost AS gain, retention_cost, churn_loss, budget
  FROM sw CROSS JOIN sc),
bt AS (
  SELECT *, {share("gain", "cost")} * 100 AS roi, budget IS NULL OR cost <= budget AS within_budget FROM bz),
bb AS (
  SELECT * FROM bt QUALIFY row_number() OVER (
    PARTITION BY scenario
    ORDER BY within_budget DESC, CASE WHEN within_budget THEN -gain ELSE cost END, threshold) = 1)"""
BUSINESS_COLUMNS = f"""scenario, {rounded("threshold", "threshold")}, {COUNT_COLUMNS},
{whole("targeted", "total_interventions")}, {rounded("cost", "intervention_cost")},
tp AS prevented_churns, fn AS missed_churns, {rounded("gain", "net_gain")}, {rounded("roi", "roi_percent")},
within_budget, {rounded("retention_cost", "retention_cost")}, {rounded("churn_loss", "churn_loss")},
{rounded("budget", "budget")}"""


def _strategy_sql(name: str, gain: str, interventions: str, baseline: str, divisor: str) -> str:
    n0, tp0 = f"((tp + tn + fp + fn) // 2) * {divisor}", f"((tp + fn) // 2) * {divisor}"
    values = {"base_n": n0, "base_gain": f"({tp0} * churn_loss - {n0} * retention_cost)"}
    gain, interventions = gain.format(**values), interventions.format(**values)
    investment = f"(({interventions}) * retention_cost)"
    return f"""SELECT scenario, '{baseline}' AS baseline, '{name}' AS strategy, {rounded(gain, "net_gain")},
{whole(interventions, "interventions")}, {rounded(investment, "investment")},
{rounded(f"CASE WHEN {investment} > 0 THEN ({gain}) / {investment} * 100 ELSE 0 END", "roi_percent")} FROM bb"""


def _strategies(baseline: str) -> list[str]:
    divisor = "1" if baseline == "random" else "0"
    return [
        _strategy_sql("baseline", "{base_gain}", "{base_n}", baseline, divisor),
        _strategy_sql("optimized", "gain", "targeted", baseline, divisor),
        _strategy_sql("incremental", "gain - {base_gain}", "targeted - {base_n}", baseline, divisor),
    ]


MODELS_SQL = f"""{SCORED_SQL},
x0 AS (
  SELECT customer_id, label, split, ((customer_id * 104729) % 1000 * 8 + label * 1500) / CAST(10000 AS DOUBLE) AS score
  FROM s),
x AS (SELECT *, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS prediction FROM x0),
{area_ctes("s", "1")}, {area_ctes("x", "2")},
m1 AS (SELECT 'first' AS model, roc_auc, pr_auc, {COUNTS_SQL} FROM s JOIN ar1 USING (split)
       WHERE split = 'test' GROUP BY roc_auc, pr_auc),
m2 AS (SELECT 'second' AS model, roc_auc, pr_auc, {COUNTS_SQL} FROM x JOIN ar2 USING (split)
       WHERE split = 'test' GROUP BY roc_auc, pr_auc),
mm AS (SELECT * FROM m1 UNION ALL SELECT * FROM m2)"""

SEGMENT_SQL = f"""{ORDER_FEATURES_SQL},
fs AS (SELECT *, {SCORE_SQL} AS score FROM ft),
md AS (SELECT quantile_cont(total_events, 0.5) AS me, quantile_cont(customer_age_days, 0.5) AS ma,
              quantile_cont(total_revenue, 0.5) AS mr FROM ft),
sg AS (
  SELECT fs.customer_id, label, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS prediction,
         CASE WHEN total_events >= me THEN 'high' ELSE 'low' END AS activity_segment,
         CASE WHEN customer_age_days < ma THEN 'new' ELSE 'established' END AS tenure_segment,
         CASE WHEN total_revenue >= mr THEN 'high_value' ELSE 'low_value' END AS usage_segment
  FROM fs, md)"""


def _segment_part(kind: str, value: str, group: str) -> str:
    return f"SELECT '{kind}' AS segment_type, {value} AS segment_value, {COUNTS_SQL} FROM sg {group}"


ERRORS_SQL = f"""{SEGMENT_SQL}, er AS (
{_segment_part("overall", "'all'", "")}
UNION ALL {_segment_part("activity_segment", "activity_segment", "GROUP BY activity_segment")}
UNION ALL {_segment_part("tenure_segment", "tenure_segment", "GROUP BY tenure_segment")}
UNION ALL {_segment_part("usage_segment", "usage_segment", "GROUP BY usage_segment")})"""
CHURN_RATE = share("tp + fn", "tp + tn + fp + fn")
ERROR_COLUMNS = f"""segment_type, segment_value, tp + tn + fp + fn AS n_samples, tp + fn AS n_churned,
{rounded(CHURN_RATE, "churn_rate")}, {COUNT_COLUMNS}, {rounded(FNR, "false_negative_rate")},
{rounded(FPR, "false_positive_rate")}, {rounded(PRECISION, "precision")}, {rounded(RECALL, "recall")}"""
FAILED = f"{FNR} >= 0.33 AND tp + tn + fp + fn >= 10 AND segment_type <> 'overall'"


def _pct(expression: str) -> str:
    return f"printf('%.2f%%', {expression} * 100)"


def _num(expression: str) -> str:
    return f"format('{{:,}}', CAST({expression} AS BIGINT))"


def _dec(expression: str) -> str:
    return f"printf('%.4f', {expression})"


def _report_sql() -> str:
    n = "tp + tn + fp + fn"
    fixed = [
        (0, "# Segment error analysis"), (0, ""), (1, "## Summary"), (1, ""), (2, ""), (2, "## Overall"), (2, ""),
        (2, "| Measure | Value |"), (2, "|---|---|"), (3, ""), (3, "## By segment"), (3, ""), (4, ""),
        (4, "## Failure segments"), (4, ""),
        (4, "| Segment type | Segment | Samples | Churn rate | FNR | FPR |"), (4, "|---|---|---|---|---|---|"),
        (5, ""), (5, "## Method"), (5, ""),
        (5, "- A failure segment has a false negative rate of at least 33% and at least 10 samples."),
    ]
    parts = ["SELECT * FROM (VALUES " + ", ".join(f"({s}, '{t}')" for s, t in fixed) + ") AS v(section, line)"]
    overall = "FROM er WHERE segment_type = 'overall'"
    for title, value in (("Samples", _num(n)), ("Churn rate", _pct(CHURN_RATE)), ("False negative rate", _pct(FNR)),
                         ("False positive rate", _pct(FPR))):
        parts.append(f"SELECT 1, '- **{title}**: ' || {value} {overall}")
    parts.append(f"SELECT 1, '- **Failure segments**: ' || {_num('count(*)')} FROM er WHERE {FAILED}")
    for title, value in (("True positives", _num("tp")), ("True negatives", _num("tn")),
                         ("False positives", _num("fp")), ("False negatives", _num("fn")),
                         ("Precision", _dec(PRECISION)), ("Recall", _dec(RECALL))):
        parts.append(f"SELECT 2, '| {title} | ' || {value} || ' |' {overall}")
    for kind, title in (("activity", "Activity"), ("tenure", "Tenure"), ("usage", "Usage")):
        for line in (f"### {title} Segment", "", "| Segment | Samples | Churn rate | FNR | FPR | Precision | Recall |",
                     "|---|---|---|---|---|---|---|"):
            parts.append(f"SELECT 3, '{line}' WHERE EXISTS (FROM er WHERE segment_type = '{kind}_segment')")
    measures = f"{_num(n)}, {_pct(CHURN_RATE)}, {_pct(FNR)}, {_pct(FPR)}"
    parts.append(f"SELECT 3, '| ' || concat_ws(' | ', segment_value, {measures}, {_dec(PRECISION)}, {_dec(RECALL)}) "
                 "|| ' |' FROM er WHERE segment_type <> 'overall'")
    parts.append(f"SELECT 4, '| ' || concat_ws(' | ', segment_type, segment_value, {measures}) || ' |' "
                 f"FROM er WHERE {FAILED}")
    return f"{ERRORS_SQL} SELECT CAST(section AS BIGINT) AS section, line FROM ({' UNION ALL '.join(parts)})"


def _decision_sql(name: str, p: DecisionParameters) -> str:
    value = f"(score * {_double(p.churn_loss)} - {_double(p.retention_cost)})"
    predicted = f"(score >= {_double(p.threshold)})"
    return f"""SELECT customer_id, {rounded("score", "churn_probability")}, {predicted} AS predicted_churn,
{rounded(value, "expected_value")},
CASE WHEN {predicted} AND {value} > 0 THEN 'intervene' WHEN {predicted} THEN 'monitor' ELSE 'no_action' END
  AS recommended_action,
CASE WHEN {predicted} AND {value} > 0 THEN CASE WHEN score > 0.7 THEN 'high' WHEN score > 0.5 THEN 'medium' ELSE 'low' END
     WHEN {predicted} THEN 'low' WHEN score < 0.3 THEN 'high' ELSE 'medium' END AS confidence,
'{name}' AS parameters FROM s"""


def _average(name: str, weighted: bool) -> str:
    def mean(a: str, b: str) -> str:
        if weighted:
            return f"({a} * (tn + fp) + {b} * (tp + fn)) / CAST(tp + tn + fp + fn AS DOUBLE)"
        return f"({a} + {b}) / 2"

    zero = {"precision": share("tn", "tn + fn"), "recall": share("tn", "tn + fp"),
            "f1": share("2 * tn", "2 * tn + fp + fn")}
    one = {"precision": PRECISION, "recall": RECALL, "f1": F1}
    columns = ", ".join(rounded(mean(zero[m], one[m]), m) for m in zero)
    return f"""SELECT '{name}' AS "class", {columns}, tp + tn + fp + fn AS support FROM ct"""


def _top_k_sql(k: int) -> str:
    size = f"floor(n * {_double(k / 100.0)})"
    return f"""SELECT CAST({k} AS BIGINT) AS k_percent, {whole(size, "k_absolute")},
{rounded(f"CAST(sum(label) FILTER (WHERE r <= {size}) AS DOUBLE) / {size}", "precision")},
{rounded(f"CAST(sum(label) FILTER (WHERE r <= {size}) AS DOUBLE) / sum(label)", "recall")},
{rounded(f"avg(label) FILTER (WHERE r <= {size})", "churn_rate_in_top_k")},
count(*) FILTER (WHERE r <= {size} AND label = 1) AS true_positives,
count(*) FILTER (WHERE r <= {size} AND label = 0) AS false_positives,
count(*) FILTER (WHERE r > {size} AND label = 1) AS false_negatives FROM tk GROUP BY n"""


def _filled(c: str) -> str:
    hole = f"CASE WHEN customer_id % 7 <> 0 THEN {c} END"
    return rounded(f"coalesce({hole}, (SELECT quantile_cont({hole}, 0.5) FROM ft))", c)


SQL = {
    "temporal_split": f"""{SCORED_SQL}
SELECT customer_id, CAST(signup_date AS VARCHAR) AS signup_date, CAST(label AS BIGINT) AS label, split FROM s""",
    "stratified_folds": f"""{SCORED_SQL}
SELECT customer_id, CAST(label AS BIGINT) AS label,
       CAST(ntile(5) OVER (PARTITION BY label ORDER BY customer_id) - 1 AS BIGINT) AS fold FROM s""",
    "target_encoding": f"""{SCORED_SQL},
f AS (
  SELECT s.customer_id, CAST(s.label AS BIGINT) AS label, cu.country,
         CASE WHEN s.customer_id % 9 > 0 THEN cu.plan_type END AS plan_type,
         CAST(ntile(5) OVER (PARTITION BY s.label ORDER BY s.customer_id) - 1 AS BIGINT) AS fold
  FROM s JOIN cu USING (customer_id)),
p AS (SELECT a.fold, avg(b.label) AS prior FROM (SELECT DISTINCT fold FROM f) a JOIN f b ON a.fold <> b.fold GROUP BY a.fold),
c AS ({" UNION ALL ".join(f"SELECT '{k}' AS k, {k} AS v, fold, label FROM f" for k in ("country", "plan_type"))}),
t AS (
  SELECT a.k, a.v, a.fold, (coalesce(sum(b.label), 0) + 20 * any_value(prior)) / CAST(count(b.label) + 20 AS DOUBLE) AS m
  FROM (SELECT DISTINCT k, v, fold FROM c) a JOIN p USING (fold)
  LEFT JOIN c b ON a.k = b.k AND a.v IS NOT DISTINCT FROM b.v AND a.fold <> b.fold GROUP BY a.k, a.v, a.fold)
SELECT f.*, {rounded("x.m", "country_target")}, {rounded("y.m", "plan_type_target")}
FROM f JOIN t x ON x.k = 'country' AND x.v IS NOT DISTINCT FROM country AND x.fold = f.fold
JOIN t y ON y.k = 'plan_type' AND y.v IS NOT DISTINCT FROM plan_type AND y.fold = f.fold""",
    "class_weights": f"""{SCORED_SQL},
ct AS (SELECT count(*) AS n, count(*) FILTER (WHERE label = 1) AS p FROM s)
SELECT CAST(0 AS BIGINT) AS label, n - p AS n_rows, {rounded("n / (2 * CAST(n - p AS DOUBLE))", "balanced_weight")},
       CAST(1 AS DOUBLE) AS boosting_weight FROM ct
UNION ALL SELECT 1, p, {rounded("n / (2 * CAST(p AS DOUBLE))", "balanced_weight")},
       {rounded("(n - p) / CAST(p AS DOUBLE)", "boosting_weight")} FROM ct""",
    "impute_median": f"{ORDER_FEATURES_SQL} SELECT customer_id, {', '.join(_filled(c) for c in FILLED)} FROM ft",
    "column_medians": ORDER_FEATURES_SQL
    + " UNION ALL ".join(
        f""" SELECT '{c}' AS "column", {rounded(f"quantile_cont({c}, 0.5)", "median")} FROM ft"""
        for c in ("total_events", *FILLED)
    ),
    "classification_metrics": f"{SCORED_SQL}, {BY_SPLIT} SELECT split, {RATES}, {COUNT_COLUMNS}, {CLASS_COLUMNS} FROM ct",
    "classification_report": f"""{SCORED_SQL}, ct AS (SELECT {COUNTS_SQL} FROM s)
SELECT '0' AS "class", {rounded(share("tn", "tn + fn"), "precision")}, {rounded(share("tn", "tn + fp"), "recall")},
       {rounded(share("2 * tn", "2 * tn + fp + fn"), "f1")}, tn + fp AS support FROM ct
UNION ALL SELECT '1', {rounded(PRECISION, "precision")}, {rounded(RECALL, "recall")}, {rounded(F1, "f1")}, tp + fn FROM ct
UNION ALL {_average("macro avg", False)} UNION ALL {_average("weighted avg", True)}""",
    "model_evaluation": f"""{SCORED_SQL}, {BY_SPLIT}, {area_ctes("s")}
SELECT split, {RATES}, {COUNT_COLUMNS}, {CLASS_COLUMNS}, {AREA_COLUMNS} FROM ct JOIN ar USING (split)""",
    "compare_metrics": f"""{SCORED_SQL}, {BY_SPLIT}, {area_ctes("s")}
SELECT split, {RATES}, {COUNT_COLUMNS}, {AREA_COLUMNS} FROM ct JOIN ar USING (split)
WHERE split IN ('validation', 'test')""",
    "total_cost": f"""{SCORED_SQL}, ct AS (SELECT {COUNTS_SQL} FROM s)
SELECT CAST(fp + 5 * fn AS DOUBLE) AS total_cost FROM ct""",
    "threshold_sweep": f"""{SWEEP_SQL}
SELECT {rounded("threshold", "threshold")}, {rounded(PRECISION, "precision")}, {rounded(RECALL, "recall")},
       {rounded(F1, "f1")}, {COUNT_COLUMNS}, CAST(fp + 5 * fn AS DOUBLE) AS total_cost,
       CAST(1 AS DOUBLE) AS cost_fp, CAST(5 AS DOUBLE) AS cost_fn FROM sw""",
    "threshold_sweep_by_split": f"""{SCORED_SQL}, {GRID_SQL}
SELECT split, {rounded("threshold", "threshold")},
       count(*) FILTER (WHERE label = 1 AND score >= threshold) AS true_positives,
       count(*) FILTER (WHERE label = 0 AND score < threshold) AS true_negatives,
       count(*) FILTER (WHERE label = 0 AND score >= threshold) AS false_positives,
       count(*) FILTER (WHERE label = 1 AND score < threshold) AS false_negatives
FROM s CROSS JOIN gr GROUP BY split, threshold""",
    "optimal_threshold": f"""{SWEEP_SQL}, sv AS (SELECT threshold, fp + 5 * fn AS cost, {F1} AS f1 FROM sw)
(SELECT 'total_cost' AS metric, {rounded("threshold", "threshold")}, CAST(cost AS DOUBLE) AS value
 FROM sv ORDER BY cost, sv.threshold LIMIT 1)
UNION ALL
(SELECT 'f1', {rounded("threshold", "threshold")}, {rounded("f1", "value")}
 FROM sv ORDER BY f1 DESC, sv.threshold LIMIT 1)""",
    "topk_targeting": f"""{SCORED_SQL},
tk AS (SELECT label, row_number() OVER (ORDER BY score DESC, customer_id) AS r, count(*) OVER () AS n FROM s)
"""
    + " UNION ALL ".join(_top_k_sql(k) for k in th.TOP_K),
    "roc_curve": f"""{CURVE_SQL}
SELECT {rounded("fps / CAST(n AS DOUBLE)", "fpr")}, {rounded("tps / CAST(p AS DOUBLE)", "tpr")},
       {rounded("score", "threshold")}
FROM cv WHERE i = 1 OR i = points OR bend_t <> 0 OR bend_f <> 0
UNION ALL SELECT CAST(0 AS DOUBLE), CAST(0 AS DOUBLE), CAST(NULL AS DOUBLE)""",
    "pr_curve": f"""{CURVE_SQL}
SELECT {rounded("tps / CAST(tps + fps AS DOUBLE)", "precision")}, {rounded("tps / CAST(p AS DOUBLE)", "recall")},
       {rounded("score", "threshold")} FROM cv
UNION ALL SELECT CAST(1 AS DOUBLE), CAST(0 AS DOUBLE), CAST(NULL AS DOUBLE)""",
    "auc": f"{SCORED_SQL}, {area_ctes('s')} SELECT split, {AREA_COLUMNS} FROM ar",
    "business_sweep": f"{BUSINESS_SQL} SELECT {BUSINESS_COLUMNS} FROM bt",
    "budget_threshold": f"{BUSINESS_SQL} SELECT {BUSINESS_COLUMNS} FROM bb",
    "strategy_comparison": BUSINESS_SQL + " " + " UNION ALL ".join(_strategies("no_intervention") + _strategies("random")),
    "business_evaluation": f"""{BUSINESS_SQL},
inc AS ({_strategies("random")[2]})
SELECT scenario AS name, {rounded("threshold", "threshold")}, 'random' AS baseline_strategy,
       inc.net_gain AS incremental_net_gain, inc.roi_percent AS incremental_roi,
       tp + tn + fp + fn AS total_customers, tp + fn AS total_churned,
       {rounded(CHURN_RATE, "churn_rate")} FROM bb JOIN inc USING (scenario)""",
    "threshold_report": f"""{SWEEP_SQL},
op AS (SELECT threshold, fp + 5 * fn AS cost FROM sw ORDER BY cost, threshold LIMIT 1),
tk AS (SELECT label, row_number() OVER (ORDER BY score DESC, customer_id) AS r, count(*) OVER () AS n FROM s),
tt AS ({" UNION ALL ".join(_top_k_sql(k) for k in th.TOP_K)})
SELECT {rounded("threshold", "optimal_threshold")}, CAST(cost AS DOUBLE) AS total_cost,
       CAST(100 AS BIGINT) AS n_thresholds, tt.* FROM op, tt""",
    "compare_models": f"""{MODELS_SQL}
SELECT model, 'test' AS split, {rounded(ACCURACY, "accuracy")}, {rounded(PRECISION, "precision")},
       {rounded(RECALL, "recall")}, {rounded(F1, "f1")}, {AREA_COLUMNS}, {rounded(FPR, "false_positive_rate")} FROM mm""",
    "best_model": f"""{MODELS_SQL}
SELECT model, {rounded("roc_auc", "roc_auc")} FROM mm ORDER BY mm.roc_auc DESC, model LIMIT 1""",
    "customer_segments": f"{SEGMENT_SQL} SELECT customer_id, activity_segment, tenure_segment, usage_segment FROM sg",
    "usage_segments": f"""{ACTIVITY_FEATURES_SQL}
SELECT customer_id,
       CASE WHEN total_events >= (SELECT quantile_cont(total_events, 0.5) FROM ft) THEN 'high' ELSE 'low' END
         AS activity_segment, 'unknown' AS tenure_segment,
       CASE WHEN count_purchase > 0 THEN 'purchaser' WHEN count_click > 0 THEN 'browser' ELSE 'inactive' END
         AS usage_segment FROM ft""",
    "segment_errors": f"{ERRORS_SQL} SELECT {ERROR_COLUMNS} FROM er",
    "failure_segments": f"{ERRORS_SQL} SELECT {ERROR_COLUMNS} FROM er WHERE {FAILED}",
    "error_report": _report_sql(),
    "behaviour_segments": f"""{ACTIVITY_FEATURES_SQL},
qt AS (SELECT quantile_cont(days_since_last_event, 0.25) AS r1, quantile_cont(days_since_last_event, 0.75) AS r3,
              quantile_cont(total_events, 0.75) AS f3, quantile_cont(total_revenue, 0.75) AS m3,
              quantile_cont(events_per_day, 0.25) AS e1, quantile_cont(events_per_day, 0.75) AS e3 FROM ft)
SELECT customer_id,
       CASE WHEN days_since_last_event <= r1 AND (total_events >= f3 OR total_revenue >= m3) THEN 'champion'
            WHEN days_since_last_event >= r3 AND (total_events >= f3 OR total_revenue >= m3) THEN 'at_risk'
            WHEN days_since_last_event >= r3 THEN 'lost' ELSE 'regular' END AS customer_segment,
       CASE WHEN events_per_day >= e3 THEN 'high' WHEN events_per_day <= e1 THEN 'low' ELSE 'medium' END
         AS engagement_level
FROM ft, qt""",
    "score_actions": f"{SCORED_SQL} {_decision_sql('default', DEFAULT_DECISION)} UNION ALL {_decision_sql('other', PARAMETERS)}",
    "inactive_customers": f"""{SCORED_SQL}
SELECT customer_id, plan_type FROM cu WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.customer_id = cu.customer_id)""",
}
