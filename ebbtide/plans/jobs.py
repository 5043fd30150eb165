"""Complete jobs from events to reports.  Each takes explicit inputs, parameters and output paths."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.operators.business import BusinessScenario, best_under_budget, business_report, compare_strategies, evaluate_counts
from ebbtide.operators.curves import pr_curve, roc_curve
from ebbtide.operators.evaluation import compare_models, evaluate, model_report
from ebbtide.operators.features import EVENT_TYPES, VALUED_TYPES, ObservationWindow, compute_features
from ebbtide.operators.quality import validate_features
from ebbtide.operators.scoring import add_scores
from ebbtide.operators.segments import (
    FNR_LIMIT,
    analyze_errors_by_segment,
    create_segments,
    identify_failure_segments,
)
from ebbtide.operators.splits import select_split, temporal_split
from ebbtide.operators.thresholds import (
    COST_FN,
    COST_FP,
    TOP_K,
    analyze_thresholds,
    optimal_threshold,
    threshold_counts,
    top_k_targeting,
)
from ebbtide.plans.training import SEED, TrainedModel, train_model
from ebbtide.plans.tuning import TuningResult, tune_model
from ebbtide.session import materialise
from ebbtide.sources.models import load_model, save_model
from ebbtide.sources.raw import export_features, ingest, load_features
from ebbtide.sources.reports import generate_error_report, load_metrics, save_csv, save_json
from ebbtide.sources.tables import BASE_TABLES


def make_features(
    customers: DataFrame,
    events: DataFrame,
    window: ObservationWindow,
    path: str,
    event_types: Sequence[str] = EVENT_TYPES,
    valued_types: Sequence[str] = VALUED_TYPES,
    strict: bool = False,
    carry: Sequence[str] = (),
) -> tuple[DataFrame, bool]:
    """Compute, write, read back and check the feature table; ``carry`` adds columns of the customers."""
    export_features(compute_features(customers, events, window, event_types, valued_types, carry=carry), path)
    features = load_features(customers.sparkSession, path)
    return features, validate_features(features, strict=strict)


def train_and_report(features: DataFrame, model_type: str, folder: str, **options: Any) -> TrainedModel:
    """Train, save the model below ``folder`` and write its metrics report with the curves of all splits."""
    trained = train_model(features, model_type, **options)
    save_model(trained.model, f"{folder}/models/{model_type}")
    save_json(trained.report(), f"{folder}/reports/{model_type}_metrics")
    save_curves(trained.scored, f"{folder}/reports/{model_type}")
    return trained


def save_curves(scored: DataFrame, prefix: str) -> None:
    """ROC and precision-recall points as Parquet tables, partitioned by split; a curve may have very many points."""
    for name, curve in (("roc_curve", roc_curve), ("pr_curve", pr_curve)):
        curve(scored, group=("split",)).write.mode("overwrite").partitionBy("split").parquet(f"{prefix}_{name}")


def tune_and_report(features: DataFrame, model_type: str, folder: str, **options: Any) -> TuningResult:
    tuned = tune_model(features, model_type, **options)
    save_model(tuned.best_model, f"{folder}/models/{model_type}_tuned")
    save_json(tuned.summary, f"{folder}/reports/tuning_summary_{model_type}")
    return tuned


def compare_saved_models(spark: SparkSession, paths: Sequence[str], output_path: str | None = None) -> DataFrame:
    """Test metrics of saved reports side by side, as CSV on request."""
    frames = [compare_models(load_metrics(spark, p)) for p in paths]
    compared = frames[0]
    for frame in frames[1:]:
        compared = compared.unionByName(frame)
    if output_path:
        save_csv(compared, output_path)
    return compared


def score_split(model: PipelineModel, features: DataFrame, split: str = "test", date_col: str | None = None) -> DataFrame:
    """Rows of one split scored by a model, for the analyses below."""
    return materialise(add_scores(model, select_split(temporal_split(features, date_col=date_col), split)))


def threshold_analysis(
    scored: DataFrame,
    path: str | None = None,
    cost_fp: float = COST_FP,
    cost_fn: float = COST_FN,
    k_values: Sequence[int] = TOP_K,
) -> DataFrame:
    """One nested row: costs, optimal threshold with its metrics, the sweep and the top-k table."""
    sweep = materialise(analyze_thresholds(scored, cost_fp, cost_fn))
    best = optimal_threshold(sweep).select(F.col("threshold").alias("optimal_threshold"))
    at_best = sweep.join(best, F.col("threshold") == F.col("optimal_threshold"))
    # One entry per grid point and per share: bounded by the arguments.
    records = F.array_sort(F.collect_list(F.struct(*sweep.columns)))
    top = top_k_targeting(scored, k_values)
    top_records = F.array_sort(F.collect_list(F.struct(*top.columns)))
    result = at_best.select(
        F.struct(F.lit(float(cost_fp)).alias("cost_fp"), F.lit(float(cost_fn)).alias("cost_fn")).alias("cost_config"),
        "optimal_threshold",
        F.struct(*sweep.columns).alias("optimal_threshold_metrics"),
        sweep.agg(records).scalar().alias("threshold_analysis"),
        top.agg(top_records).scalar().alias("top_k_analysis"),
    )
    if path:
        save_json(result, path)
    return result


def business_evaluation(
    scored: DataFrame,
    scenarios: Sequence[BusinessScenario],
    path: str | None = None,
    baseline: str = "no_intervention",
) -> DataFrame:
    """Nested report per scenario from one aggregation of the scored rows."""
    best = materialise(best_under_budget(evaluate_counts(threshold_counts(scored), scenarios)))
    report = business_report(best, baseline)
    if path:
        save_json(report, path)
        save_csv(compare_strategies(best, baseline), f"{path}_strategies")
    return report


def error_analysis(
    scored: DataFrame,
    folder: str | None = None,
    fnr_threshold: float = FNR_LIMIT,
    threshold: float | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Segment error table and failure segments, written as JSON and Markdown below ``folder``."""
    if threshold is not None:
        scored = scored.withColumn("prediction", (F.col("score") >= threshold).cast("int"))
    errors = materialise(analyze_errors_by_segment(create_segments(scored)))
    failures = identify_failure_segments(errors, fnr_threshold)
    if folder:
        save_json(errors, f"{folder}/error_analysis")
        save_json(failures, f"{folder}/failure_segments")
        generate_error_report(errors, failures, f"{folder}/error_analysis_report", fnr_threshold=fnr_threshold)
    return errors, failures


@dataclass(frozen=True)
class RunResult:
    features: DataFrame
    valid: bool
    trained: TrainedModel
    thresholds: DataFrame
    business: DataFrame
    errors: DataFrame
    failures: DataFrame


def full_run(
    customers: DataFrame,
    events: DataFrame,
    window: ObservationWindow,
    folder: str,
    model_type: str = "logistic_regression",
    params: Mapping[str, Any] | None = None,
    event_types: Sequence[str] = EVENT_TYPES,
    valued_types: Sequence[str] = VALUED_TYPES,
    scenarios: Sequence[BusinessScenario] = (BusinessScenario(),),
    cost_fp: float = COST_FP,
    cost_fn: float = COST_FN,
    fnr_threshold: float = FNR_LIMIT,
    threshold: float | None = 0.5,
    split: str = "test",
    exclude: Sequence[str] = (),
    seed: int = SEED,
    date_col: str | None = None,
) -> RunResult:
    """Features, checks, training and the four evaluations; rows are scored once.

    ``date_col``: a date of the customers to split by in time; without it rows are split in the order of their ids.
    """
    carry = [date_col] if date_col else []
    features, valid = make_features(
        customers, events, window, f"{folder}/features", event_types, valued_types, carry=carry
    )
    trained = train_and_report(
        features, model_type, folder, params=params, exclude=exclude, seed=seed, date_col=date_col
    )
    scored = select_split(trained.scored, split)
    reports = f"{folder}/reports"
    thresholds = threshold_analysis(scored, f"{reports}/threshold_analysis", cost_fp, cost_fn)
    business = business_evaluation(scored, scenarios, f"{reports}/business_evaluation")
    errors, failures = error_analysis(scored, reports, fnr_threshold, threshold)
    return RunResult(features, valid, trained, thresholds, business, errors, failures)


def evaluate_saved_model(
    spark: SparkSession,
    model_path: str,
    features_path: str,
    folder: str,
    name: str = "model",
    split: str = "test",
    date_col: str | None = None,
    scenarios: Sequence[BusinessScenario] = (BusinessScenario(),),
    cost_fp: float = COST_FP,
    cost_fn: float = COST_FN,
    fnr_threshold: float = FNR_LIMIT,
    threshold: float | None = 0.5,
) -> DataFrame:
    """Metrics, curves, thresholds, business and error reports of a saved model on saved features, below ``folder``.

    Metrics and curves cover all splits, the other reports the chosen one.  Returns the metrics by split.
    """
    features = load_features(spark, features_path)
    scored = materialise(add_scores(load_model(model_path), temporal_split(features, date_col=date_col)))
    metrics = materialise(evaluate(scored))
    reports = f"{folder}/reports"
    save_json(model_report(metrics, name), f"{reports}/{name}_metrics")
    save_curves(scored, f"{reports}/{name}")
    chosen = select_split(scored, split)
    threshold_analysis(chosen, f"{reports}/threshold_analysis", cost_fp, cost_fn)
    business_evaluation(chosen, scenarios, f"{reports}/business_evaluation")
    error_analysis(chosen, reports, fnr_threshold, threshold)
    return metrics


def run_from_raw(
    spark: SparkSession,
    customers_path: str,
    events_path: str,
    window: ObservationWindow,
    folder: str,
    **options: Any,
) -> RunResult:
    """``full_run`` on raw CSV or Parquet files, staged with the declared schemas first."""
    staged = {}
    for name, path in (("customers", customers_path), ("events", events_path)):
        staged[name], profiled, repeated = ingest(
            spark, f"{folder}/staging/{name}", raw_file=path, schema=BASE_TABLES[name]
        )
        save_json(profiled, f"{folder}/reports/{name}_profile")
        save_json(repeated, f"{folder}/reports/{name}_duplicates")
    return full_run(staged["customers"], staged["events"], window, folder, **options)
