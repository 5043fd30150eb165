"""Cost and return of interventions under scenarios with an optional budget."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.functions.decisions import DEFAULT_CHURN_LOSS, DEFAULT_RETENTION_COST
from ebbtide.functions.expressions import safe_ratio
from ebbtide.operators.thresholds import threshold_counts

BASELINES = ("no_intervention", "random")


@dataclass(frozen=True)
class BusinessScenario:
    retention_cost: float = DEFAULT_RETENTION_COST
    churn_loss: float = DEFAULT_CHURN_LOSS
    budget: float | None = None
    name: str = "default"

    def literal(self) -> Column:
        return F.struct(
            F.lit(self.name).alias("scenario"),
            F.lit(float(self.retention_cost)).alias("retention_cost"),
            F.lit(float(self.churn_loss)).alias("churn_loss"),
            F.lit(None if self.budget is None else float(self.budget)).cast("double").alias("budget"),
        )


def net_gain(tp: Column, interventions: Column) -> Column:
    """Losses prevented minus what the interventions cost."""
    return tp * F.col("churn_loss") - interventions * F.col("retention_cost")


def roi_percent(gain: Column, investment: Column) -> Column:
    """Gain per amount spent in percent, 0 without spending."""
    return safe_ratio(gain, investment) * 100


def evaluate_counts(counts: DataFrame, scenarios: Sequence[BusinessScenario]) -> DataFrame:
    """Business outcome of every (scenario, threshold) from confusion counts per threshold."""
    spread = counts.select("*", F.inline(F.array(*[s.literal() for s in scenarios])))
    targeted = F.col("true_positives") + F.col("false_positives")
    return (
        spread.withColumn("total_interventions", targeted)
        .withColumn("intervention_cost", F.col("total_interventions") * F.col("retention_cost"))
        .withColumn("net_gain", net_gain(F.col("true_positives"), F.col("total_interventions")))
        .select(
            "scenario",
            "threshold",
            "true_positives",
            "true_negatives",
            "false_positives",
            "false_negatives",
            "total_interventions",
            "intervention_cost",
            F.col("true_positives").alias("prevented_churns"),
            F.col("false_negatives").alias("missed_churns"),
            "net_gain",
            roi_percent(F.col("net_gain"), F.col("intervention_cost")).alias("roi_percent"),
            (F.col("budget").isNull() | (F.col("intervention_cost") <= F.col("budget"))).alias("within_budget"),
            "retention_cost",
            "churn_loss",
            "budget",
        )
    )


def evaluate_business_scenario(
    scored: DataFrame,
    scenarios: Sequence[BusinessScenario] | BusinessScenario,
    thresholds: Sequence[float] | None = None,
    label_col: str = "label",
    score_col: str = "score",
) -> DataFrame:
    """Scored rows are aggregated once, whatever the number of thresholds and scenarios."""
    if isinstance(scenarios, BusinessScenario):
        scenarios = [scenarios]
    return evaluate_counts(threshold_counts(scored, thresholds, label_col, score_col), scenarios)


def best_under_budget(business: DataFrame) -> DataFrame:
    """Per scenario the affordable threshold with the highest net gain, or the cheapest if none is.

    The lowest threshold wins a tie.
    """
    row = F.struct(*business.columns)
    gain = F.struct(F.col("net_gain").alias("m"), (-F.col("threshold")).alias("t"), row.alias("row"))
    cost = F.struct(F.col("intervention_cost").alias("m"), F.col("threshold").alias("t"), row.alias("row"))
    best = F.coalesce(
        F.max(F.when(F.col("within_budget"), gain)).getField("row"), F.min(cost).getField("row")
    )
    return (
        business.groupBy("scenario")
        .agg(best.alias("_b"))
        .select("_b.*")
        .select(
            "scenario",
            "threshold",
            "net_gain",
            "roi_percent",
            "total_interventions",
            "intervention_cost",
            "prevented_churns",
            "missed_churns",
            "true_positives",
            "false_positives",
            "false_negatives",
            "true_negatives",
            "within_budget",
            "retention_cost",
            "churn_loss",
            "budget",
        )
    )


def compare_strategies(best: DataFrame, baseline: str = "no_intervention") -> DataFrame:
    """Baseline, optimised and incremental outcome per scenario.

    The random baseline targets half of the customers and meets half of the churned ones.
    """
    if baseline not in BASELINES:
        raise ValueError(f"unknown baseline strategy {baseline!r}: expected one of {', '.join(BASELINES)}")
    positives = F.col("true_positives") + F.col("false_negatives")
    rows = positives + F.col("false_positives") + F.col("true_negatives")
    half = (lambda c: F.floor(c / 2)) if baseline == "random" else (lambda c: F.lit(0).cast("bigint"))
    sized = best.withColumn("_n", half(rows)).withColumn("_tp", half(positives))
    sized = sized.withColumn("_gain", net_gain(F.col("_tp"), F.col("_n")))
    more = F.col("net_gain") - F.col("_gain")
    extra = F.col("total_interventions") - F.col("_n")

    def outcome(name: str, gain: Column, interventions: Column) -> Column:
        investment = interventions * F.col("retention_cost")
        roi = F.when(investment > 0, roi_percent(gain, investment)).otherwise(0.0)
        return F.struct(
            F.lit(name).alias("strategy"),
            gain.alias("net_gain"),
            interventions.alias("interventions"),
            investment.alias("investment"),
            roi.alias("roi_percent"),
        )

    return sized.select(
        "scenario",
        F.inline(
            F.array(
                outcome("baseline", F.col("_gain"), F.col("_n")),
                outcome("optimized", F.col("net_gain"), F.col("total_interventions")),
                outcome("incremental", more, extra),
            )
        ),
    )


def business_report(best: DataFrame, baseline: str = "no_intervention") -> DataFrame:
    """One nested row per scenario: parameters, best threshold, comparison and totals."""
    compared = compare_strategies(best, baseline)
    fields = F.struct("net_gain", "interventions", "investment", "roi_percent")
    by_scenario = compared.groupBy("scenario").agg(
        *[F.max(F.when(F.col("strategy") == s, fields)).alias(s) for s in ("baseline", "optimized", "incremental")]
    )
    churned = F.col("true_positives") + F.col("false_negatives")
    rows = churned + F.col("false_positives") + F.col("true_negatives")
    return best.join(by_scenario, "scenario").select(
        F.struct(
            F.col("scenario").alias("name"),
            F.col("retention_cost").alias("retention_cost_per_customer"),
            F.col("churn_loss").alias("churn_loss_per_customer"),
            F.col("budget").alias("intervention_budget"),
        ).alias("scenario"),
        F.struct(
            "threshold",
            "net_gain",
            "roi_percent",
            "total_interventions",
            "intervention_cost",
            "prevented_churns",
            "missed_churns",
            "true_positives",
            "false_positives",
            "false_negatives",
            "within_budget",
        ).alias("best_threshold"),
        F.lit(baseline).alias("baseline_strategy"),
        F.struct("baseline", "optimized", "incremental").alias("comparison"),
        F.struct(
            F.col("incremental.net_gain").alias("incremental_net_gain"),
            F.col("incremental.roi_percent").alias("incremental_roi"),
            rows.alias("total_customers"),
            churned.alias("total_churned"),
            safe_ratio(churned, rows).alias("churn_rate"),
        ).alias("summary"),
    )
