"""Scoring decisions: expected value, recommended action and confidence; null without a prediction."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values used when no saved report supplies them.
DEFAULT_THRESHOLD = 0.5
DEFAULT_RETENTION_COST = 10.0
DEFAULT_CHURN_LOSS = 100.0
# Fixed confidence bounds.
HIGH_PROBABILITY = 0.7
MEDIUM_PROBABILITY = 0.5
LOW_PROBABILITY = 0.3


def expected_value(probability: Column, churn_loss: Column, retention_cost: Column) -> Column:
    return probability * churn_loss - retention_cost


def recommended_action(predicted: Column, value: Column) -> Column:
    return (
        F.when(predicted & (value > 0), F.lit("intervene"))
        .when(predicted, F.lit("monitor"))
        .when(~predicted, F.lit("no_action"))
    )


def confidence(action: Column, probability: Column) -> Column:
    intervene = (
        F.when(probability > HIGH_PROBABILITY, F.lit("high"))
        .when(probability > MEDIUM_PROBABILITY, F.lit("medium"))
        .otherwise(F.lit("low"))
    )
    leave = F.when(probability < LOW_PROBABILITY, F.lit("high")).otherwise(F.lit("medium"))
    return (
        F.when(action == "intervene", intervene)
        .when(action == "monitor", F.lit("low"))
        .when(action == "no_action", leave)
    )
