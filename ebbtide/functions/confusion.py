"""Confusion counts and the rates derived from them, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ebbtide.functions.expressions import safe_ratio

COUNTS = ("true_positives", "true_negatives", "false_positives", "false_negatives")


def confusion_counts(label: Column, prediction: Column) -> list[Column]:
    """The four counts as aggregates of one pass."""
    return [
        F.count_if((label == 1) & (prediction == 1)).alias("true_positives"),
        F.count_if((label == 0) & (prediction == 0)).alias("true_negatives"),
        F.count_if((label == 0) & (prediction == 1)).alias("false_positives"),
        F.count_if((label == 1) & (prediction == 0)).alias("false_negatives"),
    ]


def _counts() -> tuple[Column, Column, Column, Column]:
    return tuple(F.col(c) for c in COUNTS)


def precision() -> Column:
    tp, _, fp, _ = _counts()
    return safe_ratio(tp, tp + fp)


def recall() -> Column:
    tp, _, _, fn = _counts()
    return safe_ratio(tp, tp + fn)


def f1() -> Column:
    tp, _, fp, fn = _counts()
    return safe_ratio(2 * tp, 2 * tp + fp + fn)


def false_positive_rate() -> Column:
    _, tn, fp, _ = _counts()
    return safe_ratio(fp, fp + tn)


def false_negative_rate() -> Column:
    tp, _, _, fn = _counts()
    return safe_ratio(fn, fn + tp)


def specificity() -> Column:
    _, tn, fp, _ = _counts()
    return safe_ratio(tn, tn + fp)


def accuracy() -> Column:
    tp, tn, fp, fn = _counts()
    return safe_ratio(tp + tn, tp + tn + fp + fn)


def total_cost(cost_fp: float, cost_fn: float) -> Column:
    return F.col("false_positives") * F.lit(float(cost_fp)) + F.col("false_negatives") * F.lit(float(cost_fn))
