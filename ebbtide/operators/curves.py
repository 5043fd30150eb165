"""ROC and precision-recall curves and the areas under them, one row per point.

Rows are first counted per distinct score, which removes ties however large they
are; the running sums over distinct scores are distributed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.functions.expressions import safe_ratio
from ebbtide.operators.ranking import running_totals


def is_scored(score_col: str) -> Column:
    """Null and NaN are no scores: such rows are on no curve and in no ranking."""
    return F.col(score_col).isNotNull() & ~F.isnan(F.col(score_col).cast("double"))


def score_counts(scored: DataFrame, label_col: str, score_col: str, group: Sequence[str]) -> DataFrame:
    """Positives and negatives of every distinct score, the ``threshold``."""
    y = F.col(label_col)
    return (
        scored.filter(is_scored(score_col) & F.col(label_col).isin(0, 1))
        .groupBy(*group, F.col(score_col).alias("threshold"))
        .agg(F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg"))
    )


def _running(counts: DataFrame, group: Sequence[str], like: tuple[DataFrame, str] | None = None) -> DataFrame:
    """From high to low: running and total counts of each distinct score."""
    return running_totals(counts, "threshold", ["pos", "neg"], group, following=["pos", "neg"], like=like)


def _cumulative(scored: DataFrame, label_col: str, score_col: str, group: Sequence[str]) -> DataFrame:
    scores = scored.filter(is_scored(score_col))
    return _running(score_counts(scored, label_col, score_col, group), group, like=(scores, score_col))


def roc_curve(
    scored: DataFrame,
    label_col: str = "label",
    score_col: str = "score",
    group: Sequence[str] = (),
    drop_intermediate: bool = True,
) -> DataFrame:
    """``fpr, tpr, threshold`` from (0, 0) with a null threshold; groups with one class have no curve.

    A point is dropped when the step after it equals the step before it, so it lies on a line.
    """
    c = _cumulative(scored, label_col, score_col, group).filter((F.col("all_pos") > 0) & (F.col("all_neg") > 0))
    first = (F.col("cum_pos") == F.col("pos")) & (F.col("cum_neg") == F.col("neg"))
    last = F.col("next_pos").isNull()
    turns = (F.col("next_pos") != F.col("pos")) | (F.col("next_neg") != F.col("neg"))
    if drop_intermediate:
        c = c.filter(first | last | turns)
    point = F.struct(
        safe_ratio(F.col("cum_neg"), F.col("all_neg")).alias("fpr"),
        safe_ratio(F.col("cum_pos"), F.col("all_pos")).alias("tpr"),
        F.col("threshold").alias("threshold"),
    )
    origin = F.struct(
        F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"), F.lit(None).cast("double").alias("threshold")
    )
    return c.select(*group, F.inline(F.when(first, F.array(origin, point)).otherwise(F.array(point))))


def pr_curve(
    scored: DataFrame, label_col: str = "label", score_col: str = "score", group: Sequence[str] = ()
) -> DataFrame:
    """``precision, recall, threshold`` with the end point (1, 0) and a null threshold."""
    c = _cumulative(scored, label_col, score_col, group).filter((F.col("all_pos") > 0) & (F.col("all_neg") > 0))
    first = (F.col("cum_pos") == F.col("pos")) & (F.col("cum_neg") == F.col("neg"))
    point = F.struct(
        safe_ratio(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg")).alias("precision"),
        safe_ratio(F.col("cum_pos"), F.col("all_pos")).alias("recall"),
        F.col("threshold").alias("threshold"),
    )
    end = F.struct(
        F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"), F.lit(None).cast("double").alias("threshold")
    )
    return c.select(*group, F.inline(F.when(first, F.array(end, point)).otherwise(F.array(point))))


def areas(
    scored: DataFrame, label_col: str = "label", score_col: str = "score", group: Sequence[str] = ()
) -> DataFrame:
    """``roc_auc`` and ``pr_auc`` by trapezoids, null when only one class is present."""
    return _areas(_cumulative(scored, label_col, score_col, group), group)


def areas_of_counts(counts: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """The same from ``pos`` and ``neg`` of every distinct ``threshold``."""
    return _areas(_running(counts, group), group)


def _areas(c: DataFrame, group: Sequence[str]) -> DataFrame:
    before_pos, before_neg = F.col("cum_pos") - F.col("pos"), F.col("cum_neg") - F.col("neg")
    before = before_pos + before_neg
    # Twice the number of (negative, positive) pairs ordered right, ties counting half.
    pairs = F.sum(F.col("neg").cast("double") * (F.col("cum_pos") + before_pos))
    precision = F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))
    earlier = F.when(before > 0, F.try_divide(before_pos.cast("double"), before.cast("double"))).otherwise(1.0)
    steps = F.sum(F.col("pos") * (precision + earlier) / 2)
    p, n = F.max("all_pos"), F.max("all_neg")
    both = (p > 0) & (n > 0)
    return c.groupBy(*group).agg(
        F.when(both, F.try_divide(pairs, 2.0 * p.cast("double") * n.cast("double"))).alias("roc_auc"),
        F.when(both, F.try_divide(steps, p.cast("double"))).alias("pr_auc"),
    )
