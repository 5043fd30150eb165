"""Threshold sweeps, best thresholds and top-k targeting over scored rows."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.functions import confusion
from ebbtide.functions.expressions import safe_ratio
from ebbtide.operators.curves import is_scored
from ebbtide.operators.selection import keys_at_ranks, literal, sortable

# Error costs, grid size and target shares in percent.
COST_FP = 1.0
COST_FN = 5.0
GRID_POINTS = 100
TOP_K = (10, 20, 30, 40, 50)


def default_grid() -> list[float]:
    return [float(t) for t in np.linspace(0.0, 1.0, GRID_POINTS)]


def points_reached(score: Column, grid: Sequence[float]) -> Column:
    """How many points of the ascending grid are at most the score.

    Equal-width bins narrow the search: every point in a lower bin is below the score and every point
    in a higher bin above it, because the bin number grows with the value.  Only the points that share
    the bin of the score are compared with it, one or two for an even grid.
    """
    if not grid:
        return F.lit(0)
    points = np.asarray(grid, dtype=float)
    low, high = float(points[0]), float(points[-1])
    bins = 2 * len(points)
    scale = bins / (high - low) if high > low else 0.0
    bin_of_point = np.floor((points - low) * scale).astype(int)
    per_bin = np.bincount(bin_of_point)
    before = np.concatenate([[0], np.cumsum(per_bin)[:-1]])

    inside = F.least(F.greatest(score, F.lit(low)), F.lit(high))
    start = F.get(F.lit([int(n) for n in before]), F.floor((inside - F.lit(low)) * F.lit(scale)).cast("int"))
    values = F.lit([float(t) for t in points])
    reached = start
    for i in range(int(per_bin.max())):
        reached = reached + F.when(score >= F.get(values, start + i), 1).otherwise(0)
    return F.when(score.isNull() | F.isnan(score), 0).otherwise(reached)


def threshold_counts(
    scored: DataFrame,
    grid: Sequence[float] | None = None,
    label_col: str = "label",
    score_col: str = "score",
    group: Sequence[str] = (),
) -> DataFrame:
    """Confusion counts at every threshold (``score >= t`` is positive) from one aggregation.

    Rows are counted by the number of grid points they reach; the counts at a threshold are running
    sums over at most ``len(grid) + 1`` rows per group.
    """
    grid = sorted(set(default_grid() if grid is None else [float(t) for t in grid]))
    y = F.col(label_col)
    reached = scored.select(*group, y.alias("_y"), points_reached(F.col(score_col), grid).alias("_reached"))
    counts = reached.groupBy(*group, "_reached").agg(
        F.count_if(F.col("_y") == 1).alias("_pos"), F.count_if(F.col("_y") == 0).alias("_neg")
    )
    down = Window.partitionBy(*group).orderBy(F.desc("_reached"))
    upto = down.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(*group)
    sums = counts.select(
        *group,
        "_reached",
        F.sum("_pos").over(upto).alias("_tp"),
        F.sum("_neg").over(upto).alias("_fp"),
        F.sum("_pos").over(whole).alias("_all_pos"),
        F.sum("_neg").over(whole).alias("_all_neg"),
        F.lead("_reached", 1, 0).over(down).alias("_lower"),
        (F.row_number().over(down) == 1).alias("_top"),
    )
    # Each counted row answers for the thresholds between the next lower count and its own; the top
    # row also for those nobody reaches.
    last = F.when(F.col("_top"), F.lit(len(grid))).otherwise(F.col("_reached"))
    covered = sums.withColumn("_last", last).filter(F.col("_lower") < F.col("_last"))
    spread = covered.withColumn("_i", F.explode(F.sequence(F.col("_lower") + 1, F.col("_last"))))
    hit = F.col("_i") <= F.col("_reached")
    tp, fp = F.when(hit, F.col("_tp")).otherwise(0), F.when(hit, F.col("_fp")).otherwise(0)
    return spread.select(
        *group,
        F.get(F.lit(grid), F.col("_i") - 1).alias("threshold"),
        tp.alias("true_positives"),
        (F.col("_all_neg") - fp).alias("true_negatives"),
        fp.alias("false_positives"),
        (F.col("_all_pos") - tp).alias("false_negatives"),
    )


def analyze_thresholds(
    scored: DataFrame,
    cost_fp: float = COST_FP,
    cost_fn: float = COST_FN,
    thresholds: Sequence[float] | None = None,
    label_col: str = "label",
    score_col: str = "score",
    group: Sequence[str] = (),
) -> DataFrame:
    """Precision, recall, F1, counts and total cost at every threshold."""
    return threshold_counts(scored, thresholds, label_col, score_col, group).select(
        *group,
        "threshold",
        confusion.precision().alias("precision"),
        confusion.recall().alias("recall"),
        confusion.f1().alias("f1"),
        *confusion.COUNTS,
        confusion.total_cost(cost_fp, cost_fn).alias("total_cost"),
        F.lit(float(cost_fp)).alias("cost_fp"),
        F.lit(float(cost_fn)).alias("cost_fn"),
    )


def total_cost(
    df: DataFrame,
    cost_fp: float = 1.0,
    cost_fn: float = 1.0,
    label_col: str = "label",
    prediction_col: str = "prediction",
) -> DataFrame:
    counts = df.agg(*confusion.confusion_counts(F.col(label_col), F.col(prediction_col)))
    return counts.select(confusion.total_cost(cost_fp, cost_fn).alias("total_cost"))


def optimal_threshold(
    sweep: DataFrame, metric: str = "total_cost", minimize: bool = True, group: Sequence[str] = ()
) -> DataFrame:
    """Row with the best metric; the lowest threshold wins a tie."""
    if minimize:
        best = F.min(F.struct(F.col(metric).alias("m"), F.col("threshold").alias("t")))
        sign = 1
    else:
        best = F.max(F.struct(F.col(metric).alias("m"), (-F.col("threshold")).alias("t")))
        sign = -1
    return (
        sweep.filter(F.col(metric).isNotNull())
        .groupBy(*group)
        .agg(best.alias("_b"))
        .select(*group, (F.col("_b.t") * sign).alias("threshold"), F.col("_b.m").alias(metric))
    )


def find_optimal_threshold(sweep: DataFrame, metric: str = "total_cost", minimize: bool = True) -> float:
    return float(optimal_threshold(sweep, metric, minimize).first()["threshold"])


def top_k_targeting(
    scored: DataFrame,
    k_values: Sequence[int] = TOP_K,
    label_col: str = "label",
    score_col: str = "score",
    id_col: str = "customer_id",
) -> DataFrame:
    """Outcome of targeting the k percent highest scores; ties go to the lower id, rows without a score are left out."""
    score = F.col(score_col)
    key = F.struct((-score).alias("k0"), sortable(scored, id_col).alias("k1"))
    narrow = scored.filter(is_scored(score_col)).select(key.alias("key"), F.col(label_col).alias("_y")).persist()
    # Boundary keys instead of ranks of all rows.
    keys = narrow.select("key")
    total, bounds = keys_at_ranks(keys, lambda n: [math.floor(float(n) * (k / 100.0)) for k in k_values])
    kind = keys.schema["key"].dataType
    positive = F.col("_y") == 1
    aggregates = [F.lit(total).cast("bigint").alias("n"), F.count_if(positive).alias("pos")]
    for i, bound in enumerate(bounds):
        inside = F.lit(False) if bound is None else F.col("key") <= literal(bound, kind)
        aggregates += [F.count_if(inside & positive).alias(f"tp{i}"), F.count_if(inside & ~positive).alias(f"fp{i}")]
    counts = narrow.agg(*aggregates)
    one = scored.sparkSession.createDataFrame([counts.first()], counts.schema)
    narrow.unpersist()
    rows = [
        F.struct(
            F.lit(k).cast("bigint").alias("k_percent"),
            F.floor(F.col("n").cast("double") * F.lit(k / 100.0)).alias("k_absolute"),
            F.col(f"tp{i}").alias("true_positives"),
            F.col(f"fp{i}").alias("false_positives"),
            (F.col("pos") - F.col(f"tp{i}")).alias("false_negatives"),
        )
        for i, k in enumerate(k_values)
    ]
    return (
        one.filter("n > 0")
        .select(F.inline(F.array(*rows)))
        .select(
            "k_percent",
            "k_absolute",
            confusion.precision().alias("precision"),
            confusion.recall().alias("recall"),
            safe_ratio(F.col("true_positives"), F.col("k_absolute")).alias("churn_rate_in_top_k"),
            "true_positives",
            "false_positives",
            "false_negatives",
        )
    )
