"""Customer segments and the error rates of a model within them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.functions import confusion
from ebbtide.functions.expressions import present_double, safe_ratio
from ebbtide.operators.quantiles import exact_median, exact_quantiles

SEGMENTS = ("activity_segment", "tenure_segment", "usage_segment")
# Fixed limits for failure segments.
FNR_LIMIT = 0.3
MIN_SAMPLES = 10


def _first_present(df: DataFrame, *names: str) -> str | None:
    return next((n for n in names if n in df.columns), None)


def _split_at(df: DataFrame, name: str | None, medians: dict, upper: str, lower: str, missing: str) -> Column:
    """``upper`` from the median on, ``lower`` below it, ``missing`` for an empty value."""
    if name is None:
        return F.lit("unknown")
    value, middle = present_double(df, name), F.lit(medians[name]).cast("double")
    return F.when(value >= middle, upper).when(value < middle, lower).otherwise(missing)


def create_segments(df: DataFrame) -> DataFrame:
    """Add activity, tenure and usage segments, cut at exact medians of the columns at hand."""
    activity = _first_present(df, "total_events", "events_last_30d")
    tenure = _first_present(df, "customer_age_days", "days_since_signup")
    by_counts = "count_purchase" in df.columns and "count_login" in df.columns
    revenue = None if by_counts else _first_present(df, "total_revenue")
    medians = exact_median(df, [c for c in (activity, tenure, revenue) if c])

    if by_counts:
        usage = (
            F.when(F.col("count_purchase") > 0, "purchaser")
            .when(F.col("count_login") > 0, "browser")
            .otherwise("inactive")
        )
    else:
        usage = _split_at(df, revenue, medians, "high_value", "low_value", "low_value")
    return df.select(
        "*",
        _split_at(df, activity, medians, "high", "low", "low").alias("activity_segment"),
        _split_at(df, tenure, medians, "established", "new", "established").alias("tenure_segment"),
        usage.alias("usage_segment"),
    )


def analyze_errors_by_segment(
    df: DataFrame,
    label_col: str = "label",
    prediction_col: str = "prediction",
    segments: Sequence[str] = SEGMENTS,
) -> DataFrame | None:
    """Counts and error rates overall and per segment value; None when no segment column is present.

    Rows are counted once per combination of segments; the grouping sets run over those few rows.
    """
    segments = [c for c in segments if c in df.columns]
    if not segments:
        return None
    y, p = F.col(label_col), F.col(prediction_col)
    combined = df.groupBy(*segments).agg(
        F.count(F.lit(1)).alias("n_samples"),
        F.count_if(y == 1).alias("n_churned"),
        *confusion.confusion_counts(y, p),
    )
    measures = ("n_samples", "n_churned", *confusion.COUNTS)
    sets = [[F.col(c)] for c in segments] + [[]]
    rolled = combined.groupingSets(sets, *segments).agg(
        F.grouping_id().alias("_set"), *[F.sum(m).alias(m) for m in measures]
    )
    # Bit i of the grouping id, counted from the left, is 0 for the column that is kept.
    full = (1 << len(segments)) - 1
    kind, value = F.lit("overall"), F.lit("all")
    for i, c in enumerate(segments):
        kept = F.col("_set") == (full & ~(1 << (len(segments) - 1 - i)))
        kind = F.when(kept, F.lit(c)).otherwise(kind)
        value = F.when(kept, F.col(c).cast("string")).otherwise(value)
    return rolled.select(
        kind.alias("segment_type"),
        value.alias("segment_value"),
        "n_samples",
        "n_churned",
        safe_ratio(F.col("n_churned"), F.col("n_samples")).alias("churn_rate"),
        *confusion.COUNTS,
        confusion.false_negative_rate().alias("false_negative_rate"),
        confusion.false_positive_rate().alias("false_positive_rate"),
        confusion.precision().alias("precision"),
        confusion.recall().alias("recall"),
    )


def identify_failure_segments(
    errors: DataFrame, fnr_threshold: float = FNR_LIMIT, min_samples: int = MIN_SAMPLES
) -> DataFrame:
    """Segments with a high false-negative rate and enough rows, worst first."""
    return errors.filter(
        (F.col("false_negative_rate") >= fnr_threshold)
        & (F.col("n_samples") >= min_samples)
        & (F.col("segment_type") != "overall")
    ).orderBy(F.desc("false_negative_rate"), "segment_type", "segment_value")


def behavioural_segments(df: DataFrame) -> DataFrame:
    """Add ``customer_segment`` and ``engagement_level``.

    The cuts are quartiles of this frame.  Recent, frequent and valuable mean the better quarter;
    stale means the worst quarter of recency.  champion: recent and (frequent or valuable); at_risk:
    stale and (frequent or valuable); lost: stale otherwise; regular: everyone else.  Engagement is
    high or low for the upper and lower quarter of events per day, medium between.
    """
    cut = exact_quantiles(
        df, ["days_since_last_event", "total_events", "total_revenue", "events_per_day"], (0.25, 0.75)
    )

    def bound(name: str, upper: bool) -> Column:
        return F.lit(cut[name][1 if upper else 0]).cast("double")

    recent = F.col("days_since_last_event") <= bound("days_since_last_event", False)
    stale = F.col("days_since_last_event") >= bound("days_since_last_event", True)
    strong = (F.col("total_events") >= bound("total_events", True)) | (
        F.col("total_revenue") >= bound("total_revenue", True)
    )
    segment = (
        F.when(recent & strong, "champion").when(stale & strong, "at_risk").when(stale, "lost").otherwise("regular")
    )
    rate = F.col("events_per_day")
    engagement = (
        F.when(rate >= bound("events_per_day", True), "high")
        .when(rate <= bound("events_per_day", False), "low")
        .otherwise("medium")
    )
    return df.select("*", segment.alias("customer_segment"), engagement.alias("engagement_level"))
