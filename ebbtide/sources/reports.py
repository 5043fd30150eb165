"""Report files: JSON, CSV and Markdown, all written from small result frames."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ebbtide.operators.scoring import DecisionParameters
from ebbtide.operators.segments import FNR_LIMIT, MIN_SAMPLES
from ebbtide.schemas import BUSINESS_PARAMETERS, MODEL_REPORT, OPTIMAL_THRESHOLD


def save_json(df: DataFrame, path: str) -> str:
    """One JSON object per row; nulls are kept as fields."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    return path


def load_json(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def load_metrics(spark: SparkSession, path: str) -> DataFrame:
    return load_json(spark, path, MODEL_REPORT)


def save_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", "true").csv(path)
    return path


def load_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return spark.read.schema(schema).option("header", "true").csv(path)


def load_decision_parameters(
    spark: SparkSession, threshold_path: str | None = None, business_path: str | None = None
) -> DecisionParameters:
    """Threshold and costs from saved reports; a missing report or field leaves the default."""

    def first(path: str | None, schema: StructType, *columns: str):
        if path is None:
            return [None] * len(columns)
        try:
            row = load_json(spark, path, schema).select(*columns).first()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            row = None
        return [None] * len(columns) if row is None else list(row)

    (threshold,) = first(threshold_path, OPTIMAL_THRESHOLD, "optimal_threshold")
    cost, loss = first(
        business_path,
        BUSINESS_PARAMETERS,
        "scenario.retention_cost_per_customer",
        "scenario.churn_loss_per_customer",
    )
    default = DecisionParameters()
    return DecisionParameters(
        threshold=default.threshold if threshold is None else threshold,
        retention_cost=default.retention_cost if cost is None else cost,
        churn_loss=default.churn_loss if loss is None else loss,
    )


# --- Markdown report of segment errors --------------------------------------------------------


def _percent(c: str) -> Column:
    return F.format_string("%.2f%%", F.col(c) * 100)


def _whole(c: str) -> Column:
    return F.format_string("%,d", F.col(c))


def _decimal(c: str) -> Column:
    return F.format_string("%.4f", F.col(c))


def _table_row(*cells: Column) -> Column:
    return F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |"))


def _header(*titles: str) -> list[str]:
    return ["| " + " | ".join(titles) + " |", "|" + "---|" * len(titles)]


def error_report_lines(
    errors: DataFrame, failures: DataFrame, fnr_threshold: float = FNR_LIMIT, min_samples: int = MIN_SAMPLES
) -> DataFrame:
    """The report as ordered lines ``section, part, position, line`` built from the segment rows.

    ``section`` orders the chapters, ``part`` the segment types within one, ``position`` the rows.
    """
    spark = errors.sparkSession

    def fixed(section: int, part: str, start: int, lines: list[str]) -> DataFrame:
        rows = [(section, part, float(start + i), text) for i, text in enumerate(lines)]
        return spark.createDataFrame(rows, "section int, part string, position double, line string")

    overall = errors.filter("segment_type = 'overall'")
    rates = [
        F.concat(F.lit(f"- **{title}**: "), value)
        for title, value in (
            ("Samples", _whole("n_samples")),
            ("Churn rate", _percent("churn_rate")),
            ("False negative rate", _percent("false_negative_rate")),
            ("False positive rate", _percent("false_positive_rate")),
        )
    ]
    counts = [
        _table_row(F.lit(title), value)
        for title, value in (
            ("True positives", _whole("true_positives")),
            ("True negatives", _whole("true_negatives")),
            ("False positives", _whole("false_positives")),
            ("False negatives", _whole("false_negatives")),
            ("Precision", _decimal("precision")),
            ("Recall", _decimal("recall")),
        )
    ]

    def spread(section: int, start: int, lines: list[Column]) -> DataFrame:
        return overall.select(F.posexplode(F.array(*lines)).alias("i", "line")).select(
            F.lit(section).alias("section"),
            F.lit("").alias("part"),
            (F.col("i") + start).cast("double").alias("position"),
            "line",
        )

    failed = failures.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(1).alias("section"),
        F.lit("").alias("part"),
        F.lit(50.0).alias("position"),
        F.concat(F.lit("- **Failure segments**: "), _whole("n")).alias("line"),
    )

    segments = errors.filter("segment_type <> 'overall'")
    titles = segments.select("segment_type").distinct().select(
        F.lit(3).alias("section"),
        F.col("segment_type").alias("part"),
        F.posexplode(
            F.array(
                F.concat(F.lit("### "), F.initcap(F.replace("segment_type", F.lit("_"), F.lit(" ")))),
                F.lit(""),
                *[F.lit(t) for t in _header("Segment", "Samples", "Churn rate", "FNR", "FPR", "Precision", "Recall")],
            )
        ).alias("i", "line"),
    )
    titles = titles.select("section", "part", (F.col("i") - 10).cast("double").alias("position"), "line")

    def rows(df: DataFrame, section: int, part: Column, cells: list[Column]) -> DataFrame:
        # Positions fall with the rate, so ordering by position lists the worst segments first.
        return df.select(
            F.lit(section).alias("section"),
            part.alias("part"),
            (F.lit(2.0) - F.col("false_negative_rate")).alias("position"),
            _table_row(*cells).alias("line"),
        )

    measures = [_whole("n_samples"), _percent("churn_rate"), _percent("false_negative_rate"),
                _percent("false_positive_rate")]
    segment_rows = rows(
        segments, 3, F.col("segment_type"),
        [F.col("segment_value"), *measures, _decimal("precision"), _decimal("recall")],
    )
    failure_rows = rows(failures, 4, F.lit("b"), [F.col("segment_type"), F.col("segment_value"), *measures])
    parts = [
        fixed(0, "", 0, ["# Segment error analysis", ""]),
        fixed(1, "", 0, ["## Summary", ""]),
        spread(1, 10, rates),
        failed,
        fixed(2, "", 0, ["", "## Overall", "", *_header("Measure", "Value")]),
        spread(2, 10, counts),
        fixed(3, "", 0, ["", "## By segment", ""]),
        titles,
        segment_rows,
        fixed(4, "a", 0, ["", "## Failure segments", "",
                          *_header("Segment type", "Segment", "Samples", "Churn rate", "FNR", "FPR")]),
        failure_rows,
        fixed(5, "", 0, [
            "",
            "## Method",
            "",
            f"- A failure segment has a false negative rate of at least {fnr_threshold:.0%} "
            f"and at least {min_samples} samples.",
        ]),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def generate_error_report(errors: DataFrame, failures: DataFrame, path: str, **limits) -> str:
    """Write the report as one Markdown text file: a few dozen lines, sorted."""
    lines = error_report_lines(errors, failures, **limits)
    ordered = lines.repartition(1).sortWithinPartitions("section", "part", "position", "line").select("line")
    ordered.write.mode("overwrite").text(path)
    return path
