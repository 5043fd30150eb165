"""Declared schemas of the base tables and of the saved reports."""

from __future__ import annotations

from pyspark.sql import types as T

CUSTOMERS = T.StructType(
    [
        T.StructField("customer_id", T.StringType(), False),
        T.StructField("signup_date", T.DateType(), True),
        T.StructField("country", T.StringType(), True),
        T.StructField("plan_type", T.StringType(), True),
        T.StructField("monthly_revenue", T.DecimalType(10, 2), True),
        T.StructField("created_at", T.TimestampNTZType(), True),
    ]
)

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType(), False),
        T.StructField("customer_id", T.StringType(), False),
        T.StructField("event_type", T.StringType(), False),
        T.StructField("event_timestamp", T.TimestampNTZType(), False),
        T.StructField("event_value", T.DecimalType(10, 2), True),
        T.StructField("metadata", T.StringType(), True),
    ]
)

CONFUSION = T.StructType(
    [
        T.StructField("true_negatives", T.LongType()),
        T.StructField("false_positives", T.LongType()),
        T.StructField("false_negatives", T.LongType()),
        T.StructField("true_positives", T.LongType()),
    ]
)

CLASS_DISTRIBUTION = T.StructType(
    [
        T.StructField("class_0", T.LongType()),
        T.StructField("class_1", T.LongType()),
        T.StructField("total", T.LongType()),
    ]
)

METRICS = T.StructType(
    [
        T.StructField("accuracy", T.DoubleType()),
        T.StructField("precision", T.DoubleType()),
        T.StructField("recall", T.DoubleType()),
        T.StructField("f1", T.DoubleType()),
        T.StructField("confusion_matrix", CONFUSION),
        T.StructField("false_positive_rate", T.DoubleType()),
        T.StructField("true_positive_rate", T.DoubleType()),
        T.StructField("specificity", T.DoubleType()),
        T.StructField("class_distribution", CLASS_DISTRIBUTION),
        T.StructField("roc_auc", T.DoubleType()),
        T.StructField("pr_auc", T.DoubleType()),
    ]
)

MODEL_REPORT = T.StructType(
    [
        T.StructField("model", T.StringType()),
        T.StructField(
            "splits",
            T.StructType(
                [
                    T.StructField("train", METRICS),
                    T.StructField("validation", METRICS),
                    T.StructField("test", METRICS),
                ]
            ),
        ),
    ]
)

BEST_THRESHOLD = T.StructType(
    [
        T.StructField("threshold", T.DoubleType()),
        T.StructField("net_gain", T.DoubleType()),
        T.StructField("roi_percent", T.DoubleType()),
        T.StructField("total_interventions", T.LongType()),
        T.StructField("intervention_cost", T.DoubleType()),
        T.StructField("prevented_churns", T.LongType()),
        T.StructField("missed_churns", T.LongType()),
        T.StructField("true_positives", T.LongType()),
        T.StructField("false_positives", T.LongType()),
        T.StructField("false_negatives", T.LongType()),
        T.StructField("within_budget", T.BooleanType()),
    ]
)

SCENARIO = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("retention_cost_per_customer", T.DoubleType()),
        T.StructField("churn_loss_per_customer", T.DoubleType()),
        T.StructField("intervention_budget", T.DoubleType()),
    ]
)

# The part of the business report that scoring reads back.
BUSINESS_PARAMETERS = T.StructType([T.StructField("scenario", SCENARIO)])

# The part of the threshold report that scoring reads back.
OPTIMAL_THRESHOLD = T.StructType([T.StructField("optimal_threshold", T.DoubleType())])
