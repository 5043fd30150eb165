"""Star-schema tables seen as customers and event logs, and the matching SQL fragments."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.operators.features import ObservationWindow, churn_labels, compute_features, event_activity
from ebbtide.operators.splits import temporal_split

# The event log: a dense month of activity.  The order log: years of orders per customer.
ACTIVITY_WINDOW = ObservationWindow(date(2024, 1, 31), days=30, churn_days=1)
ACTIVITY_TYPES = ("purchase", "click", "view")
ORDER_WINDOW = ObservationWindow(date(2001, 8, 2), days=90, churn_days=30)
ORDER_TYPES = ("1-URGENT", "2-HIGH", "5-LOW")
DIGITS = 6


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def activity_log(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        "event_id",
        F.col("user_id").alias("customer_id"),
        "event_type",
        F.col("ts").alias("event_timestamp"),
        F.col("value").cast("decimal(10,2)").alias("event_value"),
        F.col("props").alias("metadata"),
    )


def order_log(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("event_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderpriority").alias("event_type"),
        F.col("o_orderdate").alias("event_timestamp"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("event_value"),
    )


def customers(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with the date of their first order as signup date."""
    first = (
        table(spark, folder, "orders")
        .groupBy(F.col("o_custkey").alias("customer_id"))
        .agg(F.to_date(F.min("o_orderdate")).alias("signup_date"))
    )
    nation = table(spark, folder, "nation").select("n_nationkey", F.col("n_name").alias("country"))
    return (
        table(spark, folder, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(
            F.col("c_custkey").alias("customer_id"),
            "country",
            F.col("c_mktsegment").alias("plan_type"),
            F.col("c_acctbal").cast("decimal(10,2)").alias("monthly_revenue"),
        )
        .join(first, "customer_id", "left")
    )


def activity(spark: SparkSession, folder: str) -> DataFrame:
    return event_activity(activity_log(spark, folder), ACTIVITY_WINDOW)


def activity_features(spark: SparkSession, folder: str) -> DataFrame:
    return compute_features(
        customers(spark, folder), activity_log(spark, folder), ACTIVITY_WINDOW, ACTIVITY_TYPES, ("purchase",)
    )


def order_features(spark: SparkSession, folder: str) -> DataFrame:
    return compute_features(
        customers(spark, folder), order_log(spark, folder), ORDER_WINDOW, ORDER_TYPES, ("1-URGENT",)
    )


def with_score(df: DataFrame) -> DataFrame:
    """A fixed score both engines compute alike, with ties, and its prediction."""
    score = ((F.col("customer_id") * 7919) % 1000 * 7 + F.col("label") * 2500) / F.lit(10000.0)
    return df.withColumn("score", score).withColumn("prediction", (F.col("score") >= 0.5).cast("int"))


def scored_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Customers active in the order window: label, signup date, score and prediction."""
    labels = churn_labels(event_activity(order_log(spark, folder), ORDER_WINDOW), ORDER_WINDOW)
    known = customers(spark, folder).select("customer_id", "signup_date")
    return with_score(known.join(labels, "customer_id"))


def scored_splits(spark: SparkSession, folder: str) -> DataFrame:
    return temporal_split(scored_labels(spark, folder), date_col="signup_date")


def finish(df: DataFrame) -> DataFrame:
    """Types both engines share: whole numbers as bigint, fractions as rounded doubles, dates as text."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            column = F.round(column.cast("double"), DIGITS)
        elif isinstance(field.dataType, T.IntegralType):
            column = column.cast("bigint")
        elif isinstance(field.dataType, T.DateType):
            column = column.cast("string")
        columns.append(column.alias(field.name))
    return df.select(*columns)


# --- SQL ---------------------------------------------------------------------------------------

ACTIVITY_LOG_SQL = """ev AS (
  SELECT event_id, user_id AS customer_id, event_type, ts AS event_timestamp,
         CAST(value AS DECIMAL(10,2)) AS event_value, props AS metadata
  FROM events)"""

ORDER_LOG_SQL = """ev AS (
  SELECT o_orderkey AS event_id, o_custkey AS customer_id, o_orderpriority AS event_type,
         o_orderdate AS event_timestamp, CAST(o_totalprice AS DECIMAL(18,2)) AS event_value
  FROM orders)"""

CUSTOMERS_SQL = """cu AS (
  SELECT c.c_custkey AS customer_id, n.n_name AS country, c.c_mktsegment AS plan_type,
         CAST(c.c_acctbal AS DECIMAL(10,2)) AS monthly_revenue, f.signup_date
  FROM customer c
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS signup_date
             FROM orders GROUP BY o_custkey) f ON f.o_custkey = c.c_custkey)"""


def day(value: date) -> str:
    return f"DATE '{value.isoformat()}'"


def window_sql(window: ObservationWindow) -> str:
    """``w``: the events of the window with date parts and zero-filled values."""
    return f"""w AS (
  SELECT customer_id, event_type, event_timestamp AS ts, CAST(event_timestamp AS DATE) AS d,
         coalesce(event_value, 0) AS v, extract(hour FROM event_timestamp) AS h,
         extract(dow FROM event_timestamp) AS dow
  FROM ev
  WHERE event_timestamp >= {day(window.start)} AND event_timestamp < {day(window.end)})"""


def rounded(expression: str, name: str) -> str:
    return f"round(CAST({expression} AS DOUBLE), {DIGITS}) AS {name}"


def whole(expression: str, name: str) -> str:
    return f"CAST({expression} AS BIGINT) AS {name}"


def share(numerator: str, denominator: str) -> str:
    """Double quotient, 0 when undefined."""
    return f"coalesce(CAST({numerator} AS DOUBLE) / NULLIF(CAST({denominator} AS DOUBLE), 0), 0)"


def age(window: ObservationWindow, expression: str) -> str:
    return f"({day(window.end)} - {expression})"


def labels_sql(window: ObservationWindow = ORDER_WINDOW) -> str:
    return f"""lab AS (
  SELECT customer_id, CASE WHEN max(ts) < {day(window.end)} - INTERVAL {window.churn_days} DAY THEN 1 ELSE 0 END AS label
  FROM w GROUP BY customer_id)"""


SCORE_SQL = "((customer_id * 7919) % 1000 * 7 + label * 2500) / CAST(10000 AS DOUBLE)"

# Scored customers with split, as CTEs ending in ``s``.
SCORED_SQL = f"""WITH {ORDER_LOG_SQL}, {CUSTOMERS_SQL}, {window_sql(ORDER_WINDOW)}, {labels_sql()},
s0 AS (
  SELECT cu.customer_id, cu.signup_date, lab.label FROM cu JOIN lab USING (customer_id)),
s1 AS (
  SELECT *, {SCORE_SQL} AS score,
         row_number() OVER (ORDER BY signup_date NULLS LAST, customer_id) AS rn, count(*) OVER () AS n
  FROM s0),
s AS (
  SELECT customer_id, signup_date, label, score, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS prediction,
         CASE WHEN rn <= floor(n * CAST(0.6 AS DOUBLE)) THEN 'train'
              WHEN rn <= floor(n * CAST(0.6 AS DOUBLE)) + floor(n * CAST(0.2 AS DOUBLE)) THEN 'validation'
              ELSE 'test' END AS split
  FROM s1)"""

COUNTS_SQL = """count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp,
       count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn,
       count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp,
       count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn"""
