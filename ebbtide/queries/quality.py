"""Data-quality queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.functions.expressions import align_columns
from ebbtide.operators import quality as q
from ebbtide.queries.common import (
    ACTIVITY_LOG_SQL,
    CUSTOMERS_SQL,
    activity_features,
    activity_log,
    customers,
    finish,
    order_features,
    order_log,
    rounded,
    table,
)
from ebbtide.queries.features import ACTIVITY_FEATURES_SQL, ORDER_FEATURES_SQL
from ebbtide.session import materialise

# What a model might expect: columns of the feature table in another order, and two it does not have.
EXPECTED_COLUMNS = (
    "activity_slope",
    "total_revenue",
    "seats",
    "active_days",
    "events_last_14d",
    "avg_event_value",
    "discount",
    "monthly_revenue",
    "days_since_last_event",
)
FOREIGN_COLUMNS = ("seats", "discount")
EVENT_COLUMNS = {
    "event_id": "bigint",
    "ts": "timestamp_ntz",
    "user_id": "bigint",
    "event_type": "string",
    "value": "double",
    "props": "string",
}
NULLABLE_COLUMNS = ("customer_id", "country", "plan_type", "monthly_revenue", "signup_date")
# The numeric columns of the activity feature table in order.
NUMERIC = (
    "customer_age_days monthly_revenue days_since_last_event days_since_first_event total_events "
    "unique_event_types events_per_day active_days total_revenue avg_event_value max_event_value "
    "events_last_7d events_last_14d events_last_30d revenue_last_7d revenue_last_14d revenue_last_30d "
    "event_trend_7d_30d event_trend_14d_30d revenue_trend_7d_30d revenue_trend_14d_30d activity_slope "
    "weekend_activity_ratio peak_hour_activity activity_consistency count_purchase avg_purchase_value "
    "last_purchase_days_ago count_click last_click_days_ago count_view last_view_days_ago"
).split()


def raw_profile(spark: SparkSession, folder: str) -> DataFrame:
    return finish(q.profile(_with_gaps(table(spark, folder, "events"))))


def _with_gaps(events: DataFrame) -> DataFrame:
    """A third of the values NaN, a fifth of the types null."""
    return events.withColumn("value", F.when(F.col("event_id") % 3 == 0, F.lit(float("nan"))).otherwise(F.col("value"))).withColumn(
        "event_type", F.when(F.col("event_id") % 5 != 0, F.col("event_type"))
    )


def duplicate_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Whole rows of the conversations, a third of them twice and a ninth three times."""
    rows = table(spark, folder, "conversations")
    twice, thrice = rows.where("conv_id % 3 = 0"), rows.where("conv_id % 9 = 0")
    return finish(q.duplicate_rows(rows.unionByName(twice).unionByName(thrice)))


def duplicate_keys(spark: SparkSession, folder: str) -> DataFrame:
    return finish(q.duplicate_keys(order_log(spark, folder)))


def missing_values(spark: SparkSession, folder: str) -> DataFrame:
    """Every third country and every fourth revenue is missing."""
    people = customers(spark, folder).select(*NULLABLE_COLUMNS)
    people = people.withColumn("country", F.when(F.col("customer_id") % 3 != 0, F.col("country")))
    people = people.withColumn("monthly_revenue", F.when(F.col("customer_id") % 4 != 0, F.col("monthly_revenue")))
    return finish(q.missing_values(people, 30.0))


def value_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """All numeric columns, with infinite, extreme and NaN revenues placed among them."""
    odd = q.value_ranges(_with_extremes(order_features(spark, folder))).drop("minimum", "maximum")
    plain = q.value_ranges(order_features(spark, folder)).select("column", "minimum", "maximum")
    # Deviations near 1e10 agree to fewer decimals than other numbers.
    return finish(odd.withColumn("std", F.round("std", 2))).join(finish(plain), "column")


def _with_extremes(df: DataFrame) -> DataFrame:
    key, inf = F.col("customer_id"), F.lit(float("inf"))
    odd = F.when(key % 11 == 0, inf).when(key % 13 == 0, -inf).when(key % 17 == 0, F.lit(float("nan")))
    odd = odd.when(key % 19 == 0, F.lit(2e10)).when(key % 23 == 0, F.lit(-2e10))
    return df.withColumn("total_revenue", odd.otherwise(F.col("total_revenue")))


def label_check(spark: SparkSession, folder: str) -> DataFrame:
    return finish(q.label_distribution(order_features(spark, folder)))


def leakage_correlation(spark: SparkSession, folder: str) -> DataFrame:
    return finish(q.label_correlations(order_features(spark, folder)))


def constraint_violations(spark: SparkSession, folder: str) -> DataFrame:
    """Broken keys, missing values and unknown customers, placed by number."""
    people, log = customers(spark, folder), activity_log(spark, folder)
    people = people.unionByName(people.where("customer_id % 10 = 0"))
    people = people.unionByName(people.where("customer_id % 25 = 1").withColumn("customer_id", F.lit(None).cast("bigint")))
    key = F.col("event_id")
    log = log.withColumn("event_type", F.when(key % 9 != 0, F.col("event_type"))).withColumn(
        "customer_id", F.when(key % 50 == 0, F.col("customer_id") + 10_000_000).when(key % 50 != 1, F.col("customer_id"))
    )
    log = log.withColumn("event_id", F.when(key % 40 == 0, F.col("event_id") + 1).when(key % 40 != 2, F.col("event_id")))
    return finish(q.constraint_violations(people, log))


def orphan_events(spark: SparkSession, folder: str) -> DataFrame:
    """Order events of customers that are missing from the activity log's users."""
    users = table(spark, folder, "events").select(F.col("user_id").alias("customer_id")).distinct()
    return finish(q.orphan_events(users, order_log(spark, folder)).select("event_id", "customer_id"))


def validation_findings(spark: SparkSession, folder: str) -> DataFrame:
    # Several checks read the table, so it is computed once.
    return finish(q.validation_findings(materialise(order_features(spark, folder)), min_per_class=1000))


def constant_features(spark: SparkSession, folder: str) -> DataFrame:
    return finish(q.constant_features(materialise(order_features(spark, folder))))


def correlated_features(spark: SparkSession, folder: str) -> DataFrame:
    """With one column missing for two thirds of the rows and another always."""
    features = activity_features(spark, folder)
    features = features.withColumn("total_revenue", F.when(F.col("customer_id") % 3 == 0, F.col("total_revenue")))
    return finish(q.correlated_features(features.withColumn("last_click_days_ago", F.lit(None).cast("double"))))


def pair_correlations(spark: SparkSession, folder: str) -> DataFrame:
    """All pairs of the same columns, as rounded as they are in SQL, with the rows that have both."""
    features = finish(activity_features(spark, folder))
    features = features.withColumn("total_revenue", F.when(F.col("customer_id") % 3 == 0, F.col("total_revenue")))
    return finish(q.pair_correlations(features.withColumn("last_click_days_ago", F.lit(None).cast("double"))))


def align_schema(spark: SparkSession, folder: str) -> DataFrame:
    features = order_features(spark, folder)
    return finish(align_columns(features, ["customer_id", *EXPECTED_COLUMNS]))


QUERIES = {
    "raw_profile": raw_profile,
    "duplicate_rows": duplicate_rows,
    "duplicate_keys": duplicate_keys,
    "missing_values": missing_values,
    "value_ranges": value_ranges,
    "label_check": label_check,
    "leakage_correlation": leakage_correlation,
    "constraint_violations": constraint_violations,
    "orphan_events": orphan_events,
    "validation_findings": validation_findings,
    "constant_features": constant_features,
    "correlated_features": correlated_features,
    "pair_correlations": pair_correlations,
    "align_schema": align_schema,
}


def _union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


def _profile_part(column: str, data_type: str) -> str:
    return (
        f"SELECT '{column}' AS \"column\", '{data_type}' AS data_type, count(*) AS n_rows, "
        f"count(*) - count({column}) AS n_missing, "
        f"{rounded(f'(count(*) - count({column})) * 100.0 / count(*)', 'missing_pct')} FROM gaps"
    )


def _missing_part(column: str) -> str:
    pct = f"CAST((count(*) - count({column})) * 100 AS DOUBLE) / count(*)"
    return (
        f"SELECT '{column}' AS \"column\", count(*) - count({column}) AS n_missing, "
        f"{rounded(pct, 'missing_pct')}, {pct} > 30.0 AS failed FROM gaps"
    )


def _range_part(c: str) -> str:
    return (
        f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE isinf(CAST(x.{c} AS DOUBLE))) AS n_infinite, "
        f"count(*) FILTER (WHERE x.{c} > 1e10) AS n_high, count(*) FILTER (WHERE x.{c} < -1e10) AS n_low, "
        f"{rounded(f'min(ft.{c})', 'minimum')}, {rounded(f'max(ft.{c})', 'maximum')}, "
        f"{rounded(f'avg(x.{c}) FILTER (WHERE isfinite(CAST(x.{c} AS DOUBLE)))', 'mean')}, "
        f"round(CAST(stddev_samp(x.{c}) FILTER (WHERE isfinite(CAST(x.{c} AS DOUBLE))) AS DOUBLE), 2) AS std "
        "FROM ft JOIN x USING (customer_id)"
    )


def _order_numeric() -> list[str]:
    renamed = {"purchase": "1_urgent", "click": "2_high", "view": "5_low"}
    out = []
    for name in NUMERIC:
        for old, new in renamed.items():
            name = name.replace(old, new)
        out.append(name)
    return out


def _corr(x: str, y: str) -> str:
    return f"CASE WHEN stddev_pop({x}) > 0 AND stddev_pop({y}) > 0 THEN corr({x}, {y}) END"


def _leak_part(c: str) -> str:
    return (
        f"SELECT '{c}' AS \"column\", {rounded(_corr(c, 'label'), 'correlation')}, "
        f"coalesce(abs({_corr(c, 'label')}) > 0.95, false) AS suspect FROM ft"
    )


def _share_part(c: str) -> str:
    return (
        f"SELECT '{c}' AS \"column\", max(n) / CAST(sum(n) AS DOUBLE) AS share "
        f"FROM (SELECT {c}, count(*) AS n FROM ft GROUP BY {c})"
    )


def _pair_parts() -> list[str]:
    return [
        f"SELECT '{a}' AS kept, '{b}' AS dropped, {_corr(a, b)} AS r, count({a} + {b}) AS n_rows FROM ft"
        for i, a in enumerate(NUMERIC)
        for b in NUMERIC[i + 1 :]
    ]


def _violation(table_name: str, column: str, rule: str, count: str, source: str) -> str:
    return (
        f"SELECT '{table_name}' AS \"table\", '{column}' AS \"column\", '{rule}' AS rule, "
        f"CAST({count} AS BIGINT) AS violations FROM {source}"
    )


# The features with one column missing for two thirds of the rows and another always.
HOLES_SQL = f"""{ACTIVITY_FEATURES_SQL.replace("ft AS (", "ft0 AS (")}, ft AS (
  SELECT * REPLACE (CASE WHEN customer_id % 3 = 0 THEN total_revenue END AS total_revenue,
                    CAST(NULL AS DOUBLE) AS last_click_days_ago) FROM ft0)"""

SQL = {
    "raw_profile": """WITH gaps AS (
  SELECT * REPLACE (CASE WHEN event_id % 3 <> 0 THEN value END AS value,
                    CASE WHEN event_id % 5 <> 0 THEN event_type END AS event_type) FROM events) """
    + _union([_profile_part(c, t) for c, t in EVENT_COLUMNS.items()]),
    "duplicate_rows": f"""WITH c AS (
  SELECT * FROM conversations UNION ALL SELECT * FROM conversations WHERE conv_id % 3 = 0
  UNION ALL SELECT * FROM conversations WHERE conv_id % 9 = 0)
SELECT count(*) AS n_rows, count(*) - count(DISTINCT (conv_id, turn, role, text)) AS duplicate_rows,
{rounded("CAST((count(*) - count(DISTINCT (conv_id, turn, role, text))) * 100 AS DOUBLE) / count(*)", "duplicate_pct")}
FROM c""",
    "duplicate_keys": """SELECT o_custkey AS customer_id, count(*) - 1 AS extra_rows
FROM orders GROUP BY o_custkey HAVING count(*) > 1""",
    "missing_values": f"WITH {CUSTOMERS_SQL}, gaps AS (SELECT * REPLACE ("
    "CASE WHEN customer_id % 3 <> 0 THEN country END AS country, "
    f"CASE WHEN customer_id % 4 <> 0 THEN monthly_revenue END AS monthly_revenue) FROM cu) {_union([_missing_part(c) for c in NULLABLE_COLUMNS])}",
    "value_ranges": f"""{ORDER_FEATURES_SQL}, x AS (SELECT * REPLACE (
  CASE WHEN customer_id % 11 = 0 THEN CAST('infinity' AS DOUBLE) WHEN customer_id % 13 = 0 THEN CAST('-infinity' AS DOUBLE)
       WHEN customer_id % 17 = 0 THEN NULL WHEN customer_id % 19 = 0 THEN 2e10 WHEN customer_id % 23 = 0 THEN -2e10
       ELSE total_revenue END AS total_revenue) FROM ft) {_union([_range_part(c) for c in _order_numeric()])}""",
    "label_check": f"""{ORDER_FEATURES_SQL}
SELECT label, count(*) AS n_rows, {rounded("count(*) * 100.0 / sum(count(*)) OVER ()", "share_pct")},
       label IN (0, 1) AS valid FROM ft GROUP BY label""",
    "leakage_correlation": f"{ORDER_FEATURES_SQL} {_union([_leak_part(c) for c in _order_numeric()])}",
    "constraint_violations": f"""WITH {ACTIVITY_LOG_SQL}, {CUSTOMERS_SQL},
c2 AS (SELECT * FROM cu UNION ALL SELECT * FROM cu WHERE customer_id % 10 = 0),
cx AS (SELECT * FROM c2 UNION ALL SELECT * REPLACE (NULL AS customer_id) FROM c2 WHERE customer_id % 25 = 1),
ex AS (
  SELECT * REPLACE (
    CASE WHEN event_id % 9 <> 0 THEN event_type END AS event_type,
    CASE WHEN event_id % 50 = 0 THEN customer_id + 10000000 WHEN event_id % 50 <> 1 THEN customer_id END AS customer_id,
    CASE WHEN event_id % 40 = 0 THEN event_id + 1 WHEN event_id % 40 <> 2 THEN event_id END AS event_id) FROM ev) """
    + _union(
        [
            _violation("customers", "customer_id", "unique", "count(customer_id) - count(DISTINCT customer_id)", "cx"),
            *[
                _violation("customers", c, "not_null", f"count(*) - count({c})", "cx")
                for c in ("customer_id", "signup_date")
            ],
            _violation("events", "event_id", "unique", "count(event_id) - count(DISTINCT event_id)", "ex"),
            *[
                _violation("events", c, "not_null", f"count(*) - count({c})", "ex")
                for c in ("event_id", "customer_id", "event_type", "event_timestamp")
            ],
            _violation(
                "events",
                "customer_id",
                "references_customers",
                "count(*)",
                "ex WHERE customer_id NOT IN (SELECT customer_id FROM cu)",
            ),
        ]
    ),
    "orphan_events": """SELECT o_orderkey AS event_id, o_custkey AS customer_id FROM orders
WHERE NOT EXISTS (SELECT 1 FROM events WHERE user_id = o_custkey)""",
    "validation_findings": f"""{ORDER_FEATURES_SQL},
lc AS (SELECT count(*) FILTER (WHERE label = 0) AS c0, count(*) FILTER (WHERE label = 1) AS c1 FROM ft),
lk AS ({_union([_leak_part(c) for c in _order_numeric()])})
SELECT 'small_class' AS "check", 'label' AS "column", CAST(least(c0, c1) AS DOUBLE) AS value, 'error' AS severity
FROM lc WHERE least(c0, c1) BETWEEN 1 AND 999
UNION ALL SELECT 'label_correlation', "column", correlation, 'warning' FROM lk WHERE suspect""",
    "constant_features": f"""{ORDER_FEATURES_SQL}, sh AS ({_union([_share_part(c) for c in _order_numeric()])})
SELECT "column", {rounded("share", "top_share")} FROM sh WHERE share > 0.9""",
    "correlated_features": f"""{HOLES_SQL},
pr AS ({_union(_pair_parts())})
SELECT kept, dropped, {rounded("r", "correlation")} FROM pr WHERE abs(r) > 0.95""",
    "pair_correlations": f"""{HOLES_SQL},
pr AS ({_union(_pair_parts())})
SELECT kept, dropped, n_rows, {rounded("r", "correlation")} FROM pr""",
    "align_schema": f"""{ORDER_FEATURES_SQL}
SELECT customer_id, {', '.join(f'CAST(0 AS DOUBLE) AS {c}' if c in FOREIGN_COLUMNS else c
                               for c in EXPECTED_COLUMNS)} FROM ft""",
}
