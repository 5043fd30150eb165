"""Data-quality checks as small result tables, each from one or two passes."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.functions.expressions import is_missing, numeric_columns, present_double, safe_ratio, text_columns
from ebbtide.session import materialise

# Fixed limits of the checks.
MAX_MISSING_PCT = 50.0
EXTREME = 1e10
MIN_PER_CLASS = 10
MAX_LABEL_CORRELATION = 0.95
MAX_TOP_SHARE = 0.9
MAX_PAIR_CORRELATION = 0.95
LISTED_KEYS = 10
# Pairs of columns summed in one pass.

FINDINGS = T.StructType(
    [
        T.StructField("check", T.StringType()),
        T.StructField("column", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("severity", T.StringType()),
    ]
)

RANGES = (
    "column string, n_infinite bigint, n_high bigint, n_low bigint, minimum double, maximum double, mean double, "
    "std double"
)


class ValidationError(Exception):
    """A strict validation found an error."""


def _rows_per_column(aggregated: DataFrame, fields: dict[str, dict[str, Column]]) -> DataFrame:
    """Turn one aggregate row into one row per column name."""
    rows = [
        F.struct(F.lit(name).alias("column"), *[expr.alias(k) for k, expr in exprs.items()])
        for name, exprs in fields.items()
    ]
    return aggregated.select(F.inline(F.array(*rows)))


def profile(df: DataFrame) -> DataFrame:
    """Column name, type, row count, missing values and their share."""
    names = df.columns
    one = df.agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(is_missing(df, c)).alias(f"m{i}") for i, c in enumerate(names)]
    )
    return _rows_per_column(
        one,
        {
            c: {
                "data_type": F.lit(df.schema[c].dataType.simpleString()),
                "n_rows": F.col("n"),
                "n_missing": F.col(f"m{i}"),
                "missing_pct": safe_ratio(F.col(f"m{i}") * 100, F.col("n")),
            }
            for i, c in enumerate(names)
        },
    )


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each identical full row, and their share.

    Only a hash of each row is shuffled at first; whole rows are compared where a hash repeats, so the
    count is exact and unique rows never leave their task.
    """
    hashed = df.withColumn("_hash", F.xxhash64(*df.columns))
    copies = hashed.groupBy("_hash").agg(F.count(F.lit(1)).alias("_copies"))
    repeated = materialise(copies.filter(F.col("_copies") > 1).select("_hash"))
    groups = (
        hashed.join(repeated, "_hash", "left_semi")
        .groupBy(*df.columns)
        .agg((F.count(F.lit(1)) - 1).alias("_extra"))
    )
    rows = df.agg(F.count(F.lit(1))).scalar()
    return (
        groups.agg(F.coalesce(F.sum("_extra"), F.lit(0)).alias("duplicate_rows"))
        .select(rows.alias("n_rows"), "duplicate_rows")
        .withColumn("duplicate_pct", safe_ratio(F.col("duplicate_rows") * 100, F.col("n_rows")))
    )


def duplicate_keys(df: DataFrame, key: str = "customer_id") -> DataFrame:
    """Keys that occur more than once, with the number of rows beyond the first."""
    return (
        df.groupBy(key)
        .agg((F.count(F.lit(1)) - 1).alias("extra_rows"))
        .filter(F.col("extra_rows") > 0)
    )


def missing_values(df: DataFrame, max_missing_pct: float = MAX_MISSING_PCT) -> DataFrame:
    """Missing share per column; ``failed`` marks shares above the limit."""
    return profile(df).select(
        "column", "n_missing", "missing_pct", (F.col("missing_pct") > max_missing_pct).alias("failed")
    )


def value_ranges(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Infinite and extreme values per numeric column with min, max, mean and standard deviation."""
    columns = list(columns) if columns is not None else numeric_columns(df)
    if not columns:
        return df.sparkSession.createDataFrame([], RANGES)
    aggregates = []
    for i, c in enumerate(columns):
        x = present_double(df, c)
        finite = F.when(F.abs(x) < F.lit(math.inf), x)
        aggregates += [
            F.count_if(F.abs(x) == F.lit(math.inf)).alias(f"inf{i}"),
            F.count_if(x > EXTREME).alias(f"high{i}"),
            F.count_if(x < -EXTREME).alias(f"low{i}"),
            F.min(x).alias(f"min{i}"),
            F.max(x).alias(f"max{i}"),
            F.avg(finite).alias(f"mean{i}"),
            F.stddev_samp(finite).alias(f"std{i}"),
        ]
    measured = {"n_infinite": "inf", "n_high": "high", "n_low": "low", "minimum": "min", "maximum": "max",
                "mean": "mean", "std": "std"}
    return _rows_per_column(
        df.agg(*aggregates),
        {c: {k: F.col(f"{v}{i}") for k, v in measured.items()} for i, c in enumerate(columns)},
    )


def label_distribution(df: DataFrame, label_col: str = "label") -> DataFrame:
    """Row count and share per label value; values other than 0 and 1 (null included) are invalid."""
    if label_col not in df.columns:
        raise ValidationError(f"label column {label_col!r} not found")
    counts = materialise(df.groupBy(F.col(label_col).alias("label")).agg(F.count(F.lit(1)).alias("n_rows")))
    total = counts.agg(F.sum("n_rows")).scalar()
    return counts.select(
        "label",
        "n_rows",
        safe_ratio(F.col("n_rows") * 100, total).alias("share_pct"),
        F.coalesce(F.col("label").isin(0, 1), F.lit(False)).alias("valid"),
    )


def _finite(x: Column) -> Column:
    return F.when(F.abs(x) < F.lit(math.inf), x)


def correlation(x: Column, y: Column) -> Column:
    """Pearson correlation over rows where both are present; null where it is undefined."""
    a, b = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    r = F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))
    return F.nanvl(r, F.lit(None).cast("double"))


def label_correlations(df: DataFrame, label_col: str = "label", first: int | None = None) -> DataFrame:
    """Correlation of every numeric column with the label and the leakage flag; ``first`` looks at fewer on request."""
    columns = numeric_columns(df, exclude=("customer_id", label_col))[:first]
    if not columns:
        return df.sparkSession.createDataFrame([], "column string, correlation double, suspect boolean")
    y = present_double(df, label_col)
    one = df.agg(*[correlation(present_double(df, c), y).alias(f"r{i}") for i, c in enumerate(columns)])
    return _rows_per_column(
        one,
        {
            c: {
                "correlation": F.col(f"r{i}"),
                "suspect": F.coalesce(F.abs(f"r{i}") > MAX_LABEL_CORRELATION, F.lit(False)),
            }
            for i, c in enumerate(columns)
        },
    )


def constraint_violations(customers: DataFrame, events: DataFrame) -> DataFrame:
    """Broken rules of the base tables: unique keys, required values, events without a customer."""

    def broken(df: DataFrame, rules: Sequence[tuple[str, str, str, Column]]) -> DataFrame:
        one = df.agg(*[F.coalesce(count.cast("bigint"), F.lit(0)).alias(f"v{i}") for i, (*_, count) in enumerate(rules)])
        rows = [
            F.struct(*[F.lit(x).alias(n) for n, x in zip(("table", "column", "rule"), rule)], F.col(f"v{i}").alias("violations"))
            for i, (*rule, _) in enumerate(rules)
        ]
        return one.select(F.inline(F.array(*rows)))

    def empty(column: str) -> Column:
        return F.count_if(F.col(column).isNull())

    def repeats(column: str) -> Column:
        return F.sum(F.when(F.col(column).isNotNull(), F.col("n") - 1))

    # Rows collapse to their keys first, so one pass over each table counts everything that a key decides, and a busy
    # unknown customer is one row in the join.
    of_customers = customers.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"), empty("signup_date").alias("e"))
    people = [
        ("customers", "customer_id", "unique", repeats("customer_id")),
        ("customers", "customer_id", "not_null", F.sum(F.when(F.col("customer_id").isNull(), F.col("n")))),
        ("customers", "signup_date", "not_null", F.sum("e")),
    ]
    event_ids = events.groupBy("event_id").agg(F.count(F.lit(1)).alias("n"))
    ids = [
        ("events", "event_id", "unique", repeats("event_id")),
        ("events", "event_id", "not_null", F.sum(F.when(F.col("event_id").isNull(), F.col("n")))),
    ]
    of_events = events.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("n"), empty("event_type").alias("types"), empty("event_timestamp").alias("stamps")
    )
    known = customers.select(F.col("customer_id").alias("known")).distinct()
    matched = of_events.join(known, F.col("customer_id") == F.col("known"), "left")
    unknown = F.col("customer_id").isNotNull() & F.col("known").isNull()
    log = [
        ("events", "customer_id", "not_null", F.sum(F.when(F.col("customer_id").isNull(), F.col("n")))),
        ("events", "event_type", "not_null", F.sum("types")),
        ("events", "event_timestamp", "not_null", F.sum("stamps")),
        ("events", "customer_id", "references_customers", F.sum(F.when(unknown, F.col("n")))),
    ]
    return broken(of_customers, people).unionByName(broken(event_ids, ids)).unionByName(broken(matched, log))


def orphan_events(customers: DataFrame, events: DataFrame) -> DataFrame:
    """Events whose customer is unknown.

    The unknown ids are found among the distinct ids, so the log itself is joined with few rows.
    """
    ids = events.select("customer_id").filter(F.col("customer_id").isNotNull()).distinct()
    unknown = materialise(ids.join(customers.select("customer_id"), "customer_id", "left_anti"))
    return events.join(unknown, "customer_id", "left_semi")


def validation_findings(
    df: DataFrame,
    max_missing_pct: float = MAX_MISSING_PCT,
    min_per_class: int = MIN_PER_CLASS,
    label_col: str = "label",
) -> DataFrame:
    """Everything the checks object to, one row each: ``check, column, value, severity``.

    Missing, infinite and extreme values and the labels are counted in one pass; repeated keys and
    label correlations take one more each.
    """
    if "customer_id" not in df.columns:
        return df.sparkSession.createDataFrame([("required_column", "customer_id", None, "error")], FINDINGS)

    def finding(check: str, column: str, value: Column, bad: Column, severity: str = "error") -> Column:
        return F.struct(
            F.lit(check).alias("check"),
            F.lit(column).alias("column"),
            F.when(bad, value.cast("double")).alias("value"),
            F.lit(severity).alias("severity"),
        )

    aggregates, findings = [F.count(F.lit(1)).alias("n")], []
    for i, c in enumerate(df.columns):
        aggregates.append(F.count_if(is_missing(df, c)).alias(f"m{i}"))
        pct = safe_ratio(F.col(f"m{i}") * 100, F.col("n"))
        findings.append(finding("missing_values", c, pct, pct > max_missing_pct))
    for i, c in enumerate(numeric_columns(df, ("customer_id", label_col))):
        # Plain comparisons keep the generated code small; NaN is above infinity and counts as missing.
        size = F.abs(F.col(c).cast("double"))
        aggregates += [
            F.count_if(size == F.lit(math.inf)).alias(f"inf{i}"),
            F.count_if((size > EXTREME) & (size < F.lit(math.inf))).alias(f"far{i}"),
        ]
        for check, count in (("infinite_values", F.col(f"inf{i}")), ("extreme_values", F.col(f"far{i}"))):
            findings.append(finding(check, c, count, count > 0))
    if label_col in df.columns:
        y = F.col(label_col)
        aggregates += [
            F.count_if(~F.coalesce(y.isin(0, 1), F.lit(False))).alias("invalid"),
            F.count_if(y == 0).alias("class_0"),
            F.count_if(y == 1).alias("class_1"),
        ]
        small = F.least("class_0", "class_1")
        findings += [
            finding("invalid_labels", label_col, F.col("invalid"), F.col("invalid") > 0),
            finding("single_class", label_col, small, small == 0),
            finding("small_class", label_col, small, (small > 0) & (small < min_per_class)),
        ]
    repeated = duplicate_keys(df).agg(F.coalesce(F.sum("extra_rows"), F.lit(0)).alias("extra"))
    extra = F.col("extra")
    out = (
        df.agg(*aggregates)
        .select(F.inline(F.array(*findings)))
        .unionByName(
            repeated.select(F.inline(F.array(finding("duplicate_keys", "customer_id", extra, extra > 0))))
        )
        .filter(F.col("value").isNotNull())
    )
    if label_col in df.columns:
        suspects = label_correlations(df, label_col).filter("suspect")
        out = out.unionByName(
            suspects.select(
                F.lit("label_correlation").alias("check"),
                "column",
                F.col("correlation").alias("value"),
                F.lit("warning").alias("severity"),
            )
        )
    return out


def validate_features(df: DataFrame, strict: bool = True, listed_keys: int = LISTED_KEYS, **limits) -> bool:
    """True when no error is found; a strict validation raises with the findings instead of returning False."""
    errors = validation_findings(df, **limits).filter("severity = 'error'").collect()
    if not errors:
        return True
    if strict:
        listed = "; ".join(f"{e['check']}({e['column']}) = {e['value']}" for e in errors)
        if any(e["check"] == "duplicate_keys" for e in errors):
            keys = [str(r[0]) for r in duplicate_keys(df).orderBy("customer_id").limit(listed_keys).collect()]
            listed += f"; repeated ids: {', '.join(keys)}"
        raise ValidationError(listed)
    return False


# --- feature selection ------------------------------------------------------------------------


def dominant_share(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Share of the median value per numeric column, over all rows.

    A value held by clearly more than half of the rows is the (sketched) median, so the share decides
    whether one value dominates, without counting every distinct value.
    """
    columns = list(columns) if columns is not None else numeric_columns(df)
    if not columns:
        return df.sparkSession.createDataFrame([], "column string, top_share double")
    middle = df.agg(
        *[F.percentile_approx(present_double(df, c), 0.5, 1000).alias(f"p{i}") for i, c in enumerate(columns)]
    ).first()
    one = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(present_double(df, c) == F.lit(middle[f"p{i}"])).alias(f"h{i}") for i, c in enumerate(columns)],
        *[F.count_if(is_missing(df, c)).alias(f"m{i}") for i, c in enumerate(columns)],
    )
    share = {
        c: {"top_share": safe_ratio(F.greatest(f"h{i}", f"m{i}"), F.col("n"))} for i, c in enumerate(columns)
    }
    return _rows_per_column(one, share)


def top_shares(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Share of the most frequent value (missing is one) per column of any kind, counted value by value.

    Repeated values collapse before they move; the counts of a column are pre-aggregated again to their largest.
    """
    cells = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns])
    )
    counts = df.select(cells.alias("cell")).groupBy("cell.column", "cell.value").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("column").agg(safe_ratio(F.max("n"), F.sum("n")).alias("top_share"))


def constant_features(df: DataFrame, max_share: float = MAX_TOP_SHARE, exclude: Sequence[str] = ("customer_id",)) -> DataFrame:
    """Numeric and text columns where one value (or missing) fills more than the allowed share of rows."""
    text = text_columns(df, exclude)
    # Below this limit a value may exceed it without being the median.
    found = dominant_share(df) if max_share >= 0.6 else top_shares(df, numeric_columns(df))
    if text:
        found = found.unionByName(top_shares(df, text))
    return found.filter(F.col("top_share") > max_share)


def pair_correlations(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``kept, dropped, n_rows, correlation`` of every pair of numeric columns in their order.

    A missing value leaves its row out for the pairs of its column only; infinite values count as missing.  A pair without
    variance in one of its columns (as far as doubles can tell) has a null correlation.

    Two scans whatever the number of columns: one for the means, one in which every task multiplies blocks of centred rows
    and of their masks to the sums of all pairs.  Pairs are then added up and judged on executors.
    """
    columns = list(columns) if columns is not None else numeric_columns(df)
    if len(columns) < 2:
        return df.sparkSession.createDataFrame([], "kept string, dropped string, n_rows long, correlation double")
    values = df.select(*[_finite(present_double(df, c)).alias(f"c{i}") for i, c in enumerate(columns)])
    # One number per column.
    means = [m or 0.0 for m in values.agg(*[F.avg(f"c{i}") for i in range(len(columns))]).first()]

    def pair_sums(batches):
        # Local, so that it travels with the plan and executors need only numpy and Arrow.
        import numpy as np
        import pyarrow as pa

        centre, size = np.array(means), len(means)
        total = np.zeros((4, size, size))
        for batch in batches:
            rows = np.stack([c.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False) for c in batch.columns], 1)
            there = ~np.isnan(rows)
            mask, x = there.astype(float), np.where(there, rows - centre, 0.0)
            total[0] += mask.T @ mask
            total[1] += x.T @ mask
            total[2] += (x * x).T @ mask
            total[3] += x.T @ x
        i, j = np.triu_indices(size, 1)
        sums = [total[0][i, j], total[1][i, j], total[1][j, i], total[2][i, j], total[2][j, i], total[3][i, j]]
        names = ["i", "j", "n", "sx", "sy", "sxx", "syy", "sxy"]
        kinds = [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), *map(pa.array, sums)]
        yield pa.RecordBatch.from_arrays(kinds, names)

    schema = "i int, j int, n double, sx double, sy double, sxx double, syy double, sxy double"
    sums = values.mapInArrow(pair_sums, schema).groupBy("i", "j").agg(
        *[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")]
    )
    n = F.col("n")
    names, centres = F.array(*[F.lit(c) for c in columns]), F.array(*[F.lit(float(m)) for m in means])

    def variance(s: str, ss: str, at: str):
        found = F.col(ss) - F.try_divide(F.col(s) * F.col(s), n)
        # What rounding leaves of a column without variance.
        noise = F.greatest(F.col(ss) * 1e-13, n * F.pow(F.get(centres, F.col(at)) * 1e-14, F.lit(2)))
        return F.when(found > noise, found)

    r = (F.col("sxy") - F.try_divide(F.col("sx") * F.col("sy"), n)) / F.sqrt(
        variance("sx", "sxx", "i") * variance("sy", "syy", "j")
    )
    return sums.select(
        F.get(names, F.col("i")).alias("kept"),
        F.get(names, F.col("j")).alias("dropped"),
        n.cast("long").alias("n_rows"),
        # Rounding leads a little beyond 1; the bounds alone would pass over a null.
        F.when(r.isNotNull(), F.greatest(F.least(r, F.lit(1.0)), F.lit(-1.0))).alias("correlation"),
    )


def correlated_features(
    df: DataFrame, max_correlation: float = MAX_PAIR_CORRELATION, columns: Sequence[str] | None = None
) -> DataFrame:
    """Pairs of numeric columns above the limit; the later column of a pair is the one to drop."""
    pairs = pair_correlations(df, columns)
    return pairs.where(F.abs("correlation") > max_correlation).select("kept", "dropped", "correlation")


def select_features(
    df: DataFrame, max_share: float = MAX_TOP_SHARE, max_correlation: float = MAX_PAIR_CORRELATION
) -> list[str]:
    """Numeric columns left after dropping near-constant ones, then the later one of each correlated pair."""
    constant = {r["column"] for r in constant_features(df, max_share).collect()}
    kept = [c for c in numeric_columns(df) if c not in constant]
    if len(kept) > 1:
        pairs = correlated_features(df, max_correlation, kept).collect()
        dropped: set[str] = set()
        for c in kept:
            if c not in dropped:
                dropped |= {r["dropped"] for r in pairs if r["kept"] == c}
        kept = [c for c in kept if c not in dropped]
    return kept
