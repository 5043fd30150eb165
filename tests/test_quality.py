import pytest
from pyspark.sql import functions as F

from ebbtide.operators import quality as q
from tests.test_features import at, make_customers, make_events


def bad_frame(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, i % 2, float(i % 2), 1.0, nan if i < 15 else 1.0, 0.5) for i in range(24)]
    df = spark.createDataFrame(rows, "customer_id long, label int, copy double, fixed double, holes double, odd double")
    return df.withColumn(
        "odd", F.when(F.col("customer_id") == 3, inf).when(F.col("customer_id") == 4, 1e11).otherwise(F.col("odd"))
    )


def findings(df, **limits):
    return {(r["check"], r["column"]): r["value"] for r in q.validation_findings(df, **limits).collect()}


def test_profile_counts_nan_as_missing(spark):
    rows = {r["column"]: r for r in q.profile(bad_frame(spark)).collect()}
    assert rows["holes"]["n_missing"] == 15 and rows["holes"]["missing_pct"] == pytest.approx(62.5)
    assert rows["label"]["data_type"] == "int" and rows["label"]["n_rows"] == 24


def test_duplicate_rows_and_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, None), (2, None), (3, "c")], "customer_id int, x string")
    row = q.duplicate_rows(df).first()
    assert (row["n_rows"], row["duplicate_rows"]) == (6, 2) and row["duplicate_pct"] == pytest.approx(200 / 6)
    assert {r["customer_id"]: r["extra_rows"] for r in q.duplicate_keys(df).collect()} == {1: 2, 2: 1}
    assert q.duplicate_rows(df.limit(0)).first()["duplicate_rows"] == 0
    hot = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("x"))
    assert q.duplicate_rows(hot).first()["duplicate_rows"] == 9_999


def test_findings_of_a_bad_table(spark):
    found = findings(bad_frame(spark))
    assert found == {
        ("missing_values", "holes"): pytest.approx(62.5),
        ("infinite_values", "odd"): 1.0,
        ("extreme_values", "odd"): 1.0,
        ("label_correlation", "copy"): pytest.approx(1.0),
    }


def test_missing_limit_is_strict(spark):
    df = spark.createDataFrame([(1, None), (2, 1.0)], "customer_id int, x double")
    assert findings(df) == {}
    assert findings(df, max_missing_pct=49.9) == {("missing_values", "x"): 50.0}


def test_label_findings(spark):
    base = spark.range(30).select(F.col("id").alias("customer_id"), (F.col("id") % 2).cast("int").alias("label"))
    assert findings(base) == {}
    odd = base.withColumn("label", F.expr("CASE WHEN customer_id = 0 THEN 2 WHEN customer_id = 1 THEN NULL ELSE label END"))
    assert findings(odd) == {("invalid_labels", "label"): 2.0}
    assert findings(base.withColumn("label", F.lit(1))) == {("single_class", "label"): 0.0}
    assert findings(base.withColumn("label", (F.col("customer_id") < 9).cast("int"))) == {("small_class", "label"): 9.0}
    rows = {r["label"]: r for r in q.label_distribution(odd).collect()}
    assert rows[2]["valid"] is False and rows[None]["valid"] is False and rows[1]["share_pct"] == pytest.approx(1400 / 30)
    with pytest.raises(q.ValidationError):
        q.label_distribution(base.drop("label"))


def test_strict_and_lenient_validation(spark):
    good = spark.range(30).select(F.col("id").alias("customer_id"), (F.col("id") % 2).cast("int").alias("label"))
    assert q.validate_features(good) is True
    twice = good.unionByName(good.limit(3))
    assert q.validate_features(twice, strict=False) is False
    with pytest.raises(q.ValidationError, match="duplicate_keys.*repeated ids"):
        q.validate_features(twice)
    assert q.validate_features(good.drop("customer_id"), strict=False) is False
    # A suspicious correlation is only a warning.
    assert q.validate_features(good.withColumn("copy", F.col("label"))) is True


def test_constant_column_has_no_correlation(spark):
    rows = {r["column"]: r for r in q.label_correlations(bad_frame(spark)).collect()}
    assert rows["fixed"]["correlation"] is None and rows["fixed"]["suspect"] is False


def test_constraints(spark):
    customers = make_customers(spark, ["a", "b", "b"], signup=None)
    events = make_events(spark, [("a", "login", at(1), 1), ("x", "login", at(1), 1), ("x", "login", at(2), 1)])
    events = events.unionByName(events.filter("event_id = 0"))
    found = {
        (r["table"], r["column"], r["rule"]): r["violations"]
        for r in q.constraint_violations(customers, events).collect()
        if r["violations"]
    }
    assert found == {
        ("customers", "customer_id", "unique"): 1,
        ("customers", "signup_date", "not_null"): 3,
        ("events", "event_id", "unique"): 1,
        ("events", "customer_id", "references_customers"): 2,
    }
    assert {r["event_id"] for r in q.orphan_events(customers, events).collect()} == {1, 2}


def test_feature_selection(spark):
    df = spark.range(100).select(
        F.col("id").alias("customer_id"),
        (F.col("id") % 2).cast("int").alias("label"),
        F.when(F.col("id") < 91, 7).otherwise(F.col("id")).alias("mostly"),
        F.when(F.col("id") < 90, 7).otherwise(F.col("id")).alias("at_limit"),
        F.when(F.col("id") < 95, F.lit(None)).otherwise(F.col("id")).alias("empty"),
        F.col("id").cast("double").alias("x"),
        (F.col("id") * 2 + 1).alias("twice"),
        F.sin(F.col("id") * 1.7).alias("wave"),
    )
    assert {r["column"] for r in q.constant_features(df).collect()} == {"mostly", "empty"}
    pairs = {(r["kept"], r["dropped"]) for r in q.correlated_features(df, columns=["x", "twice", "wave"]).collect()}
    assert pairs == {("x", "twice")}
    assert q.select_features(df) == ["at_limit", "x", "wave"]
    # Below 0.6 values are counted one by one, with the same result.
    assert {r["column"]: r["top_share"] for r in q.constant_features(df, 0.55).collect()} == {
        "mostly": 0.91, "at_limit": 0.9, "empty": 0.95
    }


def test_text_columns_are_near_constant_too(spark):
    df = spark.range(100).select(
        F.col("id").alias("customer_id"),
        F.when(F.col("id") < 95, "free").otherwise("paid").alias("plan"),
        F.when(F.col("id") < 50, "a").otherwise("b").alias("region"),
    )
    assert [tuple(r) for r in q.constant_features(df).collect()] == [("plan", 0.95)]


def test_missing_values_leave_out_their_own_pairs_only(spark):
    x = F.col("id").cast("double")
    df = spark.range(200).select(
        x.alias("x"),
        F.when(F.col("id") % 2 == 0, x * 3).alias("half"),
        F.when(F.col("id") == 7, float("inf")).when(F.col("id") == 8, float("nan")).otherwise(-x).alias("odd"),
        F.lit(None).cast("double").alias("none"),
        F.when(F.col("id") == 3, 1.0).alias("single"),
        F.lit(4.0).alias("same"),
    )
    found = {(r["kept"], r["dropped"]): r["correlation"] for r in q.correlated_features(df).collect()}
    assert found == {("x", "half"): pytest.approx(1), ("x", "odd"): pytest.approx(-1), ("half", "odd"): pytest.approx(-1)}


def test_every_column_is_checked_for_leakage(spark):
    columns = [(F.col("id") * (i + 2) % 17).alias(f"c{i:02d}") for i in range(40)]
    df = spark.range(100).select((F.col("id") % 2).cast("int").alias("label"), *columns, (F.col("id") % 2).alias("leak"))
    assert [r["column"] for r in q.label_correlations(df).where("suspect").collect()] == ["leak"]
    assert q.label_correlations(df, first=5).count() == 5


def test_constraints_read_each_table_a_bounded_number_of_times(spark, tmp_path):
    make_customers(spark, ["a"]).write.parquet(str(tmp_path / "c"))
    make_events(spark, [("a", "login", at(1), 1)]).write.parquet(str(tmp_path / "e"))
    found = q.constraint_violations(spark.read.parquet(str(tmp_path / "c")), spark.read.parquet(str(tmp_path / "e")))
    assert found._jdf.queryExecution().executedPlan().toString().count("FileScan") <= 4
