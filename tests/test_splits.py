from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from ebbtide.operators.splits import select_split, split_frames, stratified_folds, temporal_split


def frame(spark, n, dated=False):
    rows = [
        (f"c{i}", i, i % 2, float(i), float(2 * i), date(2023, 1, 1) + timedelta(days=i) if dated else None)
        for i in range(n)
    ]
    return spark.createDataFrame(
        rows, "customer_id string, row_id long, label int, feature1 double, feature2 double, signup_date date"
    )


def sizes(df):
    counts = {r["split"]: r["count"] for r in df.groupBy("split").count().collect()}
    return tuple(counts.get(s, 0) for s in ("train", "validation", "test"))


def test_basic_split_is_complete_and_disjoint(spark):
    df = frame(spark, 100)
    out = temporal_split(df, id_col="row_id")
    assert sizes(out) == (60, 20, 20)
    train, valid, test = (f.select("customer_id") for f in split_frames(out))
    assert train.intersect(valid).isEmpty() and valid.intersect(test).isEmpty() and train.intersect(test).isEmpty()
    assert train.union(valid).union(test).distinct().count() == 100


def test_split_respects_dates(spark):
    df = frame(spark, 100, dated=True).orderBy(F.rand(3))
    parts = split_frames(temporal_split(df, date_col="signup_date"))
    low, high = zip(*[f.agg(F.min("signup_date"), F.max("signup_date")).first() for f in parts])
    assert high[0] <= low[1] and high[1] <= low[2]


def test_other_shares(spark):
    assert sizes(temporal_split(frame(spark, 1000), 0.7, 0.15, 0.15)) == (700, 150, 150)


def test_shares_must_sum_to_one(spark):
    with pytest.raises(ValueError):
        temporal_split(frame(spark, 100), 0.5, 0.3, 0.3)


def test_columns_are_kept(spark):
    df = frame(spark, 100)
    out = temporal_split(df)
    assert out.columns == [*df.columns, "split"]
    assert df.columns[-1] == "signup_date"
    assert out.drop("split").exceptAll(df).isEmpty()


def test_small_and_tiny_frames(spark):
    assert sizes(temporal_split(frame(spark, 10))) == (6, 2, 2)
    assert sizes(temporal_split(frame(spark, 1))) == (0, 0, 1)
    assert sizes(temporal_split(frame(spark, 3))) == (1, 0, 2)


def test_shares_truncate_in_double_arithmetic(spark):
    # 100 * 0.29 is a little below 29 in doubles.
    assert sizes(temporal_split(frame(spark, 100), 0.29, 0.31, 0.4)) == (28, 31, 41)


def test_label_totals(spark):
    df = frame(spark, 100).withColumn("label", (F.col("row_id") >= 70).cast("int"))
    out = temporal_split(df, id_col="row_id")
    assert {r["label"]: r["count"] for r in out.groupBy("label").count().collect()} == {0: 70, 1: 30}
    assert select_split(out, "train").filter("label = 1").isEmpty()


def test_missing_dates_come_last(spark):
    df = frame(spark, 10, dated=True).withColumn("signup_date", F.expr("if(row_id < 2, null, signup_date)"))
    last = {r["row_id"] for r in select_split(temporal_split(df, date_col="signup_date"), "test").collect()}
    assert last == {0, 1}


def test_one_date_for_everyone_falls_back_to_ids(spark):
    df = frame(spark, 100).withColumn("signup_date", F.lit(date(2024, 1, 1)))
    train = select_split(temporal_split(df, date_col="signup_date", id_col="row_id"), "train")
    assert train.agg(F.max("row_id")).first()[0] == 59


def test_unknown_split(spark):
    with pytest.raises(ValueError):
        select_split(temporal_split(frame(spark, 10)), "holdout")


@pytest.mark.parametrize("n, k", [(103, 5), (7, 5), (3, 5), (40, 4)])
def test_folds_are_contiguous_and_even_per_class(spark, n, k):
    rows = [(i, int(i % 3 == 0)) for i in range(n)]
    df = spark.createDataFrame(rows, "customer_id long, label int")
    out = stratified_folds(df, k).orderBy("customer_id").collect()
    assert len(out) == n
    for label in (0, 1):
        folds = [r["fold"] for r in out if r["label"] == label]
        assert folds == sorted(folds)
        counts = [folds.count(i) for i in range(k)]
        assert max(counts) - min(counts) <= 1 and counts == sorted(counts, reverse=True)
