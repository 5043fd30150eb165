"""Keys at ranks against a sort of all rows."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ebbtide.operators import selection
from ebbtide.operators.splits import temporal_split
from ebbtide.operators.thresholds import top_k_targeting


@pytest.fixture()
def narrow(monkeypatch):
    """Many passes on small frames."""
    monkeypatch.setattr(selection, "SLOTS", 64)
    monkeypatch.setattr(selection, "FEW", 40)
    monkeypatch.setattr(selection, "MARGIN", 0.1)


def hot_dates(spark, n=5000):
    """A third of the rows has one date, some have none; ids are texts."""
    day = F.when(F.col("id") % 3 == 0, F.lit(date(2024, 2, 1))).when(
        F.col("id") % 50 == 1, F.lit(None).cast("date")
    ).otherwise(F.date_add(F.lit(date(2024, 1, 1)), F.pmod(F.xxhash64("id"), F.lit(90)).cast("int")))
    return spark.range(0, n, 1, 5).select(F.concat(F.lit("c"), "id").alias("customer_id"), day.alias("day"))


def test_keys_at_ranks(spark, narrow):
    keys = hot_dates(spark).select(F.struct(F.col("day").isNull().alias("a"), "day", "customer_id").alias("key"))
    want = [r["key"] for r in keys.orderBy("key").collect()]
    ranks = [0, 1, 2, 1700, 2500, 2501, 4999, 5000]
    total, found = selection.keys_at_ranks(keys, lambda n: ranks)
    assert total == 5000 and found == [want[r - 1] if r else None for r in ranks]
    with pytest.raises(ValueError):
        selection.keys_at_ranks(keys, lambda n: [n + 1])


def test_repeated_keys_and_no_rows(spark, narrow):
    keys = spark.range(0, 4000, 1, 3).select(F.when(F.col("id") % 5 < 4, 7).otherwise(F.col("id") % 400).alias("key"))
    want = [r["key"] for r in keys.orderBy("key").collect()]
    ranks = [1, 100, 101, 2000, 3999, 4000]
    assert selection.keys_at_ranks(keys, lambda n: ranks)[1] == [want[r - 1] for r in ranks]
    assert selection.keys_at_ranks(keys.where("key < 0"), lambda n: [0, n]) == (0, [None, None])


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "string", "double", "decimal(12,3)"])
def test_kinds_of_keys(spark, narrow, kind):
    stamp = F.lit(datetime(2024, 3, 30, 22)) + F.make_interval(secs=F.col("id") % 997 * 977.003)
    value = stamp if kind.startswith("timestamp") else F.col("id") % 997 / 8
    df = spark.range(0, 3000, 1, 4).withColumn("when", value.cast(kind))
    got = temporal_split(df, date_col="when", id_col="id")
    order = [r["id"] for r in df.orderBy("when", "id").collect()]
    split = {r["id"]: r["split"] for r in got.collect()}
    assert [split[i] for i in order] == ["train"] * 1800 + ["validation"] * 600 + ["test"] * 600


def test_a_split_on_a_hot_date_sorts_and_moves_nothing(spark, narrow, capsys):
    df = hot_dates(spark)
    got = temporal_split(df, date_col="day")
    got.explain("formatted")
    plan = capsys.readouterr().out
    assert "Sort" not in plan and "Exchange" not in plan
    assert {r["split"]: r["count"] for r in got.groupBy("split").count().collect()} == {
        "train": 3000, "validation": 1000, "test": 1000}


def test_top_k_with_a_hot_score(spark, narrow):
    df = spark.range(0, 4000, 1, 4).select(
        F.concat(F.lit("c"), "id").alias("customer_id"),
        F.when(F.col("id") % 3 > 0, 0.5).when(F.col("id") % 30 == 0, float("nan")).otherwise(F.col("id") / 4000).alias("score"),
        (F.col("id") % 7 == 0).cast("int").alias("label"),
    )
    rows = sorted(((-r.score, r.customer_id, r.label) for r in df.collect() if r.score == r.score))
    for r in top_k_targeting(df, (1, 25, 60, 100)).collect():
        n = len(rows) * r.k_percent // 100
        hits = sum(label for _, _, label in rows[:n])
        assert (r.k_absolute, r.true_positives, r.false_positives) == (n, hits, n - hits)
