import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbtide.operators.quantiles import exact_median, exact_quantiles
from ebbtide.operators.ranking import rank_rows, running_totals


def skewed(spark, n=20_000):
    """A third of the rows share one key value; ids are unique; rows lie in many partitions."""
    return (
        spark.range(0, n, 1, 7)
        .withColumn("key", F.when(F.col("id") % 3 == 0, 5).otherwise(F.pmod(F.xxhash64("id"), F.lit(997))))
        .withColumn("grp", F.when(F.col("id") % 10 < 7, "a").otherwise("b"))
    )


def test_global_rank_with_a_hot_key(spark):
    rows = rank_rows(skewed(spark), [F.desc("key"), F.asc("id")]).toPandas()
    rows = rows.sort_values(["key", "id"], ascending=[False, True])
    assert list(rows["rank"]) == list(range(1, len(rows) + 1))
    assert set(rows["group_rows"]) == {len(rows)}


def test_rank_within_groups(spark):
    rows = rank_rows(skewed(spark), [F.asc("key"), F.asc("id")], group=["grp"]).toPandas()
    for _, part in rows.sort_values(["key", "id"]).groupby("grp"):
        assert list(part["rank"]) == list(range(1, len(part) + 1))
        assert set(part["group_rows"]) == {len(part)}


def test_rank_of_an_empty_frame(spark):
    assert rank_rows(spark.range(0), [F.asc("id")]).count() == 0


@pytest.mark.parametrize("ascending", [True, False])
@pytest.mark.parametrize("like", [None, "flat"])
def test_running_totals_and_following_rows(spark, ascending, like):
    df = skewed(spark).withColumn("v", F.col("id") % 11).withColumn("x", F.col("id") / 7 - 100)
    # Ranges that fit badly, here all rows in one, change nothing.
    of = (spark.range(3).select(F.lit(1e9).alias("z")), "z") if like else None
    rows = running_totals(df, "x", ["v"], ["grp"], following=["id"], like=of, ascending=ascending).toPandas()
    assert len(rows) == 20_000
    for _, part in rows.sort_values("x", ascending=ascending).groupby("grp"):
        assert (part["v"].cumsum() == part["cum_v"]).all()
        assert (part["all_v"] == part["v"].sum()).all()
        following = part["id"].shift(-1)
        assert following.equals(part["next_id"].astype(following.dtype))


def test_running_totals_of_odd_numbers_and_no_rows(spark):
    df = spark.createDataFrame([(float("inf"), 1), (float("-inf"), 2), (0.0, 4)], "x double, v long")
    got = {r.x: (r.cum_v, r.all_v) for r in running_totals(df, "x", ["v"]).collect()}
    assert got == {float("inf"): (1, 7), 0.0: (5, 7), float("-inf"): (7, 7)}
    assert running_totals(df.where("v > 9"), "x", ["v"]).count() == 0


def test_running_totals_move_rows_once(spark, capsys):
    scored = skewed(spark).select((F.col("id") / 20_000).alias("score"), (F.col("id") % 2).alias("label"))
    running_totals(scored, "score", ["label"]).explain("formatted")
    plan = capsys.readouterr().out.split("(1)")[0]
    # One for the rows, and those of the totals, which are a row per range.
    assert "Sort" in plan and plan.count("rangepartitioning") == 0


def test_sorted_rows_are_spread_over_partitions(spark):
    """The rows of one hot key do not end up in one partition."""
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        from ebbtide.operators.ranking import _sorted_positions

        placed = _sorted_positions(skewed(spark), [F.asc("key"), F.asc("id")], [])
        sizes = [r["count"] for r in placed.groupBy("_part").count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert len(sizes) == 4
    assert max(sizes) < 0.5 * sum(sizes)


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(7)
    n = 30_001
    columns = {
        "normal": rng.normal(size=n),
        "skewed": np.exp(rng.normal(size=n) * 3),
        "hot": np.where(rng.random(n) < 0.4, 3.0, rng.integers(0, 50, n).astype(float)),
        "constant": np.full(n, 2.5),
    }
    rows = [tuple(float(columns[c][i]) for c in columns) for i in range(n)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in columns)).repartition(5)
    probabilities = (0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0)
    found = exact_quantiles(df, list(columns), probabilities)
    for c, values in columns.items():
        assert np.allclose(found[c], np.quantile(values, probabilities), rtol=1e-12, atol=1e-12)


def test_quantiles_of_small_and_missing_columns(spark):
    df = spark.createDataFrame(
        [(1, None, 1.0, None), (2, 4, float("nan"), None), (9, 6, 3.0, None), (4, None, None, None)],
        "a int, b int, c double, d double",
    )
    assert exact_median(df, ["a", "b", "c", "d"]) == {"a": 3.0, "b": 5.0, "c": 2.0, "d": None}
    assert exact_median(df, []) == {}
    one = spark.createDataFrame([(7,)], "a int")
    assert exact_quantiles(one, ["a"], (0.25, 0.75)) == {"a": [7.0, 7.0]}


def test_small_sizes_are_exact(spark):
    for n in (1, 2, 3, 4, 8):
        values = [float((i * 7) % n) for i in range(n)]
        df = spark.createDataFrame([(v,) for v in values], "a double")
        assert np.allclose(exact_quantiles(df, ["a"], (0.25, 0.5, 0.75))["a"], np.quantile(values, (0.25, 0.5, 0.75)))


def test_infinite_neighbours(spark):
    inf = float("inf")
    df = spark.createDataFrame([(-inf, inf), (-inf, inf), (1.0, inf), (inf, inf)], "a double, b double")
    assert exact_quantiles(df, ["a", "b"], (0.25, 0.5)) == {"a": [-inf, -inf], "b": [inf, inf]}


def test_brackets_are_cut_until_few_values_are_left(spark, monkeypatch):
    from ebbtide.operators import quantiles

    monkeypatch.setattr(quantiles, "FEW", 40)
    monkeypatch.setattr(quantiles, "PARTS", 4)
    monkeypatch.setattr(quantiles, "_MARGIN", 0.2)
    rng = np.random.default_rng(7)
    values = np.r_[rng.normal(size=3000), np.full(700, 0.125), rng.integers(0, 9, 500)]
    df = spark.createDataFrame([(float(v),) for v in values], "a double").repartition(5)
    wanted = (0.1, 0.5, 0.77, 0.99)
    assert np.allclose(quantiles.exact_quantiles(df, ["a"], wanted)["a"], np.quantile(values, wanted), rtol=1e-12)
