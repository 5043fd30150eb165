import json
import os
from datetime import date
from decimal import Decimal
from glob import glob

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from ebbtide.functions.expressions import align_columns
from ebbtide.operators import business as bz
from ebbtide.operators.evaluation import compare_models, evaluate, model_report
from ebbtide.operators.scoring import DecisionParameters
from ebbtide.plans.jobs import business_evaluation, compare_saved_models, error_analysis, threshold_analysis
from ebbtide.schemas import CUSTOMERS
from ebbtide.session import clear_scratch, scratch_path, shared_folder
from ebbtide.sources import raw, reports, tables
from tests.test_decisions import scored
from tests.test_features import make_customers
from tests.test_metrics import CASES, frame


def test_shared_folder_is_the_configured_one(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_scratch_is_removed_on_request(spark):
    path = scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    assert spark.read.parquet(path).count() == 3
    assert clear_scratch() >= 1 and not os.path.exists(path)
    assert clear_scratch() == 0


def test_csv_wins_over_parquet_and_all_files_are_read(spark, tmp_path):
    df = make_customers(spark, ["a", "b", "c"])
    folder = str(tmp_path / "raw")
    df.limit(1).write.parquet(folder)
    assert raw.find_raw_data(spark, folder).endswith("*.parquet")
    df.repartition(2).write.mode("append").option("header", True).csv(folder)
    path = raw.find_raw_data(spark, folder)
    assert path.endswith("*.csv")
    declared = raw.load_raw_data(spark, path, CUSTOMERS)
    assert [f.dataType for f in declared.schema] == [f.dataType for f in CUSTOMERS]
    assert declared.orderBy("customer_id").first()["monthly_revenue"] == Decimal("9.50")
    assert declared.count() == 3
    assert dict(raw.load_raw_data(spark, path, infer_schema=True).dtypes)["signup_date"] == "date"
    assert dict(raw.load_raw_data(spark, path).dtypes)["signup_date"] == "string"


def test_unsupported_and_missing_files(spark, tmp_path):
    with pytest.raises(ValueError):
        raw.load_raw_data(spark, "data.xlsx")
    with pytest.raises(FileNotFoundError):
        raw.ingest(spark, str(tmp_path / "s"), raw_folder=str(tmp_path))
    with pytest.raises(AnalysisException):
        raw.load_features(spark, str(tmp_path / "absent"))


def test_ingest_stages_and_profiles(spark, tmp_path):
    df = make_customers(spark, ["a", "a", "b"], country=None)
    raw.save_staging_data(df, str(tmp_path / "in.parquet"))
    staged, profile, duplicates = raw.ingest(spark, str(tmp_path / "staging"), raw_file=str(tmp_path / "in.parquet"))
    assert staged.count() == 3 and duplicates.first()["duplicate_rows"] == 1
    assert profile.filter("column = 'country'").first()["missing_pct"] == 100.0


def test_snapshots_are_kept_side_by_side(spark, tmp_path):
    path = str(tmp_path / "features")
    for day, value in (("2024-01-01", 1), ("2024-02-01", 2), ("2024-01-01", 3)):
        df = spark.createDataFrame([(value, day)], "total int, observation_date string")
        raw.export_features(df, path, partition_by="observation_date")
    rows = raw.load_features(spark, path).orderBy("total").collect()
    assert [(r["total"], str(r["observation_date"])) for r in rows] == [(2, "2024-02-01"), (3, "2024-01-01")]


def test_base_tables_scripts_and_queries(spark, tmp_path):
    tables.create_base_tables(spark)
    tables.create_base_tables(spark)
    assert spark.table("events").isEmpty() and spark.table("customers").columns == CUSTOMERS.names
    tables.register_views({"people": make_customers(spark, ["a", "b"])})
    script = [
        """-- a comment; with a separator
        CREATE OR REPLACE TEMPORARY VIEW dated AS
        SELECT customer_id, signup_date FROM people WHERE signup_date < :day -- and one; here
        """,
        "SELECT count(*) AS n, 'a;\n-- b' AS t FROM dated",
    ]
    out = str(tmp_path / "result")
    assert tables.run_sql(spark, script, {"day": date(2024, 1, 1)}, out).first()["n"] == 2
    assert spark.read.parquet(out).first()["t"] == "a;\n-- b"
    file = tmp_path / "s.sql"
    file.write_text("SELECT 1 AS one\n")
    assert tables.run_sql_file(spark, str(file)).first()["one"] == 1
    assert tables.execute_query(spark, "SELECT customer_id FROM people WHERE customer_id = :c", c="a").first()[0] == "a"
    saved = tables.save_table(spark.range(3), "numbers")
    assert saved.count() == 3
    tables.save_table(spark.range(5), "numbers")
    assert tables.load_table(spark, "numbers").count() == 5


def test_reports_survive_json_and_csv(spark, tmp_path):
    good = frame(spark, *CASES["perfect"], split="test")
    weak = frame(spark, *CASES["partial"], split="test")
    paths = []
    for name, df in (("good", good), ("weak", weak)):
        paths.append(reports.save_json(model_report(evaluate(df), name), str(tmp_path / name)))
    loaded = reports.load_metrics(spark, paths[0]).first()
    assert loaded["splits"]["test"]["roc_auc"] == 1.0 and loaded["splits"]["train"] is None
    compared = compare_saved_models(spark, paths, str(tmp_path / "csv"))
    again = reports.load_csv(spark, str(tmp_path / "csv"), compared.schema)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, compared.collect()))
    assert compare_models(reports.load_metrics(spark, paths[1])).first()["accuracy"] == pytest.approx(6 / 8)


def test_decision_parameters_come_from_the_reports(spark, tmp_path):
    df = scored(spark)
    threshold = threshold_analysis(df, str(tmp_path / "t")).first()
    business_evaluation(df, [bz.BusinessScenario(4.0, 40.0, None, "s")], str(tmp_path / "b"))
    assert len(threshold["threshold_analysis"]) == 100 and len(threshold["top_k_analysis"]) == 5
    assert threshold["optimal_threshold_metrics"]["threshold"] == threshold["optimal_threshold"]
    found = reports.load_decision_parameters(spark, str(tmp_path / "t"), str(tmp_path / "b"))
    assert found == DecisionParameters(threshold["optimal_threshold"], 4.0, 40.0)
    default = DecisionParameters(0.5, 10.0, 100.0)
    assert reports.load_decision_parameters(spark) == default
    assert reports.load_decision_parameters(spark, str(tmp_path / "no"), str(tmp_path / "no")) == default
    (tmp_path / "partial").mkdir()
    (tmp_path / "partial" / "x.json").write_text(json.dumps({"scenario": {"churn_loss_per_customer": 7.0}}))
    partial = reports.load_decision_parameters(spark, None, str(tmp_path / "partial"))
    assert partial == DecisionParameters(0.5, 10.0, 7.0)


def test_error_report_is_one_ordered_file(spark, tmp_path):
    df = scored(spark).withColumns(
        {"total_events": F.col("customer_id") % 17, "customer_age_days": F.col("customer_id") % 5}
    )
    errors, failures = error_analysis(df, str(tmp_path), fnr_threshold=0.2, threshold=0.8)
    assert failures.count() >= 2
    files = glob(str(tmp_path / "error_analysis_report" / "part-*"))
    assert len(files) == 1
    lines = open(files[0]).read().splitlines()
    headings = [line for line in lines if line.startswith("#")]
    assert headings == [
        "# Segment error analysis",
        "## Summary",
        "## Overall",
        "## By segment",
        "### Activity Segment",
        "### Tenure Segment",
        "### Usage Segment",
        "## Failure segments",
        "## Method",
    ]
    table = [line for line in lines[lines.index("## Failure segments"):] if line.startswith("| ") and "_segment" in line]
    rates = [float(line.split("|")[5].strip().rstrip("%")) for line in table]
    assert len(rates) == failures.count() and rates == sorted(rates, reverse=True)
    assert any("at least 20%" in line for line in lines)
    saved = spark.read.json(str(tmp_path / "error_analysis"))
    assert saved.count() == errors.count()


def test_alignment_adds_and_orders_columns(spark):
    df = spark.createDataFrame([(1, 2.0)], "b int, a double")
    out = align_columns(df, ["a", "missing", "b"])
    assert out.columns == ["a", "missing", "b"] and tuple(out.first()) == (2.0, 0.0, 1)


def test_bucketed_tables_join_without_moving_rows(spark, tmp_path):
    from ebbtide.queries.features import changes
    from ebbtide.sources.tables import save_bucketed

    known = spark.range(300).selectExpr("id AS customer_id", "concat('l', id % 5) AS country")
    parts = [spark.range(a, b).selectExpr("id AS customer_id", "id % 9 AS total_events", "CAST(id % 2 AS INT) AS label")
             for a, b in ((0, 200), (100, 300))]
    frames = {"known_b": known, "before_b": parts[0], "after_b": parts[1]}
    saved = {k: save_bucketed(v, k, buckets=4, path=str(tmp_path / k)) for k, v in frames.items()}
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = changes(saved["known_b"], saved["before_b"], saved["after_b"])
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        rows = {r.customer_id: (r.more_events, r.became_inactive) for r in joined.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert len(rows) == 300 and rows[4] == (-4, True) and rows[150] == (0, False) and rows[250] == (250 % 9, False)
    again = save_bucketed(known.limit(0), "known_b", buckets=4, path=str(tmp_path / "known_b"))
    assert again.count() == 0
