import datetime as dt

import pytest
from pyspark.sql import functions as F

from millrace.operators import checks
from millrace.plans.qa import run_qa, store_qa


def status(df):
    return df.first()["status"]


def test_unique_and_rows(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "k string, n int")
    assert status(checks.check_unique(df, ["k"], "L", "t")) == "FAIL"
    assert status(checks.check_unique(df, ["k", "n"], "L", "t")) == "PASS"
    both = checks.check_rows_and_keys(df, ["k"], "L", "t").collect()
    assert [(r["status"], r["actual"]) for r in both] == [("PASS", "3"), ("FAIL", "1")]
    none = checks.check_rows_and_keys(df.limit(0), ["k"], "L", "t").collect()
    assert [(r["status"], r["actual"]) for r in none] == [("FAIL", "0"), ("PASS", "0")]
    assert status(checks.check_non_empty(df.limit(0), "L", "t")) == "FAIL"


def test_technical_columns_are_optional(spark):
    plain = spark.createDataFrame([(1,)], "a int")
    assert status(checks.check_technical(plain, "L", "t")) == "PASS"
    bad = plain.withColumn("_corrupt_record", F.lit("x"))
    assert status(checks.check_technical(bad, "L", "t")) == "WARN"
    assert checks.check_technical(bad, "L", "t").first()["actual"] == '{"rescued":0,"corrupt":1}'


def test_row_count(spark):
    assert status(checks.check_row_count(spark.range(3), 3, "L", "t")) == "PASS"
    assert status(checks.check_row_count(spark.range(4), 3, "L", "t")) == "WARN"


def test_dq_status_is_the_newest_per_dataset(spark):
    rows = [
        ("e", "a", "b1", -1, "ALERT", 9.0, 1.0, dt.datetime(2024, 1, 1)),
        ("e", "a", "b2", -1, "PASS", 0.0, 1.0, dt.datetime(2024, 1, 2)),
        ("e", "b", "b1", -1, "ALERT", 9.0, 1.0, dt.datetime(2024, 1, 1)),
        ("e", "c", "b1", -1, None, None, 1.0, dt.datetime(2024, 1, 1)),
    ]
    metrics = spark.createDataFrame(
        rows,
        "environment string, dataset string, batch_id string, micro_batch_id int, "
        "dq_status string, dq_failure_rate_percent double, dq_failure_threshold_percent double, "
        "recorded_at timestamp",
    )
    got = {r["test_name"][-1]: r["status"] for r in checks.check_dq_status(metrics, "S").collect()}
    assert got == {"a": "PASS", "b": "WARN", "c": "FAIL"}


def test_reconciliation(spark):
    fact = spark.createDataFrame([(1.0,), (2.0,)], "net_sales_amount double")
    summary = spark.createDataFrame([(3.0,)], "total_sales double")
    assert status(checks.check_reconciles(fact, summary, "G", "s")) == "PASS"
    off = spark.createDataFrame([(3.02,)], "total_sales double")
    assert status(checks.check_reconciles(fact, off, "G", "s")) == "FAIL"
    nothing = fact.limit(0)
    assert status(checks.check_reconciles(nothing, nothing, "G", "s")) == "PASS"
    with pytest.raises(ValueError, match="none of the measures"):
        checks.check_reconciles(fact, spark.range(1), "G", "s")


def test_coverage_counts_null_and_unknown_keys(spark):
    fact = spark.createDataFrame([("a",), ("x",), ("x",), (None,)], "k string")
    dim = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    row = checks.uncovered(fact, dim, "k").first()
    assert (row["fact_rows"], row["missing_keys"]) == (3, 2)
    assert status(checks.check_coverage(fact, dim, "k", "G", "d")) == "FAIL"
    assert status(checks.check_coverage(fact.limit(0), dim, "k", "G", "d")) == "PASS"


def test_an_empty_lake_reports_missing_tables(spark, lake):
    results = run_qa(lake)
    assert {(r["status"], r["actual"]) for r in results.collect()} == {("FAIL", "false"), ("FAIL", None)}
    totals = {r["status"]: r["tests"] for r in store_qa(lake, "dev", results).collect()}
    assert totals == {"FAIL": 22}
    # a second run is summarized alone, but both are kept
    assert store_qa(lake, "dev", run_qa(lake)).first()["tests"] == 22
    assert lake.table("monitoring", "qa_test_results").read().count() == 44


def test_missing_columns_fail(spark, lake):
    lake.table("bronze", "customers").overwrite(spark.createDataFrame([("a",)], "customer_id string"))
    got = {r["test_name"]: r for r in run_qa(lake).collect()}
    assert got["bronze.customers required columns"]["status"] == "FAIL"
    assert "email" in got["bronze.customers required columns"]["details"]


def test_broken_tables_are_reported_not_raised(spark, lake):
    """No key column, no measure, no validity, no metrics for most datasets: a row for each."""
    lake.table("silver", "customers").overwrite(spark.createDataFrame([("x",)], "email string"))
    lake.table("gold", "fact_orders").overwrite(spark.createDataFrame([("o",)], "order_id string"))
    lake.table("gold", "customer_sales_summary").overwrite(spark.createDataFrame([("c",)], "customer_id string"))
    lake.table("gold", "dim_customer").overwrite(spark.createDataFrame([("c",)], "customer_id string"))
    lake.table("monitoring", "silver_dq_metrics/orders").overwrite(
        spark.sql(
            "SELECT 'e' environment, 'orders' dataset, 'b' batch_id, -1 micro_batch_id, 'PASS' dq_status, "
            "0.0D dq_failure_rate_percent, 1.0D dq_failure_threshold_percent, now() recorded_at"
        )
    )
    got = {r["test_name"]: (r["status"], r["details"]) for r in run_qa(lake).collect()}
    assert got["silver.customers business-key uniqueness"] == ("FAIL", "cannot run, missing: customer_id")
    assert got["silver.customers non-empty"][0] == "PASS"
    assert got["gold.customer_sales_summary reconciles to the fact"][0] == "WARN"
    assert got["gold.dim_customer SCD2 current-row integrity"][0] == "FAIL"
    assert got["gold.dim_customer for fact_orders covers customer_id"][0] == "FAIL"
    assert got["DQ latest status: orders"][0] == "PASS"
    assert got["DQ latest status: returns"][0] == "FAIL"


def test_bronze_checks_take_one_pass(spark):
    df = spark.createDataFrame([("a", "x"), ("b", None)], "k string, _corrupt_record string")
    got = [(r["status"], r["actual"]) for r in checks.check_bronze(df, "B", "t", 3).collect()]
    assert got == [("PASS", "2"), ("WARN", '{"rescued":0,"corrupt":1}'), ("WARN", "2")]


def test_unchanged_counts_copies(spark):
    one = spark.createDataFrame([("a", None), ("b", 1), ("b", 1)], "k string, n int")
    assert status(checks.check_unchanged(one, one.orderBy("k"), "L", "t")) == "PASS"
    fewer = one.distinct()
    changed = checks.check_unchanged(one, fewer, "L", "t").first()
    assert (changed["status"], changed["actual"]) == ("FAIL", "1")
