"""What the physical plans must and must not contain."""

import re

import pytest

from millrace.suite.queries import queries

SF = "/root/testdata/sf0.001"
JOBS = {
    "bronze_stream_ingest", "bronze_snapshot_ingest", "silver_incremental", "silver_snapshot",
    "reprocess_quarantine", "gold_build", "qa_suite", "run_log", "snapshot_overwrite",
    "quarantine_write",
}


def plan(spark, name):
    df = queries()[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(queries()) - JOBS))
def test_no_cross_join_and_no_python(spark, name):
    text = plan(spark, name)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython", "InPandas"):
        assert bad not in text


@pytest.mark.parametrize("name", ["dedup_latest", "silver_transform", "customer_sales"])
def test_deduplication_starts_before_the_shuffle(spark, name):
    assert re.search(r"row_number\(\), 1, Partial", plan(spark, name))


def test_scans_read_only_what_is_needed(spark):
    text = plan(spark, "promotion_products")
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert any("p_retailprice" not in s for s in schemas) and len(schemas) == 2
    coverage = plan(spark, "dq_regex")
    assert "c_acctbal" not in coverage and "c_mktsegment" not in coverage


def test_sales_shuffle_only_partial_sums(spark):
    """One exchange after the deduplication, and that of aggregated rows."""
    text = plan(spark, "customer_sales")
    last = text.index("Exchange hashpartitioning(customer_id")
    assert "partial_sum" in text[last:].splitlines()[1]


def test_checks_need_no_lambda(spark):
    """Higher-order functions would keep the projection out of generated code."""
    assert "lambda" not in plan(spark, "dq_assemble")
