"""The whole way from CSV drops to QA, twice, through the entry points of the jobs."""

import datetime as dt

import pytest

from millrace.datasets import DATASETS
from millrace.environments import Environment, dataset, new_batch_id
from millrace.plans.jobs import bronze_job, gold_job, qa_job, reprocess_job, silver_job
from millrace.plans.run_log import read_run_log
from millrace.sources import supplied

SF = "/root/testdata/sf0.001"
SETTINGS = (
    "spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.parallelismFirst",
)


def test_names():
    with pytest.raises(ValueError, match="unknown environment"):
        Environment("qa", "/x", "/y")
    with pytest.raises(ValueError, match="unknown dataset"):
        dataset("stock")
    moment = dt.datetime(2024, 1, 2, 3, 4, 5)
    assert new_batch_id(dataset("orders"), moment) == "orders_20240102030405"
    env = Environment("dev", "/lake/", "/raw/")
    assert env.drops(dataset("orders")) == "/raw/erp/orders"
    assert env.checkpoint(dataset("orders")) == "/lake/checkpoints/dev/erp/orders"


@pytest.fixture()
def own_settings(spark):
    """The jobs set the session's shuffles; the other tests keep theirs."""
    before = {n: spark.conf.get(n) for n in SETTINGS}
    yield
    for n, v in before.items():
        spark.conf.set(n, v)


def test_drops_to_qa(spark, tmp_path, rows, own_settings):
    env = Environment("dev", str(tmp_path / "root"), str(tmp_path / "raw"), buckets={"orders": 4})
    lake = env.lake(spark)
    for name, d in DATASETS.items():
        frame = supplied.FRAMES[name](spark, SF).select(*d.columns)
        frame.coalesce(2).write.csv(env.drops(d), header=True)
        bronze_job(spark, env, name, f"{name}_20240101000000")
        silver_job(spark, env, name, job_id="7")
    gold_job(spark, env, dt.date(2024, 1, 1))
    totals = {r["status"]: r["tests"] for r in qa_job(spark, env, 200).collect()}
    # Customers that failed the checks are ordered from: one coverage check fails.
    assert totals.pop("FAIL") == 1 and totals["PASS"] > 50

    def state():
        names = ("dim_customer", "fact_orders", "daily_sales_summary", "product_revenue_summary")
        return [rows(lake.table("gold", n).read()) for n in names]

    first = state()
    for name in DATASETS:
        bronze_job(spark, env, name, f"{name}_20240102000000")
        silver_job(spark, env, name)
    gold_job(spark, env, dt.date(2024, 1, 2))
    assert state() == first

    out = reprocess_job(spark, env, "customers", "customers_20240101000000")
    assert out["status"] == "PARTIAL" and out["valid_records"] == 0
    with pytest.raises(ValueError):
        reprocess_job(spark, env, "products", "products_20240101000000")
    log = rows(read_run_log(lake), "task_key", "status", "error_type")
    assert ("reprocess_products", "FAILED", "ValueError") in log
    assert log.count(("silver_orders", "SUCCESS", None)) == 2
    done = read_run_log(lake).filter("status = 'SUCCESS'").orderBy("start_time").collect()
    orders = supplied.raw_orders(spark, SF).count()
    assert [r["rows_processed"] for r in done if r["task_key"] == "bronze_orders"] == [orders, 0]
    assert [r["rows_processed"] for r in done if r["task_key"] == "silver_orders"] == [orders, 0]
    assert [r["rows_processed"] for r in done if r["task_key"] == "silver_promotions"] == [200, 200]
    assert all(r["rows_processed"] > 0 for r in done if r["task_key"] in ("gold", "qa", "reprocess_customers"))
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == str(256 * 1024 * 1024)
    starts = read_run_log(lake).filter("status = 'STARTED'").count()
    assert starts == read_run_log(lake).filter("status <> 'STARTED'").count()
    durations = [r["duration_ms"] for r in read_run_log(lake).collect()]
    assert max(durations) > 100
