"""Large inputs are stored by key once and not shuffled by their readers; the rows are the same."""

import pytest
from pyspark.sql import functions as F

import millrace.plans.gold as gold
import millrace.plans.silver as plan
from millrace.datasets import Dataset, Rule
from millrace.operators.latest import latest_per_key
from millrace.plans.silver import Silver, run_incremental, run_snapshot
from millrace.session import FRUGAL, frugal
from millrace.sources import dealt as D
from millrace.sources import supplied
from millrace.sources.lake import Lake, Table
from millrace.suite.queries import queries

SF = "/root/testdata/sf0.001"
ITEMS = Dataset(
    name="items", domain="test", ddl="k string, v int", key=("k",), required=("k",),
    rules=(Rule("v", "greater_than", "v must be > 0", 0),),
)


@pytest.fixture()
def all_large(monkeypatch):
    for module in (D, plan, supplied):
        monkeypatch.setattr(module, "LEAST_BYTES", 0)
    monkeypatch.setattr(gold, "FILTERED_BY_BYTES", 0)


@pytest.fixture()
def no_broadcast(spark):
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    yield
    spark.conf.set(limit, before)


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_joins_and_groups_of_dealt_rows_take_no_shuffle(spark, tmp_path, rows, no_broadcast):
    left = spark.range(1000).selectExpr("nullif(id % 90, 7) k", "id v", "if(id % 5 = 0, null, string(id)) s")
    right = spark.range(80).selectExpr("id k2", "id * 2 w").union(spark.sql("SELECT NULL, 1L"))
    a, b = D.dealt(left, f"{tmp_path}/a", ["k"], 5), D.dealt(right, f"{tmp_path}/b", ["k2"], 5)
    assert rows(a) == rows(left) and rows(b) == rows(right) and a.dtypes == left.dtypes
    joined = a.join(b, F.col("k") == F.col("k2"))
    assert "SortMergeJoin" in physical(joined) and "Exchange" not in physical(joined)
    assert rows(joined) == rows(left.join(right, F.col("k") == F.col("k2")))
    latest = latest_per_key(a, ["k"])
    assert "Exchange" not in physical(latest) and rows(latest) == rows(latest_per_key(left, ["k"]))
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("millrace_")]


def test_a_hot_key_is_left_to_the_shuffle(spark, tmp_path, rows, monkeypatch):
    monkeypatch.setattr(D, "BUCKET_BYTES", 5000)
    even = spark.range(20000).selectExpr("id k", "rand(1) v")
    hot = even.withColumn("k", F.when(F.col("k") % 3 == 0, -1).otherwise(F.col("k")))
    buckets = D.buckets_for(spark, 200_000)
    assert buckets == 40
    spread = latest_per_key(D.dealt(even, f"{tmp_path}/even", ["k"], buckets), ["k"])
    heaped = latest_per_key(D.dealt(hot, f"{tmp_path}/hot", ["k"], buckets), ["k"])
    assert "Exchange" not in physical(spread)
    # as ever: the key leaves each task as one row
    assert "Exchange" in physical(heaped) and "row_number(), 1, Partial" in physical(heaped)
    assert rows(heaped) == rows(latest_per_key(hot, ["k"]))


@pytest.mark.parametrize("run", [run_incremental, run_snapshot])
def test_a_large_first_load_is_not_shuffled_by_key(spark, tmp_path, rows, monkeypatch, all_large, run):
    bronze = spark.range(900).selectExpr(
        "if(id % 100 = 0, null, concat('k', id % 70)) k", "int(id % 11) v",
        "timestamp_seconds(id DIV 2) _ingestion_timestamp", "'f' _source_file", "concat('b', id % 3) _batch_id",
    )
    plans, overwrite = {}, Table.overwrite

    def noted(table, df):
        plans[table.path.rsplit("/", 2)[-2]] = physical(df)
        overwrite(table, df)

    def stored(silver):
        silver.bronze.overwrite(bronze)
        assert run(silver) == 900
        metrics = rows(silver.metrics.read().drop("recorded_at"))
        return (
            rows(silver.table.read().drop("_silver_timestamp")),
            rows(silver.quarantine.read().drop("_quarantine_timestamp")), metrics,
        )

    monkeypatch.setattr(Table, "overwrite", noted)
    large = stored(Silver(Lake(spark, f"{tmp_path}/large"), ITEMS, "test"))
    assert "Exchange" not in plans["silver"]
    monkeypatch.setattr(plan, "LEAST_BYTES", 1 << 40)
    small = stored(Silver(Lake(spark, f"{tmp_path}/small"), ITEMS, "test"))
    assert "Exchange" in plans["silver"] and large == small


def test_judged_rows_go_when_the_run_ends(spark, lake):
    silver = Silver(lake, ITEMS, "test")
    silver.bronze.append(spark.sql("SELECT 'a' k, 1 v, now() _ingestion_timestamp, 'f' _source_file, 'b' _batch_id"))
    assert run_incremental(silver) == 1
    assert not silver.work("assessed").exists() and silver.table.read().count() == 1


def test_lines_of_stored_tables_are_the_same(spark, tmp_path, rows, all_large, no_broadcast):
    tables = supplied.dealt_lines(spark, SF, str(tmp_path))
    for frame in (supplied.raw_orders, supplied.returns):
        lines = frame(spark, SF, tables)
        assert "Exchange" not in physical(lines) and rows(lines) == rows(frame(spark, SF))


def test_the_qa_suite_is_the_same_and_leaves_no_copies(spark, tmp_path, rows, monkeypatch, all_large):
    import millrace.suite.queries as suite

    def checked(name):
        lake = Lake(spark, f"{tmp_path}/{name}")
        monkeypatch.setattr(suite, "new_lake", lambda *a: lake)
        found = rows(queries()["qa_suite"](spark, SF))
        totals = [rows(lake.table("gold", t).read()) for t in ("dim_customer", "fact_orders", "fact_returns")]
        assert not list((tmp_path / name).glob("**/dealt*")) and not list((tmp_path / name).glob("**/assessed"))
        return found, totals

    large = checked("large")
    monkeypatch.setattr(plan, "LEAST_BYTES", 1 << 40)
    monkeypatch.setattr(supplied, "LEAST_BYTES", 1 << 40)
    monkeypatch.setattr(gold, "FILTERED_BY_BYTES", 1 << 40)
    assert len(large[0]) == 72 and checked("small") == large


def test_settings_come_back(spark):
    before = {name: spark.conf.get(name) for name in FRUGAL}
    with pytest.raises(ValueError), frugal(spark):
        assert {name: spark.conf.get(name) for name in FRUGAL} == FRUGAL
        raise ValueError
    assert {name: spark.conf.get(name) for name in FRUGAL} == before
