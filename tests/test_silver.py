from dataclasses import replace

import pytest
from pyspark.sql import functions as F

import millrace.plans.silver as plan
from millrace.datasets import DATASETS, Dataset, Rule
from millrace.plans.reprocess import of_batch, reprocess_batch
from millrace.plans.silver import Silver, run_incremental, run_silver, run_snapshot
from millrace.sources.lake import Table

ITEMS = Dataset(
    name="items",
    domain="test",
    ddl="k string, v int",
    key=("k",),
    required=("k",),
    rules=(Rule("v", "greater_than", "v must be > 0", 0),),
)


def bronze_rows(spark, *rows):
    """(k, v, day, batch)"""
    df = spark.createDataFrame(list(rows), "k string, v int, day int, _batch_id string")
    moment = F.timestamp_add("DAY", F.col("day"), F.lit("2024-01-01").cast("timestamp"))
    return df.select(
        "k", "v", moment.alias("_ingestion_timestamp"), F.lit("f").alias("_source_file"),
        "_batch_id",
    )


@pytest.fixture()
def silver(lake):
    return Silver(lake, ITEMS, "test", buckets=4)


def stored(silver, rows):
    return rows(silver.table.read(), "k", "v")


def quarantined(silver, rows):
    return rows(silver.quarantine.read(), "k", "v", "_batch_id")


def test_incremental(spark, silver, rows):
    silver.bronze.append(
        bronze_rows(spark, ("a", 1, 0, "b1"), ("a", 2, 1, "b2"), ("b", -1, 0, "b1"), ("c", 3, 0, "b1"))
    )
    assert run_incremental(silver) == 4
    assert stored(silver, rows) == [("a", 2), ("c", 3)]
    assert quarantined(silver, rows) == [("b", -1, "b1")]
    assert rows(silver.control.read(), "dataset", "_batch_id") == [("items", "b1"), ("items", "b2")]
    metrics = rows(silver.metrics.read(), "batch_id", "total_records", "quarantined_records", "dq_status")
    assert metrics == [("b1", 3, 1, "ALERT"), ("b2", 1, 0, "PASS")]

    silver.bronze.append(bronze_rows(spark, ("d", 4, 2, "b3"), ("a", 9, -5, "b0")))
    assert run_incremental(silver) == 2
    assert stored(silver, rows) == [("a", 2), ("c", 3), ("d", 4)]  # the late row lost
    assert run_incremental(silver) == 0
    assert {r["_quality_status"] for r in silver.table.read().collect()} == {"VALID"}


def test_running_again_changes_nothing(spark, silver, rows, monkeypatch):
    """As after a run that died just before it marked its batches."""
    silver.bronze.append(
        bronze_rows(spark, ("a", 1, 0, "b1"), ("a", 1, 0, "b1"), ("b", -1, 0, "b1"), ("c", None, 0, "b2"))
    )
    with monkeypatch.context() as m:
        m.setattr(plan, "mark_processed", lambda *a: None)
        run_incremental(silver)
    before = (rows(silver.table.read()), quarantined(silver, rows))
    assert run_incremental(silver) == 4
    assert (rows(silver.table.read()), quarantined(silver, rows)) == before
    assert silver.metrics.read().count() == 2


def test_rules_that_changed_empty_the_quarantine_of_a_batch(spark, silver, rows, monkeypatch):
    silver.bronze.append(bronze_rows(spark, ("a", -1, 0, "b1"), ("b", -1, 0, "b2"), ("", -1, 0, "b2")))
    with monkeypatch.context() as m:
        m.setattr(plan, "mark_processed", lambda *a: None)
        run_incremental(silver)
    assert len(quarantined(silver, rows)) == 3
    run_incremental(replace(silver, dataset=ITEMS.with_rules()))
    assert quarantined(silver, rows) == [("", -1, "b2")]
    assert stored(silver, rows) == [("a", -1), ("b", -1)]


def test_any_number_of_batches_in_one_pass(spark, silver, rows):
    many = spark.range(12_000).selectExpr(
        "concat('k', id % 50) k", "1 v", "timestamp_seconds(id) _ingestion_timestamp", "'f' _source_file",
        "concat('b', id) _batch_id",
    )
    silver.bronze.append(many)
    assert run_incremental(silver) == 12_000
    assert silver.control.read().count() == 12_000 and silver.table.read().count() == 50
    assert {r["_batch_id"] for r in silver.table.read().collect()} == {f"b{i}" for i in range(11_950, 12_000)}
    silver.bronze.append(bronze_rows(spark, ("k1", 5, 9000, "later")))
    assert run_incremental(silver) == 1


def written_last(silver):
    newest = silver.table._versions()[0]
    return sorted(silver.table._slice_folders(f"{newest}/_slice=*"))


def test_only_touched_pieces_are_rewritten(spark, lake, rows):
    silver = Silver(lake, ITEMS, "test", buckets=16)
    silver.bronze.append(bronze_rows(spark, *[(f"k{i}", 1, 0, "b1") for i in range(90)]))
    run_incremental(silver)
    assert len(written_last(silver)) > 10
    for day, row in enumerate((("n", 1, 2, "b3"), ("k7", 2, 3, "b4"), ("k7", 9, -3, "b0"))):
        silver.bronze.append(bronze_rows(spark, row))
        run_incremental(silver)
        assert len(written_last(silver)) == 1
    got = stored(silver, rows)
    assert len(got) == 91 and ("k7", 2) in got
    assert len(silver.table.slices()) <= 16


def test_emptied_pieces_take_no_job_each(spark, lake):
    """Emptying 200 slices starts no more jobs than emptying one."""
    table = lake.table("silver", "many")
    counts = []
    for n in (1, 200):
        table.overwrite(spark.range(n).selectExpr("id v", "string(id) _slice"))
        nothing = table.read().limit(0).selectExpr("v", "'x' _slice")
        group = f"emptying-{n}"
        spark.sparkContext.setJobGroup(group, group)
        table.replace_slices(nothing, [str(i) for i in range(n)])
        counts.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)))
        spark.sparkContext.setJobGroup("", "")
        assert table.read().count() == 0
    assert counts[1] <= counts[0]


def test_a_piece_may_lose_its_last_row(spark, silver, rows):
    silver.bronze.append(bronze_rows(spark, ("a", 1, 0, "b1")))
    run_incremental(silver)
    silver.bronze.append(bronze_rows(spark, ("a", 2, 1, "b2")))
    run_incremental(silver)
    assert stored(silver, rows) == [("a", 2)]


def test_another_number_of_buckets(spark, silver, rows):
    silver.bronze.append(bronze_rows(spark, *[(f"k{i}", 1, 0, "b1") for i in range(20)]))
    run_incremental(silver)
    assert len(silver.table.slices()) == 4
    wider = replace(silver, buckets=7)
    wider.bronze.append(bronze_rows(spark, ("k3", 2, 1, "b2")))
    run_incremental(wider)
    assert len(stored(wider, rows)) == 20
    assert all(s.endswith("-of-7") for s in wider.table.slices())


def test_batches_without_valid_rows(spark, silver, rows):
    silver.bronze.append(bronze_rows(spark, ("a", -1, 0, "b1")))
    run_incremental(silver)
    assert stored(silver, rows) == [] and silver.table.read().columns[:2] == ["k", "v"]
    silver.bronze.append(bronze_rows(spark, ("b", -1, 0, "b2")))
    run_incremental(silver)
    silver.bronze.append(bronze_rows(spark, ("b", 1, 0, "b3")))
    run_incremental(silver)
    assert stored(silver, rows) == [("b", 1)]


def test_snapshot(spark, silver, rows):
    silver.bronze.overwrite(bronze_rows(spark, ("a", 1, 0, "b1"), ("b", 1, 0, "b1"), ("c", -1, 0, "b1")))
    run_snapshot(silver)
    run_snapshot(silver)
    assert quarantined(silver, rows) == [("c", -1, "b1")]
    silver.bronze.overwrite(bronze_rows(spark, ("a", 2, 1, "b2"), ("d", 1, 1, "b2")))
    run_silver(replace(silver, dataset=replace(ITEMS, snapshot=True)))
    assert stored(silver, rows) == [("a", 2), ("b", 1), ("d", 1)]
    assert rows(silver.metrics.read(), "batch_id", "micro_batch_id") == [("b1", -1), ("b2", -1)]
    run_snapshot(silver, delete_missing=True)
    assert stored(silver, rows) == [("a", 2), ("d", 1)]
    assert not silver.control.exists()


def test_empty_snapshot(spark, silver, rows):
    silver.bronze.overwrite(bronze_rows(spark))
    run_snapshot(silver)
    assert stored(silver, rows) == []
    assert rows(silver.metrics.read(), "batch_id", "dq_status") == [("snapshot_items", "PASS")]


def test_reprocess_promotes_and_loses_nothing(spark, silver, rows):
    silver.bronze.append(
        bronze_rows(
            spark, ("a", -1, 0, "b1"), ("b", -2, 0, "b1"), ("", 5, 0, "b1"), ("", 5, 0, "b1"),
            ("c", 1, 0, "b1"), ("x", -1, 0, "b2"),
        )
    )
    run_incremental(silver)
    relaxed = replace(
        silver, dataset=ITEMS.with_rules(Rule("v", "greater_than", "v must be > -2", -2))
    )
    out = reprocess_batch(relaxed, "b1")
    assert out == {
        "dataset": "items", "batch_id": "b1", "valid_records": 1, "invalid_records": 2,
        "new_bronze_records": 0, "new_silver_records": 1, "status": "PARTIAL",
    }
    assert stored(silver, rows) == [("a", -1), ("c", 1)]
    assert quarantined(silver, rows) == [("", 5, "b1"), ("b", -2, "b1"), ("x", -1, "b2")]
    reasons = rows(silver.quarantine.read().filter("_batch_id = 'b1'"), "k", "_quarantine_reason", "_quarantine_batch_id")
    assert reasons == [
        ("", "k is null or empty", "b1"), ("b", "v must be > -2", "b1"),
    ]
    # the same again: nothing new, nothing twice
    again = reprocess_batch(relaxed, "b1")
    assert (again["valid_records"], again["invalid_records"]) == (0, 2)
    assert len(quarantined(silver, rows)) == 3

    free = replace(silver, dataset=replace(ITEMS, required=(), rules=()))
    assert reprocess_batch(free, "b1")["status"] == "PASS"
    assert quarantined(silver, rows) == [("x", -1, "b2")]
    with pytest.raises(ValueError, match="no quarantined rows"):
        reprocess_batch(free, "b1")
    assert run_incremental(silver) == 0


def test_reprocess_adds_to_bronze_what_it_lacks(spark, silver, rows):
    """A quarantined copy that was put right has another key than its bronze row."""
    silver.bronze.append(bronze_rows(spark, ("", 5, 0, "b1")))
    run_incremental(silver)
    fixed = silver.quarantine.read().withColumn("k", F.lit("fixed"))
    plan.replace_quarantined(silver, fixed, fixed.select("_batch_id"))
    out = reprocess_batch(silver, "b1")
    assert (out["new_bronze_records"], out["new_silver_records"], out["status"]) == (1, 1, "PASS")
    assert rows(silver.bronze.read(), "k") == [("",), ("fixed",)]
    assert stored(silver, rows) == [("fixed", 5)]


def test_shipped_datasets_are_consistent():
    for d in DATASETS.values():
        names = set(d.columns)
        assert set(d.key) <= set(d.required) <= names
        assert {r.column for r in d.rules} <= names


def scanned(df):
    """(files, rows) that the frame's scan with partition filters has read, once it has run."""
    df.collect()
    top = df._jdf.queryExecution().executedPlan()
    if top.nodeName() == "AdaptiveSparkPlan":
        top = top.executedPlan().plan()
    leaves = top.collectLeaves()
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.nodeName().startswith("Scan parquet") and leaf.partitionFilters().nonEmpty():
            return tuple(leaf.metrics().get(k).get().value() for k in ("numFiles", "numOutputRows"))
    raise AssertionError("no scan with partition filters")


def test_a_second_delivery_reads_no_file_of_the_first(spark, silver):
    silver.bronze.append(bronze_rows(spark, *[(f"k{i}", 1, 0, f"b{i % 7}") for i in range(70)]))
    run_incremental(silver)
    silver.bronze.append(bronze_rows(spark, ("x", 1, 1, "late"), ("y", 1, 1, "late")))
    bronze = silver.bronze.read()
    plan.store_pending(silver, bronze)
    rows = plan.pending_rows(silver, bronze)
    assert "dynamicpruning" in rows._jdf.queryExecution().executedPlan().toString()
    assert scanned(rows) == (1, 2)
    assert sorted(r["k"] for r in rows.collect()) == ["x", "y"]


def test_pending_ids_come_from_the_folders(spark, silver, monkeypatch):
    silver.bronze.append(bronze_rows(spark, *[(f"k{i}", 1, 0, f"b{i % 3}") for i in range(30)], ("n", 1, 0, None)))
    plans = []
    write = Table.overwrite
    monkeypatch.setattr(Table, "overwrite", lambda t, df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or write(t, df))
    plan.store_pending(silver, silver.bronze.read())
    assert sorted(r[0] for r in silver.work("pending").read().collect()) == ["b0", "b1", "b2"]
    assert "FileScan" not in plans[0] and "LocalTableScan" in plans[0]


def test_reprocessing_reads_one_batch_only(spark, silver):
    silver.bronze.append(bronze_rows(spark, *[(f"k{i}", -1, 0, f"b{i % 9}") for i in range(90)]))
    run_incremental(silver)
    for table in (silver.bronze, silver.quarantine):
        assert scanned(of_batch(table, "b4")) == (1, 10)


def test_judged_rows_are_stored_without_a_shuffle(spark, silver, rows, monkeypatch):
    plans, overwrite = [], Table.overwrite

    def noted(table, df):
        if table.path.endswith("/assessed"):
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        overwrite(table, df)

    monkeypatch.setattr(Table, "overwrite", noted)
    silver.bronze.append(bronze_rows(spark, ("a", 1, 0, "b1"), ("b", -1, 0, "b1")))
    assert run_incremental(silver) == 2
    assert len(plans) == 1 and "Repartition" not in plans[0] and "Rebalance" not in plans[0]
    assert stored(silver, rows) == [("a", 1)] and quarantined(silver, rows) == [("b", -1, "b1")]


def test_an_upsert_chooses_the_latest_row_once(spark, silver, rows, monkeypatch):
    silver.bronze.append(bronze_rows(spark, ("a", 1, 0, "b1"), ("b", 1, 5, "b1")))
    run_incremental(silver)
    chosen, latest = [], plan.latest_per_key
    monkeypatch.setattr(plan, "latest_per_key", lambda *a: chosen.append(a) or latest(*a))
    silver.bronze.append(
        bronze_rows(spark, ("a", 2, 1, "b2"), ("a", 3, 2, "b2"), ("b", 9, 4, "b2"), ("c", 5, 1, "b2"), ("c", 5, 1, "b2"))
    )
    run_incremental(silver)
    assert stored(silver, rows) == [("a", 3), ("b", 1), ("c", 5)] and not chosen


def test_lines_joined_by_order_are_not_shuffled_again(spark):
    from millrace.sources import supplied

    conf, limit = spark.conf, "spark.sql.autoBroadcastJoinThreshold"
    before = conf.get(limit)
    conf.set(limit, "-1")
    try:
        lines = supplied.latest_order_lines(spark, "/root/testdata/sf0.001")
        text = lines._jdf.queryExecution().executedPlan().toString()
    finally:
        conf.set(limit, before)
    assert "SortMergeJoin" in text and text.count("Exchange hashpartitioning") == 2
