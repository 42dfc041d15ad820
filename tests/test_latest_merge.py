import pytest
from pyspark.sql import functions as F

from millrace.operators.columns import require_columns, require_non_empty, standardize_columns
from millrace.operators.latest import any_per_key, latest_per_key
from millrace.operators.merge import (
    delete_where,
    insert_absent,
    unprocessed_batches,
    upsert_by_key,
    upsert_latest,
)

DDL = "k string, v string, _ingestion_timestamp timestamp_ntz, _source_file string, _batch_id string"


def frame(spark, *rows):
    """(k, v, day, file, batch)"""
    df = spark.createDataFrame(
        list(rows), "k string, v string, day int, _source_file string, _batch_id string"
    )
    moment = F.timestamp_add("DAY", F.col("day"), F.lit("2024-01-01").cast("timestamp_ntz"))
    return df.select(
        "k", "v", moment.alias("_ingestion_timestamp"), "_source_file", "_batch_id"
    )


def test_latest_prefers_time_then_batch_then_file_then_values(spark, rows):
    df = frame(
        spark,
        ("a", "old", 0, "f", "b9"), ("a", "new", 1, "f", "b1"),
        ("b", "x", 0, "f", "b1"), ("b", "y", 0, "f", "b2"),
        ("c", "x", 0, "f2", "b"), ("c", "y", 0, "f1", "b"),
        ("d", "z", 0, "f", "b"), ("d", None, 0, "f", "b"), ("d", "a", 0, "f", "b"),
        (None, "n1", 0, "f", "b"), (None, "n2", 1, "f", "b"),
    )
    assert rows(latest_per_key(df, ["k"]), "k", "v") == sorted(
        [("a", "new"), ("b", "y"), ("c", "y"), ("d", None), (None, "n2")],
        key=lambda r: [str(v) for v in r],
    )


@pytest.mark.parametrize("pick", [latest_per_key, any_per_key])
def test_choice_does_not_depend_on_input_order(spark, rows, pick):
    df = spark.range(3000).selectExpr(
        "cast(id % 50 as string) k", "cast(id * 7919 % 101 as string) v",
        "timestamp_ntz'2024-01-01' _ingestion_timestamp", "'f' _source_file", "'b' _batch_id",
    )
    results = {
        tuple(rows(pick(df.repartition(n).orderBy(F.rand(n)), ["k"]))) for n in (1, 3, 7)
    }
    assert len(results) == 1


def test_hot_key_is_cut_before_the_shuffle(spark):
    """Two thirds of the rows share a key: each task sends one of them."""
    df = spark.range(0, 30000, 1, 6).selectExpr("if(id % 3 > 0, 0, id) k", "id v")
    chosen = any_per_key(df, ["k"])
    assert chosen.count() == 10000 and chosen.filter("k = 0").first()["v"] == 0
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.index("Partial"), plan


def test_upsert_null_keys_never_match(spark, rows):
    target = spark.createDataFrame([("a", 1), ("b", 1), (None, 1)], "k string, v int")
    source = spark.createDataFrame([("b", 2), ("c", 2), (None, 2)], "k string, v int")
    assert rows(upsert_by_key(target, source, ["k"])) == [
        (None, 1), (None, 2), ("a", 1), ("b", 2), ("c", 2),
    ]


def test_upsert_deduplicates_first_load_and_source(spark, rows):
    source = spark.createDataFrame([("a", 2), ("a", 1)], "k string, v int")
    assert rows(upsert_by_key(None, source, ["k"])) == [("a", 1)]
    target = spark.createDataFrame([("a", 0, "kept")], "k string, v int, extra string")
    assert rows(upsert_by_key(target, source, ["k"])) == [("a", 1, None)]


def test_upsert_latest_guards_newer_rows(spark, rows):
    stored = frame(spark, ("a", "newer", 5, "f", "b5"), ("b", "old", 1, "f", "b1"))
    late = frame(spark, ("a", "late", 2, "f", "b2"), ("b", "new", 2, "f", "b2"))
    once = upsert_latest(stored, late, ["k"])
    assert rows(once, "k", "v") == [("a", "newer"), ("b", "new")]
    assert rows(upsert_latest(once, late, ["k"])) == rows(once)


def test_insert_absent_keeps_first(spark, rows):
    target = spark.createDataFrame([("d", "b1", 1)], "dataset string, b string, n int")
    source = spark.createDataFrame(
        [("d", "b1", 2), ("d", "b2", 2), ("d", "b2", 3)], "dataset string, b string, n int"
    )
    assert rows(insert_absent(target, source, ["dataset", "b"])) == [("d", "b1", 1), ("d", "b2", 2)]


def test_delete_keeps_unknown(spark, rows):
    df = spark.createDataFrame([(1,), (5,), (None,)], "v int")
    assert rows(delete_where(df, F.col("v") > 3)) == [(1,), (None,)]


def test_unprocessed_batches(spark, rows):
    df = spark.createDataFrame([("b1",), ("b2",), ("b2",), (None,)], "_batch_id string")
    control = spark.createDataFrame(
        [("orders", "b1"), ("returns", "b2")], "dataset string, _batch_id string"
    )
    assert rows(unprocessed_batches(df, None, "orders")) == [("b1",), ("b2",)]
    assert rows(unprocessed_batches(df, control, "orders")) == [("b2",)]


def test_column_guards(spark):
    df = spark.createDataFrame([(1, 2)], "` A.b ` int, C int")
    assert standardize_columns(df).columns == ["a.b", "c"]
    with pytest.raises(ValueError, match="collide"):
        standardize_columns(spark.createDataFrame([(1, 2)], "`a ` int, A int").toDF("a ", "A"))
    with pytest.raises(ValueError, match="missing"):
        require_columns(df, ["x"])
    with pytest.raises(ValueError, match="empty"):
        require_non_empty(df.filter("C = 9"))
    assert require_non_empty(df) is df
