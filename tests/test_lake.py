import os

import pytest
from pyspark.sql import functions as F

from millrace.sources.lake import sliced


def by(df, column):
    return sliced(df, F.col(column))


def test_versions_and_schema_replacement(spark, lake, rows):
    t = lake.table("gold", "t")
    assert not t.exists() and t.read_or_none() is None
    with pytest.raises(FileNotFoundError):
        t.read()
    t.overwrite(spark.range(3))
    before = t.read()
    t.overwrite(spark.createDataFrame([("x",)], "name string"))
    assert rows(t.read()) == [("x",)]
    assert before.count() == 3  # a frame read earlier keeps its version


def test_a_write_without_its_marker_does_not_exist(spark, lake):
    t = lake.table("gold", "t")
    t.overwrite(spark.range(3))
    spark.range(9).write.parquet(f"{t.path}/v00000002.whole")
    assert t.read().count() == 3
    t.overwrite(spark.range(5))
    assert t.read().count() == 5
    assert sorted(os.listdir(t.path))[-1] == "v00000003.whole"


def test_empty_tables_keep_their_schema(spark, lake):
    t = lake.table("gold", "t")
    t.overwrite(by(spark.createDataFrame([], "k string, v int"), "k"))
    assert t.read().columns == ["k", "v"] and t.read().count() == 0
    t.replace_slices(by(spark.createDataFrame([("a", 1)], "k string, v int"), "k"), ["a"])
    assert t.read().count() == 1


def test_slices_are_replaced_alone(spark, lake, rows):
    t = lake.table("silver", "t")
    names = ["a b", "c:d/e=f%", "x"]
    t.overwrite(by(spark.createDataFrame([(n, 1) for n in names], "k string, v int"), "k"))
    assert t.slices() == sorted(names)
    t.replace_slices(by(spark.createDataFrame([("c:d/e=f%", 2)], "k string, v int"), "k"), [names[1]])
    assert rows(t.read()) == [("a b", 1), ("c:d/e=f%", 2), ("x", 1)]
    assert rows(t.read(["c:d/e=f%"])) == [("c:d/e=f%", 2)]
    # covered, but without rows: empty from now on, also after further versions
    t.replace_slices(by(spark.createDataFrame([], "k string, v int"), "k"), ["a b", "never"])
    assert rows(t.read()) == [("c:d/e=f%", 2), ("x", 1)]
    t.append(spark.createDataFrame([("y", 3)], "k string, v int"))
    assert rows(t.read()) == [("c:d/e=f%", 2), ("x", 1), ("y", 3)]
    t.overwrite(spark.createDataFrame([("z", 9)], "k string, v int"))
    assert rows(t.read()) == [("z", 9)]


def test_new_columns_widen(spark, lake, rows):
    t = lake.table("silver", "t")
    t.append(spark.createDataFrame([("a",)], "k string"))
    t.append(spark.createDataFrame([("b", 1)], "k string, v int"))
    t.append(spark.createDataFrame([("c",)], "k string"))
    assert rows(t.read()) == [("a", None), ("b", 1), ("c", None)]
    with pytest.raises(ValueError, match="type of column 'v'"):
        t.append(spark.createDataFrame([("d", "1")], "k string, v string"))


def test_tables_of_a_family(spark, lake, rows):
    for name in ("a", "b"):
        lake.table("m", f"metrics/{name}").overwrite(spark.createDataFrame([(name,)], "k string"))
    assert rows(lake.tables("m", "metrics", ["a", "b", "absent"])) == [("a",), ("b",)]
    assert lake.tables("m", "nothing", ["a"]) is None


def test_shuffles_start_from_the_data(spark, lake):
    from millrace.session import MOST_PARTITIONS, size_for

    t = lake.table("gold", "t")
    t.overwrite(spark.range(100000))
    assert 100000 < t.bytes() < 2000000
    other = spark.newSession()
    for size, partitions in ((t.bytes(), 8), (10 * 2**30, 40), (100 * 2**40, MOST_PARTITIONS)):
        size_for(other, size)
        assert other.conf.get("spark.sql.shuffle.partitions") == str(partitions)


def test_few_slices_are_written_as_they_come(spark, lake, rows):
    from millrace.sources.lake import FEW_SLICES, cut_into

    df = spark.range(100).selectExpr("cast(id % 3 AS string) k", "id v")
    few, many = (cut_into(df, F.col("k"), n) for n in (FEW_SLICES, FEW_SLICES + 1))
    plans = [f._jdf.queryExecution().optimizedPlan().toString() for f in (few, many)]
    assert ["RebalancePartitions" in p for p in plans] == [False, True]
    for i, frame in enumerate((few, many)):
        t = lake.table("gold", f"t{i}")
        t.overwrite(frame)
        assert t.slices() == ["0", "1", "2"] and rows(t.read(["1"]), "v") == sorted(((v,) for v in range(1, 100, 3)), key=str)
