import datetime as dt

import pytest

from millrace.operators.checks import check_scd2
from millrace.operators.scd2 import (
    OPEN_END,
    changed_customers,
    customer_versions,
    new_customers,
    scd2_merge,
)

D1, D2, D3 = (dt.date(2024, 1, d) for d in (1, 2, 3))
DDL = (
    "customer_id string, first_name string, last_name string, email string, city string, "
    "state string, country string, signup_date date, customer_segment string"
)


def customers(spark, *pairs):
    """(id, city)"""
    return spark.createDataFrame(
        [(k, "F", "L", "e@x.y", city, None, "C", D1, "S") for k, city in pairs], DDL
    )


@pytest.fixture()
def seen(rows):
    return lambda df: rows(
        df, "customer_id", "city", "effective_start_date", "effective_end_date", "is_current"
    )


def test_three_days(spark, seen):
    one = scd2_merge(None, customers(spark, ("a", "x"), ("b", "x"), ("c", None)), D1)
    # a changes, b vanishes, c gets a value, d is new
    two = scd2_merge(one, customers(spark, ("a", "y"), ("c", "x"), ("d", "x")), D2)
    # a changes back, the others stay
    three = scd2_merge(two, customers(spark, ("a", "x"), ("c", "x"), ("d", "x")), D3)
    assert seen(three) == [
        ("a", "x", D1, D1, False),
        ("a", "x", D3, OPEN_END, True),
        ("a", "y", D2, D2, False),
        ("b", "x", D1, OPEN_END, True),
        ("c", None, D1, D1, False),
        ("c", "x", D2, OPEN_END, True),
        ("d", "x", D2, OPEN_END, True),
    ]
    assert check_scd2(three, "GOLD", "dim").first()["status"] == "PASS"
    again = scd2_merge(three, customers(spark, ("a", "x"), ("c", "x"), ("d", "x")), D3)
    assert seen(again) == seen(three)


def test_second_change_on_the_same_day_replaces(spark, seen):
    one = scd2_merge(None, customers(spark, ("a", "x"), ("b", "x")), D1)
    two = scd2_merge(one, customers(spark, ("a", "y"), ("b", "x")), D2)
    twice = scd2_merge(two, customers(spark, ("a", "z"), ("b", "w")), D2)
    assert seen(twice) == [
        ("a", "x", D1, D1, False),
        ("a", "z", D2, OPEN_END, True),
        ("b", "w", D2, OPEN_END, True),
        ("b", "x", D1, D1, False),
    ]
    same_first_day = scd2_merge(one, customers(spark, ("a", "q")), D1)
    assert ("a", "q", D1, OPEN_END, True) in seen(same_first_day)
    assert same_first_day.count() == 2


def test_a_late_run_never_ends_a_version_before_it_starts(spark, seen):
    two = scd2_merge(None, customers(spark, ("a", "y")), D2)
    assert seen(scd2_merge(two, customers(spark, ("a", "x")), D1)) == [
        ("a", "x", D2, OPEN_END, True)
    ]


def test_source_with_repeated_keys(spark, seen):
    one = scd2_merge(None, customers(spark, ("a", "x"), ("a", "x"), ("a", "w")), D1)
    assert seen(one) == [("a", "w", D1, OPEN_END, True)]
    two = scd2_merge(one, customers(spark, ("a", "z"), ("a", "z")), D2)
    assert two.count() == 2


def test_changed_and_new(spark, rows):
    target = customer_versions(customers(spark, ("a", "x"), ("b", None)), D1)
    source = customers(spark, ("a", "y"), ("b", None), ("c", "x"))
    assert rows(changed_customers(target, source), "customer_id") == [("a",)]
    assert rows(new_customers(target, source), "customer_id") == [("c",)]


@pytest.mark.parametrize(
    "versions",
    [
        [("a", D1, D2, True)],                               # current but ended
        [("a", D1, OPEN_END, True), ("a", D2, OPEN_END, True)],   # two current
        [("a", D2, D1, False), ("a", D3, OPEN_END, True)],   # reversed
        [("a", D1, D3, False), ("a", D2, OPEN_END, True)],   # overlap
    ],
)
def test_seeded_history_defects_fail(spark, versions):
    dim = spark.createDataFrame(
        versions,
        "customer_id string, effective_start_date date, effective_end_date date, "
        "is_current boolean",
    )
    assert check_scd2(dim, "GOLD", "dim").first()["status"] == "FAIL"
