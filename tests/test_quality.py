import pytest

from millrace.datasets import DATASETS, STRICT_GATE, Rule
from millrace.operators.quality import assess, dq_metrics, split

NAN, INF = float("nan"), float("inf")


def reasons(spark, values, kind, operand, ddl="v double"):
    df = spark.createDataFrame([(v,) for v in values], ddl)
    out = assess(df, (), [Rule("v", kind, "bad", operand)])
    return [r["_quality_reason"] for r in out.collect()]


@pytest.mark.parametrize(
    "kind, bad",
    [
        ("greater_than", [-1.0, 5.0, -INF]),
        ("greater_than_or_equal", [-1.0, -INF]),
        ("less_than", [5.0, 6.0, NAN, INF]),
        ("less_than_or_equal", [6.0, NAN, INF]),
    ],
)
def test_bounds(spark, kind, bad):
    """NULL passes; NaN is greater than anything."""
    values = [None, -1.0, 5.0, 6.0, NAN, INF, -INF]
    expected = ["bad" if str(v) in {str(b) for b in bad} else None for v in values]
    assert reasons(spark, values, kind, 5) == expected


def test_numeric_rule_on_text(spark):
    got = reasons(spark, ["7", "5", "x", "", None, " 8 "], "greater_than", 5, "v string")
    assert got == [None, "bad", "bad", "bad", None, None]


def test_blank_means_null_empty_or_spaces(spark):
    got = reasons(spark, [None, "", "  ", "\t", "a"], "not_empty", None, "v string")
    assert got == ["bad", "bad", "bad", None, None]


def test_regex_searches_and_lets_null_pass(spark):
    got = reasons(spark, ["xaby", "b", None], "regex", "ab", "v string")
    assert got == [None, "bad", None]


def test_column_order(spark):
    df = spark.sql(
        "select * from values (date'2024-01-02', date'2024-01-02'), "
        "(date'2024-01-02', date'2024-01-01'), (null, date'2024-01-01') as t(s, e)"
    )
    rule = Rule("e", "column_greater_than_or_equal", "reversed", "s")
    got = [r["_quality_reason"] for r in assess(df, (), [rule]).collect()]
    assert got == [None, "reversed", None]


def test_reasons_join_in_order(spark):
    df = spark.createDataFrame([("", -1.0), ("k", 1.0)], "k string, v double")
    rules = [Rule("v", "greater_than", "not positive", 0), Rule("v", "less_than", "huge", -5)]
    out = assess(df, ["k"], rules).collect()
    assert out[0]["_quality_reason"] == "k is null or empty; not positive; huge"
    assert [r["_quality_status"] for r in out] == ["QUARANTINE", "QUARANTINE"]
    assert out[1]["_quality_reason"] == "huge"


def test_errors_when_the_plan_is_built(spark):
    df = spark.createDataFrame([(1,)], "v int")
    with pytest.raises(ValueError, match="missing"):
        assess(df, ["absent"])
    with pytest.raises(ValueError, match="missing"):
        assess(df, (), [Rule("absent", "not_empty", "x")])
    with pytest.raises(ValueError, match="missing"):
        assess(df, (), [Rule("v", "column_greater_than_or_equal", "x", "absent")])
    with pytest.raises(ValueError, match="unknown rule"):
        Rule("v", "matches", "x")
    with pytest.raises(ValueError, match="reason"):
        Rule("v", "not_empty", "")


def test_incomplete_customers(load_fixture):
    spec = DATASETS["customers"]
    out = assess(load_fixture("customers_incomplete.csv"), spec.required, spec.rules)
    assert {r["customer_id"]: r["_quality_reason"] for r in out.collect()} == {
        "": "customer_id is null or empty",
        "C2": "email is null or empty; email must be a valid email address",
        "C3": "signup_date is null or empty",
        "C4": "customer_segment is null or empty",
    }
    good = load_fixture("one_good.json")
    assert assess(good, spec.required, spec.rules).first()["_quality_status"] == "VALID"


def test_metrics_per_batch_and_threshold(spark):
    df = spark.sql(
        "select if(id < 100, 'b1', 'b2') _batch_id, if(id in (0, 150, 151), '', 'x') k "
        "from range(200)"
    )
    got = {
        r["batch_id"]: r.asDict() for r in dq_metrics(assess(df, ["k"]), "t", "d", 1.0).collect()
    }
    assert (got["b1"]["quarantined_records"], got["b1"]["dq_status"]) == (1, "PASS")
    assert (got["b2"]["valid_records"], got["b2"]["dq_status"]) == (98, "ALERT")
    assert got["b2"]["dq_failure_rate_percent"] == 2.0


def test_metrics_of_nothing(spark):
    from pyspark.sql import functions as F

    df = assess(spark.createDataFrame([], "_batch_id string, k string"), ["k"])
    row = dq_metrics(df, "t", "d", 1.0, batch_id=F.coalesce(F.max("_batch_id"), F.lit("none")))
    assert row.first().asDict()["total_records"] == 0
    assert (row.first()["dq_status"], row.first()["dq_failure_rate_percent"]) == ("PASS", 0.0)


def test_split_loses_nothing(spark):
    df = assess(spark.createDataFrame([("a",), (None,)], "k string"), ["k"])
    valid, invalid = split(df)
    assert (valid.count(), invalid.count()) == (1, 1)


def test_gate_rules_differ(spark):
    assert STRICT_GATE["products"].dq_alert_percent == 10.0
    assert "category" in STRICT_GATE["products"].required
    df = spark.createDataFrame([(0.0,)], "unit_price double")
    gate = assess(df, (), STRICT_GATE["products"].rules).first()
    current = assess(df, (), DATASETS["products"].rules).first()
    assert (gate["_quality_status"], current["_quality_status"]) == ("VALID", "QUARANTINE")
