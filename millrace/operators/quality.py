"""Row-level data quality: rules become column expressions, never Python code per row."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.datasets import Rule
from millrace.functions.text import is_blank
from millrace.operators.columns import require_columns

VALID = "VALID"
QUARANTINE = "QUARANTINE"


def _bound_violation(breaks: Callable[[Column, object], Column], df: DataFrame, rule: Rule):
    value = F.col(rule.column)
    numeric_bound = isinstance(rule.operand, (int, float)) and not isinstance(rule.operand, bool)
    if numeric_bound and isinstance(df.schema[rule.column].dataType, T.StringType):
        # Text that is not a number breaks a numeric rule instead of failing the job.
        number = value.try_cast("double")
        return (value.isNotNull() & number.isNull()) | breaks(number, F.lit(rule.operand))
    return breaks(value, F.lit(rule.operand))


def _regex_violation(df: DataFrame, rule: Rule) -> Column:
    return ~F.col(rule.column).cast("string").rlike(rule.operand)


def _blank_violation(df: DataFrame, rule: Rule) -> Column:
    return is_blank(rule.column)


def _column_order_violation(df: DataFrame, rule: Rule) -> Column:
    require_columns(df, [rule.operand])
    return F.col(rule.column) < F.col(rule.operand)


# A NULL value makes the violation NULL, so NULL passes every rule but not_empty.
VIOLATIONS = {
    "regex": _regex_violation,
    "not_empty": _blank_violation,
    "greater_than": partial(_bound_violation, lambda value, bound: value <= bound),
    "greater_than_or_equal": partial(_bound_violation, lambda value, bound: value < bound),
    "less_than": partial(_bound_violation, lambda value, bound: value >= bound),
    "less_than_or_equal": partial(_bound_violation, lambda value, bound: value > bound),
    "column_greater_than_or_equal": _column_order_violation,
}


def violation(df: DataFrame, rule: Rule) -> Column:
    """The condition under which a row breaks the rule."""
    require_columns(df, [rule.column])
    return VIOLATIONS[rule.kind](df, rule)


def assess(df: DataFrame, required: Sequence[str], rules: Sequence[Rule] = ()) -> DataFrame:
    """Add ``_quality_reason`` (all failures, ``; ``-joined, or NULL) and ``_quality_status``.

    ``concat_ws`` skips NULLs, so the list of failures needs no array and no lambda
    and stays inside generated code.
    """
    require_columns(df, required)
    failures = [F.when(is_blank(c), F.lit(f"{c} is null or empty")) for c in required]
    failures += [F.when(violation(df, rule), F.lit(rule.reason)) for rule in rules]
    reason = F.nullif(F.concat_ws("; ", *failures), F.lit(""))
    return df.withColumn("_quality_reason", reason).withColumn(
        "_quality_status",
        F.when(F.col("_quality_reason").isNull(), F.lit(VALID)).otherwise(F.lit(QUARANTINE)),
    )


def split(assessed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rows to quarantine)."""
    status = F.col("_quality_status")
    return assessed.filter(status == VALID), assessed.filter(status == QUARANTINE)


def dq_metrics(
    assessed: DataFrame,
    environment: str,
    dataset: str,
    threshold_percent: float,
    micro_batch_id: int = -1,
    batch_id: Column | None = None,
    at: dt.datetime | None = None,
) -> DataFrame:
    """Counts, failure rate and PASS/ALERT, one row for every batch in one pass.

    With ``batch_id`` (an aggregate) the whole input is one batch, empty input included.
    """
    by_batch = batch_id is None
    grouped = assessed.groupBy(F.col("_batch_id").alias("batch_id")) if by_batch else assessed
    counts = [
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(F.col("_quality_status") == VALID).alias("valid_records"),
        F.count_if(F.col("_quality_status") == QUARANTINE).alias("quarantined_records"),
    ]
    if not by_batch:
        counts.append(batch_id.alias("batch_id"))
    rate = F.when(
        F.col("total_records") > 0,
        F.col("quarantined_records") / F.col("total_records") * F.lit(100.0),
    ).otherwise(F.lit(0.0))
    return (
        grouped.agg(*counts)
        .withColumn("dq_failure_rate_percent", rate)
        .select(
            F.lit(environment).alias("environment"),
            F.lit(dataset).alias("dataset"),
            "batch_id",
            F.lit(micro_batch_id).alias("micro_batch_id"),
            "total_records",
            "valid_records",
            "quarantined_records",
            "dq_failure_rate_percent",
            F.lit(float(threshold_percent)).alias("dq_failure_threshold_percent"),
            F.when(F.col("dq_failure_rate_percent") > F.lit(float(threshold_percent)), "ALERT")
            .otherwise("PASS")
            .alias("dq_status"),
            (F.current_timestamp() if at is None else F.lit(at)).alias("recorded_at"),
        )
    )
