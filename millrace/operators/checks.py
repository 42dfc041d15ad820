"""Data assertions: each gives rows (layer, test_name, status, actual, expected, details)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.functions.text import has_text
from millrace.operators.latest import first_per_key
from millrace.operators.scd2 import CUSTOMER_KEY, OPEN_END

RESULT_DDL = """
    layer string, test_name string, status string, actual string, expected string,
    details string
"""


def outcome(passes: Column, otherwise: str = "FAIL") -> Column:
    return F.when(passes, F.lit("PASS")).otherwise(F.lit(otherwise))


def result(
    measured: DataFrame,
    layer: str,
    test_name: str | Column,
    status: Column,
    actual: Column,
    expected: str,
    details: Column | None = None,
) -> DataFrame:
    name = F.lit(test_name) if isinstance(test_name, str) else test_name
    return measured.select(
        F.lit(layer).alias("layer"),
        name.alias("test_name"),
        status.alias("status"),
        actual.cast("string").alias("actual"),
        F.lit(expected).alias("expected"),
        (F.lit(None) if details is None else details).cast("string").alias("details"),
    )


def _as_json(*names: str) -> Column:
    return F.to_json(F.struct(*names))


def schema_results(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    """Checks that need no data: a table exists, a schema has its columns."""
    return spark.createDataFrame(list(rows), RESULT_DDL)


def check_non_empty(df: DataFrame, layer: str, name: str) -> DataFrame:
    rows = df.agg(F.count(F.lit(1)).alias("rows"))
    return result(
        rows, layer, f"{name} non-empty", outcome(F.col("rows") > 0), F.col("rows"), "> 0"
    )


def key_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: how many rows there are and how many keys occur more than once."""
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    return groups.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("rows"),
        F.count_if(F.col("copies") > 1).alias("duplicate_groups"),
    )


def check_unique(df: DataFrame, keys: Sequence[str], layer: str, name: str) -> DataFrame:
    duplicates = F.col("duplicate_groups")
    return result(
        key_groups(df, keys),
        layer,
        f"{name} business-key uniqueness",
        outcome(duplicates == 0),
        duplicates,
        "0",
        F.lit(f"keys: {', '.join(keys)}"),
    )


def check_rows_and_keys(df: DataFrame, keys: Sequence[str], layer: str, name: str) -> DataFrame:
    """Non-empty and unique in one pass over the table: two result rows."""
    rows, duplicates = F.col("rows"), F.col("duplicate_groups")

    def row(test: str, passes: Column, actual: Column, expected: str, details: Column) -> Column:
        return F.struct(
            F.lit(layer).alias("layer"),
            F.lit(f"{name} {test}").alias("test_name"),
            outcome(passes).alias("status"),
            actual.cast("string").alias("actual"),
            F.lit(expected).alias("expected"),
            details.cast("string").alias("details"),
        )

    listed = F.lit(f"keys: {', '.join(keys)}")
    both = F.array(
        row("non-empty", rows > 0, rows, "> 0", F.lit(None)),
        row("business-key uniqueness", duplicates == 0, duplicates, "0", listed),
    )
    return key_groups(df, keys).select(F.inline(both))


def check_technical(df: DataFrame, layer: str, name: str) -> DataFrame:
    """Rescued and corrupt rows are allowed, but warned about."""
    counts = df.agg(
        F.count_if(has_text("_rescued_data", df.columns)).alias("rescued"),
        F.count_if(has_text("_corrupt_record", df.columns)).alias("corrupt"),
    )
    return result(
        counts,
        layer,
        f"{name} technical ingestion quality",
        outcome((F.col("rescued") == 0) & (F.col("corrupt") == 0), "WARN"),
        _as_json("rescued", "corrupt"),
        '{"rescued":0,"corrupt":0}',
    )


def check_row_count(df: DataFrame, expected: int, layer: str, name: str) -> DataFrame:
    """A source may legitimately change size, so this warns."""
    rows = df.agg(F.count(F.lit(1)).alias("rows"))
    return result(
        rows,
        layer,
        f"{name} row count",
        outcome(F.col("rows") == expected, "WARN"),
        F.col("rows"),
        str(expected),
    )


def check_bronze(
    df: DataFrame, layer: str, name: str, expected_rows: int | None = None
) -> DataFrame:
    """Non-empty, technical quality and, if a count is expected, row count: one pass, a row each."""
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(has_text("_rescued_data", df.columns)).alias("rescued"),
        F.count_if(has_text("_corrupt_record", df.columns)).alias("corrupt"),
    )
    rows, clean = F.col("rows"), (F.col("rescued") == 0) & (F.col("corrupt") == 0)
    tests = [
        (f"{name} non-empty", outcome(rows > 0), rows, "> 0"),
        (f"{name} technical ingestion quality", outcome(clean, "WARN"), _as_json("rescued", "corrupt"),
         '{"rescued":0,"corrupt":0}'),
    ]
    if expected_rows is not None:
        tests.append((f"{name} row count", outcome(rows == expected_rows, "WARN"), rows, str(expected_rows)))
    found = F.array(
        *(
            F.struct(
                F.lit(layer).alias("layer"),
                F.lit(test).alias("test_name"),
                status.alias("status"),
                actual.cast("string").alias("actual"),
                F.lit(expected).alias("expected"),
                F.lit(None).cast("string").alias("details"),
            )
            for test, status, actual, expected in tests
        )
    )
    return counts.select(F.inline(found))


def latest_dq_status(metrics: DataFrame) -> DataFrame:
    """The newest metrics row of each dataset."""
    order = [
        F.col("recorded_at").desc_nulls_last(),
        F.col("batch_id").desc_nulls_last(),
        F.col("micro_batch_id").desc_nulls_last(),
        F.col("environment").asc_nulls_first(),
    ]
    return first_per_key(metrics, ["dataset"], order)


def check_dq_status(
    metrics: DataFrame, layer: str, expected: Sequence[str] | None = None
) -> DataFrame:
    """A row per dataset; one of the ``expected`` without any metrics fails."""
    status = F.col("dq_status")
    latest = latest_dq_status(metrics)
    if expected is not None:
        names = metrics.sparkSession.createDataFrame([(n,) for n in expected], "dataset string")
        latest = names.join(latest, "dataset", "left")
    return result(
        latest,
        layer,
        F.concat(F.lit("DQ latest status: "), "dataset"),
        F.when(status == "PASS", "PASS").when(status == "ALERT", "WARN").otherwise("FAIL"),
        status,
        "PASS",
        F.concat(
            F.lit("failure rate "),
            F.format_number("dq_failure_rate_percent", 2),
            F.lit(" %, threshold "),
            F.format_number("dq_failure_threshold_percent", 2),
            F.lit(" %"),
        ),
    )


def scd2_defects(dim: DataFrame) -> DataFrame:
    """One row of counts; all but ``current_rows`` should be 0.

    With versions sorted by start, looking at the previous one finds every key with an
    overlap: if a version starts before an earlier one ended, so does the one right
    after that earlier version.
    """
    current = F.col("is_current")
    by_start = Window.partitionBy(CUSTOMER_KEY).orderBy(
        F.col("effective_start_date").asc_nulls_first(),
        F.col("effective_end_date").asc_nulls_first(),
    )
    versions = dim.select(
        CUSTOMER_KEY,
        current,
        "effective_start_date",
        "effective_end_date",
        F.lag("effective_end_date").over(by_start).alias("previous_end"),
    )
    per_key = versions.groupBy(CUSTOMER_KEY).agg(
        F.count_if(current).alias("current_rows"),
        F.count_if(current & (F.col("effective_end_date") != F.lit(OPEN_END))).alias("not_open"),
        F.count_if(F.col("effective_start_date") > F.col("effective_end_date")).alias("reversed"),
        F.count_if(F.col("previous_end") >= F.col("effective_start_date")).alias("overlaps"),
    )
    return per_key.agg(
        *[
            F.coalesce(F.sum(c), F.lit(0)).alias(alias)
            for c, alias in (
                ("current_rows", "current_rows"),
                ("not_open", "invalid_current_rows"),
                ("reversed", "reversed_rows"),
                ("overlaps", "overlapping_rows"),
            )
        ],
        F.count_if(F.col("current_rows") > 1).alias("keys_with_several_current_rows"),
    )


def check_scd2(dim: DataFrame, layer: str, name: str) -> DataFrame:
    counts = (
        "invalid_current_rows", "reversed_rows", "overlapping_rows",
        "keys_with_several_current_rows",
    )
    clean = F.lit(True)
    for c in counts:
        clean = clean & (F.col(c) == 0)
    return result(
        scd2_defects(dim),
        layer,
        f"{name} SCD2 current-row integrity",
        outcome(clean),
        _as_json("current_rows", *counts),
        "every current row open, one per key, no overlap, start <= end",
    )


def has_measure(df: DataFrame) -> bool:
    return any(c in df.columns for c in NET_SALES_NAMES)


def first_measure(df: DataFrame, candidates: Sequence[str]) -> str:
    """The first of the candidate columns the frame has."""
    for name in candidates:
        if name in df.columns:
            return name
    raise ValueError(f"none of the measures {list(candidates)} in {df.columns}")


# Names under which the net sales measure may appear, in order.
NET_SALES_NAMES = (
    "net_sales_amount", "net_amount", "net_sales", "revenue", "sales_amount", "total_sales",
)


def totals(fact: DataFrame, summary: DataFrame) -> DataFrame:
    """One row with both totals and their distance; the two sums are stacked, not crossed."""
    f = fact.agg(F.sum(first_measure(fact, NET_SALES_NAMES)).alias("fact_total"))
    s = summary.agg(F.sum(first_measure(summary, NET_SALES_NAMES)).alias("summary_total"))
    stacked = f.unionByName(s, allowMissingColumns=True)
    both = stacked.agg(
        F.coalesce(F.max("fact_total"), F.lit(0.0)).alias("fact_total"),
        F.coalesce(F.max("summary_total"), F.lit(0.0)).alias("summary_total"),
    )
    return both.withColumn("delta", F.abs(F.col("fact_total") - F.col("summary_total")))


def check_reconciles(
    fact: DataFrame, summary: DataFrame, layer: str, name: str, tolerance: float = 0.01
) -> DataFrame:
    return result(
        totals(fact, summary),
        layer,
        f"{name} reconciles to the fact",
        outcome(F.col("delta") < tolerance),
        _as_json("fact_total", "summary_total", "delta"),
        f"delta < {tolerance}",
    )


def uncovered(fact: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """One row: fact rows whose key the dimension lacks, and how many keys those are.

    The fact is counted per key first, so a key with a third of all rows is one row in
    the anti-join. A NULL key is not covered.
    """
    per_key = fact.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    lacking = per_key.join(dimension.select(key).distinct(), key, "left_anti")
    return lacking.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("fact_rows"),
        F.count(F.lit(1)).alias("missing_keys"),
    )


def check_coverage(
    fact: DataFrame, dimension: DataFrame, key: str, layer: str, name: str
) -> DataFrame:
    return result(
        uncovered(fact, dimension, key),
        layer,
        f"{name} covers {key}",
        outcome(F.col("fact_rows") == 0),
        _as_json("fact_rows", "missing_keys"),
        "0",
    )


def differing_rows(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: how many distinct rows occur more often on one side than on the other.

    Both sides are stacked with opposite signs and added up per row, in one aggregation.
    """
    stacked = before.withColumn("_sign", F.lit(1)).unionByName(
        after.withColumn("_sign", F.lit(-1))
    )
    balance = stacked.groupBy(*before.columns).agg(F.sum("_sign").alias("balance"))
    return balance.agg(F.count_if(F.col("balance") != 0).alias("differing_rows"))


def check_unchanged(before: DataFrame, after: DataFrame, layer: str, name: str) -> DataFrame:
    """A job that ran again over the same input left its output as it was."""
    return result(
        differing_rows(before, after),
        layer,
        f"{name} idempotency",
        outcome(F.col("differing_rows") == 0),
        F.col("differing_rows"),
        "0",
    )


def summarize(results: DataFrame) -> DataFrame:
    return results.groupBy("status").agg(F.count(F.lit(1)).alias("tests"))
