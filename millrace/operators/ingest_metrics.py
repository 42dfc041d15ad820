"""Ingest health, computed from rows already written."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import has_text

METRIC_KEY = ("environment", "dataset", "batch_id", "micro_batch_id")


def ingestion_metrics(
    rows: DataFrame,
    environment: str,
    dataset: str,
    batch_id: str,
    micro_batch_id: int,
    alert_percent: float = 1.0,
    at: dt.datetime | None = None,
) -> DataFrame:
    """One row: totals, rescued and corrupt counts and rates, OK or ALERT.

    Feed it the written Parquet, not the CSV reader: a pruned CSV scan does not parse
    the columns it drops and then reports no corrupt rows.
    """
    total = F.col("total_records")

    def rate(count: str):
        return F.when(total > 0, F.col(count) / total * F.lit(100.0)).otherwise(F.lit(0.0))

    return (
        rows.agg(
            F.count(F.lit(1)).alias("total_records"),
            F.count_if(has_text("_rescued_data", rows.columns)).alias("rescued_records"),
            F.count_if(has_text("_corrupt_record", rows.columns)).alias("corrupt_records"),
        )
        .withColumns(
            {
                "rescued_rate_percent": rate("rescued_records"),
                "corrupt_rate_percent": rate("corrupt_records"),
            }
        )
        .select(
            F.lit(environment).alias("environment"),
            F.lit(dataset).alias("dataset"),
            F.lit(batch_id).alias("batch_id"),
            F.lit(micro_batch_id).cast("long").alias("micro_batch_id"),
            "total_records",
            "rescued_records",
            "corrupt_records",
            "rescued_rate_percent",
            "corrupt_rate_percent",
            F.lit(float(alert_percent)).alias("ingestion_alert_threshold_percent"),
            F.when(
                F.greatest("rescued_rate_percent", "corrupt_rate_percent")
                > F.lit(float(alert_percent)),
                "ALERT",
            )
            .otherwise("OK")
            .alias("ingestion_status"),
            (F.current_timestamp() if at is None else F.lit(at)).alias("recorded_at"),
        )
    )
