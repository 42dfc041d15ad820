"""Whole-folder ingest: each run replaces the bronze table."""

from __future__ import annotations

from millrace.datasets import Dataset
from millrace.operators.ingest_metrics import METRIC_KEY, ingestion_metrics
from millrace.operators.merge import upsert_by_key
from millrace.sources.csv_drops import as_bronze, read_drops
from millrace.sources.lake import Lake


def ingest_snapshot(
    lake: Lake, dataset: Dataset, source_path: str, environment: str, batch_id: str
) -> None:
    bronze = lake.table("bronze", dataset.name)
    drops = read_drops(lake.spark, source_path, dataset)
    bronze.overwrite(as_bronze(drops, dataset, environment, batch_id))
    measured = ingestion_metrics(
        bronze.read(), environment, dataset.name, batch_id, -1, dataset.ingest_alert_percent
    )
    metrics = lake.table("monitoring", f"bronze_ingestion_metrics/{dataset.name}")
    metrics.overwrite(
        upsert_by_key(metrics.read_or_none(), measured, METRIC_KEY, source_is_unique=True)
    )
