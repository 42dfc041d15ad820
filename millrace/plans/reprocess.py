"""Check a quarantined batch again and promote what passes by now."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.columns import QUALITY_COLUMNS, QUARANTINE_COLUMNS, stamp_quarantine
from millrace.operators.latest import any_per_key
from millrace.operators.merge import absent_from
from millrace.operators.quality import VALID, assess, split
from millrace.plans.silver import Silver, replace_quarantined, upsert_silver
from millrace.sources.lake import Table


def identity(silver: Silver) -> list[str]:
    return ["_source_file", "_batch_id", *silver.dataset.key]


def of_batch(table: Table, batch_id: str) -> DataFrame:
    """One batch's rows; the folders of others are not read."""
    return table.read().filter(F.col("_batch_id") == batch_id)


def recheck(silver: Silver, batch_id: str):
    """The batch's quarantined rows, each once, judged by the dataset's current rules."""
    rows = of_batch(silver.quarantine, batch_id)
    plain = any_per_key(
        rows.drop(*QUALITY_COLUMNS, *QUARANTINE_COLUMNS), identity(silver)
    )
    return assess(plain, silver.dataset.required, silver.dataset.rules)


def reprocess_batch(silver: Silver, batch_id: str) -> dict:
    """Promote valid rows to silver (and to bronze where it lacks them), keep the rest.

    Every frame here is read from stored versions, which later writes leave alone. The
    quarantine is replaced last, so a run that dies loses no row.
    """
    dataset = silver.dataset
    assessed = recheck(silver, batch_id)
    if assessed.isEmpty():
        raise ValueError(f"{dataset.name}: no quarantined rows in batch {batch_id!r}")
    valid, invalid = split(assessed)
    promoted = valid.drop(*QUALITY_COLUMNS)

    missing = promoted
    if silver.bronze.exists():
        missing = absent_from(promoted, of_batch(silver.bronze, batch_id), identity(silver))
    new_keys = valid.select(*dataset.key).distinct()
    if silver.table.exists():
        new_keys = absent_from(new_keys, silver.table.read(), list(dataset.key))

    passed = F.col("_quality_status") == VALID
    counts = assessed.agg(
        F.count_if(passed).alias("valid"), F.count_if(~passed).alias("invalid")
    ).first()
    new_bronze, new_silver = missing.count(), new_keys.count()

    if counts["valid"]:
        upsert_silver(silver, valid)
    if new_bronze:
        silver.bronze.append(missing)
    kept = (
        stamp_quarantine(invalid)
        .withColumn("_quarantine_reason", F.col("_quality_reason"))
        .withColumn("_quarantine_batch_id", F.lit(batch_id))
        .drop(*QUALITY_COLUMNS)
    )
    batch = silver.lake.spark.createDataFrame([(batch_id,)], "_batch_id string")
    replace_quarantined(silver, kept, batch)

    # The names of the result.
    return {
        "dataset": dataset.name,
        "batch_id": batch_id,
        "valid_records": counts["valid"],
        "invalid_records": counts["invalid"],
        "new_bronze_records": new_bronze,
        "new_silver_records": new_silver,
        "status": "PASS" if counts["invalid"] == 0 else "PARTIAL",
    }
