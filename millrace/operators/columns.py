"""Column-level clean-up, stamps and guards."""

from __future__ import annotations

import datetime as dt
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

QUALITY_COLUMNS = ("_quality_reason", "_quality_status")
QUARANTINE_COLUMNS = ("_quarantine_reason", "_quarantine_timestamp", "_quarantine_batch_id")


def standardize_columns(df: DataFrame) -> DataFrame:
    """Trim and lower-case every column name; two names may not become one."""
    names = [c.strip().lower() for c in df.columns]
    clashes = sorted(n for n, times in Counter(names).items() if times > 1)
    if clashes:
        raise ValueError(f"column names collide after standardizing: {clashes}")
    return df.toDF(*names)


def require_columns(df: DataFrame, required) -> DataFrame:
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def require_non_empty(df: DataFrame) -> DataFrame:
    if df.isEmpty():
        raise ValueError("the DataFrame is empty")
    return df


def _moment(at: dt.datetime | None) -> Column:
    return F.current_timestamp() if at is None else F.lit(at)


def stamp_ingestion(
    df: DataFrame,
    environment: str,
    batch_id: str,
    source_file: Column | None = None,
    at: dt.datetime | None = None,
) -> DataFrame:
    """Add provenance. Without ``source_file`` the reader's own file path is taken."""
    moment = _moment(at)
    return df.withColumns(
        {
            "_ingestion_timestamp": moment,
            "_source_file": F.col("_metadata.file_path") if source_file is None else source_file,
            "_load_date": moment.cast("date"),
            "_batch_id": F.lit(batch_id),
            "_environment": F.lit(environment),
        }
    )


def stamp_silver(df: DataFrame, environment: str, at: dt.datetime | None = None) -> DataFrame:
    return df.withColumns(
        {"_silver_timestamp": _moment(at), "_silver_environment": F.lit(environment)}
    )


def stamp_quarantine(df: DataFrame, at: dt.datetime | None = None) -> DataFrame:
    return df.withColumn("_quarantine_timestamp", _moment(at))
