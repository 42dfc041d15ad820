"""Rows for the start and the end of each step of a job."""

from __future__ import annotations

import datetime as dt
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame

from millrace.sources.lake import Lake

# The log's columns.
RUN_LOG_DDL = """
    log_id string, environment string, job_id string, run_id string, task_run_id string,
    task_key string, notebook_name string, cell_name string, domain string, dataset string,
    status string, start_time timestamp, end_time timestamp, duration_ms bigint,
    rows_processed bigint, error_type string, error_message string, created_at timestamp
"""


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


def log_run(
    lake: Lake,
    environment: str,
    step: dict,
    status: str,
    started: dt.datetime,
    rows_processed: int = 0,
    error: Exception | None = None,
) -> str:
    """Append a row to a file of its own: steps running at the same time do not collide."""
    ended = _now()
    row = {
        **step,
        "log_id": str(uuid.uuid4()),
        "environment": environment,
        "status": status,
        "start_time": started,
        "end_time": ended,
        "duration_ms": int((ended - started).total_seconds() * 1000),
        "rows_processed": rows_processed,
        "error_type": type(error).__name__ if error else None,
        "error_message": str(error) if error else None,
        "created_at": _now(),
    }
    log = lake.spark.createDataFrame([row], RUN_LOG_DDL)
    log.coalesce(1).write.parquet(f"{lake.root}/monitoring/run_log/{row['log_id']}")
    return row["log_id"]


@contextmanager
def logged(lake: Lake, environment: str, **step):
    """Log the enclosed step as STARTED, then as SUCCESS, or as FAILED with its error, which goes on.

    The step reports its size by setting ``rows_processed`` in the dict it is given.
    """
    started, report = _now(), {"rows_processed": 0}
    log_run(lake, environment, step, "STARTED", started)
    try:
        yield report
    except Exception as error:
        log_run(lake, environment, step, "FAILED", started, report["rows_processed"], error)
        raise
    log_run(lake, environment, step, "SUCCESS", started, report["rows_processed"])


def read_run_log(lake: Lake) -> DataFrame:
    reader = lake.spark.read.schema(RUN_LOG_DDL).option("recursiveFileLookup", "true")
    return reader.parquet(f"{lake.root}/monitoring/run_log")
