"""The jobs a scheduler starts: one call per task, each leaving a row in the run log."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.environments import Environment, dataset, new_batch_id
from millrace.plans.gold import build_gold
from millrace.plans.pieces import pieces_for
from millrace.plans.qa import PROMOTIONS_EXPECTED, run_qa, store_qa
from millrace.plans.reprocess import reprocess_batch
from millrace.plans.run_log import logged
from millrace.plans.silver import Silver, run_silver
from millrace.plans.snapshot import ingest_snapshot
from millrace.session import size_for
from millrace.sources.lake import Lake, Table, bytes_under
from millrace.streaming.bronze import ingest_stream


def _step(env: Environment, lake: Lake, task: str, name: str | None, ids: dict):
    known = dataset(name) if name else None
    return logged(
        lake,
        env.name,
        task_key=task if known is None else f"{task}_{known.name}",
        cell_name=task,
        domain=known.domain if known else None,
        dataset=known.name if known else None,
        **ids,
    )


def _fit(spark: SparkSession, *tables: Table) -> None:
    """Shuffles fitted to the largest table a job reads."""
    size_for(spark, max((t.bytes() for t in tables if t.exists()), default=0))


def bronze_job(
    spark: SparkSession,
    env: Environment,
    name: str,
    batch_id: str | None = None,
    files_per_trigger: int | None = None,
    **ids,
) -> str:
    """Take in a dataset's drops: new files of a stream, or the folder of a snapshot."""
    d, lake = dataset(name), env.lake(spark)
    batch_id = batch_id or new_batch_id(d)
    with _step(env, lake, "bronze", name, ids) as report:
        size_for(spark, bytes_under(spark, env.drops(d)))
        if d.snapshot:
            ingest_snapshot(lake, d, env.drops(d), env.name, batch_id)
        else:
            ingest_stream(
                lake, d, env.drops(d), env.checkpoint(d), env.name, batch_id, files_per_trigger
            )
        metrics = lake.table("monitoring", f"bronze_ingestion_metrics/{d.name}").read_or_none()
        if metrics is not None:
            own = metrics.filter(F.col("batch_id") == batch_id)
            report["rows_processed"] = own.agg(F.coalesce(F.sum("total_records"), F.lit(0))).first()[0]
    return batch_id


def _silver(env: Environment, lake: Lake, name: str) -> Silver:
    silver = Silver(lake, dataset(name), env.name)
    return replace(silver, buckets=pieces_for(silver.table, silver.bronze, env.buckets.get(name)))


def silver_job(spark: SparkSession, env: Environment, name: str, **ids) -> None:
    lake = env.lake(spark)
    silver = _silver(env, lake, name)
    with _step(env, lake, "silver", name, ids) as report:
        _fit(spark, silver.bronze, silver.table)
        report["rows_processed"] = run_silver(silver)
        for work in (silver.work("assessed"), silver.work("pending")):
            if work.exists():
                work.retire()


def gold_job(
    spark: SparkSession, env: Environment, as_of: dt.date | None = None, **ids
) -> None:
    lake = env.lake(spark)
    with _step(env, lake, "gold", None, ids) as report:
        _fit(spark, *(lake.table("silver", d) for d in ("orders", "returns", "customers")))
        build_gold(lake, as_of, buckets=env.buckets)
        report["rows_processed"] = lake.table("gold", "fact_orders").read().count()


def reprocess_job(
    spark: SparkSession, env: Environment, name: str, batch_id: str, **ids
) -> dict:
    lake = env.lake(spark)
    silver = _silver(env, lake, name)
    with _step(env, lake, "reprocess", name, ids) as report:
        _fit(spark, silver.quarantine, silver.bronze, silver.table)
        out = reprocess_batch(silver, batch_id)
        report["rows_processed"] = out["valid_records"] + out["invalid_records"]
        return out


def qa_job(
    spark: SparkSession,
    env: Environment,
    promotions_expected: int = PROMOTIONS_EXPECTED,
    **ids,
) -> DataFrame:
    """Totals per status. Failed checks are results, not errors."""
    lake = env.lake(spark)
    with _step(env, lake, "qa", None, ids) as report:
        _fit(spark, lake.table("bronze", "orders"), lake.table("gold", "fact_orders"))
        totals = store_qa(lake, env.name, run_qa(lake, promotions_expected))
        report["rows_processed"] = totals.agg(F.sum("tests")).first()[0]
        return totals
