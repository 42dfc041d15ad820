"""Bronze to silver: check, quarantine, deduplicate, upsert, mark."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.datasets import Dataset
from millrace.operators.columns import stamp_quarantine, stamp_silver, standardize_columns
from millrace.operators.ingest_metrics import METRIC_KEY
from millrace.operators.latest import latest_per_key, latest_snapshot
from millrace.operators.merge import (
    insert_absent,
    unprocessed_batches,
    upsert_by_key,
    upsert_latest,
)
from millrace.operators.quality import QUARANTINE, VALID, assess, dq_metrics, split
from millrace.plans.pieces import names, piece_of
from millrace.plans.together import together
from millrace.session import delete_dir
from millrace.sources.dealt import LEAST_BYTES, MOST_BYTES, buckets_for, dealt
from millrace.sources.lake import Lake, Table, cut_into, gathered


@dataclass(frozen=True)
class Silver:
    """One dataset's silver tables.

    The silver table is cut by key hash into ``buckets`` pieces, the quarantine by the hash
    of the batch id into as many. A write replaces only the pieces it touches, however many
    deliveries there have been. Choose ``buckets`` so that a piece is about a gigabyte.
    """

    lake: Lake
    dataset: Dataset
    environment: str
    buckets: int = 1

    @property
    def bronze(self) -> Table:
        return self.lake.table("bronze", self.dataset.name)

    @property
    def table(self) -> Table:
        return self.lake.table("silver", self.dataset.name)

    @property
    def quarantine(self) -> Table:
        return self.lake.table("silver_quarantine", self.dataset.name)

    @property
    def control(self) -> Table:
        return self.lake.table("silver", f"processed_batches/{self.dataset.name}")

    @property
    def metrics(self) -> Table:
        return self.lake.table("monitoring", f"silver_dq_metrics/{self.dataset.name}")

    def work(self, what: str) -> Table:
        """Intermediate rows of a run, replaced by the next one."""
        return self.lake.table("work", f"silver/{self.dataset.name}/{what}")

    def piece(self) -> Column:
        """The slice of silver a row belongs to."""
        return piece_of(self.dataset.key, self.buckets)

    def quarantine_piece(self) -> Column:
        return piece_of(["_batch_id"], self.buckets)


def cut_alike(silver: Silver, table: Table) -> bool:
    return all(s.endswith(f"-of-{silver.buckets}") for s in table.slices())


def transform(valid: DataFrame, dataset: Dataset, environment: str) -> DataFrame:
    """Clean names, the latest row per key, the silver stamp."""
    return stamp_silver(
        latest_per_key(standardize_columns(valid), dataset.key), environment
    )


def replace_quarantined(silver: Silver, rows: DataFrame, batches: DataFrame) -> None:
    """``rows`` become all that is quarantined of ``batches`` (_batch_id); the rest stays."""
    table, piece = silver.quarantine, silver.quarantine_piece()
    if not table.exists():
        table.overwrite(gathered(rows, piece, "_batch_id"))
        return
    alike = cut_alike(silver, table)
    touched = names(batches, piece) if alike else []
    held, done = (table.read(touched) if alike else table.read()), batches.distinct().alias("done")
    same = F.col("held._batch_id").eqNullSafe(F.col("done._batch_id"))
    kept = held.alias("held").join(done, same, "left_anti")
    merged = gathered(kept.unionByName(rows, allowMissingColumns=True), piece, "_batch_id")
    if alike:
        table.replace_slices(merged, touched)
    else:
        table.overwrite(merged)


def quarantine_rows(silver: Silver, invalid: DataFrame, batches: DataFrame) -> None:
    """Replace the quarantined rows of the given batches, so that a rerun adds nothing."""
    replace_quarantined(silver, stamp_quarantine(invalid), batches)


def upsert_silver(silver: Silver, valid: DataFrame) -> None:
    """Bring valid rows into silver; what is newer there already stays.

    The latest row of a key is chosen once, among stored and incoming rows together.
    """
    table = silver.table
    if not table.exists():
        first = transform(valid, silver.dataset, silver.environment)
        table.overwrite(cut_into(first, silver.piece(), silver.buckets))
        return
    incoming = stamp_silver(standardize_columns(valid), silver.environment)
    if not cut_alike(silver, table):
        merged = upsert_latest(table.read(), incoming, silver.dataset.key)
        table.overwrite(cut_into(merged, silver.piece(), silver.buckets))
        return
    touched = names(incoming.select(*silver.dataset.key), silver.piece())
    if touched:
        merged = upsert_latest(table.read(touched), incoming, silver.dataset.key)
        table.replace_slices(cut_into(merged, silver.piece(), silver.buckets), touched)


def record_metrics(silver: Silver, metrics: DataFrame) -> None:
    stored = silver.metrics.read_or_none()
    silver.metrics.overwrite(upsert_by_key(stored, metrics, METRIC_KEY, source_is_unique=True))


def mark_processed(silver: Silver, batches: DataFrame) -> None:
    marks = batches.select(
        F.lit(silver.dataset.name).alias("dataset"),
        "_batch_id",
        F.current_timestamp().alias("_processed_timestamp"),
    )
    stored = silver.control.read_or_none()
    if stored is None:
        stored = silver.lake.spark.createDataFrame([], marks.schema)
    silver.control.overwrite(insert_absent(stored, marks, ["dataset", "_batch_id"]))


def assessed_rows(silver: Silver, rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(all, valid, invalid): judged in one pass and stored, from which every sink is fed.

    Bronze may be many small files, which are read once. Two slices take no shuffle. A large first
    load, all of bronze, is stored in buckets by key: its latest rows are chosen without a shuffle.
    """
    judged = assess(rows, silver.dataset.required, silver.dataset.rules)
    table = silver.work("assessed")
    if not silver.table.exists() and LEAST_BYTES <= (size := silver.bronze.bytes()) <= MOST_BYTES:
        buckets = buckets_for(silver.lake.spark, size)
        every = dealt(judged, f"{table.path}/{uuid.uuid4().hex}", silver.dataset.key, buckets)
        return every, *split(every)
    table.overwrite(cut_into(judged, F.col("_quality_status"), 2))
    return table.read(), table.read([VALID]), table.read([QUARANTINE])


def forget_assessed(silver: Silver) -> None:
    """Judged rows are as many as bronze's and are needed for one run only."""
    delete_dir(silver.lake.spark, silver.work("assessed").path)


def store_pending(silver: Silver, bronze: DataFrame) -> None:
    """Which batches of bronze are not marked yet. Ids come from the partition folders alone."""
    conf, setting = silver.lake.spark.conf, "spark.sql.optimizer.metadataOnly"
    before, ids = conf.get(setting), silver.work("batches")
    conf.set(setting, "true")
    try:
        ids.overwrite(bronze.select("_batch_id").distinct())
    finally:
        conf.set(setting, before)
    pending = unprocessed_batches(ids.read(), silver.control.read_or_none(), silver.dataset.name)
    silver.work("pending").overwrite(pending.withColumn("dataset", F.lit(silver.dataset.name)))


def pending_rows(silver: Silver, bronze: DataFrame) -> DataFrame:
    """Bronze rows of the pending batches.

    The filter on the small side is what lets Spark prune bronze's partition folders by it
    at run time; folders of other batches are not read.
    """
    pending = silver.work("pending").read().where(F.col("dataset") == silver.dataset.name)
    return bronze.join(pending.select("_batch_id"), "_batch_id", "left_semi").select(*bronze.columns)


def run_incremental(silver: Silver) -> int:
    """Process every pending batch in one pass. Returns the number of rows processed.

    Which batches are pending is stored first, and rows are found by joining with that, so
    their number is not bounded by anything. Marking comes last: a run that dies before it is
    repeated, and repeating changes nothing that was written already.
    """
    bronze = silver.bronze.read()
    store_pending(silver, bronze)
    pending = silver.work("pending").read().select("_batch_id")
    if pending.isEmpty():
        return 0
    every, valid, invalid = assessed_rows(silver, pending_rows(silver, bronze))
    dataset = silver.dataset
    metrics = dq_metrics(every, silver.environment, dataset.name, dataset.dq_alert_percent)
    together(
        partial(upsert_silver, silver, valid),
        partial(quarantine_rows, silver, invalid, pending),
        partial(record_metrics, silver, metrics),
    )
    mark_processed(silver, pending)
    processed = every.count()
    forget_assessed(silver)
    return processed


def run_snapshot(silver: Silver, delete_missing: bool = False) -> int:
    """Process the bronze table as the source's current state, without a control table.

    Keys gone from the source stay in silver unless ``delete_missing``. Returns the number
    of rows processed.
    """
    dataset = silver.dataset
    every, valid, invalid = assessed_rows(silver, silver.bronze.read())
    batch_id = F.coalesce(F.max("_batch_id"), F.lit(f"snapshot_{dataset.name}"))
    metrics = dq_metrics(
        every, silver.environment, dataset.name, dataset.dq_alert_percent, batch_id=batch_id
    )

    def store_valid() -> None:
        if delete_missing:
            current = transform(valid, dataset, silver.environment)
            silver.table.overwrite(cut_into(current, silver.piece(), silver.buckets))
        else:
            upsert_silver(silver, latest_snapshot(valid, dataset.key))

    together(
        store_valid,
        partial(quarantine_rows, silver, invalid, every.select("_batch_id")),
        partial(record_metrics, silver, metrics),
    )
    processed = every.count()
    forget_assessed(silver)
    return processed


def run_silver(silver: Silver) -> int:
    return run_snapshot(silver) if silver.dataset.snapshot else run_incremental(silver)
