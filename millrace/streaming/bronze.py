"""File stream into bronze, exactly once per micro-batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.datasets import Dataset
from millrace.operators.ingest_metrics import ingestion_metrics
from millrace.sources.csv_drops import as_bronze, by_name, stream_lines
from millrace.sources.lake import Lake, sliced


def stream_id(batch: DataFrame) -> str:
    """The stream's id, which stays the same for as long as its checkpoint is kept."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


def micro_batch_writer(
    lake: Lake, dataset: Dataset, environment: str, batch_id: str
) -> Callable[[DataFrame, int], None]:
    """Write a micro-batch as its own slice, then measure what was written.

    The checkpoint names the stream and numbers its micro-batches. A retried one comes with
    the same name and number, under a new batch id if the job was restarted, and replaces
    itself in the table and in the metrics. A stream with a new checkpoint has another name,
    so it adds to what is stored.
    """

    def write(batch: DataFrame, micro_batch_id: int) -> None:
        name = f"mb-{stream_id(batch)}-{micro_batch_id}"
        bronze = lake.table("bronze", dataset.name)
        bronze.replace_slices(sliced(batch, F.lit(name)), [name])
        metrics = ingestion_metrics(
            bronze.read([name]),
            environment,
            dataset.name,
            batch_id,
            micro_batch_id,
            dataset.ingest_alert_percent,
        )
        lake.table("monitoring", f"bronze_ingestion_metrics/{dataset.name}").replace_slices(
            sliced(metrics, F.lit(name)), [name]
        )

    return write


def ingest_stream(
    lake: Lake,
    dataset: Dataset,
    source_path: str,
    checkpoint: str,
    environment: str,
    batch_id: str,
    files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Take in every file that is new since the checkpoint, then stop."""
    write = micro_batch_writer(lake, dataset, environment, batch_id)

    def take_in(lines: DataFrame, micro_batch_id: int) -> None:
        write(as_bronze(by_name(lines, dataset), dataset, environment, batch_id), micro_batch_id)

    query = (
        stream_lines(lake.spark, source_path, files_per_trigger)
        .writeStream.foreachBatch(take_in)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
