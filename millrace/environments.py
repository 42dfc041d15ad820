"""Where an environment keeps its drops, tables and checkpoints."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from millrace.datasets import DATASETS, Dataset
from millrace.sources.lake import Lake

# The environments a job may run in.
NAMES = ("dev", "staging", "prod")


@dataclass(frozen=True)
class Environment:
    """``root`` must be storage that every executor reaches.

    ``buckets`` is the number of pieces a batch is cut into in the silver table of a
    dataset, 1 if it names none; a piece should hold about a gigabyte.
    """

    name: str
    root: str
    raw_root: str
    buckets: Mapping[str, int] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.name not in NAMES:
            raise ValueError(f"unknown environment {self.name!r}, expected one of {NAMES}")

    def lake(self, spark: SparkSession) -> Lake:
        return Lake(spark, f"{self.root.rstrip('/')}/retail_{self.name}")

    def drops(self, dataset: Dataset) -> str:
        return f"{self.raw_root.rstrip('/')}/{dataset.source_path}"

    def checkpoint(self, dataset: Dataset) -> str:
        return f"{self.root.rstrip('/')}/checkpoints/{self.name}/{dataset.source_path}"


def dataset(name: str) -> Dataset:
    if name not in DATASETS:
        raise ValueError(f"unknown dataset {name!r}, expected one of {sorted(DATASETS)}")
    return DATASETS[name]


def new_batch_id(dataset: Dataset, at: dt.datetime | None = None) -> str:
    """Ids of a dataset sort by time."""
    moment = at or dt.datetime.now(dt.timezone.utc)
    return f"{dataset.name}_{moment:%Y%m%d%H%M%S}"
