"""One row per key, chosen by a total order so that every run picks the same one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

RECENCY = ("_ingestion_timestamp", "_batch_id")


def recency_order(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    """Newest first; ties by source file, then by every other column as it stands."""
    newest = [F.col(c).desc_nulls_last() for c in RECENCY if c in df.columns]
    rest = [c for c in df.columns if c not in keys and c not in RECENCY]
    rest.sort(key=lambda c: c != "_source_file")
    return newest + [F.col(c).asc_nulls_first() for c in rest]


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """``row_number() = 1``.

    Spark turns this filter into a group limit that runs before the shuffle too, so a
    key with a third of all rows sends one row per input partition, not all of them.
    """
    window = Window.partitionBy(*keys).orderBy(*(order or [F.lit(1)]))
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def latest_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return first_per_key(df, keys, recency_order(df, keys))


# A mutable snapshot source holds several versions of a key; its current state is the newest.
latest_snapshot = latest_per_key


def any_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keep one row per key where rows are meant to agree: the smallest, not a random one."""
    rest = [c for c in df.columns if c not in keys]
    return first_per_key(df, keys, [F.col(c).asc_nulls_first() for c in rest])
