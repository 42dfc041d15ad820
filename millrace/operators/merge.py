"""Upserts and deletes as whole-table expressions: old rows in, new rows out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.latest import any_per_key, latest_per_key


def upsert_by_key(
    target: DataFrame | None,
    source: DataFrame,
    keys: Sequence[str],
    source_is_unique: bool = False,
) -> DataFrame:
    """Source rows replace target rows of equal key, the rest of both stays.

    A NULL key equals nothing, so such rows are kept and inserted. The source is made
    unique first unless the caller knows it is; on first load as well.
    """
    incoming = source if source_is_unique else any_per_key(source, keys)
    if target is None:
        return incoming
    kept = target.join(incoming.select(*keys), list(keys), "left_anti")
    return kept.unionByName(incoming, allowMissingColumns=True)


def upsert_latest(
    target: DataFrame | None, source: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """Upsert in which an older incoming row never replaces a newer stored one."""
    rows = source if target is None else target.unionByName(source, allowMissingColumns=True)
    return latest_per_key(rows, keys)


def insert_absent(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add source rows whose key the target lacks; never change a target row."""
    added = absent_from(any_per_key(source, keys), target, keys)
    return target.unionByName(added, allowMissingColumns=True)


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Drop rows where the condition is true; where it is NULL the row stays."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


def absent_from(source: DataFrame, existing: DataFrame, identity: Sequence[str]) -> DataFrame:
    """Source rows whose identity does not occur in ``existing``.

    Repeated identities are dropped before the shuffle, as a join would split a hot key
    of the left side only.
    """
    known = existing.select(*identity).distinct()
    return source.join(known, list(identity), "left_anti")


def unprocessed_batches(rows: DataFrame, control: DataFrame | None, dataset: str) -> DataFrame:
    """Batch ids present in ``rows`` and not marked for the dataset."""
    batches = rows.filter(F.col("_batch_id").isNotNull()).select("_batch_id").distinct()
    if control is None:
        return batches
    return absent_from(batches, control.filter(F.col("dataset") == dataset), ["_batch_id"])
