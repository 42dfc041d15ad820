"""Tests on text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_blank(name: str) -> Column:
    """NULL, empty, or spaces only. A tab is not blank: ``trim`` strips spaces."""
    value = F.col(name)
    return value.isNull() | (F.trim(value.cast("string")) == "")


def has_text(name: str, columns: list[str]) -> Column:
    """True where an optional technical column exists and is not blank."""
    if name not in columns:
        return F.lit(False)
    return F.col(name).isNotNull() & (F.length(F.trim(F.col(name))) > 0)
