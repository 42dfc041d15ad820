"""Calendar attributes of a date column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def calendar_columns(name: str) -> dict[str, Column]:
    """Week is the ISO week; day_of_week counts from Sunday = 1. The names."""
    day = F.col(name)
    return {
        "date_key": F.date_format(day, "yyyyMMdd").cast("int"),
        "year": F.year(day),
        "quarter": F.quarter(day),
        "month": F.month(day),
        "month_name": F.date_format(day, "MMMM"),
        "week_of_year": F.weekofyear(day),
        "day_of_month": F.dayofmonth(day),
        "day_of_week": F.dayofweek(day),
        "day_name": F.date_format(day, "EEEE"),
    }
