"""Type-2 history of customers, merged in one pass."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.latest import latest_per_key

CUSTOMER_KEY = "customer_id"
TRACKED = (
    "first_name", "last_name", "email", "city", "state", "country", "signup_date",
    "customer_segment",
)
OPEN_END = dt.date(9999, 12, 31)
VALIDITY = ("effective_start_date", "effective_end_date", "is_current")


def _day(as_of: dt.date | None) -> Column:
    return F.current_date() if as_of is None else F.lit(as_of)


def customer_versions(customers: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Customer attributes as open versions that start on ``as_of``."""
    return customers.select(
        CUSTOMER_KEY,
        *TRACKED,
        _day(as_of).alias("effective_start_date"),
        F.lit(OPEN_END).alias("effective_end_date"),
        F.lit(True).alias("is_current"),
    )


def differs(left: str, right: str, tracked: Sequence[str] = TRACKED) -> Column:
    """True where any tracked attribute differs; two NULLs do not differ."""
    return reduce(
        or_, (~F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in tracked)
    )


def changed_customers(target: DataFrame, customers: DataFrame) -> DataFrame:
    """Customers whose attributes differ from their current version."""
    s = customers.select(CUSTOMER_KEY, *TRACKED).alias("s")
    t = target.filter("is_current").alias("t")
    return s.join(t, F.col(f"s.{CUSTOMER_KEY}") == F.col(f"t.{CUSTOMER_KEY}")).filter(
        differs("t", "s")
    ).select("s.*")


def new_customers(target: DataFrame, customers: DataFrame) -> DataFrame:
    """Customers that have no current version."""
    current = target.filter("is_current").select(CUSTOMER_KEY)
    return customers.select(CUSTOMER_KEY, *TRACKED).join(current, CUSTOMER_KEY, "left_anti")


def scd2_merge(
    target: DataFrame | None, customers: DataFrame, as_of: dt.date | None = None
) -> DataFrame:
    """The dimension after ``customers`` became known on ``as_of``.

    One full outer join with the source, which only current versions can match, emits per
    stored version itself (kept, or closed the day before) and, if a customer is new or
    changed, an open version. The target is read once. A version that already started on
    ``as_of`` is replaced, as closing it would end it before its start. Keys missing from the
    source stay open.
    """
    source = latest_per_key(customers, [CUSTOMER_KEY])
    if target is None:
        return customer_versions(source, as_of)

    today = _day(as_of)
    t = target.withColumn("_known", F.lit(True)).alias("t")
    s = source.select(CUSTOMER_KEY, *TRACKED).withColumn("_seen", F.lit(True)).alias("s")
    same = (F.col(f"t.{CUSTOMER_KEY}") == F.col(f"s.{CUSTOMER_KEY}")) & F.col("t.is_current")
    pairs = t.join(s, same, "full_outer")

    known, seen = F.col("t._known").isNotNull(), F.col("s._seen").isNotNull()
    changed = known & seen & differs("t", "s")
    started_before = F.col("t.effective_start_date") < today

    def version(emit: Column, side: str, start: Column, end: Column, current: Column) -> Column:
        return F.struct(
            emit.alias("_emit"),
            *[F.col(f"{side}.{c}").alias(c) for c in (CUSTOMER_KEY, *TRACKED)],
            start.alias("effective_start_date"),
            end.alias("effective_end_date"),
            current.alias("is_current"),
        )

    stored = version(
        known & (~changed | started_before),
        "t",
        F.col("t.effective_start_date"),
        F.when(changed, F.date_sub(today, 1)).otherwise(F.col("t.effective_end_date")),
        F.col("t.is_current") & ~changed,
    )
    opened = version(
        seen & (~known | changed),
        "s",
        F.when(changed & ~started_before, F.col("t.effective_start_date")).otherwise(today),
        F.lit(OPEN_END),
        F.lit(True),
    )
    return pairs.select(F.inline(F.array(stored, opened))).filter("_emit").drop("_emit")
