"""Facts and dimensions of the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.datasets import DATASETS
from millrace.functions.calendar import calendar_columns

LINEAGE = ("_ingestion_timestamp", "_source_file")


def fact_orders(orders: DataFrame) -> DataFrame:
    """One row per order with gross and net amount; an unknown discount counts as none."""
    gross = F.col("quantity") * F.col("unit_price")
    # The fact's columns.
    return orders.select(
        "order_id",
        "customer_id",
        "product_id",
        "order_date",
        "quantity",
        "unit_price",
        "discount_amount",
        gross.alias("gross_amount"),
        (gross - F.coalesce("discount_amount", F.lit(0.0))).alias("net_sales_amount"),
        "payment_method",
        "order_status",
        *LINEAGE,
    )


def fact_returns(returns: DataFrame) -> DataFrame:
    # The fact's columns.
    return returns.select(
        "return_id",
        "order_id",
        "customer_id",
        "product_id",
        "return_date",
        "return_quantity",
        "refund_amount",
        "return_reason",
        "return_status",
        *LINEAGE,
    )


def dim_customer(customers: DataFrame) -> DataFrame:
    """Current attributes only; the history is kept by ``scd2_merge``."""
    return customers.select(*DATASETS["customers"].columns)


def dim_product(products: DataFrame) -> DataFrame:
    return products.select(*DATASETS["products"].columns)


def dim_date(bounds: DataFrame, first: Column, last: Column) -> DataFrame:
    """Every day from ``first`` to ``last`` of a one-row frame, with calendar attributes."""
    days = bounds.select(
        F.explode(F.sequence(first, last, F.expr("interval 1 day"))).alias("date")
    )
    return days.select("date", *[c.alias(n) for n, c in calendar_columns("date").items()])
