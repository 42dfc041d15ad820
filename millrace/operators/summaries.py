"""Sales and revenue summaries over the facts.

``order_id`` is the key of the order fact. Where the caller's orders are known to hold
each id once (the gold fact is upserted by it), ``unique_orders=True`` counts rows: an
ordinary map-side sum in place of a second shuffle of every order id.

Amounts are added as the doubles they are: nothing is rounded on the way, and every size of
group takes the same path. The last digits of a total follow the order of addition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names of measures, here and in the aliases below.
MEASURES = ("quantity", "gross_amount", "discount_amount", "net_sales_amount")


def _order_measures(unique_orders: bool) -> list[Column]:
    orders = F.count("order_id") if unique_orders else F.countDistinct("order_id")
    return [
        orders.alias("order_count"),
        F.sum("quantity").alias("units_sold"),
        F.sum("gross_amount").alias("gross_sales_amount"),
        F.sum("discount_amount").alias("discount_amount"),
        F.sum("net_sales_amount").alias("net_sales_amount"),
    ]


def customer_sales(orders: DataFrame, unique_orders: bool = False) -> DataFrame:
    return orders.groupBy("customer_id").agg(*_order_measures(unique_orders))


def product_sales(orders: DataFrame, unique_orders: bool = False) -> DataFrame:
    return orders.groupBy("product_id").agg(*_order_measures(unique_orders))


def return_summary(returns: DataFrame, *keys: str) -> DataFrame:
    """Refund and returned units per order, or per the given keys."""
    return returns.groupBy(*(keys or ("order_id",))).agg(
        F.sum("refund_amount").alias("refund_amount"),
        F.sum("return_quantity").alias("returned_units"),
    )


def sold(orders: DataFrame) -> DataFrame:
    """What refunds need of an order."""
    return orders.select("order_id", "order_date", "customer_id", "product_id")


def refunded(returns: DataFrame) -> DataFrame:
    """What a refund is of a return; those of nothing add nothing."""
    return returns.filter(F.col("refund_amount") != 0).select("order_id", "product_id", "refund_amount")


def refunds_on_orders(orders: DataFrame, returns: DataFrame) -> DataFrame:
    """Refunds of known orders, with the order's date, customer and product: a row per return.

    Only four narrow columns of the fact meet the returns. The join is inner, so its
    output is as small as the returns, and the fact is not shuffled if those broadcast.
    Beyond that Spark puts a Bloom filter of the returned orders before the fact's shuffle
    (``size_for`` sets up to what size): for this the returns are joined as they are stored,
    not summed first, and only those that refund something, as others add nothing.
    """
    refunds = refunded(returns).withColumnRenamed("product_id", "returned_product_id")
    return sold(orders).join(refunds, "order_id")


#: Sums that add up: partial ones of some orders each give those of all orders.
ADDED = (
    "order_count", "units_sold", "gross_sales_amount", "discount_amount", "net_sales_amount",
    "refund_amount",
)


def _stacked_sums(
    orders: DataFrame, refunds: DataFrame, keys: Sequence[str], unique_orders: bool
) -> DataFrame:
    stacked = orders.select(*keys, "order_id", *MEASURES).unionByName(
        refunds.select(*keys, "refund_amount"), allowMissingColumns=True
    )
    return stacked.groupBy(*keys).agg(
        *_order_measures(unique_orders), F.sum("refund_amount").alias("refund_amount")
    )


def _net(sums: DataFrame) -> DataFrame:
    refund = F.coalesce("refund_amount", F.lit(0.0))
    return sums.withColumns(
        {"refund_amount": refund, "net_revenue": F.col("net_sales_amount") - refund}
    )


def revenue_by(
    orders: DataFrame, refunds: DataFrame, key: str, unique_orders: bool = False
) -> DataFrame:
    """Sales, refunds and net revenue per ``key``.

    Orders and refunds are stacked and aggregated together, so the wide fact is summed
    where it is read and never shuffled row by row. The refund follows the order: its
    date, its customer. Returns of unknown orders are not in ``refunds``.
    """
    return _net(_stacked_sums(orders, refunds, [key], unique_orders))


def partial_revenue(orders: DataFrame, refunds: DataFrame, piece: str, key: str) -> DataFrame:
    """Sums per ``key`` of each ``piece`` of the orders, each order id being in one row only."""
    return _stacked_sums(orders, refunds, [piece, key], True)


def revenue_of_partials(partials: DataFrame, key: str) -> DataFrame:
    """What ``revenue_by`` gives for unique orders, from the sums of their pieces."""
    return _net(partials.groupBy(key).agg(*[F.sum(c).alias(c) for c in ADDED]))


def daily_sales(orders: DataFrame, returns: DataFrame, unique_orders: bool = False) -> DataFrame:
    return revenue_by(orders, refunds_on_orders(orders, returns), "order_date", unique_orders)


def monthly_from_daily(daily: DataFrame) -> DataFrame:
    """Roll the daily summary up; a few thousand rows in, whatever the fact's size."""
    money = (
        "gross_sales_amount", "discount_amount", "net_sales_amount", "refund_amount",
        "net_revenue",
    )
    return daily.groupBy(
        F.year("order_date").alias("year"), F.month("order_date").alias("month")
    ).agg(
        F.sum("order_count").alias("order_count"),
        F.sum("units_sold").alias("units_sold"),
        *[F.sum(m).alias(m) for m in money],
    )


def monthly_sales(orders: DataFrame, returns: DataFrame, unique_orders: bool = False) -> DataFrame:
    return monthly_from_daily(daily_sales(orders, returns, unique_orders))


def customer_revenue(
    orders: DataFrame, returns: DataFrame, unique_orders: bool = False
) -> DataFrame:
    return revenue_by(orders, refunds_on_orders(orders, returns), "customer_id", unique_orders)


def own_product(refunds: DataFrame) -> DataFrame:
    """Refunds whose return names the product of the order."""
    return refunds.filter(F.col("returned_product_id") == F.col("product_id"))


def product_revenue(
    orders: DataFrame, returns: DataFrame, unique_orders: bool = False
) -> DataFrame:
    """A refund counts for a product only if the return names the order's product."""
    refunds = own_product(refunds_on_orders(orders, returns))
    return revenue_by(orders, refunds, "product_id", unique_orders)


def promotion_products(promotions: DataFrame, products: DataFrame) -> DataFrame:
    """Promotions with the attributes of their product, NULL where it is unknown."""
    attributes = ["product_name", "category", "subcategory", "brand"]
    return promotions.join(
        products.select("product_id", *attributes), "product_id", "left"
    ).select(
        "promotion_id", "promotion_name", "product_id", *attributes, "start_date", "end_date",
        "discount_percent",
    )
