"""The supplied star-schema tables seen as the six retail datasets.

Each frame holds the dataset's columns plus the technical columns of a bronze row
(``_ingestion_timestamp``, ``_source_file``, ``_batch_id``). Some mappings put in the
defects that quality rules exist for: addresses without ``@``, missing segments,
promotions that end before they start or give more than 100 %.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.datasets import DATASETS
from millrace.operators.latest import latest_per_key
from millrace.sources.dealt import LEAST_BYTES, MOST_BYTES, buckets_for, dealt
from millrace.sources.lake import bytes_under

TECHNICAL = ("_ingestion_timestamp", "_source_file", "_batch_id")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _technical(source: str, moment: Column, daily: bool = False) -> list[Column]:
    """Batches are months, or days, written as yyyyMM or yyyyMMdd."""
    batch = F.year(moment) * 100 + F.month(moment)
    if daily:
        batch = batch * 100 + F.dayofmonth(moment)
    return [
        moment.cast("timestamp_ntz").alias("_ingestion_timestamp"),
        F.lit(source).alias("_source_file"),
        F.concat(F.lit(f"{source}_"), batch.cast("string")).alias("_batch_id"),
    ]


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nation and region have 25 and 5 rows at every scale, so both joins broadcast."""
    key = F.col("c_custkey")
    name = F.split("c_name", "#")
    signup = F.date_add(F.lit("1995-01-01").cast("date"), (key % 2000).cast("int"))
    return (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            key.cast("string").alias("customer_id"),
            name[0].alias("first_name"),
            name[1].alias("last_name"),
            F.concat(
                F.lit("c"),
                key.cast("string"),
                F.when(key % 37 == 0, F.lit(".example.com")).otherwise(F.lit("@example.com")),
            ).alias("email"),
            F.col("n_name").alias("city"),
            F.col("n_name").alias("state"),
            F.col("r_name").alias("country"),
            signup.alias("signup_date"),
            F.when(key % 41 != 0, F.col("c_mktsegment")).alias("customer_segment"),
            *_technical("customers", signup),
        )
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.split("p_name", " ")[1].alias("subcategory"),
        F.col("p_brand").alias("brand"),
        F.col("p_retailprice").alias("unit_price"),
        F.lit("USD").alias("currency"),
        *_technical("products", F.lit("1995-01-01").cast("date")),
    )


LINE_KEY = ("l_orderkey", "l_linenumber")
DELIVERED = "_ingestion_timestamp"


def _delivered_lines(
    spark: SparkSession, sf_dir: str, tables: tuple[DataFrame, DataFrame] | None = None
) -> DataFrame:
    """Lines with their order's columns, known by ``LINE_KEY`` still."""
    lineitem, orders = tables or (table(spark, sf_dir, name) for name in ("lineitem", "orders"))
    return (
        lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            *LINE_KEY,
            F.col("o_custkey").cast("string").alias("customer_id"),
            F.col("l_partkey").cast("string").alias("product_id"),
            F.col("o_orderdate").cast("date").alias("order_date"),
            F.col("l_quantity").cast("int").alias("quantity"),
            (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
            F.when(
                F.col("l_partkey") % 29 != 0, F.col("l_extendedprice") * F.col("l_discount")
            ).alias("discount_amount"),
            F.col("o_orderpriority").alias("payment_method"),
            F.col("o_orderstatus").alias("order_status"),
            F.col("l_suppkey").alias("supplier_id"),
            F.col("l_tax").alias("tax"),
            F.col("l_returnflag").alias("line_flag"),
            F.col("l_linestatus").alias("line_status"),
            (F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))).alias("line_value"),
            F.col("l_shipdate").alias(DELIVERED),
        )
    )


def dealt_lines(spark: SparkSession, sf_dir: str, folder: str) -> tuple[DataFrame, DataFrame] | None:
    """Lineitem and orders stored in buckets by order, for several readers; None if that does not pay."""
    size = bytes_under(spark, f"{sf_dir}/lineitem.parquet")
    if not LEAST_BYTES <= size <= MOST_BYTES:
        return None
    buckets = buckets_for(spark, size)
    lineitem, orders = (table(spark, sf_dir, name) for name in ("lineitem", "orders"))
    return (
        dealt(lineitem, f"{folder}/lineitem", ["l_orderkey"], buckets),
        dealt(orders.drop("o_totalprice"), f"{folder}/orders", ["o_orderkey"], buckets),
    )


def _named(lines: DataFrame) -> DataFrame:
    own = [c for c in lines.columns if c not in (*LINE_KEY, DELIVERED)]
    order_id = F.concat_ws("-", *LINE_KEY).alias("order_id")
    return lines.select(order_id, *own, *_technical("orders", F.col(DELIVERED)))


def order_lines(
    spark: SparkSession, sf_dir: str, tables: tuple[DataFrame, DataFrame] | None = None
) -> DataFrame:
    """Order rows as delivered: an order id occurs several times, in several batches.

    Columns after the dataset's own (from ``supplier_id``) carry what returns need and
    make any two deliveries distinguishable.
    """
    return _named(_delivered_lines(spark, sf_dir, tables))


def raw_orders(
    spark: SparkSession, sf_dir: str, tables: tuple[DataFrame, DataFrame] | None = None
) -> DataFrame:
    """``order_lines`` in the shape of the orders dataset, repeated ids included."""
    return order_lines(spark, sf_dir, tables).select(*DATASETS["orders"].columns, *TECHNICAL)


def latest_order_lines(
    spark: SparkSession, sf_dir: str, tables: tuple[DataFrame, DataFrame] | None = None
) -> DataFrame:
    """One row per order id: its latest delivery.

    The key's two columns make the id, so lines that a join has dealt out by order are not
    shuffled again, and the moment makes the batch, so neither text is moved.
    """
    return _named(latest_per_key(_delivered_lines(spark, sf_dir, tables), LINE_KEY))


def orders_of(lines: DataFrame) -> DataFrame:
    """The orders among deduplicated lines."""
    return lines.select(*DATASETS["orders"].columns, *TECHNICAL)


def returns_of(lines: DataFrame) -> DataFrame:
    """A return for each of the deduplicated lines that is flagged as returned."""
    return lines.filter(F.col("line_flag") == "R").select(
        F.concat(F.lit("R-"), "order_id").alias("return_id"),
        "order_id",
        "customer_id",
        "product_id",
        F.col("_ingestion_timestamp").cast("date").alias("return_date"),
        F.col("quantity").alias("return_quantity"),
        F.col("line_status").alias("return_reason"),
        F.col("line_value").alias("refund_amount"),
        F.col("order_status").alias("return_status"),
        *TECHNICAL,
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order id: its latest delivery."""
    return orders_of(latest_order_lines(spark, sf_dir))


def returns(
    spark: SparkSession, sf_dir: str, tables: tuple[DataFrame, DataFrame] | None = None
) -> DataFrame:
    """A return for each order whose latest delivery is flagged as returned."""
    return returns_of(latest_order_lines(spark, sf_dir, tables))


def clickstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    user = F.col("user_id").cast("string")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("event_id"),
        user.alias("customer_id"),
        F.col("ts").alias("event_timestamp"),
        "event_type",
        F.concat(F.lit("/"), "event_type").alias("page_url"),
        F.get_json_object("props", "$.k").alias("product_id"),
        F.lit(None).cast("string").alias("device_type"),
        F.concat_ws("-", user, F.date_format("ts", "yyyy-MM-dd")).alias("session_id"),
        *_technical("clickstream", F.col("ts"), daily=True),
    )


def promotions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part is on promotion; large ones by more than 100 %, small ones end too early."""
    key, size = F.col("p_partkey"), F.col("p_size")
    start = F.date_add(F.lit("1996-01-01").cast("date"), (key % 365).cast("int"))
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("P-"), key.cast("string")).alias("promotion_id"),
        F.col("p_name").alias("promotion_name"),
        key.cast("string").alias("product_id"),
        start.alias("start_date"),
        F.date_add(start, size - 3).alias("end_date"),
        (size * 2.5).alias("discount_percent"),
        F.col("p_type").alias("promotion_type"),
        F.lit("ACTIVE").alias("status"),
        *_technical("promotions", F.lit("1996-01-01").cast("date")),
    )


FRAMES = {
    "customers": customers,
    "products": products,
    "orders": raw_orders,
    "clickstream": clickstream,
    "returns": returns,
    "promotions": promotions,
}
