"""One query per operator and job, each over whole supplied tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import replace
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.datasets import DATASETS, STRICT_GATE, Rule
from millrace.operators import checks, scd2, star, summaries
from millrace.operators.columns import (
    require_columns,
    require_non_empty,
    stamp_ingestion,
    stamp_silver,
    standardize_columns,
)
from millrace.operators.ingest_metrics import METRIC_KEY, ingestion_metrics
from millrace.operators.latest import any_per_key, latest_per_key, latest_snapshot
from millrace.operators.merge import (
    absent_from,
    delete_where,
    insert_absent,
    unprocessed_batches,
    upsert_by_key,
    upsert_latest,
)
from millrace.operators.quality import assess, dq_metrics, split
from millrace.operators.rescue import type_and_rescue
from millrace.functions.calendar import calendar_columns
from millrace.plans.gold import build_gold
from millrace.plans.qa import run_qa
from millrace.plans.reprocess import identity, reprocess_batch
from millrace.plans.run_log import logged, read_run_log
from millrace.plans.silver import (
    Silver,
    quarantine_rows,
    run_incremental,
    run_silver,
    run_snapshot,
    transform,
)
from millrace.plans.snapshot import ingest_snapshot
from millrace.plans.together import together
from millrace.session import delete_dir, frugal, scratch_dir
from millrace.sources import supplied as src
from millrace.sources.lake import CODEC, Lake, sliced
from millrace.streaming.bronze import ingest_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

ENVIRONMENT = "test"
CUT = "orders_199806"
DAY_ONE, DAY_TWO = dt.date(2024, 1, 1), dt.date(2024, 2, 1)

ORDERS = DATASETS["orders"]
CUSTOMERS = DATASETS["customers"]
PROMOTIONS = DATASETS["promotions"]


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def new_lake(spark: SparkSession, purpose: str) -> Lake:
    return Lake(spark, scratch_dir(spark, purpose))


def kept(df: DataFrame, purpose: str) -> DataFrame:
    """Written to the shared folder once, for a query that uses it several times."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path, compression=CODEC)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def both_facts(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Orders and returns from one deduplication of the lines."""
    lines = kept(src.latest_order_lines(spark, sf), "lines")
    return star.fact_orders(src.orders_of(lines)), star.fact_returns(src.returns_of(lines))


# -- star schema and projections ---------------------------------------------------


def orders_fact(spark: SparkSession, sf: str) -> DataFrame:
    return star.fact_orders(src.orders(spark, sf))


def returns_fact(spark: SparkSession, sf: str) -> DataFrame:
    return star.fact_returns(src.returns(spark, sf))


@query
def fact_orders(spark, sf):
    return orders_fact(spark, sf)


@query
def fact_returns(spark, sf):
    return returns_fact(spark, sf)


@query
def dim_customer(spark, sf):
    return star.dim_customer(src.customers(spark, sf))


@query
def dim_product(spark, sf):
    return star.dim_product(src.products(spark, sf))


@query
def dim_date(spark, sf):
    """Every day the orders span."""
    span = src.table(spark, sf, "orders").agg(
        F.min("o_orderdate").cast("date").alias("first"),
        F.max("o_orderdate").cast("date").alias("last"),
    )
    return star.dim_date(span, F.col("first"), F.col("last"))


@query
def standardize_columns_(spark, sf):
    messy = src.table(spark, sf, "customer").select(
        F.col("c_custkey").alias(" Customer_Key"),
        F.col("c_name").alias("NAME "),
        F.col("c_mktsegment").alias("Segment.Code"),
    )
    return standardize_columns(messy)


@query
def ingest_metadata(spark, sf):
    rows = src.customers(spark, sf).select(*CUSTOMERS.columns)
    return stamp_ingestion(
        require_columns(rows, CUSTOMERS.key),
        ENVIRONMENT,
        "customers_20240101",
        F.lit("customers"),
        dt.datetime(2024, 1, 1, 12),
    ).drop("_ingestion_timestamp")


@query
def silver_metadata(spark, sf):
    rows = src.clickstream(spark, sf).select(*DATASETS["clickstream"].columns)
    return stamp_silver(rows, ENVIRONMENT).drop("_silver_timestamp")


# -- summaries ---------------------------------------------------------------------
# The adapter keeps one row per order id, so these count rows.


def to_cents(df: DataFrame) -> DataFrame:
    """Finished totals to four decimals: further digits follow the order of addition."""
    return df.withColumns({c: F.round(c, 4) + 0.0 for c, kind in df.dtypes if kind == "double"})


@query
def customer_sales(spark, sf):
    return to_cents(summaries.customer_sales(orders_fact(spark, sf), unique_orders=True))


@query
def product_sales(spark, sf):
    return to_cents(summaries.product_sales(orders_fact(spark, sf), unique_orders=True))


@query
def return_summary(spark, sf):
    return to_cents(summaries.return_summary(returns_fact(spark, sf)))


@query
def return_summary_by_product(spark, sf):
    return to_cents(summaries.return_summary(returns_fact(spark, sf), "order_id", "product_id"))


@query
def daily_sales(spark, sf):
    return to_cents(summaries.daily_sales(*both_facts(spark, sf), True))


@query
def monthly_sales(spark, sf):
    return to_cents(summaries.monthly_sales(*both_facts(spark, sf), True))


@query
def customer_revenue(spark, sf):
    return to_cents(summaries.customer_revenue(*both_facts(spark, sf), True))


@query
def product_revenue(spark, sf):
    return to_cents(summaries.product_revenue(*both_facts(spark, sf), True))


@query
def promotion_products(spark, sf):
    return summaries.promotion_products(src.promotions(spark, sf), src.products(spark, sf))


# -- quality rules -----------------------------------------------------------------


def judged(df: DataFrame, columns: list[str], *rules: Rule, required=()) -> DataFrame:
    return assess(df, required, rules).select(*columns, "_quality_reason", "_quality_status")


@query
def dq_required(spark, sf):
    return judged(src.customers(spark, sf), ["customer_id"], required=CUSTOMERS.required)


@query
def dq_regex(spark, sf):
    return judged(src.customers(spark, sf), ["customer_id", "email"], *CUSTOMERS.rules)


@query
def dq_not_empty(spark, sf):
    rule = Rule("customer_segment", "not_empty", "segment is empty")
    return judged(src.customers(spark, sf), ["customer_id", "customer_segment"], rule)


@query
def dq_gt(spark, sf):
    rule = Rule("quantity", "greater_than", "quantity must be > 5", 5)
    return judged(src.raw_orders(spark, sf), ["order_id", "quantity"], rule)


@query
def dq_gte(spark, sf):
    rule = Rule("discount_amount", "greater_than_or_equal", "discount must be >= 100", 100)
    return judged(src.raw_orders(spark, sf), ["order_id", "discount_amount"], rule)


@query
def dq_lt(spark, sf):
    rule = Rule("quantity", "less_than", "quantity must be < 45", 45)
    return judged(src.raw_orders(spark, sf), ["order_id", "quantity"], rule)


@query
def dq_lte(spark, sf):
    rule = Rule("discount_percent", "less_than_or_equal", "discount_percent must be <= 100", 100)
    return judged(src.promotions(spark, sf), ["promotion_id", "discount_percent"], rule)


@query
def dq_col_gte(spark, sf):
    rule = Rule(
        "end_date", "column_greater_than_or_equal", "end_date must be >= start_date", "start_date"
    )
    return judged(src.promotions(spark, sf), ["promotion_id", "start_date", "end_date"], rule)


@query
def dq_text_number(spark, sf):
    """A numeric rule on text: what is no number breaks it."""
    rule = Rule("o_orderpriority", "greater_than", "priority must be a number > 0", 0)
    return judged(src.table(spark, sf, "orders"), ["o_orderkey", "o_orderpriority"], rule)


@query
def dq_assemble(spark, sf):
    return judged(
        src.promotions(spark, sf),
        ["promotion_id"],
        *PROMOTIONS.rules,
        required=PROMOTIONS.required,
    )


def assessed_customers(spark: SparkSession, sf: str, spec=CUSTOMERS) -> DataFrame:
    return assess(src.customers(spark, sf), spec.required, spec.rules)


@query
def dq_split(spark, sf):
    valid, invalid = split(assessed_customers(spark, sf))
    return valid.select("customer_id", F.lit("silver").alias("destination")).unionByName(
        invalid.select("customer_id", F.lit("quarantine").alias("destination"))
    )


def customer_metrics(spark: SparkSession, sf: str, spec=CUSTOMERS) -> DataFrame:
    return dq_metrics(
        assessed_customers(spark, sf, spec), ENVIRONMENT, "customers", spec.dq_alert_percent
    )


@query
def dq_metrics_(spark, sf):
    return customer_metrics(spark, sf).drop("recorded_at")


@query
def dq_metrics_gate(spark, sf):
    """The rule set and threshold that once gated rows before bronze."""
    return customer_metrics(spark, sf, STRICT_GATE["customers"]).drop("recorded_at")


@query
def bronze_gate(spark, sf):
    """All five rule sets of the gate before bronze: what each would have held back."""
    found = None
    for name, spec in STRICT_GATE.items():
        rows = assess(src.FRAMES[name](spark, sf), spec.required, spec.rules)
        held = F.count_if(F.col("_quality_status") == "QUARANTINE")
        counts = rows.agg(F.count(F.lit(1)).alias("total_records"), held.alias("quarantined_records"))
        rate = 100.0 * F.col("quarantined_records") / F.col("total_records")
        status = F.when(rate > spec.dq_alert_percent, "FAIL").otherwise("PASS")
        row = counts.select(F.lit(name).alias("dataset"), "*", status.alias("gate"))
        found = row if found is None else found.unionByName(row)
    return found


# -- one row per key ---------------------------------------------------------------


@query
def dedup_latest(spark, sf):
    latest = latest_per_key(src.raw_orders(spark, sf), ORDERS.key)
    return latest.drop("_source_file")


@query
def latest_snapshot_(spark, sf):
    """Each customer's newest event; ties go to the smaller event id."""
    events = src.clickstream(spark, sf).select(
        "customer_id",
        F.col("event_id").cast("long").alias("event"),
        "event_timestamp",
        "event_type",
        "_ingestion_timestamp",
        "_batch_id",
    )
    newest = latest_snapshot(events, ["customer_id"])
    return newest.select("customer_id", "event_timestamp", "event_type")


@query
def dedup_deterministic(spark, sf):
    return any_per_key(src.raw_orders(spark, sf).select(*ORDERS.columns), ORDERS.key)


@query
def silver_transform(spark, sf):
    shouted = src.raw_orders(spark, sf)
    shouted = shouted.toDF(*[f" {c.upper()} " for c in shouted.columns])
    out = transform(shouted, ORDERS, ENVIRONMENT)
    return out.select(*ORDERS.columns, "_batch_id", "_silver_environment")


# -- upserts, deletes, control tables ----------------------------------------------


def early_and_late(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Deliveries up to the middle of the span, and those after it."""
    rows = src.raw_orders(spark, sf)
    return rows.filter(F.col("_batch_id") <= CUT), rows.filter(F.col("_batch_id") > CUT)


@query
def upsert_by_key_(spark, sf):
    early, late = early_and_late(spark, sf)
    merged = upsert_by_key(
        latest_per_key(early, ORDERS.key),
        kept(latest_per_key(late, ORDERS.key), "late"),
        ORDERS.key,
        source_is_unique=True,
    )
    return merged.select(*ORDERS.columns, "_batch_id")


@query
def upsert_newest_wins(spark, sf):
    """The late half is stored already; the early half arrives after it and wins nothing."""
    early, late = early_and_late(spark, sf)
    merged = upsert_latest(latest_per_key(late, ORDERS.key), early, ORDERS.key)
    return merged.select(*ORDERS.columns, "_batch_id")


@query
def upsert_first_load(spark, sf):
    return upsert_by_key(None, src.raw_orders(spark, sf).select(*ORDERS.columns), ORDERS.key)


def marks(batches: DataFrame, day: dt.date) -> DataFrame:
    return batches.select(
        F.lit("orders").alias("dataset"), "_batch_id", F.lit(day).alias("processed_on")
    )


@query
def mark_batches(spark, sf):
    rows = src.order_lines(spark, sf)
    every = unprocessed_batches(rows, None, "orders")
    first = marks(every.filter(F.col("_batch_id") <= CUT), DAY_ONE)
    return insert_absent(first, marks(every, DAY_TWO), ["dataset", "_batch_id"])


@query
def unprocessed_batches_(spark, sf):
    rows = src.order_lines(spark, sf)
    done = rows.filter(F.col("_batch_id") <= CUT).select("_batch_id").distinct()
    return unprocessed_batches(rows, marks(done, DAY_ONE), "orders")


@query
def metrics_upsert(spark, sf):
    """Later batches are measured again, under fewer required columns."""
    relaxed = replace(CUSTOMERS, required=("customer_id", "email"))
    again = customer_metrics(spark, sf, relaxed).filter("batch_id > 'customers_199706'")
    merged = upsert_by_key(customer_metrics(spark, sf), again, METRIC_KEY, source_is_unique=True)
    return merged.drop("recorded_at")


@query
def delete_by_predicate(spark, sf):
    """Orders without a discount have no opinion on the condition and stay."""
    rows = src.raw_orders(spark, sf).select(*ORDERS.columns)
    return delete_where(rows, F.col("discount_amount") > 5000)


@query
def snapshot_overwrite(spark, sf):
    """A table replaced by rows of another shape."""
    table = new_lake(spark, "snapshot").table("bronze", "catalogue")
    table.overwrite(src.promotions(spark, sf))
    table.overwrite(star.dim_product(src.products(spark, sf)))
    return table.read()


@query
def quarantine_write(spark, sf):
    """Written three times, the last time with a column more: no row comes twice."""
    silver = Silver(new_lake(spark, "quarantine"), CUSTOMERS, ENVIRONMENT)
    _, invalid = split(assessed_customers(spark, sf))
    batches = src.customers(spark, sf).select("_batch_id").distinct()
    quarantine_rows(silver, invalid, batches)
    quarantine_rows(silver, invalid, batches)
    quarantine_rows(silver, invalid.withColumn("region_added_later", F.col("country")), batches)
    return silver.quarantine.read().select(
        "customer_id", "_batch_id", "_quality_reason", "region_added_later"
    )


# -- customer history --------------------------------------------------------------


def first_day(spark: SparkSession, sf: str) -> DataFrame:
    return src.customers(spark, sf).filter(F.col("country") != "ASIA")


def corrected(spark: SparkSession, sf: str) -> DataFrame:
    """Day two: addresses and segments are put right, Europe is missing, Asia is new."""
    customers = src.customers(spark, sf).filter(F.col("country") != "EUROPE")
    repaired = F.regexp_replace("email", r"^(c\d+)\.", "$1@")
    return customers.withColumns(
        {
            "email": F.when(F.contains("email", F.lit("@")), F.col("email")).otherwise(repaired),
            "customer_segment": F.coalesce("customer_segment", F.lit("UNKNOWN")),
        }
    )


def moved(spark: SparkSession, sf: str) -> DataFrame:
    """Still day two: customers in America move."""
    new_city = F.when(
        F.col("country") == "AMERICA", F.concat("city", F.lit(" II"))
    ).otherwise(F.col("city"))
    return corrected(spark, sf).withColumn("city", new_city)


def history(spark: SparkSession, sf: str) -> DataFrame:
    day_one = scd2.scd2_merge(None, first_day(spark, sf), DAY_ONE)
    day_two = scd2.scd2_merge(day_one, corrected(spark, sf), DAY_TWO)
    return scd2.scd2_merge(day_two, moved(spark, sf), DAY_TWO)


@query
def scd2_source(spark, sf):
    return scd2.customer_versions(src.customers(spark, sf), DAY_ONE)


@query
def scd2_changed(spark, sf):
    target = scd2.customer_versions(first_day(spark, sf), DAY_ONE)
    return scd2.changed_customers(target, moved(spark, sf))


@query
def scd2_new(spark, sf):
    target = scd2.customer_versions(first_day(spark, sf), DAY_ONE)
    return scd2.new_customers(target, moved(spark, sf))


@query
def scd2_merge(spark, sf):
    return history(spark, sf)


# -- ingest ------------------------------------------------------------------------


def text_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as text, with dates or quantities that do not parse for two of the statuses."""
    status = F.col("o_orderstatus")
    iso, slashed = (F.date_format("o_orderdate", p) for p in ("yyyy-MM-dd", "yyyy/MM/dd"))
    return src.table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.when(status == "F", slashed).otherwise(iso).alias("order_date"),
        F.when(status == "P", F.col("o_orderpriority"))
        .otherwise(F.col("o_custkey").cast("string"))
        .alias("quantity"),
    )


def rescued_orders(spark: SparkSession, sf: str) -> DataFrame:
    schema = T.StructType.fromDDL(
        "order_id string, customer_id string, order_date date, quantity int"
    )
    return type_and_rescue(text_orders(spark, sf), schema, F.lit("orders"))


@query
def rescued_data(spark, sf):
    return rescued_orders(spark, sf)


@query
def ingestion_metrics_(spark, sf):
    rows = rescued_orders(spark, sf)
    return ingestion_metrics(rows, ENVIRONMENT, "orders", "orders_1", 7).drop("recorded_at")


def drop_csv(df: DataFrame, path: str) -> None:
    df.write.csv(path, header=True, mode="append")


def taken_in(spark: SparkSession, sf: str) -> Lake:
    """Three deliveries of orders: as declared; reordered and with a column more; short lines."""
    lake = new_lake(spark, "stream")
    drops, checkpoint = f"{lake.root}/drops", f"{lake.root}/checkpoint"
    early, late = (df.select(*ORDERS.columns) for df in early_and_late(spark, sf))
    drop_csv(early, drops)
    ingest_stream(lake, ORDERS, drops, checkpoint, ENVIRONMENT, "orders_1", 4)
    reordered = [*reversed(ORDERS.columns), F.col("payment_method").alias("line_note")]
    drop_csv(late.select(*reordered), drops)
    ingest_stream(lake, ORDERS, drops, checkpoint, ENVIRONMENT, "orders_2", 4)
    short = F.concat_ws(",", "o_orderkey", "o_custkey")
    with_header = F.concat_ws("\n", F.lit(",".join(ORDERS.columns)), short)
    src.table(spark, sf, "orders").select(with_header).write.mode("append").text(drops)
    ingest_stream(lake, ORDERS, drops, checkpoint, ENVIRONMENT, "orders_3", 4)
    return lake


@query
def bronze_stream_ingest(spark, sf):
    """All order rows and a drop of short lines, each taken in once, columns by name."""
    bronze = taken_in(spark, sf).table("bronze", "orders").read()
    return bronze.select(
        *ORDERS.columns,
        "_corrupt_record",
        F.get_json_object("_rescued_data", "$.line_note").alias("line_note"),
        F.contains("_source_file", F.lit("/drops/")).alias("has_file"),
        "_batch_id",
    )


@query
def bronze_stream_metrics(spark, sf):
    """What was measured of the three deliveries, over their micro-batches."""
    metrics = taken_in(spark, sf).table("monitoring", "bronze_ingestion_metrics/orders").read()
    return metrics.groupBy("dataset", "batch_id").agg(
        *(F.sum(c).alias(c) for c in ("total_records", "rescued_records", "corrupt_records"))
    )


@query
def bronze_snapshot_ingest(spark, sf):
    """The folder is read whole twice; the second run replaces the first. Two layouts in it."""
    lake = new_lake(spark, "snapshot")
    drops = f"{lake.root}/drops"
    rows, wide = src.promotions(spark, sf).select(*PROMOTIONS.columns), F.col("discount_percent") > 50
    drop_csv(rows.filter(wide), drops)
    drop_csv(rows.filter(~wide).select(F.lit("x").alias("note"), *reversed(PROMOTIONS.columns)), drops)
    ingest_snapshot(lake, PROMOTIONS, drops, ENVIRONMENT, "promotions_1")
    ingest_snapshot(lake, PROMOTIONS, drops, ENVIRONMENT, "promotions_2")
    bronze = lake.table("bronze", "promotions").read()
    note = F.get_json_object("_rescued_data", "$.note").alias("note")
    return bronze.select(*PROMOTIONS.columns, "_corrupt_record", note, "_batch_id")


# -- jobs --------------------------------------------------------------------------


@query
def silver_incremental(spark, sf):
    """Two deliveries of batches, each processed, and a last run that finds nothing."""
    spec = ORDERS.with_rules(
        *ORDERS.rules, Rule("quantity", "less_than", "quantity must be < 50", 50)
    )
    silver = Silver(new_lake(spark, "silver"), spec, ENVIRONMENT)
    for part in early_and_late(spark, sf):
        silver.bronze.append(part)
        run_incremental(silver)
    run_incremental(silver)
    return silver.table.read().select(*ORDERS.columns, "_batch_id", "_quality_status")


@query
def silver_snapshot(spark, sf):
    silver = Silver(new_lake(spark, "silver"), PROMOTIONS, ENVIRONMENT)
    silver.bronze.overwrite(src.promotions(spark, sf))
    run_snapshot(silver)
    run_snapshot(silver)
    return silver.table.read().select(*PROMOTIONS.columns, "_quality_status")


@query
def reprocess_quarantine(spark, sf):
    """One batch of all customers, checked again once the segment is no longer required."""
    lake = new_lake(spark, "reprocess")
    strict = Silver(lake, CUSTOMERS, ENVIRONMENT)
    batch = "customers_all"
    strict.bronze.overwrite(src.customers(spark, sf).withColumn("_batch_id", F.lit(batch)))
    run_incremental(strict)
    relaxed = replace(CUSTOMERS, required=("customer_id", "email", "signup_date"))
    reprocess_batch(Silver(lake, relaxed, ENVIRONMENT), batch)
    promoted = strict.table.read().select(
        "customer_id", F.lit("silver").alias("place"), F.col("_quality_reason").alias("reason")
    )
    kept = strict.quarantine.read().select(
        "customer_id",
        F.lit("quarantine").alias("place"),
        F.col("_quarantine_reason").alias("reason"),
    )
    return promoted.unionByName(kept)


@query
def reprocess_new_valid(spark, sf):
    """Rows whose file, batch and key are not stored yet."""
    early, _ = early_and_late(spark, sf)
    keys = identity(Silver(Lake(spark, ""), ORDERS, ENVIRONMENT))
    candidates = any_per_key(src.raw_orders(spark, sf).select(*keys), keys)
    return absent_from(candidates, early, keys)


# Gold tables, and what is added up in each to compare it.
GOLD_AMOUNTS = {
    "dim_customer": "CAST(is_current AS DOUBLE)",
    "dim_product": "unit_price",
    "dim_date": "CAST(day_of_month AS DOUBLE)",
    "fact_orders": "net_sales_amount",
    "fact_returns": "refund_amount",
    "customer_sales_summary": "net_sales_amount",
    "product_sales_summary": "net_sales_amount",
    "daily_sales_summary": "net_revenue",
    "monthly_sales_summary": "net_revenue",
    "customer_revenue_summary": "net_revenue",
    "product_revenue_summary": "net_revenue",
    "promotion_product_summary": "discount_percent",
}

#: What a row of a summary is known by.
GOLD_SUMMARIES = {
    "customer_sales_summary": "customer_id",
    "product_sales_summary": "product_id",
    "daily_sales_summary": "order_date",
    "monthly_sales_summary": "concat(year, '-', month)",
    "customer_revenue_summary": "customer_id",
    "product_revenue_summary": "product_id",
}


@query
def gold_build(spark, sf):
    """Gold of day one, then of day two over silver that has changed: each table's rows and one
    sum, and every row and measure of the sales summaries.

    On day one the later deliveries are missing, orders have other quantities, refunds are
    not known, customers are those of the first day of their history.
    """
    lake = new_lake(spark, "gold")
    lines = kept(src.latest_order_lines(spark, sf), "lines")
    orders, returns = src.orders_of(lines), src.returns_of(lines)
    early = F.col("_batch_id") <= CUT
    days = (
        (DAY_ONE, {
            "customers": first_day(spark, sf),
            "products": src.products(spark, sf).withColumn("unit_price", F.lit(1.0)),
            "orders": orders.filter(early).withColumn("quantity", F.col("quantity") + 1),
            "returns": returns.filter(early).withColumn("refund_amount", F.lit(0.0)),
            "promotions": src.promotions(spark, sf),
        }),
        (DAY_TWO, {
            "customers": moved(spark, sf),
            "products": src.products(spark, sf),
            "orders": orders,
            "returns": returns,
            "promotions": src.promotions(spark, sf),
        }),
    )
    for day, silver in days:
        for name, rows in silver.items():
            lake.table("silver", name).overwrite(rows)
        build_gold(lake, day, buckets={"orders": 4, "returns": 2})
    found = None
    for name, amount in GOLD_AMOUNTS.items():
        rows = lake.table("gold", name).read().agg(
            F.count(F.lit(1)).alias("row_count"), F.round(F.sum(F.expr(amount)), 0).alias("amount")
        )
        rows = rows.select(F.lit(name).alias("table_name"), "row_count", "amount")
        found = rows if found is None else found.unionByName(rows)
    for name, key in GOLD_SUMMARIES.items():
        rows = to_cents(lake.table("gold", name).read())
        measures = [c for c in summaries.ADDED + ("net_revenue",) if c in rows.columns]
        key = F.expr(key).cast("string").alias("key")
        rows = rows.select(F.lit(name).alias("table_name"), key, *measures)
        found = found.unionByName(rows, allowMissingColumns=True)
    return found


@query
def run_log(spark, sf):
    """Rows logged for one step that works and one that fails over the real tables."""
    lake = new_lake(spark, "log")
    step = {"job_id": "1", "run_id": "2", "task_key": "gold", "dataset": "orders"}
    with logged(lake, ENVIRONMENT, **step, cell_name="dim_product") as report:
        table = lake.table("gold", "dim_product")
        table.overwrite(star.dim_product(src.products(spark, sf)))
        report["rows_processed"] = table.read().count()
    try:
        with logged(lake, ENVIRONMENT, **step, cell_name="required columns"):
            require_columns(require_non_empty(src.products(spark, sf)), ["discount"])
    except ValueError:
        pass
    return read_run_log(lake).filter("status <> 'STARTED'").select(
        "environment", "task_key", "cell_name", "dataset", "status", "rows_processed",
        "error_type", "error_message",
    )


# -- QA ----------------------------------------------------------------------------


@query
def qa_suite(spark, sf):
    """All checks after every dataset went through bronze, silver and gold."""
    lake = new_lake(spark, "qa")
    silver = {name: Silver(lake, d, ENVIRONMENT) for name, d in DATASETS.items()}
    scratch = f"{lake.root}/dealt"
    with frugal(spark):
        tables = src.dealt_lines(spark, sf, scratch)

        def into_bronze(name: str) -> None:
            of_lines = [tables] if name in ("orders", "returns") else []
            rows = src.FRAMES[name](spark, sf, *of_lines)
            rows = rows.withColumns({"_load_date": F.lit(DAY_ONE), "_environment": F.lit(ENVIRONMENT)})
            # Of much data each task writes files of its own into each batch: rows do not move again.
            silver[name].bronze.overwrite(sliced(rows, F.lit("all")) if tables else rows)

        together(*[partial(into_bronze, name) for name in DATASETS])
        delete_dir(spark, scratch)
        together(*[partial(run_silver, s) for s in silver.values()])
        build_gold(lake, DAY_ONE)
    listing = F.col("test_name").endswith("required columns") | F.col("test_name").endswith("reconciles to the fact")
    return run_qa(lake).select(
        "layer", "test_name", "status", F.when(~listing, F.col("actual")).alias("actual")
    )


@query
def latest_dq_status(spark, sf):
    p = assess(src.promotions(spark, sf), PROMOTIONS.required, PROMOTIONS.rules)
    metrics = customer_metrics(spark, sf).unionByName(
        dq_metrics(p, ENVIRONMENT, "promotions", 1.0)
    )
    same_moment = metrics.withColumn("recorded_at", F.lit(DAY_ONE).cast("timestamp"))
    return checks.latest_dq_status(same_moment).select(
        "dataset", "batch_id", "dq_failure_rate_percent", "dq_status"
    )


@query
def qa_non_empty(spark, sf):
    return checks.check_non_empty(src.raw_orders(spark, sf), "BRONZE", "orders")


@query
def qa_unique(spark, sf):
    raw, clean = src.raw_orders(spark, sf), src.orders(spark, sf)
    return checks.check_unique(raw, ORDERS.key, "BRONZE", "orders").unionByName(
        checks.check_unique(clean, ORDERS.key, "SILVER", "orders")
    )


@query
def qa_technical(spark, sf):
    return checks.check_technical(rescued_orders(spark, sf), "BRONZE", "orders")


@query
def qa_row_count(spark, sf):
    return checks.check_row_count(src.promotions(spark, sf), 200, "BRONZE", "promotions")


@query
def qa_scd2(spark, sf):
    return checks.scd2_defects(history(spark, sf))


@query
def qa_reconcile(spark, sf):
    orders = kept(orders_fact(spark, sf), "orders")
    return to_cents(checks.totals(orders, summaries.customer_sales(orders, unique_orders=True)))


@query
def qa_dimension_coverage(spark, sf):
    """Orders of products whose promotion did not give more than they cost."""
    given_away = src.promotions(spark, sf).filter("discount_percent > 100")
    return checks.uncovered(orders_fact(spark, sf), given_away, "product_id")


@query
def qa_idempotency(spark, sf):
    """Customers merged a second time change nothing; merged before they moved, they do."""
    final, moved_rows = history(spark, sf), moved(spark, sf)
    again = scd2.scd2_merge(final, moved_rows, DAY_TWO)
    before = scd2.scd2_merge(None, first_day(spark, sf), DAY_ONE)
    return checks.check_unchanged(final, again, "GOLD", "dim_customer").unionByName(
        checks.check_unchanged(before, final, "GOLD", "dim_customer day one")
    )


@query
def qa_summary(spark, sf):
    raw, promotions = src.raw_orders(spark, sf), src.promotions(spark, sf)
    results = (
        checks.check_unique(raw, ORDERS.key, "BRONZE", "orders")
        .unionByName(checks.check_row_count(promotions, 200, "BRONZE", "promotions"))
        .unionByName(checks.check_non_empty(raw, "BRONZE", "orders"))
        .unionByName(checks.check_non_empty(src.products(spark, sf), "BRONZE", "products"))
    )
    return checks.summarize(results)


# -- functions ---------------------------------------------------------------------


@query
def fn_date(spark, sf):
    days = src.table(spark, sf, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("order_date")
    )
    return days.select(
        "*",
        *[c.alias(n) for n, c in calendar_columns("order_date").items()],
        F.date_sub("order_date", 1).alias("day_before"),
    )


@query
def fn_string(spark, sf):
    return src.table(spark, sf, "part").select(
        "p_partkey",
        F.trim(F.concat(F.lit("  "), "p_name", F.lit(" "))).alias("trimmed"),
        F.length("p_name").alias("name_length"),
        F.col("p_name").rlike("^(red|blue) ").alias("red_or_blue"),
        F.concat_ws("; ", "p_brand", F.when(F.col("p_size") > 25, F.col("p_type"))).alias(
            "joined"
        ),
    )


@query
def fn_null_conditional(spark, sf):
    quantity, discount = F.col("quantity"), F.col("discount_amount")
    return src.raw_orders(spark, sf).select(
        "order_id",
        quantity,
        discount,
        F.coalesce(discount, F.lit(0.0)).alias("discount_or_zero"),
        discount.isNull().alias("no_discount"),
        discount.eqNullSafe(F.lit(None)).alias("null_safe_equal"),
        F.when(quantity >= 25, "large").otherwise("small").alias("size_class"),
        ((quantity > 10) & ~(quantity > 40)).alias("medium"),
    )


@query
def fn_array(spark, sf):
    reasons = F.filter(
        F.array(
            F.when(F.col("discount_percent") > 100, "too high"),
            F.when(F.col("end_date") < F.col("start_date"), "reversed"),
        ),
        lambda r: r.isNotNull(),
    )
    return src.promotions(spark, sf).select(
        "promotion_id",
        F.size(reasons).alias("reason_count"),
        F.concat_ws("; ", reasons).alias("reasons"),
    )


def queries() -> dict[str, Query]:
    """A trailing underscore only keeps a function apart from the operator it runs."""
    return {name.rstrip("_"): f for name, f in QUERIES.items()}
