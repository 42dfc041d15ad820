"""The QA suite over a lake: results as rows, also when everything is broken."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.datasets import DATASETS
from millrace.operators import checks as C
from millrace.operators.scd2 import CUSTOMER_KEY, VALIDITY
from millrace.sources.lake import Lake

PROVENANCE = ("_source_file", "_ingestion_timestamp", "_load_date", "_batch_id", "_environment")

# Columns every table of a layer must have, beside its key.
BRONZE_EXTRA = {"customers": ("email",)}
SILVER_EXTRA = {"customers": ("email",), "returns": ("order_id", "customer_id", "product_id")}
GOLD_KEYS = {
    "dim_customer": ("customer_id", "effective_start_date"),
    "dim_product": ("product_id",),
    "fact_orders": ("order_id",),
    "fact_returns": ("return_id",),
}
PROMOTIONS_EXPECTED = 200


def run_qa(lake: Lake, promotions_expected: int = PROMOTIONS_EXPECTED) -> DataFrame:
    """All checks as one frame; nothing is measured until it is written or counted."""
    facts: list[tuple] = []
    frames: list[DataFrame] = []
    found: dict[tuple[str, str], DataFrame] = {}

    def present(layer: str, name: str) -> DataFrame | None:
        table = lake.table(layer, name)
        exists = table.exists()
        facts.append(
            (layer.upper(), f"{layer}.{name} exists", "PASS" if exists else "FAIL",
             str(exists).lower(), "true", None)
        )
        if not exists:
            return None
        found[layer, name] = table.read()
        return found[layer, name]

    def has_columns(df: DataFrame, required, layer: str, name: str) -> None:
        missing = sorted(set(required) - set(df.columns))
        facts.append(
            (layer.upper(), f"{layer}.{name} required columns", "FAIL" if missing else "PASS",
             ", ".join(sorted(df.columns)), ", ".join(required),
             f"missing: {', '.join(missing)}" if missing else None)
        )

    def able(df: DataFrame, needed, layer: str, test: str, status: str = "FAIL") -> bool:
        """Whether a check can run; if not, that is its result."""
        missing = sorted(set(needed) - set(df.columns))
        if missing:
            facts.append((layer, test, status, None, None, f"cannot run, missing: {', '.join(missing)}"))
        return not missing

    def rows_and_keys(df: DataFrame, keys, layer: str, name: str) -> None:
        if able(df, keys, layer, f"{name} business-key uniqueness"):
            frames.append(C.check_rows_and_keys(df, keys, layer, name))
        else:
            frames.append(C.check_non_empty(df, layer, name))

    for name, d in DATASETS.items():
        df = present("bronze", name)
        if df is not None:
            has_columns(df, (*d.key, *BRONZE_EXTRA.get(name, ()), *PROVENANCE), "bronze", name)
            expected = promotions_expected if name == "promotions" else None
            frames.append(C.check_bronze(df, "BRONZE", f"bronze.{name}", expected))

    for name, d in DATASETS.items():
        df = present("silver", name)
        if df is not None:
            has_columns(df, (*d.key, *SILVER_EXTRA.get(name, ())), "silver", name)
            rows_and_keys(df, d.key, "SILVER", f"silver.{name}")
    metrics = lake.tables("monitoring", "silver_dq_metrics", DATASETS)
    if metrics is not None:
        frames.append(C.check_dq_status(metrics, "SILVER", list(DATASETS)))
    else:
        facts.extend(
            ("SILVER", f"DQ latest status: {name}", "FAIL", None, "PASS", "no metrics") for name in DATASETS
        )

    for name, keys in GOLD_KEYS.items():
        df = present("gold", name)
        if df is not None:
            rows_and_keys(df, keys, "GOLD", f"gold.{name}")
    gold = {name: df for (layer, name), df in found.items() if layer == "gold"}
    history = "gold.dim_customer SCD2 current-row integrity"
    if "dim_customer" in gold and able(gold["dim_customer"], (CUSTOMER_KEY, *VALIDITY), "GOLD", history):
        frames.append(C.check_scd2(gold["dim_customer"], "GOLD", "gold.dim_customer"))
    summary = lake.table("gold", "customer_sales_summary").read_or_none()
    if "fact_orders" in gold and summary is not None:
        reconciled = "gold.customer_sales_summary"
        if C.has_measure(gold["fact_orders"]) and C.has_measure(summary):
            frames.append(C.check_reconciles(gold["fact_orders"], summary, "GOLD", reconciled))
        else:
            facts.append(
                ("GOLD", f"{reconciled} reconciles to the fact", "WARN", None, None,
                 f"cannot run, no measure of: {', '.join(C.NET_SALES_NAMES)}")
            )
    for fact, dim, key in (
        ("fact_orders", "dim_customer", "customer_id"),
        ("fact_orders", "dim_product", "product_id"),
        ("fact_returns", "dim_product", "product_id"),
    ):
        if fact in gold and dim in gold:
            name = f"gold.{dim} for {fact}"
            test = f"{name} covers {key}"
            if able(gold[fact], [key], "GOLD", test) and able(gold[dim], [key], "GOLD", test):
                frames.append(C.check_coverage(gold[fact], gold[dim], key, "GOLD", name))

    return reduce(DataFrame.unionByName, frames, C.schema_results(lake.spark, facts))


def store_qa(lake: Lake, environment: str, results: DataFrame) -> DataFrame:
    """Append the results and return the totals per status."""
    table = lake.table("monitoring", "qa_test_results")
    before = set(table.slices()) if table.exists() else set()
    table.append(
        results.select(
            F.lit(environment).alias("environment"),
            *results.columns,
            F.current_timestamp().alias("recorded_at"),
        )
    )
    return C.summarize(table.read(set(table.slices()) - before))
