"""Declarations of the six retail datasets: schema, key, mode, quality rules."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import types as T

# Column order and types are part of the data contract.
CUSTOMERS_DDL = """
    customer_id string, first_name string, last_name string, email string, city string,
    state string, country string, signup_date date, customer_segment string
"""
PRODUCTS_DDL = """
    product_id string, product_name string, category string, subcategory string,
    brand string, unit_price double, currency string
"""
ORDERS_DDL = """
    order_id string, customer_id string, product_id string, order_date date, quantity int,
    unit_price double, discount_amount double, payment_method string, order_status string
"""
CLICKSTREAM_DDL = """
    event_id string, customer_id string, event_timestamp timestamp, event_type string,
    page_url string, product_id string, device_type string, session_id string
"""
RETURNS_DDL = """
    return_id string, order_id string, customer_id string, product_id string,
    return_date date, return_quantity int, return_reason string, refund_amount double,
    return_status string
"""
PROMOTIONS_DDL = """
    promotion_id string, promotion_name string, product_id string, start_date date,
    end_date date, discount_percent double, promotion_type string, status string
"""

# Fixed value: the e-mail test is a search for this pattern.
EMAIL_PATTERN = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"

RULE_KINDS = frozenset(
    {
        "regex",
        "not_empty",
        "greater_than",
        "greater_than_or_equal",
        "less_than",
        "less_than_or_equal",
        "column_greater_than_or_equal",
    }
)


@dataclass(frozen=True)
class Rule:
    """What a column must satisfy; rows that do not are reported with ``reason``."""

    column: str
    kind: str
    reason: str
    operand: object = None

    def __post_init__(self) -> None:
        if self.kind not in RULE_KINDS:
            raise ValueError(f"unknown rule kind {self.kind!r} on column {self.column!r}")
        if not self.reason:
            raise ValueError(f"rule {self.kind!r} on {self.column!r} needs a reason")


@dataclass(frozen=True)
class Dataset:
    name: str
    domain: str
    ddl: str
    key: tuple[str, ...]
    required: tuple[str, ...]
    rules: tuple[Rule, ...] = ()
    snapshot: bool = False
    ingest_alert_percent: float = 1.0
    dq_alert_percent: float = 1.0

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.ddl)

    @property
    def columns(self) -> list[str]:
        return [field.split()[0] for field in self.ddl.split(",")]

    @property
    def source_path(self) -> str:
        return f"{self.domain}/{self.name}"

    def with_rules(self, *rules: Rule, dq_alert_percent: float | None = None) -> "Dataset":
        percent = self.dq_alert_percent if dq_alert_percent is None else dq_alert_percent
        return replace(self, rules=tuple(rules), dq_alert_percent=percent)


# Keys, required columns, rules, their texts and thresholds.
DATASETS: dict[str, Dataset] = {
    d.name: d
    for d in (
        Dataset(
            name="customers",
            domain="erp",
            ddl=CUSTOMERS_DDL,
            key=("customer_id",),
            required=("customer_id", "email", "signup_date", "customer_segment"),
            rules=(Rule("email", "regex", "email must be a valid email address", EMAIL_PATTERN),),
        ),
        Dataset(
            name="products",
            domain="erp",
            ddl=PRODUCTS_DDL,
            key=("product_id",),
            required=("product_id", "product_name", "unit_price", "currency"),
            rules=(Rule("unit_price", "greater_than", "unit_price must be > 0", 0),),
        ),
        Dataset(
            name="orders",
            domain="erp",
            ddl=ORDERS_DDL,
            key=("order_id",),
            required=(
                "order_id", "customer_id", "product_id", "order_date", "quantity", "unit_price",
            ),
            rules=(
                Rule("quantity", "greater_than", "quantity must be > 0", 0),
                Rule("unit_price", "greater_than", "unit_price must be > 0", 0),
                Rule(
                    "discount_amount", "greater_than_or_equal", "discount_amount must be >= 0", 0
                ),
            ),
        ),
        Dataset(
            name="clickstream",
            domain="ecommerce",
            ddl=CLICKSTREAM_DDL,
            key=("event_id",),
            required=("event_id", "event_timestamp", "event_type", "session_id"),
        ),
        Dataset(
            name="returns",
            domain="ecommerce",
            ddl=RETURNS_DDL,
            key=("return_id",),
            required=(
                "return_id", "order_id", "customer_id", "product_id", "return_date",
                "return_quantity", "refund_amount",
            ),
            rules=(
                Rule("return_quantity", "greater_than", "return_quantity must be > 0", 0),
                Rule("refund_amount", "greater_than_or_equal", "refund_amount must be >= 0", 0),
            ),
        ),
        Dataset(
            name="promotions",
            domain="marketing",
            ddl=PROMOTIONS_DDL,
            key=("promotion_id",),
            required=(
                "promotion_id", "promotion_name", "product_id", "start_date", "end_date",
                "discount_percent",
            ),
            rules=(
                Rule(
                    "discount_percent", "greater_than_or_equal", "discount_percent must be >= 0", 0
                ),
                Rule(
                    "discount_percent", "less_than_or_equal", "discount_percent must be <= 100", 100
                ),
                Rule(
                    "end_date", "column_greater_than_or_equal", "end_date must be >= start_date",
                    "start_date",
                ),
            ),
            snapshot=True,
        ),
    )
}

# The earlier rule set, kept for gating rows before bronze. Its alert threshold is 10 %.
STRICT_GATE: dict[str, Dataset] = {
    "customers": replace(
        DATASETS["customers"],
        rules=(Rule("email", "regex", "Invalid email format", EMAIL_PATTERN),),
        dq_alert_percent=10.0,
    ),
    "products": replace(
        DATASETS["products"],
        required=("product_id", "product_name", "category", "unit_price", "currency"),
        rules=(Rule("unit_price", "greater_than_or_equal", "unit_price must be >= 0", 0),),
        dq_alert_percent=10.0,
    ),
    "orders": replace(
        DATASETS["orders"],
        required=(
            "order_id", "customer_id", "product_id", "order_date", "quantity", "unit_price",
            "payment_method", "order_status",
        ),
        rules=(
            Rule("quantity", "greater_than", "quantity must be > 0", 0),
            Rule("unit_price", "greater_than_or_equal", "unit_price must be >= 0", 0),
            Rule("discount_amount", "greater_than_or_equal", "discount_amount must be >= 0", 0),
        ),
        dq_alert_percent=10.0,
    ),
    "clickstream": replace(
        DATASETS["clickstream"],
        required=("event_id", "customer_id", "event_timestamp", "event_type", "session_id"),
        rules=(Rule("event_type", "not_empty", "event_type cannot be empty"),),
        dq_alert_percent=10.0,
    ),
    "returns": replace(
        DATASETS["returns"],
        required=(
            "return_id", "order_id", "customer_id", "product_id", "return_date",
            "return_quantity", "refund_amount", "return_status",
        ),
        rules=(
            Rule("return_quantity", "greater_than", "return_quantity must be > 0", 0),
            Rule("refund_amount", "greater_than_or_equal", "refund_amount must be >= 0", 0),
        ),
        dq_alert_percent=10.0,
    ),
}
