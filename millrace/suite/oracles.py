"""The queries' results as SQL over the supplied tables."""

from __future__ import annotations

# The six datasets. Tie-breaks of "latest" are spelled out with their NULL order.
DATASETS_SQL = """
ds_customers AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
         split_part(c_name, '#', 1) AS first_name,
         split_part(c_name, '#', 2) AS last_name,
         'c' || c_custkey || CASE WHEN c_custkey % 37 = 0 THEN '.example.com'
                                  ELSE '@example.com' END AS email,
         n_name AS city, n_name AS state, r_name AS country,
         CAST(DATE '1995-01-01' + CAST(c_custkey % 2000 AS INTEGER) AS DATE) AS signup_date,
         CASE WHEN c_custkey % 41 <> 0 THEN c_mktsegment END AS customer_segment,
         CAST(DATE '1995-01-01' + CAST(c_custkey % 2000 AS INTEGER) AS TIMESTAMP)
           AS _ingestion_timestamp,
         'customers' AS _source_file,
         'customers_' || strftime(DATE '1995-01-01' + CAST(c_custkey % 2000 AS INTEGER), '%Y%m')
           AS _batch_id
  FROM customer JOIN nation ON c_nationkey = n_nationkey
                JOIN region ON n_regionkey = r_regionkey),
ds_products AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name,
         p_type AS category, split_part(p_name, ' ', 2) AS subcategory, p_brand AS brand,
         p_retailprice AS unit_price, 'USD' AS currency,
         TIMESTAMP '1995-01-01' AS _ingestion_timestamp, 'products' AS _source_file,
         'products_199501' AS _batch_id
  FROM part),
ds_lines AS (
  SELECT l_orderkey || '-' || l_linenumber AS order_id,
         CAST(o_custkey AS VARCHAR) AS customer_id,
         CAST(l_partkey AS VARCHAR) AS product_id,
         CAST(o_orderdate AS DATE) AS order_date,
         CAST(l_quantity AS INTEGER) AS quantity,
         l_extendedprice / l_quantity AS unit_price,
         CASE WHEN l_partkey % 29 <> 0 THEN l_extendedprice * l_discount END AS discount_amount,
         o_orderpriority AS payment_method, o_orderstatus AS order_status,
         l_suppkey AS supplier_id, l_tax AS tax, l_returnflag AS line_flag,
         l_linestatus AS line_status,
         l_extendedprice * (1.0 - l_discount) AS line_value,
         l_shipdate AS _ingestion_timestamp, 'orders' AS _source_file,
         'orders_' || strftime(l_shipdate, '%Y%m') AS _batch_id
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
ds_latest AS (
  SELECT * FROM ds_lines
  QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY
    _ingestion_timestamp DESC NULLS LAST, _batch_id DESC NULLS LAST,
    customer_id ASC NULLS FIRST, product_id ASC NULLS FIRST, order_date ASC NULLS FIRST,
    quantity ASC NULLS FIRST, unit_price ASC NULLS FIRST, discount_amount ASC NULLS FIRST,
    payment_method ASC NULLS FIRST, order_status ASC NULLS FIRST, supplier_id ASC NULLS FIRST,
    tax ASC NULLS FIRST, line_flag ASC NULLS FIRST, line_status ASC NULLS FIRST,
    line_value ASC NULLS FIRST) = 1),
ds_orders AS (
  SELECT order_id, customer_id, product_id, order_date, quantity, unit_price, discount_amount,
         payment_method, order_status, _ingestion_timestamp, _source_file, _batch_id
  FROM ds_latest),
ds_returns AS (
  SELECT 'R-' || order_id AS return_id, order_id, customer_id, product_id,
         CAST(_ingestion_timestamp AS DATE) AS return_date, quantity AS return_quantity,
         line_status AS return_reason, line_value AS refund_amount,
         order_status AS return_status, _ingestion_timestamp, _source_file, _batch_id
  FROM ds_latest WHERE line_flag = 'R'),
ds_promotions AS (
  SELECT 'P-' || p_partkey AS promotion_id, p_name AS promotion_name,
         CAST(p_partkey AS VARCHAR) AS product_id,
         CAST(DATE '1996-01-01' + CAST(p_partkey % 365 AS INTEGER) AS DATE) AS start_date,
         CAST(DATE '1996-01-01' + CAST(p_partkey % 365 AS INTEGER) + (p_size - 3) AS DATE)
           AS end_date,
         CAST(p_size * 2.5 AS DOUBLE) AS discount_percent, p_type AS promotion_type,
         'ACTIVE' AS status,
         TIMESTAMP '1996-01-01' AS _ingestion_timestamp, 'promotions' AS _source_file,
         'promotions_199601' AS _batch_id
  FROM part),
ds_clickstream AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS customer_id,
         ts AS event_timestamp, event_type, '/' || event_type AS page_url,
         json_extract_string(props, '$.k') AS product_id, CAST(NULL AS VARCHAR) AS device_type,
         user_id || '-' || strftime(ts, '%Y-%m-%d') AS session_id,
         ts AS _ingestion_timestamp, 'clickstream' AS _source_file,
         'clickstream_' || strftime(ts, '%Y%m%d') AS _batch_id
  FROM events),
fact AS (
  SELECT *, quantity * unit_price AS gross_amount,
         quantity * unit_price - coalesce(discount_amount, 0.0) AS net_sales_amount
  FROM ds_orders)
"""


def money(expression: str) -> str:
    """Totals are compared to four decimals: they are rounded once, when they are finished; no -0.0."""
    return f"round(sum({expression}), 4) + 0.0"


MEASURES_SQL = f"""
  count(DISTINCT order_id) AS order_count, sum(quantity) AS units_sold,
  {money('gross_amount')} AS gross_sales_amount,
  {money('discount_amount')} AS discount_amount,
  {money('net_sales_amount')} AS net_sales_amount
"""

REVENUE_SQL = """
  SELECT {key}, order_count, CAST(units_sold AS BIGINT) AS units_sold, gross_sales_amount,
         discount_amount, net_sales_amount, refund_amount, net_revenue
  FROM (SELECT {key}, {measures}, {refund} AS refund_amount,
               round(sum(net_sales_amount) - sum(refund), 4) + 0.0 AS net_revenue
        FROM (SELECT fact.*, coalesce(r.refund, 0.0) AS refund
              FROM fact LEFT JOIN (
                SELECT {on}, {refund_sum} AS refund FROM ds_returns GROUP BY {on}
              ) r USING ({on}))
        GROUP BY {key})
"""


def revenue(key: str, on: str = "order_id") -> str:
    return REVENUE_SQL.format(
        key=key, on=on, measures=MEASURES_SQL, refund=money("refund"),
        refund_sum="sum(refund_amount)",
    )


def sales(key: str) -> str:
    return f"""SELECT {key}, order_count, CAST(units_sold AS BIGINT) AS units_sold,
      gross_sales_amount, discount_amount, net_sales_amount
      FROM (SELECT {key}, {MEASURES_SQL} FROM fact GROUP BY {key})"""


MONTHLY_SQL = f"""SELECT CAST(year(order_date) AS INTEGER) AS year,
    CAST(month(order_date) AS INTEGER) AS month,
    CAST(sum(order_count) AS BIGINT) AS order_count,
    CAST(sum(units_sold) AS BIGINT) AS units_sold,
    {', '.join(money(m) + ' AS ' + m for m in (
        'gross_sales_amount', 'discount_amount', 'net_sales_amount', 'refund_amount',
        'net_revenue'))}
  FROM ({revenue('order_date')}) GROUP BY ALL"""


def reasons(frame: str, columns: str, *tests: tuple[str, str]) -> str:
    """Rows with the ``; ``-joined texts of the conditions that hold."""
    cases = ", ".join(f"CASE WHEN {condition} THEN '{text}' END" for condition, text in tests)
    return f"""
      SELECT {columns}, _quality_reason,
             CASE WHEN _quality_reason IS NULL THEN 'VALID' ELSE 'QUARANTINE' END
               AS _quality_status
      FROM (SELECT *, nullif(concat_ws('; ', {cases}), '') AS _quality_reason FROM {frame})
    """


def blank(*names: str) -> list[tuple[str, str]]:
    return [
        (f"{n} IS NULL OR trim(CAST({n} AS VARCHAR)) = ''", f"{n} is null or empty")
        for n in names
    ]


EMAIL = (
    r"NOT regexp_matches(email, '^[^@\s]+@[^@\s]+\.[^@\s]+$')",
    "email must be a valid email address",
)
CUSTOMER_TESTS = [*blank("customer_id", "email", "signup_date", "customer_segment"), EMAIL]
PROMOTION_TESTS = [
    *blank(
        "promotion_id", "promotion_name", "product_id", "start_date", "end_date",
        "discount_percent",
    ),
    ("discount_percent < 0", "discount_percent must be >= 0"),
    ("discount_percent > 100", "discount_percent must be <= 100"),
    ("end_date < start_date", "end_date must be >= start_date"),
]
ORDER_COLUMNS = (
    "order_id, customer_id, product_id, order_date, quantity, unit_price, discount_amount, "
    "payment_method, order_status"
)
CUSTOMER_COLUMNS = (
    "customer_id, first_name, last_name, email, city, state, country, signup_date, "
    "customer_segment"
)
PROMOTION_COLUMNS = (
    "promotion_id, promotion_name, product_id, start_date, end_date, discount_percent, "
    "promotion_type, status"
)
LATEST_ORDER = """
  _ingestion_timestamp DESC NULLS LAST, _batch_id DESC NULLS LAST, customer_id ASC NULLS FIRST,
  product_id ASC NULLS FIRST, order_date ASC NULLS FIRST, quantity ASC NULLS FIRST,
  unit_price ASC NULLS FIRST, discount_amount ASC NULLS FIRST, payment_method ASC NULLS FIRST,
  order_status ASC NULLS FIRST
"""


def latest_orders(where: str = "true", columns: str = ORDER_COLUMNS) -> str:
    return f"""SELECT {columns} FROM ds_lines WHERE {where}
      QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY {LATEST_ORDER}) = 1"""


CUT = "orders_199806"
CUSTOMER_METRICS_SQL = """
  SELECT 'test' AS environment, 'customers' AS dataset, _batch_id AS batch_id,
         CAST(-1 AS INTEGER) AS micro_batch_id,
         count(*) AS total_records,
         count(*) FILTER (_quality_status = 'VALID') AS valid_records,
         count(*) FILTER (_quality_status = 'QUARANTINE') AS quarantined_records,
         count(*) FILTER (_quality_status = 'QUARANTINE') / count(*) * 100.0
           AS dq_failure_rate_percent,
         CAST({threshold} AS DOUBLE) AS dq_failure_threshold_percent,
         CASE WHEN count(*) FILTER (_quality_status = 'QUARANTINE') / count(*) * 100.0
              > {threshold} THEN 'ALERT' ELSE 'PASS' END AS dq_status
  FROM ({assessed}) GROUP BY _batch_id
"""
CUSTOMERS_ASSESSED = reasons("ds_customers", "*", *CUSTOMER_TESTS)

# What customer history holds after day one, corrections on day two, moves the same day.
SCD2_SQL = f"""
  first_day AS (SELECT {CUSTOMER_COLUMNS} FROM ds_customers WHERE country <> 'ASIA'),
  last_day AS (
    SELECT customer_id, first_name, last_name,
           CASE WHEN contains(email, '@') THEN email
                ELSE replace(email, '.example.com', '@example.com') END AS email,
           CASE WHEN country = 'AMERICA' THEN city || ' II' ELSE city END AS city,
           state, country, signup_date,
           coalesce(customer_segment, 'UNKNOWN') AS customer_segment
    FROM ds_customers WHERE country <> 'EUROPE'),
  changed AS (
    SELECT f.customer_id FROM first_day f JOIN last_day l USING (customer_id)
    WHERE (f.email, f.city, f.customer_segment)
          IS DISTINCT FROM (l.email, l.city, l.customer_segment)),
  dim AS (
    SELECT *, DATE '2024-01-01' AS effective_start_date,
           CASE WHEN customer_id IN (FROM changed) THEN DATE '2024-01-31'
                ELSE DATE '9999-12-31' END AS effective_end_date,
           customer_id NOT IN (FROM changed) AS is_current
    FROM first_day
    UNION ALL BY NAME
    SELECT *, DATE '2024-02-01' AS effective_start_date,
           DATE '9999-12-31' AS effective_end_date, true AS is_current
    FROM last_day
    WHERE country = 'ASIA' OR customer_id IN (FROM changed))
"""

RESCUED_SQL = """
  text_orders AS (
    SELECT CAST(o_orderkey AS VARCHAR) AS order_id, o_custkey, o_orderstatus,
           o_orderpriority, o_orderdate, o_totalprice,
           o_orderstatus = 'F' AS bad_date, o_orderstatus = 'P' AS bad_quantity
    FROM orders)
"""


def with_datasets(sql: str, extra: str = "") -> str:
    return f"WITH {DATASETS_SQL}{',' + extra if extra else ''} {sql}"


def day_parts(day: str) -> str:
    return f"""CAST(strftime({day}, '%Y%m%d') AS INTEGER) AS date_key,
      CAST(year({day}) AS INTEGER) AS year, CAST(quarter({day}) AS INTEGER) AS quarter,
      CAST(month({day}) AS INTEGER) AS month, monthname({day}) AS month_name,
      CAST(weekofyear({day}) AS INTEGER) AS week_of_year,
      CAST(dayofmonth({day}) AS INTEGER) AS day_of_month,
      CAST(dayofweek({day}) + 1 AS INTEGER) AS day_of_week, dayname({day}) AS day_name"""


def check_row(layer: str, test: str, status: str, actual: str, expected: str, details="NULL"):
    return f"""SELECT '{layer}' AS layer, '{test}' AS test_name, {status} AS status,
      CAST({actual} AS VARCHAR) AS actual, '{expected}' AS expected,
      CAST({details} AS VARCHAR) AS details"""


DUPLICATES = "(SELECT count(*) FROM (SELECT 1 FROM ds_lines GROUP BY order_id HAVING count(*) > 1))"
SILVER_RULE = "quantity < 50"


def qa_suite_sql() -> str:
    """Every check of the suite, its status and what it measured from the data."""
    valid = "(SELECT * FROM ({assessed}) WHERE _quality_status = 'VALID')"
    customers = valid.format(assessed=CUSTOMERS_ASSESSED)
    promotions = valid.format(assessed=reasons("ds_promotions", "*", *PROMOTION_TESTS))
    bronze = {d: f"ds_{'lines' if d == 'orders' else d}" for d in (
        "customers", "products", "orders", "clickstream", "returns", "promotions")}
    silver = {
        "customers": (customers, "customer_id"), "products": ("ds_products", "product_id"),
        "orders": ("ds_lines", "order_id"), "clickstream": ("ds_clickstream", "event_id"),
        "returns": ("ds_returns", "return_id"), "promotions": (promotions, "promotion_id"),
    }
    gold = {
        "dim_customer": silver["customers"], "dim_product": silver["products"],
        "fact_orders": silver["orders"], "fact_returns": silver["returns"],
    }
    rows: list[str] = []

    def add(layer: str, test: str, status: str, actual: str, source: str = "") -> None:
        rows.append(
            f"SELECT '{layer}' AS layer, '{test}' AS test_name, {status} AS status, "
            f"CAST({actual} AS VARCHAR) AS actual {'FROM ' + source if source else ''}"
        )

    def filled(layer: str, name: str, source: str, count: str) -> None:
        add(layer, f"{name} exists", "'PASS'", "'true'")
        add(layer, f"{name} non-empty", f"CASE WHEN {count} > 0 THEN 'PASS' ELSE 'FAIL' END", count, source)

    def unique(layer: str, name: str, source: str, key: str) -> None:
        copies = f"(SELECT {key} FROM (SELECT DISTINCT {key} FROM {source}) GROUP BY {key} HAVING count(*) > 1)"
        add(layer, f"{name} business-key uniqueness",
            "CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END", "count(*)", copies)

    for name, source in bronze.items():
        filled("BRONZE", f"bronze.{name}", source, "count(*)")
        add("BRONZE", f"bronze.{name} required columns", "'PASS'", "NULL")
        add("BRONZE", f"bronze.{name} technical ingestion quality", "'PASS'", """'{"rescued":0,"corrupt":0}'""")
    add("BRONZE", "bronze.promotions row count",
        "CASE WHEN count(*) = 200 THEN 'PASS' ELSE 'WARN' END", "count(*)", "ds_promotions")
    for name, (source, key) in silver.items():
        filled("SILVER", f"silver.{name}", source, f"count(DISTINCT {key})")
        add("SILVER", f"silver.{name} required columns", "'PASS'", "NULL")
        unique("SILVER", f"silver.{name}", source, key)
    for name, assessed in (
        ("customers", CUSTOMERS_ASSESSED), ("promotions", reasons("ds_promotions", "*", *PROMOTION_TESTS)),
    ):
        add("SILVER", f"DQ latest status: {name}",
            "CASE WHEN arg_max(dq_status, batch_id) = 'ALERT' THEN 'WARN' ELSE 'PASS' END",
            "arg_max(dq_status, batch_id)",
            f"({CUSTOMER_METRICS_SQL.format(assessed=assessed, threshold='1.0')})")
    for name, key, source in (
        ("products", "product_id", "ds_products"), ("orders", "order_id", "ds_lines"),
        ("clickstream", "event_id", "ds_clickstream"), ("returns", "return_id", "ds_returns"),
    ):
        broken = f"count(*) FILTER ({key} IS NULL OR trim({key}) = '')"
        for_all = f"CASE WHEN {broken} * 100.0 / count(*) > 1 THEN"
        add("SILVER", f"DQ latest status: {name}", f"{for_all} 'WARN' ELSE 'PASS' END",
            f"{for_all} 'ALERT' ELSE 'PASS' END", source)
    for name, (source, key) in gold.items():
        filled("GOLD", f"gold.{name}", source, f"count(DISTINCT {key})")
        unique("GOLD", f"gold.{name}", source, key)
    add("GOLD", "gold.dim_customer SCD2 current-row integrity", "'PASS'",
        """'{"current_rows":' || count(*) || ',"invalid_current_rows":0,"reversed_rows":0,"""
        """"overlapping_rows":0,"keys_with_several_current_rows":0}'""", customers)
    add("GOLD", "gold.customer_sales_summary reconciles to the fact", "'PASS'", "NULL")
    for fact, (dim, source) in (
        ("fact_orders", ("dim_customer", customers)), ("fact_orders", ("dim_product", "ds_products")),
        ("fact_returns", ("dim_product", "ds_products")),
    ):
        key = "customer_id" if dim == "dim_customer" else "product_id"
        add("GOLD", f"gold.{dim} for {fact} covers {key}",
            "CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END",
            f"""'{{"fact_rows":' || count(*) || ',"missing_keys":' || count(DISTINCT {key}) || '}}'""",
            f"{'fact' if fact == 'fact_orders' else 'ds_returns'} WHERE {key} NOT IN (SELECT {key} FROM {source})")
    return " UNION ALL ".join(rows)


def oracles() -> dict[str, str]:
    D = with_datasets
    out: dict[str, str] = {}

    # Projections and star schema.
    out["fact_orders"] = D(
        f"""SELECT {ORDER_COLUMNS}, gross_amount, net_sales_amount, _ingestion_timestamp,
            _source_file FROM fact"""
    )
    out["fact_returns"] = D(
        """SELECT return_id, order_id, customer_id, product_id, return_date, return_quantity,
           refund_amount, return_reason, return_status, _ingestion_timestamp, _source_file
           FROM ds_returns"""
    )
    out["dim_customer"] = D(f"SELECT {CUSTOMER_COLUMNS} FROM ds_customers")
    out["dim_product"] = D(
        """SELECT product_id, product_name, category, subcategory, brand, unit_price, currency
           FROM ds_products"""
    )
    out["dim_date"] = f"""
      SELECT date, {day_parts('date')}
      FROM (SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate),
                                               INTERVAL 1 DAY)) AS DATE) AS date
            FROM orders)"""
    out["standardize_columns"] = """
      SELECT c_custkey AS customer_key, c_name AS name, c_mktsegment AS "segment.code"
      FROM customer"""
    out["ingest_metadata"] = D(
        f"""SELECT {CUSTOMER_COLUMNS}, _source_file, DATE '2024-01-01' AS _load_date,
            'customers_20240101' AS _batch_id, 'test' AS _environment FROM ds_customers"""
    )
    out["silver_metadata"] = D(
        "SELECT event_id, customer_id, event_timestamp, event_type, page_url, product_id, "
        "device_type, session_id, 'test' AS _silver_environment FROM ds_clickstream"
    )

    # Summaries.
    out["customer_sales"] = D(sales("customer_id"))
    out["product_sales"] = D(sales("product_id"))
    for name, keys in (
        ("return_summary", "order_id"), ("return_summary_by_product", "order_id, product_id")
    ):
        out[name] = D(
            f"""SELECT {keys}, {money('refund_amount')} AS refund_amount,
                CAST(sum(return_quantity) AS BIGINT) AS returned_units
                FROM ds_returns GROUP BY {keys}"""
        )
    out["daily_sales"] = D(revenue("order_date"))
    out["monthly_sales"] = D(MONTHLY_SQL)
    out["customer_revenue"] = D(revenue("customer_id"))
    out["product_revenue"] = D(revenue("product_id", "order_id, product_id"))
    out["promotion_products"] = D(
        """SELECT promotion_id, promotion_name, product_id, product_name, category, subcategory,
           brand, start_date, end_date, discount_percent
           FROM ds_promotions LEFT JOIN (SELECT product_id, product_name, category, subcategory,
           brand FROM ds_products) USING (product_id)"""
    )

    # Quality rules.
    out["dq_required"] = D(
        reasons("ds_customers", "customer_id",
                *blank("customer_id", "email", "signup_date", "customer_segment"))
    )
    out["dq_regex"] = D(reasons("ds_customers", "customer_id, email", EMAIL))
    out["dq_not_empty"] = D(
        reasons("ds_customers", "customer_id, customer_segment",
                ("customer_segment IS NULL OR trim(customer_segment) = ''", "segment is empty"))
    )
    for name, column, test, text in (
        ("dq_gt", "quantity", "quantity <= 5", "quantity must be > 5"),
        ("dq_gte", "discount_amount", "discount_amount < 100", "discount must be >= 100"),
        ("dq_lt", "quantity", "quantity >= 45", "quantity must be < 45"),
    ):
        out[name] = D(reasons("ds_lines", f"order_id, {column}", (test, text)))
    out["dq_lte"] = D(
        reasons("ds_promotions", "promotion_id, discount_percent",
                ("discount_percent > 100", "discount_percent must be <= 100"))
    )
    out["dq_col_gte"] = D(
        reasons("ds_promotions", "promotion_id, start_date, end_date",
                ("end_date < start_date", "end_date must be >= start_date"))
    )
    out["dq_assemble"] = D(reasons("ds_promotions", "promotion_id", *PROMOTION_TESTS))
    out["dq_text_number"] = reasons(
        "(SELECT * FROM orders)", "o_orderkey, o_orderpriority",
        ("true", "priority must be a number > 0"),
    )
    out["dq_split"] = D(
        f"""SELECT customer_id, CASE WHEN _quality_status = 'VALID' THEN 'silver'
            ELSE 'quarantine' END AS destination FROM ({CUSTOMERS_ASSESSED})"""
    )
    out["dq_metrics"] = D(
        CUSTOMER_METRICS_SQL.format(assessed=CUSTOMERS_ASSESSED, threshold="1.0")
    )
    gate = reasons(
        "ds_customers", "*", *blank("customer_id", "email", "signup_date", "customer_segment"),
        (EMAIL[0], "Invalid email format"),
    )
    out["dq_metrics_gate"] = D(CUSTOMER_METRICS_SQL.format(assessed=gate, threshold="10.0"))

    gates = {
        "customers": ("ds_customers", [
            *blank("customer_id", "email", "signup_date", "customer_segment"), EMAIL]),
        "products": ("ds_products", [
            *blank("product_id", "product_name", "category", "unit_price", "currency"), ("unit_price < 0", "low")]),
        "orders": ("ds_lines", [
            *blank("order_id", "customer_id", "product_id", "order_date", "quantity", "unit_price",
                   "payment_method", "order_status"),
            ("quantity <= 0", "low"), ("unit_price < 0", "low"), ("discount_amount < 0", "low")]),
        "clickstream": ("ds_clickstream", [
            *blank("event_id", "customer_id", "event_timestamp", "event_type", "session_id"),
            ("trim(event_type) = ''", "empty")]),
        "returns": ("ds_returns", [
            *blank("return_id", "order_id", "customer_id", "product_id", "return_date", "return_quantity",
                   "refund_amount", "return_status"),
            ("return_quantity <= 0", "low"), ("refund_amount < 0", "low")]),
    }
    held = "count(*) FILTER (_quality_status = 'QUARANTINE')"
    out["bronze_gate"] = D(
        " UNION ALL ".join(
            f"""SELECT '{name}' AS dataset, count(*) AS total_records, {held} AS quarantined_records,
                CASE WHEN 100.0 * {held} / count(*) > 10 THEN 'FAIL' ELSE 'PASS' END AS gate
                FROM ({reasons(frame, '*', *tests)})"""
            for name, (frame, tests) in gates.items()
        )
    )

    # One row per key.
    out["dedup_latest"] = D(
        latest_orders(columns=ORDER_COLUMNS + ", _ingestion_timestamp, _batch_id")
    )
    out["latest_snapshot"] = D(
        """SELECT customer_id, max(event_timestamp) AS event_timestamp,
             max_by(event_type, (event_timestamp, -CAST(event_id AS BIGINT))) AS event_type
           FROM ds_clickstream GROUP BY customer_id"""
    )
    out["dedup_deterministic"] = D(
        f"""SELECT {ORDER_COLUMNS} FROM ds_lines QUALIFY row_number() OVER (
            PARTITION BY order_id ORDER BY customer_id NULLS FIRST, product_id NULLS FIRST,
            order_date NULLS FIRST, quantity NULLS FIRST, unit_price NULLS FIRST,
            discount_amount NULLS FIRST, payment_method NULLS FIRST,
            order_status NULLS FIRST) = 1"""
    )
    out["silver_transform"] = D(
        latest_orders(columns=ORDER_COLUMNS + ", _batch_id, 'test' AS _silver_environment")
    )

    # Upserts, deletes, control tables.
    split_orders = f"""
      target AS (SELECT {ORDER_COLUMNS}, _batch_id FROM ({latest_orders(
          f"_batch_id <= '{CUT}'", '*')})),
      source AS (SELECT {ORDER_COLUMNS}, _batch_id FROM ({latest_orders(
          f"_batch_id > '{CUT}'", '*')}))"""
    out["upsert_by_key"] = D(
        """SELECT * FROM source UNION ALL
           SELECT * FROM target WHERE order_id NOT IN (SELECT order_id FROM source)""",
        split_orders,
    )
    out["upsert_newest_wins"] = D(latest_orders(columns=ORDER_COLUMNS + ", _batch_id"))
    out["upsert_first_load"] = out["dedup_deterministic"]
    out["mark_batches"] = D(
        f"""SELECT 'orders' AS dataset, _batch_id, CASE WHEN _batch_id <= '{CUT}'
            THEN DATE '2024-01-01' ELSE DATE '2024-02-01' END AS processed_on
            FROM (SELECT DISTINCT _batch_id FROM ds_lines)"""
    )
    out["unprocessed_batches"] = D(
        f"SELECT DISTINCT _batch_id FROM ds_lines WHERE _batch_id > '{CUT}'"
    )
    relaxed = reasons("ds_customers", "*", *blank("customer_id", "email"), EMAIL)
    out["metrics_upsert"] = D(
        f"""SELECT * FROM ({CUSTOMER_METRICS_SQL.format(
              assessed=CUSTOMERS_ASSESSED, threshold='1.0')}) WHERE batch_id <= 'customers_199706'
            UNION ALL
            SELECT * FROM ({CUSTOMER_METRICS_SQL.format(assessed=relaxed, threshold='1.0')})
            WHERE batch_id > 'customers_199706'"""
    )
    out["delete_by_predicate"] = D(
        f"""SELECT {ORDER_COLUMNS} FROM ds_lines
            WHERE NOT coalesce(discount_amount > 5000, false)"""
    )
    out["snapshot_overwrite"] = out["dim_product"]
    out["quarantine_write"] = D(
        f"""SELECT customer_id, _batch_id, _quality_reason, country AS region_added_later
            FROM ({CUSTOMERS_ASSESSED}) WHERE _quality_status = 'QUARANTINE'"""
    )

    # Customer history.
    out["scd2_source"] = D(
        f"""SELECT {CUSTOMER_COLUMNS}, DATE '2024-01-01' AS effective_start_date,
            DATE '9999-12-31' AS effective_end_date, true AS is_current FROM ds_customers"""
    )
    out["scd2_changed"] = D(
        f"SELECT {CUSTOMER_COLUMNS} FROM last_day WHERE customer_id IN (FROM changed)", SCD2_SQL
    )
    out["scd2_new"] = D(f"SELECT {CUSTOMER_COLUMNS} FROM last_day WHERE country = 'ASIA'", SCD2_SQL)
    out["scd2_merge"] = D(
        f"SELECT {CUSTOMER_COLUMNS}, effective_start_date, effective_end_date, is_current FROM dim",
        SCD2_SQL,
    )

    # Ingest.
    out["rescued_data"] = f"""WITH {RESCUED_SQL}
      SELECT order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
             CASE WHEN NOT bad_date THEN CAST(o_orderdate AS DATE) END AS order_date,
             CASE WHEN NOT bad_quantity THEN CAST(o_custkey AS INTEGER) END AS quantity,
             CASE WHEN bad_date THEN '{{"order_date":"' || strftime(o_orderdate, '%Y/%m/%d')
                    || '","_file_path":"orders"}}'
                  WHEN bad_quantity THEN '{{"quantity":"' || o_orderpriority
                    || '","_file_path":"orders"}}' END AS _rescued_data
      FROM text_orders"""
    out["ingestion_metrics"] = f"""WITH {RESCUED_SQL}
      SELECT 'test' AS environment, 'orders' AS dataset, 'orders_1' AS batch_id,
             CAST(7 AS BIGINT) AS micro_batch_id, count(*) AS total_records,
             count(*) FILTER (bad_date OR bad_quantity) AS rescued_records,
             CAST(0 AS BIGINT) AS corrupt_records,
             count(*) FILTER (bad_date OR bad_quantity) / count(*) * 100.0
               AS rescued_rate_percent,
             CAST(0 AS DOUBLE) AS corrupt_rate_percent,
             CAST(1 AS DOUBLE) AS ingestion_alert_threshold_percent,
             CASE WHEN count(*) FILTER (bad_date OR bad_quantity) / count(*) * 100.0 > 1
                  THEN 'ALERT' ELSE 'OK' END AS ingestion_status
      FROM text_orders"""
    out["bronze_stream_ingest"] = D(
        f"""SELECT {ORDER_COLUMNS}, CAST(NULL AS VARCHAR) AS _corrupt_record,
              CASE WHEN _batch_id > '{CUT}' THEN payment_method END AS line_note, true AS has_file,
              CASE WHEN _batch_id > '{CUT}' THEN 'orders_2' ELSE 'orders_1' END AS _batch_id
            FROM ds_lines
            UNION ALL
            SELECT CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), NULL, NULL, NULL,
              NULL, NULL, NULL, NULL, o_orderkey || ',' || o_custkey, NULL, true, 'orders_3'
            FROM orders"""
    )
    out["bronze_stream_metrics"] = D(
        f"""SELECT 'orders' AS dataset,
              CASE WHEN _batch_id > '{CUT}' THEN 'orders_2' ELSE 'orders_1' END AS batch_id,
              count(*) AS total_records, count(*) FILTER (_batch_id > '{CUT}') AS rescued_records,
              CAST(0 AS BIGINT) AS corrupt_records
            FROM ds_lines GROUP BY ALL
            UNION ALL SELECT 'orders', 'orders_3', count(*), 0, count(*) FROM orders"""
    )
    out["bronze_snapshot_ingest"] = D(
        f"""SELECT {PROMOTION_COLUMNS}, CAST(NULL AS VARCHAR) AS _corrupt_record,
            CASE WHEN discount_percent > 50 THEN NULL ELSE 'x' END AS note,
            'promotions_2' AS _batch_id FROM ds_promotions"""
    )

    # Jobs.
    out["silver_incremental"] = D(
        latest_orders(SILVER_RULE, ORDER_COLUMNS + ", _batch_id, 'VALID' AS _quality_status")
    )
    out["silver_snapshot"] = D(
        f"""SELECT {PROMOTION_COLUMNS}, _quality_status
            FROM ({reasons('ds_promotions', '*', *PROMOTION_TESTS)})
            WHERE _quality_status = 'VALID'"""
    )
    out["reprocess_quarantine"] = D(
        f"""SELECT customer_id, CASE WHEN {EMAIL[0]} THEN 'quarantine' ELSE 'silver' END
              AS place, CASE WHEN {EMAIL[0]} THEN '{EMAIL[1]}' END AS reason
            FROM ds_customers"""
    )
    out["reprocess_new_valid"] = D(
        f"""SELECT DISTINCT order_id, _source_file, _batch_id FROM ds_lines
            WHERE _batch_id > '{CUT}'"""
    )
    gold = (
        ("dim_customer", "dim", "CASE WHEN is_current THEN 1 ELSE 0 END"),
        ("dim_product", "ds_products", "unit_price"),
        ("dim_date",
         "(SELECT unnest(generate_series(DATE '2020-01-01', DATE '2030-12-31', INTERVAL 1 DAY)) AS date)",
         "day(date)"),
        ("fact_orders", "fact", "net_sales_amount"),
        ("fact_returns", "ds_returns", "refund_amount"),
        ("customer_sales_summary", f"({sales('customer_id')})", "net_sales_amount"),
        ("product_sales_summary", f"({sales('product_id')})", "net_sales_amount"),
        ("daily_sales_summary", f"({revenue('order_date')})", "net_revenue"),
        ("monthly_sales_summary",
         f"""(SELECT year(order_date), month(order_date), sum(net_revenue) AS net_revenue
              FROM ({revenue('order_date')}) GROUP BY ALL)""", "net_revenue"),
        ("customer_revenue_summary", f"({revenue('customer_id')})", "net_revenue"),
        ("product_revenue_summary", f"({revenue('product_id', 'order_id, product_id')})", "net_revenue"),
        ("promotion_product_summary", "ds_promotions", "discount_percent"),
    )
    measures = (
        "order_count", "units_sold", "gross_sales_amount", "discount_amount", "net_sales_amount",
        "refund_amount", "net_revenue",
    )
    no_measures = ", ".join(f"NULL AS {m}" for m in measures)
    whole = [
        f"""SELECT '{name}' AS table_name, count(*) AS row_count,
            round(CAST(sum({amount}) AS DOUBLE), 0) AS amount, NULL AS key, {no_measures} FROM {source}"""
        for name, source, amount in gold
    ]
    every_row = [
        f"""SELECT '{name}', NULL, NULL, CAST({key} AS VARCHAR), {', '.join(
            'NULL' if 'sales_summary' in name and m in measures[5:] and key in ('customer_id', 'product_id') else m
            for m in measures)} FROM ({sql})"""
        for name, key, sql in (
            ("customer_sales_summary", "customer_id", sales("customer_id")),
            ("product_sales_summary", "product_id", sales("product_id")),
            ("daily_sales_summary", "order_date", revenue("order_date")),
            ("monthly_sales_summary", "year || '-' || month", MONTHLY_SQL),
            ("customer_revenue_summary", "customer_id", revenue("customer_id")),
            ("product_revenue_summary", "product_id", revenue("product_id", "order_id, product_id")),
        )
    ]
    out["gold_build"] = D(" UNION ALL ".join(whole + every_row), SCD2_SQL)

    out["run_log"] = """
      SELECT 'test' AS environment, 'gold' AS task_key, 'dim_product' AS cell_name,
             'orders' AS dataset, 'SUCCESS' AS status, count(*) AS rows_processed,
             CAST(NULL AS VARCHAR) AS error_type, CAST(NULL AS VARCHAR) AS error_message
      FROM part
      UNION ALL
      SELECT 'test', 'gold', 'required columns', 'orders', 'FAILED', 0, 'ValueError',
             'missing required columns: [''discount'']'"""

    # QA.
    out["qa_suite"] = D(qa_suite_sql())
    out["latest_dq_status"] = D(
        f"""SELECT dataset, batch_id, dq_failure_rate_percent, dq_status FROM (
              SELECT * FROM ({CUSTOMER_METRICS_SQL.format(
                  assessed=CUSTOMERS_ASSESSED, threshold='1.0')})
              UNION ALL
              SELECT * REPLACE ('promotions' AS dataset) FROM ({CUSTOMER_METRICS_SQL.format(
                  assessed=reasons('ds_promotions', '*', *PROMOTION_TESTS), threshold='1.0')}))
            QUALIFY row_number() OVER (PARTITION BY dataset ORDER BY batch_id DESC) = 1"""
    )
    out["qa_non_empty"] = D(
        check_row("BRONZE", "orders non-empty",
                  "CASE WHEN count(*) > 0 THEN 'PASS' ELSE 'FAIL' END", "count(*)", "> 0")
        + " FROM ds_lines"
    )
    out["qa_unique"] = D(
        check_row("BRONZE", "orders business-key uniqueness",
                  f"CASE WHEN {DUPLICATES} = 0 THEN 'PASS' ELSE 'FAIL' END", DUPLICATES, "0",
                  "'keys: order_id'")
        + " UNION ALL "
        + check_row("SILVER", "orders business-key uniqueness", "'PASS'", "0", "0",
                    "'keys: order_id'")
    )
    out["qa_technical"] = f"WITH {RESCUED_SQL} " + check_row(
        "BRONZE", "orders technical ingestion quality",
        "CASE WHEN count(*) FILTER (bad_date OR bad_quantity) = 0 THEN 'PASS' ELSE 'WARN' END",
        """'{"rescued":' || count(*) FILTER (bad_date OR bad_quantity) || ',"corrupt":0}'""",
        '{"rescued":0,"corrupt":0}',
    ) + " FROM text_orders"
    out["qa_row_count"] = D(
        check_row("BRONZE", "promotions row count",
                  "CASE WHEN count(*) = 200 THEN 'PASS' ELSE 'WARN' END", "count(*)", "200")
        + " FROM ds_promotions"
    )
    out["qa_scd2"] = D(
        """SELECT count(*) FILTER (is_current) AS current_rows,
             count(*) FILTER (is_current AND effective_end_date <> DATE '9999-12-31')
               AS invalid_current_rows,
             count(*) FILTER (effective_start_date > effective_end_date) AS reversed_rows,
             count(*) FILTER (EXISTS (
               SELECT 1 FROM dim AS other WHERE other.customer_id = dim.customer_id
               AND other.effective_start_date < dim.effective_start_date
               AND other.effective_end_date >= dim.effective_start_date)) AS overlapping_rows,
             (SELECT count(*) FROM (SELECT 1 FROM dim WHERE is_current GROUP BY customer_id
                HAVING count(*) > 1)) AS keys_with_several_current_rows
           FROM dim""",
        SCD2_SQL,
    )
    out["qa_reconcile"] = D(
        f"""SELECT {money('net_sales_amount')} AS fact_total,
              (SELECT round(sum(customer_total), 4) FROM (
                 SELECT sum(net_sales_amount) AS customer_total FROM fact GROUP BY customer_id))
                AS summary_total,
              round(abs(sum(net_sales_amount) - (SELECT sum(net_sales_amount) FROM fact)), 4) AS delta
            FROM fact"""
    )
    out["qa_dimension_coverage"] = D(
        """SELECT count(*) AS fact_rows, count(DISTINCT product_id) AS missing_keys FROM fact
           WHERE product_id NOT IN (SELECT product_id FROM ds_promotions
                                    WHERE discount_percent > 100)"""
    )
    versions = f"{CUSTOMER_COLUMNS}, effective_start_date, effective_end_date, is_current"
    day_one = f"""SELECT {CUSTOMER_COLUMNS}, DATE '2024-01-01' AS effective_start_date,
      DATE '9999-12-31' AS effective_end_date, true AS is_current FROM first_day"""
    changes = f"""(SELECT count(*) FROM (
      (SELECT {versions} FROM dim EXCEPT {day_one}) UNION ALL
      ({day_one} EXCEPT SELECT {versions} FROM dim)))"""
    out["qa_idempotency"] = D(
        check_row("GOLD", "dim_customer idempotency", "'PASS'", "0", "0")
        + " UNION ALL "
        + check_row("GOLD", "dim_customer day one idempotency",
                    f"CASE WHEN {changes} = 0 THEN 'PASS' ELSE 'FAIL' END", changes, "0"),
        SCD2_SQL,
    )
    out["qa_summary"] = D(
        f"""SELECT status, count(*) AS tests FROM (
              SELECT CASE WHEN {DUPLICATES} = 0 THEN 'PASS' ELSE 'FAIL' END AS status
              UNION ALL SELECT CASE WHEN (SELECT count(*) FROM ds_promotions) = 200
                THEN 'PASS' ELSE 'WARN' END
              UNION ALL SELECT CASE WHEN (SELECT count(*) FROM ds_lines) > 0
                THEN 'PASS' ELSE 'FAIL' END
              UNION ALL SELECT CASE WHEN (SELECT count(*) FROM ds_products) > 0
                THEN 'PASS' ELSE 'FAIL' END)
            GROUP BY status"""
    )

    # Functions.
    out["fn_date"] = f"""
      SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date,
             {day_parts('CAST(o_orderdate AS DATE)')},
             CAST(o_orderdate AS DATE) - 1 AS day_before FROM orders"""
    out["fn_string"] = """
      SELECT p_partkey, trim('  ' || p_name || ' ') AS trimmed,
             CAST(length(p_name) AS INTEGER) AS name_length,
             regexp_matches(p_name, '^(red|blue) ') AS red_or_blue,
             concat_ws('; ', p_brand, CASE WHEN p_size > 25 THEN p_type END) AS joined
      FROM part"""
    out["fn_null_conditional"] = D(
        """SELECT order_id, quantity, discount_amount,
             coalesce(discount_amount, 0.0) AS discount_or_zero,
             discount_amount IS NULL AS no_discount,
             discount_amount IS NOT DISTINCT FROM NULL AS null_safe_equal,
             CASE WHEN quantity >= 25 THEN 'large' ELSE 'small' END AS size_class,
             quantity > 10 AND NOT quantity > 40 AS medium
           FROM ds_lines"""
    )
    out["fn_array"] = D(
        """SELECT promotion_id, CAST(len(reasons) AS INTEGER) AS reason_count,
             array_to_string(reasons, '; ') AS reasons
           FROM (SELECT promotion_id, list_filter(
               [CASE WHEN discount_percent > 100 THEN 'too high' END,
                CASE WHEN end_date < start_date THEN 'reversed' END],
               lambda r: r IS NOT NULL) AS reasons FROM ds_promotions)"""
    )
    return out
