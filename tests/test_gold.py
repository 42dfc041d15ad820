import datetime as dt

import pytest
from pyspark.sql import functions as F

from millrace.operators import star, summaries
from millrace.plans.gold import build_gold
from millrace.session import size_for

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 2, 1)
ORDERS_DDL = (
    "order_id string, customer_id string, product_id string, order_date date, quantity int, "
    "unit_price double, discount_amount double"
)
RETURNS_DDL = (
    "return_id string, order_id string, product_id string, return_quantity int, "
    "refund_amount double"
)


def orders_of(spark, *rows):
    return spark.createDataFrame(list(rows), ORDERS_DDL).withColumns(
        {
            "payment_method": F.lit("CARD"),
            "order_status": F.lit("DONE"),
            "_ingestion_timestamp": F.lit("2024-01-01").cast("timestamp"),
            "_source_file": F.lit("f"),
        }
    )


def returns_of(spark, *rows):
    return spark.createDataFrame(list(rows), RETURNS_DDL).withColumns(
        {
            "customer_id": F.lit("someone else"),
            "return_date": F.lit(D2),
            "return_reason": F.lit("r"),
            "return_status": F.lit("s"),
            "_ingestion_timestamp": F.lit("2024-01-01").cast("timestamp"),
            "_source_file": F.lit("f"),
        }
    )


@pytest.fixture()
def facts(spark):
    orders = star.fact_orders(
        orders_of(
            spark,
            ("o1", "c1", "p1", D1, 2, 10.0, 1.0),
            ("o2", "c1", "p2", D1, 1, 5.0, None),
            ("o3", "c2", "p1", D2, 1, 10.0, None),
            ("o4", None, "p3", None, 1, 1.0, 0.25),
        )
    )
    returns = star.fact_returns(
        returns_of(
            spark,
            ("r1", "o1", "p1", 1, 3.0), ("r2", "o1", "p1", 1, 4.0),  # many
            ("r3", "o2", "p9", 1, 2.0),                              # another product
            ("r4", "oX", "p1", 1, 100.0),                            # unknown order
            ("r5", "o3", "p1", 1, None),
        )
    )
    return orders, returns


def test_fact_measures(facts, rows):
    orders, _ = facts
    assert rows(orders, "order_id", "gross_amount", "discount_amount", "net_sales_amount") == [
        ("o1", 20.0, 1.0, 19.0), ("o2", 5.0, None, 5.0), ("o3", 10.0, None, 10.0),
        ("o4", 1.0, 0.25, 0.75),
    ]


@pytest.mark.parametrize("unique", [True, False])
def test_refunds_follow_the_order(facts, rows, unique):
    orders, returns = facts
    daily = summaries.daily_sales(orders, returns, unique)
    assert rows(
        daily, "order_date", "order_count", "units_sold", "discount_amount", "refund_amount",
        "net_revenue",
    ) == [
        (D1, 2, 3, 1.0, 9.0, 15.0), (D2, 1, 1, None, 0.0, 10.0), (None, 1, 1, 0.25, 0.0, 0.75),
    ]
    by_customer = summaries.customer_revenue(orders, returns, unique)
    assert rows(by_customer, "customer_id", "refund_amount", "net_revenue") == [
        (None, 0.0, 0.75), ("c1", 9.0, 15.0), ("c2", 0.0, 10.0),
    ]
    by_product = summaries.product_revenue(orders, returns, unique)
    assert rows(by_product, "product_id", "refund_amount", "net_revenue") == [
        ("p1", 7.0, 22.0), ("p2", 0.0, 5.0), ("p3", 0.0, 0.75),
    ]
    monthly = summaries.monthly_sales(orders, returns, unique)
    assert rows(monthly, "year", "month", "order_count", "net_revenue") == [
        (2024, 1, 2, 15.0), (2024, 2, 1, 10.0), (None, None, 1, 0.75),
    ]


def test_repeated_orders_count_once_but_sum_twice(facts, rows):
    """Without a promise of unique orders the id is counted distinct, as sums are not."""
    orders, returns = facts
    doubled = orders.unionByName(orders)
    daily = summaries.daily_sales(doubled, returns)
    assert rows(daily.filter("order_date = '2024-01-01'"), "order_count", "units_sold", "refund_amount") == [
        (2, 6, 18.0)
    ]


def test_totals_lose_no_small_amounts_and_know_no_size(spark):
    """A million tiny amounts count, and a huge one beside small ones takes the same path."""
    orders = spark.range(0, 1_000_000, 1, 7).selectExpr(
        "'c' || id % 2 customer_id", "string(id) order_id", "1 quantity", "0.00004D gross_amount",
        "CAST(NULL AS DOUBLE) discount_amount", "IF(id = 1, 1e12D, 0.1D) net_sales_amount",
    )
    got = {r["customer_id"]: r for r in summaries.customer_sales(orders, True).collect()}
    assert sum(r["gross_sales_amount"] for r in got.values()) == pytest.approx(40, rel=1e-9)
    assert got["c0"]["net_sales_amount"] == pytest.approx(50_000, rel=1e-9)
    assert got["c1"]["net_sales_amount"] == pytest.approx(1e12 + 49_999.9, abs=10)
    assert got["c0"]["discount_amount"] is None


def test_build_gold_twice(spark, lake, rows):
    customers = spark.createDataFrame(
        [("c1", "Lyon"), ("c2", "Nice")], "customer_id string, city string"
    )
    for c in ("first_name", "last_name", "email", "state", "country", "customer_segment"):
        customers = customers.withColumn(c, F.lit("x"))
    customers = customers.withColumn("signup_date", F.lit(D1))
    products = spark.createDataFrame(
        [("p1", 1.0)], "product_id string, unit_price double"
    ).withColumns({c: F.lit("x") for c in ("product_name", "category", "subcategory", "brand", "currency")})
    promotions = spark.createDataFrame(
        [("P1", "p1"), ("P2", "p9")], "promotion_id string, product_id string"
    ).withColumns(
        {
            "promotion_name": F.lit("n"), "start_date": F.lit(D1), "end_date": F.lit(D2),
            "discount_percent": F.lit(5.0),
        }
    )

    def silver(name, df):
        lake.table("silver", name).overwrite(df)

    silver("customers", customers)
    silver("products", products)
    silver("promotions", promotions)
    silver("orders", orders_of(spark, ("o1", "c1", "p1", D1, 2, 10.0, 1.0), ("o2", "c2", "p1", D1, 1, 5.0, None)))
    silver("returns", returns_of(spark, ("r1", "o1", "p1", 1, 3.0)))
    build_gold(lake, D1)

    def gold(name, *columns):
        return rows(lake.table("gold", name).read(), *columns)

    assert lake.table("gold", "dim_date").read().count() == 4018
    assert gold("daily_sales_summary", "net_revenue") == [(21.0,)]
    assert gold("promotion_product_summary", "promotion_id", "brand") == [("P1", "x"), ("P2", None)]
    first = gold("fact_orders")
    build_gold(lake, D1)
    assert gold("fact_orders") == first and len(gold("dim_customer")) == 2

    # silver loses o1 and changes o2: gold keeps the first and takes the change
    silver("orders", orders_of(spark, ("o2", "c2", "p1", D1, 3, 5.0, None)))
    silver("customers", customers.withColumn("city", F.lit("Paris")))
    build_gold(lake, D2)
    assert gold("fact_orders", "order_id", "quantity") == [("o1", 2), ("o2", 3)]
    assert len(gold("dim_customer")) == 4
    assert gold("customer_sales_summary", "customer_id", "net_sales_amount") == [("c1", 19.0), ("c2", 15.0)]
    assert gold("product_sales_summary", "order_count", "units_sold") == [(2, 5)]
    assert gold("product_revenue_summary", "refund_amount", "net_revenue") == [(3.0, 31.0)]


def test_empty_facts_create_empty_tables(spark, facts, rows):
    orders, returns = facts
    assert summaries.daily_sales(orders.limit(0), returns).count() == 0
    assert rows(summaries.customer_revenue(orders, returns.limit(0)), "refund_amount") == [
        (0.0,), (0.0,), (0.0,)
    ]


def test_closed_history_and_untouched_slices_stay_as_they_are(spark, lake, rows):
    """Files of versions closed on earlier days, and of slices without a changed key, are not written again."""
    from millrace.operators.scd2 import TRACKED
    from millrace.plans.gold import merge_customers, upsert_gold

    def customers(**cities):
        frame = spark.createDataFrame(list(cities.items()), "customer_id string, city string")
        others = {c: F.lit("x") for c in TRACKED if c not in ("city", "signup_date")}
        return frame.withColumns(others).withColumn("signup_date", F.lit(D1))

    table = lake.table("gold", "dim_customer")
    days = [dt.date(2024, 1, d) for d in (1, 2, 3)]
    merge_customers(lake, customers(a="Lyon", b="Nice"), days[0], 4)
    merge_customers(lake, customers(a="Paris", b="Nice"), days[1], 4)
    closed = table._located()["closed-2024-01-02"]
    merge_customers(lake, customers(a="Paris", b="Metz", c="Brest"), days[2], 4)
    merge_customers(lake, customers(a="Paris", b="Metz", c="Brest"), days[2], 4)
    assert table._located()["closed-2024-01-02"] == closed
    got = rows(table.read(), "customer_id", "city", "is_current")
    assert got == [
        ("a", "Lyon", False), ("a", "Paris", True), ("b", "Metz", True), ("b", "Nice", False), ("c", "Brest", True),
    ]

    facts = spark.range(200).selectExpr("string(id) order_id", "1.0D amount")
    upsert_gold(lake, "fact", facts, ["order_id"], 8)
    before = lake.table("gold", "fact")._located()
    changed = facts.withColumn("amount", F.when(F.col("order_id") == "7", 2.0).otherwise(F.col("amount")))
    upsert_gold(lake, "fact", changed, ["order_id"], 8)
    after = lake.table("gold", "fact")._located()
    assert sum(before[s] != after[s] for s in before) == 1
    assert lake.table("gold", "fact").read().agg(F.sum("amount")).first()[0] == 201.0
    upsert_gold(lake, "fact", changed.filter("order_id <> '7'"), ["order_id"], 8)
    assert lake.table("gold", "fact")._located() == after


def customers_of(spark, cities):
    from millrace.operators.scd2 import TRACKED

    frame = spark.createDataFrame(list(cities.items()), "customer_id string, city string")
    others = {c: F.lit("x") for c in TRACKED if c not in ("city", "signup_date")}
    return frame.withColumns(others).withColumn("signup_date", F.lit(D1))


def test_one_changed_customer_rewrites_one_piece(spark, lake, rows):
    from millrace.plans.gold import merge_customers

    cities = {f"c{i}": "Lyon" for i in range(60)}
    table = lake.table("gold", "dim_customer")
    merge_customers(lake, customers_of(spark, cities), D1, 8)
    before = table.written()
    assert len(before) == 8
    merge_customers(lake, customers_of(spark, cities), D2, 8)
    assert table.written() == before
    merge_customers(lake, customers_of(spark, {**cities, "c7": "Nice"}), D2, 8)
    after = table.written()
    assert sum(after[s] != v for s, v in before.items()) == 1
    assert set(after) - set(before) == {"closed-2024-02-01"}
    # Another number of pieces, later: the same history, closed versions in the slices of their days.
    other = dt.date(2024, 3, 1)
    merge_customers(lake, customers_of(spark, {**cities, "c7": "Metz", "new": "Brest"}), other, 3)
    assert {s for s in table.slices() if s.startswith("closed")} == {"closed-2024-02-01", "closed-2024-03-01"}
    assert {s for s in table.slices() if s.startswith("current")} == {f"current-{i}-of-3" for i in range(3)}
    got = rows(table.read().filter("customer_id IN ('c7', 'new')"), "customer_id", "city", "effective_start_date", "is_current")
    assert got == [("c7", "Lyon", D1, False), ("c7", "Metz", other, True), ("c7", "Nice", D2, False), ("new", "Brest", other, True)]
    assert table.read().count() == 63


def test_a_value_that_moves_to_an_empty_column_is_a_change(spark, lake, rows):
    from millrace.plans.gold import upsert_gold

    ddl = "id string, a string, b string"
    upsert_gold(lake, "t", spark.createDataFrame([("1", "x", None), ("2", "y", None)], ddl), ["id"], 2)
    upsert_gold(lake, "t", spark.createDataFrame([("1", None, "x")], ddl), ["id"], 2)
    assert rows(lake.table("gold", "t").read()) == [("1", None, "x"), ("2", "y", None)]


def test_a_row_cut_by_another_column_moves_with_it(spark, lake, rows):
    from millrace.plans.gold import upsert_gold

    first = spark.range(40).selectExpr("string(id) return_id", "string(id % 10) order_id")
    upsert_gold(lake, "r", first, ["return_id"], 4, ["order_id"])
    second = first.withColumn("order_id", F.when(F.col("return_id") == "3", "8").otherwise(F.col("order_id")))
    upsert_gold(lake, "r", second, ["return_id"], 4, ["order_id"])
    assert rows(lake.table("gold", "r").read()) == rows(second)
    from millrace.plans.pieces import piece_of

    for name in lake.table("gold", "r").slices():
        assert rows(lake.table("gold", "r").read([name])) == rows(second.where(piece_of(["order_id"], 4) == name))


def test_summaries_read_changed_pieces_only_and_equal_a_full_build(spark, lake, rows):
    from millrace.plans import gold
    from millrace.sources.lake import Lake

    def facts_of(extra, refund):
        orders = spark.range(300).selectExpr(
            "string(id) order_id", "string(id % 17) customer_id", "string(id % 5) product_id",
            "date_add(date'2024-01-01', cast(id % 40 as int)) order_date",
            f"cast(IF(id = 5, {extra}, id % 3) as int) quantity", "cast(id as double) gross_amount",
            "IF(id % 2 = 0, NULL, 1.5D) discount_amount", "cast(id as double) net_sales_amount",
        )
        returns = spark.range(60).selectExpr(
            "string(id) return_id", "string(id * 6) order_id", "string(id % 5) product_id",
            "1 return_quantity", f"IF(id = 2, {refund}, 2.5D) refund_amount",
        )
        return orders, returns

    def store(where, extra, refund, pieces=8):
        orders, returns = facts_of(extra, refund)
        gold.upsert_gold(where, "fact_orders", orders, ["order_id"], pieces)
        gold.upsert_gold(where, "fact_returns", returns, ["return_id"], pieces, ["order_id"])

    def summaries_of(where):
        names = [f"{k}_{w}_summary" for k in ("customer", "product") for w in ("revenue", "sales")]
        return {n: rows(where.table("gold", n).read()) for n in (*names, "daily_sales_summary", "monthly_sales_summary")}

    def built(extra, refund):
        whole = Lake(spark, f"{lake.root}-{extra}-{refund}")
        store(whole, extra, refund)
        gold.sum_sales(whole, 8)
        return summaries_of(whole)

    partials = lake.table("gold_partials", "customer_id")
    store(lake, 1, 0.5)
    gold.sum_sales(lake, 8)
    assert summaries_of(lake) == built(1, 0.5)
    before = partials.written()
    assert len(before) == 8

    # One order and one return change. The first attempt dies between the facts and the sums.
    store(lake, 9, 7.5)
    store(lake, 9, 7.5)
    facts = [lake.table("gold", f"fact_{n}") for n in ("orders", "returns")]
    stale = gold.stale_pieces(partials, facts)
    assert 1 <= len(stale) <= 2
    gold.sum_sales(lake, 8)
    after = partials.written()
    assert sorted(s for s in after if after[s] != before[s]) == stale
    assert summaries_of(lake) == built(9, 7.5)
    assert gold.stale_pieces(partials, facts) == []

    # Cut anew, all is summed again.
    store(lake, 9, 7.5, pieces=3)
    gold.sum_sales(lake, 3)
    assert set(partials.slices()) == {f"{i}-of-3" for i in range(3)}
    assert summaries_of(lake) == built(9, 7.5)


def test_number_of_pieces_follows_the_size(spark, lake, monkeypatch):
    from millrace.plans import pieces

    source, table = lake.table("silver", "s"), lake.table("gold", "t")
    assert pieces.pieces_for(table, source) == pieces.LEAST_PIECES
    source.overwrite(spark.range(1000))
    monkeypatch.setattr(pieces, "PIECE_BYTES", max(1, source.bytes() // 20))
    assert 20 <= pieces.pieces_for(table, source) <= 22
    assert pieces.pieces_for(table, source, 3) == 3
    from millrace.plans.gold import upsert_gold

    upsert_gold(lake, "t", spark.range(100).selectExpr("string(id) id"), ["id"], 6)
    assert pieces.pieces_for(table, source) == 6
    upsert_gold(lake, "t", spark.range(100).selectExpr("string(id) id"), ["id"], 4)
    assert 20 <= pieces.pieces_for(table, source) <= 22


def _shuffled_rows(node):
    """Rows written by each shuffle of a plan that has run."""
    name = node.nodeName()
    if name == "AdaptiveSparkPlan":
        return _shuffled_rows(node.executedPlan())
    if name.endswith("QueryStage"):
        return _shuffled_rows(node.plan())
    own = [node.metrics().apply("shuffleRecordsWritten").value()] if name == "Exchange" else []
    below = node.children()
    return own + [n for i in range(below.size()) for n in _shuffled_rows(below.apply(i))]


def test_only_returned_orders_are_shuffled_to_meet_their_returns(spark, tmp_path, rows):
    """40,000 orders, 400 returns, some of unknown orders, of nothing or without an amount."""
    spark.range(40000).selectExpr(
        "CAST(id AS STRING) order_id", "DATE '2024-01-01' order_date", "CAST(id % 9 AS STRING) customer_id",
        "CAST(id % 7 AS STRING) product_id", "1 quantity", "2D gross_amount", "0D discount_amount", "2D net_sales_amount",
    ).write.parquet(str(tmp_path / "orders"))
    spark.range(400).selectExpr(
        "CAST(id * 110 AS STRING) order_id", "CAST(id * 110 % 7 AS STRING) product_id", "1 return_quantity",
        "CASE WHEN id % 10 = 1 THEN 0D WHEN id % 10 > 1 THEN 0.5D END refund_amount",
    ).write.parquet(str(tmp_path / "returns"))
    cluster = spark.newSession()
    size_for(cluster, 100 * 2**40)
    cluster.conf.set("spark.sql.shuffle.partitions", "4")
    cluster.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    cluster.conf.set("spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold", "0")

    def refunds(session):
        orders, returns = (session.read.parquet(str(tmp_path / t)) for t in ("orders", "returns"))
        return summaries.refunds_on_orders(orders, returns), summaries.product_revenue(orders, returns, True)

    joined, revenue = refunds(cluster)
    plain, plain_revenue = refunds(spark)
    assert len(rows(joined)) == 290 and rows(joined) == rows(plain)
    assert rows(revenue) == rows(plain_revenue)
    assert sum(r["refund_amount"] for r in revenue.collect()) == 145.0
    assert "might_contain" in joined._jdf.queryExecution().optimizedPlan().toString()
    of_orders = max(_shuffled_rows(joined._jdf.queryExecution().executedPlan()))
    assert of_orders < 1000

    # A side too large for the filter's bits makes none.
    cluster.conf.set("spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold", "1")
    unfiltered, _ = refunds(cluster)
    assert rows(unfiltered) == rows(plain)
    assert max(_shuffled_rows(unfiltered._jdf.queryExecution().executedPlan())) == 40000


def test_stored_rows_are_read_again_only_of_slices_that_keep_some(spark, lake, rows, monkeypatch):
    import millrace.plans.gold as plan

    read, absent = [], plan.absent_from
    monkeypatch.setattr(plan, "absent_from", lambda kept, *a: read.append(kept.count()) or absent(kept, *a))

    def upsert(*pairs):
        found = plan.upsert_gold(lake, "t", spark.createDataFrame(list(pairs), "k string, v int"), ["k"], 4)
        return rows(found.select("k", "v"))

    all_of = [(f"k{i}", 0) for i in range(40)]
    assert upsert(*all_of) == sorted(all_of)
    changed = [(k, 1) for k, _ in all_of]
    assert upsert(*changed) == sorted(changed) and read == []
    assert upsert(*[(k, 2) for k, _ in all_of[1:]]) == sorted([("k0", 1)] + [(k, 2) for k, _ in all_of[1:]])
    assert len(read) == 1 and read[0] < 40
    # a key with a NULL equals none: what is stored stays, what comes in is added
    assert len(upsert(*[(k, 2) for k, _ in all_of[1:]], (None, 1))) == 41
    assert sum(k is None for k, _ in upsert(*[(k, 3) for k, _ in all_of], (None, 1))) == 2
