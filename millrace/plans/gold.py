"""Silver to gold: dimensions, facts, then summaries of the facts as stored."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping, Sequence
from functools import partial, reduce
from operator import and_, or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators import star
from millrace.operators import summaries as S
from millrace.operators.merge import absent_from
from millrace.operators.scd2 import CUSTOMER_KEY, TRACKED, scd2_merge
from millrace.plans.pieces import names, piece_of, pieces_for, row_hash
from millrace.plans.together import together
from millrace.session import FILTERED_BY_BYTES, delete_dir
from millrace.sources.dealt import MOST_BYTES, buckets_for, dealt
from millrace.sources.lake import Lake, Table, cut_into, gathered

# The span of the date dimension.
FIRST_DAY = dt.date(2020, 1, 1)
LAST_DAY = dt.date(2030, 12, 31)

SALES = ("order_count", "units_sold", "gross_sales_amount", "discount_amount", "net_sales_amount")


def upsert_gold(
    lake: Lake,
    name: str,
    source: DataFrame,
    keys: Sequence[str],
    pieces: int,
    by: Sequence[str] | None = None,
) -> DataFrame:
    """Upsert a source that is unique by ``keys`` and return the stored table.

    The table is cut by the hash of its keys, or of the columns ``by``, into slices, of which
    only those are rewritten that hold a new or changed row: stored and incoming rows meet as
    keys and row hashes. A row whose ``by`` changed leaves its old slice. Stored keys that the
    source lost stay; stored rows are read again only of slices with such keys. An empty source
    creates an empty table.
    """
    table, piece = lake.table("gold", name), piece_of(by or keys, pieces)
    if not table.exists():
        table.overwrite(cut_into(source, piece, pieces))
        return table.read()
    stored = table.read()
    alike = all(s.endswith(f"-of-{pieces}") for s in table.slices())
    if not alike or set(source.columns) - set(stored.columns):
        kept = absent_from(stored, source, keys)
        merged = source.unionByName(kept, allowMissingColumns=True)
        table.overwrite(cut_into(merged, piece, pieces))
        return table.read()
    row = row_hash(source.columns)
    new, old = (
        df.select(*keys, piece.alias("piece"), row.alias("row")).alias(side)
        for df, side in ((source, "new"), (stored, "old"))
    )
    same_key = reduce(and_, (F.col(f"new.{c}").eqNullSafe(F.col(f"old.{c}")) for c in keys))
    met = new.join(old, same_key, "full")
    # A key with a NULL equals none, so a stored row of it stays as if the source had lost it.
    nameless = reduce(or_, (F.col(f"old.{c}").isNull() for c in keys))
    stays = F.col("old.row").isNotNull() & (F.col("new.row").isNull() | nameless)
    differs = F.col("new.row").isNotNull() & ~F.col("new.row").eqNullSafe(F.col("old.row"))
    moves = F.array(
        F.struct(F.col("new.piece").alias("piece"), differs.alias("differs"), F.lit(False).alias("stays")),
        F.struct(F.col("old.piece").alias("piece"), differs.alias("differs"), stays.alias("stays")),
    )
    touched = met.where(differs | stays).select(F.inline(moves)).where("piece IS NOT NULL")
    found = touched.groupBy("piece").agg(F.max("differs").alias("differs"), F.max("stays").alias("stays")).collect()
    changed = sorted(r["piece"] for r in found if r["differs"])
    holding = sorted(r["piece"] for r in found if r["differs"] and r["stays"])
    if changed:
        merged = incoming = source.where(piece.isin(changed))
        if holding:
            kept = absent_from(table.read(holding), incoming, keys)
            merged = incoming.unionByName(kept, allowMissingColumns=True)
        table.replace_slices(cut_into(merged, piece, pieces), changed)
    return table.read()


CURRENT = "current"


def merge_customers(
    lake: Lake, customers: DataFrame, as_of: dt.date | None, pieces: int
) -> None:
    """Bring customers into the history; only pieces with a new or changed one are written.

    Current versions are cut by key hash, and stored and incoming ones meet as keys and row
    hashes. Versions closed on earlier days lie in slices of their own, one per day, and stay
    as they are; those closed on the same day are written again if anything changed.
    """
    table = lake.table("gold", "dim_customer")
    day = as_of or lake.spark.sql("SELECT current_date()").first()[0]
    closed = f"closed-{day}"
    piece = F.concat(F.lit(f"{CURRENT}-"), piece_of([CUSTOMER_KEY], pieces))
    cut = F.when(F.col("is_current"), piece).otherwise(
        F.concat(F.lit("closed-"), F.date_add("effective_end_date", 1).cast("string"))
    )
    if not table.exists():
        table.overwrite(gathered(scd2_merge(None, customers, as_of), cut))
        return
    slices = table.slices()
    held = [s for s in slices if s.startswith(f"{CURRENT}-")]
    if not held or not all(s.endswith(f"-of-{pieces}") for s in held):
        table.overwrite(gathered(scd2_merge(table.read(), customers, as_of), cut))
        return
    new, old = (
        df.select(CUSTOMER_KEY, row_hash(TRACKED).alias("row")).alias(side)
        for df, side in ((customers, "new"), (table.read(held), "old"))
    )
    same_key = F.col(f"new.{CUSTOMER_KEY}") == F.col(f"old.{CUSTOMER_KEY}")
    met = new.join(old, same_key, "left").where(~F.col("new.row").eqNullSafe(F.col("old.row")))
    touched = names(met.select(f"new.{CUSTOMER_KEY}"), piece)
    if touched:
        incoming = customers.where(piece.isin(touched))
        merged = scd2_merge(table.read(touched), incoming, as_of)
        if closed in slices:
            merged = merged.unionByName(table.read([closed]))
        table.replace_slices(gathered(merged, cut), [*touched, closed])


PIECE = "_piece"
#: Versions of orders and returns that were current when a piece was summed.
SEEN = ("_orders_version", "_returns_version")


def cut_otherwise(partials: Table, facts: Sequence[Table]) -> bool:
    """Whether sums are stored of pieces that the orders no longer have."""
    return not set(partials.slices()) <= set(facts[0].slices())


def stale_pieces(partials: Table, facts: Sequence[Table]) -> list[str]:
    """Pieces of the facts that were written since they were last summed into ``partials``.

    That is read from the stored sums, so a run that died between the two is made up for.
    """
    now = [{s: v for s, v in fact.written().items() if s} for fact in facts]
    pieces = set().union(*now)
    if not partials.exists() or cut_otherwise(partials, facts):
        return sorted(pieces)
    seen = {r[PIECE]: r for r in partials.read().select(PIECE, *SEEN).distinct().collect()}
    return sorted(
        p for p in pieces
        if p not in seen or any(v.get(p, 0) > seen[p][c] for c, v in zip(SEEN, now))
    )


def sum_sales(lake: Lake, pieces: int) -> None:
    """Summaries of orders and refunds, of which only changed pieces of the facts are read.

    Orders and returns are cut alike, by order, so a piece of one meets the same piece of the
    other only. Sums per day, customer and product of each piece are kept, those of changed
    pieces replaced, and the summaries are added up from them.
    """
    facts = [lake.table("gold", name) for name in ("fact_orders", "fact_returns")]
    seen = [max(f.written().values()) for f in facts]
    partials = {key: lake.table("gold_partials", key) for key in ("order_date", "customer_id", "product_id")}
    found = together(*[partial(stale_pieces, table, facts) for table in partials.values()])
    stale = dict(zip(partials, found))
    anew = sorted(set().union(*stale.values()))

    def cut(df: DataFrame) -> DataFrame:
        return df.withColumn(PIECE, piece_of(["order_id"], pieces))

    # The one join of orders with returns, written once and summed three ways.
    work, scratch = lake.table("work", "gold/order_refunds"), f"{lake.root}/work/gold/dealt-{uuid.uuid4().hex}"
    orders, returns = S.sold(facts[0].read(anew)), S.refunded(facts[1].read(anew))
    size = facts[0].bytes(anew) // 3  # of four columns
    # Of so many returns no filter keeps orders out of a shuffle.
    if facts[1].bytes(anew) >= FILTERED_BY_BYTES and size <= MOST_BYTES:
        buckets = buckets_for(lake.spark, size)
        orders = dealt(orders, f"{scratch}/orders", ["order_id"], buckets)
        returns = dealt(returns, f"{scratch}/returns", ["order_id"], buckets)
    work.overwrite(cut_into(cut(S.refunds_on_orders(orders, returns)), F.col(PIECE), pieces))
    delete_dir(lake.spark, scratch)

    def summed(key: str) -> DataFrame:
        table, changed = partials[key], stale[key]
        if changed or not table.exists():
            orders, refunds = cut(facts[0].read(changed)), work.read(changed)
            refunds = S.own_product(refunds) if key == "product_id" else refunds
            sums = S.partial_revenue(orders, refunds, PIECE, key)
            sums = sums.withColumns({c: F.lit(v) for c, v in zip(SEEN, seen)})
            sums = cut_into(sums, F.col(PIECE), pieces)
            if not table.exists() or cut_otherwise(table, facts):
                table.overwrite(sums)
            else:
                table.replace_slices(sums, changed)
        return S.revenue_of_partials(table.read(), key)

    def store(name: str, df: DataFrame) -> DataFrame:
        table = lake.table("gold", name)
        table.overwrite(df)
        return table.read()

    def by_day() -> None:
        daily = store("daily_sales_summary", summed("order_date"))
        store("monthly_sales_summary", S.monthly_from_daily(daily))

    def by_entity(entity: str) -> None:
        key = f"{entity}_id"
        revenue = store(f"{entity}_revenue_summary", summed(key))
        store(f"{entity}_sales_summary", revenue.select(key, *SALES))

    together(by_day, lambda: by_entity("customer"), lambda: by_entity("product"))
    work.retire()


def build_gold(
    lake: Lake,
    as_of: dt.date | None = None,
    first_day: dt.date = FIRST_DAY,
    last_day: dt.date = LAST_DAY,
    buckets: Mapping[str, int] | None = None,
) -> None:
    """Tables that do not depend on each other are written at the same time.

    ``buckets`` says into how many pieces tables are cut, by the name of the dataset they come
    from; a size decides where it names none. Returns are cut like orders.
    """
    wanted = dict(buckets or {})

    def pieces(dataset: str, name: str) -> int:
        return pieces_for(lake.table("gold", name), lake.table("silver", dataset), wanted.get(dataset))

    silver = {
        name: lake.table("silver", name).read()
        for name in ("customers", "products", "orders", "returns", "promotions")
    }

    def store(name: str, df: DataFrame) -> DataFrame:
        table = lake.table("gold", name)
        table.overwrite(df)
        return table.read()

    def summarize_orders() -> None:
        # Silver is unique by these keys, so the facts are, and counting rows counts orders.
        cut, by = pieces("orders", "fact_orders"), ["order_id"]
        together(
            lambda: upsert_gold(lake, "fact_orders", star.fact_orders(silver["orders"]), by, cut),
            lambda: upsert_gold(
                lake, "fact_returns", star.fact_returns(silver["returns"]), ["return_id"], cut, by
            ),
        )
        sum_sales(lake, cut)

    together(
        summarize_orders,
        lambda: merge_customers(
            lake, silver["customers"], as_of, pieces("customers", "dim_customer")
        ),
        lambda: upsert_gold(
            lake, "dim_product", star.dim_product(silver["products"]), ["product_id"],
            pieces("products", "dim_product"),
        ),
        lambda: store(
            "dim_date", star.dim_date(lake.spark.range(1), F.lit(first_day), F.lit(last_day))
        ),
        lambda: store(
            "promotion_product_summary",
            S.promotion_products(silver["promotions"], silver["products"]),
        ),
    )
