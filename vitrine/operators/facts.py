"""Fact jobs: orders (with payment and review roll-ups), order items, reviews.

Each builder is a pure DataFrame function of the batch's staging rows, the
current dimensions and (optionally) the rows already loaded, which are
excluded with an anti join so a re-run adds nothing twice.

Join order is chosen to shuffle the big side as few times as possible:
orders are first reduced to not-yet-loaded rows and joined to the roll-ups,
which are already hash-partitioned by ``order_id`` by their own aggregation,
so only the customer lookup needs a second exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.functions import columns as C
from vitrine.functions import lookups as L
from vitrine.operators.quality import in_batch
from vitrine.sources.feeds import Staging

# --- FIXED VALUES: column names and order of the warehouse's fact tables ---
FACT_ORDER_COLUMNS = [
    "order_id",
    "customer_key",
    "order_date_key",
    "approved_date_key",
    "delivered_date_key",
    "estimated_delivery_date_key",
    "order_status",
    "total_payment_value",
    "payment_installments_max",
    "payment_type_primary",
    "num_payment_methods",
    "days_to_deliver",
    "days_to_approve",
    "delivery_delay_days",
    "is_late_delivery",
    "review_score",
    "has_review",
    "etl_batch_id",
]
FACT_ITEM_COLUMNS = [
    "order_id",
    "order_item_id",
    "order_date_key",
    "customer_key",
    "product_key",
    "seller_key",
    "price",
    "freight_value",
    "total_item_value",
    "etl_batch_id",
]
FACT_REVIEW_COLUMNS = [
    "review_id",
    "order_id",
    "review_date_key",
    "review_score",
    "sentiment",
    "has_comment_title",
    "has_comment_message",
    "response_days",
    "etl_batch_id",
]


def _batch(batch_id: int | None) -> Column:
    return F.lit(batch_id).cast("long") if batch_id is not None else F.col("etl_batch_id")


# ------------------------------------------------------------ idempotency


def not_yet_loaded(rows: DataFrame, loaded: DataFrame | None, keys: list[str]) -> DataFrame:
    """``rows`` whose key is not in ``loaded`` (the NOT EXISTS guard of a re-run).

    The loaded history is first cut down to this batch's keys with a semi
    join: when the batch's key set is small (a daily batch, a re-run), adaptive
    execution broadcasts it and the history is only scanned for one column,
    never shuffled. The anti join then meets a table no larger than the batch.
    """
    if loaded is None:
        return rows
    batch_keys = rows.select(*keys).distinct()
    seen = loaded.select(*keys).join(batch_keys, keys, "left_semi")
    return rows.join(seen, keys, "left_anti")


# ------------------------------------------------------------------ roll-ups


def payment_type_totals(stg: Staging, batch_id: int | None = None) -> DataFrame:
    """Payments summed per (order, payment type); an amount too large for the column counts as none.

    Payments are dealt by order before they are summed, so that both this sum
    and a further one per order need no other exchange, and no task that reads
    the feed holds the sums of its whole split.
    """
    amount = C.parse_amount("payment_value")
    fits = amount.try_cast(C.PAYMENT_TOTAL_TYPE).isNotNull()
    p = in_batch(stg.order_payments, batch_id).select(
        "order_id", "payment_type", "payment_installments", F.when(fits, amount).alias("amount")
    )
    return p.repartition("order_id").groupBy("order_id", "payment_type").agg(
        F.sum("amount").alias("type_total"),
        F.max("payment_installments").alias("type_max_installments"),
    )


def payments_rollup(stg: Staging, batch_id: int | None = None) -> DataFrame:
    """Per order: total value, max installments, number of types, primary type.

    The primary type is the type with the greatest summed value; ties go to
    the greatest type name, and a type whose sum is NULL ranks first (NULLs
    sort first in a descending order). Two grouped aggregates after one
    exchange; the struct ``max`` does the arg-max.
    """
    per_type = payment_type_totals(stg, batch_id)
    rank = F.struct(
        F.col("type_total").isNull().alias("n"), F.col("type_total").alias("v"), F.col("payment_type").alias("t")
    )
    return per_type.groupBy("order_id").agg(
        F.sum("type_total").alias("total_payment"),
        F.max("type_max_installments").alias("max_installments"),
        F.count("payment_type").alias("num_methods"),
        F.max(rank)["t"].alias("primary_payment_type"),
    )


def reviews_rollup(stg: Staging, batch_id: int | None = None) -> DataFrame:
    """Per order: highest review score and highest review id (independently)."""
    r = in_batch(stg.order_reviews, batch_id)
    return r.groupBy("order_id").agg(
        F.max("review_score").alias("review_score"), F.max("review_id").alias("review_id")
    )


# ------------------------------------------------------------ customer lookup


def customer_lookup_rows(
    stg: Staging, dim_customer: DataFrame, batch_id: int | None = None, mode: str = "customer_id"
) -> DataFrame:
    """(customer_id, customer_key, customer_unique_id) used to resolve orders.

    ``customer_id``: literal lookup on the dimension's order-level id (only the
    surviving id of a repeat customer resolves). ``bridge``: every staged
    customer_id of the batch maps through its unique id to the key.
    """
    dim = dim_customer.select("customer_key", "customer_unique_id", F.col("customer_id").alias("_dim_cid"))
    if mode == "customer_id":
        return dim.select(F.col("_dim_cid").alias("customer_id"), "customer_key", "customer_unique_id")
    if mode == "bridge":
        ids = in_batch(stg.customers, batch_id).select("customer_id", "customer_unique_id").distinct()
        return ids.join(dim.drop("_dim_cid"), "customer_unique_id").select(
            "customer_id", "customer_key", "customer_unique_id"
        )
    raise ValueError(f"unknown customer lookup mode: {mode}")


# ------------------------------------------------------------------- orders


def _orders_to_load(stg: Staging, batch_id: int | None, loaded: DataFrame | None) -> DataFrame:
    return not_yet_loaded(in_batch(stg.orders, batch_id), loaded, ["order_id"])


def fact_orders(
    stg: Staging,
    dim_customer: DataFrame,
    batch_id: int | None = None,
    loaded: DataFrame | None = None,
    customer_lookup: str = "customer_id",
) -> DataFrame:
    """FACT_ORDERS rows of a batch (plus ``customer_unique_id`` for reporting).

    Orders whose customer does not resolve are not returned (see
    ``fact_orders_unresolved``); nor are orders without an id or whose purchase
    date does not parse (both are required).
    """
    # Days are parsed before the joins: a day is a quarter of its text in an exchange.
    texts = {
        "purchase": "order_purchase_timestamp",
        "approved": "order_approved_at",
        "delivered": "order_delivered_customer_date",
        "estimated": "order_estimated_delivery_date",
    }
    days = {f"_{name}": C.parse_day(text) for name, text in texts.items()}
    o = _orders_to_load(stg, batch_id, loaded).withColumns(days).drop(*texts.values())
    pay = payments_rollup(stg, batch_id)
    rev = reviews_rollup(stg, batch_id).withColumnRenamed("review_score", "r_score").withColumnRenamed(
        "review_id", "r_id"
    )
    j = o.join(pay, "order_id", "left").join(rev, "order_id", "left")
    cust = customer_lookup_rows(stg, dim_customer, batch_id, customer_lookup)
    j = j.join(cust, "customer_id")

    purchase, approved, delivered, estimated = (F.col(day) for day in days)
    late = delivered.isNotNull() & estimated.isNotNull() & (delivered > estimated)
    out = j.select(
        "order_id",
        "customer_key",
        "customer_unique_id",
        C.date_key(purchase).alias("order_date_key"),
        C.date_key(approved).alias("approved_date_key"),
        C.date_key(delivered).alias("delivered_date_key"),
        C.date_key(estimated).alias("estimated_delivery_date_key"),
        F.upper("order_status").alias("order_status"),
        F.coalesce("total_payment", F.lit(0)).try_cast(C.PAYMENT_TOTAL_TYPE).alias("total_payment_value"),
        F.coalesce("max_installments", F.lit(1)).cast("long").alias("payment_installments_max"),
        "primary_payment_type",
        F.coalesce("num_methods", F.lit(1)).cast("long").alias("num_payment_methods"),
        F.datediff(delivered, purchase).alias("days_to_deliver"),
        F.datediff(approved, purchase).alias("days_to_approve"),
        F.datediff(delivered, estimated).alias("delivery_delay_days"),
        C.yes_no(late).alias("is_late_delivery"),
        F.col("r_score").cast("int").alias("review_score"),
        C.yes_no(F.col("r_id").isNotNull()).alias("has_review"),
        _batch(batch_id).alias("etl_batch_id"),
    ).withColumnRenamed("primary_payment_type", "payment_type_primary")
    return out.filter(F.col("order_id").isNotNull() & F.col("order_date_key").isNotNull())


def fact_orders_unresolved(
    stg: Staging,
    dim_customer: DataFrame,
    batch_id: int | None = None,
    loaded: DataFrame | None = None,
    customer_lookup: str = "customer_id",
) -> DataFrame:
    """Staged orders that the fact load leaves out, each once, with the first reason that holds."""
    o = _orders_to_load(stg, batch_id, loaded)
    cust = customer_lookup_rows(stg, dim_customer, batch_id, customer_lookup).select(
        F.col("customer_id").alias("_cid"), F.lit(True).alias("_known")
    )
    j = o.join(cust.distinct(), o["customer_id"] == cust["_cid"], "left")
    reason = (
        F.when(F.col("order_id").isNull(), L.REJECT_NULL_ORDER_ID)
        .when(F.col("_known").isNull(), L.REJECT_NO_CUSTOMER)
        .when(C.to_date_key("order_purchase_timestamp").isNull(), L.REJECT_NO_ORDER_DATE)
    )
    return j.select("order_id", "customer_id", reason.alias("reason")).filter(F.col("reason").isNotNull())


# -------------------------------------------------------------------- items


def resolved_items(
    stg: Staging,
    dim_customer: DataFrame,
    dim_product: DataFrame,
    dim_seller: DataFrame,
    batch_id: int | None = None,
    loaded: DataFrame | None = None,
) -> DataFrame:
    """Every staged item not loaded yet: its fact columns, and ``reason`` if the load must leave it out.

    Items resolve their order within the same batch and the *current* product
    version. Orders are joined to the customer first (the smaller side), so
    the item stream is shuffled once per lookup key: order, product, seller.
    Outer joins keep the items that do not resolve, for the reject table.
    """
    i = not_yet_loaded(in_batch(stg.order_items, batch_id), loaded, ["order_id", "order_item_id"])
    # Amounts are parsed before the joins: a filter on the reason, which needs the joins, then reads the parsed ones.
    price, freight = (C.parse_amount_as(c, C.PRICE_TYPE) for c in ("price", "freight_value"))
    too_large = C.amount_overflows("price", C.PRICE_TYPE) | C.amount_overflows("freight_value", C.PRICE_TYPE)
    i = i.select(
        "order_id", "order_item_id", "product_id", "seller_id", "etl_batch_id",
        price.alias("price"), freight.alias("freight_value"), too_large.alias("_too_large"),
    )
    o = (
        in_batch(stg.orders, batch_id)
        .filter(F.col("order_id").isNotNull())
        .select(
            "order_id",
            "customer_id",
            C.to_date_key("order_purchase_timestamp").alias("order_date_key"),
            F.lit(True).alias("_staged"),
        )
    )
    cust = dim_customer.select("customer_id", "customer_key", "customer_unique_id")
    oc = o.join(cust, "customer_id", "left").drop("customer_id")
    prod = dim_product.filter(F.col("is_current") == "Y").select("product_id", "product_key")
    sell = dim_seller.select("seller_id", "seller_key")
    j = i.join(oc, "order_id", "left").join(prod, "product_id", "left").join(sell, "seller_id", "left")
    reason = (
        F.when(F.col("order_id").isNull() | F.col("order_item_id").isNull(), L.REJECT_NULL_ITEM_KEY)
        .when(F.col("_staged").isNull(), L.REJECT_NO_ORDER)
        .when(F.col("order_date_key").isNull(), L.REJECT_NO_ORDER_DATE)
        .when(F.col("customer_key").isNull(), L.REJECT_NO_CUSTOMER)
        .when(F.col("product_key").isNull(), L.REJECT_NO_PRODUCT)
        .when(F.col("seller_key").isNull(), L.REJECT_NO_SELLER)
        .when(F.col("_too_large"), L.REJECT_AMOUNT_RANGE)
    )
    return j.select(
        "order_id",
        "order_item_id",
        "order_date_key",
        "customer_key",
        "product_key",
        "seller_key",
        "customer_unique_id",
        "product_id",
        "seller_id",
        "price",
        "freight_value",
        (F.col("price") + F.col("freight_value")).cast(C.ITEM_TOTAL_TYPE).alias("total_item_value"),
        _batch(batch_id).alias("etl_batch_id"),
        reason.alias("reason"),
    )


def fact_order_items(
    stg: Staging,
    dim_customer: DataFrame,
    dim_product: DataFrame,
    dim_seller: DataFrame,
    batch_id: int | None = None,
    loaded: DataFrame | None = None,
) -> DataFrame:
    """FACT_ORDER_ITEMS rows of a batch (with product/seller/customer ids): the items that resolve."""
    rows = resolved_items(stg, dim_customer, dim_product, dim_seller, batch_id, loaded)
    # The lookups' keys are known where there is no reason; said apart, rows that miss one take no part in the next exchange.
    resolved = [F.col(key).isNotNull() for key in ("customer_key", "product_key", "seller_key")]
    return rows.filter(F.col("reason").isNull() & resolved[0] & resolved[1] & resolved[2]).drop("reason")


def fact_order_items_unresolved(
    stg: Staging,
    dim_customer: DataFrame,
    dim_product: DataFrame,
    dim_seller: DataFrame,
    batch_id: int | None = None,
    loaded: DataFrame | None = None,
) -> DataFrame:
    """Staged items that the fact load leaves out, each with the first reason that holds."""
    rows = resolved_items(stg, dim_customer, dim_product, dim_seller, batch_id, loaded)
    cols = ["order_id", "order_item_id", "product_id", "seller_id", "reason"]
    return rows.filter(F.col("reason").isNotNull()).select(*cols)


# ------------------------------------------------------------------ reviews


def fact_reviews(
    stg: Staging, batch_id: int | None = None, loaded: DataFrame | None = None, one_per_key: bool = False
) -> DataFrame:
    """FACT_REVIEWS rows: scores 1..5 only (NULL and out-of-range are skipped).

    Like the source, duplicates of a review id inside one batch are all
    loaded unless ``one_per_key`` keeps only the greatest row per id.
    """
    r = in_batch(stg.order_reviews, batch_id).filter(F.col("review_score").between(1, 5))
    r = r.filter(F.col("review_id").isNotNull())
    r = not_yet_loaded(r, loaded, ["review_id"])
    if one_per_key:
        cols = [c for c in r.columns if c != "review_id"]
        r = r.groupBy("review_id").agg(F.max(F.struct(*cols)).alias("_r")).select("review_id", "_r.*")
    created = C.parse_day("review_creation_date")
    answered = C.parse_day("review_answer_timestamp")
    return r.select(
        "review_id",
        "order_id",
        C.date_key(created).alias("review_date_key"),
        F.col("review_score").cast("int").alias("review_score"),
        C.sentiment("review_score").alias("sentiment"),
        C.yes_no(F.col("review_comment_title").isNotNull()).alias("has_comment_title"),
        C.yes_no(F.col("review_comment_message").isNotNull()).alias("has_comment_message"),
        F.datediff(answered, created).alias("response_days"),
        _batch(batch_id).alias("etl_batch_id"),
    )


def fact_reviews_unresolved(stg: Staging, batch_id: int | None = None, loaded: DataFrame | None = None) -> DataFrame:
    """Staged reviews that the fact load leaves out, with the first reason that holds."""
    r = not_yet_loaded(in_batch(stg.order_reviews, batch_id), loaded, ["review_id"])
    reason = F.when(F.col("review_id").isNull(), L.REJECT_NULL_REVIEW).when(
        ~F.coalesce(F.col("review_score").between(1, 5), F.lit(False)), L.REJECT_NO_SCORE
    )
    return r.select("review_id", "order_id", reason.alias("reason")).filter(F.col("reason").isNotNull())
