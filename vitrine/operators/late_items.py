"""Order items that arrive before their order, product or seller.

Each batch tries its staged items and those that earlier batches left waiting.
An item that resolves is loaded by the batch that resolves it; one that a later
batch may still resolve waits, with the reason; one that no batch can load is
rejected at once. Every item is loaded exactly once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.functions import columns as C
from vitrine.functions import lookups as L

ITEM_KEY = ["order_id", "order_item_id"]
WAITING_COLUMNS = ["order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value", "etl_batch_id"]
#: What becomes of a tried item.
LOADS, WAITS, REJECTED, REPEATED = "loads", "waits", "rejected", "repeated"


def latest_sent(waiting: DataFrame, staged: DataFrame, loaded: DataFrame) -> DataFrame:
    """One row per item key of those waiting and those staged: the one of the latest batch, then the greatest.

    ``n_sent`` counts the rows of the key, so that further ones can be balanced;
    ``seen`` says whether ``loaded`` holds it, of which only keys sent again are
    read on. Rows with a NULL in their key stay as they are, one by one. All are
    dealt by their order once, which also serves joins on the order.
    """
    rows = _sent(waiting, staged, WAITING_COLUMNS)
    known = F.col("order_id").isNotNull() & F.col("order_item_id").isNotNull()
    rest = ["etl_batch_id", *[c for c in WAITING_COLUMNS if c not in ITEM_KEY and c != "etl_batch_id"]]
    alone = F.when(~known, F.monotonically_increasing_id())
    sent = rows.select(*ITEM_KEY, alone.alias("alone"), F.struct(*rest).alias("r"))
    again = loaded.select(*ITEM_KEY).join(_sent(waiting, staged, ITEM_KEY), ITEM_KEY, "left_semi")
    again = again.select(*[F.col(k).cast(sent.schema[k].dataType) for k in ITEM_KEY])
    return (
        sent.unionByName(again, allowMissingColumns=True)
        .repartition("order_id")
        .groupBy(*ITEM_KEY, "alone")
        .agg(F.max("r").alias("r"), F.count("r").alias("n_sent"), F.max(F.col("r").isNull()).alias("seen"))
        .select(*ITEM_KEY, *[F.col(f"r.{c}").alias(c) for c in rest], "n_sent", "seen")
    )


def _sent(waiting: DataFrame, staged: DataFrame, columns: list[str]) -> DataFrame:
    return waiting.select(*columns).unionByName(staged.select(*columns))


def try_items(
    waiting: DataFrame,
    staged: DataFrame,
    loaded: DataFrame,
    fact_orders: DataFrame,
    dim_product: DataFrame,
    dim_seller: DataFrame,
    batch_id: int,
) -> DataFrame:
    """Every item key of ``waiting`` and ``staged`` with its ``outcome``, its ``reason`` and its fact columns.

    ``loaded``: items that a fact holds already (``repeated``: not loaded
    again). An order resolves through ``fact_orders``, which holds this batch's
    orders and all earlier ones; it is first cut to the orders of these items.
    The result holds the columns of a waiting row as well (amounts as text:
    ``price_text``, ``freight_text``).
    """
    rows = latest_sent(waiting, staged, loaded).withColumnsRenamed({"price": "price_text", "freight_value": "freight_text"})
    orders = fact_orders.select("order_id", "order_date_key", "customer_key")
    orders = orders.join(_sent(waiting, staged, ["order_id"]), "order_id", "left_semi")
    current = dim_product.where(F.col("is_current") == "Y").select("product_id", "product_key")
    j = (
        rows.join(orders, "order_id", "left")
        .join(current, "product_id", "left")
        .join(dim_seller.select("seller_id", "seller_key"), "seller_id", "left")
    )
    too_large = C.amount_overflows("price_text", C.PRICE_TYPE) | C.amount_overflows("freight_text", C.PRICE_TYPE)
    never = (
        F.when(F.col("order_id").isNull() | F.col("order_item_id").isNull(), L.REJECT_NULL_ITEM_KEY)
        .when(too_large, L.REJECT_AMOUNT_RANGE)
    )
    not_yet = (
        F.when(F.col("customer_key").isNull(), L.REJECT_NO_ORDER)
        .when(F.col("product_key").isNull(), L.REJECT_NO_PRODUCT)
        .when(F.col("seller_key").isNull(), L.REJECT_NO_SELLER)
    )
    repeated = F.col("seen")
    outcome = (
        F.when(repeated, REPEATED).when(never.isNotNull(), REJECTED).when(not_yet.isNotNull(), WAITS).otherwise(LOADS)
    )
    price, freight = (C.parse_amount_as(c, C.PRICE_TYPE) for c in ("price_text", "freight_text"))
    return j.select(
        *ITEM_KEY,
        "order_date_key",
        "customer_key",
        "product_key",
        "seller_key",
        "product_id",
        "seller_id",
        price.alias("price"),
        freight.alias("freight_value"),
        (price + freight).cast(C.ITEM_TOTAL_TYPE).alias("total_item_value"),
        F.lit(batch_id).cast("long").alias("etl_batch_id"),
        "price_text",
        "freight_text",
        F.col("etl_batch_id").alias("sent_batch_id"),
        "n_sent",
        outcome.alias("outcome"),
        F.when(~repeated, F.coalesce(never, not_yet)).alias("reason"),
    )


def still_waiting(tried: DataFrame) -> DataFrame:
    """The items that wait for a later batch, as they were staged, with the reason."""
    return tried.where(F.col("outcome") == WAITS).select(
        *ITEM_KEY, "product_id", "seller_id", F.col("price_text").alias("price"), F.col("freight_text").alias("freight_value"),
        F.col("sent_batch_id").alias("etl_batch_id"), "reason",
    )


def balance(tried: DataFrame, waiting: DataFrame, staged: DataFrame, batch_id: int) -> DataFrame:
    """One row: items that waited before and were staged, and what became of them; further rows of a key are superseded."""
    outcomes = [LOADS, WAITS, REJECTED, REPEATED]

    def counted(rows: DataFrame, **metrics: Column) -> DataFrame:
        names = ["waited_before", "staged", *outcomes, "superseded"]
        return rows.select(*[metrics.get(n, F.lit(0)).cast("long").alias(n) for n in names])

    became = {o: (F.col("outcome") == o) for o in outcomes}
    rows = (
        counted(tried, **became, superseded=F.col("n_sent") - 1)
        .unionByName(counted(waiting, waited_before=F.lit(1)))
        .unionByName(counted(staged, staged=F.lit(1)))
    )
    totals = rows.groupBy().agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in rows.columns])
    spent = F.col(LOADS) + F.col(WAITS) + F.col(REJECTED) + F.col(REPEATED) + F.col("superseded")
    return totals.select(
        F.lit(batch_id).cast("long").alias("batch_id"), "*", (F.col("waited_before") + F.col("staged") == spent).alias("balanced")
    )
