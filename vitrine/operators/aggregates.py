"""The pre-aggregated daily sales table and the calendar dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.functions import columns as C
from vitrine.functions import lookups as L

AGG_DAILY_COLUMNS = [
    "date_key",
    "state",
    "category_en",
    "payment_type",
    "order_status",
    "order_count",
    "item_count",
    "total_revenue",
    "total_freight",
    "avg_review_score",
    "late_delivery_count",
]
# What the aggregate reads of the facts.
DAILY_ORDER_COLUMNS = [
    "order_id", "customer_key", "order_date_key", "payment_type_primary", "order_status", "review_score", "is_late_delivery",
]
DAILY_ITEM_COLUMNS = ["order_id", "product_key", "price", "freight_value"]
DAILY_GROUP = AGG_DAILY_COLUMNS[:5]
DAILY_MEASURES = [
    "order_count", "item_count", "price_total", "price_n", "freight_total", "freight_n", "score_sum", "score_n",
    "late_delivery_count",
]


def items_by_order_category(fact_items: DataFrame, dim_product: DataFrame, product_versions: str = "current") -> DataFrame:
    """Items of each (order, current-product category): count, price, freight.

    Reducing items to this grain before joining orders keeps the order join
    and the final group-by small; it is exact because every order attribute
    is the same for all items of the order.

    ``product_versions="current"`` joins only current product rows, as the
    source does (items keyed to an expired version drop out); ``"all"`` keeps
    them under the category of the version they were loaded with.
    """
    prod = current_products(dim_product, product_versions).select("product_key", "category_name_en")
    return (
        fact_items.select(*DAILY_ITEM_COLUMNS)
        .join(prod, "product_key")
        .groupBy("order_id", "category_name_en")
        .agg(
            F.count(F.lit(1)).alias("n_items"),
            F.sum("price").alias("price_sum"),
            F.count("price").alias("price_n"),
            F.sum("freight_value").alias("freight_sum"),
            F.count("freight_value").alias("freight_n"),
        )
    )


def current_products(dim_product: DataFrame, product_versions: str = "current") -> DataFrame:
    if product_versions == "current":
        return dim_product.filter(F.col("is_current") == "Y")
    if product_versions == "all":
        return dim_product
    raise ValueError(f"product_versions must be 'current' or 'all', not {product_versions!r}")


def agg_daily_sales(
    fact_orders: DataFrame,
    dim_customer: DataFrame,
    fact_items: DataFrame,
    dim_product: DataFrame,
    product_versions: str = "current",
) -> DataFrame:
    """AGG_DAILY_SALES: date x state x category x payment type x status.

    ``fact_orders`` has one row per order id (enforced at load), so the rows of
    a group, one per order and category, are its distinct orders: counting them
    needs no further exchange.

    Item-grain semantics of the source are kept: the review average and the
    late count weight each order by its number of items in the group.
    """
    return finish_daily(daily_state(fact_orders, dim_customer, fact_items, dim_product, product_versions))


def daily_state(
    fact_orders: DataFrame,
    dim_customer: DataFrame,
    fact_items: DataFrame,
    dim_product: DataFrame,
    product_versions: str = "current",
) -> DataFrame:
    """The daily aggregate as sums and counts only, so that states of different orders add up (``DAILY_MEASURES``)."""
    per_cat = items_by_order_category(fact_items, dim_product, product_versions)
    fo = fact_orders.filter(F.col("order_date_key").isNotNull()).select(*DAILY_ORDER_COLUMNS)
    dc = dim_customer.select("customer_key", "state")
    j = fo.join(dc, "customer_key").join(per_cat, "order_id")
    scored_items = F.when(F.col("review_score").isNotNull(), F.col("n_items")).otherwise(F.lit(0))
    g = j.groupBy(
        F.col("order_date_key").alias("date_key"),
        "state",
        F.col("category_name_en").alias("category_en"),
        F.col("payment_type_primary").alias("payment_type"),
        "order_status",
    ).agg(
        F.count(F.lit(1)).alias("order_count"),
        F.sum("n_items").alias("item_count"),
        _total("price_sum").alias("price_total"),
        F.sum("price_n").alias("price_n"),
        _total("freight_sum").alias("freight_total"),
        F.sum("freight_n").alias("freight_n"),
        F.coalesce(F.sum(F.col("review_score") * F.col("n_items")), F.lit(0)).alias("score_sum"),
        F.sum(scored_items).alias("score_n"),
        F.sum(F.when(F.col("is_late_delivery") == "Y", F.col("n_items")).otherwise(F.lit(0))).alias(
            "late_delivery_count"
        ),
    )
    return g


def _total(amount: str) -> Column:
    return F.coalesce(F.sum(amount), F.lit(0)).cast("decimal(38,2)")


def finish_daily(state: DataFrame) -> DataFrame:
    """The published columns of a state; a sum without any amount is NULL, an average without any score too."""

    def money(total: str, n: str) -> Column:
        return F.when(F.col(n) > 0, F.round(total, 2)).cast(C.AGG_MONEY_TYPE)

    return state.select(
        *DAILY_GROUP,
        F.col("order_count").cast("long").alias("order_count"),
        F.col("item_count").cast("long").alias("item_count"),
        money("price_total", "price_n").alias("total_revenue"),
        money("freight_total", "freight_n").alias("total_freight"),
        C.round_ratio("score_sum", "score_n", 2).cast(C.AVG_SCORE_TYPE).alias("avg_review_score"),
        F.col("late_delivery_count").cast("long").alias("late_delivery_count"),
    )


def touched_days(
    fact_orders: DataFrame,
    fact_items: DataFrame,
    dim_customer: DataFrame,
    dim_product: DataFrame,
    since_batch: int,
) -> DataFrame:
    """Order days whose aggregate rows may differ from a refresh at the end of batch ``since_batch``.

    A row depends on its orders, their items, the customers' states and the
    items' product versions, and each of these tables names the batch that
    wrote a row last. The batch itself counts as changed (it may have been
    re-run). A closed product version keeps its batch, but the product then has
    a version of a later one, so all versions of such products count.
    """

    def changed(df: DataFrame) -> DataFrame:
        return df.filter(F.col("etl_batch_id") >= since_batch)

    products = dim_product.join(changed(dim_product).select("product_id").distinct(), "product_id", "left_semi")
    items = changed(fact_items).select("order_id").union(
        fact_items.join(products.select("product_key"), "product_key", "left_semi").select("order_id")
    )
    dated = fact_orders.select("order_id", "customer_key", "order_date_key", "etl_batch_id")
    days = (
        changed(dated).select("order_date_key")
        .union(dated.join(items.distinct(), "order_id", "left_semi").select("order_date_key"))
        .union(dated.join(changed(dim_customer), "customer_key", "left_semi").select("order_date_key"))
    )
    return days.distinct().withColumnRenamed("order_date_key", "date_key")


def refresh_days(
    previous: DataFrame,
    days: DataFrame,
    fact_orders: DataFrame,
    dim_customer: DataFrame,
    fact_items: DataFrame,
    dim_product: DataFrame,
    product_versions: str = "current",
) -> DataFrame:
    """The daily aggregate with the ``days`` (date_key) computed anew and all others taken from ``previous``."""
    orders = fact_orders.join(days.withColumnRenamed("date_key", "order_date_key"), "order_date_key", "left_semi")
    items = fact_items.join(orders.select("order_id"), "order_id", "left_semi")
    fresh = agg_daily_sales(orders, dim_customer, items, dim_product, product_versions)
    return previous.join(days, "date_key", "left_anti").select(*AGG_DAILY_COLUMNS).unionByName(fresh)


# ------------------------------------------------------------------ calendar


def dim_date(spark, start: str = L.CALENDAR_START, end: str = L.CALENDAR_END) -> DataFrame:
    """One row per day from ``start`` to ``end`` inclusive (default 2015..2030)."""
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("full_date")
    )
    return calendar_rows(days)


def dim_date_between(days_bounds: DataFrame) -> DataFrame:
    """Calendar over ``[min_day, max_day]`` of a one-row DataFrame of bounds."""
    return calendar_rows(days_bounds.select(F.explode(F.sequence("min_day", "max_day")).alias("full_date")))


def calendar_rows(days: DataFrame) -> DataFrame:
    d = F.col("full_date")
    quarter = F.quarter(d)
    return days.select(
        C.date_key(d).alias("date_key"),
        d.alias("full_date"),
        F.dayofmonth(d).alias("day_num"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.weekofyear(d).alias("week_num"),
        F.month(d).alias("month_num"),
        F.date_format(d, "MMMM").alias("month_name"),
        quarter.alias("quarter_num"),
        F.concat(F.lit("Q"), quarter.cast("string")).alias("quarter_name"),
        F.year(d).alias("year_num"),
        C.yes_no(F.dayofweek(d).isin(1, 7)).alias("is_weekend"),
        F.lit("N").alias("is_holiday"),
    )
