"""Registered queries: every job of the pipeline, run on the driver's tables.

``FixtureLoad`` is the first load of one batch into an empty warehouse, built
lazily from the staging views in ``sources.fixtures``; each registered query
is one job (or report) on top of it. Surrogate keys and load timestamps are
left out of the outputs so results can be compared on business keys.

Scenarios that need a prior warehouse state (upserts, SCD2, incremental
loads) derive that state from the same tables as an earlier load would have
left it: customers of two market segments (then with an old city), sellers of
one region, orders purchased before 1998 with their items and reviews. The
work of every query still covers the whole input tables.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.functions import columns as C
from vitrine.operators import aggregates as A
from vitrine.operators import dimensions as D
from vitrine.operators import facts as FT
from vitrine.operators import quality as Q
from vitrine.operators.keys import assign_keys
from vitrine.plans import reports as R
from vitrine.plans import schemas
from vitrine.sources import fixtures as FX
from vitrine.sources.feeds import Staging

BATCH = FX.FIXTURE_BATCH_ID
AS_OF = FX.FIXTURE_AS_OF
LOAD_TS = FX.FIXTURE_LOAD_TS
PRIOR_AS_OF = "2024-01-01"


def _empty(spark: SparkSession, ddl: str) -> DataFrame:
    from vitrine.plans.warehouse import empty_table

    return empty_table(spark, ddl)


class FixtureLoad:
    """First load of the fixture batch into an empty warehouse (lazy)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        from vitrine.session import checkpoint_dir

        self.spark = spark
        checkpoint_dir(spark)  # the cluster's shared folder; a local one only when unset
        self.stg = FX.staging(spark, sf_dir)

    @cached_property
    def customer_source(self) -> DataFrame:
        return D.customer_source(self.stg, BATCH)

    def _table(self, df: DataFrame, name: str) -> DataFrame:
        """A loaded dimension: written once as Parquet under the shared
        checkpoint folder and read back by every later job, as the pipeline
        reads its dimension tables. The write cuts the lineage (a lost
        executor re-reads files instead of recomputing the dimension) and the
        later joins scan a columnar table."""
        from vitrine.session import scratch_path

        path = scratch_path(self.spark, name)
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    @cached_property
    def dim_customer(self) -> DataFrame:
        return self._table(assign_keys(self.customer_source, ["customer_unique_id"], "customer_key"), "dim_customer")

    @cached_property
    def dim_seller(self) -> DataFrame:
        return self._table(
            assign_keys(D.seller_source(self.stg, BATCH), ["seller_id", "zip_code_prefix"], "seller_key"),
            "dim_seller",
        )

    @cached_property
    def product_source(self) -> DataFrame:
        return D.product_source(self.stg, BATCH)

    @cached_property
    def dim_product(self) -> DataFrame:
        empty = _empty(self.spark, schemas.DIM_PRODUCT)
        return self._table(
            D.scd2_apply(empty, self.product_source, empty.select("product_id"), AS_OF, BATCH, LOAD_TS),
            "dim_product",
        )

    @cached_property
    def fact_orders(self) -> DataFrame:
        return FT.fact_orders(self.stg, self.dim_customer, BATCH)

    @cached_property
    def fact_items(self) -> DataFrame:
        return FT.fact_order_items(self.stg, self.dim_customer, self.dim_product, self.dim_seller, BATCH)

    @cached_property
    def fact_reviews(self) -> DataFrame:
        return FT.fact_reviews(self.stg, BATCH)

    @cached_property
    def dim_date(self) -> DataFrame:
        day = C.parse_day("order_purchase_timestamp")
        bounds = self.stg.orders.agg(F.min(day).alias("min_day"), F.max(day).alias("max_day"))
        return A.dim_date_between(bounds)


Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def query(fn: Callable[[FixtureLoad], DataFrame]) -> Callable[[FixtureLoad], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(FixtureLoad(spark, sf_dir))

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    _REGISTRY[fn.__name__] = run
    return fn


def queries() -> dict[str, Query]:
    return dict(_REGISTRY)


REJECT_OUT = ["source_table", "source_key", "reject_reason", "etl_batch_id"]

# ------------------------------------------------------------ data quality


@query
def dq_null_order_id(w: FixtureLoad) -> DataFrame:
    return Q.null_order_ids(w.stg, BATCH).select(*REJECT_OUT)


@query
def dq_bad_status(w: FixtureLoad) -> DataFrame:
    return Q.bad_statuses(w.stg, BATCH).select(*REJECT_OUT)


@query
def dq_negative_amount(w: FixtureLoad) -> DataFrame:
    return Q.negative_amounts(w.stg, BATCH).select(*REJECT_OUT)


@query
def dq_bad_score(w: FixtureLoad) -> DataFrame:
    return Q.bad_scores(w.stg, BATCH).select(*REJECT_OUT)


@query
def dq_parse_errors(w: FixtureLoad) -> DataFrame:
    return Q.non_numeric_amounts(w.stg, BATCH).unionByName(Q.bad_dates(w.stg, BATCH)).select(*REJECT_OUT)


@query
def dq_out_of_range(w: FixtureLoad) -> DataFrame:
    return Q.out_of_range(w.stg, BATCH).select(*REJECT_OUT)


@query
def dim_rejects(w: FixtureLoad) -> DataFrame:
    """Customers, sellers and products that no dimension can hold: their key is missing."""
    return D.keyless_rows(w.stg, BATCH).select(*REJECT_OUT, "raw_data")


@query
def dq_summary(w: FixtureLoad) -> DataFrame:
    return Q.reject_summary(Q.validate_staging(w.stg, BATCH))


# -------------------------------------------------------------- dimensions


@query
def geo_centroid(w: FixtureLoad) -> DataFrame:
    return D.geo_centroid(w.stg.geolocation, BATCH)


@query
def state_region_lookup(w: FixtureLoad) -> DataFrame:
    s = w.stg.customers.groupBy(F.col("customer_state").alias("state_code")).agg(
        F.count(F.lit(1)).alias("customers")
    )
    return s.select("state_code", C.state_name("state_code").alias("state_name"), C.region("state_code").alias("region"), "customers")


@query
def dim_customer_source(w: FixtureLoad) -> DataFrame:
    return w.customer_source


DIM_CUSTOMER_OUT = [
    "customer_unique_id", "customer_id", "zip_code_prefix", "city", "state", "state_name", "region", "lat", "lng",
    "is_active", "etl_batch_id", "merge_action",
]


# Earlier loads used to build prior warehouse states (fixed scenario values).
EARLIER_CUSTOMER_CITIES = ["Building Do Sul", "Automobile Do Sul"]  # two market segments
EARLIER_SELLER_REGION = "Southeast"
RETIRED_STATE, RETIRED_REGION = "RJ", "South"  # of customers and sellers that no later feed holds
EARLIER_ORDERS_BEFORE = "1998-01-01"  # orders purchased before this day


def _prior_dimension(
    src: DataFrame, earlier: Column, retired: Column, key: str, id_col: str, ddl_cols: list[str]
) -> DataFrame:
    """Earlier version of a dimension: the rows an earlier load had, then with an old city, and rows since retired."""
    gone = src.filter(retired).withColumn(id_col, F.concat(F.lit("gone-"), F.col(id_col)))
    prior = (
        src.filter(earlier)
        .unionByName(gone)
        .withColumn("city", F.lit("Old"))
        .withColumn("etl_batch_id", F.lit(0).cast("long"))
        .withColumn("is_active", F.lit("Y"))
        .withColumn("etl_insert_dt", F.lit(f"{PRIOR_AS_OF} 00:00:00").cast("timestamp"))
        .withColumn("etl_update_dt", F.lit(None).cast("timestamp"))
    )
    return assign_keys(prior, [id_col], key).select(*ddl_cols)


@query
def dim_customer_upsert(w: FixtureLoad) -> DataFrame:
    earlier = F.col("city").isin(*EARLIER_CUSTOMER_CITIES)
    target = _prior_dimension(
        w.customer_source, earlier, F.col("state") == RETIRED_STATE, "customer_key", "customer_unique_id", D.CUSTOMER_COLUMNS
    )
    out = D.scd1_upsert(
        target, w.customer_source, "customer_unique_id", "customer_key", D.CUSTOMER_COLUMNS, LOAD_TS,
        start_key=1_000_000_000,
    )
    return out.select(*DIM_CUSTOMER_OUT)


UPSERT_BUCKETS, UPSERT_TOUCHED = 40, 4


@query
def dim_customer_upsert_buckets(w: FixtureLoad) -> DataFrame:
    """The customer dimension stored by key bucket, after a batch whose keys lie in a tenth of the buckets."""
    from vitrine.operators.keys import key_bucket
    from vitrine.plans.buckets import BucketedDimension
    from vitrine.session import scratch_path

    source = w._table(w.customer_source, "customer_source")
    earlier = F.col("city").isin(*EARLIER_CUSTOMER_CITIES)
    prior = _prior_dimension(
        source, earlier, F.col("state") == RETIRED_STATE, "customer_key", "customer_unique_id", D.CUSTOMER_COLUMNS
    )
    stored = BucketedDimension(
        w.spark, scratch_path(w.spark, "dim_customer_buckets"), "customer_unique_id", "customer_key", D.CUSTOMER_COLUMNS,
        UPSERT_BUCKETS,
    )
    stored.create(prior)
    stored.upsert(source.where(key_bucket(F.col("customer_unique_id"), UPSERT_BUCKETS) < UPSERT_TOUCHED), LOAD_TS)
    return stored.read().select(*[c for c in DIM_CUSTOMER_OUT if c != "merge_action"])


@query
def dim_seller_source(w: FixtureLoad) -> DataFrame:
    return D.seller_source(w.stg, BATCH)


@query
def dim_seller_upsert(w: FixtureLoad) -> DataFrame:
    src = D.seller_source(w.stg, BATCH)
    earlier = F.col("region") == EARLIER_SELLER_REGION
    target = _prior_dimension(
        src, earlier, F.col("region") == RETIRED_REGION, "seller_key", "seller_id", D.SELLER_COLUMNS
    )
    out = D.scd1_upsert(target, src, "seller_id", "seller_key", D.SELLER_COLUMNS, LOAD_TS, start_key=1_000_000_000)
    return out.select(*[c for c in D.SELLER_COLUMNS if c not in ("seller_key", "etl_insert_dt", "etl_update_dt")], "merge_action")


@query
def dim_product_source(w: FixtureLoad) -> DataFrame:
    return w.product_source


def _toys_history(w: FixtureLoad, loaded_on: str = PRIOR_AS_OF) -> DataFrame:
    """Earlier version of the product dimension: products of most weights, all filed under 'toys'."""
    h = (
        w.product_source.filter(F.col("weight_g") % 700 != 0)
        .withColumn("category_name_en", F.lit("toys"))
        .withColumn("category_group", C.category_group(F.lit("toys")))
        .withColumn("effective_from", F.lit(loaded_on).cast("date"))
        .withColumn("effective_to", F.lit(None).cast("date"))
        .withColumn("is_current", F.lit("Y"))
        .withColumn("etl_batch_id", F.lit(0).cast("long"))
        .withColumn("etl_insert_dt", F.lit(f"{PRIOR_AS_OF} 00:00:00").cast("timestamp"))
    )
    return assign_keys(h, ["product_id"], "product_key").select(*D.PRODUCT_COLUMNS)


@query
def dim_product_changed(w: FixtureLoad) -> DataFrame:
    return D.product_changes(_toys_history(w), w.stg, BATCH).select("product_id", "category_name_en", "is_current")


PRODUCT_OUT = [
    "product_id", "category_name_pt", "category_name_en", "category_group", "weight_g", "volume_cm3",
    "effective_from", "effective_to", "is_current", "etl_batch_id",
]


@query
def dim_product_scd2(w: FixtureLoad) -> DataFrame:
    history = _toys_history(w)
    changed = D.product_changes(history, w.stg, BATCH)
    out = D.scd2_apply(history, w.product_source, changed, AS_OF, BATCH, LOAD_TS, start_key=1_000_000_000)
    return out.select(*PRODUCT_OUT)


@query
def check_scd2_intervals(w: FixtureLoad) -> DataFrame:
    """Interval check after a second category change on the same day."""
    history = _toys_history(w, loaded_on=AS_OF)
    changed = D.product_changes(history, w.stg, BATCH)
    out = D.scd2_apply(history, w.product_source, changed, AS_OF, BATCH, LOAD_TS, start_key=1_000_000_000)
    return Q.scd2_interval_errors(out).select("product_id", "effective_from", "effective_to", "problem")


# Days of three product feeds; the second arrives after the third, and the first is then loaded again.
TIMELINE_DAYS = [PRIOR_AS_OF, "2024-03-01", AS_OF]
TIMELINE_LATER_NAME = "garden_tools"


def _sightings(w: FixtureLoad) -> list[DataFrame]:
    """What three feeds say of the products: most weights filed under 'toys', all as they are, some renamed since."""
    src = w.product_source.select("product_id", "category_name_en", "weight_g", "product_photos_qty")
    renamed = F.when(F.col("product_photos_qty") == 0, TIMELINE_LATER_NAME).when(F.col("product_photos_qty") == 1, "toys")
    feeds = [
        src.filter(F.col("weight_g") % 700 != 0).withColumn("category_name_en", F.lit("toys")),
        src,
        src.withColumn("category_name_en", F.coalesce(renamed, "category_name_en")),
    ]
    return [f.drop("product_photos_qty").withColumn("seen_on", F.lit(d).cast("date")) for f, d in zip(feeds, TIMELINE_DAYS)]


@query
def dim_product_timeline(w: FixtureLoad) -> DataFrame:
    """Product versions when a batch arrives late and an old one is loaded again: as if all had come in order."""
    first, late, last = _sightings(w)
    said, timeline = first, D.product_timeline(first)
    for n, batch in enumerate((last, late, first)):
        said = w._table(D.merge_sightings(said, batch), f"sightings-{n}")
        timeline = w._table(D.refresh_timeline(timeline, said, batch), f"timeline-{n}")
    return timeline


@query
def check_timeline_intervals(w: FixtureLoad) -> DataFrame:
    """Versions of the timeline that are empty or overlap: none."""
    timeline = dim_product_timeline(w).withColumn("product_key", F.lit(0).cast("long"))
    return Q.scd2_interval_errors(timeline).select("product_id", "effective_from", "effective_to", "problem")


@query
def category_group_counts(w: FixtureLoad) -> DataFrame:
    return w.product_source.groupBy("category_group").agg(F.count(F.lit(1)).alias("products"))


@query
def dim_date(w: FixtureLoad) -> DataFrame:
    return w.dim_date


@query
def calendar_by_year(w: FixtureLoad) -> DataFrame:
    return w.dim_date.groupBy("year_num").agg(
        F.count(F.lit(1)).alias("days"),
        F.count_if(F.col("is_weekend") == "Y").alias("weekend_days"),
        F.max("week_num").alias("max_week"),
        F.min("date_key").alias("first_key"),
        F.max("date_key").alias("last_key"),
    )


# ------------------------------------------------------------------- facts


@query
def payments_rollup(w: FixtureLoad) -> DataFrame:
    p = FT.payments_rollup(w.stg, BATCH)
    return p.select(
        "order_id",
        F.col("total_payment").cast(C.PAYMENT_TOTAL_TYPE).alias("total_payment"),
        F.col("max_installments").cast("long").alias("max_installments"),
        F.col("num_methods").cast("long").alias("num_methods"),
        "primary_payment_type",
    )


@query
def primary_payment_type(w: FixtureLoad) -> DataFrame:
    p = FT.payments_rollup(w.stg, BATCH)
    return p.groupBy("primary_payment_type", F.col("num_methods").cast("long").alias("num_methods")).agg(
        F.count(F.lit(1)).alias("orders")
    )


@query
def reviews_rollup(w: FixtureLoad) -> DataFrame:
    return FT.reviews_rollup(w.stg, BATCH)


FACT_ORDER_OUT = [c for c in FT.FACT_ORDER_COLUMNS if c != "customer_key"] + ["customer_unique_id"]


@query
def fact_orders(w: FixtureLoad) -> DataFrame:
    return w.fact_orders.select(*FACT_ORDER_OUT)


@query
def fact_orders_strict(w: FixtureLoad) -> DataFrame:
    """Strict mode: orders and reviews rejected by the data-quality rules are not loaded."""
    rejects = w._table(Q.validate_staging(w.stg, BATCH), "strict-rejects")  # written once for the tables that it cuts
    stg = Q.strict_staging(w.stg, rejects)
    return FT.fact_orders(stg, w.dim_customer, BATCH).select(*FACT_ORDER_OUT)


@query
def fact_orders_bridge(w: FixtureLoad) -> DataFrame:
    return FT.fact_orders(w.stg, w.dim_customer, BATCH, customer_lookup="bridge").select(*FACT_ORDER_OUT)


@query
def fact_orders_unresolved(w: FixtureLoad) -> DataFrame:
    return FT.fact_orders_unresolved(w.stg, w.dim_customer, BATCH)


def _earlier_orders(w: FixtureLoad) -> DataFrame:
    """Order ids an earlier batch already loaded: those purchased before the cut-off day."""
    day = C.parse_day("order_purchase_timestamp")
    return w.stg.orders.filter(day < F.lit(EARLIER_ORDERS_BEFORE).cast("date")).select("order_id")


@query
def fact_orders_incremental(w: FixtureLoad) -> DataFrame:
    loaded = _earlier_orders(w)
    return FT.fact_orders(w.stg, w.dim_customer, BATCH, loaded=loaded).select(*FACT_ORDER_OUT)


def _guarded(w: FixtureLoad, earlier: DataFrame, rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Earlier keys as a table of one partition per order month, cut by key summaries for the guard of ``rows``."""
    from vitrine.operators import key_summary as KS
    from vitrine.session import scratch_path

    day = C.parse_day("order_purchase_timestamp")
    months = w.stg.orders.select("order_id", (F.year(day) * 100 + F.month(day)).cast("long").alias("etl_batch_id"))
    path = scratch_path(w.spark, f"history-{name}")
    earlier.join(months, "order_id").select(*keys, "etl_batch_id").write.partitionBy("etl_batch_id").parquet(path)
    ddl = ", ".join(f"{k} {earlier.schema[k].dataType.simpleString()}" for k in keys)
    history = w.spark.read.schema(f"{ddl}, etl_batch_id bigint").parquet(path)
    summary = w._table(KS.summarise(history, keys), f"keys-{name}")
    return KS.possible_rows(history, summary, rows, keys).select(*keys)


@query
def fact_orders_guarded(w: FixtureLoad) -> DataFrame:
    """The incremental load of orders, its guard cut to the earlier months that can hold one of the batch's keys."""
    loaded = _guarded(w, _earlier_orders(w), w.stg.orders, ["order_id"], "orders")
    return FT.fact_orders(w.stg, w.dim_customer, BATCH, loaded=loaded).select(*FACT_ORDER_OUT)


@query
def fact_order_items_guarded(w: FixtureLoad) -> DataFrame:
    """The incremental load of items with the guard of ``fact_orders_guarded`` on both parts of the key."""
    from dataclasses import replace

    keys = ["order_id", "order_item_id"]
    stg = replace(w.stg, order_items=w._table(w.stg.order_items, "staged-items"))  # written once, read by every step
    earlier = stg.order_items.join(_earlier_orders(w), "order_id", "left_semi").select(*keys)
    loaded = _guarded(w, earlier, stg.order_items, keys, "items")
    return FT.fact_order_items(
        stg, w.dim_customer, w.dim_product, w.dim_seller, BATCH, loaded=loaded
    ).select(*FACT_ITEM_OUT)


@query
def late_flag_counts(w: FixtureLoad) -> DataFrame:
    return w.fact_orders.groupBy("order_status", "is_late_delivery").agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum("days_to_deliver").alias("sum_days_to_deliver"),
        F.sum("delivery_delay_days").alias("sum_delay_days"),
        F.count("days_to_approve").alias("approved_orders"),
    )


FACT_ITEM_OUT = [
    "order_id", "order_item_id", "order_date_key", "customer_unique_id", "product_id", "seller_id", "price",
    "freight_value", "total_item_value", "etl_batch_id",
]


@query
def fact_order_items(w: FixtureLoad) -> DataFrame:
    return w.fact_items.select(*FACT_ITEM_OUT)


@query
def fact_order_items_incremental(w: FixtureLoad) -> DataFrame:
    loaded = w.stg.order_items.join(_earlier_orders(w), "order_id", "left_semi").select("order_id", "order_item_id")
    return FT.fact_order_items(
        w.stg, w.dim_customer, w.dim_product, w.dim_seller, BATCH, loaded=loaded
    ).select(*FACT_ITEM_OUT)


@query
def fact_order_items_unresolved(w: FixtureLoad) -> DataFrame:
    return FT.fact_order_items_unresolved(w.stg, w.dim_customer, w.dim_product, w.dim_seller, BATCH)


@query
def fact_reviews(w: FixtureLoad) -> DataFrame:
    return w.fact_reviews


@query
def fact_reviews_unresolved(w: FixtureLoad) -> DataFrame:
    return FT.fact_reviews_unresolved(w.stg, BATCH)


@query
def sentiment_counts(w: FixtureLoad) -> DataFrame:
    return w.fact_reviews.groupBy("sentiment", "review_score").agg(
        F.count(F.lit(1)).alias("reviews"),
        F.count_if(F.col("has_comment_message") == "Y").alias("with_message"),
        F.sum("response_days").alias("sum_response_days"),
    )


@query
def fact_reviews_incremental(w: FixtureLoad) -> DataFrame:
    # reviews of the earlier orders were loaded with them
    loaded = w.stg.order_reviews.join(_earlier_orders(w), "order_id", "left_semi").select("review_id")
    return FT.fact_reviews(w.stg, BATCH, loaded=loaded)


@query
def agg_daily_sales(w: FixtureLoad) -> DataFrame:
    return A.agg_daily_sales(w.fact_orders, w.dim_customer, w.fact_items, w.dim_product)


@query
def agg_daily_sales_incremental(w: FixtureLoad) -> DataFrame:
    """A refresh of the touched days only: orders since 1998 are new, customers of one state have moved there since."""
    new_order = F.col("order_date_key") >= F.lit(int(EARLIER_ORDERS_BEFORE.replace("-", "")))
    moved = F.col("state") == RETIRED_STATE
    # Facts are written once, as far as the aggregate reads them: both aggregates and the search for days read them.
    facts = w._table(w.fact_orders.select(*A.DAILY_ORDER_COLUMNS), "daily-orders")
    sold = w._table(w.fact_items.select(*A.DAILY_ITEM_COLUMNS, "order_date_key"), "daily-items")
    orders = facts.withColumn("etl_batch_id", F.when(new_order, 2).otherwise(1).cast("long"))
    items = sold.withColumn("etl_batch_id", F.when(new_order, 2).otherwise(1).cast("long"))
    products = w.dim_product.withColumn("etl_batch_id", F.lit(1).cast("long"))
    customers = w.dim_customer.withColumn("etl_batch_id", F.when(moved, 2).otherwise(1).cast("long"))
    before = w.dim_customer.withColumn("state", F.when(moved, "SP").otherwise(F.col("state")))
    previous = A.agg_daily_sales(orders.filter(~new_order), before, items.filter(~new_order), products)
    days = A.touched_days(orders, items, customers, products, since_batch=2)
    return A.refresh_days(previous, days, orders, customers, items, products)


@query
def agg_daily_sales_delta(w: FixtureLoad) -> DataFrame:
    """A refresh by signed differences: new orders, corrected items, moved customers, re-filed products."""
    from vitrine.operators import daily_delta as DD

    facts = w._table(w.fact_orders.select(*A.DAILY_ORDER_COLUMNS), "delta-orders")  # as far as the aggregate reads them
    sold = w._table(w.fact_items.select(*A.DAILY_ITEM_COLUMNS, "order_item_id", "order_date_key"), "delta-items")
    new_order = F.col("order_date_key") >= F.lit(int(EARLIER_ORDERS_BEFORE.replace("-", "")))
    corrected = (F.col("order_item_id") == 1) & (F.col("freight_value") < 3)
    moved, refiled = F.col("state") == RETIRED_STATE, (F.col("weight_g") % 700 == 0) & (F.col("product_photos_qty") == 0)

    def stamped(rows: DataFrame, new: Column) -> DataFrame:
        return rows.withColumn("etl_batch_id", F.when(new, 2).otherwise(1).cast("long"))

    after = DD.Star(
        stamped(facts, new_order), w.dim_customer, stamped(sold, new_order | F.coalesce(corrected, F.lit(False))), w.dim_product
    )
    price = F.when(corrected, F.col("price") + 1).otherwise(F.col("price")).cast(C.PRICE_TYPE)
    before = DD.Star(
        facts.where(~new_order),
        w.dim_customer.withColumn("state", F.when(moved, "SP").otherwise(F.col("state"))),
        sold.where(~new_order).withColumn("price", price),
        w.dim_product.withColumn("category_name_en", F.when(refiled, "toys").otherwise(F.col("category_name_en"))),
    )
    state = w._table(before.state(), "daily-state")
    changed = w._table(DD.changed_orders(before, after, since_batch=2), "changed-orders")
    return A.finish_daily(DD.apply_delta(state, DD.signed_delta(before, after, changed)))


# -------------------------------------------------------------- late items


def _late_batches(w: FixtureLoad) -> list[dict[str, DataFrame]]:
    """Two batches. In the first, later orders, products of some weights and the sellers of one region are missing;
    the second brings them, and sends every first item of an order again at another price."""
    from vitrine.operators import late_items as LI

    early = F.col("order_date_key") < F.lit(int(EARLIER_ORDERS_BEFORE.replace("-", "")))
    # Written once: each batch reads the staged items more than once.
    staged, orders = w._table(w.stg.order_items.select(*LI.WAITING_COLUMNS), "late-staged"), w._table(w.fact_orders, "late-orders")
    again = staged.where("order_item_id = 1").withColumn("price", F.lit(RESENT_PRICE))
    none = staged.limit(0)
    scenes = [
        (staged, orders.where(early), w.dim_product.where("weight_g % 700 <> 0"),
         w.dim_seller.where(F.col("region") != EARLIER_SELLER_REGION)),
        (again, orders, w.dim_product, w.dim_seller),
    ]
    waiting, loaded, batches = none, none.select(*LI.ITEM_KEY), []
    for n, (items, known, products, sellers) in enumerate(scenes, start=1):
        items = items.withColumn("etl_batch_id", F.lit(n).cast("long"))
        tried = w._table(LI.try_items(waiting, items, loaded, known, products, sellers, n), f"tried-items-{n}")
        batches.append({"waiting": waiting, "staged": items, "tried": tried})
        waiting = LI.still_waiting(tried)
        loaded = loaded.unionByName(tried.where(F.col("outcome") == LI.LOADS).select(*LI.ITEM_KEY))
    return batches


RESENT_PRICE = "10.00"
LATE_ITEM_OUT = [
    "order_id", "order_item_id", "order_date_key", "product_id", "seller_id", "price", "freight_value", "total_item_value",
    "etl_batch_id",
]


@query
def fact_order_items_late(w: FixtureLoad) -> DataFrame:
    """Items loaded by two batches, each once, by the batch that resolves it."""
    from vitrine.operators import late_items as LI

    first, second = (b["tried"].where(F.col("outcome") == LI.LOADS).select(*LATE_ITEM_OUT) for b in _late_batches(w))
    return first.unionByName(second)


@query
def late_items_waiting(w: FixtureLoad) -> DataFrame:
    """Items that wait after each of two batches, by reason, with how many batches' rows they hold."""
    from functools import reduce

    from vitrine.operators import late_items as LI

    parts = [
        LI.still_waiting(b["tried"]).groupBy("reason").agg(F.count(F.lit(1)).alias("items"))
        .select(F.lit(n).cast("long").alias("batch_id"), "reason", "items")
        for n, b in enumerate(_late_batches(w), start=1)
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def late_items_balance(w: FixtureLoad) -> DataFrame:
    """Waiting and staged items of two batches are loaded, wait on, or are rejected, repeated or superseded."""
    from functools import reduce

    from vitrine.operators import late_items as LI

    parts = [LI.balance(b["tried"], b["waiting"], b["staged"], n) for n, b in enumerate(_late_batches(w), start=1)]
    return reduce(DataFrame.unionByName, parts)


# ----------------------------------------------------------------- run log


def _run_log(w: FixtureLoad) -> tuple[DataFrame, DataFrame]:
    """Current states of the batches and of the steps of the derived run log."""
    from vitrine.plans.runlog import latest_events
    from vitrine.sources import fixture_runs as FR

    months = w._table(FR.monthly_loads(w.stg), "monthly-loads")
    return (
        latest_events(FR.batch_events(months), "batch_id"), latest_events(FR.step_events(months), "step_log_id")
    )


@query
def run_history(w: FixtureLoad) -> DataFrame:
    """Every run with its totals and minutes; unfinished ones have none."""
    return R.run_history(_run_log(w)[0])


@query
def run_health_check(w: FixtureLoad) -> DataFrame:
    """The latest five runs."""
    return R.health_check(_run_log(w)[0])


@query
def run_step_detail(w: FixtureLoad) -> DataFrame:
    """The steps of the first batch that was run again, of both attempts."""
    batches, steps = _run_log(w)
    first = batches.where("attempt = 2").agg(F.min("batch_id")).first()[0]
    return R.step_detail(steps, first)


# ------------------------------------------------------- constraints, keys


#: Items whose orders are loaded and gated in one pass: bounds the shuffle files on disk at a time
#: (about 140 bytes an item). Each further pass reads the feeds again.
ITEMS_A_PASS = 240_000_000


def order_passes(stg: Staging, items_a_pass: int) -> list[Staging]:
    """``stg`` dealt by order id into passes of about so many items: an order, its items, payments and reviews share one.

    Every row is in exactly one pass (those without an order id, too).
    """
    passes = max(1, -(-stg.order_items.count() // items_a_pass))
    if passes == 1:
        return [stg]

    def dealt(rows: DataFrame, nth: int) -> DataFrame:
        return rows.where(F.pmod(F.xxhash64("order_id"), F.lit(passes)) == nth)

    names = ("orders", "order_items", "order_payments", "order_reviews")
    return [replace(stg, **{name: dealt(getattr(stg, name), nth) for name in names}) for nth in range(passes)]


def _gated(w: FixtureLoad, rows: DataFrame, rules: list, name: str) -> DataFrame:
    """``rows`` written, gated and written again; the table before the gate is then deleted."""
    from vitrine.operators import constraints as K
    from vitrine.plans.warehouse import FileSystem
    from vitrine.session import scratch_path

    path = scratch_path(w.spark, f"gate-{name}")
    rows.write.option("compression", "zstd").parquet(path)
    gated = w._table(K.gate(w.spark.read.schema(rows.schema).parquet(path), rules), f"gated-{name}")
    FileSystem(w.spark).delete(path)
    return gated


@query
def constraint_gate(w: FixtureLoad) -> DataFrame:
    """Orders in process are staged twice: neither they nor their items reach a fact; both show as rejects."""
    from functools import reduce

    from vitrine.operators import constraints as K
    from vitrine.session import shuffles_freed

    twice = w.stg.orders.filter(F.col("order_status") == "processing")
    stg = replace(w.stg, orders=w.stg.orders.unionByName(twice))
    parts = []
    with shuffles_freed(w.spark):
        for part in order_passes(stg, ITEMS_A_PASS):
            facts = FT.fact_orders(part, w.dim_customer, BATCH)
            orders = _gated(w, facts, [K.Unique("FACT_ORDERS_UK", ("order_id",))], "orders")
            accepted = orders.where("violation IS NULL")
            facts = FT.fact_order_items(part, w.dim_customer, w.dim_product, w.dim_seller, BATCH)
            rules = [
                K.Parent("FACT_ITEM_ORDER_FK", ("order_id",), accepted, ("order_id",)),
                K.Unique("FACT_ITEMS_UK", ("order_id", "order_item_id")),
            ]
            parts.append((orders, _gated(w, facts, rules, "items")))
    orders, items = (reduce(DataFrame.unionByName, tables) for tables in zip(*parts))

    def loaded(df: DataFrame, table: str) -> DataFrame:
        n = df.where("violation IS NULL").agg(F.count(F.lit(1)).alias("occurrences"))
        return n.select(F.lit(table).alias("constraint_name"), F.lit("loaded").alias("key_value"), "occurrences")

    return (
        K.violations(orders, ["order_id"])
        .unionByName(K.violations(items, ["order_id", "order_item_id"]))
        .unionByName(loaded(orders, "FACT_ORDERS"))
        .unionByName(loaded(items, "FACT_ORDER_ITEMS"))
    )


@query
def fact_keys(w: FixtureLoad) -> DataFrame:
    """Surrogate keys of the three facts, given out by written file: as many as rows, dense from 1."""
    from functools import reduce

    from vitrine.operators.keys import keys_by_file
    from vitrine.session import scratch_path

    parts = []
    for name, rows in (("FACT_ORDERS", w.fact_orders), ("FACT_ORDER_ITEMS", w.fact_items), ("FACT_REVIEWS", w.fact_reviews)):
        path = scratch_path(w.spark, f"keys-{name.lower()}")
        rows.write.parquet(path)
        keyed = keys_by_file(w.spark, path, rows.schema, "fact_key")
        parts.append(
            keyed.agg(
                F.lit(name).alias("fact"),
                F.count(F.lit(1)).alias("n_rows"),
                F.min("fact_key").alias("min_key"),
                F.max("fact_key").alias("max_key"),
                F.countDistinct("fact_key").alias("n_keys"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


# ----------------------------------------------------------------- reports


@query
def top_categories(w: FixtureLoad) -> DataFrame:
    return R.top_categories(w.fact_items, w.fact_orders, w.dim_product)


@query
def monthly_revenue(w: FixtureLoad) -> DataFrame:
    return R.monthly_revenue(w.fact_orders, w.dim_date)


@query
def late_rate_by_state(w: FixtureLoad) -> DataFrame:
    return R.late_rate_by_state(w.fact_orders, w.dim_customer)


# ------------------------------------------------------------------ checks


@query
def check_duplicate_keys(w: FixtureLoad) -> DataFrame:
    parts = [
        Q.duplicate_keys(w.stg.customers, ["customer_unique_id"], "STG_CUSTOMERS"),
        Q.duplicate_keys(w.dim_customer, ["customer_unique_id"], "DIM_CUSTOMER"),
        Q.duplicate_keys(w.fact_orders, ["order_id"], "FACT_ORDERS"),
        Q.duplicate_keys(w.fact_items, ["order_id", "order_item_id"], "FACT_ORDER_ITEMS"),
        Q.duplicate_keys(w.fact_reviews, ["review_id"], "FACT_REVIEWS"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query
def check_orphans(w: FixtureLoad) -> DataFrame:
    calendar = A.dim_date(w.spark)  # the warehouse calendar, 2015..2030
    return Q.orphans(w.fact_orders, ["order_date_key"], calendar, ["date_key"], "FACT_ORD_DATE_FK").unionByName(
        Q.orphans(w.stg.order_items, ["product_id"], w.dim_product, ["product_id"], "ITEM_PRODUCT")
    ).unionByName(
        Q.orphans(w.stg.orders, ["customer_id"], w.dim_customer, ["customer_id"], "ORDER_CUSTOMER")
    )


@query
def check_not_null(w: FixtureLoad) -> DataFrame:
    return Q.null_counts(
        w.fact_orders, ["order_id", "customer_key", "order_date_key"], "FACT_ORDERS"
    ).unionByName(
        Q.null_counts(
            w.fact_items,
            ["order_id", "order_item_id", "order_date_key", "customer_key", "product_key", "seller_key"],
            "FACT_ORDER_ITEMS",
        )
    ).unionByName(Q.null_counts(w.stg.order_reviews, ["review_score", "review_comment_title"], "STG_ORDER_REVIEWS"))


# ----------------------------------------------------------- run counters


def _counted(df: DataFrame, step: str, also: dict[str, dict[str, Column]] | None = None, **metrics: Column) -> DataFrame:
    """(step, metric, n) rows of several counts, those of further steps in ``also``, taken in one pass over ``df``."""
    counts = [(s, k, m) for s, named in {step: metrics, **(also or {})}.items() for k, m in named.items()]
    one = df.agg(*[F.coalesce(F.sum(m.cast("long")), F.lit(0)).alias(f"n{i}") for i, (_, _, m) in enumerate(counts)])
    rows = [
        F.struct(F.lit(s).alias("step_name"), F.lit(k).alias("metric"), F.col(f"n{i}").alias("n"))
        for i, (s, k, _) in enumerate(counts)
    ]
    return one.select(F.inline(F.array(*rows)))


def step_count_rows(w: FixtureLoad) -> DataFrame:
    """Counts of each step of a first load: input, output, rejected and merged rows, one pass per step and table.

    Merged rows are further rows of a business key that a dimension holds once.
    """
    from functools import reduce

    from vitrine.functions import lookups as L

    stg, one = w.stg, F.lit(1)

    def dimension(step: str, rows: DataFrame, key: str, group: list[str]) -> DataFrame:
        per_row = rows.groupBy(*group).agg(F.count(one).alias("rows"))
        known = F.col(key).isNotNull()
        return _counted(
            per_row,
            step,
            **{"in": F.col("rows"), "out": known, "rejected": F.when(~known, F.col("rows")).otherwise(0),
               "merged": F.when(known, F.col("rows") - 1).otherwise(0)},
        )

    def fact(step: str, read: DataFrame, out: DataFrame, left_out: DataFrame) -> list[DataFrame]:
        return [_counted(read, step, **{"in": one}), _counted(out, step, out=one), _counted(left_out, step, rejected=one)]

    staged = reduce(DataFrame.unionByName, [t.select(F.lit(1).alias("x")) for t in stg.tables().values()])
    items = FT.resolved_items(stg, w.dim_customer, w.dim_product, w.dim_seller, BATCH)
    loads = F.col("reason").isNull()
    agg = A.agg_daily_sales(w.fact_orders, w.dim_customer, w.fact_items, w.dim_product)
    seller = ["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"]
    parts = [
        _counted(staged, L.STEP_TAG_STAGING, **{"in": one, "out": one}),
        _counted(Q.validate_staging(stg, BATCH), L.STEP_DQ, rejected=one),
        dimension(L.STEP_DIM_CUSTOMER, stg.customers, "customer_unique_id", ["customer_unique_id"]),
        dimension(L.STEP_DIM_SELLER, stg.sellers, "seller_id", seller),
        _counted(
            stg.products, L.STEP_DIM_PRODUCT,
            **{"in": one, "out": F.col("product_id").isNotNull(), "rejected": F.col("product_id").isNull()},
        ),
        *fact(L.STEP_FACT_ORDERS, stg.orders, w.fact_orders, FT.fact_orders_unresolved(stg, w.dim_customer, BATCH)),
        _counted(items, L.STEP_FACT_ITEMS, {L.STEP_AGG_DAILY: {"in": loads}}, **{"in": one, "out": loads, "rejected": ~loads}),
        *fact(L.STEP_FACT_REVIEWS, stg.order_reviews, w.fact_reviews, FT.fact_reviews_unresolved(stg, BATCH)),
        _counted(agg, L.STEP_AGG_DAILY, out=one),
    ]
    return reduce(DataFrame.unionByName, parts)


def _pivot_counts(rows: DataFrame, keys: list[str]) -> DataFrame:
    def total(m):
        return F.coalesce(F.sum(F.when(F.col("metric") == m, F.col("n"))), F.lit(0)).cast("long")

    return rows.groupBy(*keys).agg(
        total("in").alias("records_in"),
        total("out").alias("records_out"),
        total("rejected").alias("records_rejected"),
        total("merged").alias("records_merged"),
    )


@query
def step_counts(w: FixtureLoad) -> DataFrame:
    """Step detail of a batch (counts part): what each step reads, writes and rejects."""
    return _pivot_counts(step_count_rows(w), ["step_name"]).drop("records_merged")


@query
def load_reconciliation(w: FixtureLoad) -> DataFrame:
    """Every row a load reads is written, merged into its key's row, or rejected with a reason."""
    from vitrine.functions import lookups as L

    loads = [
        L.STEP_DIM_CUSTOMER, L.STEP_DIM_SELLER, L.STEP_DIM_PRODUCT, L.STEP_FACT_ORDERS, L.STEP_FACT_ITEMS, L.STEP_FACT_REVIEWS,
    ]
    counts = _pivot_counts(step_count_rows(w).filter(F.col("step_name").isin(*loads)), ["step_name"])
    total = F.col("records_out") + F.col("records_rejected") + F.col("records_merged")
    return counts.withColumn("balanced", F.col("records_in") == total)


@query
def batch_totals(w: FixtureLoad) -> DataFrame:
    """Batch totals: sums of the step counts of the batch (zero when absent)."""
    return _pivot_counts(step_count_rows(w).withColumn("batch_id", F.lit(BATCH).cast("long")), ["batch_id"]).select(
        "batch_id",
        F.col("records_in").alias("total_records"),
        F.col("records_out").alias("success_records"),
        F.col("records_rejected").alias("rejected_records"),
    )


# --------------------------------------------------------------- CSV feeds


def _csv_round_trip(w: FixtureLoad, feed_name: str, staged: DataFrame | None = None) -> DataFrame:
    """Export a staging view as a delimited feed, then parse it back with the ingest code."""
    from vitrine.session import scratch_path
    from vitrine.sources import ingest as I
    from vitrine.sources.feeds import FEEDS

    feed = FEEDS[feed_name]
    src = (getattr(w.stg, feed_name) if staged is None else staged).select(*[c.name for c in feed.columns])
    path = scratch_path(w.spark, f"feed-{feed_name}")
    src.write.option("header", True).option("quote", '"').option("escape", '"').csv(path)
    tagged = I.tag_rows(I.read_feed_text(w.spark, feed, path), feed, BATCH, LOAD_TS)
    return tagged.filter(F.col("_reject_reason").isNull()).select(*[c.name for c in feed.columns], "etl_batch_id")


def translations_found(translation: DataFrame, products: DataFrame) -> DataFrame:
    """Translations of the categories that staged products have."""
    found = products.select("product_category_name").distinct()
    return translation.join(found, "product_category_name", "left_semi")


@query
def ingest_orders_csv(w: FixtureLoad) -> DataFrame:
    return _csv_round_trip(w, "orders")


@query
def ingest_customers_csv(w: FixtureLoad) -> DataFrame:
    return _csv_round_trip(w, "customers")


@query
def ingest_sellers_csv(w: FixtureLoad) -> DataFrame:
    return _csv_round_trip(w, "sellers")


@query
def ingest_products_csv(w: FixtureLoad) -> DataFrame:
    return _csv_round_trip(w, "products")


@query
def ingest_geolocation_csv(w: FixtureLoad) -> DataFrame:
    return _csv_round_trip(w, "geolocation")


@query
def ingest_order_items_csv(w: FixtureLoad) -> DataFrame:
    return _csv_round_trip(w, "order_items")


@query
def ingest_payments_csv(w: FixtureLoad) -> DataFrame:
    return _csv_round_trip(w, "order_payments")


@query
def ingest_translation_csv(w: FixtureLoad) -> DataFrame:
    return _csv_round_trip(w, "category_translation", translations_found(w.stg.category_translation, w.stg.products))


@query
def ingest_reviews_csv(w: FixtureLoad) -> DataFrame:
    return _csv_round_trip(w, "order_reviews")


@query
def ingest_reviews_multiline(w: FixtureLoad) -> DataFrame:
    """Reviews with line ends, quotes and commas in their messages, through the splittable scan of quoted records."""
    return _csv_round_trip(w, "order_reviews", FX.multiline_reviews(w.stg.order_reviews))


def _planted_ingest(w: FixtureLoad, feed_name: str) -> DataFrame:
    """A feed with planted defects, written as delimited text and ingested; rows with more fields are rejected."""
    from vitrine.session import scratch_path
    from vitrine.sources import ingest as I
    from vitrine.sources.feeds import FEEDS

    feed, rows = FEEDS[feed_name], getattr(w.stg, feed_name)
    rows = FX.multiline_reviews(rows) if feed.multiline else rows
    path = scratch_path(w.spark, f"planted-{feed_name}")
    records = FX.planted_records(rows.select(I.record_text(feed).alias("record")), feed.multiline)
    I.export_records(records, feed, path)
    return I.tag_rows(I.read_feed_text(w.spark, feed, path), feed, BATCH, LOAD_TS, long_rows="reject")


@query
def ingest_bad_rows(w: FixtureLoad) -> DataFrame:
    """Rejects of all nine feeds with planted defects: the reason and the record exactly as it was read."""
    from functools import reduce

    from vitrine.sources import ingest as I
    from vitrine.sources.feeds import LOAD_ORDER

    parts = [
        _planted_ingest(w, f.name).where("_reject_reason IS NOT NULL").select(
            F.lit(f.table.upper()).alias("source_table"),
            I._key(f).alias("source_key"),
            F.col("_reject_reason").alias("reject_reason"),
            F.col("_raw").alias("raw_data"),
            "etl_batch_id",
        )
        for f in LOAD_ORDER
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def ingest_balance(w: FixtureLoad) -> DataFrame:
    """Per feed with planted defects: loaded and rejected records, and the reasons' counts."""
    from functools import reduce

    from vitrine.functions import lookups as L
    from vitrine.sources.feeds import LOAD_ORDER

    def of(reason: Column) -> Column:
        return F.count_if(F.coalesce(reason, F.lit(False)))

    why = F.col("_reject_reason")
    parts = [
        _planted_ingest(w, f.name).groupBy().agg(
            F.lit(f.table.upper()).alias("source_table"),
            F.count(F.lit(1)).alias("records_in"),
            of(why.isNull()).alias("loaded"),
            of(why == L.REJECT_LONG_ROW).alias("long_rows"),
            of(why == L.REJECT_QUOTES).alias("bad_quotes"),
            of(why.startswith("Value too long")).alias("too_wide"),
        )
        for f in LOAD_ORDER
    ]
    return reduce(DataFrame.unionByName, parts)
