"""Staging views over the driver's test tables.

The pipeline's inputs are nine delimited feeds (see ``feeds.py``). The test
data is a TPC-H-like star schema instead, so this module maps each driver table
onto one feed, column for column, with plain DataFrame expressions. The
mapping is deliberately lossy in places (bad statuses, negative prices,
out-of-range scores, repeat customers, untranslated categories) so that every
data-quality rule and join edge is exercised. ``FIXTURES.md`` is the spec.

Every view is lazy and reads only the columns it needs; it grows linearly with
the input tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitrine.sources.feeds import Staging

FIXTURE_BATCH_ID = 1
FIXTURE_LOAD_TS = "2024-06-30 00:00:00"
# A fixed "today" for everything dated at run time (SCD2 effective dates).
FIXTURE_AS_OF = "2024-06-30"

# --- FIXED VALUES (test mapping): state code chosen by nation key + 1 ---
FIXTURE_STATES = [
    "SP", "RJ", "MG", "RS", "PR", "SC", "BA", "DF", "ES", "GO", "PE", "CE", "PA",
    "MT", "MA", "MS", "PB", "PI", "RN", "AL", "SE", "RO", "AM", "ac", "zz",
]

# --- FIXED VALUES (test mapping): category translation rows ---
FIXTURE_TRANSLATION = [
    ("cat_economy", "fashion_bags"),
    ("cat_large", "furniture_decor"),
    ("cat_medium", "health_beauty"),
    ("cat_promo", "sports_leisure"),
    ("cat_small", "toys"),
]


# Layouts of the driver's tables: reading with a given schema skips the
# footer-inference job that every schema-less read would start.
TABLE_SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _audit(df: DataFrame, source_file: str) -> DataFrame:
    return (
        df.withColumn("etl_batch_id", F.lit(FIXTURE_BATCH_ID).cast("long"))
        .withColumn("etl_insert_dt", F.lit(FIXTURE_LOAD_TS).cast("timestamp"))
        .withColumn("etl_source_file", F.lit(source_file))
    )


def _day_text(day, plus_days, clock: str):
    return F.concat(F.date_add(day, plus_days).cast("string"), F.lit(" " + clock))


def _state(nationkey):
    return F.element_at(F.array(*[F.lit(s) for s in FIXTURE_STATES]), nationkey + 1)


def _zip(nationkey):
    return F.lpad(nationkey.cast("string"), 5, "0")


def _money_text(x):
    return x.cast("decimal(12,2)").cast("string")


def stg_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    day = F.col("o_orderdate").cast("date")
    status = (
        F.when(k % 97 == 0, "bogus")
        .when(F.col("o_orderstatus") == "F", "delivered")
        .when(F.col("o_orderstatus") == "O", "shipped")
        .otherwise("processing")
    )
    df = o.select(
        F.when(k % 701 != 0, k.cast("string")).alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        status.alias("order_status"),
        F.when(k % 499 == 0, "1998-13-45 08:00:00").otherwise(_day_text(day, 0, "08:00:00")).alias("order_purchase_timestamp"),
        F.when(k % 50 != 0, _day_text(day, (k % 3).cast("int"), "09:00:00")).alias("order_approved_at"),
        F.lit(None).cast("string").alias("order_delivered_carrier_date"),
        F.when(F.col("o_orderstatus") == "F", _day_text(day, (1 + k % 30).cast("int"), "18:00:00")).alias(
            "order_delivered_customer_date"
        ),
        _day_text(day, 20, "00:00:00").alias("order_estimated_delivery_date"),
    )
    return _audit(df, "orders.parquet")


def stg_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    # (l_orderkey, l_linenumber) is not unique in the test data, so the item
    # number is re-derived; one order holds a handful of lines. The window deals
    # the rows by the order id as text, so that later joins on it move them no more.
    li = read_table(spark, sf_dir, "lineitem").withColumn("order_id", F.col("l_orderkey").cast("string"))
    w = Window.partitionBy("order_id").orderBy(
        "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity", "l_discount", "l_tax"
    )
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    key, line = F.col("order_id").cast("long"), F.col("l_linenumber")
    text = (
        F.when((key % 613 == 0) & (line == 1), "n/a")
        .when((key % 1009 == 0) & (line == 2), "12345678901.00")
        .when((key % 500 == 0) & (line == 7), (-price).cast("string"))
        .when(key % 11 == 0, F.concat(price.cast("string"), F.lit("495")))
        .otherwise(price.cast("string"))
    )
    df = li.select(
        "order_id",
        F.row_number().over(w).cast("long").alias("order_item_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_suppkey").cast("string").alias("seller_id"),
        F.col("l_shipdate").cast("date").cast("string").alias("shipping_limit_date"),
        text.alias("price"),
        _money_text(F.col("l_quantity")).alias("freight_value"),
    )
    return _audit(df, "lineitem.parquet")


def stg_order_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    ptype = (
        F.when(F.col("l_returnflag") == "R", "credit_card")
        .when(F.col("l_returnflag") == "A", "boleto")
        .otherwise("voucher")
    )
    df = li.select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_linenumber").cast("long").alias("payment_sequential"),
        ptype.alias("payment_type"),
        (1 + F.col("l_linenumber")).cast("long").alias("payment_installments"),
        F.when((F.col("l_orderkey") % 29 == 0) & (F.col("l_returnflag") == "A"), F.lit(None))
        .when(F.col("l_orderkey") % 31 == 0, "10.00")
        .otherwise(_money_text(F.col("l_extendedprice")))
        .alias("payment_value"),
    )
    return _audit(df, "lineitem.parquet")


def stg_order_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    eid = F.col("event_id")
    day = F.col("ts").cast("date")
    is_error = F.col("event_type") == "error"
    df = ev.select(
        F.concat(F.lit("r"), eid.cast("string")).alias("review_id"),
        (eid - eid % 3).cast("string").alias("order_id"),
        F.when(eid % 101 == 0, 0).otherwise(1 + eid % 5).cast("int").alias("review_score"),
        F.when(F.col("event_type") == "purchase", F.col("event_type")).alias("review_comment_title"),
        F.when(~is_error, F.col("props")).alias("review_comment_message"),
        _day_text(day, 0, "00:00:00").alias("review_creation_date"),
        F.when(~is_error, _day_text(day, (eid % 7).cast("int"), "12:00:00")).alias("review_answer_timestamp"),
    )
    return _audit(df, "events.parquet")


def stg_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    unique = F.when(k % 20 == 19, k - 1).otherwise(k)
    df = c.select(
        k.cast("string").alias("customer_id"),
        F.when(k % 211 != 0, F.concat(F.lit("u"), unique.cast("string"))).alias("customer_unique_id"),
        _zip(F.col("c_nationkey")).alias("customer_zip_code_prefix"),
        F.concat(F.lower("c_mktsegment"), F.lit(" do sul")).alias("customer_city"),
        _state(F.col("c_nationkey")).alias("customer_state"),
    )
    return _audit(df, "customer.parquet")


def stg_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    df = s.select(
        F.when(k % 43 != 7, k.cast("string")).alias("seller_id"),
        _zip(F.col("s_nationkey")).alias("seller_zip_code_prefix"),
        F.concat(F.lit("porto-d'agua "), (k % 7).cast("string")).alias("seller_city"),
        _state(F.col("s_nationkey")).alias("seller_state"),
    )
    return _audit(df, "supplier.parquet")


def stg_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    size = F.col("p_size").cast("long")
    name_len = F.length("p_name").cast("long")
    variant = F.when(k % 3 == 0, F.concat(F.lit("_"), (k % 4).cast("string"))).otherwise("")
    df = p.select(
        F.when(k % 307 != 0, k.cast("string")).alias("product_id"),
        F.when(k % 200 != 0, F.concat(F.lit("cat_"), F.lower("p_type"), variant)).alias("product_category_name"),
        name_len.alias("product_name_lenght"),
        (name_len * 10).alias("product_description_lenght"),
        (size % 5).alias("product_photos_qty"),
        (size * 100).alias("product_weight_g"),
        size.alias("product_length_cm"),
        (size + 1).alias("product_height_cm"),
        (size + 2).alias("product_width_cm"),
    )
    return _audit(df, "part.parquet")


def stg_geolocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    frac = F.lpad((k % 1000).cast("string"), 3, "0")
    mark = F.when(k % 2 == 0, ",").otherwise(".")
    df = c.select(
        F.when(F.col("c_nationkey") == 7, "99907").otherwise(_zip(F.col("c_nationkey"))).alias("geolocation_zip_code_prefix"),
        F.when(k % 401 == 0, "-123456.5")
        .otherwise(F.concat(F.lit("-"), (k % 33).cast("string"), mark, frac))
        .alias("geolocation_lat"),
        F.concat(F.lit("-"), (35 + k % 35).cast("string"), F.lit("."), frac).alias("geolocation_lng"),
        F.lit(None).cast("string").alias("geolocation_city"),
        F.lit(None).cast("string").alias("geolocation_state"),
    )
    return _audit(df, "customer.parquet")


def literal_rows(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    """A small constant table built in the JVM (no Python worker, no RDD)."""
    structs = [F.struct(*[F.lit(v).alias(n) for v, n in zip(r, names)]) for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def stg_category_translation(spark: SparkSession, sf_dir: str | None = None) -> DataFrame:
    df = literal_rows(spark, FIXTURE_TRANSLATION, ["product_category_name", "product_category_name_english"])
    return _audit(df, "translation.inline")


def multiline_reviews(reviews: DataFrame) -> DataFrame:
    """Reviews of an even score get a message of several lines with quotes and commas (``FIXTURES.md``)."""
    more = F.concat("review_comment_message", F.lit('\nsecond "line", with\n\na last one'))
    even = F.col("review_score") % 2 == 0
    return reviews.withColumn("review_comment_message", F.when(even, more).otherwise(F.col("review_comment_message")))


#: Defects planted into a feed's records, by the record's length modulo PLANT_MOD (``FIXTURES.md``).
PLANT_MOD = 23
PLANT_LONG, PLANT_QUOTE, PLANT_WIDE, PLANT_SHORT, PLANT_OPEN = 3, 5, 7, 11, 17
PLANT_WIDTH = 600


def planted_records(records: DataFrame, multiline: bool) -> DataFrame:
    """``record`` with a further field, a quote inside or at the end of its last field, a too long first field, or one field only."""
    r = F.col("record")
    kind = F.length(r) % PLANT_MOD
    bad = (
        F.when(kind == PLANT_LONG, F.concat(r, F.lit(",extra")))
        .when(kind == PLANT_QUOTE, F.concat(r, F.lit('x"x"')))
        .when(kind == PLANT_WIDE, F.concat(F.lit("w" * PLANT_WIDTH), r))
        .when(kind == PLANT_SHORT, F.substring_index(r, ",", 1))
    )
    if not multiline:  # an open quote would take the rest of a file that may hold line ends in quotes
        bad = bad.when(kind == PLANT_OPEN, F.concat(r, F.lit('"')))
    return records.select(bad.otherwise(r).alias("record"))


def staging(spark: SparkSession, sf_dir: str) -> Staging:
    return Staging(
        orders=stg_orders(spark, sf_dir),
        order_items=stg_order_items(spark, sf_dir),
        order_payments=stg_order_payments(spark, sf_dir),
        order_reviews=stg_order_reviews(spark, sf_dir),
        customers=stg_customers(spark, sf_dir),
        sellers=stg_sellers(spark, sf_dir),
        products=stg_products(spark, sf_dir),
        geolocation=stg_geolocation(spark, sf_dir),
        category_translation=stg_category_translation(spark, sf_dir),
    )
