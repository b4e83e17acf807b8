"""The nine delimited input feeds: columns, widths, types and load order.

Staging keeps text as text: amounts and timestamps are parsed by the jobs
(with ``try_cast`` / ``try_to_date``) so one bad value rejects one row instead
of failing a load. Integer columns are integers already in staging, as in the
source warehouse's staging DDL.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame
from pyspark.sql import types as T


@dataclass(frozen=True)
class Field:
    name: str
    kind: str = "string"  # "string" | "long" | "int"
    width: int | None = None  # maximum characters for text columns


@dataclass(frozen=True)
class Feed:
    name: str  # staging table suffix, e.g. "orders" -> stg_orders
    file_name: str
    key: tuple[str, ...]  # business key used in reject rows
    columns: tuple[Field, ...]
    multiline: bool = False  # quoted free text may contain newlines

    @property
    def table(self) -> str:
        return f"stg_{self.name}"

    def csv_schema(self) -> T.StructType:
        """All columns read as text; typed columns are cast with try_cast."""
        return T.StructType([T.StructField(c.name, T.StringType(), True) for c in self.columns])

    def staging_schema(self) -> T.StructType:
        kinds = {"string": T.StringType(), "long": T.LongType(), "int": T.IntegerType()}
        cols = [T.StructField(c.name, kinds[c.kind], True) for c in self.columns]
        return T.StructType(cols + AUDIT_FIELDS)


AUDIT_FIELDS = [
    T.StructField("etl_batch_id", T.LongType(), True),
    T.StructField("etl_insert_dt", T.TimestampType(), True),
    T.StructField("etl_source_file", T.StringType(), True),
]

S = "string"

# --- FIXED VALUES: feed layouts (column order = file column order) ---
TRANSLATION = Feed(
    "category_translation",
    "product_category_name_translation.csv",
    ("product_category_name",),
    (Field("product_category_name", S, 100), Field("product_category_name_english", S, 100)),
)
CUSTOMERS = Feed(
    "customers",
    "olist_customers_dataset.csv",
    ("customer_id",),
    (
        Field("customer_id", S, 50),
        Field("customer_unique_id", S, 50),
        Field("customer_zip_code_prefix", S, 10),
        Field("customer_city", S, 100),
        Field("customer_state", S, 5),
    ),
)
SELLERS = Feed(
    "sellers",
    "olist_sellers_dataset.csv",
    ("seller_id",),
    (
        Field("seller_id", S, 50),
        Field("seller_zip_code_prefix", S, 10),
        Field("seller_city", S, 100),
        Field("seller_state", S, 5),
    ),
)
PRODUCTS = Feed(
    "products",
    "olist_products_dataset.csv",
    ("product_id",),
    (
        Field("product_id", S, 50),
        Field("product_category_name", S, 100),
        Field("product_name_lenght", "long"),
        Field("product_description_lenght", "long"),
        Field("product_photos_qty", "long"),
        Field("product_weight_g", "long"),
        Field("product_length_cm", "long"),
        Field("product_height_cm", "long"),
        Field("product_width_cm", "long"),
    ),
)
GEOLOCATION = Feed(
    "geolocation",
    "olist_geolocation_dataset.csv",
    ("geolocation_zip_code_prefix",),
    (
        Field("geolocation_zip_code_prefix", S, 10),
        Field("geolocation_lat", S, 30),
        Field("geolocation_lng", S, 30),
        Field("geolocation_city", S, 100),
        Field("geolocation_state", S, 5),
    ),
)
ORDERS = Feed(
    "orders",
    "olist_orders_dataset.csv",
    ("order_id",),
    (
        Field("order_id", S, 50),
        Field("customer_id", S, 50),
        Field("order_status", S, 30),
        Field("order_purchase_timestamp", S, 30),
        Field("order_approved_at", S, 30),
        Field("order_delivered_carrier_date", S, 30),
        Field("order_delivered_customer_date", S, 30),
        Field("order_estimated_delivery_date", S, 30),
    ),
)
ORDER_ITEMS = Feed(
    "order_items",
    "olist_order_items_dataset.csv",
    ("order_id", "order_item_id"),
    (
        Field("order_id", S, 50),
        Field("order_item_id", "long"),
        Field("product_id", S, 50),
        Field("seller_id", S, 50),
        Field("shipping_limit_date", S, 30),
        Field("price", S, 20),
        Field("freight_value", S, 20),
    ),
)
ORDER_PAYMENTS = Feed(
    "order_payments",
    "olist_order_payments_dataset.csv",
    ("order_id", "payment_sequential"),
    (
        Field("order_id", S, 50),
        Field("payment_sequential", "long"),
        Field("payment_type", S, 30),
        Field("payment_installments", "long"),
        Field("payment_value", S, 20),
    ),
)
ORDER_REVIEWS = Feed(
    "order_reviews",
    "olist_order_reviews_dataset.csv",
    ("review_id",),
    (
        Field("review_id", S, 50),
        Field("order_id", S, 50),
        Field("review_score", "int"),
        Field("review_comment_title", S, 500),
        Field("review_comment_message", S),
        Field("review_creation_date", S, 30),
        Field("review_answer_timestamp", S, 30),
    ),
    multiline=True,
)

# Load order of the feeds (translation first: products map through it).
LOAD_ORDER = (
    TRANSLATION,
    CUSTOMERS,
    SELLERS,
    PRODUCTS,
    GEOLOCATION,
    ORDERS,
    ORDER_ITEMS,
    ORDER_PAYMENTS,
    ORDER_REVIEWS,
)
FEEDS = {f.name: f for f in LOAD_ORDER}


@dataclass
class Staging:
    """The nine staging tables (of one batch, or all batches)."""

    orders: DataFrame
    order_items: DataFrame
    order_payments: DataFrame
    order_reviews: DataFrame
    customers: DataFrame
    sellers: DataFrame
    products: DataFrame
    geolocation: DataFrame
    category_translation: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {f.name: getattr(self, f.name) for f in fields(self)}
