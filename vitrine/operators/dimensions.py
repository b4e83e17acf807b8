"""Dimension jobs: source selects, SCD type 1 upsert, SCD type 2 versioning.

The ``*_source`` functions are the per-batch source rows of each dimension;
``scd1_upsert`` and ``scd2_apply`` turn (current table, source rows) into the
next version of the table.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.functions import columns as C
from vitrine.functions import lookups as L
from vitrine.operators.keys import DEFAULT_BUCKETS, assign_keys
from vitrine.operators.quality import in_batch
from vitrine.session import scratch_path
from vitrine.sources.feeds import Staging

# --- FIXED VALUES: column names and order of the warehouse's dimension tables ---
CUSTOMER_COLUMNS = [
    "customer_key",
    "customer_unique_id",
    "customer_id",
    "zip_code_prefix",
    "city",
    "state",
    "state_name",
    "region",
    "lat",
    "lng",
    "is_active",
    "etl_batch_id",
    "etl_insert_dt",
    "etl_update_dt",
]
SELLER_COLUMNS = [
    "seller_key",
    "seller_id",
    "zip_code_prefix",
    "city",
    "state",
    "region",
    "lat",
    "lng",
    "is_active",
    "etl_batch_id",
    "etl_insert_dt",
    "etl_update_dt",
]
PRODUCT_COLUMNS = [
    "product_key",
    "product_id",
    "category_name_pt",
    "category_name_en",
    "category_group",
    "product_name_length",
    "product_desc_length",
    "product_photos_qty",
    "weight_g",
    "length_cm",
    "height_cm",
    "width_cm",
    "volume_cm3",
    "effective_from",
    "effective_to",
    "is_current",
    "etl_batch_id",
    "etl_insert_dt",
]


def _batch_lit(batch_id: int | None) -> Column:
    return F.lit(batch_id).cast("long")


# ------------------------------------------------------------------ geography


def geo_centroid(geolocation: DataFrame, batch_id: int | None = None) -> DataFrame:
    """Average latitude/longitude per zip prefix, rounded to 6 decimals.

    A plain grouped sum/count: the partial aggregate runs before the shuffle,
    so a zip prefix with millions of rows costs one row per map task.
    """
    g = in_batch(geolocation, batch_id).select(
        F.col("geolocation_zip_code_prefix").alias("zip_code_prefix"),
        C.parse_coord("geolocation_lat").alias("lat"),
        C.parse_coord("geolocation_lng").alias("lng"),
    )
    agg = g.groupBy("zip_code_prefix").agg(
        F.sum("lat").alias("lat_sum"),
        F.count("lat").alias("lat_n"),
        F.sum("lng").alias("lng_sum"),
        F.count("lng").alias("lng_n"),
    )
    return agg.select(
        "zip_code_prefix",
        C.round_ratio("lat_sum", "lat_n", 6, C.COORD_SCALE).cast(C.COORD_TYPE).alias("lat"),
        C.round_ratio("lng_sum", "lng_n", 6, C.COORD_SCALE).cast(C.COORD_TYPE).alias("lng"),
    )


# ------------------------------------------------------------------ customers


def customer_source(stg: Staging, batch_id: int | None = None) -> DataFrame:
    """One row per unique customer: the latest staged row, with its zip centroid.

    "Latest" is the greatest (load time, customer_id), NULL load time first,
    picked with a grouped ``max`` over a struct instead of ``row_number``: the
    partial aggregate collapses a hot customer before the shuffle.
    """
    c = in_batch(stg.customers, batch_id).filter(F.col("customer_unique_id").isNotNull())
    pick = F.max(
        F.struct(
            F.col("etl_insert_dt").isNull().alias("t_null"),
            F.col("etl_insert_dt").alias("t"),
            F.col("customer_id").isNull().alias("id_null"),
            F.col("customer_id").alias("customer_id"),
            F.col("customer_zip_code_prefix").alias("zip"),
            F.col("customer_city").alias("city"),
            F.col("customer_state").alias("state"),
        )
    ).alias("r")
    latest = c.groupBy("customer_unique_id").agg(pick)
    src = latest.select(
        "customer_unique_id",
        F.col("r.customer_id").alias("customer_id"),
        F.col("r.zip").alias("zip_code_prefix"),
        C.initcap_words("r.city").alias("city"),
        F.upper("r.state").alias("state"),
        C.state_name("r.state").alias("state_name"),
        C.region("r.state").alias("region"),
    )
    geo = geo_centroid(stg.geolocation, batch_id)
    out = src.join(geo, "zip_code_prefix", "left")
    batch = _batch_lit(batch_id) if batch_id is not None else F.lit(None).cast("long")
    return out.select(
        "customer_unique_id",
        "customer_id",
        "zip_code_prefix",
        "city",
        "state",
        "state_name",
        "region",
        "lat",
        "lng",
        batch.alias("etl_batch_id"),
    )


def keyless_rows(stg: Staging, batch_id: int | None = None) -> DataFrame:
    """Reject rows of customers, sellers and products without their business key (the dimensions require it)."""
    batch = F.lit(batch_id).cast("long") if batch_id is not None else F.col("etl_batch_id")

    def rows(df: DataFrame, table: str, key: str, reason: str, raw: list[str]) -> DataFrame:
        return (
            in_batch(df, batch_id)
            .filter(F.col(key).isNull())
            .select(
                F.lit(table).alias("source_table"),
                F.lit(L.NULL_KEY_TEXT).alias("source_key"),
                F.lit(reason).alias("reject_reason"),
                F.concat_ws(",", *raw).alias("raw_data"),
                batch.alias("etl_batch_id"),
            )
        )

    return (
        rows(stg.customers, "STG_CUSTOMERS", "customer_unique_id", L.REJECT_NULL_CUSTOMER, ["customer_id", "customer_city"])
        .unionByName(rows(stg.sellers, "STG_SELLERS", "seller_id", L.REJECT_NULL_SELLER, ["seller_city", "seller_state"]))
        .unionByName(rows(stg.products, "STG_PRODUCTS", "product_id", L.REJECT_NULL_PRODUCT, ["product_category_name"]))
    )


# -------------------------------------------------------------------- sellers


def seller_source(stg: Staging, batch_id: int | None = None) -> DataFrame:
    """Distinct (seller, zip, city, state) rows with the zip centroid.

    Averaging the raw geolocation rows of a seller's zip equals the zip
    centroid, so the centroid (already reduced to one row per zip) is joined
    instead of the raw rows.
    """
    s = (
        in_batch(stg.sellers, batch_id)
        .filter(F.col("seller_id").isNotNull())  # the key is required (NOT NULL in the dimension)
        .select("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state")
        .distinct()
    )
    geo = geo_centroid(stg.geolocation, batch_id)
    out = s.join(geo, s["seller_zip_code_prefix"] == geo["zip_code_prefix"], "left")
    batch = _batch_lit(batch_id) if batch_id is not None else F.lit(None).cast("long")
    return out.select(
        "seller_id",
        F.col("seller_zip_code_prefix").alias("zip_code_prefix"),
        C.initcap_words("seller_city").alias("city"),
        F.upper("seller_state").alias("state"),
        C.region("seller_state").alias("region"),
        "lat",
        "lng",
        batch.alias("etl_batch_id"),
    )


# ------------------------------------------------------------------- products


def product_source(stg: Staging, batch_id: int | None = None, with_translated: bool = False) -> DataFrame:
    """Staged products with English category name and category group (rows without an id go to ``keyless_rows``).

    ``with_translated`` adds whether the batch has a translation of the category.
    """
    s = in_batch(stg.products, batch_id).filter(F.col("product_id").isNotNull())
    t = in_batch(stg.category_translation, batch_id).select(
        F.col("product_category_name").alias("_pt"), F.col("product_category_name_english").alias("_en")
    )
    extra = [F.col("_pt").isNotNull().alias("translated")] if with_translated else []
    j = s.join(t, s["product_category_name"] == t["_pt"], "left")
    batch = _batch_lit(batch_id) if batch_id is not None else F.lit(None).cast("long")
    length, height, width = F.col("product_length_cm"), F.col("product_height_cm"), F.col("product_width_cm")
    return j.select(
        "product_id",
        F.col("product_category_name").alias("category_name_pt"),
        F.coalesce("_en", "product_category_name").alias("category_name_en"),
        C.category_group("_en").alias("category_group"),
        F.col("product_name_lenght").alias("product_name_length"),
        F.col("product_description_lenght").alias("product_desc_length"),
        "product_photos_qty",
        F.col("product_weight_g").alias("weight_g"),
        length.alias("length_cm"),
        height.alias("height_cm"),
        width.alias("width_cm"),
        (length * height * width).alias("volume_cm3"),
        batch.alias("etl_batch_id"),
        *extra,
    )


def product_changes(
    history: DataFrame,
    stg: Staging,
    batch_id: int | None = None,
    tracked: tuple[str, ...] = ("category_name_en",),
) -> DataFrame:
    """Current dimension rows that differ from the new feed in a ``tracked`` column, NULL-safely.

    Only staged products that *have* a translation in the same batch take part.
    """
    fresh = product_source(stg, batch_id, with_translated=True).filter("translated")
    fresh = fresh.select(F.col("product_id").alias("_pid"), *[F.col(c).alias(f"_new_{c}") for c in tracked])
    differs = reduce(lambda x, y: x | y, [~F.col(c).eqNullSafe(F.col(f"_new_{c}")) for c in tracked])
    current = history.filter(F.col("is_current") == "Y")
    return current.join(fresh, (F.col("product_id") == F.col("_pid")) & differs, "left_semi")


def scd2_apply(
    history: DataFrame,
    source: DataFrame,
    changed: DataFrame,
    as_of: str | _dt.date,
    batch_id: int | None,
    load_ts: str | None = None,
    start_key: int = 0,
    buckets: int | None = DEFAULT_BUCKETS,
) -> DataFrame:
    """Next version of a type-2 product dimension.

    1. rows of ``changed`` products that are current are closed:
       ``effective_to = as_of - 1``, ``is_current = 'N'``;
    2. every source row whose product has no current row left is inserted as
       a new current version from ``as_of`` (new products and just-closed ones).
    Weight/size changes alone create no version, as in the source pipeline.
    """
    day = F.lit(str(as_of)).cast("date")
    ts = F.lit(load_ts or f"{as_of} 00:00:00").cast("timestamp")
    # The ids of changed products are needed three times: written once, small.
    path = scratch_path(history.sparkSession, "changed-products")
    changed.select(F.col("product_id").alias("_cid")).distinct().write.parquet(path)
    chg = history.sparkSession.read.schema("_cid string").parquet(path)
    h = history.join(chg, history["product_id"] == chg["_cid"], "left")
    closing = (F.col("is_current") == "Y") & F.col("_cid").isNotNull()
    h = (
        h.withColumn("effective_to", F.when(closing, F.date_sub(day, 1)).otherwise(F.col("effective_to")))
        .withColumn("is_current", F.when(closing, F.lit("N")).otherwise(F.col("is_current")))
        .drop("_cid")
    )
    current = history.filter(F.col("is_current") == "Y").select(F.col("product_id").alias("_cur"))
    still_current = current.join(chg, F.col("_cur") == F.col("_cid"), "left_anti")
    new = source.join(still_current, source["product_id"] == still_current["_cur"], "left_anti")
    new = (
        new.withColumn("effective_from", day)
        .withColumn("effective_to", F.lit(None).cast("date"))
        .withColumn("is_current", F.lit("Y"))
        .withColumn("etl_batch_id", _batch_lit(batch_id))
        .withColumn("etl_insert_dt", ts)
    )
    keyed = assign_keys(new, ["product_id", "category_name_pt", "weight_g"], "product_key", start_key, buckets)
    return h.select(*PRODUCT_COLUMNS).unionByName(keyed.select(*PRODUCT_COLUMNS))


# ------------------------------------------------- versions out of order


def merge_sightings(sightings: DataFrame, batch: DataFrame, key: str = "product_id", day: str = "seen_on") -> DataFrame:
    """What each batch has said of a product: a row per product and day; the batch replaces what it said that day before."""
    return sightings.join(batch.select(key, day), [key, day], "left_anti").unionByName(batch)


def product_timeline(sightings: DataFrame, tracked: tuple[str, ...] = ("category_name_en",), key: str = "product_id", day: str = "seen_on") -> DataFrame:
    """Version history from what the batches said, whatever the order they were loaded in.

    Sightings of a product in day order; a version begins where a ``tracked``
    column differs from the sighting before it (NULL-safely), keeps all columns
    of that sighting, and ends the day before the next one begins. A product has
    a sighting per batch, so its window is as long as the number of batches.
    """
    from pyspark.sql import Window

    in_order = Window.partitionBy(key).orderBy(day)
    same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.lag(c).over(in_order)) for c in tracked])
    first = F.row_number().over(in_order) == 1
    begins = sightings.withColumn("_begins", first | ~same).where("_begins").drop("_begins")
    following = F.lead(day).over(in_order)
    return begins.select(
        *[c for c in begins.columns if c != day],
        F.col(day).alias("effective_from"),
        F.date_sub(following, 1).alias("effective_to"),
        C.yes_no(following.isNull()).alias("is_current"),
    )


def refresh_timeline(
    timeline: DataFrame, sightings: DataFrame, batch: DataFrame, tracked: tuple[str, ...] = ("category_name_en",), key: str = "product_id"
) -> DataFrame:
    """The timeline after ``batch`` was merged into ``sightings``: only the batch's products are worked out anew."""
    touched = batch.select(key).distinct()
    fresh = product_timeline(sightings.join(touched, key, "left_semi"), tracked, key)
    return timeline.join(touched, key, "left_anti").unionByName(fresh)


# ------------------------------------------------------------ SCD1 upsert


def scd1_upsert(
    target: DataFrame,
    source: DataFrame,
    business_key: str,
    key_name: str,
    columns: list[str],
    as_of_ts: str,
    start_key: int = 0,
    buckets: int | None = DEFAULT_BUCKETS,
) -> DataFrame:
    """MERGE: matched rows take the source values; new keys are inserted.

    ``source`` must be unique on ``business_key`` (checked by the caller).
    Existing surrogate keys never change; new ones continue after
    ``start_key``. Target rows without a source row are kept as they are.
    The result has an extra column ``merge_action`` (KEEP/UPDATE/INSERT).

    Only the business keys not seen before are numbered (one key column each of
    source and target); target and source meet in a single full outer join.
    """
    ts = F.lit(as_of_ts).cast("timestamp")
    updated_cols = [c for c in source.columns if c != business_key]
    unseen = source.select(business_key).join(target.select(business_key), business_key, "left_anti")
    numbered = assign_keys(unseen, [business_key], "_new_key", start_key, buckets)
    s = source.join(numbered, business_key, "left")
    t = target.select(*[F.col(c).alias(f"t_{c}") for c in target.columns], F.lit(True).alias("_in_t"))
    s = s.select(*[F.col(c).alias(f"s_{c}") for c in source.columns], "_new_key", F.lit(True).alias("_in_s"))
    j = t.join(s, F.col(f"t_{business_key}") == F.col(f"s_{business_key}"), "full_outer")
    in_t, in_s = F.col("_in_t").isNotNull(), F.col("_in_s").isNotNull()
    action = F.when(in_t & in_s, "UPDATE").when(in_t, "KEEP").otherwise("INSERT")

    def pick(c: str) -> Column:
        if c == key_name:
            return F.coalesce(F.col(f"t_{c}"), F.col("_new_key"))
        if c == business_key:
            return F.coalesce(F.col(f"t_{c}"), F.col(f"s_{c}"))
        if c in updated_cols:
            return F.when(in_s, F.col(f"s_{c}")).otherwise(F.col(f"t_{c}"))
        if c == "etl_update_dt":
            return F.when(in_t & in_s, ts).otherwise(F.col(f"t_{c}"))
        if c == "etl_insert_dt":
            return F.when(in_t, F.col(f"t_{c}")).otherwise(ts)
        if c == "is_active":
            return F.when(in_t, F.col(f"t_{c}")).otherwise(F.lit("Y"))
        return F.col(f"t_{c}")

    return j.select(*[pick(c).alias(c) for c in columns], action.alias("merge_action"))
