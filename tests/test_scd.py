"""Dimension semantics: SCD1 upsert and SCD2 versioning on hand-made rows."""

import datetime as dt

from pyspark.sql import functions as F

from test_functions import _empty_stg, _rows
from vitrine.operators import dimensions as D
from vitrine.operators import quality as Q
from vitrine.operators.keys import assign_keys
from vitrine.plans import schemas


def test_repeat_customer_keeps_greater_id(spark):
    cust = _rows(spark, "customers", [
        ("c1", "u1", "01000", "sao paulo", "SP"), ("c2", "u1", "01000", "campinas", "sp"),
        ("c3", "u3", "99999", "rio", "rj"),
    ])
    geo = _rows(spark, "geolocation", [("01000", "-23,5", "-46.5", None, None), ("01000", "-23.6", "-46.6", None, None)])
    stg = _empty_stg(spark, customers=cust, geolocation=geo)
    src = {r.customer_unique_id: r for r in D.customer_source(stg, 1).collect()}
    assert src["u1"].customer_id == "c2" and src["u1"].city == "Campinas" and src["u1"].state == "SP"
    assert str(src["u1"].lat) == "-23.550000" and src["u3"].lat is None
    # upsert: existing key stays, new key continues after the max
    target = assign_keys(D.customer_source(stg, 1).filter("customer_unique_id = 'u1'"), ["customer_unique_id"],
                         "customer_key", 41)
    dim_schema = spark.createDataFrame([], schemas.DIM_CUSTOMER).schema
    target = target.select(
        *[F.col(f.name) if f.name in target.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in dim_schema]
    )
    merged = D.scd1_upsert(target, D.customer_source(stg, 1), "customer_unique_id", "customer_key",
                           D.CUSTOMER_COLUMNS, "2024-01-02 00:00:00", start_key=42)
    keys = {r.customer_unique_id: (r.customer_key, r.merge_action) for r in merged.collect()}
    assert keys == {"u1": (42, "UPDATE"), "u3": (42 + 1, "INSERT")}


def _products(spark, rows):
    return _rows(spark, "products", [(pid, cat, 10, 100, 1, w, 1, 2, 3) for pid, cat, w in rows])


def _translation(spark, rows):
    return _rows(spark, "category_translation", rows)


def _apply(spark, history, stg, day, batch):
    start = history.agg(F.coalesce(F.max("product_key"), F.lit(0))).first()[0]
    # every hand-made staging row is in batch 1; ``batch`` only stamps the output
    src = D.product_source(stg, 1)
    changed = D.product_changes(history, stg, 1)
    return D.scd2_apply(history, src, changed, day, batch, start_key=start)


def test_scd2_versions(spark):
    empty = spark.createDataFrame([], schemas.DIM_PRODUCT)
    t1 = _translation(spark, [("brinquedos", "toys")])
    stg1 = _empty_stg(spark, products=_products(spark, [("p1", "brinquedos", 100), ("p2", "casa", 100)]),
                      category_translation=t1)
    h1 = spark.createDataFrame(_apply(spark, empty, stg1, "2024-01-01", 1).collect(), schemas.DIM_PRODUCT)
    assert h1.filter("is_current = 'Y'").count() == 2
    # weight-only change: no new version
    stg2 = _empty_stg(spark, products=_products(spark, [("p1", "brinquedos", 999)]), category_translation=t1)
    h2 = spark.createDataFrame(_apply(spark, h1, stg2, "2024-01-02", 2).collect(), schemas.DIM_PRODUCT)
    assert h2.count() == 2
    # p2's category gains a translation: old row closed the day before, new current row
    t3 = _translation(spark, [("casa", "housewares")])
    stg3 = _empty_stg(spark, products=_products(spark, [("p2", "casa", 100)]), category_translation=t3)
    h3 = spark.createDataFrame(_apply(spark, h2, stg3, "2024-01-03", 3).collect(), schemas.DIM_PRODUCT)
    p2 = sorted(h3.filter("product_id = 'p2'").collect(), key=lambda r: r.product_key)
    assert [(r.is_current, r.effective_to, r.category_name_en) for r in p2] == [
        ("N", dt.date(2024, 1, 2), "casa"), ("Y", None, "housewares")
    ]
    assert Q.scd2_interval_errors(h3).count() == 0
    # changed twice on one day: the interval check reports the empty interval
    t4 = _translation(spark, [("casa", "home")])
    stg4 = _empty_stg(spark, products=_products(spark, [("p2", "casa", 100)]), category_translation=t4)
    h4 = spark.createDataFrame(_apply(spark, h3, stg4, "2024-01-03", 4).collect(), schemas.DIM_PRODUCT)
    problems = Q.scd2_interval_errors(h4).collect()
    assert [p.problem for p in problems] == ["EFFECTIVE_TO before EFFECTIVE_FROM"]
    assert h4.filter("is_current = 'Y' AND product_id = 'p2'").first().category_group == "Home & Furniture"


def test_aggregate_product_versions_option(spark):
    from decimal import Decimal

    from vitrine.operators import aggregates as A

    dim_product = spark.createDataFrame(
        [(1, "p1", "toys", "N"), (2, "p1", "housewares", "Y")],
        "product_key bigint, product_id string, category_name_en string, is_current string",
    )
    items = spark.createDataFrame(
        [("o1", 1, Decimal("10.00"), Decimal("1.00")), ("o2", 2, Decimal("20.00"), Decimal("2.00"))],
        "order_id string, product_key bigint, price decimal(12,2), freight_value decimal(12,2)",
    )
    orders = spark.createDataFrame(
        [("o1", 7, 20240101, "boleto", "DELIVERED", 5, "N"), ("o2", 7, 20240102, "boleto", "DELIVERED", None, "Y")],
        "order_id string, customer_key bigint, order_date_key int, payment_type_primary string, order_status string, "
        "review_score int, is_late_delivery string",
    )
    customers = spark.createDataFrame([(7, "SP")], "customer_key bigint, state string")
    current = A.agg_daily_sales(orders, customers, items, dim_product).collect()
    assert [(r.date_key, r.category_en) for r in current] == [(20240102, "housewares")]  # item of the old version drops out
    everything = sorted(A.agg_daily_sales(orders, customers, items, dim_product, "all").collect(), key=lambda r: r.date_key)
    assert [(r.category_en, r.avg_review_score, r.late_delivery_count) for r in everything] == [
        ("toys", Decimal("5.00"), 0), ("housewares", None, 1)
    ]
