"""Column functions and single-job semantics on hand-made rows."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from vitrine.functions import columns as C
from vitrine.operators import facts as FT
from vitrine.operators import quality as Q
from vitrine.sources.feeds import FEEDS, Staging


def _one_col(spark, values, typ="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {typ}")


def test_state_name_and_region(spark):
    df = _one_col(spark, [None, "sp", "XX", "DF"])
    got = df.select(C.state_name("x").alias("n"), C.region("x").alias("r")).collect()
    assert [(r.n, r.r) for r in got] == [
        ("Unknown", "Unknown"), ("Sao Paulo", "Southeast"), ("Unknown", "Unknown"), ("Distrito Federal", "Central-West")
    ]


def test_to_date_key(spark):
    df = _one_col(spark, ["2018-1-5", "2018-13-01", None, "", "2017-10-02 10:56:33"])
    got = [r[0] for r in df.select(C.to_date_key("x")).collect()]
    assert got == [20180105, None, None, None, 20171002]


def test_initcap_words(spark):
    df = _one_col(spark, ["santa barbara d'oeste", "mogi-guacu", "SAO PAULO", None, "3rd avenue"])
    got = [r[0] for r in df.select(C.initcap_words("x")).collect()]
    assert got == ["Santa Barbara D'Oeste", "Mogi-Guacu", "Sao Paulo", None, "3rd Avenue"]


def test_text_concat_null_as_empty(spark):
    df = spark.createDataFrame([("o1", None)], "a string, b long")
    assert df.select(C.text_concat("a", F.lit("-"), "b")).first()[0] == "o1-"


def test_parse_amount_and_coord(spark):
    df = _one_col(spark, ["1,5", "x", "12.30", None, "-3"])
    got = [r[0] for r in df.select(C.parse_amount("x")).collect()]
    assert got == [None, None, Decimal("12.3000"), None, Decimal("-3.0000")]
    c = _one_col(spark, ["-23,5", "-23.5", "abc"]).select(C.parse_coord("x")).collect()
    assert [r[0] for r in c] == [Decimal("-23.5"), Decimal("-23.5"), None]


def test_round_ratio_exact_half_up(spark):
    rows = [(1, 8, 1), (-1, 8, 1), (107, 40, 2), (7, 2000, 3), (5, 0, 2)]
    df = spark.createDataFrame(rows, "n long, d long, k int")
    got = [
        df.filter(F.col("k") == k).select(C.round_ratio("n", "d", k)).collect() for k in (1, 2, 3)
    ]
    assert [r[0] for r in got[0]] == [Decimal("0.1"), Decimal("-0.1")]  # 0.125 -> 0.1
    assert [r[0] for r in got[1]] == [Decimal("2.68"), None]  # 2.675 -> 2.68 ; den 0 -> NULL
    assert [r[0] for r in got[2]] == [Decimal("0.004")]  # 0.0035 -> 0.004


def test_category_group_first_match(spark):
    df = _one_col(spark, ["fashion_bags", "home_electronics", "bed_bath_table", "baby", None, "cool_stuff"])
    got = [r[0] for r in df.select(C.category_group("x")).collect()]
    assert got == ["Fashion & Apparel", "Electronics", "Home & Furniture", "Toys & Baby", "Other", "Other"]


def _empty_stg(spark, **tables):
    t = {}
    for name, feed in FEEDS.items():
        t[name] = tables.get(name) or spark.createDataFrame([], feed.staging_schema())
    return Staging(**t)


def _rows(spark, name, rows):
    schema = FEEDS[name].staging_schema()
    full = [tuple(r) + (1, dt.datetime(2024, 1, 1), "f.csv") for r in rows]
    return spark.createDataFrame(full, schema)


def test_primary_payment_type_ties_and_nulls(spark):
    pays = _rows(spark, "order_payments", [
        ("o1", 1, "boleto", 1, "5.00"), ("o1", 2, "voucher", 1, "5.00"),
        ("o2", 1, "credit_card", 3, "100.00"), ("o2", 2, "voucher", 1, "x"),
        ("o3", 1, "boleto", 2, "1.00"), ("o3", 2, "boleto", 4, "2.00"), ("o3", 3, "voucher", 1, "2.50"),
    ])
    stg = _empty_stg(spark, order_payments=pays)
    got = {r.order_id: r for r in FT.payments_rollup(stg, 1).collect()}
    assert got["o1"].primary_payment_type == "voucher"  # tie -> greater name
    assert got["o2"].primary_payment_type == "voucher"  # a NULL sum ranks first
    assert got["o3"].primary_payment_type == "boleto" and got["o3"].num_methods == 2
    assert got["o3"].max_installments == 4 and got["o3"].total_payment == Decimal("5.5000")


def test_dq_rules(spark):
    orders = _rows(spark, "orders", [
        (None, "c1", "delivered", "2018-01-01 00:00:00", None, None, None, None),
        ("o2", "c1", "weird", "2018-01-01 00:00:00", None, None, None, None),
        ("o3", "c1", None, "2018-13-01 00:00:00", None, None, None, None),
    ])
    items = _rows(spark, "order_items", [
        ("o1", None, "p", "s", None, "-1.00", "0.00"), ("o1", 2, "p", "s", None, "1,5", "0.00"),
    ])
    reviews = _rows(spark, "order_reviews", [
        ("r1", "o1", None, None, None, "2018-01-01", None), ("r2", "o1", 7, None, None, "2018-01-01", None),
    ])
    stg = _empty_stg(spark, orders=orders, order_items=items, order_reviews=reviews)
    got = sorted((r.source_table, r.source_key, r.reject_reason) for r in Q.validate_staging(stg, 1).collect())
    assert got == [
        ("STG_ORDERS", "NULL", "NULL ORDER_ID"),
        ("STG_ORDERS", "o2", "Invalid ORDER_STATUS"),
        ("STG_ORDERS", "o3", "Invalid date"),
        ("STG_ORDER_ITEMS", "o1-", "Negative price/freight"),
        ("STG_ORDER_ITEMS", "o1-2", "Non-numeric amount"),
        ("STG_ORDER_REVIEWS", "r2", "Score not 1-5"),
    ]
    # a NULL score is neither rejected nor loaded
    assert [r.review_id for r in FT.fact_reviews(stg, 1).collect()] == []


def test_strict_mode_drops_rejected_keys(spark):
    orders = _rows(spark, "orders", [
        ("o1", "c1", "delivered", "2018-01-01 00:00:00", None, None, None, None),
        ("o2", "c1", "weird", "2018-01-01 00:00:00", None, None, None, None),
    ])
    stg = _empty_stg(spark, orders=orders)
    rejects = Q.validate_staging(stg, 1)
    kept = Q.without_rejects(stg.orders, rejects, "STG_ORDERS", F.col("order_id"))
    assert [r.order_id for r in kept.collect()] == ["o1"]
