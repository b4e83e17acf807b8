"""CSV feed ingest: permissive parsing, reject split, error limit, batch partitions."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from vitrine.plans.warehouse import Warehouse
from vitrine.sources import ingest as I
from vitrine.sources.feeds import FEEDS

ORDERS_CSV = (
    "order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,"
    "order_delivered_carrier_date,order_delivered_customer_date,order_estimated_delivery_date\n"
    "o1,c1,delivered,2018-01-01 10:00:00,,,,2018-01-20 00:00:00\n"
    '"o2","c""1","delivered","2018-01-02 10:00:00","","","",""\n'
    "o3,c1\n"
    "o4,c1,shipped,2018-01-04 10:00:00,,,,,EXTRA,FIELDS\n"
    + "x" * 51 + ",c1,delivered,2018-01-05 10:00:00,,,,\n"
)
REVIEWS_CSV = (
    "review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,"
    "review_answer_timestamp\n"
    'r1,o1,5,,"great\nproduct, ""really""",2018-01-03 00:00:00,2018-01-04 10:00:00\n'
    "r2,o1,five,,,2018-01-03 00:00:00,\n"
)


def _write(dirname, name, text):
    with open(os.path.join(dirname, name), "w") as f:
        f.write(text)


def test_orders_feed_edge_cases(spark, tmp_root):
    wh = Warehouse(spark, tmp_root)
    d = tempfile.mkdtemp(prefix="feeds-")
    _write(d, "orders.csv", ORDERS_CSV)
    loaded, rejected = I.ingest_feed(wh, FEEDS["orders"], f"{d}/orders.csv", 7, "2024-01-01 00:00:00")
    assert (loaded, rejected) == (4, 1)
    rows = {r.order_id: r for r in spark.read.parquet(wh.path("stg_orders")).collect()}
    assert rows["o2"].customer_id == 'c"1' and rows["o2"].order_approved_at is None  # doubled quote, ""
    assert rows["o3"].order_status is None  # short row padded with NULL
    assert rows["o4"].order_estimated_delivery_date is None  # extra fields dropped
    assert all(r.etl_batch_id == 7 and r.etl_source_file == "orders.csv" for r in rows.values())
    rej = wh.read("stg_rejected_records").collect()
    assert [(r.source_table, r.reject_reason) for r in rej] == [("STG_ORDERS", "Value too long for ORDER_ID")]
    assert rej[0].raw_data.startswith("x" * 51 + ",c1,delivered")
    # re-ingesting the same batch replaces its partition (no duplicates); another batch is kept
    I.ingest_feed(wh, FEEDS["orders"], f"{d}/orders.csv", 7, "2024-01-01 00:00:00")
    I.ingest_feed(wh, FEEDS["orders"], f"{d}/orders.csv", 8, "2024-01-02 00:00:00")
    counts = {r[0]: r[1] for r in spark.read.parquet(wh.path("stg_orders")).groupBy("etl_batch_id").count().collect()}
    assert counts == {7: 4, 8: 4}


def test_reviews_multiline_and_bad_number(spark, tmp_root):
    wh = Warehouse(spark, tmp_root)
    d = tempfile.mkdtemp(prefix="feeds-")
    _write(d, "reviews.csv", REVIEWS_CSV)
    loaded, rejected = I.ingest_feed(wh, FEEDS["order_reviews"], f"{d}/reviews.csv", 1, "2024-01-01 00:00:00")
    assert (loaded, rejected) == (1, 1)
    r1 = spark.read.parquet(wh.path("stg_order_reviews")).first()
    assert r1.review_comment_message == 'great\nproduct, "really"' and r1.review_score == 5
    assert wh.read("stg_rejected_records").first().reject_reason == "Invalid number in REVIEW_SCORE"


def test_error_limit(spark, tmp_root):
    wh = Warehouse(spark, tmp_root)
    d = tempfile.mkdtemp(prefix="feeds-")
    _write(d, "orders.csv", ORDERS_CSV)
    with pytest.raises(I.TooManyRejects):
        I.ingest_feed(wh, FEEDS["orders"], f"{d}/orders.csv", 1, "2024-01-01 00:00:00", error_limit=0)
    assert not wh.fs.exists(wh.path("stg_orders"))  # nothing published


def test_staged_frames_have_no_blank_text_and_an_empty_feed_clears_its_batch(spark, tmp_root):
    from vitrine.sources.feeds import Staging

    wh = Warehouse(spark, tmp_root)
    empty = {n: spark.createDataFrame([], f.staging_schema()) for n, f in FEEDS.items()}
    orders = spark.createDataFrame([("o1", "", "delivered", "", None, None, None, None)], FEEDS["orders"].csv_schema())
    orders = orders.selectExpr("*", "0L as etl_batch_id", "current_timestamp() as etl_insert_dt", "'x' as etl_source_file")
    assert I.stage_batch(wh, Staging(**{**empty, "orders": orders}), 4)["orders"] == 1
    row = I.read_staging(wh, 4).orders.first()
    assert row.customer_id is None and row.order_purchase_timestamp is None and row.etl_batch_id == 4
    d = tempfile.mkdtemp(prefix="feeds-")
    _write(d, "orders.csv", ORDERS_CSV.split("\n")[0] + "\n")  # a header and nothing else
    assert I.ingest_feed(wh, FEEDS["orders"], f"{d}/orders.csv", 4, "2024-01-01 00:00:00") == (0, 0)
    assert I.read_staging(wh, 4).orders.count() == 0


def test_tag_staging_batch(spark):
    df = spark.createDataFrame([(0,), (3,)], "etl_batch_id long")
    assert [r[0] for r in I.tag_staging_batch(df, 9).collect()] == [9, 3]


def test_translation_feed_comes_from_the_products(spark):
    from vitrine.plans.catalog import translations_found

    translation = spark.createDataFrame([("a", "x"), ("b", "y")], "product_category_name string, english string")
    products = spark.createDataFrame([("b",), ("b",), ("c",), (None,)], "product_category_name string")
    assert [tuple(r) for r in translations_found(translation, products).collect()] == [("b", "y")]


@pytest.mark.parametrize("loads", [True, False])
def test_a_filtered_feed_parses_each_record_once(spark, tmp_path, loads):
    path = str(tmp_path / "items.csv")
    header = "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\n"
    good, endings, long_id, number = "a,1,p,s,d,1,2", "b,1,p,s,d,1,2\r", "c" * 51 + ",1,p,s,d,1,2", "d,x,p,s,d,1,2"
    open(path, "w", newline="").write(header + "\n".join([good, endings, long_id, number]) + "\n")
    tagged = I.tag_rows(I.read_feed_text(spark, FEEDS["order_items"], path), FEEDS["order_items"], 1, "2024-06-30 00:00:00")
    why = F.col("_reject_reason")
    rows = tagged.where(why.isNull() if loads else why.isNotNull())
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("from_csv(") == 1
    got = {(r["order_id"][0], r["freight_value"], r["_reject_reason"]) for r in rows.collect()}
    accepted = {("a", "2", None), ("b", "2", None)}
    rejected = {("c", "2", "Value too long for ORDER_ID"), ("d", "2", "Invalid number in ORDER_ITEM_ID")}
    assert got == (accepted if loads else rejected)
