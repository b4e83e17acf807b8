"""Refresh by signed differences, and items that arrive early, on small hand-made tables."""

import pytest
from pyspark.sql import functions as F

from vitrine.operators import aggregates as A
from vitrine.operators import daily_delta as DD
from vitrine.operators import late_items as LI

ORDERS = (
    "order_id string, customer_key long, order_date_key int, payment_type_primary string, order_status string, "
    "review_score int, is_late_delivery string, etl_batch_id long"
)
ITEMS = "order_id string, order_item_id long, product_key long, price decimal(12,2), freight_value decimal(12,2), etl_batch_id long"


def star(spark, orders, items, states, categories):
    from decimal import Decimal as D

    rows = [(o, n, p, None if x is None else D(x), D("1.00"), b) for o, n, p, x, b in items]
    return DD.Star(
        spark.createDataFrame([(o, c, d, "boleto", "DELIVERED", r, "Y", b) for o, c, d, r, b in orders], ORDERS),
        spark.createDataFrame(states, "customer_key long, state string"),
        spark.createDataFrame(rows, ITEMS),
        spark.createDataFrame(categories, "product_key long, category_name_en string, is_current string"),
    )


BEFORE = dict(
    orders=[("a", 1, 20200101, 5, 1), ("b", 2, 20200101, None, 1), ("c", 3, 20200102, 1, 1)],
    items=[("a", 1, 7, "10.00", 1), ("a", 2, 8, None, 1), ("b", 1, 7, "3.00", 1), ("c", 1, 9, "4.00", 1)],
    states=[(1, "SP"), (2, "RJ"), (3, None)],
    categories=[(7, "toys", "Y"), (8, "toys", "Y"), (9, None, "Y")],
)


def refreshed(spark, versions="current", gone=(), **changes):
    before, after = star(spark, **BEFORE), star(spark, **{**BEFORE, **changes})
    changed = DD.changed_orders(before, after, since_batch=2)
    if gone:
        changed = changed.unionAll(spark.createDataFrame([(g,) for g in gone], "order_id string")).distinct()
    got = A.finish_daily(DD.apply_delta(before.state(versions), DD.signed_delta(before, after, changed, versions)))
    full = A.agg_daily_sales(after.orders, after.customers, after.items, after.products, versions)
    assert sorted(map(str, got.collect())) == sorted(map(str, full.collect()))
    return {r[0] for r in changed.collect()}, full


@pytest.mark.parametrize(
    "changes, touched",
    [
        ({}, set()),
        ({"orders": BEFORE["orders"] + [("d", 2, 20200103, 4, 2)], "items": BEFORE["items"] + [("d", 1, 9, "2.50", 2)]}, {"d"}),
        ({"items": [("a", 1, 7, "11.00", 2)] + BEFORE["items"][1:]}, {"a"}),
        ({"states": [(1, "SP"), (2, "MG"), (3, None)]}, {"b"}),
        ({"states": [(1, "SP"), (2, "RJ"), (3, "BA")]}, {"c"}),
        ({"categories": [(7, "garden", "Y"), (8, "toys", "Y"), (9, None, "Y")]}, {"a", "b"}),
        ({"categories": [(7, "toys", "N"), (8, "toys", "Y"), (9, None, "Y")]}, {"a", "b"}),
        ({"items": [("a", 1, 7, None, 2)] + BEFORE["items"][1:]}, {"a"}),
    ],
)
def test_delta_equals_full_refresh(spark, changes, touched):
    assert refreshed(spark, **changes)[0] == touched


def test_delta_takes_off_deleted_rows_named_by_the_caller(spark):
    _, full = refreshed(spark, gone=["c"], orders=BEFORE["orders"][:2], items=BEFORE["items"][:3])
    assert {r["date_key"] for r in full.collect()} == {20200101}


def test_delta_keeps_expired_versions_when_asked(spark):
    refreshed(spark, "all", categories=[(7, "garden", "N"), (8, "toys", "Y"), (9, None, "Y")])


def test_delta_of_another_state_raises(spark):
    before = star(spark, **BEFORE)
    nothing = star(spark, **{**BEFORE, "items": []})
    ids = before.orders.select("order_id")
    delta = DD.signed_delta(before, nothing, ids)
    with pytest.raises(Exception, match="does not hold"):
        DD.apply_delta(nothing.state(), delta).collect()


def test_delta_of_empty_tables(spark):
    none = star(spark, [], [], [], [])
    assert DD.apply_delta(none.state(), DD.signed_delta(none, none, none.orders)).count() == 0


# ------------------------------------------------------------------ late items

STAGED = "order_id string, order_item_id long, product_id string, seller_id string, price string, freight_value string, etl_batch_id long"


def tables(spark, orders, products, sellers):
    return (
        spark.createDataFrame([(o, 20200101, 1) for o in orders], "order_id string, order_date_key int, customer_key long"),
        spark.createDataFrame([(p, k, "Y") for k, p in enumerate(products)], "product_id string, product_key long, is_current string"),
        spark.createDataFrame([(s, k) for k, s in enumerate(sellers)], "seller_id string, seller_key long"),
    )


def staged(spark, rows):
    return spark.createDataFrame(rows, STAGED)


def outcomes(tried):
    return {(r["order_id"], r["order_item_id"]): (r["outcome"], r["reason"] is None) for r in tried.collect()}


def test_items_wait_and_load_once(spark):
    none = staged(spark, [])
    loaded = none.select(*LI.ITEM_KEY)
    first = staged(
        spark,
        [
            ("o1", 1, "p1", "s1", "5.00", "1.00", 1),  # loads
            ("o2", 1, "p1", "s1", "5.00", "1.00", 1),  # its order comes later
            ("o1", 2, "p2", "s1", "5.00", "1.00", 1),  # its product comes later
            ("o1", 3, "p1", "s9", "5.00", "1.00", 1),  # its seller never comes
            ("o1", 4, "p1", "s1", "99999999999", "1.00", 1),  # too large for its column
            ("o1", None, "p1", "s1", "5.00", "1.00", 1),
            (None, 1, "p1", "s1", "5.00", "1.00", 1),
            ("o3", 1, "p1", "s1", "5.00", "1.00", 1),
            ("o3", 1, "p1", "s1", "5.00", "1.00", 1),  # sent twice
        ],
    )
    one = LI.try_items(none, first, loaded, *tables(spark, ["o1"], ["p1"], ["s1"]), batch_id=1)
    got = outcomes(one)
    assert got[("o1", 1)] == ("loads", True)
    assert {k for k, v in got.items() if v[0] == "waits"} == {("o2", 1), ("o1", 2), ("o1", 3), ("o3", 1)}
    assert {k for k, v in got.items() if v[0] == "rejected"} == {("o1", 4), ("o1", None), (None, 1)}
    assert LI.balance(one, none, first, 1).first().asDict() == dict(
        batch_id=1, waited_before=0, staged=9, loads=1, waits=4, rejected=3, repeated=0, superseded=1, balanced=True
    )

    waiting = LI.still_waiting(one)
    loaded = one.where("outcome = 'loads'").select(*LI.ITEM_KEY)
    second = staged(spark, [("o1", 1, "p1", "s1", "6.00", "1.00", 2), ("o2", 1, "p1", "s1", "7.00", "1.00", 2)])
    two = LI.try_items(waiting, second, loaded, *tables(spark, ["o1", "o2", "o3"], ["p1", "p2"], ["s1"]), batch_id=2)
    got = outcomes(two)
    assert got == {
        ("o1", 1): ("repeated", True), ("o2", 1): ("loads", True), ("o1", 2): ("loads", True),
        ("o1", 3): ("waits", False), ("o3", 1): ("loads", True),
    }
    assert str(two.where("order_id = 'o2'").first()["price"]) == "7.00"  # the later sending counts
    balance = LI.balance(two, waiting, second, 2).first()
    assert balance["balanced"] and balance["superseded"] == 1 and balance["waits"] == 1

    # the batch runs again after its items were loaded: nothing is loaded twice
    loaded = loaded.unionByName(two.where("outcome = 'loads'").select(*LI.ITEM_KEY))
    again = LI.try_items(waiting, second, loaded, *tables(spark, ["o1", "o2", "o3"], ["p1", "p2"], ["s1"]), batch_id=2)
    assert again.where(F.col("outcome") == "loads").count() == 0


def test_no_items(spark):
    none = staged(spark, [])
    tried = LI.try_items(none, none, none.select(*LI.ITEM_KEY), *tables(spark, ["o"], ["p"], ["s"]), batch_id=1)
    assert tried.count() == 0
    assert LI.balance(tried, none, none, 1).first()["balanced"]


def test_pipeline_parks_items_until_their_order_comes(spark, tmp_root):
    from star_cases import SF_SMALL
    from vitrine.plans.pipeline import Pipeline, RunOptions
    from vitrine.sources import fixtures as FX

    stg = FX.staging(spark, SF_SMALL)
    early = F.coalesce(F.col("order_purchase_timestamp") < "1998", F.lit(False))

    def part(orders, items):
        return type(stg)(**{**stg.tables(), "orders": orders, "order_items": items})

    p = Pipeline(spark, tmp_root, RunOptions(as_of=FX.FIXTURE_AS_OF, late_items="park"))
    one = p.run_pipeline("TEST", staging=part(stg.orders.where(early), stg.order_items))
    waited = p.wh.current("stg_items_waiting").count()
    assert waited > 0
    two = p.run_pipeline("TEST", staging=part(stg.orders.where(~early), stg.order_items.limit(0)))
    whole = Pipeline(spark, tmp_root + "-whole", RunOptions(as_of=FX.FIXTURE_AS_OF))
    whole.run_pipeline("TEST", staging=stg)

    keys = ["order_id", "order_item_id", "price", "freight_value", "order_date_key"]
    got, want = (sorted(map(str, x.wh.read("fact_order_items").select(*keys).collect())) for x in (p, whole))
    assert got == want
    loaded_later = p.wh.read("fact_order_items").where(F.col("etl_batch_id") == two).count()
    assert loaded_later == waited - p.wh.current("stg_items_waiting").count() > 0

    p.rerun_batch(one)
    assert sorted(map(str, p.wh.read("fact_order_items").select(*keys).collect())) == want


def exchanges(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_an_order_deals_the_tried_items_once(spark):
    """Grouping, the keys seen before and the order join share one exchange of the items."""
    sent = spark.range(40).select(
        F.concat(F.lit("o"), F.col("id") % 7).alias("order_id"), F.col("id").alias("order_item_id"), F.lit("p").alias("product_id"),
        F.lit("s").alias("seller_id"), F.lit("1.00").alias("price"), F.lit("2.00").alias("freight_value"),
        F.lit(1).cast("long").alias("etl_batch_id"),
    )
    rows = LI.latest_sent(sent, sent.unionAll(sent), sent.where("order_item_id < 5"))
    assert "Exchange hashpartitioning(order_id" in exchanges(rows) and "order_item_id#" not in "".join(
        x.split(",")[1] for x in exchanges(rows).split("hashpartitioning(order_id")[1:2]
    )
    got = rows.agg(F.count("*"), F.sum("n_sent"), F.count_if("seen")).first()
    assert tuple(got) == (40, 120, 5)


def test_items_with_a_null_key_stay_apart_and_seen_ones_are_named(spark):
    ddl = "order_id string, order_item_id long, product_id string, seller_id string, price string, freight_value string, etl_batch_id long"
    rows = [(None, 1, "p", "s", "1", "1", 1), (None, 1, "p", "s", "1", "1", 1), ("o", None, "p", "s", "1", "1", 1), ("o", 1, "p", "s", "1", "1", 1)]
    sent = spark.createDataFrame(rows, ddl)
    loaded = spark.createDataFrame([("o", 1), ("o", 1), ("o", 2), (None, 1)], "order_id string, order_item_id int")
    got = LI.latest_sent(sent.limit(0), sent, loaded).collect()
    assert sorted((str(r.order_id), str(r.order_item_id), r.n_sent, r.seen) for r in got) == [
        ("None", "1", 1, False), ("None", "1", 1, False), ("o", "1", 1, True), ("o", "None", 1, False),
    ]
