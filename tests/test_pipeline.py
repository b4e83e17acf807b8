"""End-to-end pipeline runs on the smallest test tables."""

from pyspark.sql import functions as F

from vitrine.functions import lookups as L

from star_cases import SF_SMALL
from vitrine.plans.pipeline import Pipeline, RunOptions
from vitrine.sources import fixtures as FX


def _key(row):
    return tuple(repr(x) for x in row)


def _snapshot(p: Pipeline):
    wh = p.wh
    return {
        "dim_customer": wh.current("dim_customer").drop("etl_update_dt", "etl_insert_dt").collect(),
        "dim_product": wh.current("dim_product").drop("etl_insert_dt").collect(),
        "dim_seller": wh.current("dim_seller").drop("etl_update_dt", "etl_insert_dt").collect(),
        "fact_orders": wh.read("fact_orders").collect(),
        "fact_order_items": wh.read("fact_order_items").collect(),
        "fact_reviews": wh.read("fact_reviews").collect(),
        "agg": wh.current("agg_daily_sales").drop("etl_batch_id").collect(),
    }


def test_full_run_rerun_and_reports(spark, tmp_root):
    p = Pipeline(spark, tmp_root, RunOptions(as_of=FX.FIXTURE_AS_OF))
    stg = FX.staging(spark, SF_SMALL)
    b = p.run_pipeline("TEST", staging=stg)
    assert b == 1
    first = _snapshot(p)
    n_orders = stg.orders.count()
    assert 0 < len(first["fact_orders"]) <= n_orders
    people = stg.customers.select("customer_unique_id").where("customer_unique_id is not null").distinct()
    assert len(first["dim_customer"]) == people.count()
    # one current row per product, keys unique
    dp = p.wh.current("dim_product")
    assert dp.filter("is_current = 'Y'").groupBy("product_id").count().filter("count > 1").count() == 0
    assert dp.select("product_key").distinct().count() == dp.count()

    # in = out + rejected for every fact, and the rejected rows are in the reject table with their reason
    rej = p.wh.read("stg_rejected_records")
    for step in ("LOAD_FACT_ORDERS", "LOAD_FACT_ORDER_ITEMS", "LOAD_FACT_REVIEWS"):
        s = p.log.steps().filter(F.col("step_name") == step).first()
        assert s["records_in"] == s["records_out"] + s["records_rejected"] and s["records_rejected"] > 0, step
    assert rej.filter(F.col("reject_reason") == L.REJECT_NO_CUSTOMER).count() > 0
    assert rej.select("reject_id").distinct().count() == rej.count()
    for reason in (L.REJECT_NULL_CUSTOMER, L.REJECT_NULL_SELLER, L.REJECT_NO_ORDER, L.REJECT_AMOUNT_RANGE):
        assert rej.filter(F.col("reject_reason") == reason).count() > 0, reason

    # the logged counts of every step are the ones the registered query derives
    from vitrine.plans.catalog import queries

    expected = {
        r.step_name: (r.records_in, r.records_out, r.records_rejected)
        for r in queries()["step_counts"](spark, SF_SMALL).collect()
    }
    logged = {
        r.step_name: (r.records_in, r.records_out, r.records_rejected)
        for r in p.log.steps().filter(f"batch_id = {b} AND attempt = 1").collect()
    }
    assert logged == expected

    # re-run the same batch: identical tables, new attempt logged
    p.rerun_batch(b)
    second = _snapshot(p)
    for k in first:
        assert sorted(map(_key, first[k])) == sorted(map(_key, second[k])), k
    told = {
        k: sorted(map(_key, rej.filter(F.col("attempt") == k).select("source_table", "source_key", "reject_reason").collect()))
        for rej in [p.wh.read("stg_rejected_records")] for k in (1, 2)
    }
    assert told[1] == told[2]  # a re-run rejects the same rows, told apart by the attempt
    batch = p.log.batch(b)
    assert batch["status"] == "SUCCESS" and batch["attempt"] == 2
    # totals are those of the latest attempt only
    steps = p.log.steps().filter(f"batch_id = {b} AND attempt = 2")
    assert steps.count() == 8
    assert batch["rejected_records"] == steps.agg(F.sum("records_rejected")).first()[0]

    # hourly refresh gets its own batch; reports read the log
    hb = p.refresh_hourly("TEST")
    assert hb == 2
    again = p.wh.current("agg_daily_sales").drop("etl_batch_id").collect()
    assert sorted(map(_key, again)) == sorted(map(_key, first["agg"]))
    with p.log.step(b, "LOAD_FACT_ORDERS", 3):  # an old batch loads again after the refresh
        pass
    assert p._changed_since(hb, 9) == b
    hist = p.run_history().collect()
    assert [r["batch_id"] for r in hist][:2] == [2, 1]
    health = p.health_check().collect()
    assert all(r["duration_mins"] != "RUNNING" for r in health)
    detail = p.step_detail(b).collect()
    assert detail[0]["step_name"] == "TAG_STAGING_BATCH"
    # watermarks were seeded for all nine feeds and moved for loaded ones
    wm = {r["entity_name"]: r for r in p.log.watermarks().collect()}
    assert len(wm) == 9 and wm["ORDERS"]["last_batch_id"] == b and wm["GEOLOCATION"]["last_batch_id"] is None
    assert p.log.get_watermark(L.WATERMARK_SOURCE, "NOPE").year == 2015


def _with(stg, **tables):
    return type(stg)(**{**stg.tables(), **tables})


def test_strict_rerun_loads_an_order_whose_customer_came_later(spark, tmp_root):
    stg = FX.staging(spark, SF_SMALL)
    late = stg.orders.filter("order_id is not null and order_status <> 'bogus'").filter(
        F.substring("order_purchase_timestamp", 1, 7) != "1998-13"
    ).first()
    p = Pipeline(spark, tmp_root, RunOptions(as_of=FX.FIXTURE_AS_OF, strict=True))
    b = p.run_pipeline("TEST", staging=_with(stg, customers=stg.customers.filter(F.col("customer_id") != late.customer_id)))
    assert p.wh.read("fact_orders").filter(F.col("order_id") == late.order_id).count() == 0
    from vitrine.sources import ingest as I

    kept = stg.customers.withColumn("customer_unique_id", F.concat(F.lit("p"), F.col("customer_id")))
    I.write_staging(p.wh, "customers", kept, b)
    p.rerun_batch(b)
    assert p.wh.read("fact_orders").filter(F.col("order_id") == late.order_id).count() == 1
    assert p.wh.read("fact_orders").filter("order_id is null or order_status = 'BOGUS'").count() == 0


def test_batch_zero_staging_empty_feed_and_reports(spark, tmp_root):
    from vitrine.sources import ingest as I

    p = Pipeline(spark, tmp_root, RunOptions(as_of=FX.FIXTURE_AS_OF))
    stg = FX.staging(spark, SF_SMALL)
    I.stage_batch(p.wh, _with(stg, order_reviews=stg.order_reviews.limit(0)), 0)  # an outside loader's rows
    b = p.run_pipeline("TEST")
    assert p.log.batch(b)["status"] == "SUCCESS"
    assert p.wh.read("fact_orders").count() > 0 and p.wh.read("fact_reviews").count() == 0
    assert not p.wh.fs.exists(f"{tmp_root}/stg_orders/etl_batch_id=0")
    assert p.top_categories().count() == 10
    assert p.late_rate_by_state().count() > 0
    # the test orders lie before the calendar, which the constraint check reports
    assert p.monthly_revenue().count() == 0
    assert {r.constraint_name for r in p.constraint_errors().collect()} == {"FACT_ORD_DATE_FK"}
    assert p.wh.current("dim_date").count() == 5844
    p.refresh_hourly("TEST")
    assert p.prune(1)["agg_daily_sales"] and len(p.wh.versions("agg_daily_sales")) == 1


def test_two_runs_at_once_get_their_own_ids_and_versions(spark, tmp_root):
    a, b = (Pipeline(spark, tmp_root, RunOptions(as_of=FX.FIXTURE_AS_OF)) for _ in range(2))
    assert a.wh.claim_id("batch", 0) == 1 and b.wh.claim_id("batch", 0) == 2  # both saw an empty log
    x = a.wh.claim_id("version-t", 0)
    assert b.wh.publish("t", spark.range(2)) == 2  # the other run, between claim and write
    spark.range(5).write.parquet(f"{tmp_root}/t/v={x:06d}")
    assert a.wh.versions("t") == [1, 2] and a.wh.current("t").count() == 2


def test_rerun_without_staging_fails(spark, tmp_root):
    import pytest

    p = Pipeline(spark, tmp_root, RunOptions(as_of=FX.FIXTURE_AS_OF))
    with pytest.raises(KeyError):
        p.rerun_batch(42)


def test_second_batch_keeps_keys_and_versions(spark, tmp_root):
    """Batch 2 (larger extract, overlapping ids): existing keys never change, new keys follow."""
    p = Pipeline(spark, tmp_root, RunOptions(as_of=FX.FIXTURE_AS_OF))
    p.run_pipeline("TEST", staging=FX.staging(spark, SF_SMALL))
    cust1 = {r.customer_unique_id: r.customer_key for r in p.wh.current("dim_customer").collect()}
    prod1 = {r.product_key: r for r in p.wh.current("dim_product").collect()}
    orders1 = p.wh.read("fact_orders").count()

    p2 = Pipeline(spark, tmp_root, RunOptions(as_of="2024-07-01"))
    b2 = p2.run_pipeline("TEST", staging=FX.staging(spark, "/root/testdata/sf0.01"))
    cust2 = {r.customer_unique_id: r.customer_key for r in p2.wh.current("dim_customer").collect()}
    assert all(cust2[u] == k for u, k in cust1.items())  # stable keys
    new_keys = sorted(k for u, k in cust2.items() if u not in cust1)
    assert new_keys == list(range(max(cust1.values()) + 1, max(cust1.values()) + 1 + len(new_keys)))  # dense
    dp = p2.wh.current("dim_product")
    # every earlier version is still there (possibly closed), one current row per product
    assert set(prod1) <= {r.product_key for r in dp.collect()}
    assert dp.filter("is_current = 'Y'").groupBy("product_id").count().filter("count > 1").count() == 0
    from vitrine.operators.quality import scd2_interval_errors

    assert scd2_interval_errors(dp).count() == 0
    # the aggregate, refreshed for the touched days, is the one computed in full
    from vitrine.operators.aggregates import agg_daily_sales

    full = agg_daily_sales(
        p2.wh.read("fact_orders"), p2.wh.current("dim_customer"), p2.wh.read("fact_order_items"), dp
    )
    kept = p2.wh.current("agg_daily_sales").select(*full.columns)
    assert kept.exceptAll(full).count() == 0 and full.exceptAll(kept).count() == 0
    # facts: batch 2 adds only orders not loaded before
    fo = p2.wh.read("fact_orders")
    assert fo.groupBy("order_id").count().filter("count > 1").count() == 0
    assert fo.filter(f"etl_batch_id = {b2}").count() == fo.count() - orders1
