"""Constraints at load, fact keys, bucket-scoped upserts and timelines of batches out of order."""

import itertools
import os
import time
from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from star_cases import SF_SMALL

from vitrine.operators import constraints as K
from vitrine.operators import dimensions as D
from vitrine.operators import quality as Q
from vitrine.operators.keys import key_bucket, keys_by_file
from vitrine.plans.buckets import BucketedDimension
from vitrine.plans.pipeline import Pipeline, RunOptions
from vitrine.sources import fixtures as FX


def test_gate_names_the_first_rule_that_breaks(spark):
    rows = spark.createDataFrame(
        [("a", 1, 10), ("a", 1, 11), ("b", 1, 10), ("c", 1, 99), (None, 1, 10), ("d", 2, None), ("a", None, 10)], "k string, n int, p int"
    )
    parent = spark.createDataFrame([(10, "x"), (11, "x"), (11, "y"), (12, "z")], "id int, p string")
    rules = [
        K.Required("NN", ("k",)),
        K.Unique("UK", ("k", "n")),
        K.Parent("FK", ("p",), parent, ("id",)),
    ]
    got = {(r.k, r.n, r.p): r.violation for r in K.gate(rows, rules).collect()}
    assert got == {
        ("a", 1, 10): "UK", ("a", 1, 11): "UK", ("b", 1, 10): None, ("c", 1, 99): "FK", (None, 1, 10): "NN",
        ("d", 2, None): None, ("a", None, 10): None,
    }
    assert K.gate(rows, []).where("violation IS NULL").count() == 7
    assert K.gate(rows.limit(0), rules).collect() == []


def test_keys_by_file_are_dense_and_repeatable(spark, tmp_root):
    path = f"{tmp_root}/rows"
    spark.range(1000).repartition(7).write.parquet(path)
    keyed = keys_by_file(spark, path, "id long", "k", start=50)
    first = sorted(map(tuple, keyed.collect()))
    assert sorted(k for _, k in first) == list(range(51, 1051)) and sorted(map(tuple, keyed.collect())) == first
    plan = keyed._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan  # the rows themselves are not exchanged


def _double_orders(spark, batch_id=0):
    stg = FX.staging(spark, SF_SMALL)
    return replace(stg, orders=stg.orders.unionByName(stg.orders.filter(F.col("order_status") == "processing")))


def test_repeated_orders_and_their_items_never_reach_a_fact(spark, tmp_root):
    p = Pipeline(spark, tmp_root, RunOptions(as_of=FX.FIXTURE_AS_OF))
    p.run_pipeline("TEST", staging=_double_orders(spark))
    orders, items = p.wh.read("fact_orders"), p.wh.read("fact_order_items")
    assert orders.where("order_status = 'PROCESSING'").count() == 0 and orders.count() > 0
    assert items.join(orders, "order_id", "left_anti").count() == 0
    reasons = {r[0]: r[1] for r in p.wh.read("stg_rejected_records").groupBy("reject_reason").count().collect()}
    assert reasons["Constraint FACT_ORDERS_UK"] > 0 and reasons["Constraint FACT_ITEM_ORDER_FK"] > 0
    for rows, key in ((orders, "order_fact_key"), (items, "item_fact_key"), (p.wh.read("fact_reviews"), "review_fact_key")):
        n, low, high, distinct = rows.agg(F.count("*"), F.min(key), F.max(key), F.countDistinct(key)).first()
        assert (low, high, distinct) == (1, n, n)
        assert rows.where("etl_insert_dt IS NULL").count() == 0
    errors = {r.constraint_name for r in p.constraint_errors().collect()}
    assert not errors & {"FACT_ORDERS", "FACT_ORDER_ITEMS", "FACT_ORD_CUST_FK", "FACT_ITEM_PROD_FK", "FACT_ITEM_SELL_FK"}
    # a second batch continues the keys
    before = orders.count()
    p.run_pipeline("TEST", staging=FX.staging(spark, SF_SMALL))
    late = p.wh.read("fact_orders").where("etl_batch_id = 2")
    n = late.count()
    assert n > 0 and sorted(r[0] for r in late.select("order_fact_key").collect()) == list(range(before + 1, before + n + 1))


def test_policy_fail_publishes_nothing_of_the_step(spark, tmp_root):
    p = Pipeline(spark, tmp_root, RunOptions(as_of=FX.FIXTURE_AS_OF, constraints="fail"))
    with pytest.raises(K.ConstraintViolation):
        p.run_pipeline("TEST", staging=_double_orders(spark))
    assert p.wh.read("fact_orders").count() == 0
    assert p.wh.read("stg_rejected_records").where("reject_reason = 'Constraint FACT_ORDERS_UK'").count() > 0
    assert p.run_history().first()["status"] == "FAILED"


def test_days_outside_the_calendar_are_rejected_when_asked(spark, tmp_root):
    p = Pipeline(spark, tmp_root, RunOptions(as_of=FX.FIXTURE_AS_OF, enforce_calendar=True))
    p.run_pipeline("TEST", staging=FX.staging(spark, SF_SMALL))  # the test orders are older than the calendar
    assert p.wh.read("fact_orders").count() == 0 and p.wh.read("fact_order_items").count() == 0
    assert p.wh.read("stg_rejected_records").where("reject_reason = 'Constraint FACT_ORD_DATE_FK'").count() > 0


COLUMNS = ["dim_key", "id", "city", "is_active", "etl_batch_id", "etl_insert_dt", "etl_update_dt"]


def _files(path):
    return {
        os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
        for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")
    }


def test_bucketed_upsert_rewrites_only_the_batch_s_buckets(spark, tmp_root):
    def rows(ids, city, batch):
        return spark.createDataFrame([(f"c{i}", city) for i in ids], "id string, city string").withColumn(
            "etl_batch_id", F.lit(batch).cast("long")
        )

    target = spark.createDataFrame(
        [(i + 1, f"c{i}", "Old", "Y", 0, None, None) for i in range(200)],
        "dim_key long, id string, city string, is_active string, etl_batch_id long, etl_insert_dt timestamp, etl_update_dt timestamp",
    )
    stored = BucketedDimension(spark, f"{tmp_root}/dim", "id", "dim_key", COLUMNS, 16)
    stored.create(target)
    source = rows([3, 5, 500, 501], "New", 1)
    before = _files(stored.path)
    touched = stored.upsert(source, "2024-01-01 00:00:00")
    after = _files(stored.path)
    kept = {f for f in before if int(f.split("bucket=")[1].split("/")[0]) not in touched}
    assert touched == sorted({r[0] for r in source.select(key_bucket(F.col("id"), 16)).collect()}) and 0 < len(touched) < 16
    assert kept and all(after.get(f) == before[f] for f in kept)
    whole = D.scd1_upsert(target, source, "id", "dim_key", COLUMNS, "2024-01-01 00:00:00", start_key=200).drop("merge_action")
    columns = [c for c in COLUMNS if c != "dim_key"]
    want = sorted(map(str, whole.select(*columns).collect()))
    assert sorted(map(str, stored.read().select(*columns).collect())) == want
    keys = [r[0] for r in stored.read().select("dim_key").collect()]
    assert sorted(keys) == list(range(1, 203))
    stored.upsert(source, "2024-01-01 00:00:00")  # again: the same rows, no further keys
    assert stored.read().count() == 202 and stored.upsert(source.limit(0), "2024-01-02 00:00:00") == []


def test_a_timeline_does_not_depend_on_the_order_of_the_batches(spark):
    def batch(day, **names):
        rows = [(p, n, day) for p, n in names.items()]
        return spark.createDataFrame(rows, "product_id string, category_name_en string, d string").selectExpr(
            "product_id", "category_name_en", "date(d) AS seen_on"
        )

    batches = [
        batch("2024-01-01", a="x", b="x", c=None), batch("2024-01-05", a="y", b="x"),
        batch("2024-01-09", a="x", b=None, c=None, d="n"), batch("2024-01-12", a="x", d="n"),
    ]
    want = {
        ("a", "x", "2024-01-01", "2024-01-04", "N"), ("a", "y", "2024-01-05", "2024-01-08", "N"),
        ("a", "x", "2024-01-09", "None", "Y"), ("b", "x", "2024-01-01", "2024-01-08", "N"),
        ("b", None, "2024-01-09", "None", "Y"), ("c", None, "2024-01-01", "None", "Y"), ("d", "n", "2024-01-09", "None", "Y"),
    }
    for order in list(itertools.permutations(range(4)))[::11]:
        said = batches[order[0]]
        timeline = D.product_timeline(said)
        for i in [*order[1:], order[0]]:
            said = D.merge_sightings(said, batches[i])
            timeline = D.refresh_timeline(timeline, said, batches[i])
        got = timeline.select("product_id", "category_name_en", "effective_from", "effective_to", "is_current").collect()
        assert {(r[0], r[1], str(r[2]), str(r[3]), r[4]) for r in got} == want and len(got) == len(want)
    history = timeline.withColumn("product_key", F.lit(0))
    assert Q.scd2_interval_errors(history).count() == 0


def test_few_repeated_keys_are_broadcast_to_many_rows(spark):
    rows = spark.range(200_000).select(F.when(F.col("id") < 2, 7).otherwise(F.col("id")).alias("k"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100000")
    try:
        gated = K.gate(rows, [K.Unique("U", ("k",))])
        plan = gated._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        assert gated.where("violation = 'U'").count() == 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_strict_rules_run_once(spark):
    """The rejects are read by every table that they cut; the rules do not run again for each."""
    from vitrine.plans import catalog

    strict = catalog.queries()["fact_orders_strict"](spark, SF_SMALL)
    assert strict._jdf.queryExecution().executedPlan().toString().count("lineitem.parquet") == 1


def _no_broadcast(spark, body):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return body()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_rows_move_once_for_rules_on_the_same_key(spark):
    """Parents are looked up for the keys, not for the rows; the rows meet the broken keys in one join."""
    rows = spark.range(1000).select(F.col("id").cast("string").alias("k"), (F.col("id") % 5).alias("n"))
    parent = spark.range(900).select(F.col("id").cast("string").alias("k"))
    rules = [K.Parent("FK", ("k",), parent, ("k",)), K.Unique("UK", ("k", "n"))]
    gated = _no_broadcast(spark, lambda: K.gate(rows, rules))
    plan = _no_broadcast(spark, lambda: gated._jdf.queryExecution().executedPlan().toString())
    assert plan.count("SortMergeJoin") == 1
    assert {r[0]: r[1] for r in gated.groupBy("violation").count().collect()} == {None: 900, "FK": 100}


def test_rules_judged_together_on_nulls_and_in_their_order(spark):
    rows = spark.createDataFrame(
        [("a", 1, "x"), ("a", 1, "x"), ("z", 1, "x"), ("z", None, "x"), ("z", None, None), (None, 1, "x"), (None, 1, "x"), ("b", None, "x"),
         ("b", None, "x"), ("c", 1, None), ("c", 1, None), ("d", 1, "x"), ("d", 2, "x")],
        "k string, n int, v string",
    )
    parent = spark.createDataFrame([("a",), ("b",), ("c",), ("d",), ("d",), (None,)], "id string")
    fk, uk, nn = K.Parent("FK", ("k",), parent, ("id",)), K.Unique("UK", ("n", "k")), K.Required("NN", ("v",))
    ones = K.Unique("U1", ("k",))

    def got(*rules):
        return sorted((r.k or "", r.n or 0, r.v or "", r.violation or "") for r in K.gate(rows, rules).collect())

    rest = [("", 1, "x", ""), ("", 1, "x", ""), ("b", 0, "x", ""), ("b", 0, "x", ""), ("d", 1, "x", ""), ("d", 2, "x", "")]
    first = [("a", 1, "x", "UK")] * 2
    zs = [("z", 0, "", "FK"), ("z", 0, "x", "FK"), ("z", 1, "x", "FK")]
    assert got(fk, nn, uk) == sorted([*rest, *first, *zs, *[("c", 1, "", "NN")] * 2])
    assert got(uk, fk, nn) == sorted([*rest, *first, *zs, *[("c", 1, "", "UK")] * 2])
    assert got(nn, uk, fk) == sorted([*rest, *first, ("z", 0, "", "NN"), *zs[1:], *[("c", 1, "", "NN")] * 2])
    unique = [(k, n, v, "U1" if k else "") for k, n, v, _ in [*rest, *first, *zs]]  # no key but NULL comes once
    assert got(ones, uk) == sorted([*unique, *[("c", 1, "", "U1")] * 2])


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for n in (files.apply(i).getName() for i in range(files.size())) if n.startswith("shuffle_")}


def test_shuffle_files_go_with_the_write(spark, tmp_root):
    from vitrine.session import shuffles_freed

    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was, counted = spark.conf.get(key, None), spark.range(10_000).groupBy((F.col("id") % 7).alias("k")).count()
    before = _shuffle_files(spark)
    with shuffles_freed(spark):
        counted.write.parquet(f"{tmp_root}/counted")
        assert spark.conf.get(key) == "true"
    for _ in range(50):  # executors are told, not waited for
        if not _shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    assert not _shuffle_files(spark) - before
    assert spark.conf.get(key, None) == was and spark.read.parquet(f"{tmp_root}/counted").count() == 7


def _orders_and_items(spark):
    orders = spark.createDataFrame([(str(i),) for i in range(40)] + [("3",), (None,)], "order_id string")
    items = spark.createDataFrame([(str(i % 40), i) for i in range(200)] + [(None, 1), ("3", 3)], "order_id string, n int")
    return replace(FX.staging(spark, SF_SMALL), orders=orders, order_items=items, order_payments=items, order_reviews=items)


def test_passes_hold_every_row_once_and_orders_whole(spark):
    from vitrine.plans.catalog import order_passes

    stg = _orders_and_items(spark)
    assert order_passes(stg, 1000) == [stg]
    passes = order_passes(stg, 50)
    assert len(passes) == 5
    for name in ("orders", "order_items", "order_payments", "order_reviews"):
        parts = [getattr(p, name).collect() for p in passes]
        assert sorted(map(str, itertools.chain(*parts))) == sorted(map(str, getattr(stg, name).collect()))
    for p in passes:
        ids = {r[0] for r in p.orders.collect()}
        assert ids and {r[0] for r in p.order_items.collect()} == ids


def test_gate_of_the_facts_in_passes_keeps_one_table(spark, monkeypatch):
    """The same rows in one pass or several; of the tables before and after the gate only the latter stays."""
    from vitrine.plans import catalog
    from vitrine.plans.warehouse import FileSystem
    from vitrine.session import checkpoint_dir

    def got():
        return sorted(map(tuple, catalog.queries()["constraint_gate"](spark, SF_SMALL).collect()))

    whole, scratch = got(), f"{checkpoint_dir(spark).rstrip('/')}/vitrine"
    kinds = {r[0] for r in whole}
    assert kinds == {"FACT_ORDERS_UK", "FACT_ITEM_ORDER_FK", "FACT_ORDERS", "FACT_ORDER_ITEMS"}
    monkeypatch.setattr(catalog, "ITEMS_A_PASS", 2000)
    before = set(FileSystem(spark).list_names(scratch))
    assert got() == whole
    new = set(FileSystem(spark).list_names(scratch)) - before
    assert sum(n.startswith("gated-items") for n in new) > 1 and not [n for n in new if n.startswith("gate-")]
