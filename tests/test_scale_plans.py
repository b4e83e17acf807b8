"""Plans of the jobs at size: texts are parsed once, payments are dealt once, facts that are read again are written."""

from dataclasses import replace

from pyspark.sql import functions as F
from star_cases import SF_SMALL

from vitrine.operators import facts as FT
from vitrine.operators import quality as Q
from vitrine.plans import catalog
from vitrine.sources import fixtures as FX


def plan(df, part: str) -> str:
    return getattr(df._jdf.queryExecution(), part)().toString()


def filters(df) -> list[str]:
    return [line for line in plan(df, "optimizedPlan").splitlines() if line.strip(" :+-").startswith("Filter")]


def test_rules_parse_a_text_once_a_row(spark):
    rejects = Q.validate_staging(FX.staging(spark, SF_SMALL), FX.FIXTURE_BATCH_ID)
    lines = [line for line in plan(rejects, "optimizedPlan").splitlines() if "decimal(38,12)" in line]
    assert lines and all(line.strip(" :+-").startswith("Project") for line in lines)  # shared within a projection only


def test_rules_on_hits_nulls_and_several_reasons(spark):
    stg = FX.staging(spark, SF_SMALL)
    rows = [("1", 1, "-2", "n/a"), ("2", 1, None, None), ("3", 1, "1.00", "2.00"), (None, None, "99999999999", "-1"), ("3", 1, "x", "1")]
    items = spark.createDataFrame(rows, "order_id string, order_item_id long, price string, freight_value string").withColumn(
        "etl_batch_id", F.lit(1).cast("long")
    )
    rules = [Q.NEGATIVE_AMOUNT, Q.NON_NUMERIC_ITEM, Q.ITEM_AMOUNT_RANGE]
    got = sorted((r.source_key, r.reject_reason) for r in Q.run_checks(replace(stg, order_items=items), rules, 1).collect())
    assert got == sorted([
        ("1-1", Q.L.REJECT_NEGATIVE_AMOUNT), ("1-1", Q.L.REJECT_NON_NUMERIC), ("-", Q.L.REJECT_NEGATIVE_AMOUNT),
        ("-", Q.L.REJECT_AMOUNT_RANGE), ("3-1", Q.L.REJECT_NON_NUMERIC),
    ])


def test_item_amounts_are_parsed_below_the_joins(spark):
    w = catalog.FixtureLoad(spark, SF_SMALL)
    assert not [line for line in filters(w.fact_items) if "decimal(38,12)" in line]


def test_payments_are_dealt_once(spark):
    rolled = FT.payments_rollup(FX.staging(spark, SF_SMALL), FX.FIXTURE_BATCH_ID)
    assert plan(rolled, "executedPlan").count("Exchange ") == 1


def test_payment_totals_of_odd_amounts(spark):
    rows = [("1", "a", 1, "10.00"), ("1", "a", 3, "0.005"), ("1", "b", 2, "9999999999999"), ("2", "a", 1, None), (None, "c", 1, "1")]
    pay = spark.createDataFrame(rows, "order_id string, payment_type string, payment_installments long, payment_value string")
    stg = replace(FX.staging(spark, SF_SMALL), order_payments=pay)
    got = {r.order_id: (r.total_payment, r.max_installments, r.primary_payment_type) for r in FT.payments_rollup(stg).collect()}
    assert {k: (None if v[0] is None else str(v[0].normalize()), *v[1:]) for k, v in got.items()} == {
        "1": ("10.005", 3, "b"), "2": (None, 1, "a"), None: ("1", 1, "c"),
    }


def test_step_counts_resolve_the_items_once_besides_the_aggregate(spark):
    """The item counts of two steps come out of one pass (each pass joins the items to their orders)."""
    counts = catalog.step_count_rows(catalog.FixtureLoad(spark, SF_SMALL))
    assert plan(counts, "analyzed").count("Order not in batch") == 2


def test_refreshes_read_written_facts(spark):
    for name in ("agg_daily_sales_incremental", "agg_daily_sales_delta"):
        refreshed = catalog.queries()[name](spark, SF_SMALL)
        assert "lineitem" not in "".join(refreshed.inputFiles())
    assert "order_item_id" not in plan(catalog.queries()["agg_daily_sales_incremental"](spark, SF_SMALL), "analyzed")


def test_order_days_are_parsed_below_the_joins(spark):
    w = catalog.FixtureLoad(spark, SF_SMALL)
    lines = [line for line in plan(w.fact_orders, "optimizedPlan").splitlines() if "AS days_to_approve" in line]
    assert lines and not [line for line in lines if "order_approved_at" in line or "order_purchase_timestamp" in line]


def test_items_that_miss_a_lookup_leave_at_its_join(spark):
    assert "LeftOuter" not in plan(catalog.FixtureLoad(spark, SF_SMALL).fact_items, "optimizedPlan")
