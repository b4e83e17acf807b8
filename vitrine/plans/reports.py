"""Published BI queries and run-log reports, as DataFrame functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.functions import columns as C
from vitrine.operators.aggregates import items_by_order_category


def top_categories(
    fact_items: DataFrame, fact_orders: DataFrame, dim_product: DataFrame, n: int = 10, product_versions: str = "current"
) -> DataFrame:
    """Top ``n`` current categories by item revenue: orders, revenue, average review.

    ``fact_orders`` has one row per order id (enforced at load), so a category's
    rows are its distinct orders.

    Items are reduced to (order, category) before meeting the orders, the
    group-by has map-side partial aggregation (a category can be huge), and
    the top-n is a ``TakeOrderedAndProject`` (no global sort). Ties on revenue
    are broken by category name so the cut is deterministic.
    """
    per_cat = items_by_order_category(fact_items, dim_product, product_versions)
    fo = fact_orders.select("order_id", "review_score")
    j = per_cat.join(fo, "order_id")
    scored = F.when(F.col("review_score").isNotNull(), F.col("n_items")).otherwise(F.lit(0))
    g = j.groupBy("category_name_en").agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum("price_sum").alias("rev"),
        F.sum(F.col("review_score") * F.col("n_items")).alias("score_sum"),
        F.sum(scored).alias("score_n"),
    )
    out = g.select(
        "category_name_en",
        F.col("orders").cast("long").alias("orders"),
        F.col("rev").cast(C.SUM_MONEY_TYPE).alias("total_revenue"),
        C.round_ratio("score_sum", "score_n", 2).cast(C.AVG_SCORE_TYPE).alias("avg_review"),
    )
    return out.orderBy(F.col("total_revenue").desc_nulls_first(), F.col("category_name_en").asc_nulls_first()).limit(n)


def monthly_revenue(fact_orders: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Delivered orders and revenue per calendar month, in month order.

    The calendar has one row per day of a fixed range, so broadcasting it has
    a size bound that does not grow with the facts.
    """
    fo = fact_orders.filter(F.col("order_status") == "DELIVERED").select(
        "order_id", "order_date_key", "total_payment_value"
    )
    d = F.broadcast(dim_date.select("date_key", "year_num", "month_num", "month_name"))
    g = (
        fo.join(d, fo["order_date_key"] == d["date_key"])
        .groupBy("year_num", "month_num", "month_name")
        .agg(
            F.countDistinct("order_id").alias("orders"),
            F.round(F.sum("total_payment_value"), 2).alias("revenue"),
        )
    )
    return g.orderBy("year_num", "month_num").select(
        "year_num",
        "month_name",
        F.col("orders").cast("long").alias("orders"),
        F.col("revenue").cast(C.SUM_MONEY_TYPE).alias("revenue"),
    )


def late_rate_by_state(fact_orders: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Delivered orders, late orders and late percentage per customer state."""
    fo = fact_orders.filter(F.col("order_status") == "DELIVERED").select("customer_key", "is_late_delivery")
    dc = dim_customer.select("customer_key", "state", "state_name")
    g = (
        fo.join(dc, "customer_key")
        .groupBy("state", "state_name")
        .agg(
            F.count(F.lit(1)).alias("total_orders"),
            F.sum(F.when(F.col("is_late_delivery") == "Y", 1).otherwise(0)).alias("late_orders"),
        )
    )
    out = g.select(
        "state",
        "state_name",
        F.col("total_orders").cast("long").alias("total_orders"),
        F.col("late_orders").cast("long").alias("late_orders"),
        C.round_ratio(F.col("late_orders") * 100, "total_orders", 1).cast(C.PCT_TYPE).alias("late_pct"),
    )
    return out.orderBy(F.col("late_pct").desc_nulls_first(), "state")


# ------------------------------------------------------------------ run log


def _minutes(start, end):
    secs = F.unix_timestamp(end) - F.unix_timestamp(start)
    return F.round(secs / F.lit(60.0), 1)


def run_history(batch_log: DataFrame) -> DataFrame:
    """All runs, newest first, with duration in minutes (true minutes)."""
    return batch_log.orderBy(F.col("start_dt").desc_nulls_first(), F.col("batch_id").desc()).select(
        "batch_id",
        "batch_name",
        "status",
        F.date_format("start_dt", "yyyy-MM-dd HH:mm").alias("started"),
        "total_records",
        "success_records",
        "rejected_records",
        _minutes("start_dt", "end_dt").alias("mins"),
    )


def step_detail(step_log: DataFrame, batch_id: int) -> DataFrame:
    """Steps of one batch in start order."""
    return (
        step_log.filter(F.col("batch_id") == F.lit(batch_id))
        .orderBy("start_dt", "step_log_id")
        .select("step_name", "step_status", "records_in", "records_out", "records_rejected", "duration_secs")
    )


def health_check(batch_log: DataFrame, n: int = 5) -> DataFrame:
    """Latest ``n`` runs with duration, or 'RUNNING' while unfinished."""
    mins = _minutes("start_dt", "end_dt")
    return (
        batch_log.orderBy(F.col("start_dt").desc_nulls_first(), F.col("batch_id").desc())
        .limit(n)
        .select(
            "batch_id",
            "batch_name",
            "status",
            F.date_format("start_dt", "yyyy-MM-dd HH:mm").alias("started"),
            "total_records",
            "rejected_records",
            F.coalesce(mins.cast("string"), F.lit("RUNNING")).alias("duration_mins"),
        )
    )
