"""A run log derived from the staged orders and items: one batch per order month.

Batch id: year and month of purchase (199501). A batch reads the orders of its
month and their items, a second a row. Some batches never end, some fail in the
items' step, some are run again a day later.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.functions import columns as C
from vitrine.functions import lookups as L
from vitrine.plans.runlog import attempt_totals, latest_events
from vitrine.sources.feeds import Staging

# Which months' batches never end, fail, and are run again (by months since year 0).
UNFINISHED, FAILED, RERUN = (7, 3), (11, 5), (10, 4)


def _is(rule: tuple[int, int]) -> Column:
    return F.col("month_no") % rule[0] == rule[1]


def monthly_loads(stg: Staging) -> DataFrame:
    """Per month of purchase: orders, those of no valid status, items, those whose price is no number."""
    day = C.parse_day("order_purchase_timestamp")
    dated = stg.orders.select("order_id", "order_status", day.alias("day")).where("day IS NOT NULL").select(
        "order_id",
        (~F.col("order_status").isin(*L.VALID_ORDER_STATUSES)).cast("long").alias("bad"),
        (F.year("day") * 100 + F.month("day")).cast("long").alias("batch_id"),
    )
    items = stg.order_items.join(dated.select("order_id", "batch_id"), "order_id").select(
        "batch_id", (F.col("price").isNotNull() & C.parse_amount("price").isNull()).cast("long").alias("bad")
    )

    def counted(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy("batch_id").agg(F.count(F.lit(1)).alias(name), F.sum("bad").alias(f"bad_{name}"))

    months = counted(dated, "orders").join(counted(items, "items"), "batch_id", "left").na.fill(0)
    b = F.col("batch_id")
    return months.withColumn("month_no", F.floor(b / 100) * 12 + b % 100).withColumn(
        "began", F.to_timestamp(F.concat(b.cast("string"), F.lit("01 02:00:00")), "yyyyMMdd HH:mm:ss")
    )


def _later(ts: str, seconds: Column) -> Column:
    return F.timestamp_seconds(F.unix_timestamp(ts) + seconds)


def _attempts(months: DataFrame) -> DataFrame:
    """One row per (batch, attempt) with its times and how it ends."""
    first = months.withColumn("attempt", F.lit(1)).withColumn("start_dt", F.col("began"))
    again = months.where(_is(RERUN)).withColumn("attempt", F.lit(2)).withColumn("start_dt", _later("began", F.lit(86400)))
    ends = (
        F.when((F.col("attempt") == 1) & _is(UNFINISHED), "RUNNING")
        .when((F.col("attempt") == 1) & _is(FAILED), "FAILED")
        .otherwise("SUCCESS")
    )
    return first.unionByName(again).withColumn("ends", ends)


def step_events(months: DataFrame) -> DataFrame:
    """A start and, unless the step never ends, an end event of both load steps of every attempt."""
    a = _attempts(months)
    middle = _later("start_dt", F.col("orders"))
    steps = [
        (L.STEP_FACT_ORDERS, 0, F.col("start_dt"), middle, "orders", F.lit("SUCCESS")),
        (L.STEP_FACT_ITEMS, 1, middle, _later("start_dt", F.col("orders") + F.col("items")), "items", F.col("ends")),
    ]
    parts = []
    for name, no, start, end, rows, status in steps:
        ident = [
            (F.col("batch_id") * 10 + F.col("attempt") * 2 + no).alias("step_log_id"), "batch_id", "attempt",
            F.lit(name).alias("step_name"),
        ]
        zero, none = F.lit(0).cast("long"), F.lit(None)
        parts.append(
            a.select(
                *ident, F.lit("RUNNING").alias("step_status"), zero.alias("records_in"), zero.alias("records_out"),
                zero.alias("records_rejected"), start.alias("start_dt"), none.cast("timestamp").alias("end_dt"),
                none.cast("double").alias("duration_secs"), none.cast("string").alias("error_message"), start.alias("event_ts"),
            )
        )
        done = status == "SUCCESS"
        parts.append(
            a.where(status != "RUNNING").select(
                *ident, status.alias("step_status"), F.col(rows).alias("records_in"),
                F.when(done, F.col(rows) - F.col(f"bad_{rows}")).otherwise(zero).alias("records_out"),
                F.when(done, F.col(f"bad_{rows}")).otherwise(zero).alias("records_rejected"), start.alias("start_dt"),
                end.alias("end_dt"), F.col(rows).cast("double").alias("duration_secs"),
                F.when(~done, "load failed").alias("error_message"), end.alias("event_ts"),
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def batch_events(months: DataFrame) -> DataFrame:
    """A start and, unless the batch never ends, an end event of every attempt, with the totals of its steps."""
    totals = attempt_totals(latest_events(step_events(months), "step_log_id"))
    a = _attempts(months).join(totals, ["batch_id", "attempt"])
    end = _later("start_dt", F.col("orders") + F.col("items"))
    zero = F.lit(0).cast("long")

    def event(rows: DataFrame, status: Column, end_dt: Column, at: Column, counted: bool) -> DataFrame:
        n = {c: F.col(c) if counted else zero for c in ("total_records", "success_records", "rejected_records")}
        return rows.select(
            "batch_id", "attempt", F.concat(F.lit(L.BATCH_NAME_PREFIX), F.col("batch_id").cast("string")).alias("batch_name"),
            F.lit(L.PIPELINE_NAME).alias("pipeline_name"), "start_dt", end_dt.cast("timestamp").alias("end_dt"),
            status.alias("status"), *[c.alias(k) for k, c in n.items()],
            F.when(status == "FAILED", "load failed").alias("error_message"), F.lit("SCHEDULER").alias("triggered_by"),
            at.alias("event_ts"),
        )

    begun = F.when(F.col("attempt") == 1, "RUNNING").otherwise("RERUN")
    return event(a, begun, F.lit(None), F.col("start_dt"), False).unionByName(
        event(a.where("ends <> 'RUNNING'"), F.col("ends"), end, end, True)
    )
