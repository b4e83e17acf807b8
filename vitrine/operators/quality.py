"""Data-quality checks (reject rows) and table constraint checks.

Every check is a filter that produces reject rows with a fixed schema; all of
them are unioned into one DataFrame and written in a single append. Checks
are log-only, as in the source pipeline: the loads run on the full staging
data unless ``strict`` filtering is asked for (see ``without_rejects``).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.functions import columns as C
from vitrine.functions import lookups as L
from vitrine.sources.feeds import Staging

REJECT_COLUMNS = ["source_table", "source_key", "reject_reason", "raw_data", "etl_batch_id"]


def in_batch(df: DataFrame, batch_id: int | None) -> DataFrame:
    """Rows of one batch (partition-pruned when staging is partitioned by batch)."""
    return df if batch_id is None else df.filter(F.col("etl_batch_id") == F.lit(batch_id).cast("long"))


def item_key() -> Column:
    return C.text_concat("order_id", F.lit("-"), "order_item_id")


def _unparseable(text: str, parsed: Column) -> Column:
    return F.col(text).isNotNull() & parsed.isNull()


def _any(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conds)


@dataclass(frozen=True)
class Check:
    """One data-quality rule: rows of ``feed`` where ``cond`` holds are rejected."""

    feed: str  # Staging attribute
    table: str  # reject table label
    reason: str
    cond: Callable[[], Column]
    key: Callable[[], Column]
    extra: bool = False  # not one of the source pipeline's four rules


ORDER_DATE_COLUMNS = [
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
]
REVIEW_DATE_COLUMNS = ["review_creation_date", "review_answer_timestamp"]

# NULL status and NULL score are not rejected (NOT IN / NOT BETWEEN on NULL is
# unknown), as in the source; the review load still skips a NULL score.
NULL_ORDER_ID = Check(
    "orders", "STG_ORDERS", L.REJECT_NULL_ORDER_ID, lambda: F.col("order_id").isNull(), lambda: F.lit(L.NULL_KEY_TEXT)
)
BAD_STATUS = Check(
    "orders", "STG_ORDERS", L.REJECT_BAD_STATUS,
    lambda: ~F.col("order_status").isin(*L.VALID_ORDER_STATUSES), lambda: F.col("order_id"),
)
NEGATIVE_AMOUNT = Check(
    "order_items", "STG_ORDER_ITEMS", L.REJECT_NEGATIVE_AMOUNT,
    lambda: (C.parse_amount("price") < 0) | (C.parse_amount("freight_value") < 0), item_key,
)
BAD_SCORE = Check(
    "order_reviews", "STG_ORDER_REVIEWS", L.REJECT_BAD_SCORE,
    lambda: ~F.col("review_score").between(1, 5), lambda: F.col("review_id"),
)
# Rows the source load would have aborted on: text that is not a number or a date.
NON_NUMERIC_ITEM = Check(
    "order_items", "STG_ORDER_ITEMS", L.REJECT_NON_NUMERIC,
    lambda: _any([_unparseable(c, C.parse_amount(c)) for c in ("price", "freight_value")]), item_key, True,
)
NON_NUMERIC_PAYMENT = Check(
    "order_payments", "STG_ORDER_PAYMENTS", L.REJECT_NON_NUMERIC,
    lambda: _unparseable("payment_value", C.parse_amount("payment_value")),
    lambda: C.text_concat("order_id", F.lit("-"), "payment_sequential"), True,
)
ITEM_AMOUNT_RANGE = Check(
    "order_items", "STG_ORDER_ITEMS", L.REJECT_AMOUNT_RANGE,
    lambda: _any([C.amount_overflows(c, C.PRICE_TYPE) for c in ("price", "freight_value")]), item_key, True,
)
PAYMENT_AMOUNT_RANGE = Check(
    "order_payments", "STG_ORDER_PAYMENTS", L.REJECT_AMOUNT_RANGE,
    lambda: C.amount_overflows("payment_value", C.PAYMENT_TOTAL_TYPE),
    lambda: C.text_concat("order_id", F.lit("-"), "payment_sequential"), True,
)
BAD_COORDINATE = Check(
    "geolocation", "STG_GEOLOCATION", L.REJECT_BAD_COORDINATE,
    lambda: _any([_unparseable(c, C.parse_coord(c)) for c in ("geolocation_lat", "geolocation_lng")]),
    lambda: F.col("geolocation_zip_code_prefix"), True,
)
BAD_ORDER_DATE = Check(
    "orders", "STG_ORDERS", L.REJECT_BAD_DATE,
    lambda: _any([_unparseable(c, C.parse_day(c)) for c in ORDER_DATE_COLUMNS]), lambda: F.col("order_id"), True,
)
BAD_REVIEW_DATE = Check(
    "order_reviews", "STG_ORDER_REVIEWS", L.REJECT_BAD_DATE,
    lambda: _any([_unparseable(c, C.parse_day(c)) for c in REVIEW_DATE_COLUMNS]), lambda: F.col("review_id"), True,
)
CHECKS = [
    NULL_ORDER_ID, BAD_STATUS, NEGATIVE_AMOUNT, BAD_SCORE,
    NON_NUMERIC_ITEM, NON_NUMERIC_PAYMENT, ITEM_AMOUNT_RANGE, PAYMENT_AMOUNT_RANGE, BAD_COORDINATE,
    BAD_ORDER_DATE, BAD_REVIEW_DATE,
]
DQ_REASONS = sorted({c.reason for c in CHECKS})


def run_checks(stg: Staging, checks: list[Check], batch_id: int | None = None) -> DataFrame:
    """Reject rows of all ``checks``, reading each staging table once.

    Every row of a table carries an array with one (hit, key, reason) entry
    per rule of that table; only the hits are exploded into reject rows, so
    adding rules does not add scans. The rules of a table are worked out in
    one projection, which parses a text once for all of them; the generator
    after it keeps the filter on their results from repeating them, and only
    rows with a hit get entries.
    """
    batch = F.lit(batch_id).cast("long") if batch_id is not None else F.col("etl_batch_id")
    by_feed: dict[str, list[Check]] = {}
    for c in checks:
        by_feed.setdefault(c.feed, []).append(c)
    parts = []
    for feed, rules in by_feed.items():
        names = [f"_hit{n}" for n in range(len(rules))]
        found = F.struct(*[r.cond().alias(n) for n, r in zip(names, rules)])
        df = in_batch(getattr(stg, feed), batch_id).withColumn("_found", found).select("*", F.inline(F.array("_found")))
        df = df.where(_any([F.col(n) for n in names]))
        entries = F.array(
            *[
                F.struct(
                    F.col(n).alias("hit"),
                    F.lit(r.table).alias("source_table"),
                    r.key().cast("string").alias("source_key"),
                    F.lit(r.reason).alias("reject_reason"),
                )
                for n, r in zip(names, rules)
            ]
        )
        hits = df.select(batch.alias("etl_batch_id"), F.explode(F.filter(entries, lambda e: e["hit"])).alias("r"))
        parts.append(
            hits.select(
                "r.source_table",
                "r.source_key",
                F.substring("r.reject_reason", 1, 1000).alias("reject_reason"),
                F.lit(None).cast("string").alias("raw_data"),
                "etl_batch_id",
            )
        )
    return reduce(DataFrame.unionByName, parts)


def null_order_ids(stg: Staging, batch_id: int | None = None) -> DataFrame:
    return run_checks(stg, [NULL_ORDER_ID], batch_id)


def bad_statuses(stg: Staging, batch_id: int | None = None) -> DataFrame:
    return run_checks(stg, [BAD_STATUS], batch_id)


def negative_amounts(stg: Staging, batch_id: int | None = None) -> DataFrame:
    return run_checks(stg, [NEGATIVE_AMOUNT], batch_id)


def bad_scores(stg: Staging, batch_id: int | None = None) -> DataFrame:
    return run_checks(stg, [BAD_SCORE], batch_id)


def non_numeric_amounts(stg: Staging, batch_id: int | None = None) -> DataFrame:
    """Amount text that is not a number (e.g. '1,5')."""
    return run_checks(stg, [NON_NUMERIC_ITEM, NON_NUMERIC_PAYMENT], batch_id)


def out_of_range(stg: Staging, batch_id: int | None = None) -> DataFrame:
    """Amounts too large for their column, and coordinates that are no number or too large."""
    return run_checks(stg, [ITEM_AMOUNT_RANGE, PAYMENT_AMOUNT_RANGE, BAD_COORDINATE], batch_id)


def bad_dates(stg: Staging, batch_id: int | None = None) -> DataFrame:
    """Date text that does not parse."""
    return run_checks(stg, [BAD_ORDER_DATE, BAD_REVIEW_DATE], batch_id)


def validate_staging(stg: Staging, batch_id: int | None = None, extra: bool = True) -> DataFrame:
    """All reject rows of a batch (the four source rules, plus parse rules): one scan per table."""
    return run_checks(stg, [c for c in CHECKS if extra or not c.extra], batch_id)


def reject_summary(rejects: DataFrame) -> DataFrame:
    return rejects.groupBy("source_table", "reject_reason").agg(F.count(F.lit(1)).alias("reject_count"))


def without_rejects(df: DataFrame, rejects: DataFrame, table: str, key: Column) -> DataFrame:
    """Strict mode: drop rows whose key was rejected for ``table``."""
    bad = rejects.filter(F.col("source_table") == table).select(F.col("source_key").alias("_rk")).distinct()
    return df.join(bad, key.cast("string") == F.col("_rk"), "left_anti")


def strict_staging(stg: Staging, rejects: DataFrame) -> Staging:
    """Staging without the rows that data-quality rules rejected (orders, items, reviews), nor those without a key.

    ``rejects``: the rule rejects of the same run. Rows that a *load* of an
    earlier run left out (an unknown customer, say) are not affected.
    """
    rejects = rejects.filter(F.col("reject_reason").isin(*DQ_REASONS))
    t = stg.tables()
    t["orders"] = t["orders"].filter(F.col("order_id").isNotNull())
    t["order_items"] = t["order_items"].filter(F.col("order_id").isNotNull() & F.col("order_item_id").isNotNull())
    t["order_reviews"] = t["order_reviews"].filter(F.col("review_id").isNotNull())
    t["orders"] = without_rejects(t["orders"], rejects, "STG_ORDERS", F.col("order_id"))
    t["order_items"] = without_rejects(t["order_items"], rejects, "STG_ORDER_ITEMS", item_key())
    t["order_reviews"] = without_rejects(t["order_reviews"], rejects, "STG_ORDER_REVIEWS", F.col("review_id"))
    return Staging(**t)


# ---------------------------------------------------------------- constraints


def duplicate_keys(df: DataFrame, keys: list[str], table: str) -> DataFrame:
    """Primary/unique key check: keys that occur more than once."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .filter(F.col("occurrences") > 1)
        .select(
            F.lit(table).alias("table_name"),
            F.concat_ws("|", *[F.col(k).cast("string") for k in keys]).alias("key_value"),
            "occurrences",
        )
    )


def orphans(child: DataFrame, child_keys: list[str], parent: DataFrame, parent_keys: list[str], name: str) -> DataFrame:
    """Foreign key check: child rows whose key has no parent row (NULL keys are not checked)."""
    not_null = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in child_keys])
    parent_keys_df = parent.select(*parent_keys).distinct()
    cond = reduce(lambda a, b: a & b, [child[c] == parent_keys_df[p] for c, p in zip(child_keys, parent_keys)])
    return (
        child.filter(not_null)
        .join(parent_keys_df, cond, "left_anti")
        .groupBy(*child_keys)
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .select(
            F.lit(name).alias("constraint_name"),
            F.concat_ws("|", *[F.col(k).cast("string") for k in child_keys]).alias("key_value"),
            "occurrences",
        )
    )


def null_counts(df: DataFrame, cols: list[str], table: str) -> DataFrame:
    """NOT NULL check: number of NULLs per required column (zero rows included)."""
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    stacked = agg.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count")) for c in cols])).alias(
            "s"
        )
    )
    return stacked.select(F.lit(table).alias("table_name"), "s.column_name", "s.null_count")


def scd2_interval_errors(history: DataFrame, key: str = "product_id", surrogate: str = "product_key") -> DataFrame:
    """Version intervals that are empty or overlap the previous version of the same key.

    A key has a handful of versions, so the per-key window stays small.
    """
    from pyspark.sql import Window

    w = Window.partitionBy(key).orderBy(F.col("effective_from"), F.col(surrogate))
    prev_to = F.lag(F.coalesce(F.col("effective_to"), F.lit("9999-12-31").cast("date"))).over(w)
    flagged = history.select(
        key,
        surrogate,
        "effective_from",
        "effective_to",
        F.when(F.col("effective_to") < F.col("effective_from"), F.lit("EFFECTIVE_TO before EFFECTIVE_FROM"))
        .when(prev_to >= F.col("effective_from"), F.lit("Overlaps previous version"))
        .alias("problem"),
    )
    return flagged.filter(F.col("problem").isNotNull())
