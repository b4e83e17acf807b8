"""Refresh of the daily aggregate by signed differences.

The aggregate is kept as a state of sums and counts (``aggregates.daily_state``).
When some orders change, their old contributions are taken off and their new ones
added; no other order is read, and no day is computed anew.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.operators import aggregates as A


@dataclass(frozen=True)
class Star:
    """The tables that the daily aggregate depends on, at one time."""

    orders: DataFrame
    customers: DataFrame
    items: DataFrame
    products: DataFrame

    def of(self, orders: DataFrame) -> "Star":
        """The same with the facts of some order ids only."""
        ids = orders.select("order_id")
        return Star(
            self.orders.join(ids, "order_id", "left_semi"), self.customers,
            self.items.join(ids, "order_id", "left_semi"), self.products,
        )

    def state(self, product_versions: str = "current") -> DataFrame:
        return A.daily_state(self.orders, self.customers, self.items, self.products, product_versions)


def _differing(before: DataFrame, after: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Keys whose row came, went, or has another value in ``columns`` (a NULL equals a NULL)."""
    was = before.select(key, F.struct(*columns).alias("was"))
    now = after.select(key, F.struct(*columns).alias("now"))
    return was.join(now, key, "full_outer").where(~F.col("was").eqNullSafe(F.col("now"))).select(key)


def changed_orders(before: Star, after: Star, since_batch: int) -> DataFrame:
    """Ids of the orders whose contribution may differ between two times.

    These are orders with a row (their own, or of an item) written by batch
    ``since_batch`` or a later one, orders of customers whose state differs, and
    orders with items of products whose category or currency differs. The facts
    are read by batch partition; the two dimensions are compared whole, and
    their differences cut the facts by semi joins. A fact row that was deleted
    leaves no trace in ``after``: add its order id to the result.
    """

    def written(rows: DataFrame) -> DataFrame:
        return rows.where(F.col("etl_batch_id") >= since_batch).select("order_id")

    moved = _differing(before.customers, after.customers, "customer_key", ["state"])
    refiled = _differing(before.products, after.products, "product_key", ["category_name_en", "is_current"])
    parts = [written(after.orders), written(after.items)]
    for star in (before, after):
        parts.append(star.orders.join(moved, "customer_key", "left_semi").select("order_id"))
        parts.append(star.items.join(refiled, "product_key", "left_semi").select("order_id"))
    ids = parts[0]
    for p in parts[1:]:
        ids = ids.unionAll(p)
    return ids.where("order_id IS NOT NULL").distinct()


def signed_delta(before: Star, after: Star, orders: DataFrame, product_versions: str = "current") -> DataFrame:
    """What the given orders add to the state: new contributions minus old ones, per group."""
    old, new = (s.of(orders).state(product_versions) for s in (before, after))
    negated = old.select(*A.DAILY_GROUP, *[(-F.col(m)).alias(m) for m in A.DAILY_MEASURES])
    return _added(new.unionByName(negated))


def apply_delta(state: DataFrame, delta: DataFrame) -> DataFrame:
    """The state with a delta added. Groups without items are gone.

    A group with fewer than no items shows that the delta was not taken from
    this state; that raises instead of giving a wrong aggregate.
    """
    merged = _added(state.select(*delta.columns).unionByName(delta))
    wrong = F.raise_error(F.lit("the delta takes off items that the state does not hold")).cast("long")
    return merged.withColumn(
        "item_count", F.when(F.col("item_count") < 0, wrong).otherwise(F.col("item_count"))
    ).where("item_count <> 0")


def _added(rows: DataFrame) -> DataFrame:
    def total(m: str) -> Column:
        kind = "decimal(38,2)" if m.endswith("_total") else "long"
        return F.sum(m).cast(kind).alias(m)

    return rows.groupBy(*A.DAILY_GROUP).agg(*[total(m) for m in A.DAILY_MEASURES])
