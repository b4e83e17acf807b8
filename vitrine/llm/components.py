"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import written


def _state(edges: DataFrame) -> tuple:
    """Count and order-free checksum: equal for equal edge sets."""
    h = F.xxhash64("hi", "lo").cast("decimal(38,0)")
    return tuple(edges.agg(F.count("*"), F.sum(h)).first())


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node that has an edge to another; root is the least node of its component.

    Each round hangs every node's greater neighbours, then its lesser ones, on
    its least neighbour, which at least halves the depth of what is left; it
    ends when a round changes nothing. A round is two grouped minima (combined
    before the exchange) and two joins on the node, which adaptive execution
    splits where a node has very many edges; rounds are cut by written tables.
    Only a count and a checksum reach the driver.
    """
    now = written(
        edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).where("hi <> lo").distinct(), "edges"
    )
    state = _state(now)
    while state[0]:
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(now.select("lo", "hi"))
        least = both.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("m"))
        large = now.join(least, now["lo"] == least["u"]).select("hi", F.col("m").alias("lo")).distinct()
        foot = large.groupBy("hi").agg(F.min("lo").alias("m"))
        joined = large.join(foot, "hi")
        small = joined.select("hi", F.col("m").alias("lo")).union(
            joined.where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        )
        after = written(small.distinct(), "edges")
        new = _state(after)
        if new == state:
            break
        now, state = after, new
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
