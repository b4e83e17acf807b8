"""Mixing sources to target weights by capped water-filling (DataFrame functions only).

Sizes are summed per source first; sources get their rank (and so their weight)
over that small table. Water-filling raises one level for all: a source's target
is level times weight, stopped at ``max_epochs`` times its size; each round adds
up what the stopped sources hold and shares the rest among the others, until no
further source is above its stop. Two sums a round reach the driver.

A source whose target is r times its size gives every document floor(r) whole
repetitions; the fractional repetition goes to documents in a seeded order (MD5
of seed and id, then id, size and written row) until its words are used up, the
last one in part, so the words taken meet the target to the word. Only the place
where the words run out is searched, in four steps that each narrow it down:
sums per MD5 prefix, per (MD5, id, size), per block of written rows, and the
rows of one block. Every sum is combined before its exchange and no step ranks
more than one prefix, group or block of a source, so neither a hot source nor a
hot repeated id (or null ids) is one task. Rows then compare themselves with the
place found in their source; texts are never shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitrine.llm.common import WORD, Input, documents, written

ROWS_PER_RANGE = 4096
ORDER = ("u", "id", "size")  # of a source's documents; rows equal in these follow as they were written


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ranked(sources: DataFrame, col: str) -> DataFrame:
    """``sources`` (one row each) plus ``rank`` from 0 by code point, null last, without one task for all."""
    ordered = written(
        sources.repartitionByRange(F.col(col).asc_nulls_last()).withColumn("part", F.spark_partition_id()), "op7-sources"
    )
    starts = ordered.groupBy("part").count()
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    starts = starts.select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    nth = F.row_number().over(Window.partitionBy("part").orderBy(F.col(col).asc_nulls_last()))
    return ordered.withColumn("nth", nth).join(F.broadcast(starts), "part").select(
        *sources.columns, (F.col("start") + F.col("nth") - 1).alias("rank")
    )


def water_level(sources: DataFrame, total: int) -> float:
    """The level at which targets min(cap, level * weight) add up to ``total`` (infinite if all caps are below)."""
    cap, weight = F.col("cap"), F.col("weight")
    filled, level = None, None
    while True:
        stopped = F.lit(False) if level is None else cap < F.lit(level) * weight
        held, free, n = sources.agg(
            F.coalesce(F.sum(F.when(stopped, cap)), F.lit(0)),
            F.coalesce(F.sum(F.when(~stopped, weight)), F.lit(0)),
            F.count(F.when(stopped, 1)),
        ).first()
        if n == filled or not free:
            return level if free else math.inf
        filled, level = n, float(total - held) / float(free)


def stops(rows: DataFrame, plan: DataFrame, rows_per_range: int) -> DataFrame:
    """Per source the row (u, id, size, rid) that takes the last ``part`` of its ``rest`` words.

    A source all of whose words are taken has none, like a source without words.
    ``rows`` is a written table, read once a step in the columns of that step.
    """
    most = rows.groupBy("src").count().agg(F.max("count")).first()[0] or 0
    digits = max(3, math.ceil(math.log(max(1, most / rows_per_range), 16)))
    rows = rows.withColumn("cut", F.substring("u", 1, digits))
    rows = rows.withColumn("block", F.col("rid") - F.pmod("rid", F.lit(rows_per_range)))
    at = plan.select("src", "rest", F.lit(0).cast("long").alias("start"))
    known: list[str] = []
    for k, keys in enumerate((["cut"], list(ORDER), ["block"], ["rid"])):
        same = F.col("r.src").eqNullSafe(F.col("f.src"))
        for c in known:
            same = same & F.col(f"r.{c}").eqNullSafe(F.col(f"f.{c}"))
        carried = ["src", *known, "rest", "start"]
        parts = rows.alias("r").join(at.alias("f"), same).select(
            *[f"f.{c}" for c in carried], *[f"r.{c}" for c in keys], F.col("r.size").alias("words")
        )
        parts = parts.groupBy(*carried, *keys).agg(F.sum("words").alias("words"))
        before = Window.partitionBy("src").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
        parts = parts.withColumn("start", F.col("start") + F.coalesce(F.sum("words").over(before), F.lit(0)))
        here = (F.col("start") <= F.col("rest")) & (F.col("rest") < F.col("start") + F.col("words"))
        at = written(parts.where(here).drop("words"), f"op7-stop{k}")  # at most one row a source
        known += keys
    return at.select("src", *ORDER, "rid", (F.col("rest") - F.col("start")).alias("part"))


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = (1, 2, 3),
    max_epochs: int = 3,
    seed: str = "mix-1",
    keep: list[str] | None = None,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """``keep`` columns of all rows of ``docs`` (default: all) plus size, source_size, target, taken.

    size counts words (null text: 0). Sources in code-point order, null last as
    a source of its own, take ``weights`` in turn; their targets share the sum
    of all sizes. taken is between floor and ceiling of target / source_size
    repetitions of the document; the source's taken words add up to its target,
    rounded. Order ties (equal ids) fall by size, then by the row as written once
    to the shared folder. A source without words has target 0. An empty table
    gives an empty result.
    """
    keep = docs.columns if keep is None else keep
    src = Input(docs, id=id_col, text=text_col, source=source_col, **{f"k{i}": c for i, c in enumerate(keep)})
    kept = list(dict.fromkeys(src.name(f"k{i}") for i in range(len(keep))))
    rows = written(
        src.df.select(
            *kept,
            word_count(src["text"]).alias("size"),
            src["source"].alias("src"),
            src["id"].alias("id"),
            F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(src["id"].cast("string"), F.lit("null"))).cast("binary")).alias("u"),
            F.monotonically_increasing_id().alias("rid"),
        ),
        "op7-rows",
    )
    sized = written(
        rows.groupBy("src").agg(F.sum("size").alias("source_size")), "op7-sizes"
    )
    total = sized.agg(F.sum("source_size")).first()[0]
    turn = F.array(*[F.lit(int(w)) for w in weights])
    sources = written(
        ranked(sized, "src").select(
            "src",
            "source_size",
            (F.col("source_size") * max_epochs).alias("cap"),
            F.get(turn, (F.col("rank") % len(weights)).cast("int")).alias("weight"),
        ),
        "op7-ranked",
    )
    level = water_level(sources, total or 0)
    wanted = F.lit(level) * F.col("weight")
    target = F.when(F.col("cap") < wanted, F.col("cap").cast("double")).otherwise(wanted)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    plan = (
        sources.withColumn("target", target)
        .withColumn("whole", whole.cast("long"))
        .withColumn("rest", F.floor(F.col("target") - F.col("whole") * F.col("source_size") + 0.5).cast("long"))
        .select("src", "source_size", "target", "whole", "rest")
    )
    plan = written(plan, "op7-plan")
    stop = stops(rows, plan, rows_per_range).withColumnRenamed("src", "s_src")
    stop = stop.select("s_src", F.struct(*ORDER, "rid").alias("stop"), "part")
    limits = plan.join(stop, F.col("src").eqNullSafe(F.col("s_src")), "left").withColumnRenamed("src", "p_src").drop("s_src")
    limits = written(limits, "op7-limits")  # one row a source: its measured size lets the rows stay where they are
    joined = rows.join(limits, F.col("src").eqNullSafe(F.col("p_src")))
    own, zero = F.struct(*ORDER, "rid"), F.lit(0).cast("long")
    part = (
        F.when(F.col("stop").isNull(), F.when(F.col("rest") >= F.col("source_size"), F.col("size")).otherwise(zero))
        .when(own < F.col("stop"), F.col("size"))
        .when(F.col("rid") == F.col("stop.rid"), F.col("part"))
        .otherwise(zero)
    )
    results = {"size": "size", "source_size": "source_size", "target": "target", "taken": F.col("whole") * F.col("size") + part}
    return joined.select(
        *[src[f"k{i}"].alias(c) for i, c in enumerate(keep) if c.lower() not in results],
        *[(F.col(c) if isinstance(c, str) else c).alias(r) for r, c in results.items()],
    )


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(documents(spark, sf_dir, "doc_id", "text", "source"), keep=["doc_id"]).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS u,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, CAST(3 * sum(size) AS BIGINT) AS cap,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
  FROM d GROUP BY source
), fill(step, level) AS (
  SELECT 0, CAST((SELECT sum(source_size) FROM s) AS DOUBLE) / CAST((SELECT sum(weight) FROM s) AS DOUBLE)
  UNION ALL
  SELECT step + 1,
         CAST((SELECT sum(source_size) FROM s) - (SELECT coalesce(sum(cap), 0) FROM s WHERE cap < level * weight) AS DOUBLE)
         / CAST((SELECT sum(weight) FROM s WHERE cap >= level * weight) AS DOUBLE)
  FROM fill WHERE step < (SELECT count(*) FROM s)
), p AS (
  SELECT source, source_size, CASE WHEN cap < level * weight THEN CAST(cap AS DOUBLE) ELSE level * weight END AS target
  FROM s, (SELECT level FROM fill ORDER BY step DESC LIMIT 1)
), q AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM p
), r AS (
  SELECT *, CAST(floor(target - whole * source_size + 0.5) AS BIGINT) AS rest FROM q
), o AS (
  SELECT doc_id, source, size,
         coalesce(sum(size) OVER (PARTITION BY source ORDER BY u, doc_id, size
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used
  FROM d
)
SELECT o.doc_id, o.size, r.source_size, r.target,
       CAST(r.whole * o.size + greatest(0, least(o.size, r.rest - o.used)) AS BIGINT) AS taken
FROM o JOIN r ON o.source IS NOT DISTINCT FROM r.source
"""
