"""Sharding by histogram sort (DataFrame functions only).

Rows are ordered by (hash of the text, hash of the id, salt), so equal texts lie
side by side; only rows equal in text and id depend on where they are stored.
Rows are written once with their number, which the salt comes from. Splitters are
found by counting exact bytes below candidate keys: each round spreads probes
over the key interval that still holds a wanted splitter, one distributed pass
adds up the bytes between probes (partial sums before the exchange), and the
interval shrinks to the part that holds the target. A target is done when a
probe meets the tolerance or the interval holds one group of equal texts small
enough to stay whole; a group beyond that is refined further by the id hash.
Only then rows are exchanged, once, to their shard.

Per round at most ``shards * probes`` sums come to the driver, whatever the
input. Slots are numbered in parallel: a shard is cut into ranges of the id
hash (a range that repeated ids overfill also by the salt), rows are numbered
inside each, and counts of the earlier ranges are added.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitrine.llm.common import Input, documents, written

BITS = 62  # hashes are cut to 62 bits, so key arithmetic never overflows
LEVELS = ("g", "d", "e")  # hashes of text and id, salt of the row
PROBES = 65_536  # probes of all splitters together, per round


def _hash(col: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(col), 64 - BITS)


@dataclass(frozen=True)
class Interval:
    """Keys lo..hi (ends included) of column ``LEVELS[level]``, inside the one key ``group`` of the columns before it."""

    level: int
    group: tuple[int, ...]
    lo: int
    hi: int
    below: int  # exact bytes before lo


def _pick(cases: list[tuple[Column, Column]]) -> Column:
    out = F.when(*cases[0])
    for cond, value in cases[1:]:
        out = out.when(cond, value)
    return out


def _count(keys: DataFrame, parts: list[Interval], probes: int) -> dict[Interval, list[tuple]]:
    """For each interval the non-empty probe cells in order: (bytes, least key, greatest key)."""
    which, cell, key = [], [], []
    for i, p in enumerate(parts):
        name = LEVELS[p.level]
        col = F.col(name)
        inside = col.between(p.lo, p.hi)
        for c, at in zip(LEVELS, p.group):
            inside = inside & (F.col(c) == at)
        width = (p.hi - p.lo) // probes + 1
        which.append((inside, F.lit(i)))
        cell.append((inside, F.expr(f"({name} - {p.lo}L) div {width}L")))
        key.append((inside, col))
    sums = (
        keys.select(_pick(which).alias("part"), _pick(cell).alias("cell"), _pick(key).alias("key"), "size")
        .where(F.col("part").isNotNull())
        .groupBy("part", "cell")
        .agg(F.sum("size").alias("bytes"), F.min("key").alias("least"), F.max("key").alias("most"))
    )
    out: dict[Interval, list[tuple]] = {p: [] for p in parts}
    for r in sorted(sums.collect(), key=lambda r: (r["part"], r["cell"])):  # at most PROBES rows
        out[parts[r["part"]]].append((r["bytes"], r["least"], r["most"]))
    return out


def splitters(
    keys: DataFrame, shards: int, tolerance: float = 0.001, group_tolerance: float = 0.01
) -> list[tuple[int, int, int]]:
    """``shards - 1`` ascending keys (g, d, e): a row belongs right of a splitter if its key is not below it."""
    total, lo, hi = keys.agg(F.sum("size"), F.min("g"), F.max("g")).first()
    if total is None or shards < 2:
        return []
    share = total / shards
    near, whole = tolerance * share, group_tolerance * share
    start = Interval(0, (), lo, hi, 0)
    open_ = {k: start for k in range(1, shards)}
    done: dict[int, tuple[int, int, int]] = {}
    while open_:
        parts = list(dict.fromkeys(open_.values()))
        cells = _count(keys, parts, max(4, min(256, PROBES // len(parts))))
        for k, p in list(open_.items()):
            target, below = k * share, p.below
            for n_bytes, least, most in cells[p]:
                if below + n_bytes >= target:
                    break
                below += n_bytes
            before, after = target - below, below + n_bytes - target
            single = least == most
            if min(before, after) <= near or (single and (p.level == len(LEVELS) - 1 or n_bytes <= whole)):
                at = least if before <= after else most + 1
                done[k] = (*p.group, at, -1, -1)[: len(LEVELS)]
                del open_[k]
            elif single:
                open_[k] = Interval(p.level + 1, (*p.group, least), 0, (1 << BITS) - 1, below)
            else:
                open_[k] = Interval(p.level, p.group, least, most, below)
    out, last = [], (-1,) * len(LEVELS)
    for k in range(1, shards):
        last = max(last, done[k])
        out.append(last)
    return out


def shard_of(cuts: list[tuple[int, int, int]]) -> Column:
    """Binary decision over the splitters: log2(shards) comparisons a row."""

    def tree(lo: int, hi: int) -> Column:  # the shard is in lo..hi
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi + 1) // 2
        g, d, e = cuts[mid - 1]
        inner = (F.col("d") > d) | ((F.col("d") == d) & (F.col("e") >= e))
        right = (F.col("g") > g) | ((F.col("g") == g) & inner)
        return F.when(right, tree(mid, hi)).otherwise(tree(lo, mid - 1))

    return tree(0, len(cuts))


def histogram_shards(
    docs: DataFrame,
    shards: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    tolerance: float = 0.001,
    group_tolerance: float = 0.01,
    rows_per_range: int = 65_536,
) -> DataFrame:
    """All rows of ``docs`` plus size, text_crc32, law, shard, slot, grown_shard (law ``bytes``).

    size is the UTF-8 bytes of the text plus 8; a null text has no bytes
    (CRC 0). Shards have near equal bytes: each splitter is within
    ``tolerance`` of a shard's share, or as near as one row allows; equal texts
    stay in one shard unless they straddle a splitter and hold more than
    ``group_tolerance`` of a share. Rows equal in text and id are split the same
    way. Slots follow the id hash, a fixed shuffle of the shard. An
    empty table gives an empty result; empty shards may occur if there are
    fewer rows than shards.
    """
    src = Input(docs, id=id_col, text=text_col)
    raw = F.coalesce(src["text"], F.lit("")).cast("binary")
    base = written(
        src.df.select(
            "*",
            (F.octet_length(raw).cast("long") + 8).alias("size"),
            F.crc32(raw).alias("crc"),
            _hash(src["text"]).alias("g"),
            _hash(src["id"]).alias("d"),
            F.monotonically_increasing_id().alias("rid"),
        ),
        "op4-rows",
    ).withColumn("e", _hash(F.col("rid")))
    keys = base.select("g", "d", "e", "size")
    cuts = splitters(keys, shards, tolerance, group_tolerance)
    ranges = max(1, -(-keys.count() // (shards * rows_per_range)))
    place = [shard_of(cuts).alias("shard"), F.expr(f"d div {(1 << BITS) // ranges + 1}L").alias("range")]
    loads = keys.select(*place).groupBy("shard", "range").count().where(F.col("count") > 4 * rows_per_range)
    full = loads.select("shard", "range", F.ceil(F.col("count") / rows_per_range).alias("parts"))

    def parted(df: DataFrame) -> DataFrame:
        part = F.expr(f"e div ({1 << BITS}L div parts + 1)")
        return df.join(full, ["shard", "range"], "left").withColumn("part", F.coalesce(part, F.lit(0).cast("long")))

    counts = parted(keys.select("e", *place)).groupBy("shard", "range", "part").count()
    before = Window.partitionBy("shard").orderBy("range", "part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "shard", "range", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).cast("long").alias("offset")
    )
    order = Window.partitionBy("shard", "range", "part").orderBy("d", "g", "crc", "rid")
    placed = (
        parted(base.select("*", *place))
        .withColumn("nth", F.row_number().over(order))
        .join(offsets, ["shard", "range", "part"])
    )
    return src.restore(
        placed,
        {
            "size": "size",
            "text_crc32": "crc",
            "law": F.lit("bytes"),
            "shard": F.col("shard").cast("int"),
            "slot": F.col("offset") + F.col("nth") - 1,
            "grown_shard": F.lit(None).cast("int"),
        },
    )


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return histogram_shards(documents(spark, sf_dir, "doc_id", "text"), 24).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )
