"""Key summaries of loaded batches: the re-run guard opens only the partitions that can hold a key of the batch.

A summary is a blocked Bloom filter beside a key range. A batch's keys are dealt
by hash over segments of 32,768 bits (Spark's bitmap functions); every key sets
``HASHES`` bits of its segment. The number of segments is a power of two that
grows with the batch's keys, so the share of false positives stays the same and
a lookup needs one probe a size in use (a few dozen at most), not one a batch.
False positives only open a partition too many: the guard then compares keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEGMENT_BITS = 1 << 15
HASHES = 8
EARLY_PART = 1024  # one in so many keys is probed before the others
LEAST_SEGMENTS = 16  # so that probes of many small batches are spread over tasks
SUMMARY = "segments bigint, segment bigint, low string, high string, bits binary, etl_batch_id bigint"


def _hashed(rows: DataFrame, keys: list[str], *others: str) -> DataFrame:
    """Distinct (others, h, first): a key's hash and its first part as text. A NULL key equals nothing and is left out."""
    texts = [F.col(k).cast("string") for k in keys]
    rows = rows.dropna(subset=keys).select(*others, F.xxhash64(*texts).alias("h"), texts[0].alias("first"))
    return rows.distinct()  # a repeated key is one row before it is shuffled


def _positions() -> Column:
    """The bits of a key in its segment, by hashes other than the one that picks the segment."""
    return F.array(*[F.pmod(F.xxhash64("h", F.lit(i)), F.lit(SEGMENT_BITS)) for i in range(HASHES)])


def _is_set(bits: Column, position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, F.floor(position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    mask = F.element_at(F.array(*[F.lit(1 << i) for i in range(8)]), (position % 8).cast("int") + 1)
    return byte.bitwiseAND(mask) != 0


def summarise(rows: DataFrame, keys: list[str], bits_per_key: int = 32) -> DataFrame:
    """Summary rows (``SUMMARY``) of the keys of every ``etl_batch_id`` in ``rows``.

    A key takes ``bits_per_key`` to twice as many bits: at 32, fewer than one
    in 100,000 foreign keys looks like a key of the batch. ``rows`` is read
    twice. Empty input gives no row.
    """
    sizes = rows.dropna(subset=keys).groupBy("etl_batch_id").agg(F.count(F.lit(1)).alias("n"))
    wanted = F.greatest(F.col("n") * bits_per_key / SEGMENT_BITS, F.lit(float(LEAST_SEGMENTS)))
    sizes = sizes.select("etl_batch_id", F.pow(F.lit(2), F.ceil(F.log2(wanted))).cast("long").alias("segments"))
    dealt = _hashed(rows, keys, "etl_batch_id").join(F.broadcast(sizes), "etl_batch_id")  # one row per batch
    dealt = dealt.withColumn("segment", F.pmod("h", "segments"))
    # Keys meet in their segment first: partial bitmaps of 4 KB a segment and task would be larger than the keys.
    dealt = dealt.repartition("etl_batch_id", "segment").withColumn("position", F.explode(_positions()))
    return dealt.groupBy("etl_batch_id", "segment", "segments").agg(
        F.min("first").alias("low"), F.max("first").alias("high"), F.bitmap_construct_agg("position").alias("bits")
    ).select("segments", "segment", "low", "high", "bits", "etl_batch_id")


def batches_with(rows: DataFrame, summary: DataFrame, keys: list[str]) -> list[int]:
    """The summarised batches that can hold a key of ``rows``; at most as many numbers as there are batches.

    One key is enough to name a batch, so a small part of the keys goes first,
    and all keys then meet the summaries of the batches that it did not name.
    """
    early = _found(rows.where(F.pmod(F.xxhash64(*keys), F.lit(EARLY_PART)) == 0), summary, keys)
    return sorted(early + _found(rows, summary.where(~F.col("etl_batch_id").isin(early)) if early else summary, keys))


def _found(rows: DataFrame, summary: DataFrame, keys: list[str]) -> list[int]:
    sizes = [r[0] for r in summary.select("segments").distinct().collect()]  # powers of two
    if not sizes:
        return []
    probes = _hashed(rows, keys).withColumn("segments", F.explode(F.array(*[F.lit(s).cast("long") for s in sizes])))
    probes = probes.withColumn("segment", F.pmod("h", "segments")).withColumn("positions", _positions())
    held = F.col("first").between(F.col("low"), F.col("high"))
    for i in range(HASHES):
        held = held & _is_set(F.col("bits"), F.get("positions", F.lit(i)))
    found = probes.join(summary, ["segments", "segment"]).where(held)
    return [r[0] for r in found.select("etl_batch_id").distinct().collect()]


def possible_rows(
    loaded: DataFrame, summary: DataFrame, rows: DataFrame, keys: list[str], unsummarised: list[int] | None = None
) -> DataFrame:
    """``loaded`` cut to the batches that can hold a key of ``rows`` (partition pruning: other folders are not opened).

    Batches without a summary must be named; they are always opened.
    """
    opened = batches_with(rows, summary, keys) + list(unsummarised or [])
    return loaded.where(F.col("etl_batch_id").isin(opened) if opened else F.lit(False))
