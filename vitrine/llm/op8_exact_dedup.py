"""Exact dedup with an extendible-hash index on shared files (DataFrame functions only).

1. Every row gets a row id, the 64-bit address and the SHA-256 of its
   normalised text; rows are written once to the shared folder.
2. Directory: the load of a bucket is the bytes of the distinct texts under it
   (copies count once). The directory starts with as many address bits as the
   total load asks for and doubles as long as a bucket is overfull and holds
   more than one address; each slot points to the bucket of the smallest local
   depth that fits. So a bucket fits, or is one address.
3. Owners: the directory routes the texts of every address that occurs more than
   once to its bucket. There texts of one address form a chain and are compared
   by their bytes (the grouping key holds the whole text); copies are combined
   before the exchange, so a group of any size costs one row a task. A text whose
   address occurs once is not moved at all when the repeated addresses are few
   enough to be sent to the tasks (checked), and once otherwise.
4. The index pages (bucket, address, digest, row that stays, group size) are
   written by owners of contiguous bucket ranges, sorted by bucket and address.
5. Rows find their bucket through the directory and look up their address and
   digest in it. A row without an entry is alone. Rows do not move if the index
   is small enough to be sent to the tasks (checked); else the columns asked for
   move once.

No step holds a bucket or a group in memory, and nothing but a few scalars goes
to the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.llm.common import Input, documents, written

#: Runs of white space that are not already one plain space.
RUNS = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """Each run of ASCII white space as one space; null as the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), RUNS, " ")


#: Repeated addresses, and index pages, of up to this many bytes in all are broadcast.
BROADCAST_BYTES = 32 << 20
ENTRY_BYTES = 128  # of an index entry with a short id


def directory(addresses: DataFrame, bucket_bytes: int) -> tuple[DataFrame, int]:
    """(slot, bucket, depth) for the occupied ones of ``2**g`` slots of the top ``g`` address bits, and ``g``.

    ``addresses``: distinct (address, bytes). A bucket is named by its first
    slot and its depth. Starting at the depth the total load asks for, each
    doubling adds a bit until every bucket fits or holds one address (64 bits
    tell all addresses apart, so this ends); a bucket keeps the smallest depth.
    """
    total = addresses.agg(F.sum("bytes")).first()[0] or 0
    first = max(0, math.ceil(math.log2(max(1.0, total / bucket_bytes))))
    g = first
    fits = (F.col("load") <= bucket_bytes) | (F.col("keys") == 1)
    while True:
        slots = addresses.groupBy(slot(F.col("address"), g).alias("slot")).agg(
            F.sum("bytes").alias("load"), F.count("*").alias("keys")
        )
        if slots.where(~fits).isEmpty():
            break
        g += 1
    slots = written(slots, "op8-slots")
    at_depth = slots.withColumn("depth", F.explode(F.sequence(F.lit(first), F.lit(g)))).withColumn(
        "bucket", F.expr(f"shiftleft(shiftrightunsigned(slot, {g} - depth), {g} - depth)")
    )
    roomy = (
        at_depth.groupBy("depth", "bucket").agg(F.sum("load").alias("load"), F.sum("keys").alias("keys")).where(fits)
    )
    chosen = (
        at_depth.join(roomy.select("depth", "bucket"), ["depth", "bucket"], "left_semi")
        .groupBy("slot")
        .agg(F.min("depth").alias("depth"))
        .withColumn("bucket", F.expr(f"shiftleft(shiftrightunsigned(slot, {g} - depth), {g} - depth)"))
    )
    return written(chosen, "op8-directory"), g


def slot(address: Column, bits: int) -> Column:
    """The top ``bits`` bits of an address."""
    return F.shiftrightunsigned(address, 64 - bits) if bits else address * 0


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    bucket_bytes: int = 64 << 20,
) -> DataFrame:
    """All rows of ``docs`` plus keep_id, group_size, kept, text_sha256.

    Null text counts as the empty text. Of equal texts the row with the
    smallest id stays; a null id comes after all others (keep_id is null only
    if every id of the group is), and of repeated rows with that id exactly
    one stays. An empty table gives an empty result.
    """
    src = Input(docs, id=id_col, text=text_col)
    norm = normalised(src["text"])
    rows = written(
        src.df.select(
            "*",
            F.monotonically_increasing_id().alias("rid"),
            F.xxhash64(norm).alias("address"),
            F.unhex(F.sha2(norm.cast("binary"), 256)).alias("digest"),
            F.octet_length(norm).cast("long").alias("n_bytes"),
        ),
        "op8-rows",
    )
    texts = written(
        rows.groupBy("address", "digest").agg(F.count("*").alias("n"), F.max("n_bytes").alias("bytes")), "op8-texts"
    )
    addresses = texts.groupBy("address").agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes"))
    slots, bits = directory(addresses, bucket_bytes)

    def routed(df: DataFrame) -> DataFrame:
        """With the bucket that the directory gives for the address."""
        return df.withColumn("slot", slot(F.col("address"), bits)).join(slots.select("slot", "bucket"), "slot").drop("slot")

    repeated = written(routed(addresses.where("n > 1").select("address")), "op8-repeated")
    few = repeated.count() * 16 <= BROADCAST_BYTES
    chained = rows.select("address", "digest", norm.alias("norm"), src["id"].alias("id"), "rid").join(
        F.broadcast(repeated) if few else repeated, "address"
    )
    chains = (
        chained.groupBy("bucket", "address", "digest", "norm")
        .agg(
            F.min("id").alias("keep_id"),
            F.coalesce(F.min_by("rid", "id"), F.min("rid")).alias("keep_rid"),
            F.count("*").alias("group_size"),
        )
        .drop("norm")
    )
    index = written(
        chains.repartitionByRange("bucket", "address").sortWithinPartitions("bucket", "address"), "op8-index"
    )
    small = index.count() * ENTRY_BYTES <= BROADCAST_BYTES  # then rows, and the texts with them, stay where they are
    found = routed(rows).join(F.broadcast(index) if small else index, ["bucket", "address", "digest"], "left")
    alone = F.col("group_size").isNull()
    return src.restore(
        found,
        {
            "keep_id": F.when(alone, src["id"]).otherwise(F.col("keep_id")),
            "group_size": F.coalesce("group_size", F.lit(1).cast("long")),
            "kept": alone | (F.col("rid") == F.col("keep_rid")),
            "text_sha256": F.lower(F.hex("digest")),
        },
    )


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir, "doc_id", "text")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256"
    )


SQL = r"""
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY norm) AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER (PARTITION BY norm ORDER BY doc_id NULLS LAST) = 1 AS kept,
       sha256(norm) AS text_sha256
FROM t
"""
