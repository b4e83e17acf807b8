"""SimHash near-dedup with pigeonring filtering.

A fingerprint's 64 bits are cut into max_bits + 1 segments arranged in a ring. If
two fingerprints differ in at most max_bits bits, then for some start segment
every chain of consecutive segments from it stays within its proportional
budget: one segment differs in no bit, two together in at most
2 * max_bits / segments, and so on round the ring. So candidates are pairs equal
in a start segment (an equi-join on segment number and value) whose longer
chains keep their budgets; only those reach the full Hamming check.

Copies (equal fingerprints) are one entry throughout. Blocks of a segment value
with more than ``pair_block`` entries don't list their pairs: every entry names
all values within one bit of it outside the start segment, and entries that name
the same value hang on the least of them. Two entries share a value exactly if
they differ in at most two bits, and at most 65 can share one, so the links of a
block of any size are found in linear space and none is lost. Components of the
links come from repeated star contraction over written tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.llm.common import Input, documents, map_texts, written
from vitrine.llm.components import components
from vitrine.llm.simhash import fingerprinter


#: Linked fingerprints of up to this many bytes in all are broadcast to the rows; rows of no other have no entry.
BROADCAST_BYTES = 32 << 20
ENTRY_BYTES = 64


def segments(count: int) -> list[tuple[int, int]]:
    """(first bit, bits) of each segment of the ring."""
    sizes = [64 // count + (i < 64 % count) for i in range(count)]
    return [(sum(sizes[:i]), n) for i, n in enumerate(sizes)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def chain_fits(difference: Column, start: int, max_bits: int, ring: list[tuple[int, int]]) -> Column:
    """Whether all chains from ``start`` keep their budgets; the chain round the whole ring is the Hamming check."""
    fits, mask = F.lit(True), 0
    for length in range(1, len(ring) + 1):
        first, bits = ring[(start + length - 1) % len(ring)]
        mask |= ((1 << bits) - 1) << first
        budget = length * max_bits // len(ring)
        fits = fits & (F.bit_count(difference.bitwiseAND(F.lit(_signed(mask)))) <= budget)
    return fits


def links(prints: DataFrame, max_bits: int, pair_block: int) -> DataFrame:
    """Edges (a, b) between distinct fingerprints ``fp`` that join all within ``max_bits`` (0 to 2) of each other."""
    ring = segments(max_bits + 1)
    parts = F.array(
        *[
            F.struct(
                F.lit(i).alias("start"),
                F.shiftrightunsigned("fp", first).bitwiseAND(F.lit(_signed((1 << bits) - 1))).alias("value"),
            )
            for i, (first, bits) in enumerate(ring)
        ]
    )
    entries = prints.select("fp", F.inline(parts))
    sizes = entries.groupBy("start", "value").agg(F.count("*").alias("n")).where("n > 1")
    blocks = written(entries.join(sizes, ["start", "value"]), "op1-blocks")

    few = blocks.where(F.col("n") <= pair_block)
    a, b = few.alias("a"), few.alias("b")
    same = (F.col("a.start") == F.col("b.start")) & (F.col("a.value") == F.col("b.value"))
    fits = F.lit(False)
    for i in range(len(ring)):
        fits = F.when(F.col("a.start") == i, chain_fits(F.col("a.fp").bitwiseXOR(F.col("b.fp")), i, max_bits, ring)).otherwise(fits)
    pairs = a.join(b, same & (F.col("a.fp") < F.col("b.fp")) & fits).select(
        F.col("a.fp").alias("a"), F.col("b.fp").alias("b")
    )

    flips = [0] + [1 << k for k in range(64)]
    outside = F.when(F.lit(False), F.array(F.lit(0).cast("long")))
    for i, (first, bits) in enumerate(ring):
        own = ((1 << bits) - 1) << first
        values = F.array(*[F.lit(_signed(f)).cast("long") for f in flips if not f & own])
        outside = outside.when(F.col("start") == i, values)
    named = (
        blocks.where(F.col("n") > pair_block)
        .select("fp", F.explode(outside).alias("flip"))
        .select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("near"))
        .distinct()
    )
    sharing = Window.partitionBy("near")  # at most 65 rows
    if max_bits == 2:
        centre = F.min("fp").over(sharing)
    else:  # one bit apart: only the fingerprint that is the named value itself
        centre = F.max(F.when(F.col("fp") == F.col("near"), F.col("fp"))).over(sharing)
    stars = named.withColumn("centre", centre).where("centre <> fp").select(F.col("fp").alias("a"), F.col("centre").alias("b"))
    return pairs.union(stars)


def near_dedup(
    docs: DataFrame,
    keep: list[str] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 3,
    max_bits: int = 2,
    pair_block: int = 64,
) -> DataFrame:
    """``keep`` columns (default: all) plus fingerprint (16 hex digits), component_id and stays.

    Rows whose fingerprints differ in at most ``max_bits`` (1 or 2) bits are
    linked; component_id is the smallest id reachable, a null id counting for
    nothing (null only if no id of the component is set); stays marks one row of
    each component, one with that id. Null texts and texts
    without words have fingerprint zero and are linked like any other. Equal
    texts and repeated rows share a component. An empty table gives an empty
    result.
    """
    if max_bits not in (1, 2):
        raise ValueError("max_bits must be 1 or 2")
    keep = docs.columns if keep is None else keep
    roles = {f"k{i}": k for i, k in enumerate(keep)}
    src = Input(docs, id=id_col, text=text_col, **roles)
    inner = list(dict.fromkeys([src.name("id"), *[src.name(r) for r in roles]]))
    fields = [T.StructField("fp", T.LongType())]
    printed = map_texts(src.df, src.name("text"), inner, fields, lambda: fingerprinter(width))
    rows = written(printed.withColumn("rid", F.monotonically_increasing_id()), "op1-prints")

    def first_row(row_id: str, doc_id: str) -> Column:
        return F.coalesce(F.min_by(row_id, doc_id), F.min(row_id)).alias("first")

    by_print = rows.groupBy("fp").agg(
        F.min(src.name("id")).alias("least"), first_row("rid", src.name("id")), F.count("*").alias("n")
    )
    prints = written(by_print, "op1-distinct")
    roots = components(links(prints.select("fp"), max_bits, pair_block), "a", "b").withColumnRenamed("node", "fp")
    rooted = prints.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"), first_row("first", "least"), F.sum("n").alias("n"))
    linked = rooted.select("fp", "root").join(least.where("n > 1"), "root").select("fp", "component_id", "first")
    linked = written(linked, "op1-linked")
    few = linked.count() * ENTRY_BYTES <= BROADCAST_BYTES  # then the rows stay where they are
    out = rows.join(F.broadcast(linked) if few else linked, "fp", "left")
    alone = F.col("first").isNull()
    results = {"fingerprint", "component_id", "stays"}
    return out.select(
        *[src[r].alias(k) for r, k in roles.items() if k.lower() not in results],
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(alone, src["id"]).otherwise(F.col("component_id")).alias("component_id"),
        (alone | (F.col("rid") == F.col("first"))).alias("stays"),
    )


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(documents(spark, sf_dir, "doc_id", "text"), keep=["doc_id"])
