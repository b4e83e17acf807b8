"""Records of delimited files, each as the text that was read, by splittable scans.

``lines``: one record per physical line (feeds without quoted line ends).

``quoted_records``: records may hold line ends inside quotes. A file is still
read in byte ranges by many tasks. A first pass counts the quotes of every
range; the parity of all quotes before a range, a running sum over the few rows
of ranges, says whether the range begins inside a quoted text. With that, a
second pass cuts every range into records on its own; only the piece of a record
that crosses the end of a range is grouped with its rest.

A file whose quotes do not pair leaves its last record open. Its lines are
given one by one, marked, so that no task has to hold the rest of a file.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.session import scratch_path

#: A record made of plain fields and quoted fields with doubled quotes inside; nothing else is well formed.
_FIELD = r'(?:"(?:[^"]++|"")*+"|[^",\r\n]*+)'
WELL_FORMED = rf"(?s)\A{_FIELD}(?:,{_FIELD})*+\z"


def well_formed(record: Column) -> Column:
    """Whether every quote of the record opens, closes or doubles as it should."""
    return ~F.contains(record, F.lit('"')) | record.rlike(WELL_FORMED)


def n_fields(record: Column) -> Column:
    """Number of fields of a well-formed record: commas outside quotes, plus one."""
    plain = F.when(
        F.contains(record, F.lit('"')),
        F.array_join(F.filter(F.split(record, '"', -1), lambda x, i: i % 2 == 0), ""),
    ).otherwise(record)
    return F.length(plain) - F.length(F.replace(plain, F.lit(","))) + 1


def _without_return(record: Column) -> Column:
    """The record without a carriage return at its end; the pattern is tried only where there is one."""
    return F.when(F.contains(record, F.lit("\r")), F.regexp_replace(record, "\r$", "")).otherwise(record)


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(record, open, etl_source_file): every line but each file's first (the header) and empty ones, untouched.

    Spark's own reader takes a line as one field of a delimiter that the line
    does not hold; if it does, the reader keeps the line as a corrupt record.
    """
    schema = "line string, kept string"
    df = (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", True)
        .option("sep", "\u0001")
        .option("quote", "\u0000")
        .option("escape", "\u0000")
        .option("lineSep", "\n")
        .option("maxCharsPerColumn", -1)
        .option("columnNameOfCorruptRecord", "kept")
        .csv(path)
    )
    df = df.select(F.coalesce("kept", "line").alias("record"), F.col("_metadata.file_name").alias("etl_source_file"))
    return df.select(_without_return(F.col("record")).alias("record"), F.lit(False).alias("open"), "etl_source_file")


# ------------------------------------------------------------ quoted records

# What a cut piece is: a record, its first or a further part, a line of an open one, the first part of a header.
WHOLE, BEGIN, MORE, OPEN, HEADER = 0, 1, 2, 3, 4
_CUT = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("block", T.LongType()),
        T.StructField("pos", T.LongType()),
        T.StructField("kind", T.IntegerType()),
        T.StructField("record", T.StringType()),
        T.StructField("etl_source_file", T.StringType()),
    ]
)


def _physical(spark: SparkSession, path: str) -> DataFrame:
    """(value, file, block, etl_source_file): physical lines with the byte range that reads them."""
    return spark.read.option("lineSep", "\n").text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_name").alias("etl_source_file"),
    )


def range_states(physical: DataFrame) -> DataFrame:
    """(file, block, inside, open_from): whether a range begins inside quotes; the range that holds a file's open record.

    One row per byte range: 64 bytes for every ``maxPartitionBytes`` of input.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
    ranges = physical.groupBy("file", "block").agg(
        F.sum(quotes.cast("long")).alias("quotes"), F.count_if(quotes % 2 == 1).alias("odd_lines")
    )
    of_file = Window.partitionBy("file")
    before = of_file.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    parity = F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2
    unpaired = F.sum("quotes").over(of_file) % 2 == 1
    last = F.max(F.when(F.col("odd_lines") > 0, F.col("block"))).over(of_file)
    return ranges.select("file", "block", (parity == 1).alias("inside"), F.when(unpaired, last).alias("open_from"))


class _Range:
    """Cuts the lines of one byte range into pieces, batch by batch."""

    def __init__(self, file: str, block: int, inside: bool, open_from: int | None, name: str):
        self.file, self.block, self.name = file, block, name
        self.inside, self.pos = inside, 0
        self.crossing = inside  # the record under way began in an earlier range
        self.open_from = open_from
        self.held: list[str] = []
        self.first = block == 0  # its first record is the header

    def cut(self, values: pa.Array) -> list[tuple[int, list[str]]]:
        """(kind, lines) of the pieces that end in these lines."""
        odd = np.asarray(pa.compute.count_substring(values, '"')) % 2 == 1
        texts = values.to_pylist()
        if self.open_from is not None and self.block > self.open_from:
            return [(OPEN, [t]) for t in texts]
        ends = np.cumsum(odd) % 2 == (1 if self.inside else 0)  # outside quotes at the line's end
        out = []
        for text, end in zip(texts, ends.tolist()):
            if end and not self.held and not self.crossing:
                out.append((WHOLE, [text]))
                continue
            self.held.append(text)
            if end:
                out.append((MORE if self.crossing else WHOLE, self.held))
                self.held, self.crossing = [], False
        self.inside = bool(len(ends)) and not bool(ends[-1]) if len(ends) else self.inside
        return out

    def rest(self) -> list[tuple[int, list[str]]]:
        """What the range ends with: the part of a record that goes on, or the lines of an open one."""
        if not self.held:
            return []
        held, self.held = self.held, []
        if self.open_from == self.block and not self.crossing:
            return [(OPEN, [t]) for t in held]
        return [(MORE if self.crossing else BEGIN, held)]

    def rows(self, pieces: list[tuple[int, list[str]]]) -> list[tuple]:
        made = []
        for kind, held in pieces:
            if self.first and kind in (WHOLE, BEGIN):
                self.first = False
                if kind == WHOLE:
                    continue
                kind = HEADER
            made.append((self.file, self.block, self.pos, kind, "\n".join(held), self.name))
            self.pos += 1
        return made


def _cut_ranges(batches):
    import pyarrow.compute  # noqa: F401  (pa.compute)
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(_CUT)

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)

    now = None
    for b in batches:
        file, block = b.column("file"), b.column("block")
        edges = [0, *(np.flatnonzero(np.diff(block.to_numpy(zero_copy_only=False)) != 0) + 1).tolist(), b.num_rows]
        files = file.to_pylist()
        edges = sorted({*edges, *(i for i in range(1, b.num_rows) if files[i] != files[i - 1])})
        for a, z in zip(edges, edges[1:]):
            key = (files[a], block[a].as_py())
            if now is None or (now.file, now.block) != key:
                if now and (made := now.rows(now.rest())):
                    yield batch(made)
                now = _Range(*key, b.column("inside")[a].as_py(), b.column("open_from")[a].as_py(), b.column("etl_source_file")[a].as_py())
            if made := now.rows(now.cut(b.column("value").slice(a, z - a))):
                yield batch(made)
    if now and (made := now.rows(now.rest())):
        yield batch(made)


def quoted_records(spark: SparkSession, path: str, scratch: str | None = None) -> DataFrame:
    """(record, open, etl_source_file): every record but each file's first, untouched; ``open`` marks unpaired lines.

    The states of the ranges are broadcast: one small row per byte range, so
    half a millionth of the input at 128 MB a range. The cut pieces are written
    once; the parts of crossing records are the only rows that are shuffled,
    at most two per range. ``scratch`` names the folder for the pieces, which
    the caller may delete when done with the records.
    """
    physical = _physical(spark, path)
    states = range_states(physical)
    cut = physical.join(F.broadcast(states), ["file", "block"]).select(
        "value", "file", "block", "inside", "open_from", "etl_source_file"
    )
    scratch = scratch or scratch_path(spark, "records")
    cut.mapInArrow(_cut_ranges, _CUT).write.parquet(scratch)
    pieces = spark.read.schema(_CUT).parquet(scratch)
    parts = pieces.where(F.col("kind").isin(BEGIN, MORE, HEADER))
    order = Window.partitionBy("file").orderBy("block", "pos")
    begun = F.count_if(F.col("kind") != MORE).over(order.rowsBetween(Window.unboundedPreceding, 0))
    crossing = (
        parts.withColumn("nth", begun)
        .groupBy("file", "nth")
        .agg(
            F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "pos", "record"))), lambda p: p["record"]), "\n").alias("record"),
            F.max("kind").alias("kind"),
            F.first("etl_source_file").alias("etl_source_file"),
        )
        .where(F.col("kind") != HEADER)
    )
    single = pieces.where(F.col("kind").isin(WHOLE, OPEN))
    trimmed = _without_return(F.col("record")).alias("record")
    return single.select(trimmed, (F.col("kind") == OPEN).alias("open"), "etl_source_file").where("record <> '' OR open").unionByName(
        crossing.select(trimmed, F.lit(False).alias("open"), "etl_source_file")
    )
