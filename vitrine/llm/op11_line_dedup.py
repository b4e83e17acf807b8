"""Line dedup with levelled sorted runs of line hashes (DataFrame functions only).

1. Every row gets a row id, the marks of its lines (first half of the SHA-256
   of a line's key, null where the key is too short to count) and a batch
   number; rows are written once to the shared folder.
2. The store holds *runs*: tables (mark, n) of the distinct marks of one or
   more batches with the number of documents that hold them, bucketed and
   sorted by mark. A new batch is reduced to (mark, n) with one exchange, which
   is the bucketing of the runs; it merge-anti-joins every run, which takes out
   the marks that a run alone shows to be frequent (their fate is settled), and
   adds what is left as a run of level 0.
3. When a level holds two runs, a merge join of their buckets compacts them
   into one run of the next level, without an exchange; so a mark is rewritten
   a logarithmic number of times and a batch meets a logarithmic number of runs.
4. At the end the levels are compacted into one run; the frequent marks are
   those whose counts reach the threshold.
   Lines look their mark up: marks that hold more than a two-thousandth of a
   batch are few by that very bound and are broadcast, all others meet the
   lines in a join on the mark, whose groups are small.
5. A row's dropped line numbers, in order, cut its lines into the slices that
   stay.

Copies of a line cost one row a task before any exchange; no step holds a line
group, and only batch sizes and folder names are on the driver. Marks have 128
bits: two different lines of 10^12 share one with a chance under 10^-14.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.llm.common import Input, documents, written
from vitrine.session import scratch_path

#: ASCII white space that a line's key loses at both ends.
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A mark with more than this share of a batch's (document, mark) pairs is heavy: at most as many per batch.
HEAVY = 2000


def line_keys(text: Column) -> Column:
    """The keys of a text's lines, in order: A-Z lower-cased, ASCII white space stripped at both ends."""
    lines = F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), "\n", -1)
    return F.transform(lines, lambda line: F.btrim(line, F.lit(BLANKS)))


def marks(text: Column, min_chars: int) -> Column:
    """A mark per line as 32 hex digits; null where the key has fewer than ``min_chars`` code points."""

    def mark(key: Column) -> Column:
        return F.when(F.char_length(key) >= min_chars, F.substring(F.sha2(key.cast("binary"), 256), 1, 32))

    return F.transform(line_keys(text), mark)


class LineRuns:
    """Levelled sorted runs of (mark, n): the distinct line marks of the batches so far and their documents.

    Each batch counts a document once, so a document must come in one batch
    only. ``levels`` names the run tables; it is all the state besides the
    tables themselves, which lie in the shared folder.
    """

    def __init__(self, spark: SparkSession, threshold: int):
        self.spark, self.threshold = spark, threshold
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []

    def _write(self, run: DataFrame, level: int) -> None:
        name = f"line_run_{uuid.uuid4().hex}"
        (
            run.write.option("compression", "zstd")
            .option("path", scratch_path(self.spark, f"op11-run-{level}"))
            .bucketBy(self.buckets, "mark")
            .sortBy("mark")
            .saveAsTable(name)
        )
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)

    def _runs(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def _merged(self, one: str, two: str) -> DataFrame:
        """Both runs as one: a merge join of their buckets, without an exchange."""
        a, b = (self.spark.table(t).select(F.col("mark").alias(f"mark_{k}"), F.col("n").alias(f"n_{k}")) for k, t in (("a", one), ("b", two)))
        both = a.join(b, F.col("mark_a") == F.col("mark_b"), "full_outer")
        n = F.coalesce("n_a", F.lit(0)) + F.coalesce("n_b", F.lit(0))
        return both.select(F.coalesce("mark_a", "mark_b").alias("mark"), n.alias("n"))

    def _drop(self, names: list[str]) -> None:
        from vitrine.plans.warehouse import FileSystem

        for name in names:
            where = self.spark.sql(f"DESCRIBE EXTENDED {name}").where("col_name = 'Location'").first()["data_type"]
            self.spark.sql(f"DROP TABLE {name}")
            FileSystem(self.spark).delete(where)

    def add(self, batch: DataFrame, pairs: int) -> None:
        """Add the marks (``batch``: one row per document and mark, ``pairs`` rows in all) as a run of level 0.

        Marks that a run shows to be frequent are settled and left out, but for
        the heavy ones of this batch, whose counts the lookup needs.
        """
        counts = batch.groupBy("mark").agg(F.count("*").alias("n"))
        heavy = F.col("n") > F.lit(pairs // HEAVY)
        for name in self._runs():
            settled = self.spark.table(name).where(F.col("n") >= self.threshold).select(F.col("mark").alias("known"))
            counts = counts.join(settled, (F.col("mark") == F.col("known")) & ~heavy, "left_anti")
        self._write(counts, 0)
        self._compact()

    def _compact(self) -> None:
        """Merge the two runs of a level into one of the next, from level 0 on."""
        for level in range(len(self.levels)):
            if len(names := self.levels[level]) == 2:
                self.levels[level] = []
                self._write(self._merged(*names), level + 1)
                self._drop(names)

    def merged(self) -> DataFrame:
        """(mark, n) of all batches so far: the levels compacted into one run, which stays for further batches."""
        names = self._runs()
        while len(names) > 1:  # the smallest first
            one, two = names[:2]
            top = max(k for k, level in enumerate(self.levels) if one in level or two in level)
            self.levels = [[n for n in level if n not in (one, two)] for level in self.levels]
            self._write(self._merged(one, two), top)
            self._drop([one, two])
            names = self._runs()
        if not names:
            return self.spark.range(0).select(F.lit(None).cast("binary").alias("mark"), F.lit(0).cast("long").alias("n"))
        return self.spark.table(names[0])

    def drop(self) -> None:
        self._drop(self._runs())
        self.levels = []


def line_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_docs: int = 10,
    min_chars: int = 1,
    batches: int = 6,
) -> DataFrame:
    """All rows of ``docs`` plus n_lines (before dropping), n_dropped, kept_text.

    A line goes, in every document, if its key (ASCII white space stripped at
    both ends, A-Z lower-cased) has at least ``min_chars`` code points and is
    found in at least ``min_docs`` documents. Every row counts as a document,
    also a repeated one or one without id; a line that a document repeats
    counts once for it. Null text is one empty line, as is the empty text; a
    document that loses all lines keeps the empty text. An empty table gives an
    empty result. Rows are dealt to ``batches`` by a hash of their row id; the
    result does not depend on it.
    """
    spark, src = docs.sparkSession, Input(docs, id=id_col, text=text_col)
    rows = written(
        src.df.select("*", F.monotonically_increasing_id().alias("rid"), marks(src["text"], min_chars).alias("marks")),
        "op11-rows",
    )
    of_row = F.pmod(F.xxhash64("rid"), F.lit(batches))
    sets = rows.select(of_row.alias("batch"), F.array_distinct(F.array_compact("marks")).alias("marks"))
    sizes = {r["batch"]: r["pairs"] for r in sets.groupBy("batch").agg(F.sum(F.size("marks")).alias("pairs")).collect()}
    runs, pairs = LineRuns(spark, min_docs), []
    for b in sorted(sizes):
        one = sets.where(F.col("batch") == b).select(F.explode("marks").alias("hex"))
        runs.add(one.select(F.unhex("hex").alias("mark")), sizes[b])
        pairs.append(sizes[b])
    merged = runs.merged()
    # At most HEAVY marks can hold more than a HEAVY-th of all pairs.
    heavy = written(merged.where(F.col("n") > sum(pairs) // HEAVY), "op11-heavy")
    light = written(merged.where((F.col("n") <= sum(pairs) // HEAVY) & (F.col("n") >= min_docs)), "op11-frequent")
    runs.drop()
    lines = rows.select("rid", F.posexplode("marks").alias("pos", "hex")).where("hex IS NOT NULL")
    lines = lines.select("rid", "pos", F.unhex("hex").alias("mark"))
    lines = lines.join(F.broadcast(heavy), "mark", "left")
    often = lines.where(F.col("n") >= min_docs).select("rid", "pos")
    hits = often.union(lines.where("n IS NULL").join(light.select("mark"), "mark").select("rid", "pos"))
    dropped = hits.groupBy("rid").agg(F.sort_array(F.collect_list("pos")).alias("gone"))
    found = rows.drop("marks").join(dropped, "rid", "left")
    all_lines = F.split(F.coalesce(src["text"], F.lit("")), "\n", -1)
    found = found.withColumn("lines", all_lines).withColumn("gone", F.coalesce("gone", F.array().cast("array<int>")))
    return src.restore(
        found,
        {
            "n_lines": F.size("lines").cast("long"),
            "n_dropped": F.size("gone").cast("long"),
            "kept_text": F.array_join(kept("lines", "gone"), "\n"),
        },
    )


def kept(lines: str, gone: str) -> Column:
    """The elements of ``lines`` but those at the ascending positions ``gone`` (from 0): the slices between them."""
    ends = F.concat(F.col(gone), F.array(F.size(lines)))

    def between(end: Column, i: Column) -> Column:
        start = F.when(i == 0, 0).otherwise(F.get(F.col(gone), i - 1) + 1)
        return F.slice(F.col(lines), start + 1, end - start)

    return F.when(F.size(gone) == 0, F.col(lines)).otherwise(F.flatten(F.transform(ends, between)))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup(documents(spark, sf_dir, "doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


SQL = r"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT rid, generate_subscripts(lines, 1) AS pos, unnest(lines) AS line FROM t),
k AS (
  SELECT rid, pos, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
),
f AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT rid) >= 10),
m AS (SELECT k.rid, k.pos, k.line, f.key IS NOT NULL AS gone FROM k LEFT JOIN f ON k.key = f.key),
s AS (
  SELECT rid, count(*) FILTER (WHERE gone) AS n_dropped,
    coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS kept FROM m GROUP BY rid
)
SELECT doc_id, len(lines) AS n_lines, n_dropped, sha256(kept) AS kept_sha256 FROM t JOIN s USING (rid)
"""
