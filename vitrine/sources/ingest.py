"""Load the nine delimited feeds into batch-partitioned staging tables.

Per feed: one splittable scan takes the records apart from the line ends
(``records.py``); every record is parsed beside its untouched text and tagged
with a reject reason (quotes that don't pair, too many fields, overlong text,
non-integer number) or none; that tagged result is written once to a scratch
folder in the shared checkpoint area, then split with two columnar reads into
the staging table (partition ``etl_batch_id=<b>``, replaced on a re-run) and the
reject table, which keeps a rejected record as it was read.

Short rows are padded with NULLs; the header line is skipped, and so are empty
lines: loaded + rejected is the number of other records. An empty feed loads
zero rows and replaces the batch's partition like any other. With an
``error_limit``, more rejects than that fail the feed before anything is
published; by default there is none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.functions import columns as C
from vitrine.functions import lookups as L
from vitrine.session import scratch_path
from vitrine.sources import records as R
from vitrine.sources.feeds import FEEDS, LOAD_ORDER, Feed, Staging


class TooManyRejects(RuntimeError):
    pass


def read_feed_text(spark: SparkSession, feed: Feed, path: str, scratch: str | None = None) -> DataFrame:
    """All columns as text, with the source file name, the record as it was read (``_raw``) and what is wrong with
    its form (``_form``): quotes that don't pair, or more fields than the feed has (``L.REJECT_LONG_ROW``)."""
    records = R.quoted_records(spark, path, scratch) if feed.multiline else R.lines(spark, path)
    options = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "maxCharsPerColumn": "-1"}
    record = F.col("record")
    form = (
        F.when(F.col("open"), L.REJECT_OPEN_QUOTE)
        .when(~R.well_formed(record), L.REJECT_QUOTES)
        .when(R.n_fields(record) > len(feed.columns), L.REJECT_LONG_ROW)
    )
    parsed = records.select(
        F.from_csv(record, feed.csv_schema().toDDL(), options).alias("f"), "etl_source_file", record.alias("_raw"), form.alias("_form")
    )
    # Fields come out of a generator: a filter on them stays above it, so that a record is parsed once and not once
    # for every check of a moved filter.
    return parsed.select(F.inline(F.array("f")), "etl_source_file", "_raw", "_form")


def _reason(feed: Feed) -> Column:
    checks = []
    for c in feed.columns:
        if c.kind == "string" and c.width:
            checks.append(F.when(F.length(c.name) > c.width, F.lit(f"Value too long for {c.name.upper()}")))
        elif c.kind in ("long", "int"):
            typ = "bigint" if c.kind == "long" else "int"
            bad = F.col(c.name).isNotNull() & F.trim(c.name).try_cast(typ).isNull()
            checks.append(F.when(bad, F.lit(f"Invalid number in {c.name.upper()}")))
    return F.coalesce(*checks) if checks else F.lit(None).cast("string")


def tag_rows(text: DataFrame, feed: Feed, batch_id: int, load_ts: str, long_rows: str = "load") -> DataFrame:
    """Typed staging columns plus ``_reject_reason`` and the record as it was read (``_raw``).

    ``long_rows``: a row with more fields than the feed has is loaded without
    them (``load``, as the source does) or rejected (``reject``).
    """
    if long_rows not in ("load", "reject"):
        raise ValueError(f"long_rows must be 'load' or 'reject', not {long_rows!r}")
    form = F.col("_form") if long_rows == "reject" else F.when(F.col("_form") != L.REJECT_LONG_ROW, F.col("_form"))
    typed = []
    for c in feed.columns:
        if c.kind == "string":
            typed.append(F.col(c.name))
        else:
            typ = "bigint" if c.kind == "long" else "int"
            typed.append(F.trim(c.name).try_cast(typ).alias(c.name))
    return text.select(
        *typed,
        F.lit(batch_id).cast("long").alias("etl_batch_id"),
        F.lit(load_ts).cast("timestamp").alias("etl_insert_dt"),
        "etl_source_file",
        F.coalesce(form, _reason(feed)).alias("_reject_reason"),
        "_raw",
    )


def _key(feed: Feed) -> Column:
    parts = []
    for i, k in enumerate(feed.key):
        if i:
            parts.append(F.lit("-"))
        parts.append(F.coalesce(F.col(k).cast("string"), F.lit("")))
    return F.concat(*parts)


def ingest_feed(
    wh,
    feed: Feed,
    path: str,
    batch_id: int,
    load_ts: str,
    error_limit: int | None = None,
    long_rows: str = "load",
) -> tuple[int, int]:
    """Load one feed file (or folder) into ``stg_<feed>``; returns (loaded, rejected)."""
    spark = wh.spark
    scratch = scratch_path(spark, f"ingest-{feed.name}-{batch_id}")
    pieces = scratch_path(spark, f"records-{feed.name}-{batch_id}")
    text = read_feed_text(spark, feed, path, pieces)
    tag_rows(text, feed, batch_id, load_ts, long_rows).write.mode("overwrite").parquet(scratch)
    wh.fs.delete(pieces)
    tagged = spark.read.parquet(scratch)
    bad = tagged.filter(F.col("_reject_reason").isNotNull())
    rejected = bad.count()
    if error_limit is not None and rejected > error_limit:
        raise TooManyRejects(f"{feed.file_name}: {rejected} rejected rows > limit {error_limit}")
    if rejected:
        wh.append_rejects(
            bad.select(
                F.lit(feed.table.upper()).alias("source_table"),
                _key(feed).alias("source_key"),
                F.col("_reject_reason").alias("reject_reason"),
                F.col("_raw").alias("raw_data"),
            ),
            batch_id,
            1,
            load_ts,
        )
    good = tagged.filter(F.col("_reject_reason").isNull()).drop("_reject_reason", "_raw")
    loaded = write_staging(wh, feed.name, good, batch_id)
    wh.fs.delete(scratch)
    return loaded, rejected


def write_staging(wh, name: str, df: DataFrame, batch_id: int) -> int:
    """Replace this batch's partition of ``stg_<name>`` as a whole, also by nothing (other batches are kept)."""
    feed = FEEDS[name]
    cols = [f.name for f in feed.staging_schema().fields if f.name != "etl_batch_id"]
    from pyspark.sql import Observation

    obs = Observation(f"stage_{name}")
    (
        df.select(*cols)
        .observe(obs, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .parquet(f"{wh.path(feed.table)}/etl_batch_id={batch_id}")
    )
    return int(obs.get["rows"])


def ingest_all(
    wh, feeds_dir: str, batch_id: int, load_ts: str, error_limit: int | None = None, long_rows: str = "load"
) -> dict:
    """Load all nine feeds of ``feeds_dir`` in the fixed load order."""
    out = {}
    for feed in LOAD_ORDER:
        out[feed.name] = ingest_feed(wh, feed, f"{feeds_dir.rstrip('/')}/{feed.file_name}", batch_id, load_ts,
                                     error_limit, long_rows)
    return out


def _no_blanks(df: DataFrame, feed: Feed) -> DataFrame:
    """Empty text as NULL, as the CSV reader gives it."""
    return df.withColumns({c.name: C.blank_to_null(c.name) for c in feed.columns if c.kind == "string"})


def stage_batch(wh, stg: Staging, batch_id: int) -> dict[str, int]:
    """Write already-typed staging DataFrames (e.g. the test views) as batch ``batch_id``."""
    out = {}
    for name, df in stg.tables().items():
        out[name] = write_staging(wh, name, _no_blanks(df, FEEDS[name]), batch_id)
    return out


def claim_batch_zero(wh, batch_id: int) -> dict[str, int]:
    """Rows that an outside loader staged with batch 0 become batch ``batch_id``; a feed without any is empty."""
    out = {}
    for name, feed in FEEDS.items():
        zero = f"{wh.path(feed.table)}/etl_batch_id=0"
        schema = feed.staging_schema()
        cols = [f for f in schema.fields if f.name != "etl_batch_id"]
        kept = type(schema)(cols)
        df = wh.spark.read.schema(kept).parquet(zero) if wh.fs.exists(zero) else wh.spark.createDataFrame([], kept)
        out[name] = write_staging(wh, name, _no_blanks(df, feed), batch_id)
        wh.fs.delete(zero)
    return out


def read_staging(wh, batch_id: int | None = None) -> Staging:
    """The nine staging tables, pruned to one batch partition when given."""
    tables = {}
    for name, feed in FEEDS.items():
        path = wh.path(feed.table)
        if not wh.fs.exists(path):
            raise FileNotFoundError(f"staging table {feed.table} is missing")
        df = wh.spark.read.schema(feed.staging_schema()).parquet(path)
        if batch_id is not None:
            if not wh.fs.exists(f"{path}/etl_batch_id={batch_id}"):
                raise FileNotFoundError(f"staging partition {feed.table}/etl_batch_id={batch_id} is missing")
            df = df.filter(F.col("etl_batch_id") == F.lit(batch_id).cast("long"))
        tables[name] = df
    return Staging(**tables)


def tag_staging_batch(df: DataFrame, batch_id: int) -> DataFrame:
    """Rows loaded with batch 0 by an outside loader take the run's batch id."""
    return df.withColumn(
        "etl_batch_id", F.when(F.col("etl_batch_id") == 0, F.lit(batch_id).cast("long")).otherwise(F.col("etl_batch_id"))
    )


def record_text(feed: Feed) -> Column:
    """A row as one record: quotes around text that holds a comma, a quote or a line end; NULL as nothing."""

    def field(c) -> Column:
        text = F.col(c.name).cast("string")
        if c.kind != "string":  # digits need no quotes
            return F.coalesce(text, F.lit(""))
        quoted = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
        special = text.contains('"') | text.contains(",") | text.contains("\r") | text.contains("\n")
        return F.coalesce(F.when(special, quoted).otherwise(text), F.lit(""))

    return F.concat_ws(",", *[field(c) for c in feed.columns])


def export_records(records: DataFrame, feed: Feed, path: str) -> None:
    """Write records (column ``record``) as they are, as a delimited feed with a header line in every file."""
    header = F.array(F.lit(",".join(c.name for c in feed.columns)))
    in_part = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))  # number of the row within its file
    text = F.when(~F.contains("record", F.lit("\n")), F.array("record")).otherwise(F.split("record", "\n", -1))
    physical = records.select(in_part.alias("nth"), "record").select(
        F.explode(F.when(F.col("nth") == 0, F.concat(header, text)).otherwise(text)).alias("value")
    )
    physical.write.text(path)


def export_feeds(stg: Staging, feeds_dir: str) -> None:
    """Write staging tables out as the nine delimited feeds (header, quoted)."""
    for feed in LOAD_ORDER:
        df = getattr(stg, feed.name).select(*[c.name for c in feed.columns])
        (
            df.write.mode("overwrite")
            .option("header", True)
            .option("quote", '"')
            .option("escape", '"')
            .csv(f"{feeds_dir.rstrip('/')}/{feed.file_name}")
        )
