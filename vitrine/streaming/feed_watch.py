"""Run the batch pipeline for every complete feed drop that lands.

A drop is a folder under ``landing_dir`` holding the nine feed files plus a
``READY`` marker written last. A Structured Streaming file source watches
the markers; each micro-batch runs one pipeline batch per new drop, oldest
first. The stream's checkpoint (under the warehouse root) records which markers
were processed, and finished drops are marked one by one, so a restarted job
skips none and repeats only a drop whose own run did not finish. ``available_now=True`` processes everything new and stops, which is how
a daily scheduler would call it; ``False`` keeps watching.

Only marker paths (one short row per drop) reach the driver; feed data is
read by the pipeline's own distributed jobs.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.plans.pipeline import Pipeline, RunOptions

MARKER = "READY"  # names starting with "_" or "." are hidden from file sources


def drop_markers(spark: SparkSession, landing_dir: str) -> DataFrame:
    """Streaming DataFrame of new drop folders (one row per marker file)."""
    markers = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("pathGlobFilter", MARKER)
        .option("recursiveFileLookup", "true")
        .load(landing_dir)
    )
    return markers.select(
        F.regexp_replace("path", f"/{MARKER}$", "").alias("drop_dir"), F.col("modificationTime").alias("landed_at")
    )


def watch_feeds(
    spark: SparkSession,
    landing_dir: str,
    warehouse_root: str,
    checkpoint_location: str | None = None,
    options: RunOptions | None = None,
    available_now: bool = True,
    triggered_by: str = "FEED_WATCH",
):
    """Start the watcher; returns the StreamingQuery (already finished when ``available_now``)."""
    pipeline = Pipeline(spark, warehouse_root, options)
    location = checkpoint_location or f"{warehouse_root.rstrip('/')}/_feed_watch"
    done = f"{warehouse_root.rstrip('/')}/_claims/drop"

    def run_drops(batch: DataFrame, epoch_id: int) -> None:
        drops = [r.drop_dir for r in batch.orderBy("landed_at", "drop_dir").collect()]
        for d in drops:
            mark = f"{done}/{hashlib.sha256(d.encode()).hexdigest()}"
            if not pipeline.wh.fs.exists(mark):  # a repeated micro-batch skips the drops it finished
                pipeline.run_pipeline(triggered_by=triggered_by, feeds_dir=d)
                pipeline.wh.fs.claim(mark)

    writer = drop_markers(spark, landing_dir).writeStream.foreachBatch(run_drops).option(
        "checkpointLocation", location
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    query = writer.start()
    if available_now:
        query.awaitTermination()
    return query
