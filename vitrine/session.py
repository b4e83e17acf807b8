"""Spark session settings for the pipeline.

The same settings are meant for a cluster: adaptive execution re-plans joins
and partition counts from runtime sizes (a join side is broadcast only when
its measured size is under the threshold), and skewed shuffle partitions are
split. Cluster-specific sizes (shuffle partitions, executor memory, the
checkpoint folder) come from the cluster's own configuration; only when a
setting is absent (tests, a laptop) is a local default used.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None, app: str = "vitrine") -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in SETTINGS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting must point at shared storage and is used as is:
    executors and driver would not see each other's local folders, so a
    missing setting is an error there. Only a local session (tests, a laptop)
    gets a fresh local folder.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if not re.match(r"local($|\[)", master):
            raise RuntimeError(f"spark.checkpoint.dir must name shared storage on {master}")
        d = tempfile.mkdtemp(prefix="vitrine-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", d)
        except Exception:  # a core (non-SQL) setting may be read-only at runtime
            pass
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A folder for intermediate tables under the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/vitrine/{name}-{os.getpid()}-{next(_counter)}-{uuid.uuid4().hex[:12]}"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of a write or count are deleted as it ends.

    Otherwise they stay on the executors' disks until the driver collects the
    plan, which a driver with little to do puts off for many jobs. A frame made
    inside that is run twice does its shuffles again, so a result that is handed
    out is better made outside.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def _count():
    n = 0
    while True:
        n += 1
        yield n


_counter = _count()
