"""Table layer on plain Parquet folders in shared storage.

Two kinds of tables:

* **append tables** (staging, facts, rejects, logs): one folder, partitioned by
  ``etl_batch_id`` (logs: unpartitioned), written with ``mode("append")``. A
  failed append leaves no visible rows (files are committed at job end);
  re-runs are made harmless by the anti joins in the jobs.
* **snapshot tables** (dimensions, watermarks, the daily aggregate): each new
  state is written to a fresh folder ``v=<n>``; readers take the greatest
  version whose write committed (has ``_SUCCESS``). Publishing is the commit
  of the write itself, so a failed refresh leaves the previous version
  readable (no truncate-then-insert window). Old versions are kept for
  re-runs and can be pruned.

Parquet has no MERGE/UPDATE, and overwriting a folder that is being read
deletes the input first; versioned folders avoid both problems. Only folder
listings and existence checks go through the Hadoop FileSystem API, so the
same code runs on HDFS, object stores and local disks.
"""

from __future__ import annotations

import re
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from vitrine.operators.key_summary import SUMMARY
from vitrine.plans import schemas

_VERSION = re.compile(r"^v=(\d+)$")


def empty_table(spark: SparkSession, ddl: str) -> DataFrame:
    """An empty DataFrame of a DDL schema, planned in the JVM (no Python RDD)."""
    from pyspark.sql.types import _parse_datatype_string

    schema = _parse_datatype_string(ddl)
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


class FileSystem:
    """Minimal folder operations on the storage behind ``spark``."""

    def __init__(self, spark: SparkSession):
        self._spark = spark
        jvm = spark.sparkContext._jvm
        self._Path = jvm.org.apache.hadoop.fs.Path
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _fs(self, path: str):
        p = self._Path(path)
        return p, p.getFileSystem(self._conf)

    def exists(self, path: str) -> bool:
        p, fs = self._fs(path)
        return bool(fs.exists(p))

    def list_names(self, path: str) -> list[str]:
        p, fs = self._fs(path)
        if not fs.exists(p):
            return []
        return [s.getPath().getName() for s in fs.listStatus(p)]

    def claim(self, path: str) -> bool:
        """Create an empty file; False if it exists already (only one of two writers gets True)."""
        p, fs = self._fs(path)
        fs.mkdirs(p.getParent())
        try:
            fs.create(p, False).close()
        except Exception as e:
            if fs.exists(p):
                return False
            raise e
        return True

    def delete(self, path: str) -> None:
        p, fs = self._fs(path)
        if fs.exists(p):
            fs.delete(p, True)


class Warehouse:
    """The staging, warehouse and control tables under one root folder."""

    APPEND_SCHEMAS = {
        "fact_orders": schemas.FACT_ORDERS,
        "fact_order_items": schemas.FACT_ORDER_ITEMS,
        "fact_reviews": schemas.FACT_REVIEWS,
        "fact_orders_keys": SUMMARY,
        "fact_order_items_keys": SUMMARY,
        "fact_reviews_keys": SUMMARY,
        "stg_rejected_records": schemas.REJECTS,
        "etl_batch_log": schemas.BATCH_LOG,
        "etl_step_log": schemas.STEP_LOG,
    }
    SNAPSHOT_SCHEMAS = {
        "dim_customer": schemas.DIM_CUSTOMER,
        "dim_seller": schemas.DIM_SELLER,
        "dim_product": schemas.DIM_PRODUCT,
        "etl_watermark": schemas.WATERMARK,
        "stg_items_waiting": schemas.ITEMS_WAITING,
        "agg_daily_sales": None,
        "dim_date": None,
    }

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.fs = FileSystem(spark)

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    # ------------------------------------------------------------- append

    def exists(self, table: str) -> bool:
        return self.fs.exists(f"{self.path(table)}/_SUCCESS") or any(
            n.startswith("etl_batch_id=") or n.endswith(".parquet") for n in self.fs.list_names(self.path(table))
        )

    def read(self, table: str, ddl: str | None = None) -> DataFrame:
        """An append table (empty with ``ddl`` schema when it does not exist yet)."""
        ddl = ddl or self.APPEND_SCHEMAS.get(table)
        if not self.exists(table):
            if ddl is None:
                raise FileNotFoundError(self.path(table))
            return empty_table(self.spark, ddl)
        reader = self.spark.read
        if ddl is not None:
            reader = reader.schema(ddl)
        return reader.parquet(self.path(table))

    def batches(self, table: str) -> list[int]:
        """The batches an append table holds rows of, from its partition folders."""
        prefix = "etl_batch_id="
        names = [n for n in self.fs.list_names(self.path(table)) if n.startswith(prefix)]
        return sorted(int(n.removeprefix(prefix)) for n in names if n.removeprefix(prefix).lstrip("-").isdigit())

    def append(self, table: str, df: DataFrame, partition_by: str | None = "etl_batch_id") -> int:
        """Append rows; returns the number of rows written (counted during the write)."""
        obs = Observation(f"append_{table}")
        observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
        writer = observed.write.mode("append")
        if partition_by:
            writer = writer.partitionBy(partition_by)
        writer.parquet(self.path(table))
        return int(obs.get["rows"])

    def append_rejects(self, df: DataFrame, batch_id: int, attempt: int, at: str) -> int:
        """Append reject rows (table, key, reason, raw text) with an id, the attempt and the time."""
        rows = df.select(
            F.expr("uuid()").alias("reject_id"),
            "source_table",
            "source_key",
            "reject_reason",
            "raw_data",
            F.lit(attempt).cast("int").alias("attempt"),
            F.lit(at).cast("timestamp").alias("reject_dt"),
            F.lit(batch_id).cast("long").alias("etl_batch_id"),
        )
        return self.append("stg_rejected_records", rows)

    def claim_id(self, kind: str, last: int) -> int:
        """The next id above ``last`` that no other run has claimed (an exclusive create decides)."""
        n = last + 1
        while not self.fs.claim(f"{self.root}/_claims/{kind}/{n}"):
            n += 1
        return n

    # ----------------------------------------------------------- snapshot

    def versions(self, table: str) -> list[int]:
        found = []
        for name in self.fs.list_names(self.path(table)):
            m = _VERSION.match(name)
            if m and self.fs.exists(f"{self.path(table)}/{name}/_SUCCESS"):
                found.append(int(m.group(1)))
        return sorted(found)

    def current(self, table: str, ddl: str | None = None) -> DataFrame:
        """Latest published version of a snapshot table (empty if none)."""
        v = self.versions(table)
        ddl = ddl or self.SNAPSHOT_SCHEMAS.get(table)
        if not v:
            if ddl is None:
                raise FileNotFoundError(self.path(table))
            return empty_table(self.spark, ddl)
        reader = self.spark.read if ddl is None else self.spark.read.schema(ddl)
        return reader.parquet(f"{self.path(table)}/v={v[-1]:06d}")

    def publish(self, table: str, df: DataFrame) -> int:
        """Write the next version; it becomes current when the write commits.

        The version number is claimed first, so two runs never write to one
        folder; a claimed version whose write failed is simply never current.
        """
        v = self.versions(table)
        nxt = self.claim_id(f"version-{table}", v[-1] if v else 0)
        target = f"{self.path(table)}/v={nxt:06d}"
        obs = Observation(f"publish_{table}_{nxt}")
        df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("errorifexists").parquet(target)
        return int(obs.get["rows"])

    def prune(self, table: str, keep: int = 3) -> list[int]:
        """Delete all but the newest ``keep`` versions; returns the deleted ones."""
        v = self.versions(table)
        old = v[:-keep] if keep > 0 else v
        for n in old:
            self.fs.delete(f"{self.path(table)}/v={n:06d}")
        return old

    def max_value(self, df: DataFrame, col: str, default: int = 0) -> int:
        """Greatest value of a numeric column (one aggregate; a scalar to the driver)."""
        v = df.agg(F.max(col)).first()[0]
        return default if v is None else int(v)
