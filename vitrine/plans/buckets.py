"""A latest-values dimension stored by key bucket, so that a batch rewrites only the buckets of its keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.operators import dimensions as D
from vitrine.operators.keys import key_bucket
from vitrine.session import scratch_path


class BucketedDimension:
    """One Parquet folder, partitioned by ``bucket`` (a hash of the business key).

    An upsert reads and writes the buckets of the batch's keys only. The new
    buckets are first written whole to scratch and then moved in; a run that
    fails in between is simply repeated, as the upsert of the same batch gives
    the same rows.
    """

    def __init__(self, spark: SparkSession, path: str, business_key: str, key_name: str, columns: list[str], buckets: int):
        self.spark, self.path, self.buckets = spark, path, buckets
        self.business_key, self.key_name, self.columns = business_key, key_name, columns

    def _dealt(self, df: DataFrame) -> DataFrame:
        return df.withColumn("bucket", key_bucket(F.col(self.business_key), self.buckets))

    def create(self, rows: DataFrame) -> None:
        self._dealt(rows.select(*self.columns)).repartition("bucket").write.partitionBy("bucket").parquet(self.path)

    def read(self, buckets: list[int] | None = None) -> DataFrame:
        """All rows, or those of some buckets (partition pruning: other folders are not opened)."""
        df = self.spark.read.parquet(self.path)
        return (df if buckets is None else df.where(F.col("bucket").isin(buckets))).select(*self.columns)

    def touched(self, source: DataFrame) -> list[int]:
        """The buckets of the batch's keys; at most ``buckets`` numbers."""
        return sorted(r[0] for r in self._dealt(source.select(self.business_key)).select("bucket").distinct().collect())

    def upsert(self, source: DataFrame, as_of_ts: str) -> list[int]:
        """Matched rows take the source's values, new keys are inserted; returns the buckets that were rewritten.

        ``source`` is read more than once; it must be unique on the business key.
        """
        touched = self.touched(source)
        if not touched:
            return []
        start = self.read().agg(F.max(self.key_name)).first()[0] or 0
        merged = D.scd1_upsert(
            self.read(touched), source, self.business_key, self.key_name, self.columns, as_of_ts, start_key=start
        )
        scratch = scratch_path(self.spark, "upsert")
        merged = self._dealt(merged.drop("merge_action")).repartition("bucket")
        merged.write.parquet(scratch)
        whole = self.spark.read.schema(merged.schema).parquet(scratch)
        (
            whole.repartition("bucket").write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("bucket")
            .parquet(self.path)
        )
        return touched
