"""Snapshot and append tables: publish only on commit, retention, appends."""

import pytest
from pyspark.sql import functions as F

from vitrine.plans.warehouse import Warehouse


def test_failed_publish_keeps_previous_version(spark, tmp_root):
    wh = Warehouse(spark, tmp_root)
    assert wh.current("agg_daily_sales", "id bigint").count() == 0  # empty before the first version
    assert wh.publish("agg_daily_sales", spark.range(3)) == 3
    boom = spark.range(5).select(
        F.when(F.col("id") == 4, F.raise_error(F.lit("refresh failed"))).otherwise(F.col("id")).alias("id")
    )
    with pytest.raises(Exception):
        wh.publish("agg_daily_sales", boom)
    assert wh.versions("agg_daily_sales") == [1]
    assert wh.current("agg_daily_sales").count() == 3  # never emptied, unlike truncate-then-insert
    assert wh.publish("agg_daily_sales", spark.range(7)) == 7
    # the failed write's number stays claimed
    assert wh.versions("agg_daily_sales") == [1, 3] and wh.current("agg_daily_sales").count() == 7
    assert wh.prune("agg_daily_sales", keep=1) == [1]
    assert wh.versions("agg_daily_sales") == [3]


def test_append_counts_and_reads(spark, tmp_root):
    wh = Warehouse(spark, tmp_root)
    rows = spark.range(4).select(F.col("id").alias("review_id").cast("string"), F.lit(3).cast("bigint").alias("etl_batch_id"))
    assert wh.append("stage_x", rows) == 4
    assert wh.append("stage_x", rows.withColumn("etl_batch_id", F.lit(4).cast("bigint"))) == 4
    got = wh.read("stage_x", "review_id string, etl_batch_id bigint")
    assert got.count() == 8 and got.filter("etl_batch_id = 4").count() == 4


def test_log_reject_appends_one_row(spark, tmp_root):
    from vitrine.plans.runlog import RunLog

    log = RunLog(Warehouse(spark, tmp_root))
    log.log_reject(5, "STG_ORDERS", "o9", "x" * 1200, raw="o9,c1")
    rows = log.wh.read("stg_rejected_records").collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.source_table, r.source_key, r.raw_data, r.etl_batch_id, r.attempt) == ("STG_ORDERS", "o9", "o9,c1", 5, 1)
    assert len(r.reject_reason) == 1000  # reason cut to 1000 characters
