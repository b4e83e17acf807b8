"""Key summaries: no key is missed, partitions that cannot hold one stay closed."""

from pyspark.sql import functions as F
from star_cases import SF_SMALL

from vitrine.operators import facts as FT
from vitrine.operators import key_summary as KS
from vitrine.plans.pipeline import Pipeline, RunOptions
from vitrine.sources import fixtures as FX

KEYS = ["order_id", "order_item_id"]


def history(spark, path, batches=10, each=400):
    rows = spark.range(batches * each).select(
        F.sha2(F.col("id").cast("string"), 256).alias("order_id"),
        (F.col("id") % 3).alias("order_item_id"),
        (F.col("id") / each).cast("long").alias("etl_batch_id"),
    )
    nulls = rows.where("etl_batch_id = 3").limit(5).withColumn("order_id", F.lit(None).cast("string"))
    rows.unionAll(nulls).unionAll(rows.where("etl_batch_id = 4")).write.partitionBy("etl_batch_id").parquet(path)
    return spark.read.schema("order_id string, order_item_id bigint, etl_batch_id bigint").parquet(path)


def test_every_key_is_found_and_few_foreign_ones(spark, tmp_root):
    loaded = history(spark, f"{tmp_root}/h")
    summary = KS.summarise(loaded, KEYS).cache()
    for b in (0, 3, 9):
        assert b in KS.batches_with(loaded.where(F.col("etl_batch_id") == b), summary, KEYS)
    for row in loaded.where("order_id is not null").orderBy("order_id").limit(3).collect():
        one = spark.createDataFrame([(row[0], int(row[1]))], "order_id string, order_item_id int")  # other integer type
        assert KS.batches_with(one, summary, KEYS) == [row[2]]
    foreign = spark.range(2000).select(F.sha2(F.concat(F.lit("x"), "id"), 256).alias("order_id"), F.lit(0).alias("order_item_id"))
    assert len(KS.batches_with(foreign, summary, KEYS)) <= 2
    nothing = spark.createDataFrame([(None, 1), ("a", None)], "order_id string, order_item_id long")
    assert KS.batches_with(nothing, summary, KEYS) == []
    assert KS.batches_with(loaded.limit(0), summary, KEYS) == []
    assert KS.summarise(loaded.limit(0), KEYS).count() == 0
    assert KS.batches_with(loaded, summary.limit(0), KEYS) == []


def test_segments_grow_with_the_keys(spark):
    def keys(n):
        return spark.range(n).select(F.col("id").alias("k"), F.lit(1).cast("long").alias("etl_batch_id"))

    few, many = (KS.summarise(keys(n), ["k"]).agg(F.max("segments")).first()[0] for n in (100, 40_000))
    assert few == KS.LEAST_SEGMENTS and 40_000 * 32 / KS.SEGMENT_BITS <= many <= 2 * 40_000 * 32 / KS.SEGMENT_BITS + 1


def test_rerun_reads_one_of_many_partitions(spark, tmp_root):
    loaded = history(spark, f"{tmp_root}/h")
    summary = KS.summarise(loaded, KEYS)
    again = loaded.where("etl_batch_id = 4")
    cut = KS.possible_rows(loaded, summary, again, KEYS)
    assert {r[0] for r in cut.select("etl_batch_id").distinct().collect()} == {4}
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "etl_batch_id" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert FT.not_yet_loaded(again, cut.select(*KEYS), KEYS).count() == 0
    fresh = spark.createDataFrame([("new", 1)], "order_id string, order_item_id long")
    assert FT.not_yet_loaded(fresh, KS.possible_rows(loaded, summary, fresh, KEYS).select(*KEYS), KEYS).count() == 1
    assert KS.possible_rows(loaded, summary, fresh, KEYS, unsummarised=[7]).select("etl_batch_id").distinct().count() == 1


def test_pipeline_loads_the_same_with_summaries(spark, tmp_root):
    """A re-run adds nothing; a fact loaded before it had summaries is summarised by the next load."""
    p = Pipeline(spark, tmp_root, RunOptions(as_of=FX.FIXTURE_AS_OF, key_summaries=True))
    b = p.run_pipeline("TEST", staging=FX.staging(spark, SF_SMALL))
    tables = list(Pipeline.FACT_KEYS)
    counts = [p.wh.read(t).count() for t in tables]
    p.wh.fs.delete(p.wh.path("fact_orders_keys"))
    p.rerun_batch(b)
    assert [p.wh.read(t).count() for t in tables] == counts
    for t, keys in Pipeline.FACT_KEYS.items():
        assert KS.batches_with(p.wh.read(t), p.wh.read(f"{t}_keys"), keys) == [b]


def test_all_keys_meet_only_the_batches_not_named_yet(spark, tmp_root, monkeypatch):
    loaded = history(spark, f"{tmp_root}/h")
    summary = KS.summarise(loaded, KEYS).cache()
    asked, found = [], KS._found

    def spied(rows, left, keys):
        asked.append({r[0] for r in left.select("etl_batch_id").distinct().collect()})
        return found(rows, left, keys)

    monkeypatch.setattr(KS, "_found", spied)
    monkeypatch.setattr(KS, "EARLY_PART", 4)
    assert KS.batches_with(loaded, summary, KEYS) == list(range(10))
    assert asked == [set(range(10)), set()]
