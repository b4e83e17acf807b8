"""A corpus pipeline over ``documents``: five stages, each one operator of the llm subpackage.

quality (drops what the classifier rejects) -> exact dedup (one of equal texts)
-> near dedup (one of each SimHash component) -> mixing (whole copies of each
document as the source targets ask) -> BPE coding. Each stage works on all rows
its predecessor kept; its result is written as Parquet in the shared folder and
read again as the next stage's documents. All but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.llm import op1_simhash, op7_mixing, op8_exact_dedup, op9_bpe, op10_quality
from vitrine.llm.common import written


ROLES = ("doc_id", "text", "lang", "source")


def aside(docs: DataFrame) -> DataFrame:
    """``docs`` with its other columns renamed, so that none shares its name with an operator's result."""
    return docs.toDF(*[c if c in ROLES else f"__other{i}" for i, c in enumerate(docs.columns)])


def back(result: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` under their own names."""
    return result.select(*aside(docs).columns).toDF(*docs.columns)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    scored = op10_quality.quality(aside(docs), labels, op10_quality.learnable(F.col("id")))
    return back(scored.where("predicted = 1"), docs)


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row that stays of each group of equal texts."""
    return back(op8_exact_dedup.exact_dedup(aside(docs)).where("kept"), docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of fingerprints within two bits."""
    return back(op1_simhash.near_dedup(aside(docs)).where("stays"), docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, in whole copies; without a copy it goes."""
    mixed = op7_mixing.mix_sources(aside(docs))
    copies = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size") + 0.5)).otherwise(0).cast("int")
    taken = mixed.withColumn("copies", copies).where("copies > 0")
    return back(taken.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))), docs)


def coding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (little-endian uint32) of every document, with digests of the ids and of the decoded text."""
    import public_tokenizers

    coded = op9_bpe.encode_decode(docs, public_tokenizers.path("word_bpe_49k.json"), ["doc_id", "lang", "source"])
    return coded.select(
        "doc_id",
        "lang",
        "source",
        "n_tokens",
        "token_ids",
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality", quality_stage),
    ("exact_dedup", exact_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("mixing", mixing_stage),
    ("bpe", coding_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"pipeline-{name}")
    return docs


#: The first stage is a fitted classifier, which SQL cannot express; tests/llm compares run() with a plain version.
ORACLE_SQL = None
