"""A corpus from raw documents: five stages, each written and read again as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pricewatch.llm import decontaminate, minhash, mixing, quality, sharding
from pricewatch.llm.common import crc, shared_dir, stored


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose compression score is at least a half."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.fit_on_sample(docs, labels, "quality", F.pmod(crc(F.col("_id")), F.lit(3)) != 1)
    return quality.accepted(docs, model)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group linked by five-word shingles at 0.8."""
    return minhash.deduplicated(docs, shingle_words=5, threshold=80)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words are benchmark passages."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), "documents")


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target takes it."""
    return mixing.mixed_documents(docs)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a shard of 40 and their slot in it."""
    return sharding.shard_documents(docs, shards=40)


STAGES = [
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("sharding", sharding_stage),
]

#: Compression, Newton steps and packing are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over `documents`, one after the other."""
    docs, folder = spark.read.parquet(f"{sf_dir}/documents.parquet"), shared_dir(spark)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), folder, name)
    return docs
