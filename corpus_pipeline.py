"""From raw documents to packed training sequences: five stages, each one operator.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; its result is
written as Parquet and read again as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalith.llm import lines, mixing, neardup, packing, quality
from catalith.session import settle


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that pass the quality rules; the classifier learns from ``labels``."""
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.quality_rules(docs, model, docs.columns).where("kept").select("row.*")


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops lines that an earlier document holds; texts get shorter, all documents go on."""
    left = lines.dedup_lines(docs)
    return left.withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near copies."""
    return neardup.near_dedup(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each document as often as its source's target asks, in training order."""
    return mixing.mix(docs).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences of at most 4096 ids; one row per piece.

    The Python workers also serve the other stages, so they remember fewer words here.
    """
    return packing.pack(docs, remember=400_000).withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("quality_rules", quality_stage), ("line_dedup", line_stage), ("near_dedup", near_stage),
    ("mixing", mixing_stage), ("packing", packing_stage),
]
# The classifier, the signatures and the token ids have no SQL; tests/llm check the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
