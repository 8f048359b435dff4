"""Token counts of texts with a stored cache of counts by content and tokenizer."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalith.llm.common import documents
from catalith.llm.tokens import counts
from catalith.session import settle, shared_folder

CACHE = "digest binary, version string, n_tokens bigint"


def tokenizer_version(name: str) -> str:
    """Digest of a tokenizer's file and of the library that reads it."""
    if name.endswith(".model"):
        import sentencepiece as library
    else:
        import tokenizers as library
    with open(public_tokenizers.path(name), "rb") as file:
        content = hashlib.sha256(file.read()).hexdigest()
    return f"{library.__name__}-{library.__version__}-{content}"


def open_cache(spark: SparkSession, path: str) -> None:
    """Make the folder a readable cache; what is there stays."""
    spark.createDataFrame([], CACHE).write.mode("append").parquet(path)


def _counter(name: str):
    schema = pa.schema([("digest", pa.binary()), ("n_tokens", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(at, 200) for at in range(0, batch.num_rows, 200)):
                found = counts(name, part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(pa.binary()), pa.array(found, pa.int64())], schema=schema)

    return count


def token_counts(
    docs: DataFrame, cache_path: str, tokenizer: str = "piece_bpe_32k.model",
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Bytes and tokens of each whole text; every distinct text is encoded once and remembered.

    Contents are compared by the SHA-256 of their UTF-8 bytes (a missing text is empty; no other
    normalising is safe, as any change of a text may change its tokens) together with the
    tokenizer's version.  Only contents without a stored count are encoded, one row of each, and
    appended to the cache at ``cache_path``, which later runs may share.

    Gives id_col, n_bytes, n_tokens.  Repeated rows each get a row, a missing id stays missing, an
    empty table gives no rows and adds nothing, other columns are not read.  A group of copies
    sends one (digest, id) row per task to the search for misses, and never meets in one task with
    its texts.
    """
    spark, version = docs.sparkSession, tokenizer_version(tokenizer)
    open_cache(spark, cache_path)
    stored = (
        spark.read.schema(CACHE).parquet(cache_path).where(F.col("version") == version)
        .groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")))
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("id"), text.alias("text"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"))
    keyed = settle(rows.select("id", F.octet_length("text").cast("bigint").alias("n_bytes"), "digest"), "text-digests")
    picked = F.coalesce(F.col("id").cast("string"), F.lit(""))
    misses = (
        keyed.groupBy("digest").agg(F.min(picked).alias("pick"))
        .join(stored, "digest", "left_anti"))
    texts = (
        rows.withColumn("pick", picked).join(misses, ["digest", "pick"], "left_semi").select("digest", "text"))
    (
        texts.mapInArrow(_counter(tokenizer), "digest binary, n_tokens bigint")
        .groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
        .select("digest", F.lit(version).alias("version"), "n_tokens")
        .write.mode("append").parquet(cache_path))
    spark.catalog.refreshByPath(cache_path)
    known = (
        spark.read.schema(CACHE).parquet(cache_path).where(F.col("version") == version)
        .groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")))
    return keyed.join(known, "digest", "left").select(F.col("id").alias(id_col), "n_bytes", "n_tokens")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document by the 32k piece model, with a fresh cache."""
    counted = token_counts(documents(spark, sf_dir, "doc_id", "text"), shared_folder(spark, "token-cache"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 4096)
