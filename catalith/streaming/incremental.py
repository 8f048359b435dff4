"""Process only new input files and append rows not seen before.

Which keys have been written is kept beside the output, in a table of keys cut into buckets by hash
(``<output>-keys/batch_id=N/bucket=B``).  A batch reads only the buckets its own keys fall into.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalith.operators.lookup import join_lookup

BUCKETS = 256


def bucket(key: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _keys_path(path: str) -> str:
    return f"{path.rstrip('/')}-keys"


def seen_keys(rows: DataFrame, path: str, key: str, batch_id: int, touched: list[int]) -> DataFrame | None:
    """The keys that batches before this one wrote, from the touched buckets only."""
    root, kind = _keys_path(path), rows.schema[key].dataType.simpleString()
    try:
        # no file is opened to find a schema
        keys = rows.sparkSession.read.schema(f"`{key}` {kind}, batch_id int, bucket int").parquet(root)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":  # anything else is a fault, not an empty table
            raise
        return None
    return keys.where((F.col("batch_id") < batch_id) & F.col("bucket").isin(touched)).select(key)


def append_batch(
    rows: DataFrame, batch_id: int, path: str, key: str,
    transform: Callable[[DataFrame], DataFrame] = lambda df: df, buckets: int = BUCKETS,
) -> None:
    """Transform and append the rows whose key no earlier batch wrote; rows without a key always.

    Seen rows are dropped before the transform, which may be costly; what the transform drops is not seen and
    may come again.  A batch owns its folders ``batch_id=N`` of the output and of the keys and overwrites
    them, so a repeated batch leaves the same; earlier batches are left alone.  The keys are taken from the
    written output, so both always agree.  The number of buckets must stay the same for an output.
    """
    spark = rows.sparkSession
    touched = [r[0] for r in rows.select(bucket(F.col(key), buckets)).distinct().collect()]  # at most ``buckets``
    seen = seen_keys(rows, path, key, batch_id, touched)
    fresh = rows if seen is None else join_lookup(rows, seen.distinct(), [key], "left_anti", settled=False)
    out = f"{path}/batch_id={batch_id}"
    transform(fresh).write.mode("overwrite").parquet(out)
    (
        spark.read.parquet(out).select(key).where(F.col(key).isNotNull()).distinct()
        .withColumn("bucket", bucket(F.col(key), buckets)).repartition("bucket")
        .write.mode("overwrite").partitionBy("bucket").parquet(f"{_keys_path(path)}/batch_id={batch_id}"))


def resume(
    spark: SparkSession, source: str, schema, output: str, checkpoint: str, key: str,
    transform: Callable[[DataFrame], DataFrame] = lambda df: df, pattern: str = "*.parquet",
    files_per_batch: int = 1000, buckets: int = BUCKETS,
) -> None:
    """Work off all files that arrived since the last run, then stop."""
    stream = (
        spark.readStream.schema(schema).option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch).parquet(source)
    )

    def each(rows: DataFrame, batch_id: int) -> None:
        append_batch(rows, batch_id, output, key, transform, buckets)

    query = (
        stream.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
