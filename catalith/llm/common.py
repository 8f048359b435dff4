"""What several operators share: columns, digests, bounded numbering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A word is a run of characters other than the six ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The table ``documents``, only the named columns."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(*columns)


def digest(text: Column) -> Column:
    """128-bit digest of a text; a missing text counts as empty."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, or with underscores in front, so that it clashes with no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted
