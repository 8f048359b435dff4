"""Profiles of columns and vectors, load checks, boilerplate clearing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalith import values
from catalith.functions import vectors
from catalith.functions.extract import boilerplate
from catalith.functions.text import number


def long_form(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value) rows of the named columns."""
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
        for c in columns
    ])
    return df.select(F.inline(pairs))


def column_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: rows, null, nan text, blank, zero, negative, distinct, min, max.

    Cells are counted per (column, digest of the value) first, so the exact distinct count needs no
    per-column set, a frequent value shrinks before the shuffle, and no text is shuffled: a row there
    is a 128-bit digest, a count, the number and what kind of value it is, whatever the cell's length.
    """
    value = F.col("value")
    kind = F.when(F.lower(value) == "nan", 1).when(value == "", 2).otherwise(0)
    cells = long_form(df, columns).select(
        "column", F.unhex(F.md5(value.cast("binary"))).alias("digest"), kind.alias("kind"), number(value).alias("number"))
    counted = cells.groupBy("column", "digest").agg(
        F.count(F.lit(1)).alias("n"), F.max("kind").alias("kind"), F.max("number").alias("number"))
    num, n = F.col("number"), F.col("n")

    def rows_where(cond: Column) -> Column:
        return F.coalesce(F.sum(F.when(cond, n)), F.lit(0)).cast("bigint")

    return counted.groupBy("column").agg(
        F.sum("n").alias("rows"),
        rows_where(F.col("digest").isNull()).alias("nulls"),
        rows_where(F.col("kind") == 1).alias("nan_texts"),
        rows_where(F.col("kind") == 2).alias("blanks"),
        rows_where(num == 0).alias("zeros"),
        rows_where(num < 0).alias("negatives"),
        F.count("digest").alias("distinct_values"),
        F.min(num).alias("min_number"),
        F.max(num).alias("max_number"),
    )


def vector_profile(df: DataFrame, columns: Sequence[str], sample: int | None = None,
                   order: str | None = None) -> DataFrame:
    """Per vector column and dimension: cells, longest text, over-limit, norm, brackets.

    Cells that do not parse come under a NULL dimension.  ``sample`` looks at
    the first rows by ``order`` only.
    """
    if sample is not None:
        df = df.orderBy(order).limit(sample)
    cells = long_form(df, columns).withColumn("_v", vectors.parse(F.col("value")))
    low, high = values.NORM_RANGE
    length = vectors.norm(F.col("_v"))
    return cells.groupBy("column", F.size("_v").alias("dimension")).agg(
        F.count(F.lit(1)).alias("cells"),
        F.max(F.length("value")).alias("max_chars"),
        F.count_if(F.length("value") >= values.CELL_LIMIT).alias("over_limit"),
        F.count_if((length < low) | (length > high)).alias("off_norm"),
        F.count_if(F.col("value").startswith("[")).alias("bracketed"),
    ).withColumn("dimension", F.when(F.col("dimension") >= 0, F.col("dimension")))


def load_verify(df: DataFrame, columns: Sequence[str], dimension: int) -> DataFrame:
    """Rows, missing vectors and wrong dimensions after a load."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"{c}_missing") for c in columns],
        *[F.count_if(F.size(c) != dimension).alias(f"{c}_wrong_size") for c in columns],
    )


def clear_boilerplate(df: DataFrame, column: str, flag: str = "cleared") -> DataFrame:
    """Flagged text becomes ''; ``flag`` tells which rows were touched."""
    return df.withColumn(flag, boilerplate(F.col(column))).withColumn(
        column, F.when(F.col(flag), F.lit("")).otherwise(F.col(column))
    )
