"""Family aggregates, counts and robust ranges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalith import values
from catalith.functions import vehicle
from catalith.functions.extract import parse_rivals
from catalith.functions.text import strip, text
from catalith.operators.lookup import first_filled
from catalith.operators.ranks import median, order_statistics


def family_rivals(
    df: DataFrame, key: str, rivals: str, order: str, limit: int = values.RIVAL_LIMIT
) -> DataFrame:
    """Per family the first distinct rivals in row order, as an array.

    Names are thinned to one row each before they meet in a family, and ranked
    before they are collected, so the collected array never exceeds ``limit``.
    """
    named = (
        df.select(key, F.col(order).alias("_order"), F.posexplode(
            parse_rivals(F.col(rivals))).alias("_pos", "_rival"))
        .groupBy(key, F.lower(F.col("_rival.name")).alias("_name"))
        .agg(F.min(F.struct("_order", "_pos", "_rival")).alias("_first"))
    )
    place = Window.partitionBy(key).orderBy("_first._order", "_first._pos")
    kept = named.withColumn("_rank", F.row_number().over(place)).where(F.col("_rank") <= limit)
    gathered = kept.groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct("_rank", "_first._rival"))).alias("_list")
    )
    return gathered.select(
        key, F.transform("_list", lambda x: x["_rival"]).alias("rivals")
    )


def family_body(df: DataFrame, key: str, body: str, length: Column, order: str) -> DataFrame:
    """First body text, median length, rule label and whether the family is ambiguous."""
    # every family once, with its first body; the medians only where lengths exist
    bodies = df.groupBy(key).agg(
        first_filled(F.col(body), F.col(order)).alias("raw_body")
    )
    lengths = median(df.select(key, length.alias("_length")), [key], "_length", "median_length")
    out = bodies.join(lengths, key, "left")
    label = vehicle.body_label(F.col("raw_body"), F.col("median_length"))
    out = out.withColumn("rule_label", F.coalesce(label, F.lit("")))
    long_hatch = F.col("rule_label").contains("hatchback") & (
        F.coalesce(F.col("median_length"), F.lit(0.0)) >= values.LONG_HATCHBACK_MM
    )
    vague = F.lower(F.col("raw_body")).isin(*values.VAGUE_BODIES)
    return out.withColumn("ambiguous", (F.col("rule_label") == "") | long_hatch | vague)


def value_counts(df: DataFrame, column: Column, top: int | None = None) -> DataFrame:
    """value, n and share in percent, most frequent first."""
    counts = df.groupBy(column.alias("value")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    out = counts.withColumn("share", F.round(F.col("n") * 100.0 / total, 4)).orderBy(
        F.desc("n"), "value"
    )
    return out.limit(top) if top else out


def status_summary(df: DataFrame, status: Column, labels: dict[str, Sequence[str]]) -> DataFrame:
    """Row counts per named status group and the success share in percent."""
    total = F.count(F.lit(1))
    counts = [F.count_if(status.isin(*v)).alias(k) for k, v in labels.items()]
    out = df.agg(total.alias("total"), *counts)
    share = F.round(F.col("success") * 100.0 / F.nullif(F.col("total"), F.lit(0)), 4)
    return out.withColumn("success_percent", share)


def robust_range(
    df: DataFrame, key: str, price: Column, floor: float = values.PRICE_FLOOR,
    trim_from: int = values.TRIM_FROM,
) -> DataFrame:
    """Range of the distinct prices, a tenth trimmed off both ends of larger samples."""
    usable = df.select(key, price.alias("_price")).where(F.col("_price") >= floor)
    stats = order_statistics(usable, [key], "_price", {
        "min_price": lambda n: F.when(n >= trim_from, F.floor(n / 10) + 1).otherwise(1),
        "max_price": lambda n: F.when(n >= trim_from, F.floor((n * 9 + 9) / 10)).otherwise(n),
    }, distinct=True)
    return stats.select(
        key, "min_price", "max_price",
        F.lit(values.DEFAULT_CONFIDENCE).alias("confidence"),
        F.concat(F.lit("sample n="), F.col("n").cast("string")).alias("notes"),
    )


def coverage(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing cells per column and rows with at least one filled column."""
    filled = {c: strip(text(F.col(c))) != "" for c in columns}
    some = F.lit(False)
    for flag in filled.values():
        some = some | flag
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(~flag).alias(f"{c}_missing") for c, flag in filled.items()],
        F.count_if(some).alias("any_filled"),
    )
