"""Exact order statistics per group, without gathering a group in one place.

Values are first counted per (group, value).  They fall into cells that grow with the value; the
cell totals of a group tell which cell holds a wanted rank.  A cell that still holds too many
values is cut into a thousand again, and again, so in the end only cells of bounded size are
ordered, however a group's values are spread and however large it is.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalith.session import settle

STEPS_PER_DOUBLING = 64
CUTS = 1024
BOUND = 65_536  # values that one window partition may order
Ranks = dict[str, Callable[[Column], Column]]


def bucket(value: Column) -> Column:
    """Monotone bucket number: about one percent of the value wide, whatever its size."""
    beyond = F.abs(value) == float("inf")
    finite = F.when(~beyond & (value != 0), F.abs(value))
    size = F.when(beyond, 10**9).otherwise(F.greatest(F.floor((F.log2(finite) + 1100) * STEPS_PER_DOUBLING), F.lit(0)))
    return F.when(value < 0, -size - 1).when(value > 0, size + 1).otherwise(0)


def _wanted(ranks: Ranks, start: Column, end: Column) -> Column:
    needed = F.lit(False)
    for rank in ranks.values():
        r = rank(F.col("n"))
        needed = needed | ((r > start) & (r <= end))
    return needed


def _cells(counted: DataFrame, keys: Sequence[str], ranks: Ranks, first: bool) -> DataFrame:
    """keys, n, _start, _low, _high, _values of the cells that hold a wanted rank.

    ``counted`` has its rows' cell in ``_cell``; beyond the first round also the cell they come from
    (``_from``), where that starts (``_base``) and ``n``.  The windows run over cells, of which there are
    at most some thousands, not over values.
    """
    parent = [] if first else ["_from", "_base", "n"]
    totals = counted.groupBy(*keys, *parent, "_cell").agg(
        F.sum("_w").alias("_total"), F.count(F.lit(1)).alias("_values"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
    whole = Window.partitionBy(*keys, *parent[:1])
    if first:
        totals = totals.withColumn("n", F.sum("_total").over(whole)).withColumn("_base", F.lit(0).cast("bigint"))
    up_to = whole.orderBy("_cell").rowsBetween(Window.unboundedPreceding, 0)
    placed = totals.withColumn("_end", F.col("_base") + F.sum("_total").over(up_to)).withColumn(
        "_start", F.col("_end") - F.col("_total"))
    return settle(
        placed.where(_wanted(ranks, F.col("_start"), F.col("_end"))).select(*keys, "n", "_start", "_low", "_high", "_values"),
        "rank-cells")


def _inside(counted: DataFrame, cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The counted values of some cells; both sides are written, so a hot group's values can be split."""
    return counted.join(cells, list(keys)).where(F.col("_v").between(F.col("_low"), F.col("_high")))


def rank_cells(counted: DataFrame, keys: Sequence[str], ranks: Ranks, bound: int = BOUND) -> DataFrame:
    """The cells that hold the wanted ranks, none with more than ``bound`` values.

    Each round divides the span of a cell by a thousand.  A cell spans one percent of its values at first, so some
    six rounds part any two doubles.
    """
    cells = _cells(counted.withColumn("_cell", bucket(F.col("_v"))), keys, ranks, first=True)
    done = cells.where(F.col("_values") <= bound)
    while not (large := cells.where(F.col("_values") > bound)).isEmpty():
        share = (F.col("_v") - F.col("_low")) / (F.col("_high") - F.col("_low"))
        cut = _inside(counted, large, keys).select(
            *keys, "_w", "_v", "n", F.col("_low").alias("_from"), F.col("_start").alias("_base"),
            F.least(F.floor(share * CUTS), F.lit(CUTS - 1)).alias("_cell"))
        cells = _cells(cut, keys, ranks, first=False)
        done = done.unionByName(cells.where(F.col("_values") <= bound))
    return done


def count_values(rows: DataFrame, keys: Sequence[str], value: str, distinct: bool) -> DataFrame:
    """keys, _v and its weight _w; NULL and NaN are ignored."""
    narrow = rows.where(F.col(value).isNotNull() & ~F.isnan(value)).select(
        *keys, F.col(value).cast("double").alias("_v"))
    counted = narrow.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_w"))
    return counted.withColumn("_w", F.lit(1).cast("bigint")) if distinct else counted


def order_statistics(
    rows: DataFrame, keys: Sequence[str], value: str, ranks: Ranks, distinct: bool = False, bound: int = BOUND,
) -> DataFrame:
    """keys, n and one column per wanted rank (1-based, a function of n).

    ``distinct`` ranks each value once; otherwise equal values count apart.
    NULL and NaN are ignored; a group with nothing else does not appear.  A result has the value's type.
    """
    keys, kind = list(keys), rows.schema[value].dataType
    counted = settle(count_values(rows, keys, value, distinct), "counted-values")
    cells = rank_cells(counted, keys, ranks, bound)
    inside = Window.partitionBy(*keys, "_low").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        _inside(counted, cells, keys)
        .withColumn("_to", F.col("_start") + F.sum("_w").over(inside))
        .withColumn("_from", F.col("_to") - F.col("_w"))
    )
    picks = []
    for name, rank in ranks.items():
        r = rank(F.col("n"))
        here = (r > F.col("_from")) & (r <= F.col("_to"))
        picks.append(F.max(F.when(here, F.col("_v"))).cast(kind).alias(name))
    return placed.groupBy(*keys).agg(F.max("n").alias("n"), *picks)


def median(rows: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """Interpolated median per group."""
    stats = order_statistics(rows, keys, value, {
        "_lower": lambda n: F.floor((n + 1) / 2),
        "_upper": lambda n: F.floor(n / 2) + 1,
    })
    return stats.select(*keys, ((F.col("_lower") + F.col("_upper")) / 2).alias(out))
