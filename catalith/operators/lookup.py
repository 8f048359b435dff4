"""Pick functions per key, and the joins that bring picks back to rows.

Every pick is a min_by/max_by with an explicit order column, so partial results
combine before the shuffle and a hot key costs one row per task.  The joins
carry no broadcast hint: ``join_lookup`` lets the optimizer decide by the
measured size of the lookup.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalith.functions.extract import boilerplate
from catalith.functions.text import norm, norm_years, strip, text
from catalith.session import settle


def is_filled(col: Column) -> Column:
    return strip(text(col)) != ""


def first_filled(value: Column, order: Column) -> Column:
    """Aggregate: first non-blank value in order, else ''."""
    return F.coalesce(F.min_by(value, F.when(is_filled(value), order)), F.lit(""))


def first_values(df: DataFrame, keys: Sequence[str], columns: Sequence[str], order: str) -> DataFrame:
    """Per key the first non-null value of each column on its own."""
    picks = [
        F.min_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in columns
    ]
    return df.groupBy(*keys).agg(*picks)


def first_rows(df: DataFrame, keys: Sequence[str], columns: Sequence[str], order: str) -> DataFrame:
    """Per key the first row, whole."""
    row = F.min_by(F.struct(*columns), F.col(order)).alias("_row")
    return df.groupBy(*keys).agg(row).select(*keys, "_row.*")


def best_text(
    value: Column, order: Column, is_boilerplate: Callable[[Column], Column] = boilerplate
) -> Column:
    """Aggregate: longest clean text, else longest text, else ''; ties go to the first."""
    rank = F.struct(~is_boilerplate(value), F.length(strip(value)), -order)
    return F.coalesce(F.max_by(value, F.when(is_filled(value), rank)), F.lit(""))


def _wide(x: Column | int) -> Column:
    return (F.lit(Decimal(x)) if isinstance(x, int) else x).cast("decimal(38,0)")


def _text_rank(value: Column, order: Column) -> Column:
    """The order of ``best_text`` as one number, missing for a blank text: clean, length, early.

    A number of fixed width is combined in a hash map, where a struct or the text itself would be sorted.
    """
    clean = F.when(boilerplate(value), 0).otherwise(1)
    rank = _wide(clean) * _wide(10**30) + _wide(F.length(strip(value))) * _wide(10**20) + (_wide(10**19) - _wide(order))
    return F.when(is_filled(value), rank)


def best_texts(
    df: DataFrame, key: Column, columns: Sequence[str], order: str, key_name: str = "join_key"
) -> DataFrame:
    """Per key the best text of each column (``best_text``); ``order`` must be a whole number.

    Only ranks are aggregated.  The winners' rows are fetched afterwards, so no other text is shuffled or
    sorted, and the rank says from which row each winner came.
    """
    rows = df.select(key.alias(key_name), F.col(order).cast("bigint").alias("_order"), *columns)
    ranks = {c: f"_rank_{c}" for c in columns}
    best = settle(
        rows.select(key_name, *[_text_rank(F.col(c), F.col("_order")).alias(r) for c, r in ranks.items()])
        .groupBy(key_name).agg(*[F.max(r).alias(r) for r in ranks.values()]), "best-ranks")
    place = [(_wide(10**19) - F.col(r) % _wide(10**20)).cast("bigint") for r in ranks.values()]
    winners = settle(
        best.select(key_name, *ranks.values(), F.explode(F.array_distinct(F.array_compact(F.array(*place)))).alias("_order")),
        "best-rows")
    fetched = settle(rows.join(winners, [key_name, "_order"]), "best-texts")
    out = best.select(key_name)
    for c, r in ranks.items():
        same = Window.partitionBy(key_name).orderBy(F.xxhash64(c))  # rows that share key, order and rank
        own = fetched.where(_text_rank(F.col(c), F.col("_order")) == F.col(r)).select(
            key_name, F.col(c).alias(f"_best_{c}"), F.row_number().over(same).alias("_n")).where("_n = 1").drop("_n")
        out = out.join(own.withColumnRenamed(key_name, "_key"), out[key_name].eqNullSafe(F.col("_key")), "left").drop("_key")
    return out.select(key_name, *[F.coalesce(f"_best_{c}", F.lit("")).alias(c) for c in columns])


def join_lookup(
    rows: DataFrame, lookup: DataFrame, keys: Sequence[str], how: str = "left",
    settled: bool = True,
) -> DataFrame:
    """Join rows with a lookup that has one row per key.

    The lookup is written out first.  Its size is then known before the join is
    planned: below ``spark.sql.autoBroadcastJoinThreshold`` the rows are not
    shuffled at all; above it both sides are, and adaptive execution splits the
    hot keys.

    With ``settled=False`` nothing is written.  A lookup just grouped by the key
    would then be joined where it lies, and the hot keys of such a join cannot
    be split; a second join key, computed from the first, sends both sides
    through an exchange of their own.
    """
    keys = list(keys)
    if settled:
        return rows.join(settle(lookup, "lookup"), keys, how)
    mark = F.hash(*keys)
    joined = rows.withColumn("_mark", mark).join(
        lookup.withColumn("_mark", mark), [*keys, "_mark"], how
    )
    return joined.drop("_mark")


def best_text_join(
    rows: DataFrame, rows_key: Column, texts: DataFrame, texts_key: Column,
    columns: Sequence[str], order: str, keep_existing: bool = False,
) -> DataFrame:
    """Bring the best text per normalised key to the rows.

    A matched key overwrites the row's own text even with '' unless
    ``keep_existing`` is set.
    """
    lookup = best_texts(texts, norm(texts_key), columns, order).withColumnsRenamed(
        {c: f"_new_{c}" for c in columns}
    )
    joined = join_lookup(rows.withColumn("join_key", norm(rows_key)), lookup, ["join_key"])
    for c in columns:
        new = F.col(f"_new_{c}")
        if keep_existing:
            new = F.nullif(new, F.lit(""))
        own = F.col(c) if c in rows.columns else F.lit(None).cast("string")
        joined = joined.withColumn(c, F.coalesce(new, own))
    return joined.drop("join_key", *[f"_new_{c}" for c in columns])


def years_join(
    rows: DataFrame, texts: DataFrame, years: str, columns: Sequence[str], order: str
) -> DataFrame:
    """Both sides on normalised years; the key is replaced by its normal form."""
    lookup = texts.groupBy(norm_years(F.col(years)).alias(years)).agg(
        *[first_filled(F.col(c), F.col(order)).alias(c) for c in columns]
    )
    return join_lookup(rows.withColumn(years, norm_years(F.col(years))), lookup, [years])


def first_wins_lookup(
    rows: DataFrame, rows_key: Column, table: DataFrame, table_key: Column, value: str,
    order: str, out: str,
) -> DataFrame:
    """Key to first non-empty value, mapped onto rows; '' when missing."""
    usable = table.select(table_key.alias("_key"), strip(text(F.col(value))).alias("_value"),
                          F.col(order).alias("_order"))
    usable = usable.where((F.col("_key") != "") & (F.col("_value") != ""))
    lookup = usable.groupBy("_key").agg(F.min_by("_value", "_order").alias("_value"))
    joined = join_lookup(rows.withColumn("_key", rows_key), lookup, ["_key"])
    return joined.withColumn(out, F.coalesce("_value", F.lit(""))).drop("_key", "_value")


def attach_vectors(
    rows: DataFrame, vectors: DataFrame, key: str, columns: Sequence[str],
) -> DataFrame:
    """Left join of vector texts on the row key, renamed to ``*_text``.

    Duplicate keys on either side multiply rows; see ``duplicate_keys``.
    """
    side = vectors.select(key, *[F.col(c).alias(f"{c}_text") for c in columns])
    return rows.join(side, key, "left")


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def unprocessed(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in ``done``; rows without a key stay."""
    return join_lookup(rows, done.select(key).distinct(), [key], "left_anti", settled=False)


def worklist(
    df: DataFrame, key: str, order: str, columns: Sequence[str], cached: DataFrame,
    missing: Column | None = None, force: bool = False,
) -> DataFrame:
    """Families still to do: first row of each, minus the cache.

    ``missing`` keeps families with at least one row where it holds; ``force``
    ignores the cache.  One aggregation answers both.
    """
    row = F.min_by(F.struct(*columns), F.col(order)).alias("_row")
    flag = F.max(missing) if missing is not None and not force else F.lit(True)
    families = df.groupBy(key).agg(row, flag.alias("_wanted")).where("_wanted")
    if not force:
        families = families.join(cached.select(key).distinct(), key, "left_anti")
    return families.select(key, "_row.*")


def apply_results(
    rows: DataFrame, results: DataFrame, key: str, columns: Sequence[str], settled: bool = True
) -> DataFrame:
    """Family results back on every row; a row keeps its own value where there is none."""
    side = results.select(key, *[F.col(c).alias(f"_new_{c}") for c in columns])
    joined = join_lookup(rows, side, [key], settled=settled)
    for c in columns:
        new = F.col(f"_new_{c}")
        joined = joined.withColumn(c, F.coalesce(new, F.col(c)) if c in rows.columns else new)
    return joined.drop(*[f"_new_{c}" for c in columns])
