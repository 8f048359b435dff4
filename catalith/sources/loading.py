"""Staged text rows to typed tables, with rejected rows kept apart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalith import values
from catalith.functions import vectors
from catalith.functions.text import text


def whole_or_blank(col: Column) -> Column:
    """Blank, or digits that fit an int; a number beyond that is no clean number."""
    own = text(col)
    return (own == "") | (own.rlike(values.DIGITS_PATTERN) & own.try_cast("int").isNotNull())


def has_vector(col: Column) -> Column:
    return ~text(col).isin("", "[]")


def strict_int(col: Column) -> Column:
    """'' to NULL, the rest to int."""
    return F.nullif(text(col), F.lit("")).try_cast("int")


def lenient_int(col: Column) -> Column:
    """Digits to int, anything else and digits beyond an int to NULL."""
    return F.when(text(col).rlike(values.DIGITS_PATTERN), col.try_cast("int"))


def _all(conditions: Sequence[Column]) -> Column:
    out = F.lit(True)
    for cond in conditions:
        out = out & cond
    return out


def load_strict(df: DataFrame, vector_cols: Sequence[str], int_cols: Sequence[str]) -> DataFrame:
    """Only rows with both vectors and clean numbers, numbers typed."""
    good = _all([has_vector(F.col(c)) for c in vector_cols])
    good = good & _all([whole_or_blank(F.col(c)) for c in int_cols])
    return _typed(df.where(good), vector_cols, {c: strict_int(F.col(c)) for c in int_cols})


def load_lenient(df: DataFrame, vector_cols: Sequence[str], int_cols: Sequence[str]) -> DataFrame:
    """Rows with both vectors; numbers that are not digits become NULL."""
    good = _all([has_vector(F.col(c)) for c in vector_cols])
    return _typed(df.where(good), vector_cols, {c: lenient_int(F.col(c)) for c in int_cols})


def _typed(df: DataFrame, vector_cols: Sequence[str], ints: dict[str, Column]) -> DataFrame:
    parsed = {c.removesuffix("_text"): vectors.parse(F.col(c)) for c in vector_cols}
    return df.withColumns({**ints, **parsed})


def full_refresh(
    df: DataFrame, vector_cols: Sequence[str], int_cols: Sequence[str], json_col: str,
) -> DataFrame:
    """All rows typed and judged: ``rejected`` rows have a value that cannot be typed.

    Where a database load would abort, ``reasons`` says why and ``raw`` keeps the rejected row's own
    texts.  JSON becomes a variant, so whatever keys a value has survive; single-quoted lists are read too.
    """
    typed_from = [*int_cols, json_col, *vector_cols]
    given = {c: F.nullif(text(F.col(c)), F.lit("")) for c in typed_from}
    typed = {c: given[c].try_cast("int") for c in int_cols}
    typed[json_col] = F.from_json(given[json_col], "variant")
    typed.update({c: vectors.parse(given[c]) for c in vector_cols})
    complaints = {json_col: "not JSON"} | {c: "not a vector" for c in vector_cols}
    # typed once, then judged and used
    staged = df.withColumns({f"_typed_{c}": col for c, col in typed.items()})
    reasons = [
        F.when(
            given[c].isNotNull() & F.col(f"_typed_{c}").isNull(),
            F.lit(f"{c}: {complaints.get(c, 'not a number')}"),
        )
        for c in typed
    ]
    judged = staged.withColumn("reasons", F.array_compact(F.array(*reasons))).withColumn(
        "rejected", F.size("reasons") > 0)
    others = [c for c in df.columns if c not in typed_from]
    final = [F.col(f"_typed_{c}").alias(c.removesuffix("_text") if c in vector_cols else c) for c in typed]
    raw = F.when(F.col("rejected"), F.struct(*typed_from)).alias("raw")
    return judged.select(*others, *final, raw, "reasons", "rejected")


def _folder(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def versions(spark: SparkSession, path: str) -> list[int]:
    """The complete versions of a table, oldest first; a write that failed has left none."""
    place, files = _folder(spark, path)
    if not files.exists(place):
        return []
    names = [f.getPath().getName() for f in files.listStatus(place)]
    done = [n for n in names if files.exists(_folder(spark, f"{path}/{n}/_SUCCESS")[0])]
    return sorted(int(n.removeprefix("version=")) for n in done if n.startswith("version="))


def write_full_refresh(judged: DataFrame, path: str, keep: int = 2) -> int:
    """Write loaded and rejected rows in one pass as the table's next version, and give its number.

    Readers take the latest complete version.  It becomes complete with the marker that is written after all
    files of both parts, so until then, and if the job fails, they see the version before.  The last
    ``keep`` versions stay, for readers that have begun.
    """
    spark = judged.sparkSession
    number = max(versions(spark, path), default=0) + 1
    # one write: nothing is computed a second time for the rejects
    judged.write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").partitionBy(
        "rejected").parquet(f"{path}/version={number}")
    for old in versions(spark, path)[:-keep]:
        place, files = _folder(spark, f"{path}/version={old}")
        files.delete(place, True)
    return number


def read_full_refresh(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(loaded, rejected) of the latest complete version."""
    number = max(versions(spark, path))
    rows = spark.read.parquet(f"{path}/version={number}")
    kept = F.col("rejected").cast("string") == "false"  # a folder's name, so only one part is read
    loaded = rows.where(kept).drop("raw", "reasons", "rejected")
    typed = [c for f in rows.schema["raw"].dataType.names for c in (f, f.removesuffix("_text")) if c in rows.columns]
    rejected = rows.where(~kept).select(
        *[c for c in rows.columns if c not in {*typed, "raw", "reasons", "rejected"}], "raw.*", "reasons")
    return loaded, rejected
