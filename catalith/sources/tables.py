"""Text tables, column maps, caches, vector and CSV sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalith import values
from catalith.functions.text import integer_text, text


def text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def as_text(df: DataFrame) -> DataFrame:
    """Every column as string; complex columns as JSON."""
    def cell(field: T.StructField) -> Column:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            return F.to_json(col).alias(field.name)
        return col.cast("string").alias(field.name)

    return df.select(*[cell(f) for f in df.schema.fields])


def scan_text_csv(spark: SparkSession, path: str, columns: Sequence[str],
                  multiline: bool = False) -> DataFrame:
    """CSV with a header, all columns text, no inference; columns are checked by name.

    ``multiline`` allows line breaks inside quotes; such files cannot be split
    between tasks, so it is off unless asked for.
    """
    reader = spark.read.option("header", True).option("enforceSchema", False)
    quoted = reader.option("quote", '"').option("escape", '"').option("multiLine", multiline)
    return quoted.schema(text_schema(columns)).csv(path)


def scan_text_parquet(spark: SparkSession, path: str) -> DataFrame:
    return as_text(spark.read.parquet(path))


def require(df: DataFrame, columns: Sequence[str]) -> None:
    """Fail at plan time when columns are missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def rename(
    df: DataFrame, mapping: dict[str, str] | None = None, required: Sequence[str] = (),
    select: Sequence[str] | None = None,
) -> DataFrame:
    """Rename by map, keep the rest; check required names; select an ordered subset."""
    out = df.withColumnsRenamed(mapping or values.HEADER_MAP)
    require(out, required)
    return out if select is None else out.select(*[c for c in select if c in out.columns])


def structured_export(
    df: DataFrame, keys: Sequence[str], mapping: dict[str, str] | None = None
) -> DataFrame:
    """Keys and mapped fields as text; numeric targets as whole numbers, '' when missing."""
    out = [text(F.col(f"`{k}`")).alias(k) for k in keys]
    for source, target in (mapping or values.STRUCTURED_MAP).items():
        if source not in df.columns:
            cell = F.lit("")
        elif target.endswith(("_min", "_max")):
            cell = integer_text(F.col(f"`{source}`"))
        else:
            cell = text(F.col(f"`{source}`"))
        out.append(cell.alias(target))
    return df.select(*out)


def cache_last_wins(lines: DataFrame, line: str, order: str, schema: str) -> DataFrame:
    """JSON lines {"fid": …, "data": {…}} to one row per fid; bad lines are skipped.

    ``order`` tells which line came later; the later one wins.
    """
    parsed = F.from_json(
        F.col(line), f"fid string, data struct<{schema}>, _bad string",
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"},
    )
    good = lines.select(F.col(order).alias("_order"), parsed.alias("_j")).where(
        F.col("_j._bad").isNull() & F.col("_j.fid").isNotNull() & F.col("_j.data").isNotNull()
    )
    return good.groupBy(F.col("_j.fid").alias("fid")).agg(
        F.max_by("_j.data", "_order").alias("data")
    )


def read_cache_lines(spark: SparkSession, path: str) -> DataFrame:
    """JSON-lines files with an order column: time and path of the file, then position in it."""
    return spark.read.text(path).select(
        F.col("value").alias("line"),
        F.struct(
            F.col("_metadata.file_modification_time").alias("time"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ).alias("line_no"),
    )


def write_vectors(df: DataFrame, path: str, columns: Sequence[str], fmt: str = "json",
                  mode: str = "append") -> None:
    """Vectors as JSON text, appended as JSON lines or CSV."""
    out = df.select(*[
        F.to_json(c).alias(c) if c in columns else F.col(c) for c in df.columns
    ])
    writer = out.write.mode(mode)
    if fmt == "json":
        writer.json(path)
    else:
        writer.option("header", True).option("escape", '"').csv(path)


def write_quoted_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with every field quoted and kept as it is, blanks at its ends included; header line, LF, UTF-8."""
    (
        as_text(df).na.fill("").write.mode(mode)
        .option("quoteAll", True).option("escape", '"').option("header", True)
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .option("lineSep", "\n").option("encoding", "UTF-8").option("emptyValue", "")
        .csv(path)
    )
