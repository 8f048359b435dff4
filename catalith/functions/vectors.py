"""Vector arithmetic on arrays, in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from catalith.functions.text import let

ZERO = 0.0


def doubles(v: Column) -> Column:
    return v.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(doubles(a), doubles(b), lambda x, y: x * y), F.lit(ZERO), lambda s, x: s + x
    )


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(doubles(v), F.lit(ZERO), lambda s, x: s + x * x))


def normalize(v: Column) -> Column:
    """Unit length; a zero vector stays as it is."""
    def scaled(s: Column) -> Column:
        return F.when(s["n"] == 0, s["v"]).otherwise(F.transform(s["v"], lambda x: x / s["n"]))

    return let(F.struct(doubles(v).alias("v"), norm(v).alias("n")), scaled)


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; NULL for a zero vector."""
    return dot(a, b) / F.nullif(norm(a) * norm(b), F.lit(ZERO))


def cosine_distance(a: Column, b: Column) -> Column:
    return F.lit(1.0) - cosine(a, b)


def parse(col: Column) -> Column:
    """Text with or without brackets to array<float>; NULL when any element is bad."""
    inner = F.btrim(col, F.lit("[] \t\n\r"))
    parsed = F.from_json(
        F.concat(F.lit("["), inner, F.lit("]")), "array<float>",
        {"allowNonNumericNumbers": "false"},
    )
    return F.when(~F.exists(parsed, lambda x: x.isNull()), parsed)
