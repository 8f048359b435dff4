"""Text and number normalisers, keys, and string projections."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from catalith import values

WS = r"(?U)\s+"  # also matches the no-break space
BLANKS = " \t\n\r\u00a0"


def text(col: Column) -> Column:
    """Null becomes the empty string."""
    return F.coalesce(col.cast("string"), F.lit(""))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Bind a value to a lambda variable, so that inner lambdas do not compute it again."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def strip(col: Column) -> Column:
    return F.btrim(col, F.lit(BLANKS))


def blank_to_null(col: Column) -> Column:
    """Trimmed text; '', nan, none and null become NULL."""
    trimmed = strip(col.cast("string"))
    return F.when(~F.lower(trimmed).isin(*values.MISSING_TEXTS), trimmed)


def nonempty(col: Column) -> Column:
    """Trimmed text or NULL when blank (the texts nan/none stay)."""
    return F.nullif(strip(col.cast("string")), F.lit(""))


def or_placeholder(col: Column, placeholder: str = values.PLACEHOLDER) -> Column:
    return F.coalesce(blank_to_null(col), F.lit(placeholder))


def collapse_ws(col: Column) -> Column:
    return strip(F.regexp_replace(text(col), WS, " "))


def norm(col: Column) -> Column:
    return F.lower(collapse_ws(col))


def norm_years(col: Column) -> Column:
    """Lower case, every dash form and the text 'to' as '-', no blanks around it."""
    lowered = F.lower(strip(text(col)))
    dashed = F.replace(
        F.translate(lowered, values.DASHES, "-" * len(values.DASHES)), F.lit("to"), F.lit("-")
    )
    tight = F.regexp_replace(dashed, r" ?- ?", "-")
    return F.regexp_replace(tight, r" {2,}", " ")


def joined_key(*parts: Column, sep: str = "|") -> Column:
    return F.concat_ws(sep, *[text(p) for p in parts])


def family_key(make: Column, model: Column, years: Column) -> Column:
    return joined_key(norm(make), norm(model), norm(years))


def family_phrase(make: Column, model: Column, years: Column) -> Column:
    """Normalised 'make model years'."""
    return norm(F.concat_ws(" ", text(make), text(model), text(years)))


def price_key(
    make: Column, model: Column, series: Column, start: Column, end: Column, engine: Column,
    now: str,
) -> Column:
    return joined_key(
        norm(make), norm(model), norm(series), norm_year(start, now), norm_year(end, now),
        norm(engine),
    )


def simple_key(*parts: Column) -> Column:
    return joined_key(*[F.lower(strip(text(p))) for p in parts])


def row_key(*parts: Column) -> Column:
    return joined_key(*[strip(text(p)) for p in parts])


def variant_key(family: Column, engine: Column, row_idx: Column) -> Column:
    slug = F.replace(
        strip(F.regexp_replace(F.lower(text(engine)), "[^a-z0-9]+", " ")), F.lit(" "), F.lit("-")
    )
    tail = F.coalesce(F.nullif(slug, F.lit("")), F.concat(F.lit("row"), row_idx.cast("string")))
    return F.concat(family, F.lit("__"), tail)


def norm_year(col: Column, now: str) -> Column:
    """Open-ended year words become ``now`` (a parameter, so results repeat)."""
    lowered = F.lower(strip(text(col)))
    return F.when(lowered.isin(*values.OPEN_YEARS), F.lit(now)).otherwise(strip(text(col)))


def clean_years(model: Column, years: Column) -> Column:
    raw = text(years)
    found = F.regexp_extract_all(raw, F.lit(values.YEAR_PATTERN), F.lit(1))
    rest = strip(F.replace(raw, text(model), F.lit("")))
    rest = F.when(text(model) == "", strip(raw)).otherwise(rest)
    return (
        F.when(F.size(found) >= 2, F.concat(F.get(found, F.lit(0)), F.lit("–"), F.get(found, F.lit(1))))
        .when(F.size(found) == 1, F.concat(F.get(found, F.lit(0)), F.lit("–present")))
        .otherwise(F.coalesce(F.nullif(rest, F.lit("")), raw))
    )


# numbers -------------------------------------------------------------------

def number(col: Column, thousands: bool = False) -> Column:
    """Text to double, NULL unless it is a plain decimal number."""
    raw = col.cast("string")
    if thousands:
        raw = F.replace(raw, F.lit(","), F.lit(""))
    raw = strip(raw)
    return F.when(raw.rlike(values.NUMBER_PATTERN), raw.try_cast("double"))


def whole(col: Column) -> Column:
    """Half-even rounding to bigint."""
    return F.bround(col).cast("bigint")


def integer_text(col: Column, thousands: bool = False) -> Column:
    """Numeric text rounded half-even and written as an integer; '' when missing."""
    return F.coalesce(whole(number(col, thousands)).cast("string"), F.lit(""))


def one_decimal(num: Column) -> Column:
    """A non-negative number with one decimal, built from integers."""
    tenths = F.bround(num * 10).cast("bigint")
    return F.concat(F.floor(tenths / 10).cast("string"), F.lit("."), (tenths % 10).cast("string"))


def matching_columns(names: Sequence[str], patterns: Sequence[str]) -> list[str]:
    """Column names that match any pattern, in schema order (decided at plan time)."""
    return [n for n in names if any(re.search(p, n, re.I) for p in patterns)]


def first_numeric(names: Sequence[str], patterns: Sequence[str]) -> Column:
    hits = matching_columns(names, patterns)
    if not hits:
        return F.lit(None).cast("double")
    return F.coalesce(*[number(F.col(f"`{n}`")) for n in hits])


def min_numeric(names: Sequence[str], patterns: Sequence[str]) -> Column:
    hits = matching_columns(names, patterns)
    if not hits:
        return F.lit(None).cast("double")
    if len(hits) == 1:
        return number(F.col(f"`{hits[0]}`"))
    return F.least(*[number(F.col(f"`{n}`")) for n in hits])


# longer texts --------------------------------------------------------------

def clean_text(col: Column, tails: Sequence[str] = values.TAIL_PATTERNS) -> Column:
    """Collapse white space, then cut everything from a tail mark to the end."""
    flat = collapse_ws(col)
    return strip(F.regexp_replace(flat, f"(?s)(?:{'|'.join(tails)}).*$", "")) if tails else flat


def word_limit(col: Column, limit: int) -> Column:
    """The first ``limit`` words; shorter texts stay as they are.

    The pattern only matches when there are more words, and reads no further.
    """
    longer = rf"(?U)^\s*+(\S++(?:\s++\S++){{{limit - 1}}})\s++\S"

    def cut(whole_text: Column) -> Column:
        return let(
            F.regexp_extract(whole_text, longer, 1),
            lambda head: F.when(head != "", collapse_ws(head)).otherwise(whole_text),
        )

    return let(text(col), cut)


def pair(label: str, value: Column, sep: str = ": ") -> Column:
    """'label: value', NULL when the value is missing."""
    return F.concat(F.lit(f"{label}{sep}"), value)


def value_range(low: Column, high: Column) -> Column:
    """'low-high', one side when they agree or one is missing."""
    return F.when(
        low.isNotNull() & high.isNotNull() & (low != high), F.concat(low, F.lit("-"), high)
    ).otherwise(F.coalesce(low, high))


def labelled(pairs: Sequence[tuple[str, Column]], sep: str, glue: str) -> Column:
    """Join the pairs whose value is present."""
    return F.concat_ws(glue, *[pair(label, value, sep) for label, value in pairs])


def bounded_pairs(pairs: Sequence[tuple[str, Column]], max_chars: int) -> Column:
    """'name: value' parts joined by '; ' up to the first one that overflows.

    Every part costs its length plus two.  Nothing after the first overflow is
    taken, even when it would fit.
    """
    parts = F.array_compact(F.array(*[pair(name, value) for name, value in pairs]))
    start = F.struct(
        F.lit(0).alias("used"),
        F.array().cast("array<string>").alias("kept"),
    )

    def step(acc: Column, part: Column) -> Column:
        used = acc["used"] + F.length(part) + 2
        kept = F.when(used <= max_chars, F.concat(acc["kept"], F.array(part))).otherwise(
            acc["kept"]
        )
        return F.struct(used.alias("used"), kept.alias("kept"))

    return F.array_join(F.aggregate(parts, start, step)["kept"], "; ")


def fill_template(template: str, fields: dict[str, Column]) -> Column:
    """A text with {name} marks; every mark is replaced by its column."""
    pieces = []
    for i, piece in enumerate(re.split(r"\{(\w+)\}", template)):
        if i % 2:
            pieces.append(text(fields[piece]))
        elif piece:
            pieces.append(F.lit(piece))
    return F.concat(*pieces)
