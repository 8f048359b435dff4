"""URL normalisation, classes and candidates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from catalith import values
from catalith.functions.extract import found
from catalith.functions.text import strip, text

# scheme, authority and path, as in RFC 3986 appendix B
PARTS = r"^(?:([^:/?#]+):)?(?://([^/?#]*))?([^?#]*)"
DEFAULT_SCHEME = "https"
DEFAULT_HOST = "www.example.com"


def normalize(url: Column, host: str = DEFAULT_HOST) -> Column:
    raw = strip(text(url))
    scheme = F.coalesce(F.lower(found(raw, PARTS, 1)), F.lit(DEFAULT_SCHEME))
    netloc = F.coalesce(found(raw, PARTS, 2), F.lit(host))
    path = F.regexp_replace(F.lower(F.regexp_extract(raw, PARTS, 3)), "//+", "/")
    path = F.regexp_replace(path, "/+$", "")
    path = F.when((path != "") & ~path.startswith("/"), F.concat(F.lit("/"), path)).otherwise(path)
    return F.concat(scheme, F.lit("://"), netloc, path)


def is_specs(url: Column, host: str = DEFAULT_HOST) -> Column:
    return normalize(url, host).endswith("/specs")


def is_review(url: Column, host: str = DEFAULT_HOST) -> Column:
    plain = normalize(url, host)
    out = F.lit(False)
    for ending in values.REVIEW_ENDINGS:
        out = out | plain.endswith(ending)
    return out


def to_specs(url: Column) -> Column:
    raw = text(url)
    swapped = F.replace(
        F.replace(raw, F.lit("/review/"), F.lit("/specs/")), F.lit("/review"), F.lit("/specs")
    )
    return F.when(raw.rlike("/review/?$"), swapped).otherwise(raw)


def specs_fallback(url: Column) -> Column:
    """The specs page to fall back on when a review page of any form fails."""
    raw = text(url)
    for ending in ("/review", "/used-review"):
        raw = F.replace(raw, F.lit(ending), F.lit("/specs"))
    return raw


def candidates(url: Column, host: str = DEFAULT_HOST) -> Column:
    """Ordered review addresses to try for a specs page, each with and without '/'.

    Other addresses pass through; a specs address with too few parts gives none.
    """
    raw = F.regexp_replace(strip(text(url)), r"[?#].*$", "")
    parts = F.split(F.regexp_replace(raw, "/+$", ""), "/")
    count = F.size(parts)
    tail = F.try_element_at(parts, F.lit(-2))
    model, brand = F.try_element_at(parts, F.lit(-3)), F.try_element_at(parts, F.lit(-4))
    body = found(tail, values.YEAR_TAIL)
    folder = F.concat(F.lit("/"), brand, F.lit("/"), model, F.lit("/"))
    prefix = F.concat(
        F.lit(f"{DEFAULT_SCHEME}://{host}"), F.regexp_replace(folder, "/+", "/")
    )
    stems = [
        (tail, "/review"), (tail, "/used-review"), (body, "/review"), (body, "/used-review"),
        (tail, "/owners-reviews"), (body, "/owners-reviews"),
    ]
    tries = F.array_compact(F.array(*[F.concat(prefix, s, F.lit(e)) for s, e in stems]))
    both = F.flatten(F.transform(tries, lambda u: F.array(F.concat(u, F.lit("/")), u)))
    nothing = F.array().cast("array<string>")
    return (
        F.when(F.try_element_at(parts, F.lit(-1)) != "specs", F.array(raw))
        .when(count < 4, nothing)
        .otherwise(both)
    )


def slug(col: Column, limit: int = 80) -> Column:
    kept = F.regexp_replace(text(col), r"(?U)[^\w\s-]", "")
    dashed = F.lower(F.regexp_replace(strip(kept), r"(?U)\s+", "-"))
    return F.coalesce(F.nullif(F.left(dashed, F.lit(limit)), F.lit("")), F.lit("row"))
