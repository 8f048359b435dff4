"""End-to-end jobs, each one lazy plan built from the operators."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalith.functions import compose, extract, html, text, vehicle
from catalith.operators import aggregate, enrich, lookup, quality, search
from catalith.session import settle
from catalith.sources import tables

C = F.col


def family_texts(cars: DataFrame, order: str) -> DataFrame:
    """Rows with a family key and the family's text.

    The text is made once per family from its first values and joined back.
    """
    keyed = cars.withColumn("family", text.family_key(C("make"), C("model"), C("series_years")))
    columns = ["make", "model", "series_years", "body_type", "length_mm"]
    firsts = lookup.first_values(keyed, ["family"], columns, order)
    size = vehicle.size_bucket(C("body_type"), text.number(C("length_mm")))
    texts = firsts.select("family", vehicle.family_essence(
        F.btrim("make"), C("model"), C("series_years"), size).alias("essence"))
    return lookup.apply_results(keyed, texts, "family", ["essence"])


def catalogue_from_pages(
    pages: DataFrame, series: Column, rows: DataFrame, rows_series: Column, order: str,
    rules: Sequence[html.FieldRule] = html.DEFAULT_FIELDS,
) -> DataFrame:
    """Fields of review pages, cleaned, the best per series brought to catalogue rows."""
    names = ["article", "pros", "cons", "rivals"]
    needed = [r for r in rules if r.field in names]
    read = pages.select(
        order, series.alias("_series"), html.field_map(C("html"), needed).alias("_fields")
    )
    flat = read.select(
        order, "_series",
        *[F.coalesce(F.try_element_at("_fields", F.lit(n)), F.lit("")).alias(n) for n in names],
    )
    clean = quality.clear_boilerplate(flat, "article")
    return lookup.best_text_join(rows, rows_series, clean, C("_series"), names, order)


def price_gaps(
    cars: DataFrame, key: str, order: str, listings: DataFrame, own_low: str,
    own_high: str | None = None,
) -> DataFrame:
    """Families with a row that lacks a price get the robust range of their listings.

    ``listings`` has the family key and a ``price``.  A family without usable
    listings keeps what its rows say: ``own_low`` and, if given, ``own_high``.
    """
    blank = text.nonempty(C(own_low)).isNull()
    nothing = cars.select(key).where(F.lit(False))
    wanted = lookup.worklist(cars, key, order, [order], nothing, missing=blank).select(key)
    relevant = lookup.join_lookup(listings, wanted, [key], "left_semi")
    ranges = aggregate.robust_range(relevant, key, C("price"))
    joined = lookup.join_lookup(cars, ranges, [key])
    own = text.number(C(own_low), thousands=True)
    own_top = text.number(C(own_high), thousands=True) if own_high else F.lit(None).cast("double")
    return joined.withColumns({
        "price_low_filled": F.coalesce(C("min_price"), own),
        "price_high_filled": F.coalesce(C("max_price"), own_top),
        "confidence": F.coalesce("confidence", F.lit("low")),
        "notes": F.coalesce("notes", F.lit("no-parse")),
    }).drop("min_price", "max_price")


def embed_and_search(
    cars: DataFrame, id_col: str, specs: dict[str, Column],
    embed: Callable[[list[str]], np.ndarray], dimension: int, query_id: int, k: int,
) -> DataFrame:
    """Specs text per row, embedded, then the rows nearest to one of them.

    The vectors are written once, so that no text is embedded a second time.
    """
    texts = cars.select(id_col, compose.specs_string(specs).alias("specs"))
    embedded = settle(
        enrich.embed_batches(texts, id_col, "specs", embed, dimension), "vectors"
    )
    query = search.query_vector(embedded, C(id_col) == query_id, "vector")
    others = embedded.where(C(id_col) != query_id)
    return search.topk(others, search.similarity(C("vector"), query), [id_col], k, id_col)


def answered_prices(
    cars: DataFrame, key: str, order: str, inputs: Sequence[str], fn: Callable[[pd.DataFrame], pd.DataFrame],
    cache: str, own_low: str, own_high: str, **how,
) -> DataFrame:
    """Families that lack a price at either end are asked once, their answers checked and brought to all rows.

    ``fn`` gives each family's answer as text; it is kept in the cache as it came, so a better parser needs no second
    call.  A row without a usable answer keeps its own prices.  ``how`` goes to ``enrich.enrich_families``.
    """
    lacking = text.nonempty(C(own_low)).isNull() | text.nonempty(C(own_high)).isNull()
    asked = enrich.enrich_families(
        cars, key, order, inputs, fn, f"{key} string, answer string", cache, missing=lacking, **how)
    parsed = asked.withColumn("_parsed", extract.answer_json(C("answer")))
    checked = enrich.sanitize_prices(C("_parsed"), C(own_low), C(own_high))
    return parsed.withColumns({f"{n}_filled" if n.startswith("price") else n: c for n, c in checked.items()}).drop("_parsed")


def answered_specs(
    cars: DataFrame, key: str, order: str, inputs: Sequence[str], fn: Callable[[pd.DataFrame], pd.DataFrame],
    cache: str, own: dict[str, str], **how,
) -> DataFrame:
    """Families with a gap in economy, insurance or sprint are asked once; answers in range fill the gaps.

    ``own`` names the rows' columns of ``mpg``, ``insurance`` and ``sprint``.
    """
    gaps = [enrich.needs_fill(C(c)) for c in own.values()]
    asked = enrich.enrich_families(
        cars, key, order, inputs, fn, f"{key} string, {', '.join(f'_{n} double' for n in own)}", cache,
        missing=reduce(Column.__or__, gaps), **how)
    checked = enrich.sanitize_specs(*[C(f"_{n}") for n in ("mpg", "insurance", "sprint")])
    filled = {
        f"{n}_filled": enrich.fill_missing(C(c), checked[n], positive_only=n == "mpg") for n, c in own.items()}
    return asked.withColumns(filled).drop(*[f"_{n}" for n in own])


def staging_csv(rows: DataFrame, vectors: DataFrame, key: str, columns: Sequence[str], path: str) -> DataFrame:
    """Rows with their vector texts as one quoted CSV table for a database load, read back as text.

    Keys that would multiply rows are an error, as the load takes one row per key.
    """
    if not lookup.duplicate_keys(vectors, key).isEmpty():
        raise ValueError(f"the vectors hold a {key} more than once")
    tables.write_quoted_csv(lookup.attach_vectors(rows, vectors, key, columns), path)
    names = [*rows.columns, *[f"{c}_text" for c in columns]]
    return tables.scan_text_csv(rows.sparkSession, path, names, multiline=True)
