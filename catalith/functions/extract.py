"""Fields pulled out of review texts, answers and pages with regular expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from catalith import values
from catalith.functions.markup import decode, inside, parse, spans
from catalith.functions.rules import contains_any
from catalith.functions.text import clean_text, let, text

RIVAL_TYPE = "array<struct<name:string,rating:string,context:string>>"
PRICE_ANSWER = "min_used_price_gbp double, max_used_price_gbp double, confidence string, notes string"


def found(col: Column, pattern: str, group: int = 1) -> Column:
    """First match of a group, NULL when there is none."""
    return F.nullif(F.regexp_extract(col, pattern, group), F.lit(""))


def glance_fields(glance: Column) -> dict[str, Column]:
    """The 'at a glance' figures, thousands separators removed."""
    flat = text(glance)
    return {
        name: F.btrim(F.replace(found(flat, pattern, group), F.lit(","), F.lit("")))
        if name not in ("insurance_group", "doors", "fuel_economy", "fuel_types")
        else F.btrim(found(flat, pattern, group))
        for name, (pattern, group) in values.GLANCE.items()
    }


def _valid(col: Column) -> Column:
    """Cleaned text that says something."""
    return let(clean_text(col), lambda c: F.when(~c.isin("", "&"), c))


def _valid_on_page(col: Column, longer_than: int, shorter_than: int | None) -> Column:
    def fits(c: Column) -> Column:
        enough = F.length(c) > longer_than
        return enough if shorter_than is None else enough & (F.length(c) < shorter_than)

    return let(_valid(col), lambda c: F.when(fits(c), c))


def pros_cons(
    combined: Column, pros: Column, cons: Column, page: Column,
    longer_than: int = values.PAGE_MIN_CHARS, shorter_than: int | None = values.PAGE_MAX_CHARS,
) -> tuple[Column, Column]:
    """Combined section, then the separate sections, then synonyms on the page.

    What a synonym finds on the page counts only within the two bounds, as a match of one word may run to
    the page's end; it is taken whole or not at all.  ``shorter_than=None`` takes any length.
    """
    def cascade(section: str, own: Column, synonyms: Sequence[tuple[str, str]]) -> Column:
        def on_page(p: Column) -> Column:
            return F.coalesce(*[
                F.when(p["lower"].contains(word), _valid_on_page(found(p["page"], pattern), longer_than, shorter_than))
                for word, pattern in synonyms
            ])

        whole_page = F.struct(text(page).alias("page"), F.lower(text(page)).alias("lower"))
        return F.coalesce(
            _valid(found(text(combined), section)), _valid(own), let(whole_page, on_page)
        )

    return (
        cascade(values.SECTION_PROS, pros, values.PAGE_PROS),
        cascade(values.SECTION_CONS, cons, values.PAGE_CONS),
    )


def author_date(about: Column) -> tuple[Column, Column]:
    author = F.btrim(found(about, values.AUTHOR_DATE, 1))
    fallback = F.btrim(found(about, values.AUTHOR_ONLY, 1))
    return F.coalesce(author, fallback), F.btrim(found(about, values.AUTHOR_DATE, 2))


def out_of_five(col: Column) -> Column:
    """Every 'Name N out of 5' as 'Name: N/5', joined by ' | '."""
    names = F.regexp_extract_all(text(col), F.lit(values.OUT_OF_FIVE), F.lit(1))
    marks = F.regexp_extract_all(text(col), F.lit(values.OUT_OF_FIVE), F.lit(2))
    lines = F.zip_with(
        names, marks,
        lambda n, m: F.concat(F.btrim(n, F.lit(" \t\n\r")), F.lit(": "), m, F.lit("/5")),
    )
    return F.nullif(F.array_join(lines, " | "), F.lit(""))


def rival_links(html: Column) -> Column:
    """Anchors whose address names a rival, as 'text: address'."""
    urls = F.regexp_extract_all(text(html), F.lit(values.ANCHOR), F.lit(1))
    names = F.regexp_extract_all(text(html), F.lit(values.ANCHOR), F.lit(2))
    lines = F.zip_with(
        names, urls,
        lambda n, u: F.when(
            contains_any(F.lower(u), values.RIVAL_URL_MARKS),
            F.concat(F.btrim(n), F.lit(": "), u),
        ),
    )
    return F.nullif(F.array_join(F.array_compact(lines), " | "), F.lit(""))


def rival_ratings(section: Column, html: Column, scored: Column) -> Column:
    """The rivals section, else rival links, else the scored list."""
    own = F.nullif(clean_text(section), F.lit(""))
    return F.coalesce(own, rival_links(html), out_of_five(scored))


def _walk(source: Column, matches: Column, describe) -> Column:
    """Visit matches from left to right, giving each the text before and after it."""
    start = F.struct(
        source.alias("rest"), F.array().cast(RIVAL_TYPE).alias("out")
    )

    def step(acc: Column, match: Column) -> Column:
        begin = F.position(match, acc["rest"])
        rest = F.substr(acc["rest"], begin + F.length(match))
        taken = F.length(source) - F.length(rest)
        item = describe(match, rest, taken - F.length(match))
        return F.struct(
            rest.alias("rest"), F.concat(acc["out"], F.array(item)).alias("out")
        )

    return F.aggregate(matches, start, step)["out"]


def parse_rivals(
    rivals: Column, dedupe: bool = True, limit: int = values.RIVAL_LIMIT,
    context_chars: int | None = values.RIVAL_CONTEXT_CHARS, name_chars: int | None = values.RIVAL_NAME_CHARS,
) -> Column:
    """array<struct<name,rating,context>> of the first rivals named in the text.

    'Name: 4.5/5' entries first; without any, names in front of web addresses.
    The context is what follows the next ':' up to '|' within the next ``context_chars``
    characters; a tail that is a web address gives no context.  A name in front of an address begins at most
    ``name_chars`` before it.  None lifts either bound.
    """
    source = text(rivals)
    entries = F.regexp_extract_all(source, F.lit(values.RIVAL_RATING), F.lit(0))
    urls = F.regexp_extract_all(source, F.lit(r"https?://\S+"), F.lit(0))

    def rated(match: Column, rest: Column, _before: Column) -> Column:
        tail = rest if context_chars is None else F.left(rest, F.lit(context_chars))
        context = F.btrim(F.regexp_extract(tail, values.RIVAL_CONTEXT, 1))
        return F.struct(
            F.btrim(F.regexp_extract(match, values.RIVAL_RATING, 1)).alias("name"),
            F.concat(F.regexp_extract(match, values.RIVAL_RATING, 2), F.lit("/5")).alias("rating"),
            F.when(context.startswith("//"), F.lit("")).otherwise(context).alias("context"),
        )

    def linked(_match: Column, _rest: Column, before: Column) -> Column:
        reach = before if name_chars is None else F.least(before, F.lit(name_chars))
        head = F.substr(source, before - reach + 1, reach)
        return F.struct(
            F.btrim(F.regexp_extract(head, values.RIVAL_NAME_BEFORE_URL, 1)).alias("name"),
            F.lit("").alias("rating"),
            F.lit(values.RIVAL_DEFAULT_CONTEXT).alias("context"),
        )

    out = F.when(F.size(entries) > 0, _walk(source, entries, rated)).otherwise(
        _walk(source, urls, linked)
    )
    if dedupe:
        named = F.filter(out, lambda r: r["name"] != "")
        keyed = let(named, lambda rs: F.struct(
            rs.alias("rivals"), F.transform(rs, lambda r: F.lower(r["name"])).alias("names")
        ))
        out = let(keyed, lambda s: F.filter(
            s["rivals"],
            lambda r, i: F.array_position(s["names"], F.lower(r["name"])) == i + 1,
        ))
    return F.slice(out, 1, limit)


def rival_columns(rivals: Column, count: int = 3) -> dict[str, Column]:
    """Flat name, rating, context of the first rivals; '' where there is none."""
    out = {}
    for i in range(count):
        item = F.get(rivals, F.lit(i))
        context = F.coalesce(
            F.nullif(item["context"], F.lit("")), F.lit(values.RIVAL_DEFAULT_CONTEXT)
        )
        out[f"rival_{i + 1}_name"] = F.coalesce(item["name"], F.lit(""))
        out[f"rival_{i + 1}_rating"] = F.coalesce(item["rating"], F.lit(""))
        out[f"rival_{i + 1}_context"] = F.when(item.isNull(), F.lit("")).otherwise(context)
    return out


def prose_specs(article: Column) -> dict[str, Column]:
    t = F.lower(text(article))
    drive = F.coalesce(*[F.when(t.contains(d), d.upper()) for d in values.PROSE_DRIVES])
    return {
        "fuel": F.coalesce(*[F.when(t.contains(f), f) for f in values.PROSE_FUELS]),
        "hp": found(t, values.PROSE_POWER),
        "sprint": found(t, values.PROSE_SPRINT),
        "drive": drive,
        "gearbox": F.when(t.contains("manual"), "manual").when(t.contains("auto"), "auto"),
        "mpg": found(t, values.PROSE_MPG),
    }


def html_prices(html: Column, marks: Sequence[str] = values.PRICE_MARKS) -> Column:
    """Distinct prices in order: marked elements, else every text chunk with a pound sign.

    A mark is text in an opening tag.  A marked element is read whole, its inner
    tags left out; character references count as their characters.
    """
    def first_price(chunk: Column) -> Column:
        digits = F.replace(F.regexp_extract(chunk, values.POUNDS, 1), F.lit(","), F.lit(""))
        return F.nullif(digits, F.lit("")).try_cast("double")

    def words(inside: Column) -> Column:
        return decode(F.regexp_replace(inside, "<[^>]+>", ""))

    def in_marks(page: Column, found: Column) -> Column:
        """Prices of the elements of the first mark, then of the next."""
        def marked(mark: str) -> Column:
            return F.filter(found, lambda span: F.get(page["tags"], span["at"]).contains(mark))

        own = F.concat(*map(marked, marks))
        return F.array_compact(F.transform(own, lambda span: first_price(words(inside(page, span)))))

    def any_mark(source: Column) -> Column:
        return reduce(Column.__or__, [source.contains(mark) for mark in marks])

    def read(source: Column) -> Column:
        walked = let(parse(source), lambda page: let(
            spans(page, lambda tag, _: any_mark(tag)), lambda found: in_marks(page, found)))
        in_marked = F.when(any_mark(source), walked).otherwise(F.array().cast("array<double>"))
        chunks = F.filter(
            F.transform(F.split(source, "<[^>]+>"), decode), lambda c: c.contains("£"))
        in_chunks = F.array_compact(F.transform(chunks, first_price))
        return let(in_marked, lambda prices: F.array_distinct(F.when(F.size(prices) > 0, prices).otherwise(in_chunks)))

    return let(text(html), read)


def answer_json(answer: Column, schema: str = PRICE_ANSWER) -> Column:
    """First '{' to last '}' of an answer as a struct; NULL when it is no JSON object."""
    body = found(answer, r"(?s)\{.*\}", 0)
    parsed = F.from_json(body, f"{schema}, _bad string", {
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad",
    })
    return let(
        parsed, lambda p: F.when(p.isNotNull() & p["_bad"].isNull(), p.dropFields("_bad"))
    )


def boilerplate(
    col: Column,
    strong: Sequence[str] = values.STRONG_BOILERPLATE,
    weak: Sequence[str] = values.WEAK_BOILERPLATE,
    hits: int = values.BOILERPLATE_HITS,
) -> Column:
    """True on any strong pattern or on enough distinct patterns."""
    t = F.lower(text(col))
    sure = F.lit(False)
    for pattern in strong:
        sure = sure | t.rlike(pattern)
    # a strong hit decides alone, so only the weak ones need counting
    count = sum((t.rlike(p).cast("int") for p in weak), F.lit(0))
    return sure | (count >= hits)
