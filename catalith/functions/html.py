"""Page text, sections, markdown and fields on the tag stream, without a DOM tree.

Script, style and comments go first, because they may hold tags.  Elements are
read whole, up to the tag that closes them; one that nothing closes runs to the
end of the page, since pages leave tags unclosed.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from catalith.functions.extract import found
from catalith.functions.markup import decode, elements, has_class, inside, parse, spans
from catalith.functions.text import let, text

BLOCK_END = r"(?i)<(?:br|/p|p|/div|div|/li|/ul|/ol|/h[1-6]|h[1-6]|/tr|/title)\b[^>]*>"
LIST_ITEM = r"(?i)<li\b[^>]*>"


def strip_noise(html: Column) -> Column:
    out = F.regexp_replace(text(html), r"(?s)<!--.*?-->", "")
    out = F.regexp_replace(out, r"(?is)<script\b[^>]*>.*?</script>", "")
    return F.regexp_replace(out, r"(?is)<style\b[^>]*>.*?</style>", "")


def article(html: Column) -> Column:
    """The insides of all article elements in order, else the whole page."""
    def read(clean: Column) -> Column:
        inside = F.array_join(elements(clean, "article", outer=True), "<p>")
        return let(inside, lambda body: F.when(body != "", body).otherwise(clean))

    return let(strip_noise(html), read)


def lines(fragment: Column, glue: str) -> Column:
    """Markup to text: one line per block, list items marked '- ', blanks dropped."""
    flat = F.regexp_replace(fragment, r"[\t\r\n\f]+", " ")
    flat = F.regexp_replace(flat, LIST_ITEM, "\n- ")
    flat = F.regexp_replace(flat, BLOCK_END, "\n")
    flat = decode(F.regexp_replace(flat, r"<[^>]*>", ""))
    flat = F.regexp_replace(flat, r" {2,}", " ")
    kept = F.filter(
        F.transform(F.split(flat, "\n"), lambda x: F.btrim(x)),
        lambda x: (x != "") & (x != "-"),
    )
    return F.array_join(kept, glue)


def inline(fragment: Column) -> Column:
    """Markup to a single line of text."""
    return lines(F.regexp_replace(fragment, LIST_ITEM, "\n"), " ")


def sections(html: Column) -> Column:
    """array<struct<heading,text>>: the whole text first, then one entry per h2."""
    def section(halves: Column) -> Column:
        rest = F.coalesce(F.get(halves, F.lit(1)), F.lit(""))
        return F.struct(
            inline(F.get(halves, F.lit(0))).alias("heading"), lines(rest, "\n").alias("text")
        )

    def read(body: Column) -> Column:
        pieces = F.split(body, r"(?i)<h2\b[^>]*>")
        parts = F.transform(pieces, lambda p, i: F.when(
            i > 0, let(F.split(p, r"(?i)</h2>", 2), section)))
        parts = F.filter(parts, lambda s: (s["heading"] != "") & (s["text"] != ""))
        head = F.struct(F.lit("full_text").alias("heading"), lines(body, "\n").alias("text"))
        return F.concat(F.array(head), parts)

    return let(article(html), read)


def title(html: Column) -> Column:
    head = let(article(html), lambda body: F.get(elements(body, "h1", first=True), F.lit(0)))
    return let(inline(head), lambda t: F.when(t != "", t))


def markdown(html: Column) -> Column:
    """What follows the first h1: headings '##' and '###', list items '- '."""
    after = let(
        article(html), lambda body: F.coalesce(found(body, r"(?is)</h1>(.*)$"), body)
    )
    marked = F.regexp_replace(after, r"(?i)<h2\b[^>]*>", "<p>## ")
    marked = F.regexp_replace(marked, r"(?i)<h3\b[^>]*>", "<p>### ")
    return lines(marked, "\n\n")


class FieldRule(NamedTuple):
    """Where a field is found: tag, optional class token (a whole word); lower order wins."""

    field: str
    tag: str
    token: str = ""
    order: int = 1
    many: bool = False  # join all elements with ' | '
    min_chars: int = 1


DEFAULT_FIELDS = (
    FieldRule("title", "h1", order=1),
    FieldRule("title", "title", order=2),
    FieldRule("article", "article", order=1),
    FieldRule("glance", "div", "glance", order=1),
    FieldRule("pros", "ul", "pros", order=1, min_chars=6),
    FieldRule("cons", "ul", "cons", order=1, min_chars=6),
    FieldRule("rivals", "a", "rival-review-card", order=1, many=True),
)


def accepts(rule: FieldRule, tag: Column, name: Column) -> Column:
    own = name == rule.tag.lower()
    return own & has_class(tag, rule.token) if rule.token else own


def rule_value(page: Column, found: Column, rule: FieldRule) -> Column:
    """The rule's text from the page's elements, all of which are ``found`` already."""
    own = F.filter(found, lambda span: accepts(rule, F.get(page["tags"], span["at"]), span["name"]))
    hits = F.transform(own if rule.many else F.slice(own, 1, 1), lambda span: inside(page, span))
    if rule.many:
        value = F.array_join(F.filter(F.transform(hits, inline), lambda h: h != ""), " | ")
    elif rule.tag in ("ul", "ol"):
        value = F.regexp_replace(lines(F.get(hits, F.lit(0)), " | "), r"(^|\| )- ", "$1")
    else:
        value = inline(F.get(hits, F.lit(0)))
    return let(
        value, lambda v: F.when((F.length(v) >= rule.min_chars) & (v != "&"), v)
    )


def fields(html: Column, rules: Sequence[FieldRule] = DEFAULT_FIELDS) -> Column:
    """array<struct<field,value>>: per field the first rule that yields text.

    The page's tags are read and walked once for all rules.
    """
    names = list(dict.fromkeys(r.field for r in rules))
    tags = sorted({r.tag.lower() for r in rules})

    def read(page: Column, found: Column) -> Column:
        out = []
        for name in names:
            own = sorted((r for r in rules if r.field == name), key=lambda r: r.order)
            value = F.coalesce(*[rule_value(page, found, r) for r in own])
            out.append(F.struct(F.lit(name).alias("field"), value.alias("value")))
        return F.filter(F.array(*out), lambda s: s["value"].isNotNull())

    def any_rule(tag: Column, name: Column) -> Column:
        return reduce(Column.__or__, [accepts(r, tag, name) for r in rules])

    return let(parse(strip_noise(html), tags), lambda page: let(
        spans(page, any_rule), lambda found: read(page, found)))


def field_map(html: Column, rules: Sequence[FieldRule] = DEFAULT_FIELDS) -> Column:
    """The same as a map, for pages that go on as rows of columns."""
    return F.map_from_entries(fields(html, rules))
