"""Whole elements and character references of a page, as column expressions."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from catalith.functions.text import let

REFERENCE = r"&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"
NAMED = {**{name: chr(code) for name, code in name2codepoint.items()}, "apos": "'"}
# Numbers 128 to 159 stand for Windows characters on pages; a no-break space counts as a blank.
WINDOWS = {c: bytes([c]).decode("cp1252", "replace") for c in range(128, 160)}
ODD_FROM = "".join(map(chr, WINDOWS)) + "\u00a0"
ODD_TO = "".join(WINDOWS.values()) + " "


def _numbered(code: Column) -> Column:
    """The character of a code point; what is no character becomes the replacement mark."""
    valid = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    return F.when(
        valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    ).otherwise(F.lit("\ufffd"))


def _character(name: Column, known: Column) -> Column:
    hexed = F.conv(F.substr(name, F.lit(3)), 16, 10).cast("bigint")
    char = F.when(name.rlike("^#[xX]"), _numbered(hexed)).when(
        name.startswith("#"), _numbered(F.substr(name, F.lit(2)).cast("bigint"))
    ).otherwise(F.try_element_at(known, name))
    return F.coalesce(F.translate(char, ODD_FROM, ODD_TO), F.concat(F.lit("&"), name, F.lit(";")))


def decode(col: Column) -> Column:
    """Decimal, hexadecimal and named references as characters, each once; unknown names stay."""
    # One literal, folded once to a map: hundreds of literals would slow the analysis of every plan.
    pairs = F.lit("\x02".join(f"{name}\x01{char}" for name, char in NAMED.items()))
    known = F.str_to_map(pairs, F.lit("\x02"), F.lit("\x01"))

    def read(source: Column) -> Column:
        between = F.split(source, REFERENCE, -1)
        names = F.regexp_extract_all(source, F.lit(REFERENCE), F.lit(1))
        parts = F.zip_with(between, names, lambda b, n: F.concat(
            b, F.when(n.isNull(), "").otherwise(_character(n, known))))
        return F.when(F.contains(source, F.lit("&")), F.array_join(parts, "")).otherwise(source)

    return let(col, read)


def has_class(tag: Column, token: str) -> Column:
    """Whether an opening tag's class attribute holds the token as a whole word."""
    word = re.escape(token)
    quoted = "|".join(rf"{q}(?:[^{q}]*\s)?{word}(?:\s[^{q}]*)?{q}" for q in "\"'")
    return tag.rlike(rf"(?s)\s(?i:class)\s*=\s*(?:{quoted}|{word}(?=[\s>]))")


def parse(source: Column, names: Sequence[str] | None = None) -> Column:
    """The tags of a text, their marks ('div', '/div'), and the pieces between them; ``names`` limits the tags."""
    name = "|".join(map(re.escape, names)) if names else r"[A-Za-z][A-Za-z0-9-]*"
    pattern = rf"(?is)<(/?(?:{name}))(?=[\s/>])[^>]*>"
    return F.struct(
        F.regexp_extract_all(source, F.lit(pattern), F.lit(0)).alias("tags"),
        F.lower(F.array_join(F.regexp_extract_all(source, F.lit(pattern), F.lit(1)), "\x01")).alias("marks"),
        F.split(source, pattern, -1).alias("between"))


def spans(page: Column, accepted: Callable[[Column, Column], Column], outer: bool = False) -> Column:
    """array<struct<at,name,until>>: where each accepted element begins and ends, in order of the page.

    ``page`` comes from ``parse`` and ``accepted`` maps an opening tag and its name to a condition.  One pass
    goes over the tags whose names occur among the accepted ones, with a stack of the accepted elements
    that are open; each holds how many tags of its name are open within it.  So the work is the tags times
    the depth to which accepted elements are nested, whatever their number.  What is never closed ends with the text.
    With ``outer`` no element inside another accepted one is listed.
    """
    def entry(mark: Column, i: Column) -> Column:
        tag = F.get(page["tags"], i)
        name = F.ltrim(mark, F.lit("/"))
        opens = ~mark.startswith("/") & ~tag.endswith("/>")
        step = F.when(mark.startswith("/"), -1).when(opens, 1).otherwise(0)
        return F.struct(
            i.alias("i"), name.alias("name"), step.alias("step"), (opens & accepted(tag, name)).alias("ok"))

    held = "array<struct<at:int,name:string,depth:int>>"
    ended = "array<struct<at:int,name:string,until:int>>"

    def step(acc: Column, x: Column) -> Column:
        inside = F.size(acc["open"]) > 0
        moved = F.when(~inside | (x["step"] == 0), acc["open"]).otherwise(F.transform(acc["open"], lambda e: F.struct(
            e["at"].alias("at"), e["name"].alias("name"),
            F.when(e["name"] == x["name"], e["depth"] + x["step"]).otherwise(e["depth"]).alias("depth"))))
        pushed = F.array(F.struct(x["i"].alias("at"), x["name"].alias("name"), F.lit(1).alias("depth")))
        new = x["ok"] & ~inside if outer else x["ok"]

        def settled(now: Column) -> Column:
            # only the tag's own name can have ended, and a closing tag opens nothing
            ends = (x["step"] < 0) & F.exists(now, lambda e: e["depth"] == 0)
            closed = F.transform(F.filter(now, lambda e: e["depth"] == 0), lambda e: F.struct(
                e["at"].alias("at"), e["name"].alias("name"), x["i"].alias("until")))
            return F.struct(
                F.when(ends, F.filter(now, lambda e: e["depth"] > 0)).when(new, F.concat(now, pushed)).otherwise(now)
                .alias("open"),
                F.when(ends, F.concat(acc["done"], closed)).otherwise(acc["done"]).alias("done"))

        return F.when(inside | new, let(moved, settled)).otherwise(acc)

    def walk(steps: Column) -> Column:
        live = F.array_distinct(F.transform(F.filter(steps, lambda x: x["ok"]), lambda x: x["name"]))
        return let(live, lambda names: F.aggregate(
            F.filter(steps, lambda x: F.array_contains(names, x["name"])),
            F.struct(F.array().cast(held).alias("open"), F.array().cast(ended).alias("done")), step,
            lambda acc: F.array_sort(F.concat(acc["done"], F.transform(acc["open"], lambda e: F.struct(
                e["at"].alias("at"), e["name"].alias("name"), F.size(page["tags"]).alias("until")))))))

    return let(F.transform(F.filter(F.split(page["marks"], "\x01"), lambda m: m != ""), entry), walk)


def inside(page: Column, span: Column) -> Column:
    """The text of an element: the pieces and tags between its own tags."""
    count = span["until"] - span["at"]
    return F.array_join(F.zip_with(
        F.slice(page["between"], span["at"] + 2, count), F.slice(page["tags"], span["at"] + 2, count - 1),
        lambda piece, tag: F.concat(piece, F.coalesce(tag, F.lit("")))), "")


def elements(
    source: Column, tag: str | None, wanted: Callable[[Column], Column] | None = None,
    first: bool = False, outer: bool = False,
) -> Column:
    """array<string>: the whole inside of every element that ``wanted`` accepts, in order.

    ``tag`` names the elements, None means any; ``wanted`` maps an opening tag to a condition.  The
    end is where as many tags of the same name are closed as were opened; an element that is never
    closed runs to the end of the text.  Elements inside accepted ones are listed as well, but not
    with ``outer``; ``first`` lists only the first.  A missing text has no list, an empty one an empty list.
    """
    def accepted(mark: Column, _name: Column) -> Column:
        return wanted(mark) if wanted else F.lit(True)

    def read(page: Column) -> Column:
        return let(spans(page, accepted, outer), lambda found: F.transform(
            F.slice(found, 1, 1) if first else found, lambda span: inside(page, span)))

    return F.when(source.isNotNull(), let(parse(source, [tag] if tag else None), read))
