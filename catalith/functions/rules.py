"""Ordered rule tables rendered as one CASE expression.

A rule pack is plain data (see ``catalith.values``).  The first rule that holds
gives the label.  The text side is matched by substring, equality or pattern,
the number side by a half-open interval.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class Rule(NamedTuple):
    label: str
    any_of: tuple[str, ...] = ()  # text contains at least one
    all_of: tuple[str, ...] = ()  # text contains every one
    equals: tuple[str, ...] = ()  # text is one of these
    pattern: str = ""  # text matches
    at_least: float | None = None  # number >= bound
    below: float | None = None  # number < bound
    or_missing: bool = False  # the number may also be null
    missing: bool = False  # the number must be null


def contains_any(text: Column, words: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(w) for w in words])


def contains_all(text: Column, words: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [text.contains(w) for w in words])


def condition(rule: Rule, text: Column, number: Column | None = None) -> Column:
    """The boolean of one rule; null inputs count as no match."""
    parts: list[Column] = []
    if rule.any_of:
        parts.append(contains_any(text, rule.any_of))
    if rule.all_of:
        parts.append(contains_all(text, rule.all_of))
    if rule.equals:
        parts.append(text.isin(*rule.equals))
    if rule.pattern:
        parts.append(text.rlike(rule.pattern))
    if rule.missing:
        parts.append(number.isNull())
    elif rule.at_least is not None or rule.below is not None:
        bounds = []
        if rule.at_least is not None:
            bounds.append(number >= F.lit(float(rule.at_least)))
        if rule.below is not None:
            bounds.append(number < F.lit(float(rule.below)))
        inside = reduce(lambda a, b: a & b, bounds)
        parts.append((number.isNull() | inside) if rule.or_missing else inside)
    if not parts:
        raise ValueError(f"rule {rule.label!r} has no condition")
    return F.coalesce(reduce(lambda a, b: a & b, parts), F.lit(False))


def classify(
    rules: Sequence[Rule],
    text: Column,
    number: Column | None = None,
    default: Column | str | None = None,
) -> Column:
    """First matching label, else ``default`` (null when not given)."""
    expr = None
    for rule in rules:
        cond, label = condition(rule, text, number), F.lit(rule.label)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    if default is None:
        return expr
    return expr.otherwise(default if isinstance(default, Column) else F.lit(default))


def lookup(table: dict[str, str], key: Column, default: Column | str) -> Column:
    """Constant-table lookup by equality."""
    entries = [F.lit(x) for pair in table.items() for x in pair]
    fallback = default if isinstance(default, Column) else F.lit(default)
    return F.coalesce(F.try_element_at(F.create_map(*entries), key), fallback)


def keep(*parts: Column) -> Column:
    """Array of the non-null parts, in order."""
    return F.array_compact(F.array(*parts))
