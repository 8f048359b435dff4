"""Rule classification of catalogue rows: size, body, fuel, audience, notes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from catalith import values
from catalith.functions.rules import classify, contains_any, keep, lookup
from catalith.functions.text import norm, nonempty, text


def body_or_car(body: Column) -> Column:
    return F.coalesce(nonempty(body), F.lit("car"))


def size_bucket(body: Column, length: Column) -> Column:
    return classify(values.SIZE_BUCKET, norm(body), length, body_or_car(body))


def size_descriptor(body: Column, length: Column) -> Column:
    return classify(values.SIZE_DESCRIPTOR, norm(body), length, body_or_car(body))


def coarse_size(body: Column, length: Column) -> Column:
    return classify(values.COARSE_SIZE, F.lower(text(body)), length)


def size_class(body: Column, length: Column) -> Column:
    return classify(values.SIZE_CLASS, body, length)


def body_label(body: Column, length: Column) -> Column:
    return classify(values.BODY_LABEL, norm(body), length)


def canonical_label(answer: Column) -> Column:
    lowered = F.replace(
        F.lower(F.btrim(text(answer))), F.lit("hatch back"), F.lit("hatchback")
    )
    return F.when(lowered.isin(*values.CANONICAL_LABELS), lowered).otherwise(
        classify(values.LABEL_CASCADE, lowered)
    )


def performance(seconds: Column) -> Column:
    return classify(values.PERFORMANCE, F.lit(""), seconds, "unknown")


def economy(mpg: Column) -> Column:
    return classify(values.ECONOMY, F.lit(""), mpg, "")


def boot(litres: Column) -> Column:
    return classify(values.BOOT, F.lit(""), litres, "")


def variant_sentence(engine: Column, fuel: Column, gearbox: Column, drive: Column) -> Column:
    e, f = F.lower(text(engine)), F.lower(text(fuel))
    first = (
        F.when(contains_any(e, ("tdi", "dci", "cdi")) | (f == "diesel"), values.VARIANT_DIESEL)
        .when(
            contains_any(e, ("phev", "plug-in")) | f.isin("phev", "plug-in hybrid"),
            values.VARIANT_PLUGIN,
        )
        .when(e.contains("hybrid") | (f == "hybrid"), values.VARIANT_HYBRID)
        .when(
            contains_any(e, ("ev", "electric")) | f.isin("ev", "electric"),
            values.VARIANT_ELECTRIC,
        )
        .otherwise(
            F.coalesce(
                classify(values.VARIANT_ENGINE, e), F.when(f == "petrol", values.VARIANT_PETROL)
            )
        )
    )
    lines = keep(
        first,
        classify(values.VARIANT_GEARBOX, F.lower(text(gearbox))),
        classify(values.VARIANT_DRIVE, F.lower(text(drive))),
    )
    rest = F.array_join(F.slice(lines, 2, 2), ", ")
    head = F.get(lines, F.lit(0))
    return (
        F.when(F.size(lines) == 0, values.VARIANT_NONE)
        .when(F.size(lines) == 1, F.concat(F.lit("This variant is "), head, F.lit(".")))
        .otherwise(F.concat(F.lit("This variant is "), head, F.lit(", with "), rest, F.lit(".")))
    )


def variant_notes(
    engine: Column, fuel: Column, gearbox: Column, drive: Column, rules=values.NOTE_RULES,
) -> Column:
    """All notes whose rule holds, in the rules' order; the first two as one text."""
    fields = {
        "badge": text(engine), "engine": norm(engine), "fuel": norm(fuel), "gearbox": norm(gearbox), "drive": norm(drive)}

    def holds(test: tuple) -> Column:
        field, wanted = test
        if field.startswith("unmarked "):  # the field has none of the words
            return ~contains_any(fields[field.removeprefix("unmarked ")], wanted)
        return fields[field].rlike(wanted) if isinstance(wanted, str) else contains_any(fields[field], wanted)

    def applies(some: tuple, none: tuple) -> Column:
        found = reduce(Column.__or__, map(holds, some))
        return reduce(lambda a, b: a & ~b, map(holds, none), found)

    notes = keep(*[F.when(applies(some, none), values.NOTE_TEXTS[note]) for note, some, none in rules])
    joined = F.array_join(F.slice(notes, 1, 2), " ")
    return F.when(F.size(notes) == 0, values.NOTE_TEXTS["none"]).otherwise(joined)


def use_case(body: Column) -> Column:
    return classify(values.USE_CASES, F.lower(text(body)), default=values.USE_CASE_DEFAULT)


def highlights(body: Column) -> Column:
    return classify(values.HIGHLIGHTS, F.lower(text(body)), default=values.HIGHLIGHTS_DEFAULT)


def buyer_fit(engine: Column, body: Column, economy_label: Column) -> Column:
    e = norm(engine)
    fits = F.array_distinct(
        keep(
            F.when(contains_any(e, values.BUYER_ECO_WORDS), values.BUYER_ECO),
            F.when(
                contains_any(e, values.BUYER_DIESEL_WORDS)
                | economy_label.isin(*values.BUYER_GOOD_ECONOMY),
                values.BUYER_MILES,
            ),
            F.when(contains_any(norm(body), values.BUYER_FAMILY_WORDS), values.BUYER_FAMILY),
        )
    )
    return F.when(F.size(fits) == 0, values.BUYER_DEFAULT).otherwise(
        F.array_join(F.slice(fits, 1, 2), ", ")
    )


def fuel_type(engine: Column, answer: Column | None = None) -> Column:
    """The answer when it names a valid type, else the engine rule."""
    by_rule = classify(values.FUEL_RULES, F.lower(text(engine)), default="petrol")
    if answer is None:
        return by_rule
    lowered = F.lower(text(answer))
    named = F.coalesce(*[F.when(lowered.contains(t), t) for t in values.FUEL_TYPES])
    return F.coalesce(named, by_rule)


def mileage_band(fuel: Column, make: Column) -> Column:
    f, m = F.lower(text(fuel)), F.lower(text(make))
    return (
        F.when(contains_any(f, values.MILEAGE_FUELS), values.SHORT_MILEAGE)
        .when(contains_any(m, values.MILEAGE_LASTING_MAKES), values.LASTING_MILEAGE)
        .when(contains_any(m, values.MILEAGE_HIGH_MAKES), values.HIGH_MILEAGE)
        .when(f.contains("diesel"), values.HIGH_MILEAGE)
        .otherwise(values.SHORT_MILEAGE)
    )


def body_keyword(words_in: Column, fallback: Column) -> Column:
    """First keyword found in the text, else the row's own body text."""
    lowered = F.lower(text(words_in))
    named = F.coalesce(*[F.when(lowered.contains(k), k) for k in values.BODY_KEYWORDS])
    return F.coalesce(named, F.nullif(F.lower(F.btrim(text(fallback))), F.lit("")))


def family_essence(make: Column, model: Column, years: Column, size: Column) -> Column:
    audience = classify(values.AUDIENCES, size, default=values.AUDIENCE_DEFAULT)
    strength = lookup(values.STRENGTHS, size, values.STRENGTH_DEFAULT)
    hint = lookup(values.BRAND_HINTS, norm(make), values.BRAND_HINT_DEFAULT)
    return F.concat(
        F.lit("The "), text(make), F.lit(" "), text(model), F.lit(" ("), text(years),
        F.lit(") is a "), size, F.lit(". It’s "), audience, F.lit(". Strengths include "),
        strength, F.lit(" and "), hint, F.lit("."),
    )


def family_essence_v2(
    make: Column, model: Column, years: Column, body: Column, size: Column
) -> Column:
    own = nonempty(body)
    shape = (
        F.when(own.isNotNull() & size.isNotNull(), F.concat(F.lit("a "), size, F.lit(" "), own))
        .when(own.isNotNull(), F.concat(F.lit("a "), own))
        .otherwise("a versatile option")
    )
    name = F.btrim(F.concat(text(make), F.lit(" "), text(model)))
    return F.concat(
        F.lit("The "), name, F.lit(" ("), text(years), F.lit(") is "), shape,
        F.lit(". It suits "), use_case(body), F.lit(", with emphasis on "), highlights(body),
        F.lit(f". {values.FAMILY_OUTRO}"),
    )


def driving_phrases(engine: Column, gearbox: Column, pace: Column) -> Column:
    """Array of driving phrases for engine, gearbox and performance label."""
    return keep(
        classify(values.DRIVING_ENGINE, norm(engine)),
        classify(values.DRIVING_GEARBOX, norm(gearbox)),
        F.when(
            pace.isin(*values.DRIVING_PACE), lookup(values.DRIVING_PACE, pace, "")
        ),
    )


