"""Texts composed per row: specs strings, summaries, essences, prompts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalith import values
from catalith.functions import vehicle
from catalith.functions.text import (
    blank_to_null, clean_years, labelled, nonempty, number,
    one_decimal, pair, text, value_range, whole, word_limit,
)


def specs_string(c: dict[str, Column]) -> Column:
    """'label: value' parts; ranges collapse when both ends agree."""
    v = {name: blank_to_null(col) for name, col in c.items()}
    none = F.lit(None).cast("string")
    parts = [
        ("Body", v["body"]),
        ("Engine", v["engine"]),
        ("Power (bhp)", v["power"]),
        ("Transmission", v["gearbox"]),
        ("Doors", v["doors"]),
        ("Seats", v["seats"]),
        ("MPG", value_range(v["mpg_min"], v.get("mpg_max", none))),
        ("Insurance Group", value_range(v["insurance_min"], v.get("insurance_max", none))),
        ("0-60 mph (s)", value_range(v["sprint_min"], v.get("sprint_max", none))),
        ("Length (mm)", v["length"]),
        ("Width (mm)", v.get("width", none)),
        ("Height (mm)", v.get("height", none)),
        ("Luggage (L)", v["boot"]),
        # years keep both ends even when they agree
        (
            "Years",
            F.when(
                v["year_start"].isNotNull() & v["year_end"].isNotNull(),
                F.concat(v["year_start"], F.lit("-"), v["year_end"]),
            ).otherwise(F.coalesce(v["year_start"], v["year_end"])),
        ),
    ]
    return labelled(parts, ": ", "; ")


def specs_text(c: dict[str, Column]) -> Column:
    power = F.nullif(text(c["power"]), F.lit(""))
    rest = [
        ("Transmission", c["gearbox"]), ("Doors", c["doors"]), ("Seats", c["seats"]),
        ("Engine", c["engine"]), ("Fuel", c["fuel"]), ("Body", c["body"]),
    ]
    return F.concat_ws(
        ", ",
        F.concat(F.lit("Power: "), power, F.lit(" bhp")),
        *[pair(label, F.nullif(text(col), F.lit(""))) for label, col in rest],
    )


def specs_compact(
    sprint: Column, gearbox: Column, fuel: Column, seats: Column, boot: Column, mpg: Column
) -> Column:
    return F.concat_ws(
        "; ",
        F.concat(F.lit("0–62mph "), one_decimal(sprint), F.lit("s")),
        F.nullif(text(gearbox), F.lit("")),
        F.nullif(text(fuel), F.lit("")),
        F.concat(F.floor(seats).cast("string"), F.lit(" seats")),
        F.concat(whole(boot).cast("string"), F.lit("L boot")),
        F.concat(whole(mpg).cast("string"), F.lit("mpg")),
    )


def specs_summary(s: dict[str, Column], body: Column) -> Column:
    """'body, fuel, 150hp, 0–62mph …s, … .' from optional text fields."""
    def unit(name: str, before: str, after: str) -> Column:
        value = F.nullif(s.get(name, F.lit(None).cast("string")), F.lit(""))
        return F.concat(F.lit(before), value, F.lit(after))

    core = F.concat_ws(
        ", ",
        unit("hp", "", "hp"), unit("sprint", "0–62mph ", "s"), unit("drive", "", ""),
        unit("gearbox", "", ""), unit("mpg", "", "mpg"), unit("boot", "", "L boot"),
        unit("seats", "", " seats"),
    )
    core = F.concat(F.coalesce(F.nullif(core, F.lit("")), F.lit(values.SPECS_VARY)), F.lit("."))
    return F.concat_ws(
        ", ", F.nullif(text(body), F.lit("")), F.nullif(text(s["fuel"]), F.lit("")), core
    )


def essence_main(
    df: DataFrame, out: str, *, make: Column, model: Column, years: Column, body: Column,
    engine: Column, gearbox: Column, sprint: Column, mpg: Column, boot: Column, seats: Column,
    length: Column, words: int = values.ESSENCE_WORDS,
) -> DataFrame:
    """Add the row essence: intro, driving, practicality, highlights, buyer fit."""
    staged = df.withColumns({
        "_years": clean_years(model, years),
        "_size": vehicle.size_descriptor(body, length),
        "_drive": F.array_join(
            vehicle.driving_phrases(engine, gearbox, vehicle.performance(sprint)), ", "
        ),
        "_economy": vehicle.economy(mpg),
        "_room": F.concat_ws(
            ", ",
            F.nullif(vehicle.boot(boot), F.lit("")),
            F.concat(F.floor(seats).cast("string"), F.lit(" seats")),
        ),
    })

    def sentence(before: str, name: str) -> Column:
        return F.concat(F.lit(before), F.nullif(F.col(name), F.lit("")), F.lit("."))

    intro = F.concat(
        F.lit("The "), text(make), F.lit(" "), text(model), F.lit(" ("), F.col("_years"),
        F.lit(") is a "), F.col("_size"), F.lit("."),
    )
    whole_text = F.concat_ws(
        " ",
        intro,
        sentence("It delivers ", "_drive"),
        sentence("The boot and seating offer ", "_room"),
        sentence("Key highlights: ", "_economy"),
        F.concat(
            F.lit("Best suited for: "),
            vehicle.buyer_fit(engine, body, F.col("_economy")),
            F.lit("."),
        ),
    )
    return staged.withColumn(out, word_limit(whole_text, words)).drop(
        "_years", "_size", "_drive", "_economy", "_room"
    )


def essence_from_fields(
    *, make: Column, model: Column, years: Column, body: Column, size: Column, pros: Column,
    cons: Column, engine: Column, pace: Column, seats: Column, boot: Column,
    words: int = values.FIELD_ESSENCE_WORDS,
) -> Column:
    def given(col: Column) -> Column:
        return F.nullif(text(col), F.lit(""))

    shape = (
        F.when(given(body).isNotNull() & given(size).isNotNull(),
               F.concat(F.lit("a "), size, F.lit(" "), body))
        .when(given(body).isNotNull(), F.concat(F.lit("a "), body))
        .otherwise("a capable option")
    )
    name = F.btrim(F.concat(text(make), F.lit(" "), text(model)))
    details = F.concat_ws(
        ", ", given(engine), given(pace),
        F.concat(given(seats), F.lit(" seats")), F.concat(given(boot), F.lit("L boot")),
    )
    whole_text = F.concat_ws(
        " ",
        F.concat(F.lit("The "), name, F.lit(" ("), text(years), F.lit(") is "), shape, F.lit(".")),
        F.coalesce(
            F.concat(F.lit("Strengths include "), given(pros), F.lit(".")),
            F.lit(values.FIELD_STRENGTH_DEFAULT),
        ),
        F.coalesce(
            F.concat(F.lit("Trade-offs: "), given(cons), F.lit(".")),
            F.lit(values.FIELD_TRADE_DEFAULT),
        ),
        F.concat(F.lit("It features "), F.nullif(details, F.lit("")), F.lit(".")),
        F.lit(values.FIELD_VERDICT),
    )
    return word_limit(whole_text, words)


def table_specs(c: dict[str, Column], prose: dict[str, Column]) -> dict[str, Column]:
    """Specs from table columns; prose fills the gaps only when the table has no fuel."""
    table = {
        "engine": nonempty(c["engine"]),
        "fuel": F.lower(nonempty(c["fuel"])),
        "body": F.lower(nonempty(c["body"])),
        "hp": whole(number(c["power"])).cast("string"),
        "sprint": c["sprint"],
        "seats": F.floor(number(c["seats"])).cast("string"),
        "boot": F.floor(number(c["boot"])).cast("string"),
    }
    no_fuel = table["fuel"].isNull()
    none = F.lit(None).cast("string")
    merged = dict(table)
    for name, found in prose.items():
        own = table.get(name, none)
        merged[name] = F.when(no_fuel, F.coalesce(own, found)).otherwise(own)
    return merged


def vector_texts(
    *, model: Column, years: Column, essence: Column, rivals: Column, summary: Column,
    uses: Column,
) -> dict[str, Column]:
    """The three texts to embed; ``rivals`` is array<struct<name,rating,context>>."""
    contexts = F.array_join(
        F.filter(F.transform(rivals, lambda r: F.btrim(text(r["context"]))), lambda x: x != ""),
        ", ",
    )
    named = F.filter(rivals, lambda r: text(r["name"]) != "")
    listed = F.array_join(
        F.transform(
            named,
            lambda r: F.btrim(
                F.concat(
                    F.btrim(r["name"]), F.lit(" ("), text(r["rating"]), F.lit("): "),
                    F.btrim(text(r["context"])),
                ),
                F.lit(": "),
            ),
        ),
        " | ",
    )
    return {
        "text_main": F.btrim(F.concat(
            essence, F.lit(" Rivals: "), contexts, F.lit(". Use cases: "), text(uses),
            F.lit(". Key facts: "), summary, F.lit("."),
        )),
        "text_rivals": F.concat(text(model), F.lit(" rivals: "), listed),
        "text_specs": F.concat(text(model), F.lit(" "), text(years), F.lit(". "), summary),
    }


def rivals_text(rivals_json: Column) -> Column:
    """JSON or single-quoted list of rivals to 'name: context | name'."""
    parsed = F.from_json(
        rivals_json, "array<struct<name string, context string>>",
        {"allowSingleQuotes": "true", "mode": "PERMISSIVE"},
    )
    named = F.filter(parsed, lambda r: F.btrim(text(r["name"])) != "")
    line = F.transform(
        named,
        lambda r: F.concat_ws(
            ": ", F.btrim(r["name"]), F.nullif(F.btrim(text(r["context"])), F.lit(""))
        ),
    )
    return F.coalesce(F.array_join(line, " | "), F.lit(""))


def rivals_json_default(*candidates: Column) -> Column:
    return F.coalesce(*candidates, F.lit("[]"))


def display_name(answer: Column, make: Column, model: Column) -> Column:
    cleaned = F.btrim(F.translate(answer, "\"'", ""))
    fallback = F.concat(text(make), F.lit(" "), text(model))
    return F.coalesce(cleaned, fallback)


def car_age(year_start: Column, year_end: Column, year: int = values.MILEAGE_AGE_YEAR) -> Column:
    """Age in years from the last digit-only year, else 'unknown'."""
    def digits(col: Column) -> Column:
        return F.when(text(col).rlike(values.DIGITS_PATTERN), col.try_cast("int"))

    age = F.lit(year) - F.coalesce(digits(year_end), digits(year_start))
    return F.coalesce(age.cast("string"), F.lit("unknown"))


# Prompt templates are data; pass your own to ``text.fill_template``.
PROMPTS = {
    "fuel": (
        "Name the fuel of {make} {model} with engine {engine}. Answer with one of these and nothing else: "
        "petrol, diesel, mild hybrid, plug in hybrid, electric."
    ),
    "price": (
        "Give the UK used price range in GBP for {make} {model}, {years} "
        "({year_start} to {year_end}), body {body}, engine {engine}, {power} bhp, {gearbox}, "
        "{doors} doors, {seats} seats. Answer as JSON with min_used_price_gbp, "
        "max_used_price_gbp, confidence, notes."
    ),
    "specs": (
        "Give mpg, insurance group and 0-60 time for {make} {model}, {years}, engine {engine}, "
        "{power} bhp, {gearbox}. Known: mpg {mpg}, insurance {insurance}, 0-60 {sprint}. Answer "
        "as JSON with mpg_low_min, insurance_group_min, zero_to_sixty_secs_min, confidence, notes."
    ),
    "mileage": (
        "Suggest a safe mileage band for {make} {model}, {years}, body {body}, "
        "{year_start}-{year_end} (age {age} years), engine {engine}, fuel {fuel}, {power} bhp, "
        "{gearbox}. Answer only with the band in the form x–y miles."
    ),
    "display": (
        "Write the official display name of {make} {model}, {years}, {year_start}-{year_end}, "
        "body {body}, engine {engine}, {power} bhp, {gearbox}, {doors} doors, {seats} seats."
    ),
}


