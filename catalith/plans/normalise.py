"""Keys, normalisers and string projections over the catalogue rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from catalith import values
from catalith.functions import compose, extract, text, urls, vehicle
from catalith.plans.registry import query
from catalith.plans.views import view

C = F.col
NOW = "2025"  # what open-ended years mean in these runs


def num(name: str) -> Column:
    return text.number(C(name))


@query
def norm_ws(spark, sf):
    return view(spark, sf, "cars").select(
        "car_id",
        text.norm(C("make")).alias("make_norm"),
        text.collapse_ws(F.concat(C("make"), F.lit("\t x \n"), C("model"))).alias("squeezed"),
        text.norm(C("engine_type")).alias("engine_norm"),
    )


@query
def norm_years(spark, sf):
    return view(spark, sf, "cars").select(
        "car_id", text.norm_years(C("series_years")).alias("years_norm")
    )


@query
def family_id(spark, sf):
    make, model, years = C("make"), C("model"), C("series_years")
    return view(spark, sf, "cars").select(
        "car_id",
        text.family_key(make, model, years).alias("family_key"),
        text.family_phrase(make, model, years).alias("family_phrase"),
        text.price_key(make, model, years, C("year_start"), C("year_end"), C("engine_type"), NOW)
        .alias("price_key"),
        text.simple_key(make, model, years).alias("simple_key"),
    )


@query
def row_id(spark, sf):
    parts = [C(c) for c in ("make", "model", "series_years", "year_start", "year_end")]
    return view(spark, sf, "cars").select("car_id", text.row_key(*parts).alias("row_id"))


@query
def variant_id(spark, sf):
    family = text.family_phrase(C("make"), C("model"), C("series_years"))
    return view(spark, sf, "cars").select(
        "car_id", text.variant_key(family, C("engine_type"), C("car_id")).alias("variant_id")
    )


@query
def blank_to_null(spark, sf):
    return view(spark, sf, "cars").select(
        "car_id",
        text.blank_to_null(C("fuel_type")).alias("fuel"),
        text.or_placeholder(C("fuel_type")).alias("fuel_text"),
    )


@query
def norm_year(spark, sf):
    return view(spark, sf, "cars").select(
        "car_id",
        text.norm_year(C("year_end"), NOW).alias("year_end_price"),
        text.norm_year(C("year_end"), "2024").alias("year_end_specs"),
    )


@query
def clean_years(spark, sf):
    years = F.when(C("car_id") % 4 == 3, F.concat(C("model"), F.lit(" Mk2"))).otherwise(
        C("series_years")
    )
    return view(spark, sf, "cars").select(
        "car_id", text.clean_years(C("model"), years).alias("years_clean")
    )


@query
def coerce_number(spark, sf):
    return view(spark, sf, "cars").select(
        "car_id",
        num("power_bhp").alias("power"),
        text.number(F.concat(C("seats"), F.lit(",250.5")), thousands=True).alias("with_comma"),
        text.whole(text.number(F.concat(C("seats"), F.lit(".5")))).alias("half_even"),
        text.integer_text(C("zero_to_sixty")).alias("whole_text"),
    )


@query
def first_numeric(spark, sf):
    cars = view(spark, sf, "cars")
    return cars.select(
        "car_id",
        text.first_numeric(cars.columns, [r"power.*bhp", r"^mpg"]).alias("power_or_mpg"),
        text.first_numeric(cars.columns, [r"boot|luggage", r"length"]).alias("length_or_boot"),
    )


@query
def min_numeric(spark, sf):
    cars = view(spark, sf, "cars").select(
        "car_id", C("zero_to_sixty").alias("0-60 mph (secs)"),
        C("seats").alias("0-60 mph (secs)2"), "mpg_low",
    )
    return cars.select(
        "car_id", text.min_numeric(cars.columns, [r"0\s*[-–]\s*60\s*mph"]).alias("fastest")
    )


@query
def url_normalize(spark, sf):
    pages = view(spark, sf, "pages").select("page_id", urls.normalize(C("url")).alias("url"))
    made = view(spark, sf, "site_urls").select(
        C("car_id").alias("page_id"), urls.normalize(C("url")).alias("url")
    )
    return pages.union(made)


@query
def url_class(spark, sf):
    return view(spark, sf, "site_urls").select(
        "car_id",
        urls.is_specs(C("url")).alias("is_specs"),
        urls.is_review(C("url")).alias("is_review"),
        urls.to_specs(F.lower("url")).alias("specs_url"),
        urls.specs_fallback(C("url")).alias("fallback_url"),
    )


@query
def url_candidates(spark, sf):
    return view(spark, sf, "site_urls").select(
        "car_id", F.posexplode(urls.candidates(C("url"))).alias("place", "candidate")
    )


@query
def slugify(spark, sf):
    name = F.concat(C("p_name"), F.lit(" (&) "), C("p_type"))
    return view(spark, sf, "part").select(
        "p_partkey", urls.slug(name).alias("slug"),
        urls.slug(F.concat(F.lit("&("), F.lit(")"))).alias("empty_slug"),
    )


@query
def clean_text(spark, sf):
    noisy = F.concat(C("text"), F.lit("  \n © 1994-2024 Example and more"))
    return view(spark, sf, "documents").select(
        "doc_id", text.clean_text(noisy).alias("clean"),
        F.length(text.clean_text(C("text"), (r"the ",))).alias("cut_chars"),
    )


def specs_inputs() -> dict[str, Column]:
    return {
        "body": C("body_type"), "engine": C("engine_type"), "power": C("power_bhp"),
        "gearbox": C("transmission"), "doors": C("doors"), "seats": C("seats"),
        "mpg_min": C("mpg_low"), "mpg_max": C("insurance_group"),
        "insurance_min": C("insurance_group"), "insurance_max": C("insurance_group"),
        "sprint_min": C("zero_to_sixty"), "length": C("length_mm"), "boot": C("boot_l"),
        "year_start": C("year_start"), "year_end": C("year_end"), "fuel": C("fuel_type"),
    }


@query
def specs_string(spark, sf):
    return view(spark, sf, "cars").select(
        "car_id", compose.specs_string(specs_inputs()).alias("specs")
    )


@query
def specs_string_all(spark, sf):
    cars = view(spark, sf, "cars")
    pairs = [(c, text.blank_to_null(C(c))) for c in cars.columns if c != "car_id"]
    return cars.select("car_id", text.bounded_pairs(pairs, 60).alias("specs"))


@query
def specs_text(spark, sf):
    return view(spark, sf, "cars").select(
        "car_id", compose.specs_text(specs_inputs()).alias("specs")
    )


@query
def specs_compact(spark, sf):
    return view(spark, sf, "cars").select(
        "car_id",
        compose.specs_compact(
            num("zero_to_sixty"), C("transmission"), C("fuel_type"), num("seats"),
            num("boot_l") + 0.5, num("mpg_low") * 1.5,
        ).alias("specs"),
    )


@query
def specs_summary(spark, sf):
    parts = {
        "fuel": C("fuel_type"), "hp": text.whole(num("power_bhp")).cast("string"),
        "sprint": C("zero_to_sixty"), "drive": C("drivetrain"), "gearbox": C("transmission"),
        "boot": C("boot_l"), "seats": C("seats"),
    }
    return view(spark, sf, "cars").select(
        "car_id", compose.specs_summary(parts, C("body_type")).alias("summary")
    )


@query
def word_limit(spark, sf):
    return view(spark, sf, "documents").select(
        "doc_id",
        text.word_limit(C("text"), values.ESSENCE_WORDS).alias("short_text"),
        F.length(text.word_limit(C("text"), values.FIELD_ESSENCE_WORDS)).alias("chars_160"),
    )


@query
def labelled_context(spark, sf):
    def some(*names: str) -> Column:
        return F.coalesce(*[text.blank_to_null(C(n)) for n in names])

    dims = [("length_mm", some("length_mm")), ("boot_l", some("boot_l")),
            ("doors", some("doors", "seats")), ("seats", some("seats"))]
    facts = [("series_years", some("series_years")), ("body_type", some("body_type")),
             ("engine_type", some("engine_type")), ("transmission", some("transmission")),
             ("fuel", some("fuel_type")), ("power_bhp", some("power_bhp"))]
    return view(spark, sf, "cars").select(
        "car_id",
        text.labelled(dims, "=", "; ").alias("dimensions"),
        text.labelled(facts, "=", "; ").alias("context"),
    )


@query
def prompt_text(spark, sf):
    fields = {
        "make": F.btrim("make"), "model": C("model"), "years": C("series_years"),
        "year_start": C("year_start"), "year_end": C("year_end"), "body": C("body_type"),
        "engine": C("engine_type"), "power": C("power_bhp"), "gearbox": C("transmission"),
        "doors": C("doors"), "seats": C("seats"), "fuel": C("fuel_type"), "mpg": C("mpg_low"),
        "insurance": C("insurance_group"), "sprint": C("zero_to_sixty"),
        "age": compose.car_age(C("year_start"), C("year_end")),
    }
    return view(spark, sf, "cars").select("car_id", *[
        text.fill_template(template, fields).alias(f"{name}_prompt")
        for name, template in compose.PROMPTS.items()
    ])


@query
def rivals_text(spark, sf):
    return view(spark, sf, "rival_lists").select(
        "car_id", compose.rivals_text(C("rivals_json")).alias("rivals")
    )


@query
def vector_texts(spark, sf):
    rows = view(spark, sf, "cars").join(view(spark, sf, "rivals"), "car_id")
    texts = compose.vector_texts(
        model=C("model"), years=C("series_years"), essence=F.concat(F.lit("The "), C("model")),
        rivals=extract.parse_rivals(C("rivals_text"), dedupe=False),
        summary=F.coalesce(C("engine_type"), F.lit("varies")), uses=vehicle.use_case(C("body_type")),
    )
    return rows.select("car_id", *[c.alias(n) for n, c in texts.items()])


@query
def display_fallback(spark, sf):
    answer = F.when(C("car_id") % 3 != 0, F.concat(F.lit("\"'"), C("engine_type"), F.lit("\" ")))
    return view(spark, sf, "cars").select(
        "car_id", compose.display_name(answer, C("make"), C("model")).alias("display_name")
    )


def spec_columns(rows):
    parts = {
        "engine": C("engine_type"), "fuel": text.blank_to_null(C("fuel_type")),
        "body": C("body_type"), "power": C("power_bhp"),
        "sprint": text.nonempty(C("zero_to_sixty")), "seats": C("seats"), "boot": C("boot_l"),
    }
    return compose.table_specs(parts, extract.prose_specs(C("article_text")))


@query
def table_specs(spark, sf):
    rows = view(spark, sf, "cars").join(
        view(spark, sf, "prose").withColumnRenamed("doc_id", "car_id"), "car_id", "left"
    )
    return rows.select("car_id", *[c.alias(n) for n, c in spec_columns(rows).items()])


@query
def default_rivals(spark, sf):
    return view(spark, sf, "rival_lists").select(
        "car_id",
        compose.rivals_json_default(C("rivals_json"), C("other_json")).alias("rivals_json"),
    )
