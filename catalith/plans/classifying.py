"""Filters, predicates and rule classification."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalith import values
from catalith.functions import compose, extract, text, vehicle
from catalith.operators import enrich, quality
from catalith.plans import jobs
from catalith.plans.normalise import num
from catalith.plans.registry import query
from catalith.plans.views import view

C = F.col


@query
def boilerplate_flag(spark, sf):
    return view(spark, sf, "descriptions").select(
        "doc_id", extract.boilerplate(C("article_text")).alias("is_boilerplate")
    )


@query
def clear_boilerplate(spark, sf):
    cleared = quality.clear_boilerplate(view(spark, sf, "descriptions"), "article_text")
    return cleared.groupBy("series_key").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if("cleared").alias("cleared_rows"),
        F.sum(F.length("article_text")).alias("chars_left"),
    )


@query
def exclude_old(spark, sf):
    old = F.coalesce(C("series_years").rlike(values.OLD_YEAR_PATTERN), F.lit(False))
    return view(spark, sf, "cars").where(~old).select("car_id", "series_years")


@query
def guide_filters(spark, sf):
    price = num("price_low")
    keep = (price < 950) & F.coalesce(C("engine_type").ilike("%tdi%"), F.lit(False))
    rated = C("zero_to_sixty").contains("7.5") | F.coalesce(
        C("body_type").contains("SUV"), F.lit(False)
    )
    return view(spark, sf, "cars").where(keep | (rated & price.isNotNull())).select(
        "car_id", "price_low", "engine_type", "body_type"
    )


@query
def needs_fill(spark, sf):
    fields = ("mpg_low", "insurance_group", "zero_to_sixty")
    flags = {f"{f}_missing": enrich.needs_fill(C(f)) for f in fields}
    some = F.lit(False)
    for flag in flags.values():
        some = some | flag
    return view(spark, sf, "cars").select(
        "car_id", *[c.alias(n) for n, c in flags.items()], some.alias("any_missing")
    )


@query
def nonempty_keys(spark, sf):
    rows = view(spark, sf, "cars").where(
        text.blank_to_null(C("fuel_type")).isNotNull() & text.nonempty(C("year_end")).isNotNull()
    )
    return rows.select("car_id", "fuel_type", "year_end")


@query
def size_bucket(spark, sf):
    body, length = C("body_type"), num("length_mm")
    return view(spark, sf, "cars").select(
        "car_id",
        vehicle.size_bucket(body, length).alias("size_bucket"),
        vehicle.size_descriptor(body, length).alias("size_descriptor"),
        vehicle.coarse_size(body, length).alias("coarse_size"),
        vehicle.size_class(F.lower(body), length).alias("size_class"),
    )


@query
def metric_buckets(spark, sf):
    return view(spark, sf, "cars").select(
        "car_id",
        vehicle.performance(num("zero_to_sixty")).alias("performance"),
        vehicle.economy(num("mpg_low")).alias("economy"),
        vehicle.boot(num("boot_l")).alias("boot"),
    )


@query
def body_label(spark, sf):
    return view(spark, sf, "cars").select(
        "car_id", vehicle.body_label(C("body_type"), num("length_mm")).alias("label")
    )


@query
def label_canonicalise(spark, sf):
    return view(spark, sf, "labels_text").select(
        "car_id", vehicle.canonical_label(C("answer")).alias("label")
    )


@query
def variant_delta_sentence(spark, sf):
    return view(spark, sf, "cars").select(
        "car_id",
        vehicle.variant_sentence(
            C("engine_type"), C("fuel_type"), C("transmission"), C("drivetrain")
        ).alias("sentence"),
    )


@query
def variant_delta_notes(spark, sf):
    return view(spark, sf, "cars").select(
        "car_id",
        vehicle.variant_notes(
            C("engine_type"), C("fuel_type"), C("transmission"), C("drivetrain")
        ).alias("notes"),
    )


@query
def use_case_highlights(spark, sf):
    return view(spark, sf, "cars").select(
        "car_id",
        vehicle.use_case(C("body_type")).alias("use_case"),
        vehicle.highlights(C("body_type")).alias("highlights"),
    )


@query
def buyer_fit(spark, sf):
    return view(spark, sf, "cars").select(
        "car_id",
        vehicle.buyer_fit(C("engine_type"), C("body_type"), vehicle.economy(num("mpg_low")))
        .alias("buyer_fit"),
    )


@query
def fuel_type_rule(spark, sf):
    return view(spark, sf, "cars").select(
        "car_id",
        vehicle.fuel_type(C("engine_type")).alias("by_rule"),
        vehicle.fuel_type(C("engine_type"), C("fuel_type")).alias("by_answer"),
    )


@query
def mileage_rule(spark, sf):
    return view(spark, sf, "cars").select(
        "car_id", vehicle.mileage_band(C("fuel_type"), C("make")).alias("mileage")
    )


@query
def bodytype_keyword(spark, sf):
    named = F.concat_ws(" ", C("body_type"), C("engine_type"))
    return view(spark, sf, "cars").select(
        "car_id",
        vehicle.body_keyword(named, C("body_type")).alias("from_text"),
        vehicle.body_keyword(F.lit(None).cast("string"), C("body_type")).alias("from_column"),
    )


@query
def essence_family(spark, sf):
    """Text once per family from its first values, brought back to every row."""
    out = jobs.family_texts(view(spark, sf, "cars"), "car_id")
    return out.select("car_id", "family", "essence")


@query
def essence_family_v2(spark, sf):
    body, length = F.lower("body_type"), num("length_mm")
    return view(spark, sf, "cars").select(
        "car_id",
        vehicle.family_essence_v2(
            F.btrim("make"), C("model"), C("series_years"), body,
            vehicle.coarse_size(body, length),
        ).alias("essence"),
    )


@query
def essence_main(spark, sf):
    out = compose.essence_main(
        view(spark, sf, "cars"), "essence_main", make=F.btrim("make"), model=C("model"),
        years=C("series_years"), body=C("body_type"), engine=C("engine_type"),
        gearbox=C("transmission"), sprint=num("zero_to_sixty"), mpg=num("mpg_low"),
        boot=num("boot_l"), seats=num("seats"), length=num("length_mm"),
    )
    return out.select("car_id", "essence_main")


@query
def essence_from_fields(spark, sf):
    rows = view(spark, sf, "cars").join(
        view(spark, sf, "descriptions").select(
            C("doc_id").alias("car_id"), text.clean_text(C("article_text")).alias("pros")
        ), "car_id", "left",
    )
    body = F.lower("body_type")
    pace = F.concat(C("power_bhp"), F.lit("hp"))
    return rows.select("car_id", compose.essence_from_fields(
        make=F.btrim("make"), model=C("model"), years=C("series_years"), body=body,
        size=vehicle.size_class(body, num("length_mm")), pros=C("pros"),
        cons=C("drivetrain"), engine=C("engine_type"), pace=pace, seats=C("seats"),
        boot=C("boot_l"),
    ).alias("essence"))
