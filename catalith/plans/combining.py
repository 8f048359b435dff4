"""Joins, family aggregates, profiles, set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalith.functions import text, vehicle
from catalith.operators import aggregate, lookup, quality, search
from catalith.plans.normalise import NOW, num
from catalith.plans.registry import query
from catalith.plans.views import view
from catalith.session import shared_folder

C = F.col


def with_family(cars):
    return cars.withColumn("family", text.family_key(C("make"), C("model"), C("series_years")))


def with_price_key(cars):
    return cars.withColumn("fid", text.price_key(
        C("make"), C("model"), C("series_years"), C("year_start"), C("year_end"),
        C("engine_type"), NOW))


# joins ---------------------------------------------------------------------

@query
def best_text_join(spark, sf):
    big = view(spark, sf, "documents").select(
        "doc_id", C("source").alias("series"), C("lang").alias("article_text")
    )
    joined = lookup.best_text_join(
        big, F.concat(F.lit(" "), F.upper("series")), view(spark, sf, "descriptions"),
        C("series_key"), ["article_text"], "doc_id",
    )
    return joined.select("doc_id", F.md5("article_text").alias("text_md5"))


@query
def years_join(spark, sf):
    texts = view(spark, sf, "cars").select(
        "car_id", "series_years", C("engine_type").alias("essence"), C("fuel_type").alias("image")
    )
    rows = view(spark, sf, "cars").select(
        "car_id", F.upper("series_years").alias("series_years")
    )
    return lookup.years_join(rows, texts, "series_years", ["essence", "image"], "car_id")


@query
def first_wins_lookup(spark, sf):
    cars = view(spark, sf, "cars")
    key = text.norm_years(C("series_years"))
    return lookup.first_wins_lookup(
        cars.select("car_id", "series_years"), key, cars, key, "body_type", "car_id", "real_body"
    ).select("car_id", "real_body")


@query
def attach_vectors(spark, sf):
    vectors = view(spark, sf, "embeddings").select(
        C("label").alias("car_id"), F.concat(F.lit("v"), C("vec_id").cast("string")).alias("vector")
    )
    return lookup.attach_vectors(
        view(spark, sf, "cars").select("car_id", "model"), vectors, "car_id", ["vector"]
    )


@query
def unprocessed(spark, sf):
    pages = view(spark, sf, "pages")
    keyed = pages.withColumn("url", F.when(C("page_id") % 10 != 0, C("url")))
    done = pages.where(C("url").contains("?")).select("url")
    return lookup.unprocessed(keyed, done, "url").select("page_id", "url")


@query
def worklist(spark, sf):
    cars = with_price_key(view(spark, sf, "cars"))
    seen = view(spark, sf, "events").select(C("user_id").alias("car_id")).distinct()
    cached = cars.join(seen, "car_id", "left_semi").select("fid")
    blank = text.nonempty(C("price_low")).isNull()
    return lookup.worklist(
        cars, "fid", "car_id", ["car_id", "make", "model", "engine_type"], cached, missing=blank
    )


@query
def apply_family_result(spark, sf):
    cars = with_family(view(spark, sf, "cars"))
    results = cars.groupBy("family").agg(F.max("engine_type").alias("engine_type"))
    return lookup.apply_results(
        cars.select("car_id", "family", "engine_type"), results, "family", ["engine_type"]
    )


@query
def rerank_join(spark, sf):
    emb = view(spark, sf, "embeddings")
    q = search.query_vector(emb, C("vec_id") == 1, "embedding")
    score = search.similarity(C("embedding"), q)
    top = search.topk(emb, score, ["vec_id", "label"], 3, "vec_id")
    return search.rerank_join(emb, top, ["label"]).select("vec_id", "label")


@query
def query_vector_subquery(spark, sf):
    emb = view(spark, sf, "embeddings")
    asked = search.with_query(emb.where(C("vec_id") != 1), emb, C("vec_id") == 1, "embedding")
    score = search.similarity(C("embedding"), C("query"))
    near = search.topk(asked, score, ["vec_id", "label"], 10, "vec_id")
    return near.select("vec_id", "label", F.round(1 - C("score"), 6).alias("distance"))


# aggregates ----------------------------------------------------------------

@query
def family_first(spark, sf):
    cars = with_family(view(spark, sf, "cars"))
    columns = ["engine_type", "drivetrain", "length_mm", "body_type"]
    per_column = lookup.first_values(cars, ["family"], columns, "car_id")
    rows = lookup.first_rows(cars, ["family"], ["car_id", *columns], "car_id")
    renamed = rows.withColumnsRenamed({c: f"row_{c}" for c in ("car_id", *columns)})
    return per_column.join(renamed, "family")


@query
def pick_best_string(spark, sf):
    best = lookup.best_texts(
        view(spark, sf, "descriptions"), text.norm(C("series_key")), ["article_text"], "doc_id"
    )
    return best.select("join_key", F.md5("article_text").alias("text_md5"),
                       F.length("article_text").alias("chars"))


@query
def first_nonblank(spark, sf):
    cars = view(spark, sf, "cars")
    return cars.groupBy(text.norm_years(C("series_years")).alias("years")).agg(
        lookup.first_filled(C("engine_type"), C("car_id")).alias("engine"),
        lookup.first_filled(C("fuel_type"), C("car_id")).alias("fuel"),
    )


@query
def family_rivals(spark, sf):
    cars = with_family(view(spark, sf, "cars")).join(view(spark, sf, "rivals"), "car_id")
    per_make = cars.withColumn("make", text.norm(C("make")))
    found = aggregate.family_rivals(per_make, "make", "rivals_text", "car_id")
    names = F.transform("rivals", lambda r: F.concat_ws(" ", r["name"], r["rating"]))
    return found.select("make", F.array_join(names, " | ").alias("rivals"))


@query
def family_body(spark, sf):
    cars = with_family(view(spark, sf, "cars"))
    return aggregate.family_body(cars, "family", "body_type", num("length_mm"), "car_id")


@query
def value_counts(spark, sf):
    fuels = vehicle.fuel_type(C("engine_type"), C("fuel_type"))
    return aggregate.value_counts(view(spark, sf, "cars"), fuels)


@query
def column_profile(spark, sf):
    cars = view(spark, sf, "cars")
    return quality.column_profile(cars, [c for c in cars.columns if c != "car_id"])


@query
def vector_profile(spark, sf):
    emb = view(spark, sf, "embeddings").select(
        # six decimals, so that both engines write the same text
        F.concat(F.lit("["), F.array_join(F.transform(
            "embedding", lambda x: x.cast("double").cast("decimal(9,6)").cast("string")), ","), F.lit("]")).alias("good"),
        F.when(C("vec_id") % 5 == 0, F.lit("[0.5,x]")).otherwise(
            F.concat(F.lit("["), C("label").cast("string"), F.lit(",0.25]"))
        ).alias("mixed"),
    )
    profile = quality.vector_profile(emb, ["good", "mixed"])
    return profile.withColumn("dimension", F.coalesce(C("dimension"), F.lit(-1)))


@query
def status_summary(spark, sf):
    return aggregate.status_summary(view(spark, sf, "events"), C("event_type"), {
        "success": ["purchase", "signup"], "failed": ["error"], "skipped": ["view", "click"],
    })


@query
def robust_range(spark, sf):
    listings = view(spark, sf, "lineitem").select(
        C("l_partkey").alias("fid"), C("l_extendedprice").alias("price")
    )
    return aggregate.robust_range(listings, "fid", C("price"))


@query
def coverage(spark, sf):
    rows = view(spark, sf, "descriptions").join(view(spark, sf, "review_text"), "doc_id")
    blank = rows.withColumn("pros_cons_text", F.nullif("pros_cons_text", F.lit("&")))
    return aggregate.coverage(blank, ["article_text", "pros_cons_text"])


@query
def load_verify(spark, sf):
    emb = view(spark, sf, "embeddings").select(
        F.when(C("label") != 3, C("embedding")).alias("vector_main"),
        F.when(C("label") == 4, F.slice("embedding", 1, 3)).otherwise(C("embedding"))
        .alias("vector_specs"),
    )
    return quality.load_verify(emb, ["vector_main", "vector_specs"], 64)


# sets and slices -----------------------------------------------------------

@query
def row_window_by_position(spark, sf):
    """Slices by position of a CSV table that has no index column."""
    path = shared_folder(spark, "unindexed")
    part = view(spark, sf, "part").select("p_partkey", "p_name")
    part.repartitionByRange(4, "p_partkey").sortWithinPartitions("p_partkey").write.csv(path, header=True)
    rows = search.numbered(spark.read.csv(path, header=True), "position")
    first, second = (search.row_window(rows, "position", at, 60) for at in (20, 130))
    return first.unionByName(second)


@query
def row_window(spark, sf):
    return search.row_window(view(spark, sf, "cars"), "car_id", 50, 100).select("car_id", "model")


@query
def append_union(spark, sf):
    cars = view(spark, sf, "cars")
    old = cars.where(text.nonempty(C("price_low")).isNotNull()).select("car_id", "price_low")
    new = cars.where(text.nonempty(C("price_low")).isNull()).select("engine_type", "car_id")
    return search.append_union(old, new)


