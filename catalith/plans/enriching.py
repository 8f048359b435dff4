"""Gap filling, answer checks, embedding and incremental runs."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from catalith.functions import extract, text
from catalith.operators import enrich
from catalith.plans import jobs
from catalith.plans.combining import with_family, with_price_key
from catalith.plans.normalise import specs_inputs
from catalith.plans.registry import query
from catalith.plans.views import view
from catalith.session import shared_folder
from catalith.streaming import incremental

C = F.col


def fuel_answers(batch: pd.DataFrame) -> pd.DataFrame:
    """Stand-in for a remote classifier: a pure function of the engine text."""
    engine = batch["engine_type"].fillna("").str.lower()
    fuel = np.select(
        [engine.str.contains("electric"), engine.str.contains("hybrid|plug"),
         engine.str.contains("tdi|dci")],
        ["electric", "hybrid", "diesel"], "petrol",
    )
    return pd.DataFrame({"family": batch["family"], "inferred_fuel": fuel})


def vowel_counts(texts: list[str]) -> np.ndarray:
    """Stand-in for an embedding model: how often each vowel occurs, and a one."""
    return np.array([[t.count(v) for v in "aeiou"] + [1] for t in texts], dtype=float)


@query
def enrich_families(spark, sf):
    """One call per family; the second run finds every answer in the cache."""
    cars = with_family(view(spark, sf, "cars")).select("car_id", "family", "engine_type")
    cache = shared_folder(spark, "family-cache")
    answers = ("family string, inferred_fuel string", cache)
    enrich.enrich_families(cars, "family", "car_id", ["engine_type"], fuel_answers, *answers)
    return enrich.enrich_families(
        cars, "family", "car_id", ["engine_type"], fuel_answers, *answers
    ).select("car_id", "inferred_fuel")


@query
def sanitize_prices(spark, sf):
    own = F.when(C("event_id") % 4 == 0, F.concat(
        (1 + C("event_id") % 20).cast("string"), F.lit(",250")))
    rows = view(spark, sf, "answers").withColumn("parsed", extract.answer_json(C("answer")))
    checked = enrich.sanitize_prices(C("parsed"), own, own)
    return rows.select("event_id", *[c.alias(n) for n, c in checked.items()])


def spec_answers(cars):
    """Made-up answers: some out of range, some missing."""
    return (
        F.when(C("car_id") % 5 == 0, None).otherwise((C("car_id") % 260 - 10).cast("double")),
        F.when(C("car_id") % 7 == 0, None).otherwise((C("car_id") % 60).cast("double")),
        F.when(C("car_id") % 3 == 0, None).otherwise((C("car_id") % 35).cast("double") - 0.5),
    )


@query
def sanitize_specs(spark, sf):
    cars = view(spark, sf, "cars")
    checked = enrich.sanitize_specs(*spec_answers(cars))
    checked["insurance"] = checked["insurance"].cast("string")
    return cars.select("car_id", *[c.alias(n) for n, c in checked.items()])


@query
def fill_missing(spark, sf):
    cars = view(spark, sf, "cars")
    mpg, insurance, sprint = spec_answers(cars)
    return cars.select(
        "car_id",
        enrich.fill_missing(C("mpg_low"), mpg, positive_only=True).alias("mpg"),
        enrich.fill_missing(C("insurance_group"), insurance).alias("insurance"),
        enrich.fill_missing(C("zero_to_sixty"), sprint).alias("sprint"),
    )


@query
def embed_batches(spark, sf):
    rows = view(spark, sf, "documents").select(
        "doc_id", F.when(C("doc_id") % 9 != 0, C("text")).alias("text")
    )
    out = enrich.embed_batches(rows, "doc_id", "text", vowel_counts, dimension=6)
    return out.select("doc_id", *[
        F.round(C("vector")[i].cast("double"), 4).alias(f"x{i}") for i in range(6)
    ])


@query
def resume_incremental(spark, sf):
    """Events that arrive in two overlapping parts, and a third run that finds nothing new."""
    base = shared_folder(spark, "resume")
    events = view(spark, sf, "events")
    for part in (C("event_id") % 3 != 0, C("event_id") % 3 != 1, None):
        if part is not None:
            events.where(part).write.mode("append").parquet(f"{base}/in")
        incremental.resume(
            spark, f"{base}/in", events.schema, f"{base}/out", f"{base}/checkpoint", "event_id",
            lambda df: df.where(C("event_type") != "error"),
        )
    written = spark.read.option("basePath", f"{base}/out").parquet(f"{base}/out")
    return written.select("event_id", "user_id", "event_type", C("batch_id").cast("int").alias("batch_no"))


@query
def pages_to_catalogue(spark, sf):
    """Review pages to the best article and pros per language, on every document."""
    rows = view(spark, sf, "documents").select("doc_id", "lang")
    language = F.regexp_extract("url", "^[^/]*//[^/]*/([a-z]+)/", 1)
    out = jobs.catalogue_from_pages(
        view(spark, sf, "review_pages"), language, rows, C("lang"), "page_id"
    )
    return out.select("doc_id", F.md5("article").alias("article_md5"), "pros", "cons", "rivals")


@query
def price_gaps(spark, sf):
    """Cars with their family's listing range where the family lacks a price."""
    cars = with_price_key(view(spark, sf, "cars"))
    listings = view(spark, sf, "lineitem").select(
        C("l_partkey").alias("car_id"), C("l_extendedprice").alias("price")
    ).join(cars.select("car_id", "fid"), "car_id").select("fid", "price")
    out = jobs.price_gaps(cars, "fid", "car_id", listings, "price_low")
    return out.select("car_id", "price_low_filled", "price_high_filled", "confidence", "notes")


@query
def embed_and_search(spark, sf):
    """Specs texts embedded, the twenty cars most like car 1."""
    near = jobs.embed_and_search(
        view(spark, sf, "cars"), "car_id", specs_inputs(), vowel_counts, 6, query_id=1, k=20
    )
    return near.select("car_id", F.round("score", 6).alias("score"))


def price_answer(car_id: int) -> str:
    """Stand-in for a remote answer: some cannot be read, some have the bounds the wrong way round."""
    if car_id % 7 == 0:
        return "no idea"
    low = 50 + car_id * 37 % 20000
    first, second = (low + 900, low) if car_id % 5 == 0 else (low, low + 900)
    return f'Sure: {{"min_used_price_gbp": {first}, "max_used_price_gbp": {second}, "confidence": "high"}}'


@query
def answered_prices(spark, sf):
    """Families that lack a price at either end, asked through a cache in two waves; nothing is asked twice."""
    cars = with_price_key(view(spark, sf, "cars")).withColumn(
        "price_high", F.when(C("car_id") % 3 != 0, F.concat(C("seats"), F.lit(",900"))))

    def answer(batch: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"fid": batch["fid"], "answer": batch["car_id"].map(price_answer)})

    base = shared_folder(spark, "price-answers")
    out = jobs.answered_prices(
        cars, "fid", "car_id", ["car_id"], answer, f"{base}/cache", "price_low", "price_high", waves=2,
        dead_letters=f"{base}/dead")
    return out.select("car_id", "price_low_filled", "price_high_filled", "confidence", "notes")


@query
def answered_specs(spark, sf):
    """Families with a gap in three specs, asked once; answers out of range fill nothing."""
    def answer(batch: pd.DataFrame) -> pd.DataFrame:
        n = batch["car_id"]
        return pd.DataFrame({
            "family": batch["family"], "_mpg": (n % 260 - 10.0).where(n % 5 != 0),
            "_insurance": (n % 60.0).where(n % 7 != 0), "_sprint": (n % 35 - 0.5).where(n % 3 != 0)})

    cars = with_family(view(spark, sf, "cars"))
    own = {"mpg": "mpg_low", "insurance": "insurance_group", "sprint": "zero_to_sixty"}
    out = jobs.answered_specs(
        cars, "family", "car_id", ["car_id"], answer, shared_folder(spark, "spec-answers"), own)
    return out.select("car_id", *[f"{n}_filled" for n in own])


@query
def staging_csv(spark, sf):
    """Catalogue rows and their vectors as one quoted table for a load."""
    vectors = view(spark, sf, "embeddings").select(
        C("vec_id").alias("car_id"),
        F.concat(F.lit("["), F.array_join(F.transform(
            "embedding", lambda x: x.cast("double").cast("decimal(9,6)").cast("string")), ","), F.lit("]")).alias("vector_main"))
    rows = view(spark, sf, "cars").select("car_id", "make", "model", "series_years", "engine_type")
    staged = jobs.staging_csv(rows, vectors, "car_id", ["vector_main"], shared_folder(spark, "staging"))
    return staged.select(
        C("car_id").cast("bigint"), text.text(C("make")).alias("make"), text.text(C("series_years")).alias("series_years"),
        text.text(C("engine_type")).alias("engine_type"), F.length(text.text(C("vector_main_text"))).alias("vector_chars"))
