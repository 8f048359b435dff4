"""Vector functions and similarity search."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalith import values
from catalith.functions import vectors
from catalith.operators import search, vector_index
from catalith.plans.registry import query
from catalith.plans.views import view

C = F.col


def two_vectors(spark, sf):
    """Rows with a main vector and a second one (the main vector reversed)."""
    return view(spark, sf, "embeddings").select(
        "vec_id", "label", C("embedding").alias("main"), F.reverse("embedding").alias("rivals")
    )


def main_score(rows):
    return search.weighted_score([
        (values.MAIN_WEIGHT, C("main"), search.query_vector(rows, C("vec_id") == 1, "main")),
        (values.RIVALS_WEIGHT, C("rivals"), search.query_vector(rows, C("vec_id") == 2, "rivals")),
    ])


@query
def l2_normalize(spark, sf):
    scaled = F.transform("embedding", lambda x: x * C("label"))
    rows = view(spark, sf, "embeddings").select("vec_id", vectors.normalize(scaled).alias("v"))
    return rows.select("vec_id", F.posexplode("v").alias("place", "x")).select(
        "vec_id", "place", F.round("x", 6).alias("x")
    )


@query
def cosine_distance(spark, sf):
    zeroed = F.transform("embedding", lambda x: F.when(C("label") == 0, 0.0).otherwise(x))
    distance = vectors.cosine_distance(zeroed, F.reverse("embedding"))
    return view(spark, sf, "embeddings").select("vec_id", F.round(distance, 6).alias("distance"))


@query
def parse_vector(spark, sf):
    cell = F.when(C("vec_id") % 7 == 0, F.lit("[0.5, abc]")).when(
        C("vec_id") % 7 == 1, F.lit("0.5, 1.5")).when(
        C("vec_id") % 7 == 2, F.lit("[]")).otherwise(F.to_json("embedding"))
    parsed = view(spark, sf, "embeddings").select("vec_id", vectors.parse(cell).alias("v"))
    total = F.aggregate(vectors.doubles(C("v")), F.lit(0.0), lambda s, x: s + x)
    return parsed.select(
        "vec_id", F.size("v").cast("string").alias("dimension"), F.round(total, 5).alias("total")
    )


@query
def cosine_topk(spark, sf):
    emb = view(spark, sf, "embeddings")
    q = search.query_vector(emb, C("vec_id") == 0, "embedding")
    near = search.topk(
        emb, search.similarity(C("embedding"), q), ["vec_id", "label"], 10, "vec_id"
    )
    return near.select("vec_id", "label", F.round(1 - C("score"), 6).alias("distance"))


@query
def weighted_topk(spark, sf):
    rows = two_vectors(spark, sf)
    best = search.topk(rows, main_score(rows), ["vec_id", "label"], 200, "vec_id")
    return best.select("vec_id", "label", F.round("score", 6).alias("score"))


@query
def two_stage_search(spark, sf):
    rows = two_vectors(spark, sf)
    q = search.query_vector(rows, C("vec_id") == 1, "main")
    best = search.two_stage(
        rows, main_score(rows), search.similarity(C("rivals"), q), ["label"], "vec_id",
        ["vec_id", "label"], where=C("label") != 5,
    )
    return best.select("vec_id", "label", F.round("score", 6).alias("score"))


@query
def approx_topk(spark, sf):
    """About the five nearest neighbours of every vector."""
    emb = view(spark, sf, "embeddings")
    found = search.approx_topk(
        emb, emb, id_col="vec_id", vector="embedding", k=5, lists=32, probes=8, exclude_self=True
    )
    return found.withColumn("similarity", F.round("similarity", 6))


@query
def indexed_topk(spark, sf):
    """About the five nearest neighbours of every fiftieth vector among all, from a written index."""
    emb = view(spark, sf, "embeddings")
    found = vector_index.indexed_topk(
        emb, emb.where(C("vec_id") % 50 == 0), 5, id_col="vec_id", vector="embedding", exclude_self=True,
        rows_per_list=200)
    return found.withColumn("similarity", F.round("similarity", 6))


@query
def sample_rows(spark, sf):
    cars = view(spark, sf, "cars")
    return search.sample_rows(
        cars.select("car_id", "make", "series_years"), "car_id", 50, "draw",
        ~F.coalesce(C("series_years").rlike(values.OLD_YEAR_PATTERN), F.lit(False)),
    )
