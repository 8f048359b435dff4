"""Sources, sinks and typed loading."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalith import values
from catalith.functions import text, vectors
from catalith.plans.registry import query
from catalith.plans.views import view
from catalith.session import shared_folder
from catalith.sources import documents, loading, tables

C = F.col


def raw_headers(spark, sf):
    """Catalogue rows under their original headers."""
    own = {
        "make": "Make", "model": "Model", "series_years": "Series (production years start-end)",
        "year_start": "Year start", "year_end": "Year end", "body_type": "Real Body Type",
        "engine_type": "engine type", "power_bhp": "Power (bhp)", "transmission": "Transmission",
        "doors": "Doors", "seats": "Seats", "price_low": "Min. of used price low helper",
        "mpg_low": "Min. of mpg low helper", "insurance_group": "Min. of Insurance group",
        "zero_to_sixty": "Min. of 0-60 mph (secs)", "length_mm": "Average of Length (mm)",
        "boot_l": "Average of Luggage Capacity (litres)",
    }
    return view(spark, sf, "cars").withColumnsRenamed(own)


def staged(spark, sf):
    """Catalogue rows with two vector texts, some missing or empty."""
    vec = F.concat(F.lit("["), C("seats"), F.lit(",0.5]"))
    return view(spark, sf, "cars").select(
        "car_id", "make", "model", "year_end",
        F.when(C("car_id") % 17 == 5, "99999999999").otherwise(C("doors")).alias("doors"), "power_bhp",
        F.when(C("car_id") % 6 == 0, F.lit(None)).when(C("car_id") % 6 == 1, "").otherwise(vec)
        .alias("vector_main_text"),
        F.when(C("car_id") % 10 == 3, "[]").otherwise(vec).alias("vector_specs_text"),
    )


INTS = ["year_end", "doors", "power_bhp"]
VECTOR_TEXTS = ["vector_main_text", "vector_specs_text"]


@query
def scan_text_table(spark, sf):
    """Part through a CSV file, every column as text."""
    path = shared_folder(spark, "scan-text")
    part = tables.as_text(view(spark, sf, "part"))
    tables.write_quoted_csv(part, path)
    return tables.scan_text_csv(spark, path, part.columns)


@query
def normalize_headers(spark, sf):
    wanted = [c for c in values.HEADER_MAP.values()]
    return tables.rename(
        raw_headers(spark, sf), required=["make", "model"], select=["car_id", *wanted]
    )


@query
def structured_export(spark, sf):
    return tables.structured_export(raw_headers(spark, sf).withColumn(
        "Min. of Power (bhp)", F.concat(C("Power (bhp)"), F.lit(".5"))
    ), ["car_id", "Make", "Model"])


@query
def cache_last_wins(spark, sf):
    won = tables.cache_last_wins(view(spark, sf, "cache_lines"), "line", "line_no", "k bigint")
    return won.select("fid", "data.k")


@query
def vectors_sink(spark, sf):
    """Vectors written as JSON lines in two appends and read back."""
    path = shared_folder(spark, "vectors")
    emb = view(spark, sf, "embeddings").select(
        C("vec_id").alias("row_id"), C("embedding").alias("vector_main"), "label"
    )
    low = C("label") < 5
    tables.write_vectors(emb.where(low), path, ["vector_main"])
    tables.write_vectors(emb.where(~low), path, ["vector_main"])
    back = spark.read.schema("row_id bigint, vector_main string, label int").json(path)
    parsed = back.withColumn("v", vectors.parse(C("vector_main")))
    total = F.aggregate(vectors.doubles(C("v")), F.lit(0.0), lambda s, x: s + x)
    return parsed.select("row_id", "label", F.size("v").alias("dimension"),
                         F.round(total, 5).alias("total"))


@query
def quoted_csv_sink(spark, sf):
    path = shared_folder(spark, "quoted")
    rows = view(spark, sf, "rivals").withColumn("note", F.lit('say "hi",\nthen go'))
    tables.write_quoted_csv(rows, path)
    return tables.scan_text_csv(spark, path, rows.columns, multiline=True).select(
        C("car_id").cast("bigint").alias("car_id"), text.text(C("rivals_text")).alias("rivals_text"),
        "note",
    )


def loaded_columns(df):
    return df.select(
        "car_id", *[C(c).cast("string").alias(c) for c in INTS], F.size("vector_main").alias("main_size"),
        F.round(F.get("vector_specs", F.lit(0)).cast("double"), 4).alias("specs_first"),
    )


@query
def load_strict(spark, sf):
    return loaded_columns(loading.load_strict(staged(spark, sf), VECTOR_TEXTS, INTS))


@query
def load_lenient(spark, sf):
    return loaded_columns(loading.load_lenient(staged(spark, sf), VECTOR_TEXTS, INTS))


@query
def load_full_refresh(spark, sf):
    """Typed rows and rejected rows after an overwrite load."""
    rows = staged(spark, sf).join(
        view(spark, sf, "rival_lists").select("car_id", "rivals_json"), "car_id"
    )
    path = shared_folder(spark, "refresh")
    judged = loading.full_refresh(rows, VECTOR_TEXTS, INTS, "rivals_json")
    for part in (judged.limit(0), judged):  # an empty version is published first and then replaced
        loading.write_full_refresh(part, path)
    loaded, rejected = loading.read_full_refresh(spark, path)
    rivals = F.from_json(F.to_json("rivals_json"), "array<struct<name:string>>")
    good = loaded.select(
        "car_id", C("doors").cast("string"), C("power_bhp").cast("string"),
        F.size(rivals).cast("string").alias("rivals"),
        F.try_variant_get("rivals_json", "$[0].context", "string").alias("context"),
        F.size("vector_specs").cast("string").alias("specs_size"), F.lit(0).alias("reasons"),
    )
    bad = rejected.select("car_id", F.size("reasons").alias("reasons"), C("doors").alias("raw_doors"))
    return good.unionByName(bad, allowMissingColumns=True)


@query
def flatten_documents(spark, sf):
    return documents.flatten(view(spark, sf, "document_json"), "document", ["page_id"])


@query
def essential_rows(spark, sf):
    return documents.essential(view(spark, sf, "document_json"), "document", "url", "series")
