"""Scraped documents (JSON) to flat review rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalith import values
from catalith.functions.text import text

SCHEMA = (
    "title string, article_text string, article_markdown string, "
    "sections map<string,string>, url string, processing_status string, "
    "key_info map<string,string>, source string, error string"
)


def parse(document: Column) -> Column:
    return F.from_json(document, SCHEMA)


def _info(doc: Column, name: str) -> Column:
    return F.coalesce(F.try_element_at(doc["key_info"], F.lit(name)), F.lit(""))


def flatten(df: DataFrame, document: str, keep: list[str]) -> DataFrame:
    """22 text columns; a document that did not succeed keeps only status and JSON."""
    doc = F.col("_doc")
    ok = F.coalesce(doc["processing_status"] == "success", F.lit(False))

    def cell(value: Column) -> Column:
        return F.when(ok, value).otherwise("")

    return df.withColumn("_doc", parse(F.col(document))).select(
        *keep,
        cell(text(doc["title"])).alias("title"),
        *[cell(_info(doc, f)).alias(f) for f in values.REVIEW_FIELDS],
        cell(text(doc["article_text"])).alias("article_text"),
        text(F.col(document)).alias("full_json"),
        F.when(ok, "success").otherwise("failed").alias("processing_status"),
        cell(text(doc["url"])).alias("resolved_url"),
    )


def essential(df: DataFrame, document: str, url: str, series: str) -> DataFrame:
    """Narrow rows; pages without a review are marked as skipped."""
    doc = F.col("_doc")
    skipped = F.coalesce(doc["source"] == "specs_page_fallback", F.lit(False))
    ok = ~skipped & F.coalesce(doc["processing_status"] == "success", F.lit(False))

    def cell(value: Column) -> Column:
        return F.when(ok, value).otherwise("")

    status = F.coalesce(doc["processing_status"], F.lit("failed"))
    return df.withColumn("_doc", parse(F.col(document))).select(
        F.col(url).alias("model_url"),
        text(F.col(series)).alias("series_production_year"),
        cell(text(doc["title"])).alias("article_title"),
        cell(text(doc["article_text"])).alias("article_text"),
        *[cell(_info(doc, f)).alias(f) for f in ("pros", "cons", "rivals")],
        cell(text(doc["url"])).alias("resolved_url"),
        F.when(skipped, "skipped_no_review").otherwise(status).alias("processing_status"),
    )


def unresolved(url: Column, reason: Column) -> Column:
    """JSON stub for an input whose page could not be found."""
    return F.to_json(F.struct(
        url.alias("url"), F.lit("failed").alias("processing_status"), reason.alias("error"),
    ))
