"""Fields from texts and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalith.functions import extract, html
from catalith.plans.registry import query
from catalith.plans.views import view

C = F.col


@query
def glance_fields(spark, sf):
    fields = extract.glance_fields(C("glance_text"))
    return view(spark, sf, "glance").select("car_id", *[c.alias(n) for n, c in fields.items()])


@query
def pros_cons(spark, sf):
    rows = view(spark, sf, "review_text").join(view(spark, sf, "documents"), "doc_id")
    none = F.lit(None).cast("string")
    pros, cons = extract.pros_cons(
        C("pros_cons_text"), F.when(C("doc_id") % 8 == 3, C("source")), none, C("text")
    )
    return rows.select("doc_id", pros.alias("pros"), cons.alias("cons"))


@query
def author_date(spark, sf):
    author, date = extract.author_date(C("author_text"))
    return view(spark, sf, "review_text").select(
        "doc_id", author.alias("author"), date.alias("publish_date")
    )


@query
def rival_ratings(spark, sf):
    found = extract.rival_ratings(C("rivals_section"), C("page_html"), C("scored_text"))
    return view(spark, sf, "scored_texts").select(
        "doc_id", found.alias("rivals"), extract.out_of_five(C("scored_text")).alias("scored")
    )


@query
def parse_rivals(spark, sf):
    rows = view(spark, sf, "rivals").select(
        "car_id", F.posexplode(extract.parse_rivals(C("rivals_text"))).alias("place", "rival")
    )
    return rows.select("car_id", "place", "rival.name", "rival.rating", "rival.context")


@query
def rival_columns(spark, sf):
    found = view(spark, sf, "rivals").withColumn(
        "list", extract.parse_rivals(C("rivals_text"), dedupe=False)
    )
    columns = extract.rival_columns(C("list"))
    return found.select("car_id", *[c.alias(n) for n, c in columns.items()])


@query
def text_specs(spark, sf):
    fields = extract.prose_specs(C("article_text"))
    return view(spark, sf, "prose").select("doc_id", *[c.alias(n) for n, c in fields.items()])


@query
def page_sections(spark, sf):
    return view(spark, sf, "review_pages").select(
        "page_id", F.posexplode(html.sections(C("html"))).alias("section_no", "section")
    ).select("page_id", "section_no", "section.heading", "section.text")


@query
def page_markdown(spark, sf):
    return view(spark, sf, "review_pages").select(
        "page_id", html.markdown(C("html")).alias("markdown")
    )


@query
def page_fields(spark, sf):
    note = html.FieldRule("note", "div", "ad")  # the given pages hold no other marked element
    return view(spark, sf, "review_pages").select(
        "page_id", F.inline(html.fields(C("html"), [*html.DEFAULT_FIELDS, note]))
    )


@query
def html_prices(spark, sf):
    return view(spark, sf, "price_pages").select(
        "car_id", F.posexplode(extract.html_prices(C("html"))).alias("place", "price")
    )


@query
def answer_json(spark, sf):
    parsed = C("parsed")
    rows = view(spark, sf, "answers").withColumn("parsed", extract.answer_json(C("answer")))
    return rows.select(
        "event_id",
        parsed.isNotNull().alias("parsed"),
        parsed["min_used_price_gbp"].alias("low"),
        parsed["max_used_price_gbp"].alias("high"),
        parsed["confidence"].alias("confidence"),
    )
