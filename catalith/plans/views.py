"""Derived inputs, as one select list each that both engines understand.

They turn the given tables into catalogue rows, texts, answers and pages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# view: (table, select list)
VIEWS: dict[str, tuple[str, tuple[str, ...]]] = {
    "cars": ("part", (
        "p_partkey AS car_id",
        "CASE p_partkey % 6 WHEN 0 THEN 'BMW' WHEN 1 THEN ' Audi ' WHEN 2 THEN 'Toyota'"
        " WHEN 3 THEN 'Ford' WHEN 4 THEN 'Mercedes-Benz' ELSE 'Skoda' END AS make",
        "p_name AS model",
        "CASE p_size % 5"
        " WHEN 0 THEN concat('(', cast(2000 + p_size % 10 AS string), ' - ', cast(2011 + p_size % 9 AS string), ')')"
        " WHEN 1 THEN concat(cast(2000 + p_size % 10 AS string), '–', cast(2011 + p_size % 9 AS string))"
        " WHEN 2 THEN concat('from ', cast(2000 + p_size % 10 AS string))"
        " WHEN 3 THEN '1994 to 1999' ELSE '' END AS series_years",
        "cast(2000 + p_size % 10 AS string) AS year_start",
        "CASE p_size % 4 WHEN 0 THEN 'Now' WHEN 1 THEN ''"
        " ELSE cast(2011 + p_size % 9 AS string) END AS year_end",
        "CASE p_partkey % 11 WHEN 0 THEN 'Hatchback' WHEN 1 THEN 'Estate' WHEN 2 THEN 'SUV'"
        " WHEN 3 THEN 'Saloon' WHEN 4 THEN 'Coupe' WHEN 5 THEN 'Gran Coupe' WHEN 6 THEN 'MPV'"
        " WHEN 7 THEN 'Sportback' WHEN 8 THEN 'Convertible' WHEN 9 THEN 'Other' ELSE NULL"
        " END AS body_type",
        "CASE p_partkey % 9 WHEN 0 THEN '2.0 TDI' WHEN 1 THEN '1.0 TSI 110 PS'"
        " WHEN 2 THEN '1.5 T petrol' WHEN 3 THEN '2.0 PHEV plug-in' WHEN 4 THEN '1.8 Hybrid'"
        " WHEN 5 THEN 'EV electric' WHEN 6 THEN '4.0 V8 AMG' WHEN 7 THEN '2.2 dCi' ELSE NULL"
        " END AS engine_type",
        "CASE p_partkey % 7 WHEN 0 THEN 'Diesel' WHEN 1 THEN 'Petrol' WHEN 2 THEN 'Hybrid'"
        " WHEN 3 THEN 'Plug-in Hybrid' WHEN 4 THEN 'Electric' WHEN 5 THEN 'nan' ELSE ''"
        " END AS fuel_type",
        "CASE p_partkey % 4 WHEN 0 THEN 'Manual' WHEN 1 THEN 'Automatic' WHEN 2 THEN 'DSG'"
        " ELSE '' END AS transmission",
        "CASE p_partkey % 5 WHEN 0 THEN 'quattro' WHEN 1 THEN 'AWD' WHEN 2 THEN 'FWD'"
        " ELSE NULL END AS drivetrain",
        "CASE p_size % 6 WHEN 0 THEN '3' WHEN 1 THEN '5' WHEN 2 THEN '5 (est)' WHEN 3 THEN ''"
        " ELSE '4' END AS doors",
        "cast(2 + p_size % 6 AS string) AS seats",
        "CASE p_size % 10 WHEN 0 THEN '' WHEN 1 THEN 'N/A'"
        " ELSE cast(60 + p_size * 7 AS string) END AS power_bhp",
        "CASE WHEN p_size % 8 = 0 THEN '0' ELSE concat(cast(2 + p_size % 11 AS string), '.5')"
        " END AS zero_to_sixty",
        "CASE WHEN p_size % 7 = 0 THEN '0' ELSE cast(20 + p_size AS string) END AS mpg_low",
        "CASE WHEN p_size % 9 = 0 THEN '0' ELSE cast(p_size AS string) END AS insurance_group",
        "CASE WHEN p_size % 5 = 0 THEN NULL ELSE cast(4000 + p_size * 20 AS string)"
        " END AS length_mm",
        "CASE WHEN p_size % 6 = 0 THEN NULL ELSE cast(200 + p_size * 9 AS string) END AS boot_l",
        "CASE WHEN p_size % 3 = 0 THEN ''"
        " ELSE cast(cast(floor(p_retailprice) AS int) AS string) END AS price_low",
    )),
    "glance": ("part", (
        "p_partkey AS car_id",
        "concat('At a glance Price new £', cast(10 + p_size AS string), ',', cast(100 + p_partkey % 900 AS string), ' - £', cast(20 + p_size AS string), ',', cast(100 + p_partkey % 800 AS string),  CASE"
        " WHEN p_size % 4 = 0 THEN ''"
        " ELSE concat(' Used prices £', cast(p_size AS string), ',', cast(100 + p_partkey % 700 AS string), ' - £', cast(5 + p_size AS string), ',250') END,  ' View 13 for sale Road tax cost £', cast(20 + p_size AS string), ' - £', cast(120 + p_size AS string),  ' Insurance group ', cast(p_size AS string), ' - ', cast(p_size + 2 AS string),  ' Fuel economy Not tested to latest standards Range ', cast(300 + p_size AS string), ' - ', cast(310 + p_size AS string),  ' miles Number of doors ', cast(3 + p_size % 3 AS string), ' View full specs Available fuel types Petrol') AS glance_text",
    )),
    "rivals": ("part", (
        "p_partkey AS car_id",
        "CASE WHEN p_size % 7 = 0 THEN ''"
        " ELSE concat('MINI Cooper S: 4.5/5 | https://www.example.com/mini/', ' | ', p_name, ': ', cast(1 + p_size % 4 AS string), '.0/5 (verdict): costs ', cast(p_size AS string), ' less | ', 'mini cooper s: 3.0/5')"
        " END AS rivals_text",
    )),
    "descriptions": ("documents", (
        "doc_id",
        "source AS series_key",
        "CASE doc_id % 7"
        " WHEN 0 THEN concat(text, ' Follow three simple steps to get to your desired version')"
        " WHEN 1 THEN concat('Step 1 of 3 - select trim level ', text)"
        " WHEN 2 THEN concat('Step 1 of 3 - select trim level. Brief specification overview ', text)"
        " WHEN 3 THEN '' ELSE text END AS article_text",
    )),
    "review_text": ("documents", (
        "doc_id",
        "CASE doc_id % 4"
        " WHEN 0 THEN concat('Pros & cons PROS ', substr(lang, 1, 2), ' handling CONS firm ride ', source)"
        " WHEN 1 THEN concat('PROS roomy ', source) WHEN 2 THEN concat('CONS noisy ', source)"
        " ELSE '&' END AS pros_cons_text",
        "CASE doc_id % 3"
        " WHEN 0 THEN concat('Written by Ivo Marsh', ' Published: 6 June 2019')"
        " WHEN 1 THEN 'Written by Tess Quill, editor' ELSE 'anonymous' END AS author_text",
    )),
    "answers": ("events", (
        "event_id",
        "user_id AS fid",
        "CASE event_id % 6"
        ' WHEN 0 THEN concat(\'Sure: {"min_used_price_gbp": \', cast(50 + event_id % 5000 AS string), \', "max_used_price_gbp": \', cast(9000 - event_id % 8990 AS string), \', "confidence": "high"} ok\') '
        ' WHEN 1 THEN concat(\'{"min_used_price_gbp": \', cast(event_id % 90 AS string), \', "max_used_price_gbp": 40}\') '
        ' WHEN 2 THEN \'{"min_used_price_gbp": null, "max_used_price_gbp": 7000, "confidence": "low"}\' '
        " WHEN 3 THEN 'no json here' WHEN 4 THEN '{broken' ELSE props END AS answer",
    )),
    "review_pages": ("pages", (
        "page_id",
        "url",
        'replace(replace(html, \'<br><p>\', \'</p><h2>Overview</h2><p>\'), \'</article>\',   concat(\'<h2>Pros &amp; cons</h2><ul class="pros"><li>roomy</li><li>quiet \', cast(page_id AS string), \'</li></ul><ul class="cons"><li>firm ride</li></ul>\', CASE WHEN page_id % 3 = 0 THEN concat(\'<div class="wide glance box"><div class="row">Doors <b>\', cast(2 + page_id % 4 AS string), \'</b></div><div>Seats <div>4</div></div> in all</div>\') ELSE \'\' END, CASE WHEN page_id % 5 < 2 THEN concat(\'<a class="rival-review-card big" href="/a">Ford <b>Ka</b> \', cast(page_id % 9 AS string), \'</a> <a class="rival-review-card">Mini</a>\') ELSE \'\' END, \'</article>\', CASE WHEN page_id % 4 = 1 THEN \'<article><p>Second opinion <article>inner</article> after</p></article>\' ELSE \'\' END)) AS html',
    )),
    "scored_texts": ("documents", (
        "doc_id",
        "CASE doc_id % 3 WHEN 0 THEN concat('Fiat Panda ', cast(1 + doc_id % 5 AS string),"
        " '.5 out of 5, Smart ', cast(doc_id % 5 AS string), ' out of 5')"
        " WHEN 1 THEN 'no score' ELSE NULL END AS scored_text",
        "CASE doc_id % 5 WHEN 0 THEN concat('<a class=\"x\" href=\"/rivals/', source,"
        " '\">Rival ', source, '</a><a href=\"/home\">Home</a>')"
        " WHEN 1 THEN '<a href=\"/competitor/a\"> A </a><a href=\"/RIVAL/b\">B</a>'"
        " ELSE text END AS page_html",
        "CASE WHEN doc_id % 7 = 0 THEN concat('Mini: 4/5 | ', source) ELSE '' END AS rivals_section",
    )),
    "prose": ("documents", (
        "doc_id",
        "concat(CASE doc_id % 4 WHEN 0 THEN 'The 2.0 Diesel with 150 bhp does 0-62 mph in 8.5s'"
        " WHEN 1 THEN 'A plug-in Hybrid, 204hp, 0–62mph takes 12s, AWD'"
        " WHEN 2 THEN 'Petrol FWD manual returns 48 mpg' ELSE 'Automatic RWD' END, ' ', text)"
        " AS article_text",
    )),
    "labels_text": ("part", (
        "p_partkey AS car_id",
        "CASE p_partkey % 13 WHEN 0 THEN 'Small Hatch Back' WHEN 1 THEN 'Gran Coupe'"
        " WHEN 2 THEN ' executive hatchback ' WHEN 3 THEN 'executive sedan' WHEN 4 THEN 'Saloon'"
        " WHEN 5 THEN 'sports tourer, touring' WHEN 6 THEN 'MPV' WHEN 7 THEN 'Roadster'"
        " WHEN 8 THEN 'Coupe' WHEN 9 THEN 'Large SUV' WHEN 10 THEN 'crossover'"
        " WHEN 11 THEN 'Pickup' ELSE p_name END AS answer",
    )),
    "price_pages": ("part", (
        "p_partkey AS car_id",
        "CASE WHEN p_size % 5 = 4 THEN concat('<div class=\"vehicle-price\"><div>Now</div><b>£', cast(p_size AS string),"
        " ',500</b><div>was <div class=\"vehicle-price\">£', cast(100 + p_partkey % 900 AS string),"
        " '</div></div></div><p>£3</p>') WHEN p_size % 3 = 0 THEN concat('<div><span class=\"vehicle-price\"><b>£',"
        " cast(p_size AS string), ',', cast(100 + p_partkey % 900 AS string),"
        " '</b></span><span class=\"vehicle-price\">£ 9,500 was £9,900</span>"
        "<p>£1</p><span data-testid=\"advert-price\">£8,250</span></div>')"
        " WHEN p_size % 3 = 1 THEN concat('<p>from £', cast(p_size AS string), ',500 to £99,000</p><p>£',"
        " cast(p_partkey AS string), '</p><p>£', cast(p_partkey AS string), '</p>')"
        " ELSE concat('<p>', p_name, '</p>') END AS html",
    )),
    "document_json": ("pages", (
        "page_id",
        "url",
        "cast(1990 + page_id % 30 AS string) AS series",
        "CASE page_id % 5"
        " WHEN 0 THEN concat('{\"url\": \"', url, '\", \"processing_status\": \"failed\","
        " \"error\": \"timeout\"}')"
        " WHEN 1 THEN concat('{\"url\": \"', url, '\", \"processing_status\": \"success\","
        " \"source\": \"specs_page_fallback\", \"title\": \"Specs\"}')"
        " WHEN 2 THEN concat('{\"title\": \"Review ', cast(page_id AS string), '\", \"url\": \"',"
        " url, '\", \"processing_status\": \"success\", \"article_text\": \"Short text\"}')"
        " ELSE concat('{\"title\": \"Review ', cast(page_id AS string), '\", \"url\": \"', url,"
        " '\", \"processing_status\": \"success\", \"article_text\": \"Long text ',"
        " cast(page_id * 7 AS string), '\", \"sections\": {\"Overview\": \"good\"},"
        " \"key_info\": {\"author\": \"Ann\", \"pros\": \"roomy\", \"cons\": \"firm ',"
        " cast(page_id % 4 AS string), '\", \"doors\": \"5\", \"rivals\": \"Mini: 4/5\"}}') END"
        " AS document",
    )),
    "site_urls": ("part", (
        "p_partkey AS car_id",
        "CASE p_partkey % 6"
        " WHEN 0 THEN concat('https://www.example.com/bmw/', replace(p_name, ' ', '-'), '/saloon-',"
        " cast(1999 + p_size AS string), '/specs/?x=1')"
        " WHEN 1 THEN concat('https://www.example.com/audi//', replace(p_name, ' ', '-'),"
        " '/estate/specs')"
        " WHEN 2 THEN concat('/Ford/', replace(p_name, ' ', '-'), '/Review/')"
        " WHEN 3 THEN concat('https://www.example.com/kia/', replace(p_name, ' ', '-'),"
        " '/used-review#top')"
        " WHEN 4 THEN 'x/specs' ELSE concat('http://shop.example.org/owners-reviews/',"
        " cast(p_size AS string)) END AS url",
    )),
    "rival_lists": ("part", (
        "p_partkey AS car_id",
        "CASE p_partkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '[]' WHEN 2 THEN 'not a list'"
        " WHEN 3 THEN concat('[{\"name\": \"', p_name, '\", \"context\": \"cheap\"},"
        " {\"name\": \" Mini \", \"context\": \"\"}]')"
        " ELSE concat('[{', chr(39), 'name', chr(39), ': ', chr(39), p_name, chr(39), ', ',"
        " chr(39), 'context', chr(39), ': ', chr(39), chr(39), '}, {', chr(39), 'name', chr(39),"
        " ': ', chr(39), chr(39), '}]') END AS rivals_json",
        "CASE WHEN p_partkey % 2 = 0 THEN NULL ELSE concat('[{\"name\": \"', p_name, '\"}]') END"
        " AS other_json",
    )),
    "cache_lines": ("events", (
        "event_id AS line_no",
        "CASE event_id % 8 WHEN 0 THEN '{broken' WHEN 1 THEN concat('{\"fid\": \"',"
        " cast(user_id AS string), '\"}') WHEN 2 THEN concat('{\"data\": ', props, '}')"
        " ELSE concat('{\"fid\": \"', cast(user_id AS string), '\", \"data\": ', props, '}') END"
        " AS line",
    )),
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, or a view derived from one."""
    if name not in VIEWS:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    table, columns = VIEWS[name]
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").selectExpr(*columns)


def view_sql(name: str) -> str:
    """The same view as a SQL SELECT."""
    table, columns = VIEWS[name]
    return f"SELECT {', '.join(columns)} FROM {table}"
