"""Oracles for sources, sinks and typed loading."""

from oracles.common import number, views, whole

STAGED = views("cars", "rival_lists") + r"""
, st AS (
  SELECT car_id, make, model, year_end, CASE WHEN car_id % 17 = 5 THEN '99999999999' ELSE doors END AS doors,
    power_bhp,
    CASE WHEN car_id % 6 = 0 THEN NULL WHEN car_id % 6 = 1 THEN '' ELSE '[' || seats || ',0.5]' END
      AS vm,
    CASE WHEN car_id % 10 = 3 THEN '[]' ELSE '[' || seats || ',0.5]' END AS vs,
    cast(seats AS double) AS first
  FROM cars),
clean AS (SELECT *, coalesce(vm, '') NOT IN ('', '[]') AND vs <> '[]' AS filled FROM st) """


def digits(x: str) -> str:
    return f"regexp_matches({x}, '^[0-9]+$')"


def loose(x: str) -> str:
    """Typed, then shown as text."""
    return f"CASE WHEN {digits(x)} THEN cast(try_cast({x} AS int) AS varchar) END"


LOADED = f"""SELECT car_id, {loose('year_end')} AS year_end, {loose('doors')} AS doors,
  {loose('power_bhp')} AS power_bhp, 2 AS main_size, first AS specs_first FROM clean WHERE filled"""


def neat(x: str) -> str:
    return f"(coalesce({x}, '') = '' OR ({digits(x)} AND try_cast({x} AS int) IS NOT NULL))"


HEADERS = [
    ("make", "make"), ("model", "model"), ("series_years", "series_production_years"),
    ("year_start", "year_start"), ("year_end", "year_end"), ("body_type", "real_body_type"),
    ("engine_type", "engine_type"), ("power_bhp", "power_bhp"), ("transmission", "transmission"),
    ("doors", "doors"), ("seats", "seats"), ("price_low", "used_price_low_min"),
    ("mpg_low", "mpg_low_min"), ("insurance_group", "insurance_group_min"),
    ("zero_to_sixty", "zero_to_sixty_secs_min"), ("length_mm", "length_mm_avg"),
    ("boot_l", "luggage_capacity_litres_avg"),
]


def whole_text(x: str) -> str:
    return f"coalesce(cast({whole(number(x))} AS varchar), '')"


INFO = (
    "author", "publish_date", "new_price_min", "new_price_max", "used_price_min", "used_price_max",
    "road_tax_min", "road_tax_max", "insurance_group", "fuel_economy", "range_min", "range_max",
    "doors", "fuel_types", "pros", "cons", "rivals",
)

DOCS = views("document_json") + """
, j AS (SELECT page_id, url AS u, series, document, cast(document AS json) AS d FROM document_json),
k AS (SELECT *, d ->> 'processing_status' = 'success' AS ok,
  coalesce(d ->> 'source', '') = 'specs_page_fallback' AS skipped FROM j) """


def when_ok(x: str, cond: str = "ok") -> str:
    return f"CASE WHEN {cond} THEN coalesce({x}, '') ELSE '' END"


SQL = {
    "scan_text_table": """
SELECT cast(p_partkey AS varchar) AS p_partkey, p_name, p_brand, p_type,
  cast(p_size AS varchar) AS p_size, cast(p_retailprice AS varchar) AS p_retailprice
FROM part""",
    "normalize_headers": views("cars") + f"""
SELECT car_id, {', '.join(f'{a} AS {b}' for a, b in HEADERS)} FROM cars""",
    "structured_export": views("cars") + f"""
SELECT cast(car_id AS varchar) AS car_id, make AS "Make", model AS "Model",
  coalesce(engine_type, '') AS engine_type, coalesce(transmission, '') AS transmission_type,
  {whole_text("(power_bhp || '.5')")} AS bhp_min, '' AS bhp_max,
  {whole_text('insurance_group')} AS insurance_group_min, '' AS insurance_group_max,
  {whole_text('mpg_low')} AS mpg_min, '' AS mpg_max, {whole_text('price_low')} AS price_min,
  '' AS price_max
FROM cars""",
    "cache_last_wins": """
SELECT cast(user_id AS varchar) AS fid,
  cast(arg_max(cast(props AS json) ->> 'k', event_id) AS bigint) AS k
FROM events WHERE event_id % 8 > 2 GROUP BY user_id""",
    "vectors_sink": """
SELECT vec_id AS row_id, label, len(embedding) AS dimension,
  round(list_sum(embedding::double[]), 5) AS total
FROM embeddings""",
    "quoted_csv_sink": views("rivals") + """
SELECT car_id, rivals_text, 'say "hi",' || chr(10) || 'then go' AS note FROM rivals""",
    "load_strict": STAGED + LOADED + f"""
  AND {neat('year_end')} AND {neat('doors')} AND {neat('power_bhp')}""",
    "load_lenient": STAGED + LOADED,
    "load_full_refresh": STAGED + f"""
, r AS (
  SELECT s.*, j.rivals_json,
    CASE WHEN {neat('doors')} THEN 0 ELSE 1 END + CASE WHEN {neat('power_bhp')} THEN 0 ELSE 1 END
    + CASE WHEN {neat('year_end')} THEN 0 ELSE 1 END
    + CASE WHEN coalesce(j.rivals_json, '') = 'not a list' THEN 1 ELSE 0 END AS bad
  FROM st s JOIN rival_lists j ON s.car_id = j.car_id)
SELECT car_id, CASE WHEN bad = 0 THEN {loose('doors')} END AS doors,
  CASE WHEN bad = 0 THEN {loose('power_bhp')} END AS power_bhp,
  CASE WHEN bad = 0 THEN CASE WHEN rivals_json IS NULL THEN NULL WHEN rivals_json = '[]' THEN '0'
    ELSE '2' END END AS rivals,
  CASE WHEN bad = 0 AND car_id % 5 = 3 THEN 'cheap' WHEN bad = 0 AND car_id % 5 = 4 THEN '' END AS context,
  CASE WHEN bad = 0 THEN CASE WHEN vs = '[]' THEN '0' ELSE '2' END END AS specs_size,
  bad AS reasons, CASE WHEN bad > 0 THEN doors END AS raw_doors
FROM r""",
    "flatten_documents": DOCS + f"""
SELECT page_id, {when_ok("d ->> 'title'")} AS title,
  {', '.join(f'''{when_ok(f"d ->> '$.key_info.{f}'")} AS {f}''' for f in INFO)},
  {when_ok("d ->> 'article_text'")} AS article_text, document AS full_json,
  CASE WHEN ok THEN 'success' ELSE 'failed' END AS processing_status,
  {when_ok("d ->> 'url'")} AS resolved_url
FROM k""",
    "essential_rows": DOCS + f"""
SELECT u AS model_url, series AS series_production_year,
  {when_ok("d ->> 'title'", 'ok AND NOT skipped')} AS article_title,
  {when_ok("d ->> 'article_text'", 'ok AND NOT skipped')} AS article_text,
  {', '.join(f'''{when_ok(f"d ->> '$.key_info.{f}'", 'ok AND NOT skipped')} AS {f}'''
             for f in ('pros', 'cons', 'rivals'))},
  {when_ok("d ->> 'url'", 'ok AND NOT skipped')} AS resolved_url,
  CASE WHEN skipped THEN 'skipped_no_review' ELSE d ->> 'processing_status' END AS processing_status
FROM k""",
}
