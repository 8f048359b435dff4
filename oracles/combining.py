"""Oracles for joins, family aggregates, profiles and set operations."""

from oracles.classifying import BODY_LABEL, BOILER
from oracles.common import norm, norm_years, number, views
from oracles.normalising import open_year

FAMILY = f"concat({norm('make')}, '|', {norm('model')}, '|', {norm('series_years')})"
PRICE_KEY = (
    f"concat({FAMILY}, '|', {open_year('year_start', '2025')}, '|', "
    f"{open_year('year_end', '2025')}, '|', {norm('engine_type')})"
)
CARS = views("cars")
KEYED = CARS + f", k AS (SELECT *, {FAMILY} AS family FROM cars) "

BEST = f"""
, flagged AS (
  SELECT doc_id, lower(series_key) AS join_key, article_text,
    {BOILER.replace('T', 'article_text')} AS b
  FROM descriptions),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY join_key ORDER BY
    trim(article_text) = '', b, len(trim(article_text, concat(' ', chr(9), chr(10), chr(13), chr(160)))) DESC,
    doc_id) AS place
  FROM flagged),
best AS (SELECT join_key, article_text FROM ranked WHERE place = 1) """

RATED = r"([A-Za-z0-9][A-Za-z0-9\-&'' ]+)\s*:\s*([\d.]+)/5"

PROFILED = [
    "make", "model", "series_years", "year_start", "year_end", "body_type", "engine_type",
    "fuel_type", "transmission", "drivetrain", "doors", "seats", "power_bhp", "zero_to_sixty",
    "mpg_low", "insurance_group", "length_mm", "boot_l", "price_low",
]


def profile(column: str) -> str:
    x = f"cast({column} AS varchar)"
    return f"""SELECT '{column}' AS "column", count(*) AS rows, count(*) FILTER ({x} IS NULL) AS nulls,
  count(*) FILTER (lower({x}) = 'nan') AS nan_texts, count(*) FILTER ({x} = '') AS blanks,
  count(*) FILTER (({number(x)}) = 0) AS zeros, count(*) FILTER (({number(x)}) < 0) AS negatives,
  count(DISTINCT {x}) AS distinct_values, min({number(x)}) AS min_number,
  max({number(x)}) AS max_number FROM cars"""


def similarity(v: str, q: str) -> str:
    return f"round(list_cosine_similarity({v}::double[], {q}::double[]), 9)"


SQL = {
    "best_text_join": views("descriptions") + BEST + """
SELECT d.doc_id, md5(coalesce(b.article_text, d.lang)) AS text_md5
FROM documents d LEFT JOIN best b ON lower(trim(d.source)) = b.join_key""",
    "years_join": CARS + f"""
, t AS (
  SELECT {norm_years('series_years')} AS y,
    coalesce(arg_min(engine_type, car_id) FILTER (trim(engine_type) <> ''), '') AS essence,
    coalesce(arg_min(fuel_type, car_id) FILTER (trim(fuel_type) <> ''), '') AS image
  FROM cars GROUP BY 1)
SELECT car_id, {norm_years('upper(series_years)')} AS series_years, essence, image
FROM cars LEFT JOIN t ON {norm_years('upper(series_years)')} = t.y""",
    "first_wins_lookup": CARS + f"""
, t AS (
  SELECT {norm_years('series_years')} AS y,
    arg_min(trim(body_type), car_id) FILTER (trim(body_type) <> '') AS body
  FROM cars WHERE {norm_years('series_years')} <> '' GROUP BY 1)
SELECT car_id, coalesce(body, '') AS real_body
FROM cars LEFT JOIN t ON {norm_years('series_years')} = t.y""",
    "attach_vectors": CARS + """
SELECT c.car_id, model, 'v' || vec_id AS vector_text
FROM cars c LEFT JOIN embeddings e ON c.car_id = e.label""",
    "unprocessed": """
WITH p AS (SELECT page_id, CASE WHEN page_id % 10 <> 0 THEN url END AS url FROM pages)
SELECT page_id, url FROM p
WHERE url IS NULL OR NOT EXISTS (
  SELECT 1 FROM pages d WHERE d.url LIKE '%?%' AND d.url = p.url)""",
    "worklist": CARS + f"""
, k AS (SELECT *, {PRICE_KEY} AS fid FROM cars),
cached AS (SELECT fid FROM k WHERE car_id IN (SELECT user_id FROM events)),
wanted AS (SELECT fid FROM k WHERE trim(price_low) = '')
SELECT fid, car_id, make, model, engine_type FROM (
  SELECT *, row_number() OVER (PARTITION BY fid ORDER BY car_id) AS n FROM k)
WHERE n = 1 AND fid IN (SELECT fid FROM wanted) AND fid NOT IN (SELECT fid FROM cached)""",
    "apply_family_result": KEYED + """
, r AS (SELECT family, max(engine_type) AS best FROM k GROUP BY family)
SELECT car_id, family, coalesce(best, engine_type) AS engine_type FROM k JOIN r USING (family)""",
    "rerank_join": f"""
WITH q AS (SELECT embedding AS q FROM embeddings WHERE vec_id = 1),
top AS (
  SELECT label FROM embeddings, q ORDER BY {similarity('embedding', 'q')} DESC, vec_id LIMIT 3)
SELECT vec_id, label FROM embeddings WHERE label IN (SELECT label FROM top)""",
    "query_vector_subquery": f"""
SELECT vec_id, label, round(1 - s, 6) AS distance FROM (
  SELECT vec_id, label, {similarity('embedding',
                                    '(SELECT embedding FROM embeddings WHERE vec_id = 1)')} AS s
  FROM embeddings WHERE vec_id <> 1)
ORDER BY s DESC, vec_id LIMIT 10""",
    "family_first": KEYED + """
SELECT family, arg_min(engine_type, car_id) AS engine_type, arg_min(drivetrain, car_id) AS drivetrain,
  arg_min(length_mm, car_id) AS length_mm, arg_min(body_type, car_id) AS body_type,
  min(car_id) AS row_car_id, (array_agg(engine_type ORDER BY car_id))[1] AS row_engine_type,
  (array_agg(drivetrain ORDER BY car_id))[1] AS row_drivetrain,
  (array_agg(length_mm ORDER BY car_id))[1] AS row_length_mm,
  (array_agg(body_type ORDER BY car_id))[1] AS row_body_type
FROM k GROUP BY family""",
    "pick_best_string": views("descriptions") + BEST + """
SELECT join_key, md5(article_text) AS text_md5, len(article_text) AS chars FROM best""",
    "first_nonblank": CARS + f"""
SELECT {norm_years('series_years')} AS years,
  coalesce(arg_min(engine_type, car_id) FILTER (trim(engine_type) <> ''), '') AS engine,
  coalesce(arg_min(fuel_type, car_id) FILTER (trim(fuel_type) <> ''), '') AS fuel
FROM cars GROUP BY 1""",
    "family_rivals": views("cars", "rivals") + f"""
, f AS (
  SELECT c.car_id, {norm('make')} AS make, regexp_extract_all(rivals_text, '{RATED}', 1) AS n,
    regexp_extract_all(rivals_text, '{RATED}', 2) AS r
  FROM cars c JOIN rivals v ON c.car_id = v.car_id),
t AS (
  SELECT car_id, make, unnest(range(len(n))) AS i, trim(unnest(n)) AS name, unnest(r) AS rating FROM f),
u AS (
  SELECT *, row_number() OVER (PARTITION BY make, lower(name) ORDER BY car_id, i) AS again FROM t),
w AS (
  SELECT *, row_number() OVER (PARTITION BY make ORDER BY car_id, i) AS place FROM u WHERE again = 1)
SELECT make, string_agg(name || ' ' || rating || '/5', ' | ' ORDER BY place) AS rivals
FROM w WHERE place <= 5 GROUP BY make""",
    "family_body": KEYED + f"""
, g AS (
  SELECT family, coalesce(arg_min(body_type, car_id) FILTER (trim(body_type) <> ''), '') AS raw_body,
    median({number('length_mm')}) AS median_length
  FROM k GROUP BY family),
l AS (SELECT *, lower(raw_body) AS t, median_length AS n FROM g),
m AS (SELECT *, coalesce({BODY_LABEL}, '') AS rule_label FROM l)
SELECT family, raw_body, median_length, rule_label,
  rule_label = '' OR (contains(rule_label, 'hatchback') AND coalesce(n >= 4850, false))
    OR t IN ('other', 'unknown', '') AS ambiguous
FROM m""",
    "value_counts": CARS + """
, v AS (
  SELECT lower(coalesce(engine_type, '')) AS e, lower(coalesce(fuel_type, '')) AS f FROM cars),
r AS (
  SELECT CASE WHEN contains(f, 'petrol') THEN 'petrol' WHEN contains(f, 'diesel') THEN 'diesel'
    WHEN contains(f, 'electric') THEN 'electric'
    WHEN regexp_matches(e, 'ev|electric') THEN 'electric'
    WHEN contains(e, 'hybrid') THEN 'mild hybrid' WHEN contains(e, 'diesel') THEN 'diesel'
    ELSE 'petrol' END AS value
  FROM v)
SELECT value, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM r), 4) AS share
FROM r GROUP BY value""",
    "column_profile": CARS + " UNION ALL ".join(profile(c) for c in PROFILED),
    "vector_profile": """
WITH c AS (
  SELECT 'good' AS "column", len(embedding) AS dimension,
    sqrt(list_inner_product(embedding::double[], embedding::double[])) AS norm,
    len(array_to_string(list_transform(embedding, lambda x: x::DOUBLE::DECIMAL(9,6)), ',')) + 2 AS chars
  FROM embeddings
  UNION ALL
  SELECT 'mixed', CASE WHEN vec_id % 5 <> 0 THEN 2 ELSE -1 END,
    CASE WHEN vec_id % 5 <> 0 THEN sqrt(label * label + 0.0625) END,
    CASE WHEN vec_id % 5 = 0 THEN 7 ELSE len('[' || label || ',0.25]') END
  FROM embeddings)
SELECT "column", dimension, count(*) AS cells, max(chars) AS max_chars, 0 AS over_limit,
  count(*) FILTER (norm < 0.97 OR norm > 1.03) AS off_norm, count(*) AS bracketed
FROM c GROUP BY ALL""",
    "row_window_by_position": """
SELECT cast(p_partkey AS varchar) AS p_partkey, p_name, position FROM (
  SELECT p_partkey, p_name, row_number() OVER (ORDER BY p_partkey) - 1 AS position FROM part)
WHERE position BETWEEN 20 AND 79 OR position BETWEEN 130 AND 189""",
    "status_summary": """
SELECT count(*) AS total, count(*) FILTER (event_type IN ('purchase', 'signup')) AS success,
  count(*) FILTER (event_type = 'error') AS failed,
  count(*) FILTER (event_type IN ('view', 'click')) AS skipped,
  round(count(*) FILTER (event_type IN ('purchase', 'signup')) * 100.0 / count(*), 4)
    AS success_percent
FROM events""",
    "robust_range": """
WITH l AS (
  SELECT l_partkey AS fid, list_sort(list(DISTINCT l_extendedprice)) AS p
  FROM lineitem WHERE l_extendedprice >= 100 GROUP BY 1)
SELECT fid, CASE WHEN len(p) >= 20 THEN p[len(p) // 10 + 1] ELSE p[1] END AS min_price,
  CASE WHEN len(p) >= 20 THEN p[(9 * len(p) + 9) // 10] ELSE p[-1] END AS max_price,
  'medium' AS confidence, 'sample n=' || len(p) AS notes
FROM l""",
    "coverage": views("descriptions", "review_text") + """
SELECT count(*) AS rows, count(*) FILTER (coalesce(trim(article_text), '') = '') AS article_text_missing,
  count(*) FILTER (pros_cons_text = '&') AS pros_cons_text_missing,
  count(*) FILTER (coalesce(trim(article_text), '') <> '' OR pros_cons_text <> '&') AS any_filled
FROM descriptions d JOIN review_text r ON d.doc_id = r.doc_id""",
    "load_verify": """
SELECT count(*) AS rows, count(*) FILTER (label = 3) AS vector_main_missing,
  0 AS vector_specs_missing,
  count(*) FILTER (label <> 3 AND len(embedding) <> 64) AS vector_main_wrong_size,
  count(*) FILTER (label = 4 OR len(embedding) <> 64) AS vector_specs_wrong_size
FROM embeddings""",
    "row_window": CARS + "SELECT car_id, model FROM cars WHERE car_id >= 50 AND car_id < 150",
    "append_union": CARS + """
SELECT car_id, price_low, NULL AS engine_type FROM cars WHERE trim(price_low) <> ''
UNION ALL SELECT car_id, NULL, engine_type FROM cars WHERE trim(price_low) = ''""",
}
