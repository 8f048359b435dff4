"""Oracles for gap filling, answer checks, embedding and incremental runs."""

from oracles.classifying import missing
from oracles.combining import PRICE_KEY
from oracles.common import norm, number, views
from oracles.extracting import PAGES, RIVAL_CARDS, to_lines
from oracles.normalising import SQL as NORMALISING

SPECS_STRING = NORMALISING["specs_string"]
PROS = "regexp_extract(h, '(?s)<ul class=\"pros\">(.*?)</ul>', 1)"
CONS = "regexp_extract(h, '(?s)<ul class=\"cons\">(.*?)</ul>', 1)"


def best(column: str) -> str:
    """Longest text, the first page on ties (no page has boilerplate)."""
    return f"(array_agg({column} ORDER BY len({column}) DESC, e.page_id))[1]"

FAMILY = f"concat({norm('make')}, '|', {norm('model')}, '|', {norm('series_years')})"

ANSWERED = views("cars") + """
, a AS (
  SELECT *, CASE WHEN car_id % 5 <> 0 THEN cast(car_id % 260 - 10 AS double) END AS mpg,
    CASE WHEN car_id % 7 <> 0 THEN cast(car_id % 60 AS double) END AS ins,
    CASE WHEN car_id % 3 <> 0 THEN car_id % 35 - 0.5 END AS sprint
  FROM cars) """


def count_of(letter: str) -> str:
    return f"len(t) - len(replace(t, '{letter}', ''))"


SQL = {
    "enrich_families": views("cars") + f"""
, k AS (SELECT *, {FAMILY} AS family FROM cars),
r AS (
  SELECT family, (array_agg(lower(coalesce(engine_type, '')) ORDER BY car_id))[1] AS e
  FROM k GROUP BY family)
SELECT car_id, CASE WHEN contains(e, 'electric') THEN 'electric'
  WHEN regexp_matches(e, 'hybrid|plug') THEN 'hybrid' WHEN regexp_matches(e, 'tdi|dci') THEN 'diesel'
  ELSE 'petrol' END AS inferred_fuel
FROM k JOIN r USING (family)""",
    "sanitize_prices": views("answers") + r"""
, j AS (
  SELECT event_id, try_cast(nullif(regexp_extract(answer, '(?s)\{.*\}'), '') AS json) AS j,
    CASE WHEN event_id % 4 = 0 THEN (1 + event_id % 20) * 1000.0 + 250 END AS own
  FROM answers),
v AS (
  SELECT *, cast(j ->> 'min_used_price_gbp' AS double) AS a,
    cast(j ->> 'max_used_price_gbp' AS double) AS b
  FROM j),
o AS (
  SELECT *, CASE WHEN a > b THEN b ELSE a END AS lo, CASE WHEN a > b THEN a ELSE b END AS hi FROM v),
f AS (SELECT *, CASE WHEN lo < 100 THEN 100 ELSE lo END AS lo2 FROM o)
SELECT event_id, cast(coalesce(lo2, own) AS double) AS price_low,
  cast(coalesce(CASE WHEN hi < coalesce(lo2, 100) THEN coalesce(lo2, 100) ELSE hi END, own) AS double)
    AS price_high,
  CASE WHEN j IS NULL THEN 'low' ELSE coalesce(j ->> 'confidence', 'medium') END AS confidence,
  CASE WHEN j IS NULL THEN 'no-parse' ELSE '' END AS notes
FROM f""",
    "sanitize_specs": ANSWERED + """
SELECT car_id, CASE WHEN mpg > 0 AND mpg <= 200 THEN mpg END AS mpg,
  CASE WHEN ins BETWEEN 1 AND 50 THEN cast(cast(ins AS int) AS varchar) END AS insurance,
  cast(CASE WHEN sprint > 0 AND sprint <= 30 THEN sprint END AS double) AS sprint
FROM a""",
    "fill_missing": ANSWERED + f"""
SELECT car_id,
  CASE WHEN {missing('mpg_low')} AND mpg > 0 THEN mpg ELSE {number('mpg_low')} END AS mpg,
  CASE WHEN {missing('insurance_group')} AND ins IS NOT NULL THEN ins
    ELSE {number('insurance_group')} END AS insurance,
  CASE WHEN {missing('zero_to_sixty')} AND sprint IS NOT NULL THEN cast(sprint AS double)
    ELSE {number('zero_to_sixty')} END AS sprint
FROM a""",
    "embed_batches": rf"""
WITH d AS (
  SELECT doc_id, CASE WHEN doc_id % 9 = 0 THEN 'placeholder' ELSE text END AS t FROM documents),
c AS (
  SELECT doc_id, [{', '.join(count_of(v) for v in 'aeiou')}, 1]::double[] AS v FROM d),
n AS (SELECT doc_id, v, sqrt(list_inner_product(v, v)) AS n FROM c)
SELECT doc_id, {', '.join(
    f'round(cast(cast(v[{i + 1}] / n AS float) AS double), 4) AS x{i}' for i in range(6))}
FROM n""",
    "resume_incremental": """
SELECT event_id, user_id, event_type, CASE WHEN event_id % 3 = 0 THEN 1 ELSE 0 END AS batch_no
FROM events WHERE event_type <> 'error'""",
    "pages_to_catalogue": PAGES + f"""
, e AS (
  SELECT p.page_id, regexp_extract(p.url, '//[^/]*/([a-z]+)/', 1) AS k,
    array_to_string({to_lines("replace(first_article, '<li>', '<p>')")}, ' ') AS article,
    regexp_replace(array_to_string({to_lines(PROS)}, ' | '), '(^|[|] )- ', '\\1', 'g') AS pros,
    regexp_replace(array_to_string({to_lines(CONS)}, ' | '), '(^|[|] )- ', '\\1', 'g') AS cons,
    {RIVAL_CARDS} AS rivals
  FROM c3 JOIN art ON c3.page_id = art.page_id JOIN pages p ON p.page_id = art.page_id),
b AS (
  SELECT k, {best('article')} AS article, {best('pros')} AS pros, {best('cons')} AS cons,
    {best('rivals')} AS rivals
  FROM e GROUP BY k)
SELECT doc_id, md5(article) AS article_md5, pros, cons, rivals FROM documents LEFT JOIN b ON lang = k""",
    "price_gaps": views("cars") + f"""
, k AS (SELECT *, {PRICE_KEY} AS fid FROM cars),
w AS (SELECT DISTINCT fid FROM k WHERE trim(price_low) = ''),
l AS (
  SELECT fid, list_sort(list(DISTINCT l_extendedprice)) AS p
  FROM lineitem JOIN k ON l_partkey = car_id
  WHERE fid IN (SELECT fid FROM w) AND l_extendedprice >= 100 GROUP BY fid),
r AS (
  SELECT fid, CASE WHEN len(p) >= 20 THEN p[len(p) // 10 + 1] ELSE p[1] END AS lo,
    CASE WHEN len(p) >= 20 THEN p[(9 * len(p) + 9) // 10] ELSE p[-1] END AS hi, len(p) AS n
  FROM l)
SELECT car_id, coalesce(lo, {number('price_low')}) AS price_low_filled, hi AS price_high_filled,
  CASE WHEN n IS NULL THEN 'low' ELSE 'medium' END AS confidence,
  CASE WHEN n IS NULL THEN 'no-parse' ELSE 'sample n=' || n END AS notes
FROM k LEFT JOIN r ON k.fid = r.fid""",
    "embed_and_search": f"""
WITH t AS (
  SELECT car_id, CASE WHEN specs = '' THEN 'placeholder' ELSE specs END AS t
  FROM ({SPECS_STRING})),
c AS (SELECT car_id, [{', '.join(count_of(v) for v in 'aeiou')}, 1]::double[] AS v FROM t),
u AS (
  SELECT car_id, list_transform(v, lambda x: x / sqrt(list_inner_product(v, v)))::float[] AS v
  FROM c),
s AS (
  SELECT car_id, round(list_cosine_similarity(v::double[],
    (SELECT v FROM u WHERE car_id = 1)::double[]), 9) AS score
  FROM u WHERE car_id <> 1)
SELECT car_id, round(score, 6) AS score FROM s ORDER BY s.score DESC, car_id LIMIT 20""",
    "answered_prices": views("cars") + f"""
, k AS (
  SELECT *, {PRICE_KEY} AS fid, CASE WHEN car_id % 3 <> 0 THEN seats || ',900' END AS price_high FROM cars),
w AS (
  SELECT fid, min(car_id) AS n FROM k GROUP BY fid
  HAVING bool_or(trim(coalesce(price_low, '')) = '' OR price_high IS NULL)),
a AS (
  SELECT fid, greatest(50 + n * 37 % 20000, 100)::DOUBLE AS lo, (950 + n * 37 % 20000)::DOUBLE AS hi
  FROM w WHERE n % 7 <> 0)
SELECT car_id, coalesce(lo, {number("replace(price_low, ',', '')")}) AS price_low_filled,
  coalesce(hi, {number("replace(price_high, ',', '')")}) AS price_high_filled,
  CASE WHEN lo IS NULL THEN 'low' ELSE 'high' END AS confidence,
  CASE WHEN lo IS NULL THEN 'no-parse' ELSE '' END AS notes
FROM k LEFT JOIN a ON k.fid = a.fid""",
    "answered_specs": views("cars") + f"""
, k AS (SELECT *, {FAMILY} AS family FROM cars),
w AS (
  SELECT family, min(car_id) AS n FROM k GROUP BY family
  HAVING bool_or({missing('mpg_low')} OR {missing('insurance_group')} OR {missing('zero_to_sixty')})),
a AS (
  SELECT family, CASE WHEN n % 5 <> 0 AND n % 260 - 10 BETWEEN 1 AND 200 THEN (n % 260 - 10)::DOUBLE END AS mpg,
    CASE WHEN n % 7 <> 0 AND n % 60 BETWEEN 1 AND 50 THEN (n % 60)::DOUBLE END AS ins,
    CASE WHEN n % 3 <> 0 AND n % 35 - 0.5 > 0 AND n % 35 - 0.5 <= 30 THEN (n % 35 - 0.5)::DOUBLE END AS sprint
  FROM w)
SELECT car_id,
  CASE WHEN {missing('mpg_low')} AND mpg IS NOT NULL THEN mpg ELSE {number('mpg_low')} END AS mpg_filled,
  CASE WHEN {missing('insurance_group')} AND ins IS NOT NULL THEN ins ELSE {number('insurance_group')} END
    AS insurance_filled,
  CASE WHEN {missing('zero_to_sixty')} AND sprint IS NOT NULL THEN sprint ELSE {number('zero_to_sixty')} END
    AS sprint_filled
FROM k LEFT JOIN a USING (family)""",
    "staging_csv": views("cars") + """
SELECT car_id, make, coalesce(series_years, '') AS series_years, coalesce(engine_type, '') AS engine_type,
  coalesce(len(array_to_string(list_transform(embedding, lambda x: x::DOUBLE::DECIMAL(9,6)), ',')) + 2, 0)
    AS vector_chars
FROM cars LEFT JOIN embeddings ON vec_id = car_id""",
}
