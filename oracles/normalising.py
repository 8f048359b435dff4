"""Oracles for keys, normalisers and string projections."""

from oracles.common import blank_null, norm, norm_years, number, squeeze, strip, views, whole

CARS = views("cars")
FAMILY = f"concat({norm('make')}, '|', {norm('model')}, '|', {norm('series_years')})"


def open_year(x: str, now: str) -> str:
    return (
        f"CASE WHEN lower({strip(x)}) IN ('now', 'present', 'current') THEN '{now}' "
        f"ELSE {strip(x)} END"
    )


PHRASE = norm("concat_ws(' ', make, model, series_years)")

SQL = {
    "norm_ws": CARS + f"""
SELECT car_id, {norm('make')} AS make_norm,
  {squeeze("concat(make, chr(9), ' x ', chr(10), model)")} AS squeezed,
  {norm('engine_type')} AS engine_norm
FROM cars""",
    "norm_years": CARS + f"SELECT car_id, {norm_years('series_years')} AS years_norm FROM cars",
    "family_id": CARS + f"""
SELECT car_id, {FAMILY} AS family_key, {PHRASE} AS family_phrase,
  concat({FAMILY}, '|', {open_year('year_start', '2025')}, '|', {open_year('year_end', '2025')},
    '|', {norm('engine_type')}) AS price_key,
  concat(lower({strip('make')}), '|', lower({strip('model')}), '|',
    lower({strip('series_years')})) AS simple_key
FROM cars""",
    "row_id": CARS + """
SELECT car_id, concat(trim(make), '|', trim(model), '|', trim(series_years), '|',
  trim(year_start), '|', trim(year_end)) AS row_id
FROM cars""",
    "variant_id": CARS + f"""
, parts AS (
  SELECT car_id, {PHRASE} AS family,
    replace(trim(regexp_replace(lower(coalesce(engine_type, '')), '[^a-z0-9]+', ' ', 'g')),
      ' ', '-') AS slug
  FROM cars)
SELECT car_id, concat(family, '__', CASE WHEN slug = '' THEN concat('row', car_id) ELSE slug END)
  AS variant_id
FROM parts""",
    "blank_to_null": CARS + f"""
SELECT car_id, {blank_null('fuel_type')} AS fuel,
  coalesce({blank_null('fuel_type')}, 'placeholder') AS fuel_text
FROM cars""",
    "norm_year": CARS + f"""
SELECT car_id, {open_year('year_end', '2025')} AS year_end_price,
  {open_year('year_end', '2024')} AS year_end_specs
FROM cars""",
    "clean_years": CARS + r"""
, raw AS (
  SELECT car_id, model, CASE WHEN car_id % 4 = 3 THEN concat(model, ' Mk2') ELSE series_years END
    AS years
  FROM cars),
found AS (
  SELECT *, regexp_extract_all(years, '(19\d{2}|20\d{2})', 1) AS y FROM raw)
SELECT car_id, CASE WHEN len(y) >= 2 THEN concat(y[1], '–', y[2])
  WHEN len(y) = 1 THEN concat(y[1], '–present')
  WHEN trim(replace(years, model, '')) <> '' THEN trim(replace(years, model, ''))
  ELSE years END AS years_clean
FROM found""",
    "coerce_number": CARS + f"""
SELECT car_id, {number('power_bhp')} AS power,
  cast(replace(concat(seats, ',250.5'), ',', '') AS DOUBLE) AS with_comma,
  {whole("cast(concat(seats, '.5') AS DOUBLE)")} AS half_even,
  coalesce(cast({whole(number('zero_to_sixty'))} AS varchar), '') AS whole_text
FROM cars""",
    "first_numeric": CARS + f"""
SELECT car_id, coalesce({number('power_bhp')}, {number('mpg_low')}) AS power_or_mpg,
  coalesce({number('length_mm')}, {number('boot_l')}) AS length_or_boot
FROM cars""",
    "min_numeric": CARS + f"""
SELECT car_id, least({number('zero_to_sixty')}, {number('seats')}) AS fastest FROM cars""",
    "url_normalize": views("site_urls") + r"""
, raw AS (
  SELECT page_id, url FROM pages UNION ALL SELECT car_id, url FROM site_urls),
bare AS (
  SELECT page_id, regexp_replace(regexp_replace(url, '#.*$', ''), '\?.*$', '') AS u FROM raw),
parts AS (
  SELECT page_id,
    CASE WHEN u LIKE '%://%' THEN split_part(u, '://', 1) ELSE 'https' END AS scheme,
    CASE WHEN u LIKE '%://%' THEN split_part(split_part(u, '://', 2), '/', 1)
      ELSE 'www.example.com' END AS host,
    CASE WHEN u LIKE '%://%' THEN regexp_extract(u, '^[a-z]+://[^/]*(.*)$', 1) ELSE u END AS path
  FROM bare),
tidy AS (
  SELECT *, rtrim(regexp_replace(lower(path), '/+', '/', 'g'), '/') AS p FROM parts)
SELECT page_id, concat(scheme, '://', host, CASE WHEN p = '' OR p LIKE '/%' THEN p
  ELSE concat('/', p) END) AS url
FROM tidy""",
    "url_class": views("site_urls") + r"""
, tidy AS (
  SELECT car_id, url, lower(url) AS u,
    rtrim(regexp_replace(lower(url), '[?#].*$', ''), '/') AS p
  FROM site_urls)
SELECT car_id, p LIKE '%/specs' AS is_specs,
  p LIKE '%/review' OR p LIKE '%/used-review' OR p LIKE '%/owners-reviews' AS is_review,
  CASE WHEN u LIKE '%/review/' OR u LIKE '%/review'
    THEN replace(replace(u, '/review/', '/specs/'), '/review', '/specs') ELSE u END AS specs_url,
  replace(replace(url, '/review', '/specs'), '/used-review', '/specs') AS fallback_url
FROM tidy""",
    "url_candidates": views("site_urls") + r"""
, bare AS (
  SELECT car_id, regexp_replace(url, '[?#].*$', '') AS u FROM site_urls),
split AS (
  SELECT car_id, u, string_split(rtrim(u, '/'), '/') AS p FROM bare),
named AS (
  SELECT car_id, u, p, p[-2] AS tail,
    CASE WHEN regexp_matches(p[-2], '^[A-Za-z0-9-]+-(19|20)[0-9][0-9]$')
      THEN left(p[-2], len(p[-2]) - 5) END AS body,
    rtrim(regexp_replace(concat('www.example.com/', p[-4], '/', p[-3], '/'), '/+', '/', 'g'), '/')
      AS prefix
  FROM split),
tries AS (
  SELECT car_id, CASE WHEN p[-1] <> 'specs' THEN [u]
    WHEN len(p) < 4 THEN []
    ELSE flatten(list_transform(list_filter([
        concat(tail, '/review'), concat(tail, '/used-review'),
        CASE WHEN body IS NOT NULL THEN concat(body, '/review') END,
        CASE WHEN body IS NOT NULL THEN concat(body, '/used-review') END,
        concat(tail, '/owners-reviews'),
        CASE WHEN body IS NOT NULL THEN concat(body, '/owners-reviews') END],
      lambda x: x IS NOT NULL),
      lambda x: [concat('https://', prefix, '/', x, '/'), concat('https://', prefix, '/', x)]))
    END AS c
  FROM named)
SELECT car_id, cast(unnest(range(len(c))) AS int) AS place, unnest(c) AS candidate FROM tries""",
    "slugify": r"""
SELECT p_partkey, left(lower(regexp_replace(trim(regexp_replace(
  concat(p_name, ' (&) ', p_type), '[^\w\s-]', '', 'g')), '\s+', '-', 'g')), 80) AS slug,
  'row' AS empty_slug
FROM part""",
    "clean_text": rf"""
SELECT doc_id, {squeeze('text')} AS clean,
  len(trim(CASE WHEN contains({squeeze('text')}, 'the ')
    THEN split_part({squeeze('text')}, 'the ', 1) ELSE {squeeze('text')} END)) AS cut_chars
FROM documents""",
    "specs_string": CARS + f"""
, v AS (
  SELECT car_id, {blank_null('body_type')} AS body, {blank_null('engine_type')} AS engine,
    {blank_null('power_bhp')} AS power, {blank_null('transmission')} AS gearbox,
    {blank_null('doors')} AS doors, {blank_null('seats')} AS seats, {blank_null('mpg_low')} AS m1,
    {blank_null('insurance_group')} AS m2, {blank_null('zero_to_sixty')} AS sprint,
    {blank_null('length_mm')} AS length, {blank_null('boot_l')} AS boot,
    {blank_null('year_start')} AS y1, {blank_null('year_end')} AS y2
  FROM cars)
SELECT car_id, concat_ws('; ', 'Body: ' || body, 'Engine: ' || engine, 'Power (bhp): ' || power,
  'Transmission: ' || gearbox, 'Doors: ' || doors, 'Seats: ' || seats,
  'MPG: ' || CASE WHEN m1 <> m2 THEN m1 || '-' || m2 ELSE coalesce(m1, m2) END,
  'Insurance Group: ' || m2, '0-60 mph (s): ' || sprint, 'Length (mm): ' || length,
  'Luggage (L): ' || boot, 'Years: ' || coalesce(y1 || '-' || y2, y1, y2)) AS specs
FROM v""",
    "specs_string_all": CARS + f"""
, cells AS (
  SELECT car_id, unnest([{', '.join(
      f"struct_pack(k := {i}, piece := '{c}: ' || {blank_null(c)})" for i, c in enumerate([
          'make', 'model', 'series_years', 'year_start', 'year_end', 'body_type', 'engine_type',
          'fuel_type', 'transmission', 'drivetrain', 'doors', 'seats', 'power_bhp',
          'zero_to_sixty', 'mpg_low', 'insurance_group', 'length_mm', 'boot_l', 'price_low']))}]) AS c
  FROM cars),
running AS (
  SELECT car_id, c.k AS k, c.piece AS piece,
    sum(len(c.piece) + 2) OVER (PARTITION BY car_id ORDER BY c.k) AS used
  FROM cells WHERE c.piece IS NOT NULL)
SELECT car_id, string_agg(piece, '; ' ORDER BY k) AS specs
FROM running WHERE used <= 60 GROUP BY car_id""",
    "specs_text": CARS + """
SELECT car_id, concat_ws(', ', 'Power: ' || nullif(power_bhp, '') || ' bhp',
  'Transmission: ' || nullif(transmission, ''), 'Doors: ' || nullif(doors, ''),
  'Seats: ' || nullif(seats, ''), 'Engine: ' || nullif(engine_type, ''),
  'Fuel: ' || nullif(fuel_type, ''), 'Body: ' || nullif(body_type, '')) AS specs
FROM cars""",
    "specs_compact": CARS + f"""
, v AS (
  SELECT car_id, transmission, fuel_type, {whole("(" + number("zero_to_sixty") + ") * 10")} AS tenths,
    {number('seats')} AS seats, ({number("boot_l")}) + 0.5 AS boot, ({number("mpg_low")}) * 1.5 AS mpg
  FROM (SELECT car_id, transmission, fuel_type, zero_to_sixty, seats, boot_l, mpg_low FROM cars))
SELECT car_id, concat_ws('; ', '0–62mph ' || (tenths // 10) || '.' || (tenths % 10) || 's',
  nullif(transmission, ''), nullif(fuel_type, ''), cast(seats AS bigint) || ' seats',
  {whole('boot')} || 'L boot', {whole('mpg')} || 'mpg') AS specs
FROM v""",
    "specs_summary": CARS + f"""
, v AS (
  SELECT *, concat_ws(', ', {whole(number('power_bhp'))} || 'hp',
    '0–62mph ' || nullif(zero_to_sixty, '') || 's', nullif(drivetrain, ''),
    nullif(transmission, ''), nullif(boot_l, '') || 'L boot', nullif(seats, '') || ' seats') AS core
  FROM cars)
SELECT car_id, concat_ws(', ', nullif(body_type, ''), nullif(fuel_type, ''),
  CASE WHEN core = '' THEN 'key specs vary.' ELSE core || '.' END) AS summary
FROM v""",
    "word_limit": f"""
WITH w AS (
  SELECT doc_id, text, string_split({squeeze('text')}, ' ') AS words FROM documents)
SELECT doc_id, CASE WHEN len(words) > 150 THEN array_to_string(words[1:150], ' ') ELSE text END
    AS short_text,
  len(CASE WHEN len(words) > 160 THEN array_to_string(words[1:160], ' ') ELSE text END)
    AS chars_160
FROM w""",
    "labelled_context": CARS + f"""
SELECT car_id, concat_ws('; ', 'length_mm=' || {blank_null('length_mm')},
    'boot_l=' || {blank_null('boot_l')},
    'doors=' || coalesce({blank_null('doors')}, {blank_null('seats')}),
    'seats=' || {blank_null('seats')}) AS dimensions,
  concat_ws('; ', 'series_years=' || {blank_null('series_years')},
    'body_type=' || {blank_null('body_type')}, 'engine_type=' || {blank_null('engine_type')},
    'transmission=' || {blank_null('transmission')}, 'fuel=' || {blank_null('fuel_type')},
    'power_bhp=' || {blank_null('power_bhp')}) AS context
FROM cars""",
    "prompt_text": CARS + r"""
, v AS (
  SELECT car_id, trim(make) AS make, model, series_years AS years, year_start, year_end,
    coalesce(body_type, '') AS body, coalesce(engine_type, '') AS engine, power_bhp AS power,
    transmission AS gearbox, doors, seats, fuel_type AS fuel, mpg_low AS mpg,
    insurance_group AS insurance, zero_to_sixty AS sprint,
    coalesce(cast(2024 - coalesce(
      CASE WHEN regexp_matches(year_end, '^\d+$') THEN cast(year_end AS int) END,
      CASE WHEN regexp_matches(year_start, '^\d+$') THEN cast(year_start AS int) END) AS varchar),
      'unknown') AS age
  FROM cars)
SELECT car_id,
  'Name the fuel of ' || make || ' ' || model || ' with engine ' || engine || '. Answer with one of these and '
    || 'nothing else: petrol, diesel, mild hybrid, plug in hybrid, electric.' AS fuel_prompt,
  'Give the UK used price range in GBP for ' || make || ' ' || model || ', ' || years || ' ('
    || year_start || ' to ' || year_end || '), body ' || body || ', engine ' || engine || ', '
    || power || ' bhp, ' || gearbox || ', ' || doors || ' doors, ' || seats
    || ' seats. Answer as JSON with min_used_price_gbp, max_used_price_gbp, confidence, notes.'
    AS price_prompt,
  'Give mpg, insurance group and 0-60 time for ' || make || ' ' || model || ', ' || years
    || ', engine ' || engine || ', ' || power || ' bhp, ' || gearbox || '. Known: mpg ' || mpg
    || ', insurance ' || insurance || ', 0-60 ' || sprint || '. Answer as JSON with mpg_low_min, '
    || 'insurance_group_min, zero_to_sixty_secs_min, confidence, notes.' AS specs_prompt,
  'Suggest a safe mileage band for ' || make || ' ' || model || ', ' || years || ', body ' || body
    || ', ' || year_start || '-' || year_end || ' (age ' || age || ' years), engine ' || engine
    || ', fuel ' || fuel || ', ' || power || ' bhp, ' || gearbox
    || '. Answer only with the band in the form x–y miles.' AS mileage_prompt,
  'Write the official display name of ' || make || ' ' || model || ', ' || years || ', '
    || year_start || '-' || year_end || ', body ' || body || ', engine ' || engine || ', ' || power
    || ' bhp, ' || gearbox || ', ' || doors || ' doors, ' || seats || ' seats.' AS display_prompt
FROM v""",
    "rivals_text": views("rival_lists") + """
, parsed AS (
  SELECT car_id, try_cast(replace(rivals_json, '''', '"') AS JSON) AS j FROM rival_lists),
items AS (
  SELECT car_id, CASE WHEN json_type(j) = 'ARRAY' THEN
    list_transform(from_json(j, '["JSON"]'), lambda x: [trim(x ->> 'name'),
      trim(coalesce(x ->> 'context', ''))]) ELSE [] END AS l
  FROM parsed)
SELECT car_id, array_to_string(list_transform(list_filter(l, lambda p: p[1] <> ''),
  lambda p: CASE WHEN p[2] = '' THEN p[1] ELSE p[1] || ': ' || p[2] END), ' | ') AS rivals
FROM items""",
    "vector_texts": views("cars", "rivals") + r"""
, found AS (
  SELECT car_id, regexp_extract_all(rivals_text, '([A-Za-z0-9][A-Za-z0-9\-&'' ]+)\s*:\s*([\d.]+)/5', 1)
      AS names,
    regexp_extract_all(rivals_text, '([A-Za-z0-9][A-Za-z0-9\-&'' ]+)\s*:\s*([\d.]+)/5', 2) AS marks,
    regexp_extract(rivals_text, 'costs [0-9]+ less') AS cost
  FROM rivals),
told AS (
  SELECT c.*, coalesce(engine_type, 'varies') AS summary, f.names, f.marks,
    -- the first entry is followed by a web address, the second by what the car costs, the third by nothing
    CASE WHEN len(names) = 3 THEN ['', cost, ''] ELSE [] END AS contexts,
    CASE WHEN lower(coalesce(body_type, '')) IN ('suv', 'estate')
        THEN 'family trips and everyday versatility'
      WHEN body_type = 'Saloon' THEN 'comfortable commuting and long-distance cruising'
      WHEN body_type = 'MPV' THEN 'family hauling and practicality'
      WHEN body_type IN ('Coupe', 'Gran Coupe') THEN 'weekend drives and style-focused buyers'
      WHEN body_type = 'Hatchback' THEN 'city duties and easy daily use'
      ELSE 'general everyday driving' END AS uses
  FROM cars c JOIN found f ON c.car_id = f.car_id)
SELECT car_id,
  'The ' || model || ' Rivals: ' || array_to_string(list_filter(contexts, lambda x: x <> ''), ', ')
    || '. Use cases: ' || uses || '. Key facts: ' || summary || '.' AS text_main,
  model || ' rivals: ' || array_to_string(list_transform(names, lambda n, i: trim(trim(n) || ' ('
    || marks[i] || '/5): ' || contexts[i], ': ')), ' | ') AS text_rivals,
  model || ' ' || series_years || '. ' || summary AS text_specs
FROM told""",
    "display_fallback": CARS + """
SELECT car_id, CASE WHEN car_id % 3 <> 0 AND engine_type IS NOT NULL THEN trim(engine_type)
  ELSE make || ' ' || model END AS display_name
FROM cars""",
    "table_specs": views("cars", "prose") + rf"""
, t AS (
  SELECT c.car_id, nullif(trim(engine_type), '') AS engine, lower({blank_null('fuel_type')}) AS fuel,
    lower(nullif(trim(body_type), '')) AS body,
    cast({whole(number('power_bhp'))} AS varchar) AS hp, nullif(trim(zero_to_sixty), '') AS sprint,
    cast(cast({number('seats')} AS bigint) AS varchar) AS seats,
    cast(cast({number('boot_l')} AS bigint) AS varchar) AS boot, lower(p.article_text) AS a
  FROM cars c LEFT JOIN prose p ON c.car_id = p.doc_id),
said AS (
  SELECT *, CASE WHEN contains(a, 'diesel') THEN 'diesel' WHEN contains(a, 'petrol') THEN 'petrol'
      WHEN contains(a, 'hybrid') THEN 'hybrid' WHEN contains(a, 'phev') THEN 'phev'
      WHEN contains(a, 'electric') THEN 'electric' END AS a_fuel,
    nullif(regexp_extract(a, '(\d{{2,4}})\s*(?:bhp|hp)', 1), '') AS a_hp,
    nullif(regexp_extract(a, '0\s*[–-]\s*62\s*mph[^\d]*(\d{{1,2}}(?:\.\d)?)s', 1), '') AS a_sprint,
    CASE WHEN contains(a, 'rwd') THEN 'RWD' WHEN contains(a, 'fwd') THEN 'FWD'
      WHEN contains(a, 'awd') THEN 'AWD' WHEN contains(a, '4wd') THEN '4WD' END AS a_drive,
    CASE WHEN contains(a, 'manual') THEN 'manual' WHEN contains(a, 'auto') THEN 'auto' END AS a_gear,
    nullif(regexp_extract(a, '(\d{{2,3}})\s*mpg', 1), '') AS a_mpg
  FROM t)
SELECT car_id, engine, coalesce(fuel, a_fuel) AS fuel, body,
  CASE WHEN fuel IS NULL THEN coalesce(hp, a_hp) ELSE hp END AS hp,
  CASE WHEN fuel IS NULL THEN coalesce(sprint, a_sprint) ELSE sprint END AS sprint,
  seats, boot, CASE WHEN fuel IS NULL THEN a_drive END AS drive,
  CASE WHEN fuel IS NULL THEN a_gear END AS gearbox, CASE WHEN fuel IS NULL THEN a_mpg END AS mpg
FROM said""",
    "default_rivals": views("rival_lists") + """
SELECT car_id, CASE WHEN rivals_json IS NOT NULL THEN rivals_json
  WHEN other_json IS NOT NULL THEN other_json ELSE '[]' END AS rivals_json
FROM rival_lists""",
}
