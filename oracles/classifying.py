"""Oracles for filters and rule classification."""

from oracles.common import blank_null, norm, number, squeeze, views

CARS = views("cars")
FAMILY = f"concat({norm('make')}, '|', {norm('model')}, '|', {norm('series_years')})"

BOILER = r"""
(regexp_matches(lower(T), 'follow\s+(three|3)\s+simple\s+steps\s+to\s+get\s+to\s+your\s+desired\s+version')
 OR cast(regexp_matches(lower(T), 'step\s*1\s*of\s*3\s*-\s*select\s*trim\s*level') AS int)
  + cast(regexp_matches(lower(T), 'step\s*2\s*of\s*3\s*-\s*select\s*engine') AS int)
  + cast(regexp_matches(lower(T), 'step\s*3\s*of\s*3\s*-\s*select\s*version') AS int)
  + cast(regexp_matches(lower(T), 'select\s+one\s+of\s+the\s+versions\s+below') AS int)
  + cast(regexp_matches(lower(T), 'brief\s+specification\s+overview') AS int)
  + cast(regexp_matches(lower(T), 'enter\s+the\s+car\s+registration') AS int) >= 2)"""


def missing(x: str) -> str:
    return f"(coalesce(trim({x}), '') IN ('', '0', '0.0') OR coalesce(({number(x)}) = 0, false))"


def gone(x: str) -> str:
    return f"coalesce(trim({x}), '') = ''"


SIZED = CARS + f""", b AS (
  SELECT car_id, make, model, series_years, engine_type, transmission, drivetrain, fuel_type,
    body_type, lower(coalesce(body_type, '')) AS t, {number('length_mm')} AS n,
    {number('zero_to_sixty')} AS sprint, {number('mpg_low')} AS mpg, {number('boot_l')} AS boot,
    {number('seats')} AS seats_n, seats, boot_l, power_bhp,
    lower(coalesce(engine_type, '')) AS e, lower(coalesce(fuel_type, '')) AS f,
    lower(coalesce(transmission, '')) AS g, lower(coalesce(drivetrain, '')) AS d
  FROM cars) """

SIZE_BUCKET = """CASE
  WHEN contains(t, 'hatch') THEN CASE WHEN n >= 4300 THEN 'medium' ELSE 'small' END || ' hatchback'
  WHEN regexp_matches(t, 'estate|touring') THEN 'estate'
  WHEN regexp_matches(t, 'suv|crossover') THEN CASE WHEN n >= 4600 THEN 'large' ELSE 'crossover' END || ' SUV'
  WHEN contains(t, 'coupe') THEN CASE WHEN contains(t, 'gran') THEN 'gran coupe' ELSE 'coupe' END
  WHEN regexp_matches(t, 'saloon|sedan') THEN CASE WHEN n >= 4700 THEN 'executive' ELSE 'small' END || ' saloon'
  WHEN contains(t, 'mpv') THEN 'MPV'
  ELSE coalesce(nullif(body_type, ''), 'car') END"""

SIZE_DESCRIPTOR = """CASE
  WHEN regexp_matches(t, 'sportback|fastback|gran.?coupe')
    THEN CASE WHEN n >= 4850 THEN 'large ' ELSE '' END || 'executive hatchback (gran coupe style)'
  WHEN regexp_matches(t, 'estate|touring')
    THEN CASE WHEN contains(t, 'premium') THEN 'premium estate' ELSE 'estate' END
  WHEN regexp_matches(t, 'suv|crossover') THEN CASE WHEN n >= 4700 THEN 'large SUV' ELSE 'crossover SUV' END
  WHEN regexp_matches(t, 'saloon|sedan') THEN CASE WHEN n < 4700 THEN 'small saloon' ELSE 'executive saloon' END
  WHEN contains(t, 'hatch') THEN CASE WHEN n < 4300 THEN 'small hatchback' ELSE 'medium hatchback' END
  WHEN contains(t, 'mpv') THEN 'MPV' WHEN contains(t, 'coupe') THEN 'coupe'
  WHEN n >= 4850 THEN 'large executive car'
  ELSE coalesce(nullif(body_type, ''), 'car') END"""

COARSE_SIZE = """CASE
  WHEN n >= 4600 AND regexp_matches(t, 'suv|crossover') THEN 'large SUV'
  WHEN n >= 4900 THEN 'exec saloon' WHEN n >= 4600 THEN 'large'
  WHEN n >= 4400 THEN CASE WHEN regexp_matches(t, 'suv|crossover') THEN 'crossover SUV' ELSE 'medium' END
  WHEN n IS NOT NULL THEN CASE WHEN contains(t, 'hatch') THEN 'small hatchback'
    WHEN contains(t, 'suv') THEN 'crossover SUV' ELSE 'compact' END
  WHEN regexp_matches(t, 'suv|crossover') THEN 'crossover SUV'
  WHEN regexp_matches(t, 'saloon|sedan') THEN 'small saloon'
  WHEN regexp_matches(t, 'estate|wagon') THEN 'estate' WHEN contains(t, 'hatch') THEN 'small hatchback'
  WHEN contains(t, 'mpv') THEN 'mpv' WHEN contains(t, 'coupe') THEN 'coupe' END"""

SIZE_CLASS = """CASE
  WHEN n IS NULL THEN CASE WHEN t IN ('suv', 'crossover') THEN 'compact'
    WHEN t IN ('saloon', 'sedan', 'estate', 'wagon') THEN 'executive' END
  WHEN n >= 4900 THEN CASE WHEN t IN ('suv', 'crossover') THEN 'full-size' ELSE 'executive' END
  WHEN n >= 4800 AND t IN ('suv', 'crossover') THEN 'full-size'
  WHEN n >= 4600 THEN 'large' WHEN n >= 4400 THEN 'mid-size' ELSE 'compact' END"""

PERFORMANCE = """CASE WHEN sprint IS NULL THEN 'unknown' WHEN sprint < 3.5 THEN 'supercar'
  WHEN sprint < 5 THEN 'very fast' WHEN sprint < 7 THEN 'decent performance'
  WHEN sprint < 10 THEN 'average slow' ELSE 'very slow' END"""
ECONOMY = """CASE WHEN mpg IS NULL THEN '' WHEN mpg >= 55 THEN 'strong economy'
  WHEN mpg >= 45 THEN 'good economy' WHEN mpg >= 35 THEN 'average economy'
  ELSE 'lower economy' END"""
BOOT = """CASE WHEN boot IS NULL THEN '' WHEN boot < 300 THEN 'pack light'
  WHEN boot < 450 THEN 'usable hatch practicality'
  WHEN boot < 600 THEN 'generous boot capacity' ELSE 'extra-large cargo space' END"""

BODY_LABEL = """CASE
  WHEN regexp_matches(t, 'sportback|fastback|gran.?coupe')
    THEN CASE WHEN n >= 4850 THEN 'executive hatchback (gran coupe style)' ELSE 'gran coupe' END
  WHEN regexp_matches(t, 'estate|touring') THEN 'estate'
  WHEN regexp_matches(t, 'convertible|cabrio|roadster') THEN 'convertible'
  WHEN contains(t, 'mpv') THEN 'MPV' WHEN contains(t, 'coupe') THEN 'coupe'
  WHEN regexp_matches(t, 'suv|crossover') THEN CASE WHEN n >= 4700 THEN 'large SUV' ELSE 'crossover SUV' END
  WHEN regexp_matches(t, 'saloon|sedan') THEN CASE WHEN n >= 4700 THEN 'executive saloon' ELSE 'small saloon' END
  WHEN contains(t, 'hatch') THEN CASE WHEN n < 4300 THEN 'small hatchback' ELSE 'medium hatchback' END
  END"""

USE_CASE = """CASE
  WHEN regexp_matches(t, 'suv|crossover|estate|wagon') THEN 'family trips and everyday versatility'
  WHEN regexp_matches(t, 'saloon|sedan') THEN 'comfortable commuting and long-distance cruising'
  WHEN contains(t, 'mpv') THEN 'family hauling and practicality'
  WHEN contains(t, 'coupe') THEN 'weekend drives and style-focused buyers'
  WHEN contains(t, 'hatch') THEN 'city duties and easy daily use'
  ELSE 'general everyday driving' END"""
HIGHLIGHTS = """CASE
  WHEN regexp_matches(t, 'suv|crossover') THEN 'space and visibility, refined ride'
  WHEN regexp_matches(t, 'saloon|sedan') THEN 'comfort and refinement, premium feel'
  WHEN regexp_matches(t, 'estate|wagon') THEN 'big boot and practicality, long-trip comfort'
  WHEN contains(t, 'mpv') THEN 'clever interior, family-friendly usability'
  WHEN contains(t, 'coupe') THEN 'style and engagement'
  WHEN contains(t, 'hatch') THEN 'easy to park, efficient running'
  ELSE 'easy to live with' END"""

BUYER_FIT = f"""coalesce(nullif(array_to_string(list_filter([
  CASE WHEN regexp_matches(e, 'ev|electric|phev|plug') THEN 'eco-conscious commuters' END,
  CASE WHEN regexp_matches(e, 'diesel|tdi|dci|cdi')
    OR ({ECONOMY}) IN ('strong economy', 'good economy') THEN 'high-mileage professionals' END,
  CASE WHEN regexp_matches(t, 'estate|touring|suv|crossover') THEN 'practical families' END],
  lambda x: x IS NOT NULL)[1:2], ', '), ''), 'city and suburban commuters')"""

FUEL_RULE = """CASE WHEN regexp_matches(e, 'electric|ev') THEN 'electric'
  WHEN contains(e, 'hybrid') AND contains(e, 'plug') THEN 'plug in hybrid'
  WHEN contains(e, 'hybrid') THEN 'mild hybrid' WHEN contains(e, 'diesel') THEN 'diesel'
  ELSE 'petrol' END"""

SQL = {
    "boilerplate_flag": views("descriptions") + f"""
SELECT doc_id, {BOILER.replace('T', 'article_text')} AS is_boilerplate FROM descriptions""",
    "clear_boilerplate": views("descriptions") + f"""
, f AS (SELECT *, {BOILER.replace('T', 'article_text')} AS b FROM descriptions)
SELECT series_key, count(*) AS rows, count(*) FILTER (b) AS cleared_rows,
  cast(sum(CASE WHEN b THEN 0 ELSE len(article_text) END) AS bigint) AS chars_left
FROM f GROUP BY series_key""",
    "exclude_old": CARS + """
SELECT car_id, series_years FROM cars
WHERE series_years IS NULL OR NOT regexp_matches(series_years, '19[89][0-9]')""",
    "guide_filters": CARS + f"""
SELECT car_id, price_low, engine_type, body_type FROM cars
WHERE (({number('price_low')}) < 950 AND lower(engine_type) LIKE '%tdi%')
  OR ((zero_to_sixty LIKE '%7.5%' OR body_type LIKE '%SUV%') AND ({number('price_low')}) IS NOT NULL)""",
    "needs_fill": CARS + f"""
SELECT car_id, {missing('mpg_low')} AS mpg_low_missing,
  {missing('insurance_group')} AS insurance_group_missing,
  {missing('zero_to_sixty')} AS zero_to_sixty_missing,
  {missing('mpg_low')} OR {missing('insurance_group')} OR {missing('zero_to_sixty')} AS any_missing
FROM cars""",
    "nonempty_keys": CARS + f"""
SELECT car_id, fuel_type, year_end FROM cars
WHERE ({blank_null('fuel_type')}) IS NOT NULL AND NOT {gone('year_end')}""",
    "size_bucket": SIZED + f"""
SELECT car_id, {SIZE_BUCKET} AS size_bucket, {SIZE_DESCRIPTOR} AS size_descriptor,
  {COARSE_SIZE} AS coarse_size, {SIZE_CLASS} AS size_class
FROM b""",
    "metric_buckets": SIZED + f"""
SELECT car_id, {PERFORMANCE} AS performance, {ECONOMY} AS economy, {BOOT} AS boot FROM b""",
    "body_label": SIZED + f"SELECT car_id, {BODY_LABEL} AS label FROM b",
    "label_canonicalise": views("labels_text") + """
, a AS (SELECT car_id, replace(lower(trim(answer)), 'hatch back', 'hatchback') AS t FROM labels_text)
SELECT car_id, CASE
  WHEN t IN ('small hatchback', 'medium hatchback', 'estate', 'small saloon', 'executive saloon',
    'coupe', 'gran coupe', 'executive hatchback (gran coupe style)', 'convertible', 'pickup') THEN t
  WHEN contains(t, 'gran') AND contains(t, 'coupe') THEN 'gran coupe'
  WHEN contains(t, 'executive') AND regexp_matches(t, 'hatch|gran')
    THEN 'executive hatchback (gran coupe style)'
  WHEN regexp_matches(t, 'saloon|sedan')
    THEN CASE WHEN contains(t, 'executive') THEN 'executive saloon' ELSE 'small saloon' END
  WHEN regexp_matches(t, 'estate|touring') THEN 'estate' WHEN contains(t, 'mpv') THEN 'MPV'
  WHEN regexp_matches(t, 'convertible|cabrio|roadster') THEN 'convertible'
  WHEN contains(t, 'coupe') THEN 'coupe'
  WHEN regexp_matches(t, 'suv|crossover')
    THEN CASE WHEN contains(t, 'large') THEN 'large SUV' ELSE 'crossover SUV' END
  WHEN contains(t, 'hatch') THEN 'medium hatchback' END AS label
FROM a""",
    "variant_delta_sentence": SIZED + r"""
, l AS (
  SELECT car_id, list_filter([
    CASE WHEN regexp_matches(e, 'tdi|dci|cdi') OR f = 'diesel'
        THEN 'suited to long-distance efficiency and relaxed motorway cruising'
      WHEN regexp_matches(e, 'phev|plug-in') OR f IN ('phev', 'plug-in hybrid')
        THEN 'great for low running costs and tax, especially around town'
      WHEN contains(e, 'hybrid') OR f = 'hybrid' THEN 'quiet and frugal in stop-start driving'
      WHEN regexp_matches(e, 'ev|electric') OR f IN ('ev', 'electric')
        THEN 'very quiet with instant response; best if you can charge at home'
      WHEN regexp_matches(e, '\b(m|amg|rs|vrs|type\s*r|sti|gti|p\s*tuned)\b')
        THEN 'genuinely quick and more enthusiast-leaning'
      WHEN regexp_matches(e, '\b1\.[0234]\b|\b(110|120|125)\b')
        THEN 'nippy and economical for city-friendly use'
      WHEN regexp_matches(e, '\b(1\.[568]|2\.0)\b')
        THEN 'balanced for daily driving, mixing pace and efficiency'
      WHEN f = 'petrol' THEN 'responsive and easy-going for everyday use' END,
    CASE WHEN regexp_matches(g, 'dct|dsg|auto|tronic') THEN 'smoother shifting for hassle-free driving'
      WHEN contains(g, 'manual') THEN 'more engaging feel if you like to be involved' END,
    CASE WHEN regexp_matches(d, 'quattro|xdrive|4matic|awd|4wd') THEN 'added all-weather confidence' END],
    lambda x: x IS NOT NULL) AS s
  FROM b)
SELECT car_id, CASE len(s) WHEN 0 THEN 'A sensible choice for typical daily driving.'
  WHEN 1 THEN 'This variant is ' || s[1] || '.'
  ELSE 'This variant is ' || s[1] || ', with ' || array_to_string(s[2:], ', ') || '.' END AS sentence
FROM l""",
    "variant_delta_notes": SIZED + r"""
, q AS (
  SELECT *, regexp_matches(coalesce(engine_type, ''),
    '(?i)\b(m|amg|rs|vrs|sti|type[\s-]?r|gti|cupra|quadrifoglio|s/?|\br/?)(\b|[^a-z])') AS quick
  FROM b),
l AS (
  SELECT car_id, list_filter([
    CASE WHEN contains(f, 'diesel') OR regexp_matches(e, '\btdi|dci|cdi|hdi|cdti\b')
      THEN 'great for long motorway journeys with relaxed cruising and strong economy' END,
    CASE WHEN contains(f, 'hybrid') AND NOT contains(f, 'plug')
      THEN 'suited to mixed driving with lower running costs in town' END,
    CASE WHEN regexp_matches(f, 'plug|phev') THEN 'ideal for short commutes with low tax and the '
      || 'ability to drive on electric power in town' END,
    CASE WHEN regexp_matches(f, 'ev|electric')
      THEN 'very quiet and smooth with instant response; best if you can home-charge' END,
    CASE WHEN quick OR regexp_matches(e, '\b(3\.\d|4\.\d|v6|v8|v12)\b')
      THEN 'genuinely quick and aimed at enthusiasts' END,
    CASE WHEN NOT quick AND regexp_matches(e,
        '\b(0\.9|1\.0|1\.2|1\.3|1\.4)\b|(\b1[0-4]\d?\s?t)|\b(110|120)\s?ps\b')
      THEN 'nippy and efficient, easy to live with in the city' END,
    CASE WHEN NOT quick AND regexp_matches(e, '1\.5|1\.6|1\.8|2\.0') AND regexp_matches(e, 't|na')
      THEN 'a balanced choice mixing pace and efficiency for daily use' END,
    CASE WHEN regexp_matches(g, 'auto|dsg|dct|tronic')
      THEN 'smoother automatic gearbox for effortless driving' END,
    CASE WHEN contains(g, 'manual') THEN 'manual gearbox for a more engaging feel' END,
    CASE WHEN regexp_matches(d, 'awd|4matic|xdrive|quattro')
      THEN 'added confidence from all-wheel drive in poor weather' END],
    lambda x: x IS NOT NULL) AS s
  FROM q)
SELECT car_id, CASE WHEN len(s) = 0 THEN 'a straightforward, easygoing choice for everyday driving'
  ELSE array_to_string(s[1:2], ' ') END AS notes
FROM l""",
    "use_case_highlights": SIZED + f"""
SELECT car_id, {USE_CASE} AS use_case, {HIGHLIGHTS} AS highlights FROM b""",
    "buyer_fit": SIZED + f"SELECT car_id, {BUYER_FIT} AS buyer_fit FROM b",
    "fuel_type_rule": SIZED + f"""
SELECT car_id, {FUEL_RULE} AS by_rule, CASE
  WHEN contains(f, 'petrol') THEN 'petrol' WHEN contains(f, 'diesel') THEN 'diesel'
  WHEN contains(f, 'mild hybrid') THEN 'mild hybrid'
  WHEN contains(f, 'plug in hybrid') THEN 'plug in hybrid'
  WHEN contains(f, 'electric') THEN 'electric' ELSE {FUEL_RULE} END AS by_answer
FROM b""",
    "mileage_rule": CARS + """
SELECT car_id, CASE WHEN regexp_matches(lower(fuel_type), 'electric|hybrid') THEN '0–80k miles'
  WHEN regexp_matches(lower(make), 'toyota|lexus|honda') THEN '0–100k miles'
  WHEN regexp_matches(lower(make), 'bmw|audi|mercedes') THEN '40k–100k miles'
  WHEN contains(lower(fuel_type), 'diesel') THEN '40k–100k miles' ELSE '0–80k miles' END AS mileage
FROM cars""",
    "bodytype_keyword": SIZED + """
SELECT car_id, CASE
  WHEN contains(t, 'hatchback') THEN 'hatchback' WHEN contains(t, 'saloon') THEN 'saloon'
  WHEN contains(t, 'estate') THEN 'estate' WHEN contains(t, 'coupe') THEN 'coupe'
  WHEN contains(t, 'suv') THEN 'suv' WHEN contains(t, 'convertible') THEN 'convertible'
  WHEN contains(t, 'mpv') THEN 'mpv' ELSE nullif(t, '') END AS from_text,
  nullif(t, '') AS from_column
FROM b""",
    "essence_family": CARS + f"""
, k AS (SELECT *, {FAMILY} AS family FROM cars),
firsts AS (
  SELECT family, arg_min(trim(make), car_id) AS make, arg_min(model, car_id) AS model,
    arg_min(series_years, car_id) AS years, lower(coalesce(arg_min(body_type, car_id), '')) AS t,
    arg_min(body_type, car_id) AS body_type, {number('arg_min(length_mm, car_id)')} AS n
  FROM k GROUP BY family),
sized AS (SELECT *, {SIZE_BUCKET} AS size FROM firsts),
told AS (
  SELECT family, 'The ' || make || ' ' || model || ' (' || years || ') is a ' || size || '. It’s '
    || CASE WHEN contains(size, 'small hatchback') THEN 'ideal for city use and new drivers'
      WHEN regexp_matches(size, 'medium hatchback|estate|crossover')
        THEN 'great for families and daily commuting'
      WHEN regexp_matches(size, 'executive|saloon|gran coupe')
        THEN 'well-suited to professionals and long-distance commuters'
      WHEN contains(size, 'coupe') THEN 'best for those who value style and weekend enjoyment'
      ELSE 'a versatile choice for a wide range of drivers' END || '. Strengths include '
    || CASE size WHEN 'small hatchback' THEN 'easy to park, low running costs'
      WHEN 'medium hatchback' THEN 'good balance of space and efficiency'
      WHEN 'estate' THEN 'huge boot and family practicality'
      WHEN 'crossover SUV' THEN 'higher driving position and family-friendly usability'
      WHEN 'large SUV' THEN 'spacious interior and long-distance comfort'
      WHEN 'executive saloon' THEN 'refinement, comfort and a premium cabin'
      WHEN 'small saloon' THEN 'comfort and a more grown-up feel than a hatchback'
      WHEN 'gran coupe' THEN 'sleek looks with more practicality than a traditional coupe'
      WHEN 'coupe' THEN 'standout styling and an engaging drive'
      WHEN 'MPV' THEN 'ultimate people-moving practicality'
      ELSE 'a sensible mix of comfort, usability and value' END || ' and '
    || CASE lower(make) WHEN 'bmw' THEN 'driver-focused feel with premium refinement'
      WHEN 'audi' THEN 'tech-led interior and solid refinement'
      WHEN 'mercedes-benz' THEN 'comfort and luxury first'
      WHEN 'skoda' THEN 'space and value' WHEN 'toyota' THEN 'reliability and efficiency'
      ELSE 'a well-rounded package' END || '.' AS essence
  FROM sized)
SELECT car_id, family, essence FROM k JOIN told USING (family)""",
    "essence_family_v2": SIZED + f"""
, s AS (SELECT *, {COARSE_SIZE} AS size FROM b)
SELECT car_id, 'The ' || trim(make) || ' ' || model || ' (' || series_years || ') is '
  || CASE WHEN t = '' THEN 'a versatile option' WHEN size IS NULL THEN 'a ' || t
    ELSE 'a ' || size || ' ' || t END
  || '. It suits ' || {USE_CASE} || ', with emphasis on ' || {HIGHLIGHTS}
  || '. Stands out as easy to live with and broadly appealing.' AS essence
FROM s""",
    "essence_main": SIZED + rf"""
, y AS (
  SELECT *, regexp_extract_all(series_years, '((?:19|20)\d\d)', 1) AS ys,
    list_filter([
      CASE WHEN regexp_matches(e, 'phev|plug-in')
          THEN 'quiet, tax-friendly running in town on electric power'
        WHEN contains(e, 'hybrid') THEN 'quiet, efficient progress in stop-start driving'
        WHEN regexp_matches(e, 'ev|electric') THEN 'silent, instant response, best with home charging'
        WHEN regexp_matches(e, 'diesel|tdi|dci|cdi')
          THEN 'relaxed long‑distance cruising with strong economy'
        WHEN regexp_matches(e, '\b1\.[0234]\b')
          THEN 'nippy, efficient feel that suits urban and suburban use'
        WHEN regexp_matches(e, '\b(1\.[568]|2\.0)\b')
          THEN 'balanced everyday pace with sensible running costs' END,
      CASE WHEN regexp_matches(g, 'auto|dsg|dct|tronic')
          THEN 'an effortless automatic to keep things smooth'
        WHEN contains(g, 'manual') THEN 'a more engaging manual shift' END,
      CASE WHEN sprint < 3.5 THEN 'ferociously quick with explosive acceleration'
        WHEN sprint < 5 THEN 'genuinely rapid when you want to push on'
        WHEN sprint < 7 THEN 'brisk everyday pace'
        WHEN sprint < 10 THEN 'relaxed rather than outright quick'
        WHEN sprint >= 10 THEN 'focused more on economy than speed' END],
      lambda x: x IS NOT NULL) AS phrases,
    concat_ws(', ', nullif({BOOT}, ''), cast(seats_n AS bigint) || ' seats') AS room
  FROM b)
SELECT car_id, concat_ws(' ',
  'The ' || trim(make) || ' ' || model || ' (' || CASE len(ys) WHEN 2 THEN ys[1] || '–' || ys[2]
    WHEN 1 THEN ys[1] || '–present' ELSE series_years END || ') is a ' || {SIZE_DESCRIPTOR} || '.',
  'It delivers ' || nullif(array_to_string(phrases, ', '), '') || '.',
  'The boot and seating offer ' || nullif(room, '') || '.',
  'Key highlights: ' || nullif({ECONOMY}, '') || '.',
  'Best suited for: ' || {BUYER_FIT} || '.') AS essence_main
FROM y""",
    "essence_from_fields": views("cars", "descriptions") + f"""
, b AS (
  SELECT c.*, lower(body_type) AS t, {number('length_mm')} AS n,
    {squeeze('d.article_text')} AS pros
  FROM cars c LEFT JOIN descriptions d ON c.car_id = d.doc_id),
s AS (SELECT *, {SIZE_CLASS} AS size FROM b),
w AS (
  SELECT car_id, concat_ws(' ',
    'The ' || trim(make) || ' ' || model || ' (' || series_years || ') is ' || CASE
      WHEN t IS NULL THEN 'a capable option' WHEN size IS NULL THEN 'a ' || t
      ELSE 'a ' || size || ' ' || t END || '.',
    coalesce('Strengths include ' || nullif(pros, '') || '.',
      'It offers a range of engines with balanced performance and refinement.'),
    coalesce('Trade-offs: ' || drivetrain || '.',
      'Inside, it focuses on comfort and useful tech, with everyday practicality.'),
    'It features ' || concat_ws(', ', engine_type, power_bhp || 'hp', seats || ' seats',
      boot_l || 'L boot') || '.',
    'Best for buyers who want a sensible mix of usability and value.') AS t
  FROM s),
x AS (SELECT car_id, t, string_split({squeeze('t')}, ' ') AS words FROM w)
SELECT car_id, CASE WHEN len(words) > 160 THEN array_to_string(words[1:160], ' ') ELSE t END AS essence
FROM x""",
}

