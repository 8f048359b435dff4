"""Oracles for fields from texts and pages."""

from oracles.common import squeeze, views


def group(x: str, pattern: str, n: int = 1) -> str:
    return f"nullif(regexp_extract({x}, '{pattern}', {n}), '')"


def plain(x: str, pattern: str, n: int = 1) -> str:
    return f"replace({group(x, pattern, n)}, ',', '')"


G = "glance_text"
NEW, USED, TAX = "Price new", "Used prices", "Road tax cost"
RANGE = "Fuel economy ([^R]+) Range ([0-9,]+) - ([0-9,]+) miles"


def pounds(label: str) -> str:
    return f"{label} £([0-9,]+) - £([0-9,]+)"


def said(x: str) -> str:
    """Cleaned text unless it is blank or '&'; a copyright tail is cut."""
    clean = rf"trim(regexp_replace({squeeze(x)}, '(?s)© \d{{4}}-\d{{4}}.*$', ''))"
    return f"nullif(nullif({clean}, ''), '&')"


def page_said(pattern: str) -> str:
    text = said(f"regexp_extract(page, '{pattern}', 1)")
    return f"CASE WHEN len({text}) > 5 AND len({text}) < 1000 THEN {text} END"


PROS = [("pros?", "cons?"), ("advantages?", "disadvantages?"), ("good points?", "bad points?"),
        ("strengths?", "weaknesses?"), ("benefits?", "drawbacks")]
CONS = [("cons?", "pros?"), ("disadvantages?", "advantages?"), ("bad points?", "good points?"),
        ("weaknesses?", "strengths?"), ("drawbacks?", "benefits")]


def synonyms(pairs) -> str:
    return ", ".join(
        page_said(rf"(?is){own}[:\s]+(.*?)(?:{other}|verdict|overview|$)") for own, other in pairs
    )


RATED = r"([A-Za-z0-9][A-Za-z0-9\-&'' ]+)\s*:\s*([\d.]+)/5"

def tail_context(source: str, match: str) -> str:
    """What follows the next colon within 120 characters behind a match, up to a bar; '' for an address."""
    tail = f"substr({source}, strpos({source}, {match}) + len({match}), 120)"
    context = rf"trim(regexp_extract({tail}, '\)?:\s*([^|]+)', 1))"
    return f"CASE WHEN starts_with({context}, '//') THEN '' ELSE {context} END"


PAGES = views("review_pages") + r"""
, c1 AS (SELECT page_id, regexp_replace(html, '(?s)<!--.*?-->', '', 'g') AS h FROM review_pages),
c2 AS (SELECT page_id, regexp_replace(h, '(?is)<script\b[^>]*>.*?</script>', '', 'g') AS h FROM c1),
c3 AS (SELECT page_id, regexp_replace(h, '(?is)<style\b[^>]*>.*?</style>', '', 'g') AS h FROM c2),
art AS (
  -- some pages have a second article with one inside it
  SELECT page_id, regexp_extract(h, '(?s)<article>(.*?)</article>', 1) AS first_article,
    first_article || CASE WHEN contains(h, 'Second opinion') THEN
      '<p>' || regexp_extract(h, '(?s)<article>(<p>Second opinion.*?</article>.*?)</article>', 1) ELSE '' END AS a
  FROM c3) """


def to_lines(x: str) -> str:
    """List of the text lines of a fragment."""
    flat = f"regexp_replace({x}, '[ \\t\\r\\n\\f]+', ' ', 'g')"
    flat = f"replace({flat}, '<li>', chr(10) || '- ')"
    flat = f"regexp_replace({flat}, '</?(p|div|ul|ol|h[1-6])\\b[^>]*>|</li>|<br>|</title>', chr(10), 'g')"
    flat = f"regexp_replace({flat}, '<[^>]*>', '', 'g')"
    for mark, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&middot;", "·"),
                       ("&copy;", "©"), ("&amp;", "&")):
        flat = f"replace({flat}, '{mark}', '{char}')"
    flat = f"regexp_replace({flat}, ' +', ' ', 'g')"
    return (
        f"list_filter(list_transform(string_split({flat}, chr(10)), lambda x: trim(x)), "
        "lambda x: x <> '' AND x <> '-')"
    )


RIVAL_CARDS = r"""array_to_string(list_transform(
      regexp_extract_all(first_article, '<a class="rival-review-card[^"]*"[^>]*>(.*?)</a>', 1),
      lambda x: regexp_replace(x, '<[^>]*>', '', 'g')), ' | ')"""

SQL = {
    "glance_fields": views("glance") + f"""
SELECT car_id, {plain(G, pounds(NEW))} AS new_price_min, {plain(G, pounds(NEW), 2)} AS new_price_max,
  {plain(G, pounds(USED))} AS used_price_min, {plain(G, pounds(USED), 2)} AS used_price_max,
  {plain(G, pounds(TAX))} AS road_tax_min, {plain(G, pounds(TAX), 2)} AS road_tax_max,
  {group(G, 'Insurance group ([0-9-]+)')} AS insurance_group,
  trim({group(G, RANGE)}) AS fuel_economy, {plain(G, RANGE, 2)} AS range_min,
  {plain(G, RANGE, 3)} AS range_max, {group(G, 'Number of doors ([0-9]+)')} AS doors,
  trim({group(G, 'Available fuel types ([^V]+)')}) AS fuel_types
FROM glance""",
    "pros_cons": views("review_text") + rf"""
, p AS (
  SELECT r.doc_id, pros_cons_text AS own, d.text AS page,
    CASE WHEN d.doc_id % 8 = 3 THEN source END AS side
  FROM review_text r JOIN documents d ON r.doc_id = d.doc_id)
SELECT doc_id,
  coalesce({said(r"regexp_extract(own, '(?is)PROS\s*(.*?)(?:CONS|$)', 1)")}, {said('side')},
    {synonyms(PROS)}) AS pros,
  coalesce({said(r"regexp_extract(own, '(?is)CONS\s*(.*?)(?:PROS|$)', 1)")}, {synonyms(CONS)}) AS cons
FROM p""",
    "author_date": views("review_text") + f"""
SELECT doc_id, trim(coalesce({group('author_text', 'Written by ([^P]+) Published: ([^W]+)')},
    {group('author_text', 'Written by ([^,]+)')})) AS author,
  trim({group('author_text', 'Written by ([^P]+) Published: ([^W]+)', 2)}) AS publish_date
FROM review_text""",
    "rival_ratings": views("scored_texts") + r"""
, s AS (
  SELECT doc_id, rivals_section, page_html,
    regexp_extract_all(coalesce(scored_text, ''), '([A-Za-z\s]+)\s+([\d.]+)\s+out of\s+5', 1) AS n,
    regexp_extract_all(coalesce(scored_text, ''), '([A-Za-z\s]+)\s+([\d.]+)\s+out of\s+5', 2) AS r,
    regexp_extract_all(page_html, '<a[^>]*href="([^"]*)"[^>]*>([^<]+)</a>', 1) AS u,
    regexp_extract_all(page_html, '<a[^>]*href="([^"]*)"[^>]*>([^<]+)</a>', 2) AS t
  FROM scored_texts),
j AS (
  SELECT *, nullif(array_to_string(list_transform(n, lambda x, i: trim(x) || ': ' || r[i] || '/5'),
      ' | '), '') AS scored,
    nullif(array_to_string(list_filter(list_transform(t, lambda x, i: CASE
      WHEN regexp_matches(lower(u[i]), 'rival|competitor') THEN trim(x) || ': ' || u[i] END),
      lambda x: x IS NOT NULL), ' | '), '') AS linked
  FROM s)
SELECT doc_id, coalesce(nullif(rivals_section, ''), linked, scored) AS rivals, scored FROM j""",
    "parse_rivals": views("rivals") + f"""
, f AS (
  SELECT car_id, rivals_text, regexp_extract_all(rivals_text, '{RATED}', 1) AS n,
    regexp_extract_all(rivals_text, '{RATED}', 2) AS r, regexp_extract_all(rivals_text, '{RATED}', 0) AS m
  FROM rivals),
t AS (
  SELECT car_id, rivals_text, unnest(range(1, len(n) + 1)) AS i, unnest(n) AS name, unnest(r) AS rating,
    unnest(m) AS match FROM f),
u AS (
  SELECT *, row_number() OVER (PARTITION BY car_id, lower(trim(name)) ORDER BY i) AS again,
    {tail_context('rivals_text', 'match')} AS context
  FROM t),
k AS (
  SELECT *, row_number() OVER (PARTITION BY car_id ORDER BY i) - 1 AS p FROM u WHERE again = 1)
SELECT car_id, cast(p AS int) AS place, trim(name) AS name, rating || '/5' AS rating, context
FROM k WHERE p < 5""",
    "rival_columns": views("rivals") + f"""
, f AS (
  SELECT car_id, rivals_text, regexp_extract_all(rivals_text, '{RATED}', 1) AS n,
    regexp_extract_all(rivals_text, '{RATED}', 2) AS r, regexp_extract_all(rivals_text, '{RATED}', 0) AS m
  FROM rivals)
SELECT car_id, {', '.join(f"""coalesce(trim(n[{i}]), '') AS rival_{i}_name, coalesce(r[{i}] || '/5', '') AS rival_{i}_rating,
  CASE WHEN n[{i}] IS NULL THEN '' ELSE coalesce(nullif({tail_context('rivals_text', f'm[{i}]')}, ''),
    'similar size and price') END AS rival_{i}_context""" for i in (1, 2, 3))}
FROM f""",
    "text_specs": views("prose") + r"""
, a AS (SELECT doc_id, lower(article_text) AS t FROM prose)
SELECT doc_id, CASE WHEN contains(t, 'diesel') THEN 'diesel' WHEN contains(t, 'petrol') THEN 'petrol'
    WHEN contains(t, 'hybrid') THEN 'hybrid' WHEN contains(t, 'phev') THEN 'phev'
    WHEN contains(t, 'electric') THEN 'electric' END AS fuel,
  nullif(regexp_extract(t, '(\d{2,4})\s*(?:bhp|hp)', 1), '') AS hp,
  nullif(regexp_extract(t, '0\s*[–-]\s*62\s*mph[^\d]*(\d{1,2}(?:\.\d)?)s', 1), '') AS sprint,
  CASE WHEN contains(t, 'rwd') THEN 'RWD' WHEN contains(t, 'fwd') THEN 'FWD'
    WHEN contains(t, 'awd') THEN 'AWD' WHEN contains(t, '4wd') THEN '4WD' END AS drive,
  CASE WHEN contains(t, 'manual') THEN 'manual' WHEN contains(t, 'auto') THEN 'auto' END AS gearbox,
  nullif(regexp_extract(t, '(\d{2,3})\s*mpg', 1), '') AS mpg
FROM a""",
    "page_sections": PAGES + f"""
, parts AS (SELECT page_id, a, string_split(a, '<h2>')[2:] AS p FROM art),
named AS (
  SELECT page_id, 'full_text' AS heading, a AS body, 0 AS k FROM parts
  UNION ALL
  SELECT page_id, split_part(unnest(p), '</h2>', 1), split_part(unnest(p), '</h2>', 2),
    unnest(range(1, len(p) + 1))
  FROM parts),
told AS (
  SELECT page_id, k, array_to_string({to_lines('heading')}, ' ') AS heading,
    array_to_string({to_lines('body')}, chr(10)) AS text
  FROM named)
SELECT page_id, cast(row_number() OVER (PARTITION BY page_id ORDER BY k) - 1 AS int) AS section_no,
  heading, text
FROM told WHERE k = 0 OR (heading <> '' AND text <> '')""",
    "page_markdown": PAGES + f"""
, m AS (
  SELECT page_id, replace(CASE WHEN contains(a, '</h1>')
    THEN substr(a, strpos(a, '</h1>') + 5) ELSE a END, '<h2>', '<p>## ') AS b
  FROM art)
SELECT page_id, array_to_string({to_lines('b')}, chr(10) || chr(10)) AS markdown FROM m""",
    "page_fields": PAGES + f"""
, e AS (
  SELECT c3.page_id, regexp_extract(h, '(?s)<h1>(.*?)</h1>', 1) AS h1,
    regexp_extract(h, '(?s)<title>(.*?)</title>', 1) AS title, replace(first_article, '<li>', '<p>') AS a,
    regexp_extract(h, '(?s)<div class="wide glance box">(.*?</div>.*?</div></div>.*?)</div>', 1) AS glance,
    regexp_extract(h, '(?s)<ul class="pros">(.*?)</ul>', 1) AS pros,
    regexp_extract(h, '(?s)<ul class="cons">(.*?)</ul>', 1) AS cons,
    regexp_extract(h, '(?s)<div class="ad">(.*?)</div>', 1) AS ad,
    {RIVAL_CARDS} AS rivals
  FROM c3 JOIN art ON c3.page_id = art.page_id),
f AS (
  SELECT page_id, unnest(['title', 'article', 'glance', 'pros', 'cons', 'note', 'rivals']) AS field,
    unnest([array_to_string({to_lines("coalesce(nullif(h1, ''), title)")}, ' '),
      array_to_string({to_lines('a')}, ' '), array_to_string({to_lines('glance')}, ' '),
      regexp_replace(array_to_string({to_lines('pros')}, ' | '), '(^|[|] )- ', '\\1', 'g'),
      regexp_replace(array_to_string({to_lines('cons')}, ' | '), '(^|[|] )- ', '\\1', 'g'),
      array_to_string({to_lines('ad')}, ' '), rivals]) AS value
  FROM e)
SELECT page_id, field, value FROM f
WHERE value <> '' AND (field NOT IN ('pros', 'cons') OR len(value) > 5)""",
    "html_prices": views("price_pages") + r"""
, m AS (
  SELECT car_id, html, list_concat(
    regexp_extract_all(html, '<div class="vehicle-price"><div>Now</div>.*</div></div></div>'),
    regexp_extract_all(html, '<div class="vehicle-price">£[^<]*</div>'),
    regexp_extract_all(html, '<span class="vehicle-price">.*?</span>'),
    regexp_extract_all(html, '<span data-testid="advert-price">.*?</span>')) AS marked
  FROM price_pages),
o AS (
  -- adverts come before the price class; an element inside another follows it
  SELECT car_id, CASE WHEN contains(html, '<div>Now</div>') THEN marked WHEN len(marked) > 0
    THEN list_concat(marked[3:], marked[1:2])
    ELSE list_filter(regexp_split_to_array(html, '<[^>]+>'), lambda x: contains(x, '£')) END AS c
  FROM m),
p AS (
  SELECT car_id, list_filter(list_transform(c, lambda x: try_cast(replace(
    regexp_extract(x, '£\s*([0-9,]+)', 1), ',', '') AS double)), lambda x: x IS NOT NULL) AS v
  FROM o),
r AS (SELECT car_id, unnest(range(len(v))) AS i, unnest(v) AS price FROM p),
d AS (SELECT car_id, price, min(i) AS i FROM r GROUP BY car_id, price)
SELECT car_id, cast(row_number() OVER (PARTITION BY car_id ORDER BY i) - 1 AS int) AS place, price
FROM d""",
    "answer_json": views("answers") + r"""
, j AS (SELECT event_id, try_cast(nullif(regexp_extract(answer, '(?s)\{.*\}'), '') AS json) AS j
  FROM answers)
SELECT event_id, j IS NOT NULL AS parsed, cast(j ->> 'min_used_price_gbp' AS double) AS low,
  cast(j ->> 'max_used_price_gbp' AS double) AS high, j ->> 'confidence' AS confidence
FROM j""",
}
