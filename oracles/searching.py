"""Oracles for vector functions and similarity search."""

from oracles.combining import similarity
from oracles.common import views

SCORED = f"""
WITH r AS (
  SELECT vec_id, label, embedding AS m, list_reverse(embedding) AS v FROM embeddings),
q AS (
  SELECT (SELECT m FROM r WHERE vec_id = 1) AS q1, (SELECT v FROM r WHERE vec_id = 2) AS q2),
s AS (
  SELECT vec_id, label,
    round(0.75 * {similarity('m', 'q1')} + 0.25 * {similarity('v', 'q2')}, 9) AS score,
    {similarity('v', 'q1')} AS second
  FROM r, q) """

SQL = {
    "l2_normalize": """
WITH s AS (
  SELECT vec_id, list_transform(embedding, lambda x: cast(x AS double) * label) AS v
  FROM embeddings),
n AS (SELECT vec_id, v, sqrt(list_inner_product(v, v)) AS n FROM s)
SELECT vec_id, cast(unnest(range(len(v))) AS int) AS place,
  round(unnest(CASE WHEN n = 0 THEN v ELSE list_transform(v, lambda x: x / n) END), 6) AS x
FROM n""",
    "cosine_distance": """
WITH s AS (
  SELECT vec_id, label, embedding::double[] AS a, list_reverse(embedding)::double[] AS b
  FROM embeddings)
SELECT vec_id, CASE WHEN label <> 0 THEN round(1 - list_cosine_similarity(a, b), 6) END AS distance
FROM s""",
    "parse_vector": """
SELECT vec_id, cast(CASE vec_id % 7 WHEN 0 THEN NULL WHEN 1 THEN 2 WHEN 2 THEN 0
    ELSE len(embedding) END AS varchar) AS dimension,
  round(CASE vec_id % 7 WHEN 0 THEN NULL WHEN 1 THEN 2.0 WHEN 2 THEN 0.0
    ELSE list_sum(embedding::double[]) END, 5) AS total
FROM embeddings""",
    "cosine_topk": f"""
SELECT vec_id, label, round(1 - s, 6) AS distance FROM (
  SELECT vec_id, label, {similarity('embedding',
                                    '(SELECT embedding FROM embeddings WHERE vec_id = 0)')} AS s
  FROM embeddings)
ORDER BY s DESC, vec_id LIMIT 10""",
    "weighted_topk": SCORED + """
SELECT vec_id, label, round(score, 6) AS score FROM s ORDER BY s.score DESC, vec_id LIMIT 200""",
    "two_stage_search": SCORED + """
, top AS (SELECT label FROM s ORDER BY score DESC, vec_id LIMIT 150)
SELECT vec_id, label, round(second, 6) AS score FROM s
WHERE label IN (SELECT label FROM top) AND label <> 5
ORDER BY second DESC, vec_id LIMIT 50""",
    "sample_rows": views("cars") + """
SELECT car_id, make, series_years FROM cars
WHERE series_years IS NULL OR NOT regexp_matches(series_years, '19[89][0-9]')
ORDER BY md5('draw:' || car_id), car_id LIMIT 50""",
    "approx_topk": """
WITH u AS (SELECT vec_id, embedding::double[] AS v FROM embeddings),
c AS (
  SELECT row_number() OVER (ORDER BY md5('lists:' || vec_id), vec_id) AS l, v AS center FROM u
  ORDER BY 1 LIMIT 32),
a AS (
  SELECT vec_id, v, l, row_number() OVER (
    PARTITION BY vec_id ORDER BY list_cosine_similarity(v, center) DESC, l) AS p
  FROM u, c),
pairs AS (
  SELECT q.vec_id AS query_id, r.vec_id AS id, round(list_cosine_similarity(q.v, r.v), 9) AS s
  FROM a q JOIN a r ON q.l = r.l AND q.p <= 8 AND r.p = 1 AND q.vec_id <> r.vec_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, id) AS place FROM pairs)
SELECT query_id, id, round(s, 6) AS similarity FROM ranked WHERE place <= 5""",
}
