"""Vector functions and search against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from catalith.functions import vectors
from catalith.operators import search

C = F.col
SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("given, expected", [
    ("[1, 2.5]", [1.0, 2.5]), ("1,2", [1.0, 2.0]), ("[]", []), ("[1,x]", None), (None, None),
    ("[1,null]", None), ("[NaN]", None), (" [ 3 ] ", [3.0]),
])
def test_parse(one, given, expected):
    assert one(vectors.parse(C("s")), s=given) == expected


def test_zero_vector(one):
    assert one(vectors.normalize(C("v")), v=[0.0, 0.0]) == [0.0, 0.0]
    assert one(vectors.cosine_distance(C("v"), C("v")), v=[0.0, 0.0]) is None
    assert one(vectors.normalize(C("v")), v=[3.0, 4.0]) == [0.6, 0.8]


@pytest.fixture(scope="module")
def table(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet")
    local = rows.orderBy("vec_id").collect()
    unit = np.array([r["embedding"] for r in local], dtype=np.float64)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    return rows, np.array([r["vec_id"] for r in local]), np.round(unit @ unit.T, search.DIGITS)


def neighbours(ids, sims, k):
    order = np.lexsort((np.broadcast_to(ids, sims.shape), -sims), axis=1)[:, :k]
    return {int(ids[i]): [int(ids[j]) for j in order[i]] for i in range(len(ids))}


def approx(rows, **how):
    out = search.approx_topk(
        rows, rows, id_col="vec_id", vector="embedding", k=5, **how).collect()
    found = {}
    for r in sorted(out, key=lambda r: (r["query_id"], -r["similarity"], r["id"])):
        found.setdefault(r["query_id"], []).append(r["id"])
    return found


@pytest.mark.parametrize("slices", [(20000, 2000), (7, 5)])
def test_all_lists_probed_is_exact(table, slices):
    """Also when lists are cut into many small blocks, as hot lists are."""
    rows, ids, sims = table
    got = approx(rows, lists=8, probes=8, slice_rows=slices[0], slice_queries=slices[1])
    assert got == neighbours(ids, sims, 5)


def test_recall(table):
    rows, ids, sims = table
    exact = neighbours(ids, sims, 5)
    got = approx(rows, lists=16, probes=8)
    hits = sum(len(set(got[i]) & set(exact[i])) for i in exact)
    assert hits / (5 * len(exact)) >= 0.7
    assert all(len(found) == 5 for found in got.values())


def test_identical_vectors_fill_one_list(spark):
    """All rows in one list: still answered in full, ties by id."""
    rows = spark.range(300).select(
        C("id").alias("vec_id"), F.array(F.lit(1.0), F.lit(2.0)).cast("array<float>")
        .alias("embedding"))
    got = approx(rows, lists=4, probes=1, slice_rows=20, slice_queries=50)
    assert len(got) == 300 and all(found == [0, 1, 2, 3, 4] for found in got.values())


@pytest.mark.parametrize("exclude", [False, True])
def test_copies_among_others_stay_exact(spark, table, exclude):
    """A third of the rows are copies of one vector; still the brute-force answer."""
    rows, ids, _ = table
    hot = rows.where("vec_id = 7").select("embedding").first()[0]
    mixed = rows.withColumn("embedding", F.when(
        C("vec_id") % 3 == 0, F.array(*[F.lit(x) for x in hot])).otherwise(
        C("embedding")).cast("array<float>"))
    unit = np.array([r["embedding"] for r in mixed.orderBy("vec_id").collect()], dtype=np.float64)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    sims = np.round(unit @ unit.T, search.DIGITS)
    if exclude:
        np.fill_diagonal(sims, -9)
    got = approx(mixed, lists=6, probes=6, slice_rows=50, slice_queries=30, exclude_self=exclude)
    assert got == neighbours(ids, sims, 5)


def test_exact_topk(table):
    rows, ids, sims = table
    asked = search.with_query(rows, rows, C("vec_id") == 3, "embedding")
    score = search.similarity(C("embedding"), C("query"))
    got = [r["vec_id"] for r in search.topk(asked, score, ["vec_id"], 7, "vec_id").collect()]
    assert got == neighbours(ids, sims, 7)[3]


@pytest.mark.parametrize("as_column", [False, True])
def test_odd_vectors_have_no_similarity(spark, as_column):
    rows = spark.createDataFrame(
        [(1, [3.0, 4.0]), (2, None), (3, [0.0, 0.0]), (4, [1.0]), (5, [4.0, 3.0]), (6, [])],
        "i bigint, v array<float>")
    if as_column:
        rows = search.with_query(rows, rows, C("i") == 1, "v")
    query = C("query") if as_column else [6.0, 8.0]
    got = rows.select("i", search.similarity(C("v"), query).alias("s")).collect()
    assert {r["i"]: r["s"] for r in got} == {1: 1.0, 2: None, 3: None, 4: None, 5: 0.96, 6: None}


def test_rerank_modes(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "i bigint, f string")
    top = rows.where("f = 'a'")
    assert search.rerank_join(rows, top, ["f"]).count() == 2
    assert search.rerank_join(rows, top, ["f"], dedupe=False).count() == 4


def test_similarity_of_mixed_sizes_does_not_depend_on_batches(spark):
    rows = [(0, [1.0, 0.0], [2.0, 0.0]), (1, [1.0, 0.0, 0.0], [0.0, 1.0, 0.0]), (2, [1.0], [1.0, 1.0]), (3, [0.0], [1.0])]
    df = spark.createDataFrame(rows, "id int, v array<double>, q array<double>")
    for parts in (1, 4):
        got = df.repartition(parts).select("id", search.similarity(F.col("v"), F.col("q")).alias("s")).collect()
        assert {r.id: r.s for r in got} == {0: 1.0, 1: 0.0, 2: None, 3: None}


def test_topk_computes_each_score_once(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0])], "id int, v array<double>")
    best = search.topk(df, search.similarity(F.col("v"), [1.0, 0.0]), ["id"], 5, "id")
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and [tuple(r) for r in best.collect()] == [(0, 1.0)]


def test_query_vector_names_a_missing_row(spark):
    df = spark.createDataFrame([(0, [1.0])], "id int, v array<double>")
    with pytest.raises(ValueError):
        search.query_vector(df, F.col("id") == 7, "v")
