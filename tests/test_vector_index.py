"""The written vector index against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from catalith.operators import vector_index
from catalith.session import shared_folder

SF = "/root/testdata/sf0.1"


def frame(spark, data, first=0):
    rows = [(first + i, x.astype(np.float32).tolist()) for i, x in enumerate(data)]
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(6)


def clustered(n, groups, seed=0, size=24):
    draw = np.random.default_rng(seed)
    return draw.standard_normal((groups, size))[draw.integers(0, groups, n)] + 0.25 * draw.standard_normal((n, size))


def brute(data, asked, k):
    m = vector_index.unit(data.astype(np.float32).astype(np.float64))
    sims = np.round(m[asked] @ m.T, 9)
    sims[np.arange(len(asked)), asked] = -9
    order = np.lexsort((np.broadcast_to(np.arange(len(m)), sims.shape), -sims), axis=1)[:, :k]
    return {int(q): [int(i) for i in row] for q, row in zip(asked, order)}


def answers(df):
    found = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], -r["similarity"], r["id"])):
        found.setdefault(r["query_id"], []).append(r["id"])
    return found


def recall(found, exact):
    return sum(len(set(found.get(q, [])) & set(x)) for q, x in exact.items()) / sum(map(len, exact.values()))


def built(spark, df, **how):
    path = shared_folder(spark, "test-index")
    vector_index.build_index(df, path, id_col="vec_id", vector="embedding", k=5, **how)
    return path


def ask(spark, path, queries, **how):
    return vector_index.search_index(
        spark, path, queries, 5, id_col="vec_id", vector="embedding", exclude_self=True, **how)


def test_comparisons_are_no_fixed_share(spark):
    """Four times the rows: recall holds, and each query meets a smaller share of them."""
    shares = []
    for n in (4000, 16000):
        data = clustered(n, n // 40)
        df = frame(spark, data)
        path = built(spark, df, rows_per_list=100)
        queries = df.where("vec_id % 50 = 0")
        assert recall(answers(ask(spark, path, queries)), brute(data, np.arange(0, n, 50), 5)) >= 0.9
        asked = vector_index.usable(queries, "vec_id", "embedding")[0]
        met = vector_index.probed_lists(spark, path, asked).join(
            spark.read.parquet(f"{path}/sizes"), ["cell", "list"]).agg(F.sum("n")).first()[0]
        shares.append(met / (n // 50) / n)
    assert shares[0] < 0.2 and shares[1] < 0.6 * shares[0]


def test_registered_settings(spark):
    """On the given vectors, which have hardly any neighbourhoods, the calibration opens as much as it must."""
    from catalith.plans import QUERIES
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    data = np.array([r["embedding"] for r in rows])
    found = answers(QUERIES["indexed_topk"](spark, SF))
    assert recall(found, brute(data, np.arange(0, len(data), 50), 5)) >= 0.9
    assert all(len(x) == 5 for x in found.values())


@pytest.mark.parametrize("slices", [(20000, 2000), (9, 4)])
def test_everything_opened_is_exact(spark, slices):
    data = clustered(600, 12, seed=3)
    data[200:420] = data[7]  # a third of the rows are copies of one
    df = frame(spark, data)
    path = built(spark, df, rows_per_list=40)
    found = answers(ask(
        spark, path, df.where("vec_id % 7 = 0"), open_cells=100, probes=1000, slice_rows=slices[0], slice_queries=slices[1]))
    assert found == brute(data, np.arange(0, 600, 7), 5)


def test_search_reads_only_opened_cells(spark):
    data = clustered(3000, 30, seed=4)
    df = frame(spark, data)
    path = built(spark, df, rows_per_list=60)
    assert vector_index.read_rows(spark, path).count() == 3000  # every row is indexed
    plan = ask(spark, path, df.where("vec_id = 50"))._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan


def test_odd_rows(spark):
    schema = "vec_id bigint, embedding array<float>"
    rows = [(1, [1.0, 0.0]), (2, [0.9, 0.1]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [1.0]), (7, [float("nan"), 1.0]), (8, [None, 1.0])]
    df = spark.createDataFrame(rows, schema)
    path = built(spark, df)
    assert answers(ask(spark, path, df)) == {1: [2], 2: [1]}
    empty = built(spark, df.where("false"))
    assert answers(ask(spark, empty, df.where("false"))) == {}
