"""Exact top-k search by inner product over sorted lists, without random access."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from catalith.session import settle

FOUND = "query_id bigint, query_key bigint, vec_id bigint, score bigint"
ARROW = pa.schema([(n, pa.int64()) for n in ("query_id", "query_key", "vec_id", "score")])
EXACT = {np.float32: 2.0**24, np.float64: 2.0**53}  # integer sums below are exact


def scaled(vector: Column, factor: int = 64) -> Column:
    """floor(factor * x) of each component; missing for a vector with a missing or non-finite one."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(~odd, F.transform(vector, lambda x: F.floor(x.cast("double") * factor).cast("bigint")))


def _matrix(table: pa.Table) -> np.ndarray:
    flat = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(table.num_rows, -1 if len(flat) else 0).astype(np.int64)


def block_topk(
    ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, vec_id, score) of the best ``k`` of one block for each query; own id excluded.

    Each component's values are one list, sorted once.  A query reads a list from its top where its
    own component is positive and from its bottom where it is negative, all lists to the same depth,
    which grows fourfold per round; equal values are read together.  What is unread counts at most as the
    value the list has been read to, and at least as its far end, which gives every row an upper and a
    lower bound.  A query stops once no more than a few times ``k`` rows have an upper bound that reaches
    the k-th best lower bound; their scores are then resolved.  A row tied with that bound is never an
    outsider, so ties are exact.
    """
    n, dims = vectors.shape
    own = query_ids[:, None] == ids[None, :]
    most = float(np.abs(vectors).max(initial=1)) * float(np.abs(queries).max(initial=1)) * max(dims, 1)
    kind = next((t for t, limit in EXACT.items() if most < limit), None)
    if kind is None or dims == 0:  # too large for bounds in floating point, or nothing to read
        return _best(np.arange(len(queries)), queries @ vectors.T, ~own, ids, k)
    v = vectors.astype(kind)
    lists = np.sort(v, axis=0)
    up, down = np.maximum(queries, 0).astype(kind), np.minimum(queries, 0).astype(kind)
    signs = np.hstack([up, down])
    waiting, depth, out = np.arange(len(queries)), max(4 * k, n // 8), []
    while len(waiting):
        if depth < n:
            high, low = lists[n - depth], lists[depth - 1]  # the values read to, from the top and from the bottom
            q = signs[waiting]
            upper = q @ np.hstack([np.maximum(v, high), np.minimum(v, low)]).T
            lower = q @ np.hstack([np.where(v >= high, v, lists[0]), np.where(v <= low, v, lists[-1])]).T
        else:
            upper = lower = queries[waiting].astype(kind) @ v.T
        mine = own[waiting]
        lower[mine] = -np.inf
        kth = max(n - k, 0)
        alive = (upper >= np.partition(lower, kth, axis=1)[:, kth, None]) & ~mine
        done = (np.count_nonzero(alive, axis=1) <= 8 * k) | (depth >= n)
        for row in np.flatnonzero(done):
            at = np.flatnonzero(alive[row])
            scores = vectors[at] @ queries[waiting[row]]
            pick = np.lexsort((ids[at], -scores))[:k]
            out.append((np.full(len(pick), waiting[row]), ids[at][pick], scores[pick]))
        waiting, depth = waiting[~done], 4 * depth
    if not out:
        return (np.empty(0, np.int64),) * 3
    return tuple(np.concatenate(part) for part in zip(*out))


def _best(rows, scores, allowed, ids, k):
    out = []
    for row in rows:
        at = np.flatnonzero(allowed[row])
        pick = at[np.lexsort((ids[at], -scores[row][at]))[:k]]
        out.append((np.full(len(pick), row), ids[pick], scores[row][pick]))
    return tuple(np.concatenate(part) for part in zip(*out)) if out else (np.empty(0, np.int64),) * 3


def _searcher(k: int, chunk: int):
    def search(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        if not candidates.num_rows or not queries.num_rows:
            return ARROW.empty_table()
        ids, vectors = candidates.column("vec_id").to_numpy(), _matrix(candidates)
        keys, asked = queries.column("query_key").to_numpy(), _matrix(queries)
        query_ids, parts = queries.column("vec_id").to_numpy(), []
        for at in range(0, len(query_ids), chunk):
            rows, found, scores = block_topk(ids, vectors, query_ids[at: at + chunk], asked[at: at + chunk], k)
            parts.append([query_ids[at + rows], keys[at + rows], found, scores])
        return pa.table([pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*parts)], schema=ARROW)

    return search


def exact_topk(
    vectors: DataFrame, queries: Column, k: int = 20, factor: int = 64, id_col: str = "vec_id",
    vector_col: str = "embedding", block_rows: int = 8192, block_queries: int = 4096,
) -> DataFrame:
    """The ``k`` rows of highest integer inner product for each row that ``queries`` selects.

    Gives query_id, rank (from 1), vec_id, score; all rows, if there are fewer than ``k``; ties go to
    the smaller vec_id.  Rows are dealt by hash into blocks of about ``block_rows``, queries of about
    ``block_queries``, and each pair of blocks is searched in one task (``block_topk``); only the
    best ``k`` of a block go on.  Copies of one vector spread over all blocks.

    A query's own id is never among its results, and a row's partners have as many components as it
    has.  Vectors that are missing or hold a missing or non-finite component, and rows without an id,
    take no part.  Repeated query rows are asked once; other repeated rows are rows of their own.  An
    empty table gives no rows.  Scores are exact while they fit a long.
    """
    rows = settle(
        vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), scaled(F.col(vector_col), factor).alias("v"))
        .where("vec_id IS NOT NULL AND v IS NOT NULL").withColumn("dims", F.size("v")), "scaled-vectors")
    asked = rows.where(queries).distinct().withColumn("query_key", F.xxhash64("v"))
    n_blocks = max(1, -(-rows.count() // block_rows))
    q_blocks = max(1, -(-asked.count() // block_queries))
    placed = F.xxhash64("vec_id", "v", F.lit(1))
    candidates = rows.withColumn("block", F.pmod(placed, F.lit(n_blocks).cast('bigint'))).withColumn(
        "q_block", F.expr(f"explode(sequence(0L, {q_blocks - 1}L))"))
    sent = asked.withColumn("q_block", F.pmod(placed, F.lit(q_blocks).cast('bigint'))).withColumn(
        "block", F.expr(f"explode(sequence(0L, {n_blocks - 1}L))"))
    keys = ["dims", "block", "q_block"]
    found = candidates.groupBy(*keys).cogroup(sent.groupBy(*keys)).applyInArrow(_searcher(k, 256), FOUND)
    order = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score"))


def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best rows for each vector whose id is divisible by 20."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return exact_topk(vectors, F.col("vec_id") % 20 == 0)


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)
)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank,
  vec_id, score
FROM s QUALIFY rank <= 20
"""
