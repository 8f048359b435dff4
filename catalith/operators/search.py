"""Exact and approximate cosine search, two-stage re-rank, sampling, row windows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import blake2b
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalith import values
from catalith.operators.lookup import join_lookup
from catalith.session import settle

DIGITS = 9  # similarities are compared after rounding, so ties fall to the id


def _matrix_of(v: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The vectors of the wanted size as a matrix, and which rows they are."""
    fits = pc.fill_null(pc.equal(pc.list_value_length(v), size), False)
    flat = v.filter(fits).flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(-1, size).astype(np.float64), fits.to_numpy(zero_copy_only=False)


def _scores(rows: np.ndarray, dots: np.ndarray, length: np.ndarray) -> pa.Array:
    """Rounded cosines placed on their rows, the others NULL."""
    out = np.full(len(rows), np.nan)
    out[rows] = np.round(np.divide(dots, length, out=np.full(len(dots), np.nan), where=length > 0),
                         DIGITS)
    return pa.array(out, from_pandas=True)


def similarity(vector: Column, query: Sequence[float] | Column) -> Column:
    """Cosine with one query vector, or with a query column.

    NULL for zero vectors and vectors of another size.  One matrix product per
    Arrow batch; Spark's array functions box every element and take four times
    as long on 512 dimensions.
    """
    if isinstance(query, Column):
        @F.arrow_udf("double")
        def pairwise(v: pa.Array, q: pa.Array) -> pa.Array:
            sizes = pc.list_value_length(q).to_numpy(zero_copy_only=False)
            out = np.full(len(q), np.nan)
            for size in np.unique(sizes[sizes > 0]):  # each size by itself: a batch may hold several
                m, rows = _matrix_of(v, int(size))
                other, asked = _matrix_of(q, int(size))
                m, other = m[asked[rows]], other[rows[asked]]
                length = np.linalg.norm(m, axis=1) * np.linalg.norm(other, axis=1)
                scores = _scores(rows & asked, np.einsum("ij,ij->i", m, other), length)
                out = np.where(rows & asked, scores.to_numpy(zero_copy_only=False).astype(float), out)
            return pa.array(out, from_pandas=True)

        return pairwise(vector, query)

    unit = np.asarray(query, dtype=np.float64)
    unit = unit / (np.linalg.norm(unit) or 1.0)

    @F.arrow_udf("double")
    def against(v: pa.Array) -> pa.Array:
        m, rows = _matrix_of(v, len(unit))
        return _scores(rows, m @ unit, np.linalg.norm(m, axis=1))

    return against(vector)


def query_vector(df: DataFrame, cond: Column, vector: str) -> list[float]:
    """The vector of the one row that meets the condition."""
    row = df.where(cond).select(vector).first()
    if row is None:
        raise ValueError(f"no row meets the condition {cond}")
    return row[0]


def with_query(df: DataFrame, source: DataFrame, cond: Column, vector: str,
               name: str = "query") -> DataFrame:
    """Add the vector of the one source row as a column (a scalar subquery)."""
    return df.withColumn(name, source.where(cond).select(vector).scalar())


def topk(df: DataFrame, score: Column, keep: Sequence[str], k: int, tie: str,
         name: str = "score") -> DataFrame:
    """The k best rows by score, ties by ``tie``; rows without a score are left out.

    They come last in the order and go after the limit, as a filter below it would
    compute every score a second time.
    """
    best = df.select(*keep, score.alias(name)).orderBy(F.desc_nulls_last(name), tie).limit(k)
    return best.where(F.col(name).isNotNull())


def weighted_score(pairs: Sequence[tuple[float, Column, Sequence[float]]]) -> Column:
    """Sum of weight * similarity over (weight, vector, query)."""
    total = F.lit(0.0)
    for weight, vector, query in pairs:
        total = total + F.lit(weight) * similarity(vector, query)
    return F.round(total, DIGITS)


def rerank_join(df: DataFrame, top: DataFrame, keys: Sequence[str], dedupe: bool = True) -> DataFrame:
    """All rows of the families in ``top``.

    ``dedupe=False`` repeats a row once per hit of its family.
    """
    side = top.select(*keys)
    return df.join(side, list(keys), "left_semi" if dedupe else "inner")


def two_stage(
    df: DataFrame, first_score: Column, second_score: Column, family: Sequence[str], tie: str,
    keep: Sequence[str], first: int = values.FIRST_STAGE, second: int = values.SECOND_STAGE,
    dedupe: bool = True, where: Column | None = None,
) -> DataFrame:
    """Best families by the first score, then their rows by the second."""
    top = topk(df, first_score, list(dict.fromkeys([*family, tie])), first, tie, "_first")
    pool = rerank_join(df, top, family, dedupe)
    if where is not None:
        pool = pool.where(where)
    return topk(pool, second_score, keep, second, tie)


# approximate search --------------------------------------------------------

def centers(df: DataFrame, id_col: str, vector: str, count: int, seed: str = "lists") -> np.ndarray:
    """At most ``count`` unit vectors as list centers, drawn by hash of the id.

    Their number is the caller's bound, so they may come to the driver.
    """
    drawn = sample_rows(df.select(id_col, vector), id_col, count, seed).collect()
    out = np.array([r[vector] for r in drawn], dtype=np.float64)
    return _unit(out)


def _unit(m: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, length, out=np.zeros_like(m), where=length > 0)


def _matrix(column: pd.Series) -> np.ndarray:
    return _unit(np.stack(column.to_numpy()).astype(np.float64))


def assign_lists(df: DataFrame, id_col: str, vector: str, center: np.ndarray, probes: int,
                 id_type: str = "bigint") -> DataFrame:
    """(id, vector, copy, list): every vector with its nearest ``probes`` lists.

    ``copy`` is a digest that equal vectors share.
    """
    probes = min(probes, len(center))

    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf) == 0:
                continue
            near = np.argsort(-(_matrix(pdf["vector"]) @ center.T), axis=1, kind="stable")
            rows = np.repeat(np.arange(len(pdf)), probes)
            raw = pdf["vector"].to_numpy()
            copies = np.array([blake2b(np.asarray(v).tobytes(), digest_size=16).hexdigest()
                               for v in raw], dtype=object)
            yield pd.DataFrame({
                "id": pdf["id"].to_numpy()[rows], "vector": raw[rows], "copy": copies[rows],
                "list": near[:, :probes].ravel(),
            })

    narrow = df.select(F.col(id_col).alias("id"), F.col(vector).alias("vector"))
    return narrow.where(F.size("vector") > 0).mapInPandas(
        nearest, f"id {id_type}, vector array<float>, copy string, list int"
    )


def _first_per(df: DataFrame, keys: Sequence[str], order: Sequence[Column], count: int) -> DataFrame:
    """The first ``count`` rows per key; each task thins its own rows before the shuffle."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).where(F.col("_place") <= count).drop("_place")


def _slices(assigned: DataFrame, per_slice: int) -> dict[int, int]:
    """How many slices each list needs; one small row per list."""
    sizes = assigned.groupBy("list").agg(F.count(F.lit(1)).alias("n")).collect()
    return {r["list"]: max(1, ceil(r["n"] / per_slice)) for r in sizes}


def _slice_count(slices: dict[int, int], lists: int) -> Column:
    return F.get(F.array(*[F.lit(slices.get(i, 1)) for i in range(lists)]), F.col("list"))


def approx_topk(
    df: DataFrame, queries: DataFrame, *, id_col: str, vector: str, k: int, lists: int,
    probes: int, slice_rows: int = 20000, slice_queries: int = 2000, id_type: str = "bigint",
    exclude_self: bool = False,
) -> DataFrame:
    """(query_id, id, similarity): about the k nearest rows of every query.

    Rows go to their nearest list, queries to their nearest ``probes`` lists; the
    number of lists should grow with the table, so that one holds some
    ``slice_rows`` rows.  With ``probes`` equal to ``lists`` the answer is exact.

    Copies do no harm.  Of equal rows only the k + 1 first ids can appear in an
    answer, so no more go on, and equal queries are asked once.  A list that is
    still larger than ``slice_rows`` rows or ``slice_queries`` queries is cut
    into a grid of blocks, every block is one bounded matrix product, and each
    block hands on only its best per query.
    """
    wanted = k + 1 if exclude_self else k
    center = centers(df, id_col, vector, lists)
    lists = len(center)
    rows = _first_per(
        assign_lists(df, id_col, vector, center, 1, id_type), ["copy"], [F.col("id")], wanted
    )
    asked = _first_per(
        assign_lists(queries, id_col, vector, center, probes, id_type), ["copy", "list"],
        [F.col("id")], 1,
    )
    # written once: their sizes shape the blocks, and their vectors fill them
    rows, asked = settle(rows, "list-rows"), settle(asked, "list-queries")
    row_slices, query_slices = _slices(rows, slice_rows), _slices(asked, slice_queries)

    def grid(side: DataFrame, own: dict[int, int], other: dict[int, int], names) -> DataFrame:
        mine, theirs = names
        return (
            side.withColumn(mine, F.pmod(F.xxhash64("id"), _slice_count(own, lists)).cast("int"))
            .withColumn(theirs, F.explode(
                F.sequence(F.lit(0), _slice_count(other, lists) - 1)))
        )

    left = grid(rows, row_slices, query_slices, ("row_slice", "query_slice"))
    right = grid(asked, query_slices, row_slices, ("query_slice", "row_slice"))
    block = ["list", "row_slice", "query_slice"]

    def best(rows_pdf: pd.DataFrame, asked_pdf: pd.DataFrame) -> pd.DataFrame:
        if rows_pdf.empty or asked_pdf.empty:
            return pd.DataFrame()
        rows_pdf = rows_pdf.sort_values("id", kind="stable")
        sims = np.round(_matrix(asked_pdf["vector"]) @ _matrix(rows_pdf["vector"]).T, DIGITS)
        order = np.argsort(-sims, axis=1, kind="stable")[:, :wanted]
        return pd.DataFrame({
            "copy": np.repeat(asked_pdf["copy"].to_numpy(), order.shape[1]),
            "id": rows_pdf["id"].to_numpy()[order].ravel(),
            "similarity": np.take_along_axis(sims, order, axis=1).ravel(),
        })

    partial = (
        left.groupBy(*block).cogroup(right.groupBy(*block))
        .applyInPandas(best, f"copy string, id {id_type}, similarity double")
    )
    kept = _first_per(partial, ["copy"], [F.desc("similarity"), F.col("id")], wanted)
    answers = kept.groupBy("copy").agg(F.array_sort(F.collect_list(
        F.struct((-F.col("similarity")).alias("away"), "id", "similarity"))).alias("best"))
    whom = assign_lists(queries, id_col, vector, center, 1, id_type).select(
        F.col("id").alias("query_id"), "copy"
    )
    found = join_lookup(whom, answers, ["copy"], "inner", settled=False)
    own = F.col("best")
    if exclude_self:
        own = F.filter(own, lambda x: x["id"] != F.col("query_id"))
    return found.select("query_id", F.explode(F.slice(own, 1, k)).alias("_hit")).select(
        "query_id", "_hit.id", "_hit.similarity"
    )


# sampling and slices -------------------------------------------------------

def sample_rows(df: DataFrame, key: str, n: int, seed: str, where: Column | None = None) -> DataFrame:
    """n rows drawn without replacement; the same rows for any partitioning."""
    pool = df if where is None else df.where(where)
    draw = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    return pool.orderBy(draw, key).limit(n)


def row_window(df: DataFrame, row_idx: str, offset: int = 0, limit: int | None = None) -> DataFrame:
    """Rows by position: a range filter, which reaches the scan."""
    out = df.where(F.col(row_idx) >= offset)
    return out if limit is None else out.where(F.col(row_idx) < offset + limit)


def numbered(df: DataFrame, row_idx: str = "row_idx") -> DataFrame:
    """Rows of a file table with their position from 0: files by path, rows as they stand.

    Rows are counted per block of a file where they are read, and a block's first position is the sum of the counts
    before it.  Only one row per block is summed up in order, and no row is moved, so the positions are the same for
    every reading with the same block size and files.  ``df`` must come straight from files.
    """
    place = {"_path": F.col("_metadata.file_path"), "_block": F.col("_metadata.file_block_start")}
    # within a block, rows are read one after the other by one task, which numbers them in turn
    rows = df.select("*", *[c.alias(n) for n, c in place.items()], F.monotonically_increasing_id().alias("_id"))
    order = Window.orderBy("_path", "_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy("_path", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first"))
    starts = settle(blocks.withColumn("_start", F.coalesce(F.sum("_n").over(order), F.lit(0))), "block-starts")
    return (
        rows.join(starts, ["_path", "_block"])
        .withColumn(row_idx, F.col("_start") + F.col("_id") - F.col("_first"))
        .drop("_path", "_block", "_id", "_n", "_first", "_start"))


def append_union(old: DataFrame, new: DataFrame) -> DataFrame:
    return old.unionByName(new, allowMissingColumns=True)
