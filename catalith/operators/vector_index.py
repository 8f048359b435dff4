"""A written index of inverted lists for cosine search: built once, searched many times.

The rows' lists come from two levels of centers, both trained in Spark.  The first level has about the
square root of the number of lists, so a row or query meets two small sets of centers instead of all
lists.  The folder holds ``rows`` (partitioned by cell, sorted by list), ``centers`` (one row of second-level
centers per cell), ``sizes`` (rows per list) and ``about`` (one row: settings, cells, probes).
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalith.operators.search import DIGITS, _first_per, sample_rows
from catalith.session import settle, shared_folder

ROW_DDL = "id bigint, vector array<float>, cell int, list int"
ROW = pa.schema([("id", pa.int64()), ("vector", pa.list_(pa.float32())), ("cell", pa.int32()), ("list", pa.int32())])
SUMS_DDL = "center int, n bigint, total array<double>"
HIT_DDL = "query_id bigint, id bigint, similarity double"
HIT = pa.schema([("query_id", pa.int64()), ("id", pa.int64()), ("similarity", pa.float64())])


def _matrix(column) -> np.ndarray:
    """Vectors of one size as unit rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return unit(flat.reshape(len(column), -1))


def unit(m: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(m, axis=-1, keepdims=True)
    return np.divide(m, length, out=np.zeros_like(m), where=length > 0)


def usable(df: DataFrame, id_col: str, vector: str) -> tuple[DataFrame, int]:
    """(id, vector) of the vectors that have a direction and the most frequent size, and that size."""
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector).cast("array<float>").alias("vector"))
    odd = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(~odd & F.exists("vector", lambda x: x != 0))
    usual = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    size = usual["d"] if usual else 0
    return rows.where(F.size("vector") == size), size


# training -------------------------------------------------------------------

def _partial_sums(center: np.ndarray):
    schema = pa.schema([("center", pa.int32()), ("n", pa.int64()), ("total", pa.list_(pa.float64()))])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(center.shape), np.zeros(len(center), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            m = _matrix(batch.column(0))
            near = (m @ center.T).argmax(axis=1)
            np.add.at(total, near, m)
            n += np.bincount(near, minlength=len(center))
        seen = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([
            pa.array(seen.astype(np.int32)), pa.array(n[seen]), pa.array(list(total[seen]), pa.list_(pa.float64()))], schema=schema)

    return gather


def _add_up(key: tuple, part: pa.Table) -> pa.Table:
    total = np.stack(part.column("total").to_numpy()).sum(axis=0)
    return pa.table({
        "center": part.column("center")[:1], "n": [int(np.sum(part.column("n").to_numpy()))],
        "total": pa.array([total], pa.list_(pa.float64()))})


def train_cells(sample: DataFrame, first: np.ndarray, rounds: int) -> np.ndarray:
    """First-level centers: rounds of assigning the sample and moving each center to its members' mean.

    A task sends one sum per center; the driver sees one row per center.
    """
    center = first
    for _ in range(rounds):
        moved = sample.select("vector").mapInArrow(_partial_sums(center), SUMS_DDL).groupBy("center").applyInArrow(
            _add_up, SUMS_DDL).collect()
        center = center.copy()
        for row in moved:
            center[row["center"]] = unit(np.array(row["total"]))
    return center


def _train_lists(count: int, rounds: int):
    def train(key: tuple, part: pa.Table) -> pa.Table:
        part = part.sort_by("id")
        m = _matrix(part.column("vector"))
        distinct = np.unique(m, axis=0, return_index=True)[1]
        center = m[np.sort(distinct)[:count]]
        for _ in range(rounds):
            near = (m @ center.T).argmax(axis=1)
            total = np.zeros_like(center)
            np.add.at(total, near, m)
            held = np.bincount(near, minlength=len(center)) > 0
            center[held] = unit(total[held])
        return pa.table({
            "cell": pa.array([key[0].as_py()], pa.int32()),
            "center": pa.array([center.astype(np.float32).tobytes()], pa.binary())})

    return train


def _cells_of(center: np.ndarray, open_cells: int, schema: pa.Schema):
    """Each vector with its nearest ``open_cells`` cells."""
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sims = _matrix(batch.column(1)) @ center.T
            near = np.argsort(-sims, axis=1, kind="stable")[:, :open_cells]
            rows = np.repeat(np.arange(batch.num_rows), near.shape[1])
            taken = batch.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays(
                [taken.column(0), taken.column(1), pa.array(near.ravel().astype(np.int32))], schema=schema)

    return assign


ASSIGNED = pa.schema([("id", pa.int64()), ("vector", pa.list_(pa.float32())), ("cell", pa.int32())])
ASSIGNED_DDL = "id bigint, vector array<float>, cell int"


def _in_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, vector, cell, list): the nearest second-level center of the row's cell."""
    for batch in batches:
        if not batch.num_rows:
            continue
        cells, m = batch.column(2).to_numpy(), _matrix(batch.column(1))
        near = np.zeros(batch.num_rows, np.int32)
        for cell in np.unique(cells):
            own = np.flatnonzero(cells == cell)
            center = np.frombuffer(batch.column(3)[int(own[0])].as_py(), np.float32).reshape(-1, m.shape[1])
            near[own] = (m[own] @ center.T).argmax(axis=1)
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(near)], schema=ROW)


def build_index(
    df: DataFrame, path: str, *, id_col: str, vector: str, rows_per_list: int = 2000, per_center: int = 64,
    rounds: int = 8, k: int = 10, target: float = 0.9, trials: int = 200, seed: str = "index",
) -> None:
    """Write an index of the usable vectors to ``path``.

    The number of lists grows with the table, so that one holds about ``rows_per_list`` rows; all rows are indexed.
    Centers are fitted on ``per_center`` rows each, drawn by hash of the id (the only sample taken).  Then
    ``trials`` rows are searched exactly, in one pass over the rows, to find how many cells and lists a query must open
    for ``target`` of its ``k`` neighbours; the numbers are kept with the index, with the recall they had.
    """
    spark = df.sparkSession
    rows, size = usable(df, id_col, vector)
    rows = settle(rows, "index-input")
    n = rows.count()
    lists = max(1, ceil(n / rows_per_list))
    cells = ceil(sqrt(lists))
    per_cell = ceil(lists / cells)
    sample = settle(sample_rows(rows, "id", cells * per_center, seed), "index-sample")
    first = [r["vector"] for r in sample_rows(sample, "id", cells, seed).collect()]
    center = train_cells(sample, unit(np.array(first, np.float64)), rounds) if n else np.zeros((0, 1))
    assigned = settle(rows.mapInArrow(_cells_of(center, 1, ASSIGNED), ASSIGNED_DDL), "index-cells") if n else rows.withColumn(
        "cell", F.lit(0))
    drawn = _first_per(assigned, ["cell"], [F.md5(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string"))), F.col("id")], per_cell * per_center)
    drawn.groupBy("cell").applyInArrow(_train_lists(per_cell, rounds), "cell int, center binary").write.parquet(f"{path}/centers")
    centers = spark.read.parquet(f"{path}/centers")
    # rebalance instead of repartition: a list that holds a large share of all rows is written by several tasks
    (
        assigned.join(centers, "cell").select("id", "vector", "cell", "center").mapInArrow(_in_lists, ROW_DDL)
        .hint("rebalance", "cell", "list").sortWithinPartitions("cell", "list").write.partitionBy("cell").parquet(f"{path}/rows"))
    written = read_rows(spark, path)
    written.groupBy("cell", "list").count().withColumnRenamed("count", "n").write.parquet(f"{path}/sizes")
    about = (n, size, [float(x) for x in center.ravel()])
    kept = _calibrated(spark, path, written, center, rows, k, target, trials, seed) if n else (1, 1, 1.0)
    spark.createDataFrame(
        [(*about, *kept)], "n bigint, size int, cells array<double>, open_cells int, probes int, recall double"
    ).coalesce(1).write.parquet(f"{path}/about")


def read_rows(spark: SparkSession, path: str) -> DataFrame:
    """The indexed rows."""
    return spark.read.schema(ROW_DDL).parquet(f"{path}/rows")


# how many lists to open -----------------------------------------------------

def _exact_hits(asked: list[tuple[int, list[float]]], k: int):
    ids, m = np.array([a[0] for a in asked]), unit(np.array([a[1] for a in asked], np.float64))
    schema = pa.schema([
        ("query_id", pa.int64()), ("id", pa.int64()), ("similarity", pa.float64()), ("cell", pa.int32()), ("list", pa.int32())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            own = batch.column(0).to_numpy()
            sims = np.round(m @ _matrix(batch.column(1)).T, DIGITS)
            sims[ids[:, None] == own[None, :]] = -2
            near = np.argsort(-sims, axis=1, kind="stable")[:, :k]
            rows = pa.array(near.ravel())
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat(ids, near.shape[1])), batch.column(0).take(rows),
                pa.array(np.take_along_axis(sims, near, axis=1).ravel()),
                batch.column(2).take(rows), batch.column(3).take(rows)], schema=schema)

    return search


def _list_order(asked: list[tuple[int, list[float]]]):
    """(query_id, cell, list, similarity) of every list, from the centers."""
    ids, m = np.array([a[0] for a in asked]), unit(np.array([a[1] for a in asked], np.float64))
    schema = pa.schema([("query_id", pa.int64()), ("cell", pa.int32()), ("list", pa.int32()), ("near", pa.float64())])

    def order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cell, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sims = m @ np.frombuffer(raw, np.float32).reshape(-1, m.shape[1]).T
                count = sims.shape[1]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat(ids, count)), pa.array(np.full(sims.size, cell, np.int32)),
                    pa.array(np.tile(np.arange(count, dtype=np.int32), len(ids))), pa.array(sims.ravel())], schema=schema)

    return order


def _calibrated(spark, path, written, center, rows, k, target, trials, seed) -> tuple[int, int, float]:
    """(cells to open, lists to open, recall on the trials)."""
    asked = [(r["id"], r["vector"]) for r in sample_rows(rows, "id", trials, f"{seed}-trial").collect()]
    hits = _first_per(
        written.select("id", "vector", "cell", "list").mapInArrow(
            _exact_hits(asked, k), "query_id bigint, id bigint, similarity double, cell int, list int")
        .where("similarity > -2"), ["query_id"], [F.desc("similarity"), F.col("id")], k)
    hits = settle(hits, "index-trials")
    sims = unit(np.array([a[1] for a in asked], np.float64)) @ center.T
    cell_order = np.argsort(-sims, axis=1, kind="stable")
    cell_rank = {a[0]: {int(c): p for p, c in enumerate(order)} for a, order in zip(asked, cell_order)}
    found = [(r["query_id"], r["cell"], r["list"]) for r in hits.collect()]
    if not found:
        return len(center), 2**31 - 1, 1.0
    ranks = np.sort([cell_rank[q][c] for q, c, _ in found])
    open_cells = int(ranks[ceil((1 + target) / 2 * len(ranks)) - 1]) + 1
    opened = spark.createDataFrame(
        [(a[0], int(c)) for a, order in zip(asked, cell_order) for c in order[:open_cells]], "query_id bigint, cell int")
    lists = spark.read.parquet(f"{path}/centers").mapInArrow(
        _list_order(asked), "query_id bigint, cell int, list int, near double").join(opened, ["query_id", "cell"])
    lists = settle(lists, "index-orders")
    wanted = lists.join(hits.select("query_id", "cell", "list", "id"), ["query_id", "cell", "list"]).select(
        "query_id", "id", F.col("near").alias("own"))
    places = wanted.join(lists.select("query_id", "near"), "query_id").groupBy("query_id", "id").agg(
        F.sum((F.col("near") >= F.col("own")).cast("int")).alias("place"))
    places = sorted(r["place"] for r in places.collect())
    need = min(len(places), ceil(target * len(found)))
    probes = places[need - 1]
    return open_cells, int(probes), sum(p <= probes for p in places) / len(found)


# search ---------------------------------------------------------------------

def _near_lists(probes: int):
    schema = pa.schema([("query_id", pa.int64()), ("cell", pa.int32()), ("list", pa.int32()), ("near", pa.float64())])

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            cells, m = batch.column(2).to_numpy(), _matrix(batch.column(1))
            for cell in np.unique(cells):
                own = np.flatnonzero(cells == cell)
                center = np.frombuffer(batch.column(3)[int(own[0])].as_py(), np.float32).reshape(-1, m.shape[1])
                sims = m[own] @ center.T
                best = np.argsort(-sims, axis=1, kind="stable")[:, :probes]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(np.repeat(own, best.shape[1]))),
                    pa.array(np.full(best.size, cell, np.int32)), pa.array(best.ravel().astype(np.int32)),
                    pa.array(np.take_along_axis(sims, best, axis=1).ravel())], schema=schema)

    return near


def _block_best(k: int):
    def best(rows: pa.Table, asked: pa.Table) -> pa.Table:
        if not rows.num_rows or not asked.num_rows:
            return HIT.empty_table()
        rows = rows.sort_by("id")
        ids = rows.column("id").to_numpy()
        sims = np.round(_matrix(asked.column("query")) @ _matrix(rows.column("vector")).T, DIGITS)
        near = np.argsort(-sims, axis=1, kind="stable")[:, :k]
        return pa.table([
            pa.array(np.repeat(asked.column("query_id").to_numpy(), near.shape[1])), pa.array(ids[near.ravel()]),
            pa.array(np.take_along_axis(sims, near, axis=1).ravel())], schema=HIT)

    return best


def about(spark: SparkSession, path: str):
    """The index's one row of settings."""
    return spark.read.parquet(f"{path}/about").first()


def probed_lists(
    spark: SparkSession, path: str, queries: DataFrame, open_cells: int | None = None, probes: int | None = None,
) -> DataFrame:
    """(query_id, cell, list): the lists that each query (id, vector) opens."""
    index = about(spark, path)
    open_cells, probes = open_cells or index["open_cells"], probes or index["probes"]
    center = np.array(index["cells"]).reshape(-1, max(index["size"], 1))
    near = queries.where(F.size("vector") == index["size"]).mapInArrow(
        _cells_of(center, open_cells, ASSIGNED), ASSIGNED_DDL)
    lists = near.join(spark.read.parquet(f"{path}/centers"), "cell").select("id", "vector", "cell", "center").mapInArrow(
        _near_lists(probes), "query_id bigint, cell int, list int, near double")
    return _first_per(lists, ["query_id"], [F.desc("near"), F.col("cell"), F.col("list")], probes).drop("near")


def search_index(
    spark: SparkSession, path: str, queries: DataFrame, k: int, *, id_col: str, vector: str,
    open_cells: int | None = None, probes: int | None = None, exclude_self: bool = False,
    slice_rows: int = 20000, slice_queries: int = 2000,
) -> DataFrame:
    """(query_id, id, similarity): about the ``k`` nearest indexed rows of every query, ties by id.

    Only the cells that some query opens are read (dynamic partition pruning), and of those only lists that are
    probed reach a product.  A list with more than ``slice_rows`` rows or ``slice_queries`` queries becomes a grid
    of blocks; how many is looked up by joins, so nothing per list comes to the driver.  With all cells and lists
    opened the answer is exact.  Queries without a direction or of another size have no answer; ids of queries
    should be unique.
    """
    asked = settle(usable(queries, id_col, vector)[0], "index-queries")
    opened = settle(probed_lists(spark, path, asked, open_cells, probes), "index-probes")
    shapes = settle(
        opened.groupBy("cell", "list").count().join(spark.read.parquet(f"{path}/sizes"), ["cell", "list"]).select(
            "cell", "list", F.ceil(F.col("n") / slice_rows).cast("int").alias("row_slices"),
            F.ceil(F.col("count") / slice_queries).cast("int").alias("query_slices")), "index-shapes")

    def spread(side: DataFrame, own: str, other: str, id_: str) -> DataFrame:
        return (
            # the comparison lets the optimizer prune cells at run time; without a filter it does not try
            side.join(shapes.where("row_slices >= 1"), ["cell", "list"])
            .withColumn(own[:-1], F.pmod(F.xxhash64(id_), F.col(own).cast("bigint")).cast("int"))
            .withColumn(other[:-1], F.explode(F.sequence(F.lit(0), F.col(other) - 1))))

    rows = spread(read_rows(spark, path), "row_slices", "query_slices", "id").select(
        "cell", "list", "row_slice", "query_slice", "id", "vector")
    sent = spread(opened, "query_slices", "row_slices", "query_id").join(
        asked.select(F.col("id").alias("query_id"), F.col("vector").alias("query")), "query_id").select(
        *[F.col(c).alias(f"q_{c}") for c in ("cell", "list", "row_slice", "query_slice")], "query_id", "query")
    wanted = k + 1 if exclude_self else k
    partial = rows.groupBy("cell", "list", "row_slice", "query_slice").cogroup(
        sent.groupBy("q_cell", "q_list", "q_row_slice", "q_query_slice")).applyInArrow(_block_best(wanted), HIT_DDL)
    if exclude_self:
        partial = partial.where("id <> query_id")
    return _first_per(partial, ["query_id"], [F.desc("similarity"), F.col("id")], k)


def indexed_topk(df: DataFrame, queries: DataFrame, k: int, *, id_col: str, vector: str, exclude_self: bool = False, **build) -> DataFrame:
    """Build an index of ``df`` in the shared folder and search it."""
    path = shared_folder(df.sparkSession, "vector-index")
    build_index(df, path, id_col=id_col, vector=vector, k=k, **build)
    return search_index(df.sparkSession, path, queries, k, id_col=id_col, vector=vector, exclude_self=exclude_self)
