"""Whitening of embeddings by principal components that contour integration finds."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalith.session import settle

SHIFT = 1_000_000
LARGEST = 2**50  # scaled components beyond this are no numbers that a double and a long both hold
NODES = 8  # quadrature nodes on the upper half of a contour

FOUND = pa.schema([
    ("id", pa.int64()), ("component", pa.int32()), ("deviation", pa.int64()), ("whitened", pa.float64())])
FOUND_DDL = "id bigint, component int, deviation bigint, whitened double"


# eigenpairs of a symmetric matrix ------------------------------------------

def tridiagonal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of the tridiagonal matrix that reflections turn a symmetric one into."""
    a, off = np.array(v, np.float64), np.zeros(max(len(v) - 1, 0))
    for k in range(len(a) - 2):
        u = a[k + 1:, k].copy()
        off[k] = -np.copysign(np.linalg.norm(u), u[0])
        u[0] -= off[k]
        if (length := np.linalg.norm(u)) == 0:
            continue
        u /= length
        rest = a[k + 1:, k + 1:]
        p = 2 * rest @ u
        q = p - (u @ p) * u
        rest -= np.outer(u, q) + np.outer(q, u)
    if len(a) > 1:
        off[-1] = a[-1, -2]
    return np.diag(a).copy(), off


class Inertia:
    """Counts of a symmetric matrix's eigenvalues above any number, by Sylvester's law.

    The matrix is made tridiagonal once; the signs of the pivots of its shifted L D L' are those of the
    shifted matrix's eigenvalues, and each count takes one pass over the diagonal.
    """

    def __init__(self, v: np.ndarray):
        diagonal, off = tridiagonal(v)
        self.rows = list(zip(diagonal.tolist(), [0.0, *(off**2).tolist()]))
        self.tiny = max(1e-300, 1e-30 * float(np.abs(v).max(initial=0)))

    def above(self, at: float) -> int:
        pivot, count = 1.0, 0
        for value, square in self.rows:
            pivot = value - at - square / pivot
            if abs(pivot) < self.tiny:
                pivot = -self.tiny
            count += pivot > 0
        return count


def feast(v: np.ndarray, low: float, high: float, count: int, rounds: int = 40) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenvalues of ``v`` inside (low, high) and their vectors.

    The spectral projector of the interval is the integral of the resolvent around it, taken by
    Gauss-Legendre nodes on a circle; as ``v`` is real, the lower half is the conjugate of the upper.
    It is applied to a block of half as many columns again, Rayleigh-Ritz takes the pairs from what it
    leaves, and their vectors are the next block, until the residuals are rounding errors.
    """
    d = len(v)
    size = min(d, count + max(4, count // 2))
    block = np.random.default_rng(0).standard_normal((d, size))
    x, w = np.polynomial.legendre.leggauss(NODES)
    angle, middle, radius = np.pi / 2 * (1 - x), (low + high) / 2, (high - low) / 2
    turn = radius * np.exp(1j * angle)
    solved = [np.linalg.inv((middle + t) * np.eye(d) - v) for t in turn]
    scale, last = np.linalg.norm(v), np.inf
    for _ in range(rounds):
        moved = sum((wi / 2 * t * (s @ block)).real for wi, t, s in zip(w, turn, solved))
        basis = np.linalg.qr(moved)[0]
        values, turned = np.linalg.eigh(basis.T @ v @ basis)
        block = basis @ turned
        inside = (values > low) & (values < high)
        residual = np.linalg.norm(v @ block[:, inside] - block[:, inside] * values[inside], axis=0).max(initial=0)
        if inside.sum() == count and (residual < 1e-14 * scale or residual > 0.5 * last and residual < 1e-11 * scale):
            return values[inside], block[:, inside]
        last = residual
    raise ArithmeticError(f"{int(inside.sum())} of {count} eigenvalues in ({low}, {high}), residual {residual}")


def _parting(inertia: Inertia, low: float, high: float) -> float:
    """Of nine numbers around the middle of (low, high) one with the fewest eigenvalues near it."""
    near = 0.02 * (high - low)
    shares = (0.5, 0.45, 0.55, 0.4, 0.6, 0.35, 0.65, 0.3, 0.7)
    return min(
        (low + s * (high - low) for s in shares), key=lambda at: inertia.above(at - near) - inertia.above(at + near))


def intervals(v: np.ndarray, most: int, floor: float, inertia: Inertia) -> list[tuple[float, float, int]]:
    """Disjoint (low, high, count) from the top of the spectrum that hold its ``most`` largest eigenvalues.

    An interval is halved while it holds more than eight eigenvalues or spans more than a factor of
    four, so its contour parts its inside well; what is below ``floor`` counts as zero.  Eigenvalues that
    halving cannot part stay together.
    """
    top = float(np.abs(v).sum(axis=1).max()) * (1 + 1e-9)
    out, have, waiting = [], 0, [(floor, top, inertia.above(floor), 0)]
    while waiting and have < most:
        low, high, n_low, n_high = waiting.pop()  # the highest one
        count = n_low - n_high
        if count == 0:
            continue
        if (count <= 8 and high <= 4 * low) or high - low <= 1e-9 * top:
            out.append((low, high, count))
            have += count
            continue
        at = _parting(inertia, low, high) if high <= 4 * low else (low * high) ** 0.5
        n_at = inertia.above(at)
        waiting += [(low, at, n_low, n_at), (at, high, n_at, n_high)]
    return out


def components(v: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The up to ``most`` largest eigenvalues of a covariance, falling, and their unit vectors as rows.

    Eigenvalues of at most 1e-11 of the trace may be rounding errors of zero and have no component.  The intervals'
    pairs go through one more Rayleigh-Ritz step together, which makes vectors of neighbouring intervals
    orthogonal to the last digit; then the inertia at the ends says whether any is missing.
    """
    trace = float(np.trace(v))
    if not trace > 0:
        return np.empty(0), np.empty((0, len(v)))
    inertia = Inertia(v)
    taken = intervals(v, most, 1e-11 * trace, inertia)
    found = [feast(v, low, high, count) for low, high, count in taken]
    if not found:
        return np.empty(0), np.empty((0, len(v)))
    basis = np.linalg.qr(np.hstack([u for _, u in found]))[0]
    values, turned = np.linalg.eigh(basis.T @ v @ basis)
    low, count = taken[-1][0], sum(n for _, _, n in taken)
    if len(values) != count or inertia.above(low) != count:
        raise ArithmeticError(f"{len(values)} eigenvalues found above {low}, {inertia.above(low)} are there")
    order = np.argsort(-values, kind="stable")[:most]
    return values[order], (basis @ turned).T[order]


# statistics of the fit list -------------------------------------------------

def scaled(vector: Column, factor: int = 64) -> Column:
    """floor(factor * x) + 1000000 of each component; missing for a vector that takes no part."""
    def whole(x: Column) -> Column:
        return F.floor(x.cast("double") * factor)

    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double") * factor) >= LARGEST))
    return F.when(~odd & (F.size(vector) > 0), F.transform(vector, lambda x: whole(x).cast("bigint") + SHIFT))


@dataclass
class Fit:
    """What the fit list says: its size, sums, a whole number near each mean, and the components."""

    n: int
    sums: list[int]
    centre: np.ndarray
    rest: np.ndarray  # mean - centre
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float = 0.0

    @property
    def maps(self) -> np.ndarray:
        return self.vectors / np.sqrt(self.values)[:, None] if len(self.values) else self.vectors

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.centre).astype(np.float64) - self.rest) @ self.maps.T

    def deviation(self, x: np.ndarray) -> np.ndarray:
        """Exact sums of (n x - S)^2 in a long; missing (None) where they exceed it."""
        away = self.n * (x - self.centre).astype(object) - np.array(
            [s - self.n * int(c) for s, c in zip(self.sums, self.centre)], object)
        if len(x) and (bound := np.abs(away).max()) and bound**2 * x.shape[1] < 2**63:
            away = away.astype(np.int64)
        total = (away * away).sum(axis=1)
        return np.array([t if t < 2**63 else None for t in total.tolist()], object)


def _matrix(column: pa.ChunkedArray | pa.Array, rows: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


def _products(centre: np.ndarray):
    """Sums y and y y^T of y = x - centre, exact: one row (i, j, sum) per entry and task; j = -1 for y itself."""
    schema = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("total", pa.decimal128(38, 0))])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = len(centre)
        first, second, seen = np.zeros(d, object), np.zeros((d, d), object), False
        for batch in batches:
            y = _matrix(batch.column(0), batch.num_rows) - centre
            if not len(y):
                continue
            seen = True
            largest = int(np.abs(y).max())
            first = first + y.astype(object).sum(axis=0) if largest * len(y) >= 2**62 else first + y.sum(axis=0)
            step = int(2**53 // (largest**2 or 1))  # so many products sum up exactly in a double
            if step < 1:
                second = second + y.astype(object).T @ y.astype(object)
            for at in range(0, len(y) if step else 0, max(step, 1)):
                part = y[at: at + step].astype(np.float64)
                second = second + (part.T @ part).astype(np.int64)
        if seen:
            i, j = np.triu_indices(d)
            totals = [int(t) for t in (*first, *second[i, j])]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([np.arange(d), i]).astype(np.int32)),
                pa.array(np.concatenate([np.full(d, -1), j]).astype(np.int32)),
                pa.array(totals, pa.decimal128(38, 0))], schema=schema)

    return gather


def fit(points: DataFrame, most: int = 16) -> Fit | None:
    """Statistics and components of the distinct vectors in the column ``x``; None, if there are none.

    Sums and products are whole numbers: each task sums exactly, Spark adds the tasks' sums as
    decimals, and d * d numbers come to the driver, whatever the number of rows.  Products are of values less a
    whole number near the mean, and the covariance is put right by what is left of the mean, also exactly.
    """
    once = settle(points.select("x").distinct(), "fit-list")
    sums = (
        once.select(F.posexplode("x").alias("i", "value")).groupBy("i")
        .agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("total"), F.count("*").alias("n")).orderBy("i").collect())
    if not sums:
        return None
    n, totals = sums[0]["n"], [int(r["total"]) for r in sums]
    centre = np.array([round(t / n) for t in totals], np.int64)
    entries = (
        once.mapInArrow(_products(centre), "i int, j int, total decimal(38,0)")
        .groupBy("i", "j").agg(F.sum("total").alias("total")).collect())
    d = len(totals)
    left = [t - n * int(c) for t, c in zip(totals, centre)]
    v = np.zeros((d, d))
    for r in entries:
        if r["j"] >= 0:
            whole = n * int(r["total"]) - left[r["i"]] * left[r["j"]]
            v[r["i"], r["j"]] = v[r["j"], r["i"]] = whole / (n * n)
    values, vectors = components(v, most)
    made = Fit(n, totals, centre, np.array([t / n for t in left]), values, vectors, float(np.trace(v)))
    if len(values):
        made.identity_error = identity_error(made, once)
    return made


def identity_error(made: Fit, once: DataFrame) -> float:
    """Largest entry of the covariance of the whitened fit list minus the identity, from the rows themselves."""
    k = len(made.values)
    schema = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("total", pa.float64())])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k + 1))
        for batch in batches:
            w = made.whiten(_matrix(batch.column(0), batch.num_rows))
            total[:, :k] += w.T @ w
            total[:, k] += w.sum(axis=0)
        i, j = np.divmod(np.arange(k * (k + 1)), k + 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total.ravel())], schema=schema)

    total = np.zeros((k, k + 1))
    for r in once.mapInArrow(gather, "i int, j int, total double").groupBy("i", "j").agg(
            F.sum("total").alias("total")).collect():
        total[r["i"], r["j"]] = r["total"] / made.n
    mean = total[:, k]  # zero but for rounding
    return float(np.abs(total[:, :k] - np.outer(mean, mean) - np.eye(k)).max())


def _whitener(made: Fit):
    k = len(made.values)

    def whiten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x = _matrix(batch.column(1), n)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(np.repeat(np.arange(n), k))),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n)),
                pa.array(np.repeat(made.deviation(x), k).tolist(), pa.int64()),
                pa.array(made.whiten(x).ravel()),
            ], schema=FOUND)

    return whiten


def whitened(
    vectors: DataFrame, most: int = 16, factor: int = 64, id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """Every usable row's whitened coordinates on the ``most`` largest principal components.

    Gives id_col, component (from 1, by falling eigenvalue), n, deviation, whitened, explained and
    identity_error.  The fit takes each distinct scaled vector once, so copies do not weigh; all
    rows are then projected.  The eigenvalue problem is of the vectors' length squared and is solved on the
    driver (``components``); nothing else comes there but sums of that size.

    Rows whose vector is missing, empty, or holds a missing or non-finite component (or one whose multiple
    leaves 2**50) take no part; of vectors of several lengths those of the most frequent length do, of equally
    frequent ones the longer.  Repeated rows and rows without an id each get their rows.  Directions without
    variance (all of them, if only one distinct vector is left) have no component, so there may be
    fewer than ``most`` and an empty table gives no rows.  Tied eigenvalues span one space; its basis is the
    same for all rows.  A deviation beyond a long is missing.  Other columns are not read.
    """
    points = settle(
        vectors.select(F.col(id_col).cast("bigint").alias("id"), scaled(F.col(vector_col), factor).alias("x"))
        .where("x IS NOT NULL"), "scaled-vectors")
    usual = points.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    points = points.where(F.size("x") == (usual["d"] if usual else 0))
    made = fit(points, most)
    if made is None or not len(made.values):
        none = points.where("false").select(
            "id", *[F.lit(None).cast(t).alias(c) for c, t in (
                ("component", "int"), ("n", "bigint"), ("deviation", "bigint"), ("whitened", "double"),
                ("explained", "double"), ("identity_error", "double"))])
        return none.withColumnRenamed("id", id_col)
    shares = F.array(*[F.lit(float(e / made.trace)) for e in made.values])
    return points.mapInArrow(_whitener(made), FOUND_DDL).select(
        F.col("id").alias(id_col), "component", F.lit(made.n).cast("bigint").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("component") - 1).alias("explained"), F.lit(made.identity_error).alias("identity_error"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened coordinates of every embedding on the 16 largest components."""
    return whitened(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))
