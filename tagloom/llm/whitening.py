"""Whitening of embeddings on the leading eigenvectors of their covariance, found by contour integration (FEAST).

Passes over the vectors: exact integer sums; the centred covariance, one matrix per task added up by rows; the projection,
written once, from which the covariance of the result is measured. All that leaves the tasks has the size of the dimension
or its square, whatever the number of rows; ``MAX_DIMENSION`` bounds it.

The eigenvectors come from slices of the spectrum. Inertia (the signs of the pivots of V - s I) counts the eigenvalues above a
shift s, so bisection cuts the top of the spectrum into intervals with a few eigenvalues each, and the count of each is known
before it is solved. Each interval is a task of its own: a Gauss-Legendre quadrature of (z I - V)^-1 Y over a circle around the
interval projects a random block Y onto the eigenvectors inside, Rayleigh-Ritz extracts them, and this repeats until the
residuals reach rounding. A result with another number of pairs than the inertia count is refused.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm.arrays import list_array
from tagloom.session import written

SCALE, SHIFT = 1024, 100_000
MAX_DIMENSION = 2048
PER_INTERVAL = 4
NODES = 8  # quadrature points on the upper half of the circle
ROUNDS = 40
BATCH_VALUES = 1 << 20


# --- inertia --------------------------------------------------------------------------------

def count_above(v: np.ndarray, shift: float) -> int:
    """Eigenvalues of the symmetric ``v`` above ``shift``: positive pivots of a symmetric elimination of v - shift I, with 1x1 and
    2x2 pivots chosen as by Bunch and Kaufman, so small pivots never divide."""
    a = v - shift * np.eye(len(v))
    ratio, above, k, n = (1 + 17**0.5) / 8, 0, 0, len(v)

    def swap(i: int, j: int) -> None:
        a[[i, j]] = a[[j, i]]
        a[:, [i, j]] = a[:, [j, i]]

    while k < n:
        size = 1
        column = np.abs(a[k + 1 :, k])
        most = column.max(initial=0.0)
        if most and abs(a[k, k]) < ratio * most:
            r = k + 1 + int(column.argmax())
            other = np.abs(a[k:, r])
            other[r - k] = 0
            if abs(a[k, k]) * other.max() >= ratio * most * most:
                pass
            elif abs(a[r, r]) >= ratio * other.max():
                swap(k, r)
            else:
                swap(k + 1, r)
                size = 2
        rest = slice(k + size, n)
        if size == 1:
            above += a[k, k] > 0
            if a[k, k]:
                a[rest, rest] -= np.outer(a[rest, k] / a[k, k], a[k, rest])
        else:
            above += 1  # a 2x2 pivot has one positive and one negative eigenvalue
            a[rest, rest] -= a[rest, k : k + 2] @ np.linalg.solve(a[k : k + 2, k : k + 2], a[k : k + 2, rest])
        k += size
    return int(above)


def edge(v: np.ndarray, inside: float, outside: float, count: int, steps: int = 16) -> float:
    """A shift between ``inside`` and ``outside``, as far out as bisection gets with ``count`` eigenvalues above it."""
    for _ in range(steps):
        middle = (inside + outside) / 2
        inside, outside = (middle, outside) if count_above(v, middle) == count else (inside, middle)
    return inside


def slices_of(v: np.ndarray, wanted: int) -> list[tuple[float, float, int]]:
    """Intervals (low, high, eigenvalues inside) that hold the ``wanted`` largest eigenvalues, from the highest down.

    A boundary is placed where about PER_INTERVAL more eigenvalues lie above it, in the middle of a gap as far as bisection finds
    one; eigenvalues too close for it to part stay in one interval, so a slice may hold more."""
    norm = float(np.abs(v).sum(axis=1).max()) * (1 + 1e-9)
    floor, done, out = -norm, 0, []
    # Close above the largest eigenvalue, since the filter is as sharp as the circle is small.
    high = edge(v, norm, floor, 0) + 0.01 * norm
    while done < wanted:
        goal = min(done + PER_INTERVAL, wanted)
        low, top, at = floor, high, len(v)
        # at = eigenvalues above low >= goal, and fewer than goal above top.
        while at != goal and top - low > 1e-12 * norm:
            middle = (low + top) / 2
            n = count_above(v, middle)
            if n >= goal:
                low, at = middle, n
            else:
                top = middle
        # The middle of the gap around the boundary, as far as bisection finds its ends.
        cut = (edge(v, low, floor, at) + edge(v, low, high, at)) / 2
        out.append((cut, high, at - done))
        high, done = cut, at
    return out


# --- FEAST ----------------------------------------------------------------------------------

def feast(v: np.ndarray, low: float, high: float, count: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenvalues of the symmetric ``v`` in (low, high), falling, and their unit eigenvectors as columns."""
    n = len(v)
    block = n if count == n else min(n, max(count + 3, 2 * count))
    y = np.random.default_rng(seed).standard_normal((n, block))
    x, w = np.polynomial.legendre.leggauss(NODES)
    centre, radius = (low + high) / 2, (high - low) / 2
    angle = np.pi / 2 * (1 - x)  # 0 to pi
    points = centre + radius * np.exp(1j * angle)
    eye = np.eye(n)
    norm = np.abs(v).sum(axis=1).max()
    best = None
    for _ in range(ROUNDS):
        # Both half circles together are twice the real part, since v is real.
        q = sum(wk / 2 * np.real(radius * np.exp(1j * t) * np.linalg.solve(z * eye - v, y.astype(complex)))
                for z, t, wk in zip(points, angle, w))
        u, s, _ = np.linalg.svd(q, full_matrices=False)
        u = u[:, s > s[0] * 1e-13]
        small = u.T @ v @ u
        e, f = np.linalg.eigh((small + small.T) / 2)
        vectors = u @ f
        residual = np.linalg.norm(v @ vectors - vectors * e, axis=0)
        # Ritz pairs whose residual could carry them across a boundary do not count as inside.
        inside = (e > low) & (e < high) & (residual < 1e-6 * norm)
        y = vectors
        if inside.sum() != count:
            continue
        worst = residual[inside].max(initial=0.0)
        if best is not None and worst >= best[0] / 2:
            if worst < best[0]:
                best = (worst, e[inside][::-1], vectors[:, inside][:, ::-1])
            break
        best = (worst, e[inside][::-1], vectors[:, inside][:, ::-1])
    if best is None or best[0] > 1e-10 * norm:
        raise ArithmeticError(f"contour integration found no {count} eigenvalues in ({low}, {high})")
    return best[1], best[2]


def leading(spark: SparkSession, v: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of ``v`` that are above rounding, falling, and their eigenvectors as columns. Every
    interval of the spectrum is a Spark task."""
    n = len(v)
    trace = float(np.trace(v))
    if not n or trace <= 0:
        return np.zeros(0), np.zeros((n, 0))
    v = v / trace
    rank = count_above(v, n * np.finfo(float).eps)
    cuts = slices_of(v, min(wanted, rank)) if rank else []
    if not cuts:
        return np.zeros(0), np.zeros((n, 0))

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for k, low, high, count in batch.itertuples(index=False):
                e, x = feast(v, low, high, int(count))
                yield pd.DataFrame({"k": k, "value": e, "vector": list(x.T)})

    tasks = spark.createDataFrame([(k, *c) for k, c in enumerate(cuts)], "k int, low double, high double, n int").repartition(len(cuts), "k")
    found = tasks.mapInPandas(solve, "k int, value double, vector array<double>").collect()  # at most wanted + a cluster of rows
    found.sort(key=lambda r: -r["value"])
    if len(found) != sum(c[2] for c in cuts):
        raise ArithmeticError("an interval lost eigenvalues")
    found = found[: min(wanted, rank)]
    return np.array([r["value"] for r in found]) * trace, np.array([r["vector"] for r in found]).T.reshape(n, -1)


# --- operator -------------------------------------------------------------------------------

def valid_rows(df: DataFrame, id: str, vector: str) -> DataFrame:
    """(id, v array<double>) of the rows whose vector is not null, not empty, and of finite entries only."""
    v = F.col(vector).cast("array<double>")
    fit = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.select(F.col(id).alias("id"), v.alias("v")).where(F.col("v").isNotNull() & (F.size("v") > 0)).where(fit)


@dataclass
class Whitening:
    """n vectors, their sums of x by dimension, components as rows, eigenvalues and the trace of the covariance."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    trace: float


def matrices(lists: pa.Array, d: int) -> Iterator[tuple[int, np.ndarray]]:
    """First row and entries x of consecutive parts of a list array, as whole numbers."""
    step = max(1, BATCH_VALUES // d)
    for at in range(0, len(lists), step):
        c = lists.slice(at, step).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
        x = np.floor(SCALE * c)
        if np.abs(x).max(initial=0) >= 1 << 52:
            raise OverflowError("an entry is too large for whole numbers")
        yield at, x.astype(np.int64) + SHIFT


def fit(rows: DataFrame, components: int = 8) -> Whitening:
    """Fit on all of ``rows`` (id, v). Vectors of different lengths, or longer than MAX_DIMENSION, are an error."""
    spark = rows.sparkSession
    sizes = rows.agg(F.min(F.size("v")).alias("a"), F.max(F.size("v")).alias("b"), F.count(F.lit(1)).alias("n")).first()
    n, d = sizes["n"], sizes["a"] or 0
    if sizes["b"] is not None and (sizes["a"] != sizes["b"] or d > MAX_DIMENSION):
        raise ValueError(f"vectors must have one length of at most {MAX_DIMENSION}, found {sizes['a']} to {sizes['b']}")
    if not n:
        return Whitening(0, [], np.zeros((0, 0)), np.zeros(0), 0.0)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * d
        for batch in batches:
            for _, x in matrices(batch.column("v"), d):
                total = [a + int(b) for a, b in zip(total, x.sum(axis=0))]
        yield pa.RecordBatch.from_pydict({"i": np.arange(d, dtype=np.int32), "s": [str(t) for t in total]})

    # Whole numbers of any size travel as text and are added up as decimals.
    exact = rows.select("v").mapInArrow(summed, "i int, s string").groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    sums = [int(r["s"]) for r in sorted(exact.collect())]
    whole, rest = np.array([s // n for s in sums]), np.array([s % n / n for s in sums])

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = np.zeros((d, d))
        for batch in batches:
            for _, x in matrices(batch.column("v"), d):
                y = (x - whole) - rest
                v += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(d, dtype=np.int32)), list_array(v.ravel(), np.full(d, d), pa.float64())], names=["i", "row"])

    total = rows.select("v").mapInArrow(products, "i int, row array<double>").groupBy("i") \
        .agg(vector_to_array(Summarizer.sum(array_to_vector("row"))).alias("row"))
    v = np.array([r["row"] for r in sorted(total.collect())]) / n
    v = (v + v.T) / 2
    values, vectors = leading(spark, v, components)
    return Whitening(n, sums, vectors.T, values, float(np.trace(v)))


def transform(rows: DataFrame, model: Whitening) -> DataFrame:
    """(id, deviation decimal(38,0), w array<double>) of every row: the exact sum of (n x - S)^2 and the whitened coordinates."""
    n, d = model.n, len(model.sums)
    whole, rest = np.array([s // n for s in model.sums], np.int64), np.array([s % n for s in model.sums], np.int64)
    k = len(model.values)
    axes = model.vectors.T / np.sqrt(model.values) if k else np.zeros((d, 0))
    decimal = pa.decimal128(38, 0)

    def deviations(apart: np.ndarray) -> pa.Array:
        """Exact sums of (n x - S)^2, where n x - S = n apart - rest: in 64 bits where they fit, else in Python's whole numbers."""
        far = int(np.abs(apart).max(initial=0)) + 1
        if d * (n * far) ** 2 < 1 << 63:
            return pa.array(((n * apart - rest) ** 2).sum(axis=1)).cast(decimal)
        if d * far * max(far, n) >= 1 << 63:
            apart = apart.astype(object)
        squares, mixed = (apart * apart).sum(axis=1), (apart * rest).sum(axis=1)
        own = sum(int(r) ** 2 for r in rest)
        return pa.array([n * n * int(a) - 2 * n * int(b) + own for a, b in zip(squares, mixed)], decimal)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lists = batch.column("id"), batch.column("v")
            for at, x in matrices(lists, d):
                w = ((x - whole) - rest / n) @ axes
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(at, len(x)), deviations(x - whole), list_array(w.ravel(), np.full(len(x), k), pa.float64())],
                    names=["id", "deviation", "w"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(project, f"id {kind}, deviation decimal(38,0), w array<double>")


def identity_error(done: DataFrame, k: int) -> float:
    """Largest absolute entry of the covariance of w minus the identity; means first, then centred products."""
    if not k:
        return 0.0
    means = done.agg(*[F.avg(F.get("w", i)).alias(f"m{i}") for i in range(k)]).first()
    c = [F.get("w", i) - F.lit(means[i]) for i in range(k)]
    spots = [(i, j) for i in range(k) for j in range(i + 1)]
    found = done.agg(*[F.avg(c[i] * c[j]).alias(f"c{i}_{j}") for i, j in spots]).first()
    return max(abs(x - (i == j)) for x, (i, j) in zip(found, spots))


def whiten(df: DataFrame, id: str = "id", vector: str = "embedding", components: int = 8) -> DataFrame:
    """(id, component, n, deviation decimal(38,0), whitened, explained, identity_error) for every row with a valid vector and each
    of the first ``components`` components, numbered from 1 by falling eigenvalue.

    Rows whose vector is null, empty, or holds null, NaN or infinite entries take no part. Components are no more than the
    rank of the covariance: none for equal vectors or fewer than two, which then give no rows. Repeated rows and ids (null ones
    too) all count and all stay. Equal eigenvalues: any orthonormal basis. Other columns are ignored. Vectors of different
    lengths, longer ones than MAX_DIMENSION, and entries beyond 2^42 are errors.
    """
    rows = valid_rows(df, id, vector)
    model = fit(rows, components)
    k = len(model.values)
    done = written(transform(rows, model), "whitened") if k else rows.select("id", F.lit(0).cast("decimal(38,0)").alias("deviation"), F.array().cast("array<double>").alias("w")).limit(0)
    share = F.array(*[F.lit(float(e / model.trace)) for e in model.values]).cast("array<double>")
    return done.select("id", "deviation", F.posexplode("w").alias("c", "whitened")).select(
        "id", (F.col("c") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(share, F.col("c")).alias("explained"), F.lit(identity_error(done, k)).alias("identity_error"))
