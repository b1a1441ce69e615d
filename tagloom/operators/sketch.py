"""Principal axes of sparse rows by a randomised range finder: no matrix of columns x columns anywhere.

The cells are dealt out once by column into packed ranges of columns. A pass reads them once: the transposed cells times ``k + extra``
vectors of the rows (Gaussian ones at first, a hash of the id) give one short vector per column of a range, and the cells times these
give the next vectors of the rows, which the tasks add up. The vectors of the columns are nowhere stored. Made orthonormal (from their
products of (k + extra)^2 numbers), they span nearly the leading axes; the small covariance of the rows' products with them turns the
span into axes, which are made from the ranges when they are read. ``passes`` repeats that, for spectra that fall slowly. The driver and every task hold a vector per row, up to
``ROW_NUMBERS`` numbers; of more rows, the vectors of rows and columns are tables joined with the cells.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.operators.hashed import gaussians
from tagloom.operators.linear import added
from tagloom.operators.ranking import dense_position
from tagloom.operators.termblocks import opened, planes
from tagloom.session import written

EXTRA = 10
BROADCAST_ROWS = 1 << 22  # numbers of rows that every task may hold
ROW_NUMBERS = 1 << 25  # numbers of the vectors of all rows that the driver may hold
JOB_NUMBERS = 1 << 23  # numbers of the sums that a task of one job makes, and the driver reads
SLICE_CELLS = 1 << 20  # cells of a range of columns, or those of one column
AXIS_ROWS = 1 << 13
SLICE_NAMES = ["column", "names", "sizes", "rows", "data"]
SLICES = "column bigint, names array<string>, sizes binary, rows binary, data binary"


@dataclass
class SparseAxes:
    """axes: (column, axis array<double>), a unit vector per component over the columns; variances fall."""

    axes: DataFrame
    offset: np.ndarray
    variances: np.ndarray
    total: float

    def project(self, cells: DataFrame, ids: DataFrame) -> DataFrame:
        """(id, projection array<double>) of every id; rows without known columns stand at minus the mean."""
        if not len(self.offset):
            return ids.select("id", F.array().cast("array<double>").alias("projection"))
        y = dotted(cells, self.axes, "axis", len(self.offset))
        zero = F.array_repeat(F.lit(0.0), len(self.offset))
        shifted = F.zip_with(F.coalesce("y", zero), F.lit(self.offset.tolist()), lambda a, b: a - b)
        return ids.select("id").join(y, "id", "left").select("id", shifted.alias("projection"))


def summed(factor: str, vector: str, size: int) -> Column:
    """Sum of the arrays ``vector`` of ``size`` numbers, each times its number ``factor``: plain sums, as Summarizer sorts its
    rows where there are many groups."""
    return F.array(*[F.sum(F.get(vector, k) * F.col(factor)) for k in range(size)])


def dotted(cells: DataFrame, columns: DataFrame, vector: str, size: int) -> DataFrame:
    """(id, y): the rows times a table of vectors of ``size`` numbers by column."""
    met = cells.join(columns.select("column", F.col(vector).alias("_v")), "column")
    return met.groupBy("id").agg(summed("value", "_v", size).alias("y"))


def moments(rows: DataFrame, vector: str, size: int, centre: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sum of the vectors and sum of their outer products (after taking off ``centre``): one small matrix per task."""
    shift = np.zeros(size) if centre is None else centre

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size + 1, size))
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, size) - shift
            total[0] += x.sum(axis=0)
            total[1:] += x.T @ x
        yield pa.RecordBatch.from_pydict({"i": pa.array(range(size + 1), pa.int32()), "row": pa.array(list(total), pa.list_(pa.float64()))})

    parts = rows.select(vector).mapInArrow(run, "i int, row array<double>").groupBy("i").agg(vector_to_array(Summarizer.sum(array_to_vector("row"))).alias("row"))
    found = np.array([r["row"] for r in sorted(parts.collect())]).reshape(-1, size)
    return (found[0], found[1:]) if len(found) else (np.zeros(size), np.zeros((size, size)))


def span(gram: np.ndarray) -> np.ndarray:
    """The small matrix that makes vectors of these products orthonormal; directions within rounding of the others go."""
    e, v = np.linalg.eigh(gram)
    keep = e > max(e.max(initial=0), 0) * 1e-12
    return v[:, keep] / np.sqrt(e[keep])


def orthonormal(table: DataFrame, size: int) -> np.ndarray:
    """The small matrix that makes the column vectors of a table of short rows orthonormal; directions within rounding of the
    others go."""
    return span(moments(table, "z", size)[1])


def turned(vector: str, turn: np.ndarray, shift: np.ndarray | None = None) -> Column:
    """A short row times a small matrix, less ``shift``."""
    parts = [reduce(lambda a, b: a + b, [F.get(vector, i) * float(x) for i, x in enumerate(c)]) for c in turn.T]
    if shift is not None:
        parts = [p - float(x) for p, x in zip(parts, shift)]
    return F.array(*parts).cast("array<double>")


def sliced(cells: DataFrame, numbers: DataFrame) -> DataFrame:
    """Cells packed by ranges of columns, written: the number of the first column, the names of all of them, how many cells each has, and
    the rows and values of the cells. A column is never cut."""
    if numbers.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        numbers = F.broadcast(numbers)
    met = cells.join(numbers.select(F.col("id").alias("_id"), "row"), F.col("id").eqNullSafe(F.col("_id")))
    met = met.select("column", F.col("row").cast("int").alias("row"), F.col("value").cast("double").alias("value"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number, held, size, need = TaskContext.get().partitionId(), 0, [], 0, SLICE_CELLS

        def packed(found: pa.DictionaryArray, rows: pa.Table, sizes: np.ndarray) -> pa.RecordBatch:
            names = found.dictionary[: len(sizes)].cast(pa.string())
            value = np.ascontiguousarray(rows["value"].to_numpy().view(np.uint8).reshape(-1, 8).T)
            data = [planes(sizes), planes(rows["row"].to_numpy()), value.tobytes()]
            names = pa.ListArray.from_arrays(pa.array([0, len(names)], pa.int32()), names)
            return pa.RecordBatch.from_arrays([pa.array([(task << 32) + number], pa.int64()), names, *(pa.array([x], pa.binary()) for x in data)], SLICE_NAMES)

        for batch in chain(batches, [None]):  # a last turn without a batch
            if batch is not None:
                held.append(batch)
                size += len(batch)
            if size >= need or batch is None and size:
                rows = pa.Table.from_batches(held)
                found = rows["column"].combine_chunks().dictionary_encode()
                found = found.combine_chunks() if isinstance(found, pa.ChunkedArray) else found
                sizes = np.bincount(found.indices.to_numpy())  # in order, as the rows are sorted
                whole = len(sizes) - (batch is not None)  # the last column may go on
                done = int(sizes[:whole].sum())
                if whole:
                    yield packed(found, rows.slice(0, done), sizes[:whole])
                number, held, size = number + whole, rows.slice(done).to_batches(), size - done
                need = max(SLICE_CELLS, 2 * size)

    return written(met.repartition("column").sortWithinPartitions("column").mapInArrow(run, SLICES), "range")


def slices_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    """Names, sizes of the columns, rows and values of each range."""
    for batch in batches:
        for i in range(len(batch)):
            sizes, row, value = (batch[c][i].as_py() for c in ("sizes", "rows", "data"))
            value = np.ascontiguousarray(np.frombuffer(value, np.uint8).reshape(8, -1).T).view("<f8").ravel()
            yield batch["names"][i].values, opened(sizes), opened(row), value


def vectors_of(sizes: np.ndarray, row: np.ndarray, value: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The short vectors of the columns of a range: the transposed cells times rows of ``y``."""
    first = np.cumsum(sizes) - sizes
    return np.stack([np.add.reduceat(value * y[row, k], first) for k in range(y.shape[1])], axis=1)


def passed(slices: DataFrame, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The cells times their transposed times ``y`` (rows x directions), the products of the vectors of the columns between, and
    the sum of all squares with that of the squared sums of the columns. A job takes as many directions as ``JOB_NUMBERS`` allows for the second product."""
    rows, size = y.shape
    made, gram, sums = np.zeros_like(y), None, None
    step = max(JOB_NUMBERS // max(rows, 1), 1)
    for at in range(0, size, step):
        own = slice(at, min(at + step, size))
        wide = own.stop - own.start
        part = y if not at else np.ascontiguousarray(y[:, own])  # the first job also multiplies all vectors with each other

        def run(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
            out, products, both = np.zeros((wide, rows)), np.zeros((part.shape[1],) * 2), np.zeros(2)
            for _, sizes, row, value in slices_of(batches):
                z = vectors_of(sizes, row, value, part)
                products += z.T @ z
                for k in range(wide):
                    out[k] += np.bincount(row, np.repeat(z[:, k], sizes) * value, rows)
                both += [value @ value, (np.add.reduceat(value, np.cumsum(sizes) - sizes) ** 2).sum()]
            return np.concatenate([both, products.ravel(), out.ravel()])

        wide_part = part.shape[1]
        found = added(slices, run, 2 + wide_part**2 + wide * rows)
        made[:, own] = found[2 + wide_part**2 :].reshape(wide, rows).T
        if not at:
            gram, sums = found[2 : 2 + wide_part**2].reshape(wide_part, -1), found[:2]
    return made, gram, sums


def leading(products: np.ndarray, offset: np.ndarray, n: float, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Axes and variances from the products of the centred projections. The sign of an axis: its entries add up to a positive
    number, as far as the projection of the mean tells."""
    e, v = np.linalg.eigh(products / max(n - 1, 1))
    order = np.argsort(-e)[:k]
    return v[:, order] * np.where(offset @ v[:, order] < 0, -1, 1), e[order]


def fit(cells: DataFrame, ids: DataFrame, k: int = 2, passes: int = 2, extra: int = EXTRA, seed: int = 1) -> SparseAxes:
    """Axes of the rows ``ids`` (id), given as cells (id, column, value), each (id, column) once; absent cells are 0. The cells are
    read once."""
    size = k + extra
    numbers = written(dense_position(ids.groupBy("id").agg(F.count(F.lit(1)).alias("m")), ["id"], "row"), "rows")
    if numbers.count() * size > ROW_NUMBERS:
        return fit_joined(cells, ids, k, passes, extra, seed)
    own = numbers.select("row", "m", F.xxhash64("id").alias("h")).orderBy("row").toArrow()
    n, rows = float(sum(own["m"].to_pylist())), len(own)
    slices = sliced(cells, numbers).coalesce(ids.sparkSession.sparkContext.defaultParallelism)  # each task gives sums of all rows
    none = ids.sparkSession.createDataFrame([], "column string, axis array<double>")
    y, total = gaussians(own["h"].to_numpy(), size, seed) if rows else np.zeros((0, size)), 0.0
    for _ in range(max(passes, 1) + 1):  # the directions of the rows stand for half a pass
        # Centring takes the mean of the products off every row, and the rows then add up to 0.
        y = np.asarray(y - y.sum(axis=0) / max(n, 1), np.float64)
        made, gram, (squares, columns) = passed(slices, y)
        turn = span(gram)
        if not turn.shape[1]:  # no rows, or all alike
            return SparseAxes(none, np.zeros(0), np.zeros(0), 0.0)
        before, y, total = y, made @ turn, squares - columns / n
    centre = y.sum(axis=0) / n
    last, variances = leading((y - centre).T @ (y - centre) + (n - rows) * np.outer(centre, centre), centre, n, k)
    weight = before @ (turn @ last)

    def axes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for names, sizes, row, value in slices_of(batches):
            z = vectors_of(sizes, row, value, weight)
            for at in range(0, len(z), AXIS_ROWS):
                part = z[at : at + AXIS_ROWS]
                lists = pa.FixedSizeListArray.from_arrays(pa.array(part.ravel()), part.shape[1]).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([names[at : at + AXIS_ROWS], lists], names=["column", "axis"])

    return SparseAxes(slices.mapInArrow(axes, "column string, axis array<double>"), centre @ last, variances, float(total) / max(n - 1, 1))


def fit_joined(cells: DataFrame, ids: DataFrame, k: int = 2, passes: int = 2, extra: int = EXTRA, seed: int = 1) -> SparseAxes:
    """``fit`` for more rows than the driver may hold vectors of: the vectors of rows and of columns stay tables, which are joined with the cells."""
    size = k + extra
    n = float(ids.count())
    cells = written(cells.select("id", "column", F.col("value").cast("double").alias("value")), "cells")

    def directions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            g = gaussians(batch.column("h").to_numpy(), size, seed)
            z = pa.FixedSizeListArray.from_arrays(pa.array(g.ravel()), size).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("column"), z], names=["column", "z"])

    # Columns get numbers once, so that the passes neither shuffle nor compare names.
    names = cells.groupBy("column").agg((F.sum("value") / n).alias("mean"), F.sum(F.col("value") ** 2).alias("sq"))
    names = written(names.withColumn("number", F.monotonically_increasing_id()), "columns")
    total = names.agg(F.sum(F.col("sq") - n * F.col("mean") ** 2).alias("t")).first()["t"] or 0.0
    cells = written(cells.join(names.select("column", "number"), "column").select("id", F.col("number").alias("column"), "value"), "numbered")
    basis = names.select(F.col("number").alias("column"), F.xxhash64("column").alias("h")).mapInArrow(directions, "column bigint, z array<double>")
    turn = np.eye(size)
    for _ in range(max(passes, 1)):
        # The vectors of the columns are ``z`` times ``turn``, which is left to the rows. Centring takes the mean of the
        # products off every row, and the rows then add up to 0.
        y = written(dotted(cells, basis, "z", size), "products")
        shift = moments(y, "y", size)[0] / n @ turn
        y = y.select("id", turned("y", turn, shift).alias("y"))
        # Rows without cells lie at minus the shift; they add nothing to the products with the cells.
        size = turn.shape[1]
        basis = written(cells.join(y, "id").groupBy("column").agg(summed("value", "y", size).alias("z")), "range")
        turn = orthonormal(basis, size)
        if not turn.shape[1]:  # no rows, or all alike
            none = names.limit(0).select("column", F.array().cast("array<double>").alias("axis"))
            return SparseAxes(none, np.zeros(0), np.zeros(0), 0.0)
    y = written(dotted(cells, basis, "z", size), "products")
    centre = moments(y, "y", size)[0] / n
    _, products = moments(y, "y", size, centre)
    products = turn.T @ (products + (n - y.count()) * np.outer(centre, centre)) @ turn
    offset = centre @ turn
    last, variances = leading(products, offset, n, k)
    axes = basis.select(F.col("column").alias("number"), turned("z", turn @ last).alias("axis")).join(names.select("number", "column"), "number")
    return SparseAxes(written(axes.select("column", "axis"), "axes"), offset @ last, variances, float(total) / max(n - 1, 1))
