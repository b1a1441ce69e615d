"""Logistic models of many labels, fitted together: one aggregation an iteration serves all labels, weights and bags.

The training rows are packed once into blocks of a few thousand rows, their cells in column order, and written. An iteration
sends the coefficients of all models to the tasks; every task adds up the losses and gradients (and, for few features, the
second derivatives) of all models over its blocks, and Spark adds up the tasks. Each model follows its own Newton or
L-BFGS path with its own step lengths, so one slow label costs passes but no extra jobs, and a finished one drops out.

Where the rows and the history of one model fit into ``HELD_BYTES``, each model follows that path in a task of its own, on the same blocks.

The objective of a model is |w|^2 / 2 + C sum_i s_i loss_i with an intercept outside |w|. The driver holds the coefficients,
features x models, and a few copies of them: MAX_COEFFICIENTS is checked.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.session import written

BLOCK_ROWS = 4096
BLOCK_CELLS = 1 << 20
MAX_COEFFICIENTS = 1 << 24
NEWTON_CELLS = 1 << 21  # second derivatives of all models that may go to the driver
NEWTON_FEATURES = 512
HISTORY = 10
HELD_BYTES = 5 << 26  # that a task may hold to fit one model by itself
CHUNK = 1 << 16  # numbers a row of the sums holds
BLOCK_SCHEMA = "n int, columns binary, starts binary, row binary, value binary, y binary, copies binary, only binary"


@dataclass
class LinearModel:
    coefficients: DenseVector
    intercept: float
    slope: float = 0.0  # largest absolute entry of the gradient, over the sum of the weights
    passes: int = 0


def stored(column: str) -> list[Column]:
    """An MLlib vector as the columns size, indices (null if dense) and values."""
    v = F.unwrap_udt(F.col(column))
    return [v["indices"].alias("indices"), v["values"].alias("values")]


def flat_lists(lists: pa.Array, kind) -> tuple[np.ndarray, np.ndarray]:
    """All items on end, and the number of items of each list; null lists are empty."""
    lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    return lists.flatten().to_numpy(zero_copy_only=False).astype(kind), lengths


def cells_of(indices: pa.Array, values: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, column and value of every cell; rows without indices are dense."""
    val, counts = flat_lists(values, np.float64)
    row = np.repeat(np.arange(len(counts)), counts)
    col = np.arange(len(val)) - np.repeat(np.cumsum(counts) - counts, counts)
    idx, some = flat_lists(indices, np.int64)
    given = np.repeat(indices.is_valid().to_numpy(zero_copy_only=False), counts)
    if given.any():
        if some.sum() != given.sum():
            raise ValueError("indices and values differ in length")
        col[given] = idx
    return row, col, val


def pack(rows: DataFrame) -> DataFrame:
    """Blocks of (features, y array<tinyint>, copies array<tinyint>, only int), written to the shared folder."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("values").value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            ends, at = np.cumsum(sizes), 0
            while at < len(sizes):
                done = ends[at - 1] if at else 0
                to = max(at + 1, min(int(np.searchsorted(ends, done + BLOCK_CELLS, "right")), at + BLOCK_ROWS))
                part = batch.slice(at, to - at)
                row, col, val = cells_of(part.column("indices"), part.column("values"))
                order = np.argsort(col, kind="stable")
                row, col, val = row[order], col[order], val[order]
                first = np.flatnonzero(np.r_[True, col[1:] != col[:-1]][: len(col)])
                y, copies = (flat_lists(part.column(c), np.uint8)[0] for c in ("y", "copies"))
                only = part.column("only").to_numpy(zero_copy_only=False).astype(np.int32)
                cells = [col[first].astype(np.int32), np.r_[first, len(col)].astype(np.int32), row.astype(np.int32), val, y, copies, only]
                yield pa.RecordBatch.from_pydict({"n": pa.array([to - at], pa.int32()), **{
                    name.split()[0]: pa.array([x.tobytes()], pa.binary()) for name, x in zip(BLOCK_SCHEMA.split(", ")[1:], cells)}})
                at = to

    # Dealt out first: every pass has as many tasks as there are files, and small inputs arrive in one partition.
    cores = rows.sparkSession.sparkContext.defaultParallelism
    dealt = rows.select(*stored("features"), "y", "copies", "only").repartition(cores)
    return written(dealt.mapInArrow(run, BLOCK_SCHEMA), "blocks")


class Block:
    """A packed block with its targets (rows x labels) and weights before class weights (rows x models)."""

    def __init__(self, parts: dict, labels: int, bags: int):
        get = lambda name, kind: np.frombuffer(parts[name], kind)
        self.n = parts["n"]
        self.columns, self.starts = get("columns", np.int32), get("starts", np.int32)
        self.row, self.value = get("row", np.int32), get("value", np.float64)
        self.y = get("y", np.uint8).reshape(self.n, labels).astype(np.float64)
        copies = get("copies", np.uint8).reshape(self.n, bags).astype(np.float64)
        only = get("only", np.int32)
        self.mask = (only[:, None] < 0) | (only[:, None] == np.arange(labels))
        self.weight = (self.mask[:, :, None] * copies[:, None, :]).reshape(self.n, labels * bags)
        self.dense = None

    def matrix(self, features: int) -> np.ndarray | None:
        """The block as a dense matrix where that takes at most twice the room of its cells."""
        if self.dense is None and self.n * features <= 2 * len(self.value):
            self.dense = np.zeros((self.n, features))
            self.dense[self.row, np.repeat(self.columns, np.diff(self.starts))] = self.value
        return self.dense

    def times(self, w: np.ndarray) -> np.ndarray:
        """X w, for w of features x models."""
        if (x := self.matrix(len(w))) is not None:
            return x @ w
        each = np.diff(self.starts)
        return np.stack([np.bincount(self.row, self.value * np.repeat(w[self.columns, m], each), self.n) for m in range(w.shape[1])], axis=1)

    def add_products(self, r: np.ndarray, out: np.ndarray) -> None:
        """out += X^T r."""
        if (x := self.matrix(len(out))) is not None:
            out += x.T @ r
        elif len(self.value):
            for m in range(r.shape[1]):
                out[self.columns, m] += np.add.reduceat(self.value * np.ascontiguousarray(r[:, m])[self.row], self.starts[:-1])


def blocks_of(batches: Iterator[pa.RecordBatch], labels: int, bags: int) -> Iterator[Block]:
    for batch in batches:
        for i in range(len(batch)):
            yield Block({name: batch.column(name)[i].as_py() for name in batch.schema.names}, labels, bags)


def added(blocks: DataFrame, run, size: int) -> np.ndarray:
    """Sum over all tasks of the vectors of ``size`` numbers that ``run`` returns for the blocks of a task."""
    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = run(batches)
        for k, at in enumerate(range(0, size, CHUNK)):
            yield pa.RecordBatch.from_pydict({"k": pa.array([k], pa.int32()), "x": pa.array([total[at : at + CHUNK]], pa.list_(pa.float64()))})

    sums = blocks.mapInArrow(parts, "k int, x array<double>").groupBy("k").agg(vector_to_array(Summarizer.sum(array_to_vector("x"))).alias("x"))
    found = sums.toArrow().sort_by("k").column("x").combine_chunks()  # ``size`` numbers
    return found.flatten().to_numpy() if len(found) else np.zeros(size)


@dataclass
class Fit:
    """What all passes share: numbers of labels, bags and features, and the class weights (2 x labels: of zeros, of ones)."""

    blocks: DataFrame
    labels: int
    bags: int
    features: int
    class_weight: np.ndarray

    def summed(self, run, size: int) -> np.ndarray:
        """Sum over all tasks of the vectors of ``size`` numbers that ``run`` returns for their blocks."""
        labels, bags = self.labels, self.bags
        return added(self.blocks, lambda batches: run(blocks_of(batches, labels, bags)), size)

    def evaluate(self, w: np.ndarray, active: np.ndarray, second: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Losses, gradients and, if asked for, second derivatives of the ``active`` models at ``w`` (features + 1, models), without
        the squares of the coefficients."""
        bags, features, class_weight = self.bags, self.features, self.class_weight
        m, p = len(active), features + 1
        shape = (m, p, p) if second else (0,)
        size = m + p * m + int(np.prod(shape))
        w = w if m == w.shape[1] else w[:, active]  # every task holds the coefficients and one vector of sums, without copies

        def run(blocks: Iterator[Block]) -> np.ndarray:
            total = np.zeros(size)
            loss, slope, curve = total[:m], total[m : m + p * m].reshape(p, m), total[m + p * m :].reshape(shape)
            for block in blocks:
                y = block.y[:, active // bags]
                s = block.weight[:, active] * np.where(y > 0, class_weight[1, active // bags], class_weight[0, active // bags])
                z = block.times(w[:-1]) + w[-1]
                loss += (s * (np.logaddexp(0, z) - y * z)).sum(axis=0)
                prob = 1 / (1 + np.exp(-np.clip(z, -700, 700)))
                r = s * (prob - y)
                block.add_products(r, slope[:-1])
                slope[-1] += r.sum(axis=0)
                if second:
                    x = block.matrix(features)
                    if x is None:
                        x = np.zeros((block.n, features))
                        x[block.row, np.repeat(block.columns, np.diff(block.starts))] = block.value
                    x = np.concatenate([x, np.ones((block.n, 1))], axis=1)
                    for k in range(m):
                        curve[k] += (x * (s[:, k] * prob[:, k] * (1 - prob[:, k]))[:, None]).T @ x
            return total

        out = self.summed(run, size)
        return out[:m], out[m : m + p * m].reshape(p, m), out[m + p * m :].reshape(shape)


def minimise(fit: Fit, total: np.ndarray, fixed: np.ndarray, c: float, max_iter: int, tol: float) -> tuple[np.ndarray, np.ndarray, int]:
    """Coefficients (features + 1, models) that minimise the objectives, their scaled slopes, and the number of passes.

    ``total`` is the sum of the weights of each model: a model is finished when no slope exceeds ``tol`` times it. Models in
    ``fixed`` are left at 0."""
    p, m = fit.features + 1, len(total)
    second = fit.features <= NEWTON_FEATURES and m * p * p <= NEWTON_CELLS
    ridge = np.ones((p, 1))
    ridge[-1] = 0
    dot = lambda a, b: np.einsum("ij,ij->j", a, b)
    w, value, slope = np.zeros((p, m)), np.full(m, np.inf), np.zeros((p, m))
    move, step = np.zeros((p, m)), np.ones(m)
    left, worst = ~fixed, np.full(m, np.inf)
    history: list[tuple] = []
    scale, passes = np.ones(m), 0
    while left.any() and passes <= max_iter:
        active = np.flatnonzero(left)
        trial = w[:, active] + step[active] * move[:, active]
        full = np.zeros((p, m))
        full[:, active] = trial
        loss, g, curve = fit.evaluate(full, active, second)
        passes += 1
        loss, g = c * loss + dot(ridge * trial, trial) / 2, c * g + ridge * trial
        good = (loss <= value[active] + 1e-4 * step[active] * dot(slope[:, active], move[:, active])) | (loss - value[active] <= 1e-12 * np.abs(loss))
        took = active[good]
        still = value[took] - loss[good] <= 1e-14 * np.abs(loss[good])
        if not second:
            s, y = np.zeros((p, m)), np.zeros((p, m))
            s[:, took], y[:, took] = trial[:, good] - w[:, took], g[:, good] - slope[:, took]
            curved = dot(s, y)
            use = np.isin(np.arange(m), took) & (curved > 1e-12 * dot(y, y)) & np.isfinite(value)
            rate = np.where(use, 1 / np.where(use, curved, 1), 0)  # a rate of 0 leaves a model's direction alone
            scale = np.where(use, curved / np.where(use, dot(y, y), 1), scale)
            if use.any():
                history = [*history[-HISTORY + 1 :], (s, y, rate)]
        first = np.isinf(value[took])
        w[:, took], value[took], slope[:, took] = trial[:, good], loss[good], g[:, good]
        step[active[~good]] /= 2
        before, worst = worst, np.abs(slope).max(axis=0) / np.maximum(c * total, 1e-300)
        left[took] = (worst[took] > tol) & ~(still & (worst[took] > before[took] / 2))
        left &= step > 1e-10  # where values and slopes no longer fall, what is left is rounding
        if second:
            eye = np.diag(ridge[:, 0] + 1e-12)
            for k, j in zip(np.flatnonzero(good), took):
                move[:, j] = -np.linalg.solve(c * curve[k] + eye, g[:, k])
            step[took] = 1
        elif len(took):
            q, kept = slope[:, took].copy(), []
            pick = (lambda x: x) if len(took) == m else (lambda x: x[:, took])  # no copies where all models took their step
            for s, y, rate in reversed(history):
                a = rate[took] * dot(pick(s), q)
                q -= a * pick(y)
                kept.append(a)
            q *= scale[took]
            for (s, y, rate), a in zip(history, reversed(kept)):
                q += pick(s) * (a - rate[took] * dot(pick(y), q))
            uphill = dot(q, slope[:, took]) <= 0
            q[:, uphill] = slope[:, took][:, uphill]
            move[:, took] = -q
            step[took] = np.where(first, 1 / np.maximum(np.sqrt(dot(q, q)), 1e-300), 1)
    return w, np.where(fixed, 0, worst), passes


class HeldFit(Fit):
    """The same of blocks that one task holds."""

    def summed(self, run, size: int) -> np.ndarray:
        return run(iter(self.blocks))


def own_block(block: Block, parts: dict, label: int, bags: int, bag: int) -> dict | None:
    """The rows of a block that count for one model, as a block of one label and one bag."""
    keep = block.weight[:, label * bags + bag] > 0
    if not keep.any():
        return None
    out = {**parts, "n": int(keep.sum()), "y": block.y[keep, label].astype(np.uint8).tobytes(), "copies": block.weight[keep, label * bags + bag].astype(np.uint8).tobytes(),
           "only": np.full(int(keep.sum()), -1, np.int32).tobytes()}
    if not keep.all():
        held = keep[block.row]
        at = np.repeat(block.columns, np.diff(block.starts))[held]
        first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]][: len(at)])
        out |= {"columns": at[first].tobytes(), "starts": np.r_[first, len(at)].astype(np.int32).tobytes(),
                "row": (np.cumsum(keep) - 1)[block.row[held]].astype(np.int32).tobytes(), "value": block.value[held].tobytes()}
    return out


def minimise_in_tasks(fit: Fit, total: np.ndarray, fixed: np.ndarray, c: float, max_iter: int, tol: float) -> tuple[np.ndarray, np.ndarray, int]:
    """``minimise`` with a task for each model, which holds the rows that count for it: no job and no sums of all coefficients a pass."""
    labels, bags, features, class_weight = fit.labels, fit.bags, fit.features, fit.class_weight
    wanted = np.flatnonzero(~fixed)
    w, slopes, passes = np.zeros((features + 1, len(total))), np.zeros(len(total)), 0
    if not len(wanted):
        return w, slopes, passes
    names = [part.split()[0] for part in BLOCK_SCHEMA.split(", ")]
    kinds = [pa.int32(), *[pa.binary()] * (len(names) - 1)]

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                parts = {name: batch.column(name)[i].as_py() for name in names}
                block = Block(parts, labels, bags)
                for at, model in enumerate(wanted):
                    if own := own_block(block, parts, model // bags, bags, model % bags):
                        yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), *(pa.array([own[n]], k) for n, k in zip(names, kinds))], ["model", *names])

    def solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[Block]] = {}
        for batch in batches:
            for i in range(len(batch)):
                held.setdefault(batch.column("model")[i].as_py(), []).append(Block({n: batch.column(n)[i].as_py() for n in names}, 1, 1))
        for at in sorted(held):
            model = wanted[at]
            own = HeldFit(held.pop(at), 1, 1, features, class_weight[:, [model // bags]])
            x, slope, passes = minimise(own, total[[model]], fixed[[model]], c, max_iter, tol)
            yield pa.RecordBatch.from_pydict({"model": pa.array([model], pa.int32()), "w": pa.array([x[:, 0].tobytes()], pa.binary()),
                                              "slope": pa.array([float(slope[0])]), "passes": pa.array([passes], pa.int32())})

    sent = fit.blocks.mapInArrow(dealt, f"model int, {BLOCK_SCHEMA}").repartitionById(len(wanted), "model")
    found = written(sent.mapInArrow(solved, "model int, w binary, slope double, passes int"), "coefficients")
    for r in found.toLocalIterator():
        w[:, r["model"]], slopes[r["model"]], passes = np.frombuffer(r["w"]), r["slope"], max(passes, r["passes"])
    return w, slopes, passes


def fit_logistic(rows: DataFrame, labels: int, features: int, bags: int = 1, class_weight: str | None = None, C: float = 1.0,
                 max_iter: int = 1000, tol: float = 1e-7) -> list[list[LinearModel]]:
    """One list of ``bags`` models per label, from rows (features, y array<tinyint> by label, copies array<tinyint> by bag, only int:
    the label a row is for, or -1 for all).

    A model without a positive or without a negative row is constant: coefficients 0 and an infinite intercept.
    """
    if class_weight not in (None, "balanced"):
        raise ValueError(f"unknown class_weight {class_weight!r}")
    models = labels * bags
    if (features + 1) * models > MAX_COEFFICIENTS:
        raise ValueError(f"{features} features x {models} models are too many for the driver")
    blocks = pack(rows)

    def counted(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        rows, drawn, cells = np.zeros((2, labels)), np.zeros((2, models)), np.zeros(labels)
        for block in blocks_of(batches, labels, bags):
            cells += np.bincount(block.row, minlength=block.n) @ block.mask
            rows += [block.mask.sum(axis=0), (block.mask * block.y).sum(axis=0)]
            drawn += [block.weight.sum(axis=0), (block.weight * np.repeat(block.y, bags, axis=1)).sum(axis=0)]
        return np.concatenate([rows.ravel(), drawn.ravel(), cells])

    sums = added(blocks, counted, 3 * labels + 2 * models)
    (n, pos), (drawn, ones), cells = sums[: 2 * labels].reshape(2, labels), sums[2 * labels : -labels].reshape(2, models), sums[-labels:]
    weight = np.ones((2, labels))
    if class_weight == "balanced":
        both = (pos > 0) & (pos < n)
        weight[0, both], weight[1, both] = (n / (2 * np.maximum(n - pos, 1)))[both], (n / (2 * np.maximum(pos, 1)))[both]
    fixed = (ones == 0) | (ones == drawn)
    total = (drawn - ones) * np.repeat(weight[0], bags) + ones * np.repeat(weight[1], bags)
    # What a task needs for one model: cells of 12 bytes, numbers of the rows, and the history with some more vectors of its size.
    small = 12 * cells.max(initial=0) + 32 * n.max(initial=0) + 8 * (2 * HISTORY + 12) * (features + 1) <= HELD_BYTES
    w, slopes, passes = (minimise_in_tasks if small else minimise)(Fit(blocks, labels, bags, features, weight), total, fixed, C, max_iter, tol)
    w[-1, fixed] = np.where(ones[fixed] > 0, np.inf, -np.inf)
    found = [LinearModel(DenseVector(w[:-1, k]), float(w[-1, k]), float(slopes[k]), passes) for k in range(models)]
    return [found[k * bags : (k + 1) * bags] for k in range(labels)]


def margins(column: str, models: list[LinearModel]) -> Column:
    """array<double>: the margin of every model for an MLlib vector, all models in one look at it."""
    w = np.stack([m.coefficients.toArray() for m in models], axis=1)
    b = np.array([m.intercept for m in models])

    @F.arrow_udf("array<double>")
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for indices, values in batches:
            out, step = [], max(1, BLOCK_CELLS // max(len(w), 1) if indices.null_count else BLOCK_ROWS)
            for at in range(0, len(values), step):
                row, col, val = cells_of(indices.slice(at, step), values.slice(at, step))
                n = len(values.slice(at, step))
                z = np.stack([np.bincount(row, val * w[col, k], n) for k in range(len(b))], axis=1) + b
                out.append(pa.FixedSizeListArray.from_arrays(pa.array(z.ravel()), len(b)).cast(pa.list_(pa.float64())))
            yield pa.concat_arrays(out) if out else pa.array([], pa.list_(pa.float64()))

    return run(*stored(column))
