"""Random forests of dense rows whose nodes never sit on the driver.

Rows are coded once as one byte a feature. Nodes of many rows are split by histograms, a pass over the rows per level of all
trees; the rows of a node of at most ``LOCAL_ROWS`` rows go to one task, which grows the rest of its tree there. Each tree so
shuffles a row once, and the subtrees stay in a table. Rows to score meet the subtrees in the same way. As in MLlib there are
32 bins a feature, cut at the quantiles of 10,000 rows, bootstrap weights are Poisson, every node looks at a random subset of
the features, and a node where none of them lowers the impurity is a leaf.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.session import written

BINS = 32
CUT_ROWS = 10_000  # rows that the cuts of the features are taken from, as in MLlib
MAX_FEATURES = 256  # wider rows are left to MLlib
LOCAL_ROWS = 1 << 14  # rows of a node that one task may hold
SCORED_ROWS = 1 << 17  # rows that may meet one subtree at once
OPEN_NODES = 1 << 12  # nodes that one pass may split
KEYS = 1 << 21
STEPS = np.array(list(accumulate(math.exp(-1) / math.factorial(k) for k in range(18))))  # cumulative Poisson(1)
CODED = "h long, bins binary, y tinyint, w double"
SPLIT = "slot int, feature int, cut int, gain double, w0 double, w1 double, l0 double, l1 double, ln double, n double"
SUBTREE = "node int, feature binary, cut binary, left binary, value binary, gains array<double>"


def cuts_of(rows: DataFrame) -> list[np.ndarray]:
    """At most 31 cuts a feature; a value up to a cut lies on its left."""
    first = rows.select(F.col("h"), vector_to_array("features").alias("x")).orderBy("h").limit(CUT_ROWS).select("x").toArrow()["x"].combine_chunks()
    x = first.flatten().to_numpy(zero_copy_only=False).reshape(len(first), -1)
    cuts = []
    for column in x.T:
        values = np.unique(column[~np.isnan(column)])
        if len(values) > BINS:
            cuts.append(np.unique(np.quantile(column[~np.isnan(column)], np.arange(1, BINS) / BINS)))
        else:
            cuts.append(values[:-1] + (values[1:] - values[:-1]) / 2)
    return cuts


def coder(cuts: list[np.ndarray]):
    @F.arrow_udf("binary")
    def code(x: pa.Array) -> pa.Array:
        values = x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), len(cuts))
        return packed(np.stack([np.searchsorted(c, values[:, j]) for j, c in enumerate(cuts)], axis=1).astype(np.uint8))

    return code


def packed(matrix: np.ndarray) -> pa.Array:
    ends = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.Array.from_buffers(pa.binary(), len(matrix), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(matrix))])


def matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.binary())
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]].reshape(len(column), width)


def numbers(table, *names: str) -> list[np.ndarray]:
    return [table[name].to_numpy() if isinstance(table[name], pa.ChunkedArray) else table[name].to_numpy(zero_copy_only=False) for name in names]


def copies(h: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often each row is drawn for a tree: the same on every rerun."""
    x = h.astype(np.int64).view(np.uint64) + np.uint64((seed * 0xD1342543DE82EF95 + (tree + 1) * 0x9E3779B97F4A7C15) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return np.searchsorted(STEPS, (x >> np.uint64(11)) * 2.0**-53, side="right")


@dataclass
class Nodes:
    """A node that is split has its left child's number in ``left`` and its right child's after it."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray

    def descend(self, bins: np.ndarray, root: int) -> np.ndarray:
        node = np.full(len(bins), root)
        rows = np.arange(len(bins))
        while True:
            rows = rows[self.left[node[rows]] >= 0]
            if not len(rows):
                return node
            at = node[rows]
            node[rows] = self.left[at] + (bins[rows, self.feature[at]] > self.cut[at])


def best_splits(keys: np.ndarray, w0: np.ndarray, w1: np.ndarray, m: int, nodes: int):
    """The split of least impurity of each node, from its occupied bins: ``keys`` are (node * m + feature) * BINS + bin, rising.
    Returns (places in keys, gain, weights on the left by class), place -1 where no split gains."""
    group = keys // BINS
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    sizes = np.diff(np.r_[first, len(keys)])
    sums = []
    for w in (w0, w1):
        total = np.cumsum(w)
        sums.append((total - np.repeat(total[first] - w[first], sizes), np.repeat(np.add.reduceat(w, first), sizes)))
    (l0, t0), (l1, t1) = sums
    r0, r1 = t0 - l0, t1 - l1
    open_ = np.r_[group[1:] == group[:-1], False]
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = 2 * (t0 * t1 / (t0 + t1) - l0 * l1 / (l0 + l1) - r0 * r1 / (r0 + r1))
    gain = np.where(open_ & (gain > 1e-9 * (t0 + t1)), gain, 0.0)
    node = group // m
    start = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
    most = np.maximum.reduceat(gain, start)
    hit = np.flatnonzero((gain == np.repeat(most, np.diff(np.r_[start, len(keys)]))) & (gain > 0))
    place = np.full(nodes, -1)
    place[node[hit[::-1]]] = hit[::-1]  # the first of equal ones
    return place, gain, l0, l1


def subset(rng: np.random.Generator, nodes: int, d: int, m: int) -> np.ndarray:
    return np.sort(np.argpartition(rng.random((nodes, d)), m - 1, axis=1)[:, :m], axis=1) if m < d else np.tile(np.arange(d), (nodes, 1))


def grow(bins: np.ndarray, y: np.ndarray, w: np.ndarray, levels: int, m: int, rng: np.random.Generator):
    """A whole tree of rows that one task holds, level by level: (feature, cut, left, share of class 1, gain by feature)."""
    d = bins.shape[1]
    w1 = np.where(y == 1, w, 0.0)
    w0 = w - w1
    feature, cut, left, value, gains = [], [], [], [], np.zeros(d)
    rows, at, nodes, made = np.arange(len(bins)), np.zeros(len(bins), np.int64), 1, 1
    while nodes:
        t0, t1 = np.bincount(at, w0[rows], nodes), np.bincount(at, w1[rows], nodes)
        value.append(t1 / (t0 + t1))
        f, c, l = np.full(nodes, -1, np.int32), np.zeros(nodes, np.int32), np.full(nodes, -1, np.int32)
        mixed = (t0 > 0) & (t1 > 0) & (len(value) <= levels)
        feature.append(f), cut.append(c), left.append(l)
        if not mixed.any():
            break
        keep = mixed[at]
        number = np.cumsum(mixed) - 1
        rows, at = rows[keep], number[at[keep]]
        tried = subset(rng, int(mixed.sum()), d, m)
        keys = ((at[:, None] * m + np.arange(m)) * BINS + bins[rows[:, None], tried[at]]).ravel()
        cells = len(tried) * m * BINS
        if cells <= 4 * len(keys):
            seen, place = np.flatnonzero(np.bincount(keys, minlength=cells)), keys
        else:
            seen, place = np.unique(keys, return_inverse=True)
        s0, s1 = (np.bincount(place, np.repeat(x[rows], m)) for x in (w0, w1))
        if cells <= 4 * len(keys):
            s0, s1 = s0[seen], s1[seen]
        best, gain, _, _ = best_splits(seen, s0, s1, m, len(tried))
        split = best >= 0
        key = seen[best[split]]
        of = np.flatnonzero(mixed)[split]
        f[of] = tried[key // BINS // m, key // BINS % m]
        c[of] = key % BINS
        l[of] = made + 2 * np.arange(len(of))
        np.add.at(gains, f[of], gain[best[split]])
        keep = split[at]
        rows, at = rows[keep], np.flatnonzero(mixed)[at[keep]]
        at = l[at] - made + (bins[rows, f[at]] > c[at])
        nodes = 2 * len(of)
        made += nodes
    return np.concatenate(feature), np.concatenate(cut), np.concatenate(left), np.concatenate(value), gains


@dataclass
class Forest:
    """The upper nodes of all trees (the first ones are the roots), and a table of the subtrees below them."""

    cuts: list[np.ndarray]
    trees: int
    top: Nodes
    value: np.ndarray  # of the upper leaves; NaN where the node is split or has a subtree
    tree: np.ndarray
    gains: np.ndarray  # by tree and feature, of the upper nodes
    subtrees: DataFrame

    @property
    def featureImportances(self) -> np.ndarray:  # noqa: N802  (MLlib's name)
        """Gain by feature, each tree scaled to 1."""
        gains, tree = self.gains.copy(), F.get(F.lit(self.tree.tolist()), F.col("node"))
        cells = self.subtrees.select(tree.alias("tree"), F.posexplode("gains").alias("feature", "gain"))
        for r in cells.groupBy("tree", "feature").agg(F.sum("gain").alias("gain")).collect():  # trees x features
            gains[r["tree"], r["feature"]] += r["gain"]
        total = gains.sum(axis=1, keepdims=True)
        gains = np.divide(gains, total, out=np.zeros_like(gains), where=total > 0).sum(axis=0)
        return gains / (gains.sum() or 1.0)

    def score(self, rows: DataFrame) -> DataFrame:
        """(_row, p): parts of the sum over the trees of the share of class 1, to be added up, of rows (_row, features)."""
        top, value, trees, width = self.top, self.value, self.trees, len(self.cuts)
        coded = rows.select("_row", coder(self.cuts)(vector_to_array("features")).alias("bins"))
        pieces = -(-rows.count() // SCORED_ROWS)

        def direct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                bins = matrix(batch["bins"], width)
                p = sum(np.nan_to_num(value[top.descend(bins, t)]) for t in range(trees))
                yield pa.RecordBatch.from_arrays([batch["_row"], pa.array(p)], ["_row", "p"])

        def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                bins, (row,) = matrix(batch["bins"], width), numbers(batch, "_row")
                for t in range(trees):
                    node = top.descend(bins, t)
                    held = np.isnan(value[node])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(node[held].astype(np.int32)), pa.array((row[held] % max(pieces, 1)).astype(np.int32)), pa.array(row[held]), packed(bins[held])],
                        ["node", "piece", "_row", "bins"])

        def walk(left: pa.Table, right: pa.Table) -> pa.Table:
            if not len(left):
                return pa.table({"_row": pa.array([], pa.int64()), "p": pa.array([], pa.float64())})
            tree = right.to_pylist()[0]
            feature, cut, child = (np.frombuffer(tree[k], np.int32) for k in ("feature", "cut", "left"))
            found = Nodes(feature, cut, child).descend(matrix(left["bins"], width), 0)
            return pa.table({"_row": left["_row"], "p": np.frombuffer(tree["value"], np.float64)[found]})

        out = coded.mapInArrow(direct, "_row long, p double")
        if np.isnan(value[top.left < 0]).any():
            deal = tasks(rows.sparkSession, int(np.isnan(value[top.left < 0]).sum()) * pieces)
            below = coded.mapInArrow(routed, "node int, piece int, _row long, bins binary").repartition(deal, "node", "piece")
            known = self.subtrees.select("*", F.explode(F.sequence(F.lit(0), F.lit(max(pieces, 1) - 1))).alias("piece")).repartition(deal, "node", "piece")
            out = out.unionByName(below.groupBy("node", "piece").cogroup(known.groupBy("node", "piece")).applyInArrow(walk, "_row long, p double"))
        return out

    def save(self, path: str) -> None:
        spark = self.subtrees.sparkSession
        self.subtrees.write.parquet(f"{path}/subtrees")
        top = [x.tolist() for x in (self.top.feature, self.top.cut, self.top.left, self.value, self.tree)]
        spark.createDataFrame([([c.tolist() for c in self.cuts], self.trees, *top, self.gains.tolist())],
                              "cuts array<array<double>>, trees int, feature array<int>, cut array<int>, left array<int>, value array<double>, "
                              "tree array<int>, gains array<array<double>>").write.parquet(f"{path}/top")


def load(spark: SparkSession, path: str) -> Forest:
    r = spark.read.parquet(f"{path}/top").first()
    top = Nodes(*(np.array(r[k], np.int32) for k in ("feature", "cut", "left")))
    return Forest([np.array(c) for c in r["cuts"]], r["trees"], top, np.array(r["value"]), np.array(r["tree"], np.int32), np.array(r["gains"]),
                  spark.read.parquet(f"{path}/subtrees"))


def tasks(spark: SparkSession, groups: int) -> int:
    """Partitions for groups that cost far more time than bytes, so that adaptive coalescing must not merge them."""
    cores = spark.sparkContext.defaultParallelism
    return max(1, min(groups, max(16 * cores, groups // 16)))


def fit_forest(frame: DataFrame, n_estimators: int = 100, max_depth: int = 30, seed: int = 0, local_rows: int | None = None) -> Forest:
    """A forest for (id, features, y, w) rows, y 0 or 1; synthetic rows of one record differ in ``copy``."""
    local_rows = local_rows or LOCAL_ROWS
    keys = [c for c in ("id", "copy") if c in frame.columns]
    rows = frame.select(F.xxhash64(*keys).alias("h"), "features", "y", "w")
    cuts = cuts_of(rows)
    d, trees = len(cuts), n_estimators
    if not d:
        raise ValueError("no rows to fit a forest on")
    m = d if trees == 1 else math.ceil(math.sqrt(d))
    coded = written(rows.select("h", coder(cuts)(vector_to_array("features")).alias("bins"), F.col("y").cast("tinyint").alias("y"), F.col("w").cast("double").alias("w")), "coded")

    feature, cut, left, value = [-1] * trees, [0] * trees, [-1] * trees, [math.nan] * trees
    tree, depth, gains = list(range(trees)), [0] * trees, np.zeros((trees, d))
    open_ = list(range(trees)) if coded.count() > local_rows else []
    while open_:
        top, after = Nodes(*(np.array(x, np.int32) for x in (feature, cut, left))), []
        for i in range(0, len(open_), OPEN_NODES):
            part = open_[i : i + OPEN_NODES]
            tried = np.concatenate([subset(np.random.default_rng([seed, node]), 1, d, m) for node in part])
            found = coded.mapInArrow(histograms(top, trees, seed, d, part, tried), "slot int, cells binary") \
                .groupBy("slot").applyInArrow(chooser(tried), SPLIT).collect()  # a row per open node
            for r in sorted(found, key=lambda r: r["slot"]):
                node = part[r["slot"]]
                if r["feature"] < 0 or depth[node] >= max_depth:
                    value[node] = r["w1"] / (r["w0"] + r["w1"])
                    continue
                feature[node], cut[node], left[node] = r["feature"], r["cut"], len(left)
                gains[tree[node], r["feature"]] += r["gain"]
                for w0, w1, n in ((r["l0"], r["l1"], r["ln"]), (r["w0"] - r["l0"], r["w1"] - r["l1"], r["n"] - r["ln"])):
                    if n > local_rows:
                        after.append(len(left))
                    feature.append(-1), cut.append(0), left.append(-1), value.append(math.nan), tree.append(tree[node]), depth.append(depth[node] + 1)
        open_ = after
    top, value, tree = Nodes(*(np.array(x, np.int32) for x in (feature, cut, left))), np.array(value), np.array(tree, np.int32)

    subtrees = coded.mapInArrow(drawn(top, value, trees, seed, d), f"node int, {CODED}")
    deal = tasks(frame.sparkSession, int((np.isnan(value) & (top.left < 0)).sum()))
    grown = subtrees.repartition(deal, "node").groupBy("node").applyInArrow(grower(np.array(depth), max_depth, m, d, seed), SUBTREE)
    return Forest(cuts, trees, top, value, tree, gains, written(grown, "subtrees"))


def histograms(top: Nodes, trees: int, seed: int, d: int, part: list[int], tried: np.ndarray):
    """Weights by class and numbers of rows for each open node, tried feature and bin: one row per node and task."""
    slot_of = np.full(len(top.left), -1)
    slot_of[part] = np.arange(len(part))
    m = tried.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros((3, len(part) * m * BINS))
        held: list[tuple] = []

        def flush() -> None:
            if held:
                key, w, y = (np.concatenate(x) for x in zip(*held))
                key, w, y = key.ravel(), np.repeat(w, m), np.repeat(y, m)
                for i, weight in enumerate((w * (y != 1), w * (y == 1), np.ones(len(w)))):
                    cells[i] += np.bincount(key, weight, cells.shape[1])
                held.clear()

        for batch in batches:
            bins, (h, y, w) = matrix(batch["bins"], d), numbers(batch, "h", "y", "w")
            for t in range(trees):
                n = copies(h, t, seed)
                rows = np.flatnonzero(n)
                slot = slot_of[top.descend(bins[rows], t)]
                rows, slot = rows[slot >= 0], slot[slot >= 0]
                held.append(((slot[:, None] * m + np.arange(m)) * BINS + bins[rows[:, None], tried[slot]], w[rows] * n[rows], y[rows]))
                if sum(len(x[1]) for x in held) * m > KEYS:
                    flush()
        flush()
        one = cells.reshape(3, len(part), m * BINS).transpose(1, 0, 2)
        some = np.flatnonzero(one[:, 2].any(axis=1))
        for i in range(0, len(some), 256):
            at = some[i : i + 256]
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array([one[s].tobytes() for s in at], pa.binary())], ["slot", "cells"])

    return run


def chooser(tried: np.ndarray):
    m = tried.shape[1]

    def choose(table: pa.Table) -> pa.Table:
        slot = table["slot"][0].as_py()
        s0, s1, n = sum(np.sort(np.stack([np.frombuffer(c, np.float64) for c in table["cells"].to_pylist()]), axis=0)).reshape(3, -1)
        seen = np.flatnonzero(n)
        best, gain, l0, l1 = best_splits(seen, s0[seen], s1[seen], m, 1)
        at = best[0]
        out = dict(slot=slot, feature=-1, cut=0, gain=0.0, w0=s0[:BINS].sum(), w1=s1[:BINS].sum(), l0=0.0, l1=0.0, ln=0.0, n=n[:BINS].sum())
        if at >= 0:
            j, bin_ = seen[at] // BINS, seen[at] % BINS
            out |= dict(feature=int(tried[slot, j]), cut=int(bin_), gain=gain[at], l0=l0[at], l1=l1[at], ln=n[j * BINS : seen[at] + 1].sum())
        kinds = {"slot": pa.int32(), "feature": pa.int32(), "cut": pa.int32()}
        return pa.table({k: pa.array([v], kinds.get(k, pa.float64())) for k, v in out.items()})

    return choose


def drawn(top: Nodes, value: np.ndarray, trees: int, seed: int, d: int):
    """The rows of each tree's sample that lie in a node without a value, with their weights."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins, (h, y, w) = matrix(batch["bins"], d), numbers(batch, "h", "y", "w")
            for t in range(trees):
                n = copies(h, t, seed)
                rows = np.flatnonzero(n)
                node = top.descend(bins[rows], t)
                rows, node = rows[np.isnan(value[node])], node[np.isnan(value[node])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node.astype(np.int32)), pa.array(h[rows]), packed(bins[rows]), pa.array(y[rows].astype(np.int8)), pa.array(w[rows] * n[rows])],
                    ["node", "h", "bins", "y", "w"])

    return run


def grower(depth: np.ndarray, max_depth: int, m: int, d: int, seed: int):
    def run(table: pa.Table) -> pa.Table:
        node, (h, y, w) = table["node"][0].as_py(), numbers(table, "h", "y", "w")
        order = np.lexsort((w, y, h))  # rows come in any order, and sums must not depend on it
        rng = np.random.default_rng([seed, node, 1])
        feature, cut, left, value, gains = grow(matrix(table["bins"], d)[order], y[order], w[order], max_depth - int(depth[node]), m, rng)
        parts = [pa.array([x.astype(k).tobytes()], pa.binary()) for x, k in ((feature, np.int32), (cut, np.int32), (left, np.int32), (value, np.float64))]
        return pa.Table.from_arrays([pa.array([node], pa.int32()), *parts, pa.array([gains.tolist()])], ["node", "feature", "cut", "left", "value", "gains"])

    return run
