"""Approximate nearest neighbours by a forest of random-projection trees.

Trees are fitted on a bounded sample: each node cuts at the median projection on the line through two sample points. Every
vector is then indexed: one row per tree in its leaf. A query walks all trees through one priority queue ordered by the
largest margin crossed so far, and takes leaves until they hold ``probe`` times the number of indexed vectors (a vector
counts once per tree). Leaves and the queries that take them are cut into blocks of bounded size, which are compared by
matrix products; the best rows of each block are scored again on the original vectors in double precision, in slices, and
the best of all blocks are the result.

Nearness is cosine; ties go to the smaller id. Vectors that are null, zero, of another length than the most frequent one,
or that hold null or non-finite components take no part. Repeated rows of an id are candidates once. Ids are long integers.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.session import written


CELLS = 1 << 20  # of the matrices of pairs, and of pairs of vectors, held at once


@dataclass(frozen=True)
class Settings:
    """probe 1.0 over 16 trees looks at three fifths of the vectors; on the given embeddings, which are nearly without
    structure, that finds 0.93 to 0.99 of the true neighbours. sample bounds the vectors that trees are fitted on, and with
    it their depth: leaves hold about ``leaf`` vectors until the sample is too small for a further cut. block bounds the
    vectors of a leaf, and the queries that take it, that one task compares at once."""

    trees: int = 16
    probe: float = 1.0
    sample: int = 8192
    leaf: int = 32
    block: int = 2048
    seed: int = 7


class Forest:
    def __init__(self, sample: np.ndarray, n: int, s: Settings):
        rng = np.random.default_rng(s.seed)
        most = int(np.log2(max(len(sample) // 16, 1)))
        self.depth = int(np.clip(np.ceil(np.log2(max(n / s.leaf, 1))), 0, most))
        self.planes = np.zeros((s.trees, 2**self.depth - 1, sample.shape[1]), np.float32)
        self.cuts = np.zeros((s.trees, 2**self.depth - 1), np.float32)
        for t in range(s.trees):
            parts = [np.arange(len(sample))]
            for level in range(self.depth):
                halves = []
                for k, part in enumerate(parts):
                    line = np.zeros(sample.shape[1])
                    if len(part) > 1:
                        a, b = rng.choice(part, 2, replace=False)
                        line = sample[a] - sample[b]
                    if not line.any():  # equal points or too few: any direction
                        line = rng.normal(size=sample.shape[1])
                    line = (line / np.linalg.norm(line)).astype(np.float32)
                    along = sample[part] @ line
                    node = 2**level - 1 + k
                    self.planes[t, node], self.cuts[t, node] = line, np.median(along) if len(part) else 0
                    right = along > self.cuts[t, node]
                    halves += [part[~right], part[right]]
                parts = halves

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """Vector x tree: the leaf."""
        out = np.zeros((len(x), len(self.planes)), np.int32)
        for t in range(len(self.planes)):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                over = np.einsum("ij,ij->i", x, self.planes[t][node]) > self.cuts[t][node]
                node = 2 * node + 1 + over
            out[:, t] = node - (2**self.depth - 1)
        return out

    def probes(self, x: np.ndarray, sizes: np.ndarray, wanted: float) -> list[tuple[int, int]]:
        """(tree, leaf) in the order of the queue until their sizes add up to ``wanted``."""
        margins = np.einsum("tnd,d->tn", self.planes, x) - self.cuts
        first = 2**self.depth - 1
        queue = [(0.0, t, 0) for t in range(len(self.planes))]
        out, got = [], 0
        while queue and got < wanted:
            crossed, t, node = heapq.heappop(queue)
            while node < first:
                m = margins[t, node]
                heapq.heappush(queue, (max(crossed, abs(float(m))), t, 2 * node + 1 + (m <= 0)))
                node = 2 * node + 1 + (m > 0)
            if sizes[t, node - first]:
                out.append((t, node - first))
                got += sizes[t, node - first]
        return out


def matrix(column, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.float64).reshape(-1, dim)


def units(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def cosine(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Row by row, in an order of additions that is the same for equal vectors wherever they stand."""
    # Scaled by the largest component first, so that no square overflows or vanishes.
    q, x = (v / np.abs(v).max(axis=1, keepdims=True) for v in (q, x))
    return (q * x).sum(axis=1) / np.sqrt((q * q).sum(axis=1) * (x * x).sum(axis=1))


def valid(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(id, v: components as doubles) of the vectors that take part."""
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    return rows.where(F.col("id").isNotNull() & F.col("v").isNotNull()).where(sound)


def packed(dim: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([r.tobytes() for r in flat], pa.binary())], ["id", "v"])

    return pack


def dealt(index: DataFrame, asked: DataFrame, sizes: np.ndarray, takers: np.ndarray, block: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``block``, of the vectors of a leaf, and ``part``, of the queries that take it: a crowded leaf is
    dealt out to as many blocks as it fills, and its queries to as many parts; every block meets every part."""
    for name, counts, own, other, key in (("block", sizes, "index", "asked", "id"), ("part", takers, "asked", "index", "q")):
        sides = {"index": index, "asked": asked}
        blocks = np.maximum(-(-counts // block), 1)
        if blocks.max() > 1:
            many = F.array(*(F.array(*map(F.lit, map(int, b))) for b in blocks))[F.col("tree")][F.col("leaf")]
            sides[own] = sides[own].withColumn(name, F.pmod(F.xxhash64(key), many).cast("int"))
            sides[other] = sides[other].withColumn(name, F.explode(F.sequence(F.lit(0), many - 1)))
        else:
            sides = {side: df.withColumn(name, F.lit(0)) for side, df in sides.items()}
        index, asked = sides["index"], sides["asked"]
    return index, asked


def compare(points: pd.DataFrame, queries: pd.DataFrame, k: int, dim: int) -> pd.DataFrame:
    """(q, id, score): the ``k`` nearest points of each query."""
    out = [pd.DataFrame({"q": np.zeros(0, np.int64), "id": np.zeros(0, np.int64), "score": np.zeros(0)})]
    # Of equal vectors none but the k smallest ids can be among the best, one more as a query is not its own neighbour.
    points = points.sort_values("id", ignore_index=True)
    points = points[points.groupby("v").cumcount() <= k]
    x, ids, qs = matrix(points["v"], dim), points["id"].to_numpy(), queries["q"].to_numpy()
    q, ux = matrix(queries["qv"], dim), units(x).T
    keep = min(k, len(ids))
    rows, pairs = max(1, CELLS // max(len(ids), 1)), max(1, CELLS // dim)
    for at in range(0, len(qs) if keep else 0, rows):
        some = slice(at, at + rows)
        near = units(q[some]) @ ux
        near[qs[some, None] == ids[None]] = -np.inf
        last = np.partition(near, len(ids) - keep, axis=1)[:, len(ids) - keep]
        # All that tie with the last up to rounding, then exactly.
        i, j = np.nonzero((near >= last[:, None] - 1e-9) & (near > -np.inf))
        score = np.concatenate([np.zeros(0), *(cosine(q[at + i[n : n + pairs]], x[j[n : n + pairs]]) for n in range(0, len(i), pairs))])
        order = np.lexsort((ids[j], -score, i))
        i, j, score = i[order], j[order], score[order]
        place = np.arange(len(i)) - np.searchsorted(i, i)
        out.append(pd.DataFrame({"q": qs[at + i], "id": ids[j], "score": score})[place < k])
    return pd.concat(out, ignore_index=True)


def search(vectors: DataFrame, query: str, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding", settings: Settings | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each vector for whose id the SQL condition ``query`` on
    the column id holds; all other vectors are candidates. A query with fewer candidates gets them all."""
    s = settings or Settings()
    spark = vectors.sparkSession
    sound = valid(vectors, vec_id, vector)
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    lengths = sound.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if lengths is None:
        return empty
    dim = lengths["d"]
    rows = sound.where(F.size("v") == dim).dropDuplicates(["id"])
    rows = written(rows.mapInArrow(packed(dim), "id long, v binary"), "vectors")
    n = rows.count()
    # Bounded by ``sample``.
    some = rows.orderBy(F.xxhash64("id"), "id").limit(s.sample).toArrow().sort_by("id")
    forest = spark.sparkContext.broadcast(Forest(units(matrix(some["v"].to_pylist(), dim)).astype(np.float32), n, s))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = forest.value.leaves(units(matrix(batch.column("v").to_pylist(), dim)).astype(np.float32))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, leaf.size + 1, s.trees), pa.int32()), pa.array(leaf.reshape(-1)))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("v"), lists], ["id", "v", "leaves"])

    placed = written(rows.mapInArrow(place, "id long, v binary, leaves array<int>"), "placed")
    index = placed.select("id", "v", F.posexplode("leaves").alias("tree", "leaf"))
    # One row per leaf: bounded by the number of leaves of the forest.
    sizes = np.zeros((s.trees, 2 ** forest.value.depth), np.int64)
    for r in placed.select(F.posexplode("leaves").alias("tree", "leaf")).groupBy("tree", "leaf").count().collect():
        sizes[r["tree"], r["leaf"]] = r["count"]
    wanted = max(s.probe * n, (k + 1) * s.trees)
    shared = spark.sparkContext.broadcast(sizes)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vecs = units(matrix(batch.column("v").to_pylist(), dim)).astype(np.float32)
            places = [[{"tree": t, "leaf": leaf} for t, leaf in forest.value.probes(x, shared.value, wanted)] for x in vecs]
            kind = pa.list_(pa.struct([("tree", pa.int32()), ("leaf", pa.int32())]))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("v"), pa.array(places, kind)], ["q", "qv", "places"])

    asked = written(rows.where(query).mapInArrow(probe, "q long, qv binary, places array<struct<tree:int,leaf:int>>"), "asked")
    asked = asked.select("q", "qv", F.inline("places"))
    # One row per leaf again.
    takers = np.zeros_like(sizes)
    for r in asked.groupBy("tree", "leaf").count().collect():
        takers[r["tree"], r["leaf"]] = r["count"]
    index, asked = dealt(index, asked, sizes, takers, s.block)
    by = ["tree", "leaf", "block", "part"]
    found = (index.groupBy(*by).cogroup(asked.groupBy(*by))
             .applyInPandas(lambda key, points, queries: compare(points, queries, k, dim), "q long, id long, score double"))
    # The same candidate comes from several trees; k per query remain, so one array holds them.
    top = found.groupBy("q").agg(F.collect_set(F.struct((-F.col("score")).alias("far"), F.col("id").alias("id"))).alias("all"))
    top = top.select("q", F.posexplode(F.slice(F.array_sort("all"), 1, k)).alias("rank", "x"))
    return top.select(F.col("q").alias("query_id"), (F.col("rank") + 1).alias("rank"), F.col("x.id").alias("vec_id"), (-F.col("x.far")).alias("score"))
