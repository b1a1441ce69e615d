"""Toxicity score of whole texts: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A text becomes the set of its words (and of the first 4 to 7 bytes of longer ones, so that inflected forms share
evidence), neighbouring pairs and pairs that skip one word, each hashed to one of 2^20 coordinates. Training runs on a bounded sample of labelled rows; per-coordinate rates and the L1 term leave few weights
other than zero, and those are all that scoring needs. Words are runs of letters of the lower-cased text. Null and empty
texts have the score of the bias; without any labelled row every score is 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm import arrays

BITS = 20
# Bytes at the beginning of longer words that count as words of their own.
STEMS = (4, 5, 6, 7)


@dataclass(frozen=True)
class Settings:
    """max_rows bounds the labelled rows that are fitted: those with the smallest hash of their id."""

    max_rows: int = 8192
    epochs: int = 4
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 5.0
    l2: float = 1.0


@dataclass(frozen=True)
class Model:
    coordinates: np.ndarray  # ascending, with weights other than 0
    weights: np.ndarray
    bias: float | None  # None: nothing was learned

    def score(self, texts: pa.Array) -> np.ndarray:
        if self.bias is None:
            return np.zeros(len(texts))
        dense = np.zeros(1 << BITS)
        dense[self.coordinates] = self.weights
        row, at = features(texts, dense != 0)
        return 1 / (1 + np.exp(-np.clip(np.bincount(row, dense[at], len(texts)) + self.bias, -35, 35)))


def features(texts: pa.Array, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Row and coordinate of every distinct feature of each text of a slice; of the ``wanted`` coordinates only."""
    raw, ends = arrays.flat_bytes(texts)
    start, stop, row = arrays.words(raw, ends, arrays.LETTER)
    sums = arrays.prefix_hash(arrays.SYMBOLS[raw])
    word = arrays.range_hash(sums, start, stop)
    shift = np.uint64(64 - BITS)
    keys = []

    def add(row, at):
        at = at >> shift
        if wanted is not None:
            good = wanted[at.astype(np.int64)]
            row, at = row[good], at[good]
        keys.append((row.astype(np.uint64) << np.uint64(BITS)) | at)

    for size in STEMS:
        long = stop - start > size
        add(row[long], arrays.mix(arrays.range_hash(sums, start[long], start[long] + size) ^ np.uint64(size)))
    with np.errstate(over="ignore"):
        for gap in (0, 1, 2):
            left, right = word[: len(word) - gap], word[gap:]
            place = np.uint64((gap * int(arrays.BASE)) % (1 << 64))
            both = row[: len(row) - gap] == row[gap:]
            pair = left if not gap else arrays.mix(left * np.uint64(3) + arrays.mix(right + place))
            add(row[: len(row) - gap][both], pair[both])
    key = np.sort(np.concatenate(keys))
    key = key[np.concatenate([[True], key[1:] != key[:-1]])] if len(key) else key
    return (key >> np.uint64(BITS)).astype(np.int64), (key & np.uint64((1 << BITS) - 1)).astype(np.int64)


def train(flat: np.ndarray, ends: np.ndarray, order: list[int], labels: np.ndarray, s: Settings) -> Model:
    """FTRL-proximal over the rows ``flat[ends[k]:ends[k + 1]]`` in the given order, once per epoch; the bias has no L1
    term and starts from the log odds of the labels, so that few rows do not leave it near even odds. The rows stay in the
    one array they came in."""
    if not len(order):
        return Model(np.zeros(0, np.int64), np.zeros(0), None)
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    bias_z = bias_n = 0.0
    odds = float(np.log((labels.sum() + 0.5) / (len(labels) - labels.sum() + 0.5)))

    def weights(z, n, l1):
        grown = np.abs(z) - l1
        return np.where(grown <= 0, 0, -np.sign(z) * grown / ((s.beta + np.sqrt(n)) / s.alpha + s.l2))

    for _ in range(s.epochs):
        for k in order:
            at, y = flat[ends[k] : ends[k + 1]], labels[k]
            old_z, old_n = z[at], n[at]
            w, bias = weights(old_z, old_n, s.l1), float(weights(bias_z, bias_n, 0.0))
            g = 1 / (1 + np.exp(-np.clip(w.sum() + odds + bias, -35, 35))) - y
            new_n = old_n + g * g
            z[at] = old_z + g - (np.sqrt(new_n) - np.sqrt(old_n)) / s.alpha * w
            n[at] = new_n
            bias_z += g - (np.sqrt(bias_n + g * g) - np.sqrt(bias_n)) / s.alpha * bias
            bias_n += g * g
    at = np.flatnonzero(np.abs(z) > s.l1)
    return Model(at, weights(z[at], n[at], s.l1), odds + float(weights(bias_z, bias_n, 0.0)))


def fit(docs: DataFrame, labels: DataFrame, label: str, doc_id: str = "doc_id", text: str = "text", settings: Settings | None = None) -> Model:
    """Learn ``label`` (0 or 1; null rows are left out) of ``labels`` from the texts with the same id. A repeated label row
    counts once; where labels of an id differ, the larger holds."""
    s = settings or Settings()

    @F.arrow_udf("array<int>")
    def coordinates(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = []
            for x in arrays.slices(batch):
                row, at = features(x)
                parts.append(arrays.list_array(at, np.bincount(row, minlength=len(x)), pa.int32()))
            yield arrays.joined(parts, pa.list_(pa.int32()))

    known = (labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("y")).where("id is not null and y is not null")
             .groupBy("id").agg(F.max("y").alias("y")).withColumn("h", F.xxhash64("id")).orderBy("h", "id").limit(s.max_rows))
    # The sample has max_rows rows at most, so it may be sent to all executors.
    sample = (docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(F.broadcast(known), "id")
              .select("h", "id", "y", coordinates(F.lower("text")).alias("at")).toArrow())
    lists = sample["at"].combine_chunks()
    order = sorted(range(len(lists)), key=list(zip(*(sample[c].to_pylist() for c in ("h", "id", "y")))).__getitem__)
    return train(lists.values.to_numpy(), np.asarray(lists.offsets), order, sample["y"].to_numpy().astype(float), s)


def score(text: Column | str, model: Model) -> Column:
    """Score of each whole text between 0 and 1."""
    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield arrays.joined([pa.array(model.score(x)) for x in arrays.slices(batch)], pa.float64())

    return scored(F.lower(text))
