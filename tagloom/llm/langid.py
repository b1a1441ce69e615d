"""Language of whole texts by a string kernel: kernel ridge regression, one against the rest, on Nyström landmarks.

The kernel of two texts is the number of byte n-grams (n = 1 to 4) that occur in both, over the root of the product of
their numbers of n-grams. N-grams of the lower-cased text, with anything but letters read as a space, are hashed to 2^14
coordinates. Landmarks come in equal shares from each language of a bounded sample. Null texts and texts without a
letter are ``und`` with score 0; so is everything when no labelled row is given. Ties go to the first name in order.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm import arrays

BITS = 14
LONGEST = 4
UNKNOWN = "und"
BYTES = np.where(arrays.LETTER, np.arange(256), 32).astype(np.uint8)


@dataclass(frozen=True)
class Settings:
    """max_rows bounds the labelled rows that are fitted, those with the smallest hash of their id; ``block`` texts are
    scored by one matrix product."""

    max_rows: int = 2048
    landmarks: int = 128
    ridge: float = 1e-4
    block: int = 256


@dataclass(frozen=True)
class Model:
    languages: list[str]
    landmarks: np.ndarray  # landmark x coordinate: 0 or 1
    weights: np.ndarray  # landmark x language

    def predict(self, texts: pa.Array, block: int) -> tuple[np.ndarray, np.ndarray]:
        """Number of the language and score of every text."""
        best, share = np.zeros(len(texts), np.int64), np.zeros(len(texts))
        wide = np.ascontiguousarray(self.landmarks.T, np.float32)
        size = np.sqrt(self.landmarks.sum(axis=1, dtype=np.float64))
        bits = presence(texts)
        for at in range(0, len(texts), block):
            values = kernel(bits[at : at + block], wide, size) @ self.weights
            best[at : at + block] = values.argmax(axis=1)
            positive = np.maximum(values, 0)
            share[at : at + block] = positive.max(axis=1) / np.maximum(positive.sum(axis=1), 1e-12)
        return best, share


def presence(texts: pa.Array) -> np.ndarray:
    """Text x coordinate: whether an n-gram that hashes there occurs in the text."""
    raw, ends = arrays.flat_bytes(texts)
    raw = BYTES[raw]
    row = np.repeat(np.arange(len(texts)), np.diff(ends))
    out = np.zeros(len(texts) << BITS, np.uint8)
    gram = np.zeros(len(raw), np.uint64)
    for n in range(1, LONGEST + 1):
        gram = (gram[: len(raw) - n + 1] << np.uint64(8)) | raw[n - 1 :]
        good = slice(None) if n == 1 else row[n - 1 :] == row[: len(row) - n + 1]
        code = ((gram | np.uint64(n << 40)) * arrays.BASE) >> np.uint64(64 - BITS)
        out[((row[: len(gram)] << BITS) | code.astype(np.int64))[good]] = 1
    return out.reshape(len(texts), 1 << BITS)


def kernel(bits: np.ndarray, wide: np.ndarray, size: np.ndarray) -> np.ndarray:
    own = np.sqrt(np.maximum(bits.sum(axis=1, dtype=np.int64), 1))
    return (bits.astype(np.float32) @ wide) / (own[:, None] * np.maximum(size, 1))


def packed_presence(text: Column) -> Column:
    """``presence`` of whole texts, eight coordinates a byte."""
    @F.arrow_udf("binary")
    def pack(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = [pa.array([b.tobytes() for b in np.packbits(presence(x), axis=1)], pa.binary()) for x in arrays.slices(batch, rows=1024)]
            yield arrays.joined(parts, pa.binary())

    return pack(text)


def train(bits: np.ndarray, languages: list[str], s: Settings) -> Model:
    """Weights from the rows of ``presence`` and their languages."""
    names = sorted(set(languages))
    label = np.array([names.index(x) for x in languages], np.int64)
    # Landmarks in turn from each language.
    turn = np.zeros(len(label), np.int64)
    for k in range(len(names)):
        turn[label == k] = np.arange((label == k).sum())
    marks = bits[np.lexsort((label, turn))[: s.landmarks]]
    if not len(names):
        return Model([], marks, np.zeros((0, 0)))
    size = np.sqrt(marks.sum(axis=1, dtype=np.float64))
    wide = np.ascontiguousarray(marks.T, np.float32)
    near = np.concatenate([kernel(bits[i : i + s.block], wide, size) for i in range(0, len(bits), s.block)]).astype(np.float64)
    inner = kernel(marks, wide, size).astype(np.float64)
    wanted = (label[:, None] == np.arange(len(names))).astype(np.float64)
    left = near.T @ near + s.ridge * len(bits) * inner + 1e-9 * np.eye(len(marks))
    return Model(names, marks, np.linalg.lstsq(left, near.T @ wanted, rcond=None)[0])


def fit(docs: DataFrame, lang: str = "lang", doc_id: str = "doc_id", text: str = "text", settings: Settings | None = None) -> Model:
    """Learn from the rows of ``docs`` with an id, a text with a letter and a language."""
    s = settings or Settings()
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    rows = rows.where("id is not null and lang is not null")
    some = rows.select("id", F.xxhash64("id").alias("h")).distinct().orderBy("h", "id").limit(s.max_rows)
    # max_rows ids at most, so they may be sent to all executors. The driver gets max_rows rows of 2 KB, however long their
    # texts and however often an id repeats.
    found = (rows.join(F.broadcast(some), "id").where(has_letter(F.col("text")))
             .select("h", "id", "lang", packed_presence(F.lower("text")).alias("bits"))
             .orderBy("h", "id", "lang", "bits").limit(s.max_rows).toArrow())
    bits = np.unpackbits(np.frombuffer(b"".join(found["bits"].to_pylist()), np.uint8).reshape(-1, (1 << BITS) // 8), axis=1)
    return train(bits, found["lang"].to_pylist(), s)


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def predict(text: Column, model: Model, settings: Settings | None = None) -> Column:
    """(lang, score) of each whole text."""
    s = settings or Settings()

    @F.arrow_udf("lang string, score double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.struct([("lang", pa.string()), ("score", pa.float64())])
        names = pa.array([*model.languages, UNKNOWN], pa.string())
        for batch in batches:
            parts = []
            for x in arrays.slices(batch, rows=1024):
                best, share = model.predict(x, s.block) if model.languages else (np.zeros(len(x), np.int64), np.zeros(len(x)))
                parts.append(pa.StructArray.from_arrays([names.take(pa.array(best)), pa.array(np.clip(share, 0, 1))], ["lang", "score"]))
            yield arrays.joined(parts, kind)

    nothing = F.struct(F.lit(UNKNOWN).alias("lang"), F.lit(0.0).alias("score"))
    return F.when(has_letter(text), scored(F.lower(text))).otherwise(nothing)
