"""Whole texts of an Arrow batch as flat numpy arrays: slicing by size, hashing of words and q-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text handled at once inside a task; a single longer text makes a slice of its own.
SLICE_BYTES = 4 << 20
SLICE_ROWS = 1 << 15

BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def slices(texts: pa.Array, limit: int = SLICE_BYTES, rows: int = SLICE_ROWS) -> Iterator[pa.Array]:
    """Consecutive parts of a string array, each of at most ``limit`` bytes or one row; null reads as empty."""
    if pa.types.is_null(texts.type):
        texts = texts.cast(pa.large_string())
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        done = ends[at - 1] if at else 0
        to = max(at + 1, min(int(np.searchsorted(ends, done + limit, "right")), at + rows))
        yield pc.fill_null(texts.slice(at, to - at).cast(pa.large_string()), "")  # only this part is copied
        at = to


def flat_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts on end, and the ``len + 1`` offsets of the texts in them."""
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[ends[0] : ends[-1]], ends - ends[0]


def flat_chars(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts on end, and the offsets of the texts in them."""
    raw, ends = flat_bytes(texts)
    first = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    return np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), np.uint32), first[ends]


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit integers (the finaliser of a splittable generator)."""
    x = np.asarray(x, np.uint64)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


SYMBOLS = mix(np.arange(1, 257, dtype=np.uint64) * BASE)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the hash base and of its inverse modulo 2^64."""
    if len(_powers[0]) < n:
        for k, base in enumerate((BASE, BASE_INVERSE)):
            x = np.full(max(n, SLICE_BYTES + 64), base, np.uint64)
            x[0] = 1
            _powers[k] = np.cumprod(x, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def prefix_hash(values: np.ndarray) -> np.ndarray:
    """Running sums of ``values[i] * BASE^i``, one longer than ``values``."""
    up, _ = powers(len(values) + 1)
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:-1], out=out[1:])
    return out


def range_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the ranges ``[start, end)``; equal contents have equal hashes wherever they stand."""
    _, down = powers(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts])


def words(raw: np.ndarray, ends: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every maximal run of bytes for which the 256-entry table ``inside`` holds."""
    hit = np.empty(len(raw) + 2, bool)
    hit[0] = hit[-1] = False
    hit[1:-1] = inside[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[ends] = True
    starts = np.flatnonzero(hit[1:] & (~hit[:-1] | edge))
    stops = np.flatnonzero(hit[:-1] & (~hit[1:] | edge))
    return starts, stops, np.searchsorted(ends, starts, "right") - 1


# Bytes that are not ASCII white space.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = False
# ASCII letters and every byte of a longer character.
LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def word_hashes(raw: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    return range_hash(prefix_hash(SYMBOLS[raw]), starts, stops)


def list_array(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Lists of ``counts`` consecutive values."""
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def joined(parts: list, kind: pa.DataType) -> pa.Array:
    """One array out of the parts of a batch (none for an empty batch)."""
    return pa.concat_arrays(parts) if parts else pa.array([], kind)
