"""Benchmark decontamination by the q-gram lemma.

Texts and benchmark items are lower-cased, with every run of other characters than letters and digits read as one space.
An item counts as found when any window of it stands in the document with few edits: any 150 characters on end, wherever
they begin, or the whole of a shorter item. A window of m characters with at most e edits shares at least m + 1 - q - q e of
its q-grams inside a band of e + 1 diagonals. Per document: q-gram hits outside any stretch dense enough for that bound go,
the rest are sorted by their place in the item in bands that overlap by half, the count slides over every start of a window,
and windows that reach the bound are verified by banded alignment. Nothing is shuffled.

Null and empty texts and items without a q-gram, fewer than q characters, have no hits; a window so short that edits could
leave it no q-gram may have only as many as leave it one; a repeated item counts once per item id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm import arrays


@dataclass(frozen=True)
class Settings:
    """edits: share of a window's characters that may be edited. max_index_chars bounds the benchmark characters that one
    pass holds on each executor; a larger benchmark is searched in several passes."""

    q: int = 10
    window: int = 150
    edits: float = 0.075
    max_index_chars: int = 16 << 20


def plain(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


SYMBOL = np.uint64(0x9E3779B97F4A7C15)


def gram_hashes(points: np.ndarray, q: int) -> np.ndarray:
    sums = arrays.prefix_hash(arrays.mix((points.astype(np.uint64) + np.uint64(1)) * SYMBOL))
    _, down = arrays.powers(len(sums))
    return (sums[q:] - sums[:-q]) * down[: len(sums) - q]


class Index:
    """Benchmark items on end, where each q-gram stands in them, and the windows: where each starts, its item, length and
    most edits."""

    def __init__(self, items: list[tuple[int, str]], s: Settings):
        self.s = s
        items = [x for x in items if len(x[1]) >= s.q]
        self.size = np.array([len(text) for _, text in items], np.int64)
        self.long = np.minimum(self.size, s.window)
        self.budget = self.edits_of(self.long)
        self.least = self.long + 1 - s.q - s.q * self.budget
        self.begin = np.cumsum(self.size) - self.size
        self.owner = np.repeat(np.arange(len(items), dtype=np.int32), self.size)
        place = np.arange(len(self.owner)) - self.begin[self.owner]
        rest = self.size[self.owner] - place
        self.start = np.flatnonzero(rest >= self.long[self.owner])
        self.window = np.cumsum(self.size - self.long + 1) - (self.size - self.long + 1)
        self.item = np.array([item for item, _ in items], np.int64)[self.owner[self.start]]
        self.length = self.long[self.owner[self.start]]
        self.most = self.budget[self.owner[self.start]]
        flat = np.frombuffer("".join(text for _, text in items).encode("utf-32-le"), np.uint32)
        self.flat = np.concatenate([flat, np.zeros(s.window, np.uint32)])
        at = np.flatnonzero(rest >= s.q)
        code = gram_hashes(flat, s.q)[at] if len(at) else np.zeros(0, np.uint64)
        order = np.argsort(code, kind="stable")
        self.at = at[order]
        self.code, self.first, self.times = np.unique(code[order], return_index=True, return_counts=True)
        bits = max(16, int(np.ceil(np.log2(max(len(self.code), 1) * 64))))
        self.shift = np.uint64(64 - bits)
        self.filter = np.zeros(1 << bits, bool)
        self.filter[self.code * arrays.BASE >> self.shift] = True

    @property
    def points(self) -> np.ndarray:
        """Window x character, put together on each call: to look at, as it holds a character up to ``window`` times."""
        return np.lib.stride_tricks.sliding_window_view(self.flat, self.s.window)[self.start]

    def edits_of(self, m: np.ndarray) -> np.ndarray:
        """Edits of a window of ``m`` characters: no more than leave it one of its q-grams, so a short one may have fewer."""
        return np.minimum((m * self.s.edits).astype(np.int64), (m - self.s.q) // self.s.q)

    def search(self, texts: pa.Array) -> list[tuple[int, int, int, int, int]]:
        """(row, item, start, end, edits): the best window of each item found in each text, in characters of the text."""
        points, ends = arrays.flat_chars(texts)
        if len(points) < self.s.q or not len(self.code):
            return []
        hashes = gram_hashes(points, self.s.q)
        pos = np.flatnonzero(self.filter[hashes * arrays.BASE >> self.shift])
        at = np.minimum(np.searchsorted(self.code, hashes[pos]), len(self.code) - 1)
        row = np.searchsorted(ends, pos, "right") - 1
        good = (self.code[at] == hashes[pos]) & (pos + self.s.q <= ends[row + 1])
        pos, at, row = pos[good], at[good], row[good]
        # Dense stretches: enough hits for some window within the longest window and its edits.
        span = int((self.long + 2 * self.budget).max()) + 1
        apart = pos + row * span  # hits of different texts are never within a span
        many = np.searchsorted(apart, apart + span) - np.arange(len(apart))
        keep = np.zeros(len(pos) + 1, np.int64)
        dense = np.flatnonzero(many >= self.least.min())
        np.add.at(keep, dense, 1)
        np.add.at(keep, dense + many[dense], -1)
        keep = np.cumsum(keep)[:-1] > 0
        pos, at, row = pos[keep], at[keep], row[keep]
        # Each hit once per place of the q-gram in the items, in the two bands that hold its diagonal.
        times = self.times[at]
        which = np.repeat(self.first[at], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        owner, row = self.owner[self.at[which]].astype(np.int64), np.repeat(row, times)
        place = self.at[which] - self.begin[owner]
        band = (np.repeat(pos, times) - ends[row] - place) // (self.budget[owner] + 1)
        place, band, owner, row = np.tile(place, 2), np.concatenate([band, band - 1]), np.tile(owner, 2), np.tile(row, 2)
        order = np.lexsort((place, band, owner, row))
        place, band, owner, row = place[order], band[order], owner[order], row[order]
        group = np.cumsum(np.concatenate([[0], (np.diff(row) != 0) | (np.diff(owner) != 0) | (np.diff(band) != 0)])) if len(row) else row
        # Windows with enough hits, wherever they start: those that hold a hit and the one that makes it enough.
        i = np.arange(len(row))
        j = i + self.least[owner] - 1
        i = i[j < len(row)]
        j = j[i]
        reach = self.long - self.s.q
        good = (group[i] == group[j]) & (place[j] - place[i] <= reach[owner[i]])
        i, j = i[good], j[good]
        low = np.maximum(place[j] - reach[owner[i]], 0)
        high = np.minimum(place[i], (self.size - self.long)[owner[i]])
        low[1:] = np.where(group[i[1:]] == group[i[:-1]], np.maximum(low[1:], high[:-1] + 1), low[1:])
        times = np.maximum(high - low + 1, 0)
        hit = np.repeat(i, times)
        offset = np.repeat(low, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        wide = int(self.size.max()) + 1
        spot, from_ = group * wide + place, group[hit] * wide + offset
        count = np.searchsorted(spot, from_ + reach[owner[hit]], "right") - np.searchsorted(spot, from_)
        row, owner, band = row[hit], owner[hit], band[hit]
        # An edit takes q hits at most, so a window without so many hits has as many edits at least.
        fewest = np.maximum(-((count - reach[owner] - 1) // self.s.q), 0)
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for x, e, start, end in self.verified(points, ends, row, owner, band, offset, fewest):
            name = (int(row[x]), int(self.item[self.window[owner[x]]]))
            best[name] = min(best.get(name, (e, start, end)), (e, start, end))
        return [(r, item, start, end, edits) for (r, item), (edits, start, end) in sorted(best.items())]

    def verified(self, points: np.ndarray, ends: np.ndarray, row: np.ndarray, owner: np.ndarray, band: np.ndarray, offset: np.ndarray,
                 fewest: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(candidate, edits, start, end) of the window with the fewest edits for each text and item that has one within
        its budget. Windows are aligned from the most promising on, until no other can have fewer edits."""
        order = np.lexsort((band, offset, fewest, owner, row))
        first = np.flatnonzero(np.concatenate([[True], (np.diff(row[order]) != 0) | (np.diff(owner[order]) != 0)])) if len(order) else order
        last = np.append(first, len(order))[1:]
        least = self.budget[owner[order[first]]] + 1
        chosen, starts, stops = (np.full(len(first), -1) for _ in range(3))
        at, open_, step = first.copy(), np.arange(len(first)), 1
        while len(open_):
            take = np.minimum(step, last[open_] - at[open_])
            pair = np.repeat(open_, take)
            x = np.repeat(at[open_], take) + np.arange(take.sum()) - np.repeat(np.cumsum(take) - take, take)
            good = fewest[order[x]] < least[pair]
            pair, x = pair[good], x[good]
            for k in range(0, len(x), 2048):
                p, c = pair[k : k + 2048], order[x[k : k + 2048]]
                low, high = ends[row[c]], ends[row[c] + 1]
                start = low + band[c] * (self.budget[owner[c]] + 1) + offset[c]
                edits, end = self.align(points, low, high, self.window[owner[c]] + offset[c], start)
                for n in np.flatnonzero(edits < least[p]):
                    if edits[n] < least[p[n]]:
                        least[p[n]], chosen[p[n]] = edits[n], c[n]
                        starts[p[n]], stops[p[n]] = max(start[n], low[n]) - low[n], end[n] - low[n]
            at[open_] += take
            open_ = open_[at[open_] < last[open_]]
            open_ = open_[fewest[order[at[open_]]] < least[open_]]
            step *= 2
        for p in np.flatnonzero(chosen >= 0):
            yield int(chosen[p]), int(least[p]), int(starts[p]), int(stops[p])

    def align(self, points: np.ndarray, low: np.ndarray, high: np.ndarray, window: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Fewest edits of each window against the text from ``start``, over the diagonals that its band and edits reach,
        and where that alignment ends. The text may begin and end anywhere in the band."""
        most = int(self.most[window].max())
        wide = 4 * (most + 1) + 1
        begin = start - most
        column = np.arange(wide)
        far = np.int64(1 << 20)
        cost = np.zeros((len(window), wide), np.int64)
        out = np.full((len(window), wide), far)
        length, place = self.length[window], self.start[window]
        out[length == 0] = 0
        for i in range(int(length.max())):
            at = begin[:, None] + i + column
            inside = (at >= low[:, None]) & (at < high[:, None])
            same = inside & (points[np.clip(at, 0, len(points) - 1)] == self.flat[place + i][:, None])
            step = cost + np.where(same, 0, np.where(inside, 1, far))
            skip = np.concatenate([cost[:, 1:] + 1, np.full((len(window), 1), far)], axis=1)
            cost = np.minimum(step, skip)
            cost = np.minimum.accumulate(cost - column, axis=1) + column
            done = length == i + 1
            out[done] = cost[done]
        k = out.argmin(axis=1)
        return out[np.arange(len(k)), k], np.minimum(begin + length + k, high)


KIND = pa.list_(pa.struct([("item_id", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("edits", pa.int32())]))


def hits_of(index: Index, texts: pa.Array) -> pa.Array:
    found = index.search(texts)
    counts = np.bincount([f[0] for f in found], minlength=len(texts)) if found else np.zeros(len(texts), np.int64)
    items = pa.StructArray.from_arrays([pa.array([f[k] for f in found], kind) for k, kind in ((1, pa.int64()), (2, pa.int32()), (3, pa.int32()), (4, pa.int32()))],
                                       ["item_id", "start", "end", "edits"])
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), items)


def searched(text: Column, index: Broadcast) -> Column:
    @F.arrow_udf("array<struct<item_id:bigint,start:int,end:int,edits:int>>")
    def search(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield arrays.joined([hits_of(index.value, x) for x in arrays.slices(batch)], KIND)

    return search(text)


def hits(text: Column, benchmark: DataFrame, item_id: str = "item_id", item: str = "text", settings: Settings | None = None) -> Column:
    """Array of (item_id, start, end, edits): the benchmark items found in each text, by item; positions are those of the
    best window in the plain form of the text, end exclusive. Item ids are long integers."""
    s = settings or Settings()
    spark = benchmark.sparkSession
    items = benchmark.select(F.col(item_id).cast("long").alias("id"), plain(F.col(item)).alias("text")).where("id is not null and text is not null")
    total = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    passes = 1 + total // s.max_index_chars
    columns = []
    for k in range(passes):
        # One pass holds about max_index_chars characters of items, whatever the size of the benchmark.
        rows = items.where(F.pmod(F.xxhash64("id"), F.lit(passes)) == k).distinct().orderBy("id", "text").collect()
        columns.append(searched(plain(text), spark.sparkContext.broadcast(Index([tuple(r) for r in rows], s))))
    return columns[0] if passes == 1 else F.flatten(F.array(*columns))
