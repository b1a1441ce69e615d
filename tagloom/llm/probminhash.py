"""Near-duplicate documents by ProbMinHash over weighted word shingles.

Every shingle sends out a Poisson process of arrivals, at a rate equal to its weight; each arrival picks a register at
random, and a register keeps the shingle that arrived first. A document stops its processes once they have passed its
largest register. Two registers agree with the probability Jaccard similarity of the weighted sets. Registers are cut
into bands, documents that share a band are candidates, and candidates are compared exactly on their shingles.

Texts are lower-cased and split at ASCII white space; a text of fewer words than a shingle is one shingle. Texts without
words (null, empty, blank) are alone in their class. Ids are long integers; a null id has a null class. Rows that share an
id share a class, which is that of any of their texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm import arrays
from tagloom.llm.common import components, fresh
from tagloom.session import written

# Shingle numbers keep 48 bits; the upper 16 of a sort key hold the row inside a slice.
ROW_BITS = 16


@dataclass(frozen=True)
class Settings:
    """With 25 bands of 5, a pair at the threshold of 0.8 shares no band with a probability of 5e-5.

    weight: "unit" compares distinct shingles, "count" weights a shingle with its occurrences.
    block: documents of a crowded band that are compared at once in one task.
    """

    words: int = 5
    similarity: float = 0.8
    bands: int = 25
    rows: int = 5
    weight: str = "unit"
    block: int = 256


def shingles(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each text of a slice: row, 48-bit shingle number (ascending inside a row) and occurrences."""
    raw, ends = arrays.flat_bytes(texts)
    start, stop, row = arrays.words(raw, ends, arrays.NOT_SPACE)
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    word = arrays.word_hashes(raw, start, stop)
    n = len(word)
    last = np.searchsorted(row, row, "right") - 1
    at = np.arange(n)
    head = np.flatnonzero((at + words - 1 <= last) | (np.concatenate([[True], row[1:] != row[:-1]])))
    total = np.zeros(len(head), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(words):
            inside = head + k <= last[head]
            part = arrays.mix(word[np.minimum(head + k, n - 1)] + np.uint64(k + 1) * arrays.BASE)
            total += np.where(inside, part, np.uint64(0))
    key = np.sort((row[head].astype(np.uint64) << np.uint64(64 - ROW_BITS)) | (arrays.mix(total) >> np.uint64(ROW_BITS)))
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    counts = np.diff(np.append(first, len(key)))
    key = key[first]
    return (key >> np.uint64(64 - ROW_BITS)).astype(np.int64), key & np.uint64((1 << (64 - ROW_BITS)) - 1), counts


def registers(row: np.ndarray, shingle: np.ndarray, weight: np.ndarray, rows: int, m: int) -> np.ndarray:
    """The ``rows`` x ``m`` shingles that arrived first; rows without shingles are left at 0."""
    first = np.full((rows, m), np.inf)
    owner = np.zeros((rows, m), np.uint64)
    flat_first, flat_owner = first.reshape(-1), owner.reshape(-1)
    seed = arrays.mix(shingle)
    time = np.zeros(len(row))
    step = 0
    scale = 2.0 ** -53
    while len(row):
        many = int(np.clip(65536 // len(row), 1, 64))  # arrivals drawn at once; later ones change nothing
        for _ in range(many):
            with np.errstate(over="ignore"):
                draw = arrays.mix(seed + np.uint64(2 * step + 1) * arrays.BASE)
                pick = arrays.mix(draw + arrays.BASE)
            time = time - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * scale) / weight
            to = row * m + ((pick >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
            early = np.flatnonzero(time < flat_first[to])
            np.minimum.at(flat_first, to[early], time[early])
            won = early[flat_first[to[early]] == time[early]]
            flat_owner[to[won]] = shingle[won]
            step += 1
        here = np.flatnonzero(np.bincount(row, minlength=rows))
        limit = np.zeros(rows)
        limit[here] = first[here].max(axis=1)
        go = time < limit[row]
        row, shingle, weight, seed, time = (x[go] for x in (row, shingle, weight, seed, time))
    return owner


def signature(text: Column, s: Settings) -> Column:
    """(lo, hi: 128 bits that name the weighted shingles; bands: one number per band), null without words."""
    kind = pa.struct([("lo", pa.int64()), ("hi", pa.int64()), ("bands", pa.list_(pa.int64()))])

    def one(texts: pa.Array) -> pa.Array:
        rows = len(texts)
        row, shingle, counts = shingles(texts, s.words)
        weight = counts.astype(np.float64) if s.weight == "count" else np.ones(len(row))
        own = registers(row, shingle, weight, rows, s.bands * s.rows).reshape(rows, s.bands, s.rows)
        with np.errstate(over="ignore"):
            place = np.arange(1, s.bands * s.rows + 1, dtype=np.uint64).reshape(s.bands, s.rows) * arrays.BASE
            bands = arrays.mix(arrays.mix(own + place).sum(axis=2, dtype=np.uint64)).view(np.int64)
            item = arrays.mix(shingle + np.uint64(7)) * weight.astype(np.uint64)
            names = []
            for salt in (np.uint64(0), arrays.BASE):
                total = np.zeros(rows, np.uint64)
                np.add.at(total, row, arrays.mix(item + salt))
                names.append(arrays.mix(total).view(np.int64))
        empty = np.bincount(row, minlength=rows) == 0
        lists = arrays.list_array(bands.reshape(-1), np.full(rows, s.bands), pa.int64())
        return pa.StructArray.from_arrays([pa.array(names[0]), pa.array(names[1]), lists], fields=list(kind), mask=pa.array(empty))

    @F.arrow_udf("lo bigint, hi bigint, bands array<bigint>")
    def sign(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield arrays.joined([one(x) for x in arrays.slices(batch)], kind)

    return sign(F.lower(text))


def packed(text: Column, s: Settings) -> Column:
    """The shingle numbers of a text and their occurrences, each as little-endian 64-bit integers on end."""
    @F.arrow_udf("shingles binary, counts binary")
    def pack(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = []
            for x in arrays.slices(batch):
                row, shingle, counts = shingles(x, s.words)
                at = np.searchsorted(row, np.arange(len(x) + 1))
                sets = [shingle[a:b].tobytes() for a, b in zip(at[:-1], at[1:])]
                many = [counts[a:b].tobytes() if s.weight == "count" else b"" for a, b in zip(at[:-1], at[1:])]
                parts.append(pa.StructArray.from_arrays([pa.array(sets, pa.binary()), pa.array(many, pa.binary())], ["shingles", "counts"]))
            yield arrays.joined(parts, pa.struct([("shingles", pa.binary()), ("counts", pa.binary())]))

    return pack(F.lower(text))


def probability_jaccard(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray) -> float:
    """Sum over common shingles d of 1 / sum over all e of max(wa(e) / wa(d), wb(e) / wb(d))."""
    _, ia, ib = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if not len(ia):
        return 0.0
    x, y = wa[ia].astype(float), wb[ib].astype(float)
    ratio = y / x
    order = np.argsort(ratio)
    x, y, ratio = x[order], y[order], ratio[order]
    # max(x_e / x_d, y_e / y_d): the first where ratio_e <= ratio_d.
    to = np.searchsorted(ratio, ratio, "right")
    left, right = np.concatenate([[0], np.cumsum(x)])[to], (y.sum() - np.concatenate([[0], np.cumsum(y)])[to])
    total = (left + wa.sum() - x.sum()) / x + (right + wb.sum() - y.sum()) / y
    return float((1 / total).sum())


def unpacked(sets: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    numbers = np.frombuffer(sets, np.uint64)
    return numbers, np.frombuffer(counts, np.int64) if counts else np.ones(len(numbers), np.int64)


def compared(pairs: DataFrame, s: Settings) -> DataFrame:
    """(u, v) of the pairs, given with both sides' packed shingles, that reach the similarity."""
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = {n: batch.column(n) for n in batch.schema.names}
            good = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                a, b = (unpacked(c[f"{x}_shingles"][i].as_py(), c[f"{x}_counts"][i].as_py()) for x in "uv")
                if s.weight == "unit":
                    both = len(np.intersect1d(a[0], b[0], assume_unique=True))
                    good[i] = both >= s.similarity * (len(a[0]) + len(b[0]) - both)
                else:
                    good[i] = probability_jaccard(*a, *b) >= s.similarity
            yield pa.RecordBatch.from_arrays([c["u"].filter(pa.array(good)), c["v"].filter(pa.array(good))], ["u", "v"])

    return pairs.mapInArrow(check, "u bigint, v bigint")


def block_links(s: Settings):
    """For one pair of blocks of a band: links that join classes, at most one fewer than documents."""
    def find(parent: np.ndarray, x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def similar(sets: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        n = len(sets)
        if s.weight != "unit":
            out = np.zeros((n, n), bool)
            for i in range(n):
                for j in range(i):
                    out[i, j] = probability_jaccard(*sets[i], *sets[j]) >= s.similarity
            return out
        size = np.array([len(x) for x, _ in sets])
        value, at, times = np.unique(np.concatenate([x for x, _ in sets]), return_inverse=True, return_counts=True)
        owner = np.repeat(np.arange(n), size)
        shared = times[at] > 1
        column, owner = (np.cumsum(times > 1) - 1)[at[shared]], owner[shared]
        both = np.zeros((n, n), np.float32)
        for c in range(0, int((times > 1).sum()), 4096):
            here = (column >= c) & (column < c + 4096)
            m = np.zeros((n, 4096), np.float32)
            m[owner[here], column[here] - c] = 1
            both += m @ m.T
        return both >= s.similarity * (size[:, None] + size[None] - both)

    def links(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("id", ignore_index=True)
        _, parent = np.unique(group["root"].to_numpy(), return_index=True)
        roots = group["root"].map(dict(zip(group["root"].to_numpy()[parent], parent))).to_numpy().copy()
        good = similar([unpacked(x, y) for x, y in zip(group["shingles"], group["counts"])])
        u, v = [], []
        for i, j in zip(*np.nonzero(np.tril(good, -1))):
            a, b = find(roots, i), find(roots, j)
            if a != b:
                roots[max(a, b)] = min(a, b)
                u.append(i)
                v.append(j)
        ids = group["id"].to_numpy()
        return pd.DataFrame({"u": ids[u], "v": ids[v]}, dtype="int64")

    return links


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", settings: Settings | None = None) -> DataFrame:
    """(id, class_id) for each row of ``docs``; class_id is the smallest id of the class.

    1. Signatures are made in the scan and written; documents with the same shingles are one representative from here on.
    2. Each band value held by several representatives compares its members with its smallest one: each distinct pair
       once, as a join that splits a hot side.
    3. Where that leaves a band value with members in different classes, those members are compared with each other in
       blocks; only links that join classes leave a task.
    4. Links of both steps are closed by connected components.
    """
    s = settings or Settings()
    if s.weight not in ("unit", "count"):
        raise ValueError("weight is unit or count")
    texts = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    signed = written(texts.select("id", signature(F.col("text"), s).alias("s")).select("id", "s.*"), "signatures")
    named = signed.where("bands is not null and id is not null")
    heads = written(named.groupBy("lo", "hi").agg(F.min("id").alias("rep"), F.first("bands").alias("bands")), "representatives")
    banded = heads.select("rep", F.explode("bands").alias("band"))
    crowded = written(banded.groupBy("band").agg(F.min("rep").alias("head"), F.count("*").alias("n")).where("n > 1"), "bands")
    members = written(banded.join(crowded, "band"), "members")
    pairs = written(members.where("rep > head").select("head", "rep").distinct(), "pairs")
    wanted = members.select(F.col("rep").alias("id")).distinct()
    # Only ids travel with the texts here; the wanted ones are the build side.
    chosen = texts.join(wanted.hint("shuffle_hash"), "id", "left_semi").select("id", packed(F.col("text"), s).alias("p"))
    sets = written(chosen.select("id", "p.*").groupBy("id", F.xxhash64("shingles", "counts").alias("h"))
                   .agg(F.first("shingles").alias("shingles"), F.first("counts").alias("counts")).drop("h"), "shingles")
    side = {x: sets.select(*(F.col(c).alias(f"{x}_{c}") for c in ("id", "shingles", "counts"))) for x in "uv"}
    full = (pairs.select(F.col("head").alias("u"), F.col("rep").alias("v"))
            .join(side["v"], F.col("v") == F.col("v_id")).join(side["u"], F.col("u") == F.col("u_id")))
    found = written(compared(full.drop("u_id", "v_id"), s), "links")
    roots = components(found, "components")

    rooted = members.where("rep > head").join(roots, F.col("rep") == F.col("id"), "left")
    rooted = written(rooted.select("band", F.col("rep").alias("id"), F.coalesce("root", "rep").alias("root")), "rooted")
    split = rooted.groupBy("band").agg(F.min("root").alias("a"), F.max("root").alias("b"), F.count("*").alias("n"),
                                       F.sum(F.xxhash64("id").cast("decimal(38,0)")).alias("who")).where("a < b")
    # Band values with the same members are compared once.
    split = written(split.groupBy("who", "n").agg(F.min("band").alias("band")), "unsettled")
    blocks = F.ceil(F.col("n") / s.block).cast("int")
    spread = rooted.join(split, "band").select("band", "id", "root", F.pmod(F.xxhash64("id"), blocks).cast("int").alias("b"), blocks.alias("k"))
    spread = spread.select("band", "id", "root", "b", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("o"))
    spread = spread.select("band", "id", "root", F.least("b", "o").alias("x"), F.greatest("b", "o").alias("y"))
    more = (spread.join(sets, "id").groupBy("band", "x", "y").applyInPandas(block_links(s), "u bigint, v bigint"))
    more = written(more, "more_links")
    star = roots.where("id > root").select(F.col("id").alias("u"), F.col("root").alias("v"))
    final = written(components(star.union(more), "classes"), "roots")

    reps = heads.select("lo", "hi", "rep").join(final, F.col("rep") == F.col("id"), "left")
    reps = written(reps.select("lo", "hi", F.coalesce("root", "rep").alias("class_id")), "classed")
    return (signed.select("id", "lo", "hi").join(reps, ["lo", "hi"], "left")
            .select(F.col("id").alias(doc_id), F.when(F.col("id").isNotNull(), F.coalesce("class_id", "id")).alias("class_id")))


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", settings: Settings | None = None) -> DataFrame:
    """``docs`` with one document of each class: its smallest id. Rows with a null id stay; of rows that repeat an id the
    texts that differ stay once each."""
    classes = written(near_duplicates(docs, doc_id, text, settings), "near_duplicates")
    gone = classes.where(f"class_id < {doc_id}").select(doc_id).distinct()
    again = written(classes.where(F.col(doc_id).isNotNull()).groupBy(doc_id).count().where("count > 1").select(doc_id), "repeated")
    # One shuffle of the texts at any size; ids are the build side.
    if again.isEmpty():
        return docs.join(gone.hint("shuffle_hash"), doc_id, "left_anti").select(docs.columns)
    once = docs.join(gone.union(again).distinct().hint("shuffle_hash"), doc_id, "left_anti")
    mark = fresh(docs, "text_hash")
    many = docs.join(again.join(gone, doc_id, "left_anti").hint("shuffle_hash"), doc_id, "left_semi")
    many = many.withColumn(mark, F.xxhash64(text)).dropDuplicates([doc_id, mark]).drop(mark)
    return once.select(docs.columns).unionByName(many.select(docs.columns))
