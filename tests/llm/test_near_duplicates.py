"""ProbMinHash classes against all pairs, and probability Jaccard against its definition."""

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest

from tagloom.llm import arrays, probminhash
from tagloom.llm.probminhash import Settings

SCHEMA = "doc_id long, text string"


def shingle_set(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_force(rows):
    sets = {i: shingle_set(t) for i, t in rows if i is not None}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        if sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


def corpus(seed=1):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows, n = [], 0
    for _ in range(40):
        words = rng.choices(vocabulary, k=rng.choice([3, 5, 8, 60, 200]))
        for _ in range(rng.randint(1, 6)):
            copy = list(words)
            for _ in range(rng.choice([0, 0, 1, 2, 4, 8])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((n, " ".join(copy)))
            n += 1
    rng.shuffle(rows)
    return rows


def classes(spark, rows, settings=None):
    out = probminhash.near_duplicates(spark.createDataFrame(rows, SCHEMA), settings=settings)
    return {r["doc_id"]: r["class_id"] for r in out.collect()}


def test_classes_equal_all_pairs(spark):
    rows = corpus()
    assert classes(spark, rows) == brute_force(rows)


def test_crowded_band_loses_no_link(spark):
    """Many edited copies of one text: some are linked only among themselves, in bands larger than a block."""
    rng = random.Random(3)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for family in range(12):
        words = list(base)
        for k in rng.sample(range(120), 4):
            words[k] = f"f{family}_{k}"
        for _ in range(5):
            copy = list(words)
            copy[rng.randrange(120)] = f"c{len(rows)}"
            rows.append((len(rows), " ".join(copy)))
    assert classes(spark, rows, Settings(block=8)) == brute_force(rows)


def test_null_empty_long_repeated_and_extra_columns(spark):
    long = " ".join(f"x{i % 977}" for i in range(60000))
    rows = [(1, None), (2, ""), (3, "  \n"), (4, "A b"), (5, "a  B"), (6, long), (7, long + " end"), (4, "A b"), (None, "a b"), (8, "a b c d e f")]
    got = probminhash.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(1, 1), (2, 2), (3, 3), (4, 4), (5, 4), (6, 6), (7, 6), (4, 4), (None, None), (8, 8)], key=str)
    wide = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], SCHEMA + ", id int, text_hash string")
    kept = probminhash.keep_first(wide)
    assert kept.columns == wide.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted([1, 2, 3, 4, 6, None, 8], key=str)


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert probminhash.near_duplicates(empty).count() == 0
    assert probminhash.keep_first(empty).count() == 0


def definition(a, b):
    total = 0.0
    for d in set(a) & set(b):
        total += 1 / sum(max(a.get(e, 0) / a[d], b.get(e, 0) / b[d]) for e in set(a) | set(b))
    return total


def test_probability_jaccard_equals_its_definition():
    rng = random.Random(5)
    for _ in range(50):
        a, b = ({rng.randrange(12): rng.randint(1, 9) for _ in range(rng.randint(1, 10))} for _ in range(2))
        sides = [(np.array(sorted(x), np.uint64), np.array([x[k] for k in sorted(x)])) for x in (a, b)]
        assert probminhash.probability_jaccard(*sides[0], *sides[1]) == pytest.approx(definition(a, b))


def test_registers_estimate_weighted_similarity():
    m = 2000
    texts = ["a a a b c d", "a a b b c e", "a"]
    row, shingle, counts = probminhash.shingles(pa.array(texts, pa.large_string()), 1)
    own = probminhash.registers(row, shingle, counts.astype(float), 3, m)
    pairs = {(0, 1): definition({"a": 3, "b": 1, "c": 1, "d": 1}, {"a": 2, "b": 2, "c": 1, "e": 1}), (0, 2): definition({"a": 3, "b": 1, "c": 1, "d": 1}, {"a": 1})}
    for (i, j), wanted in pairs.items():
        assert abs((own[i] == own[j]).mean() - wanted) < 4 * (wanted * (1 - wanted) / m) ** 0.5


def test_weighted_classes(spark):
    repeated = " ".join(["the same line of words here"] * 30)
    rows = [(1, repeated + " one two three four five six"), (2, repeated + " six seven eight nine ten eleven")]
    assert classes(spark, rows, Settings(weight="count")) == {1: 1, 2: 1}
    assert classes(spark, rows) == {1: 1, 2: 2}


def test_slices_do_not_change_signatures():
    texts = pa.array(["a b c d e f g", None, "", "x" * 50, "é ü a b c"], pa.string())
    whole = [x.to_pylist() for x in arrays.slices(texts)]
    parts = [x.to_pylist() for x in arrays.slices(texts, limit=10)]
    assert sum(whole, []) == sum(parts, []) and len(parts) > 1
