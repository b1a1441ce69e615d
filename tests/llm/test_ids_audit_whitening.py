"""Packed token ids, the audit of filters and the whitening, against plain Python and numpy."""

import json
import random
import re
import tracemalloc
import zlib
from collections import Counter
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tagloom.llm import arrays, filteraudit, packedids, queries, whitening
from tagloom.session import scratch_path

# --- packed ids ----------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def word_model():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def test_encoding_holds_a_slice_and_not_the_batch(word_model):
    rng = random.Random(3)
    texts = pa.array([" ".join(f"w{rng.randrange(40000)}" for _ in range(3000)) for _ in range(400)])
    before = pa.total_allocated_bytes()
    parts = arrays.slices(texts, 1 << 20)
    assert len(next(parts)) < 100 and pa.total_allocated_bytes() - before < 3 << 20
    packedids.tokenizer(word_model)
    tracemalloc.start()
    for x in arrays.slices(texts, packedids.ENCODE_BYTES):
        packedids.encode_texts(word_model, x, 1)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 80 << 20


@pytest.mark.parametrize("block", [8, 128, 256])
@pytest.mark.parametrize("percentile", [0.01, 0.5, 0.9, 1.0])
def test_blocks_round_trip(block, percentile):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.integers(0, 2**k, block * 3) for k in (0, 1, 5, 13, 16, 31, 32)]).astype(np.uint32)
    x[::17] = rng.integers(0, 2**32, len(x[::17]))
    x[-block:] = 2**32 - 1
    raw, sizes = packedids.encode_blocks(x, percentile, block)
    starts = np.cumsum(sizes) - sizes
    assert len(raw) == sizes.sum() and (packedids.decode_blocks(raw, starts, block) == x).all()
    assert (packedids.decode_blocks(raw, starts[3:9], block) == x[3 * block : 9 * block]).all()
    assert not len(packedids.decode_blocks(raw, starts[:0], block))


def test_width_is_the_percentile_and_longer_values_are_exceptions():
    x = np.arange(128, dtype=np.uint32) % 8 + 1000
    x[[5, 77]] = [4_000_000_000, 70_000]
    raw, sizes = packedids.encode_blocks(x, 0.9)
    assert raw[:4].view("<u4")[0] == 1000 and raw[4] == 3 and raw[5:7].view("<u2")[0] == 2
    assert sizes[0] == packedids.HEAD + 128 * 3 // 8 + 2 * 6
    assert raw[packedids.HEAD + 48 :][:4].view("<u2").tolist() == [5, 77]


def odd_texts(n=3000):
    rng = random.Random(7)
    bits = list("$%&.,-=~+_ßÿ×÷abAB '.<|>éẽ \n\t\r\x0b\x1c\x1f日本Σς1२#") + [
        "̸", "́", "　", " ", "<|endoftext|>", "<|startoftext|>", "'re", "가", "éx", "İ", "word", "x" * 300]
    return ["".join(rng.choices(bits, k=rng.randint(0, 40))) for _ in range(n)] + ["", "   ", "\n", "a" * 100_000, "ab, " * 50_000]


def test_ids_equal_those_of_the_library(word_model):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(word_model)
    texts = odd_texts()
    for _ in range(2):  # unknown pieces, then known ones
        ids, counts = packedids.encode_texts(word_model, next(arrays.slices(pa.array(texts), 1 << 30, 1 << 30)), 1)
        ends = np.cumsum(counts)
        for i, text in enumerate(texts):
            assert ids[ends[i] - counts[i] : ends[i]].tolist() == library.encode(text, add_special_tokens=False).ids + [1]


def test_pieces_beyond_the_cache_and_other_tokenizers(word_model, monkeypatch):
    monkeypatch.setattr(packedids, "CACHED", 5)
    few, many = packedids.Pieces(word_model), packedids.tokenizer(word_model)
    words = [f"w{chr(97 + i)}" for i in range(26)]
    for part in (words[:4], words, words[::-1]):
        got = few.look_up(part, np.array([i % 3 > 0 for i in range(len(part))]))
        want = many.look_up(part, np.ones(len(part), bool))
        assert all((a == b).all() for a, b in zip(got, want)) and len(few.known) <= 5
    import public_tokenizers

    with pytest.raises(ValueError):
        packedids.Pieces(public_tokenizers.path("byte_bpe_50k.json"))


def test_files_give_back_every_document_in_order(spark, word_model, tmp_path):
    texts = odd_texts(300)
    rows = [(i * 7 % 305, t, "x") for i, t in enumerate(texts)] + [(3, None, "x"), (3, "twice", "y"), (3, "twice", "y"), (None, "lost", None), (-5, "first", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(7)
    path = scratch_path(spark, "packed")
    packedids.write(docs, path, word_model, 1, shardtokens=5000, block=64, percentile=0.8)
    order = sorted(((d is not None, d or 0, t or "") for d, t, _ in rows), key=lambda r: r[:2])
    got = packedids.with_checksum(packedids.read(spark, path)).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == [d if known else None for known, d, _ in order]
    from tokenizers import Tokenizer

    library, start = Tokenizer.from_file(word_model), 0
    want = Counter((d if known else None, tuple(library.encode(t, add_special_tokens=False).ids + [1])) for known, d, t in order)
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in got) == want
    for r in got:
        assert r["start"] == start and r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        start += len(r["ids"])
    manifest = json.load(open(f"{path}/manifest.json"))
    assert manifest["tokens"] == start and len(manifest["shards"]) > 3
    shard = manifest["shards"][1]
    reader = packedids.ShardReader(f"{path}/{shard['file']}")
    whole = reader.ids(0, reader.tokens)
    assert len(whole) == shard["tokens"] and (reader.ids(100, 777) == whole[100:777]).all() and not len(reader.ids(5, 5))


def test_no_documents_and_a_foreign_file(spark, word_model, tmp_path):
    path = scratch_path(spark, "packed")
    packedids.write(spark.createDataFrame([], "doc_id long, text string"), path, word_model, 1)
    assert packedids.read(spark, path).count() == 0
    (tmp_path / "x.pfor").write_bytes(b"no shard" * 20)
    with pytest.raises(ValueError):
        packedids.ShardReader(str(tmp_path / "x.pfor"))


def test_leftovers_of_lost_tasks_are_not_read(spark, word_model):
    path = scratch_path(spark, "packed")
    packedids.write(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), path, word_model, 1)
    left = packedids.ShardWriter(f"{path}/left-behind.pfor", 0.9, 128)
    left.add(pa.array([9]), np.array([1, 2], np.uint32), np.array([2]))
    left.close()
    assert [r["doc_id"] for r in packedids.read(spark, path).collect()] == [1]


def test_the_query_equals_the_library(spark, sf, word_model):
    from tokenizers import Tokenizer

    library, start = Tokenizer.from_file(word_model), 0
    docs = sorted((r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    got = {r["doc_id"]: r for r in queries.op11_packed_token_ids(spark, sf).collect()}
    assert len(got) == len(docs)
    for i, text in docs:
        ids = library.encode(text, add_special_tokens=False).ids + [1]
        assert (got[i]["start"], got[i]["n_tokens"], got[i]["ids_crc32"]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


# --- filter audit --------------------------------------------------------------------------------------------------


def plain_audit(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    first, seen = {}, []
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    for i, t, s in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
                 "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and i > first[t]}
        seen.append((s or "", {f for f, bad in fails.items() if bad}, i in good, i in toxic))
    out, shares = {}, Counter()
    for order in permutations("ABCDE"):
        for part in {s for s, *_ in seen}:
            left, gone = [r for r in seen if r[0] == part], []
            for k, f in enumerate(order):
                removed = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                out[part, "".join(order), k + 1] = [len(left), len(removed), sum(f in r[1] for r in gone), sum(r[1] == {f} and r[0] == part for r in seen),
                                                   sum(r[2] for r in removed), sum(r[3] for r in removed)]
                shares[part, f] += len(removed)
                gone += removed
    return {k: (*v, shares[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_audit_equals_plain_python(spark):
    rng = random.Random(3)
    words = ["alpha", "beta", "Gamma", "DELTA", "x#", "é", "0", " ", "\x1c"]
    rows = []
    for i in range(160):
        n = rng.choice([0, 1, 49, 50, 51, 80])
        text = rng.choice([" ", "\t", " \x0b\n"]).join(rng.choices(words, k=n) if rng.random() < 0.5 else [f"w{k}" for k in range(n)])
        rows.append((rng.choice([i, i, rng.randrange(30), None]), rng.choice([text, text, None, "same text"]), rng.choice(["s1", "s2", "", None])))
    rows += [rows[0], rows[0], (400, "A " * 200_000, "s1"), (401, "A " * 200_000, "s3")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 160, 2)] + [(4, 1, 1), (4, 0, 1), (None, 1, 1)]
    docs = spark.createDataFrame([(i, t, s, "q", 9) for i, t, s in rows], "doc_id long, text string, source string, words string, class int")
    got = filteraudit.audit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert {(r["part"], r["filter_order"], r["step"]): tuple(r[n] for n in names) for r in got} == plain_audit(rows, labels)
    assert len(got) == 600 * 4


def test_audit_with_a_frequent_text_and_without_rows(spark, monkeypatch):
    monkeypatch.setattr(filteraudit, "HOT_SHARE", 2)
    rows = [(i, "hot text" if i % 3 else f"text {i}", "s") for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r["filter_order"]: r for r in filteraudit.audit(docs).where("step = 1").collect()}
    assert got["EABCD"]["removed"] == 59 and got["EABCD"]["good_lost"] == 0
    assert filteraudit.audit(docs.limit(0)).count() == 0


# --- whitening -----------------------------------------------------------------------------------------------------


def symmetric(kind, d, rng):
    a = rng.standard_normal((400, d))
    if kind == "decay":
        a = a * np.exp(-np.arange(d) / 3)
    if kind == "low rank":
        a = rng.standard_normal((400, 3)) @ rng.standard_normal((3, d))
    if kind == "equal":
        return np.eye(d) / d
    if kind == "clusters":
        q, _ = np.linalg.qr(rng.standard_normal((d, d)))
        v = q * np.r_[np.full(6, 2.0), np.full(5, 1.5), np.linspace(1, 0.1, d - 11)] @ q.T
        return (v + v.T) / 2 / np.trace(v)
    v = a.T @ a
    return v / np.trace(v)


@pytest.mark.parametrize("kind,d", [("plain", 64), ("decay", 64), ("low rank", 9), ("equal", 20), ("clusters", 30), ("plain", 1), ("plain", 5)])
def test_slices_and_pairs_of_the_spectrum(kind, d):
    rng = np.random.default_rng(2)
    v = symmetric(kind, d, rng)
    e = np.linalg.eigvalsh(v)[::-1]
    for shift in rng.uniform(-0.1, 1.1 * e[0], 20):
        assert whitening.count_above(v, shift) == (e > shift).sum()
    wanted = min(8, whitening.count_above(v, d * 2e-16))
    cuts = whitening.slices_of(v, wanted)
    assert sum(c[2] for c in cuts) >= wanted and all(a[0] == b[1] for a, b in zip(cuts, cuts[1:]))
    found = [whitening.feast(v, *c) for c in cuts]
    values, vectors = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found], axis=1)
    assert np.abs(values - e[: len(values)]).max() < 1e-13
    assert np.abs(v @ vectors - vectors * values).max() < 1e-13 and np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-11


def test_inertia_of_matrices_with_zero_pivots():
    for v in ([[0.0, 1.0], [1.0, 0.0]], [[0, 2, 0], [2, 0, 1], [0, 1, 0.0]], [[0.0, 0.0], [0.0, 0.0]], np.ones((4, 4)) - np.eye(4)):
        v = np.array(v)
        assert whitening.count_above(v, 0.0) == (np.linalg.eigvalsh(v) > 1e-12).sum()


def test_a_wrong_count_is_refused():
    with pytest.raises(ArithmeticError):
        whitening.feast(np.diag([3.0, 2.0, 1.0]), 1.5, 3.5, 1)


def whitened_by_numpy(vectors, k=8):
    x = np.floor(1024 * np.array(vectors, float)).astype(int) + 100_000
    centred = x - x.mean(axis=0)
    v = centred.T @ centred / len(x)
    e, q = np.linalg.eigh(v)
    order = np.argsort(-e)[:k]
    return x, centred @ q[:, order] / np.sqrt(e[order]), e[order] / np.trace(v)


def test_whitening_equals_numpy(spark):
    rng = np.random.default_rng(8)
    vectors = (rng.standard_normal((150, 12)) * np.linspace(2, 0.3, 12)).astype(np.float32)
    rows = [(i if i % 50 else None, v.tolist(), i) for i, v in enumerate(vectors)]
    rows += [(rows[3][0], rows[3][1], 0), (900, None, 0), (901, [float("nan")] * 12, 0), (902, [float("inf")] + [0.0] * 11, 0), (903, [None] * 12, 0), (904, [], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, n int").repartition(5)
    got = whitening.whiten(df, "vec_id").collect()
    kept = [r for r in rows[:151]]
    x, w, explained = whitened_by_numpy([r[1] for r in kept])
    n, s = len(x), x.sum(axis=0)
    assert len(got) == 8 * 151 and {r["n"] for r in got} == {151} and max(r["identity_error"] for r in got) < 1e-9
    deviation = Counter((r["id"], int(r["deviation"])) for r in got if r["component"] == 1)
    assert deviation == Counter((kept[i][0], sum((n * int(a) - int(b)) ** 2 for a, b in zip(x[i], s))) for i in range(n))
    of = {r[0]: i for i, r in enumerate(kept) if r[0] not in (None, rows[3][0])}
    signs = {}
    for r in got:
        c = r["component"] - 1
        assert r["explained"] == pytest.approx(explained[c], rel=1e-9)
        if r["id"] in of:
            want = w[of[r["id"]], c]
            signs.setdefault(c, np.sign(want * r["whitened"]))
            assert r["whitened"] == pytest.approx(signs[c] * want, abs=1e-8)


def test_whitening_of_few_and_equal_vectors(spark):
    schema = "id long, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], schema)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0])], schema)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0])] * 5, schema)).count() == 0
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 0.0]) for i in range(6)], schema)
    got = whitening.whiten(line).collect()
    assert {r["component"] for r in got} == {1} and len(got) == 6 and got[0]["explained"] == pytest.approx(1.0)
    with pytest.raises(ValueError):
        whitening.whiten(spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], schema))


def test_large_sums_stay_exact(spark):
    rows = spark.createDataFrame([(i, [float(2**18 + i), -float(2**19)]) for i in range(4)], "id long, v array<double>")
    model = whitening.Whitening(10**9, [10**9 * (1024 * 2**18 + 100_000) + 7, 5 * 10**8], np.zeros((0, 2)), np.zeros(0), 1.0)
    got = {r["id"]: int(r["deviation"]) for r in whitening.transform(rows, model).collect()}
    for i in range(4):
        x = [1024 * (2**18 + i) + 100_000, -1024 * 2**19 + 100_000]
        assert got[i] == sum((model.n * a - b) ** 2 for a, b in zip(x, model.sums))


def test_the_query_is_whitened_by_its_own_columns(spark, sf):
    got = queries.op13_contour_whitening(spark, sf)
    one = got.groupBy("component").agg(F.avg("whitened").alias("m"), F.var_pop("whitened").alias("v"), F.max("identity_error").alias("e"), F.sum("explained").alias("s")).collect()
    assert len(one) == 8 and all(abs(r["m"]) < 1e-9 and abs(r["v"] - 1) < 1e-9 and r["e"] < 1e-4 for r in one)
