"""Shared-pass logistic models, hashed neighbours, quota splits, sparse axes, stages, ledger, keyword index, word blocks."""

import os
import random
import tracemalloc
import zlib
from itertools import combinations

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom import session
from tagloom.catalog import learning
from tagloom.operators import balance, decide, features, hashed, keywords, linear, models, neighbours, quota, sketch, stages, wordblocks
from tagloom.plans import experiments
from tagloom.session import scratch_path, written

# --- logistic models -----------------------------------------------------------------------------------------------


def labelled(spark, x, sets, sparse):
    vector = (lambda v: Vectors.sparse(len(v), [(j, float(a)) for j, a in enumerate(v) if a])) if sparse else (lambda v: Vectors.dense(v))
    rows = [(i, vector(v), s) for i, (v, s) in enumerate(zip(x, sets))]
    kind = T.StructType([T.StructField("id", T.LongType()), T.StructField("features", VectorUDT()), T.StructField("labels", T.ArrayType(T.StringType()))])
    return spark.createDataFrame(rows, kind).repartition(3)


def slope(x, y, w, coefficients, intercept):
    p = 1 / (1 + np.exp(-(x @ coefficients + intercept)))
    return np.append(x.T @ (w * (p - y)) + coefficients, (w * (p - y)).sum()) / w.sum()


@pytest.mark.parametrize("sparse,columns", [(False, 6), (True, 6), (True, 900)])
@pytest.mark.parametrize("class_weight", [None, "balanced"])
def test_all_labels_are_at_their_optimum(spark, sparse, columns, class_weight, monkeypatch):
    monkeypatch.setattr(linear, "BLOCK_ROWS", 37)
    rng = np.random.default_rng(1)
    x = rng.exponential(1, (180, columns)) * (rng.random((180, columns)) < (5 / columns if columns > 10 else 0.6))
    x[7] = 0
    names = ["common", "rare", "none", "all"]
    held = np.stack([x[:, 0] + rng.normal(0, 0.3, 180) > 0.4, rng.random(180) < 0.05, np.zeros(180, bool), np.ones(180, bool)], axis=1)
    rows = labelled(spark, x, [[n for n, h in zip(names, row) if h] for row in held], sparse)
    model = models.fit_multilabel(rows, names, "lreg", class_weight, columns)
    for k in (0, 1):
        m, y = model.models[names[k]][0], held[:, k].astype(float)
        w = np.ones(180) if class_weight is None else np.where(y > 0, 90 / y.sum(), 90 / (180 - y.sum()))
        assert np.abs(slope(x, y, w, m.coefficients.toArray(), m.intercept)).max() < 2e-7
    assert model.models["none"][0].intercept == -np.inf and model.models["all"][0].intercept == np.inf
    got = model.predict_proba(rows).orderBy("id").collect()
    m = model.models["common"][0]
    for r in got[:20]:
        assert r["proba"][0] == pytest.approx(1 / (1 + np.exp(-(x[r["id"]] @ m.coefficients.toArray() + m.intercept))))
        assert r["proba"][2:] == [0.0, 1.0]


def test_jobs_do_not_grow_with_the_labels(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(120, 4))
    passes = []
    for n in (1, 12):
        rows = labelled(spark, x, [[f"l{k}" for k in range(n) if rng.random() < 0.4] for _ in x], False)
        passes.append(models.fit_multilabel(rows, [f"l{k}" for k in range(n)], "lreg", n_features=4).models["l0"][0].passes)
    assert max(passes) <= 12


@pytest.mark.parametrize("columns", [5, 700])
def test_models_that_fit_a_task_take_no_job_a_pass(spark, columns, monkeypatch):
    rng = np.random.default_rng(6)
    x = rng.exponential(1, (150, columns)) * (rng.random((150, columns)) < (5 / columns if columns > 10 else 0.6))
    names = ["a", "b", "never"]
    sets = [[n for n, p in zip(names, (0.4 + 0.4 * (r[0] > 0.5), 0.1, 0)) if rng.random() < p] for r in x]
    rows = labelled(spark, x, sets, True)
    more = spark.createDataFrame([(1, 1, Vectors.dense(x[3] + x[4]), 1), (2, 2, Vectors.dense(x[5]), 1)], T.StructType([
        T.StructField("id", T.LongType()), T.StructField("copy", T.LongType()), T.StructField("features", VectorUDT()), T.StructField("y", T.IntegerType())]))
    sums, fits = [], {}
    monkeypatch.setattr(linear, "added", lambda *a, of=linear.added: sums.append(a[2]) or of(*a))
    for limit in (linear.HELD_BYTES, 0):
        monkeypatch.setattr(linear, "HELD_BYTES", limit)
        sums.clear()
        fits[limit] = models.fit_multilabel(rows, names, "lreg", "balanced", columns, {"b": more}).models
        assert (len(sums) == 1) == (limit > 0)
    (held, shared) = fits.values()
    for name in names[:2]:
        assert held[name][0].coefficients.toArray() == pytest.approx(shared[name][0].coefficients.toArray(), abs=1e-5)
        assert held[name][0].intercept == pytest.approx(shared[name][0].intercept, abs=1e-5)
    assert held["never"][0].intercept == -np.inf


def test_a_task_makes_one_vector_of_sums(spark, monkeypatch):
    p, seen = 200_000, []
    one = F.array(F.lit(1).cast("tinyint"))
    rows = spark.createDataFrame([(Vectors.sparse(p, [1, 5], [1.0, 2.0]),)], T.StructType([T.StructField("features", VectorUDT())]))
    batch = linear.pack(rows.select("features", one.alias("y"), one.alias("copies"), F.lit(-1).alias("only"))).toArrow().to_batches()

    def measured(blocks, run, size):
        tracemalloc.start()
        out = run(iter(batch))
        seen.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        return out

    monkeypatch.setattr(linear, "added", measured)
    loss, slope, _ = linear.Fit(None, 1, 1, p, np.ones((2, 1))).evaluate(np.zeros((p + 1, 1)), np.array([0]), False)
    assert loss == pytest.approx([np.log(2)]) and slope[[1, 5, p], 0] == pytest.approx([-0.5, -1.0, -0.5])
    assert seen[0] < 1.2 * 8 * p


def test_synthetic_rows_count_for_their_label_only(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(90, 3))
    y = (x[:, 0] > 0.8).astype(int)
    rows = labelled(spark, x, [["p", "q"] if v else [] for v in y], False)
    bare = rows.select("id", F.col("features"), F.array_contains("labels", "p").cast("int").alias("y"))
    dense = bare.select("id", F.transform(F.unwrap_udt("features")["values"], lambda v: v).alias("features"), "y")
    made = balance.smote(dense, 25).withColumn("features", array_to_vector("features"))
    model = models.fit_multilabel(rows, ["p", "q"], "lreg", n_features=3, per_label={"p": made})
    more = np.array([r["features"].toArray() for r in made.where("copy > 0").collect()])
    all_x, all_y = np.concatenate([x, more]), np.concatenate([y, np.ones(len(more))])
    p, q = model.models["p"][0], model.models["q"][0]
    assert len(more) == 25
    assert np.abs(slope(all_x, all_y, np.ones(len(all_y)), p.coefficients.toArray(), p.intercept)).max() < 2e-7
    assert np.abs(slope(x, y, np.ones(90), q.coefficients.toArray(), q.intercept)).max() < 2e-7


def test_too_many_coefficients_are_refused(spark, monkeypatch):
    monkeypatch.setattr(linear, "MAX_COEFFICIENTS", 10)
    with pytest.raises(ValueError):
        models.fit_multilabel(labelled(spark, np.eye(4), [["a"], [], ["a"], []], False), ["a", "b", "c"], "lreg", n_features=4)


# --- neighbours ----------------------------------------------------------------------------------------------------


def recall(spark, x, k, sparse=False, **options):
    if sparse:
        rows = [(i, (np.flatnonzero(v).tolist(), v[v != 0].tolist())) for i, v in enumerate(x)]
        v = spark.createDataFrame(rows, "id long, vector struct<indices:array<int>,values:array<double>>")
    else:
        v = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "id long, vector array<double>")
    got = hashed.nearest_hashed(v, v, k, exclude_self=True, **options).collect()
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    for r in got:
        assert r["distance"] == pytest.approx(d[r["id"], r["neighbour_id"]]) and r["id"] != r["neighbour_id"]
    assert sorted((r["id"], r["rank"]) for r in got) == [(i, j) for i in range(len(x)) for j in range(1, k + 1)]
    np.fill_diagonal(d, np.inf)
    far = np.sort(d, axis=1)[:, k - 1]
    return np.mean([r["distance"] <= far[r["id"]] + 1e-9 for r in got])


def test_hashed_neighbours_of_clusters_and_of_noise(spark):
    rng = np.random.default_rng(4)
    clusters = np.repeat(rng.normal(size=(40, 16)) * 10, 10, axis=0) + rng.normal(size=(400, 16))
    assert recall(spark, clusters, 5) > 0.95
    assert recall(spark, rng.normal(size=(300, 32)), 5) > 0.93


def test_hashed_neighbours_of_sparse_rows_and_copies(spark):
    rng = np.random.default_rng(5)
    x = rng.exponential(1, (200, 300)) * (rng.random((200, 300)) < 0.05)
    x[50:120] = x[0]  # a hot bucket, cut into blocks
    assert recall(spark, x, 3, sparse=True, block_rows=16) > 0.95
    assert recall(spark, np.ones((30, 4)), 4, block_rows=8) == 1.0


def test_queries_that_meet_too_few_points_are_searched_exactly(spark):
    far = hashed.Tables(tables=1, hashes=8, probes=1, width=0.01)
    assert recall(spark, np.random.default_rng(6).normal(size=(60, 8)), 3, tables=far) == 1.0
    none = spark.createDataFrame([], "id long, vector array<double>")
    one = spark.createDataFrame([(1, [0.0])], "id long, vector array<double>")
    assert hashed.nearest_hashed(one, none, 3).count() == 0 and hashed.nearest_hashed(one, one, 3).count() == 1
    with pytest.raises(ValueError):
        hashed.Tables(probes=0)


def test_vectors_are_written_once_and_noise_is_searched_exactly(spark, monkeypatch):
    kept = []
    for module in (hashed, neighbours):
        monkeypatch.setattr(module, "written", lambda df, name, put=module.written: kept.append((name, put(df, name))) or kept[-1][1])
    rng = np.random.default_rng(9)
    assert recall(spark, rng.normal(size=(300, 16)), 3) == 1.0  # the tables would compare more pairs than there are
    rows = {name: df.count() for name, df in kept}
    assert rows["buckets"] == rows["probes"] == 300 and "hashed" not in rows


def test_a_large_block_is_searched_in_slices(monkeypatch):
    rng = np.random.default_rng(10)
    x, y = rng.normal(size=(50, 4)), rng.normal(size=(90, 4))
    p, q = ({"id": np.arange(len(z)), "indices": None, "values": list(z)} for z in (y, x))
    run = neighbours.search_block(3, False, False)
    want = run(pd.DataFrame(q), pd.DataFrame(p))
    held = []
    monkeypatch.setattr(neighbours, "SLICE_VALUES", 400)
    monkeypatch.setattr(neighbours, "distances", lambda a, b, of=neighbours.distances: held.append(a.n * b.n) or of(a, b))
    assert run(pd.DataFrame(q), pd.DataFrame(p)).equals(want) and max(held) <= 400 and len(want) == 150


def test_smote_with_hashed_neighbours(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(40, 3))
    df = spark.createDataFrame([(i, v.tolist(), int(i < 25)) for i, v in enumerate(x)], "id long, features array<double>, y int")
    made = [r for r in balance.smote(df, 30, search="hashed").collect() if r["copy"]]
    assert len(made) == 30 and all(r["y"] == 1 for r in made)
    for r in made:  # on a line between its source and another positive
        a = x[r["id"]]
        assert any(np.allclose(np.cross(np.array(r["features"]) - a, x[j] - a), 0, atol=1e-9) for j in range(25) if j != r["id"])
    with pytest.raises(ValueError):
        balance.smote(df, 3, search="guess")


# --- quotas --------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("ratio", [0.1, 0.3])
def test_quotas_of_labels_and_pairs_hold(spark, ratio):
    rng = random.Random(8)
    names = [f"n{k:02d}" for k in range(18)]
    weights = [1 / (k + 1) for k in range(18)]
    rows = [(i, sorted(set(rng.choices(names, weights, k=rng.randint(0, 6))))) for i in range(1500)]
    rows += [(1500 + i, None) for i in range(20)] + [(1520 + i, ["n00", "n00"]) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, labels array<string>").withColumn("split", F.lit("x"))
    got = {r["id"]: r["split"] for r in quota.quota_split(df.drop("split"), ratio).collect()}
    assert len(got) == len(rows)
    parts = {}
    for i, labels in rows:
        s = sorted(set(labels or []))
        for part in [(), *((a,) for a in s), *combinations(s, 2)]:
            parts.setdefault(part, []).append(got[i] == "test")
    off = {p: abs(sum(t) - ratio * len(t)) for p, t in parts.items() if len(p) < 2 or ratio * len(t) >= 1}
    assert max(off.values()) < 1 and len(off) > 60
    assert got == {r["id"]: r["split"] for r in quota.quota_split(df.drop("split").repartition(5), ratio).collect()}


def test_quota_split_of_few_records(spark):
    none = spark.createDataFrame([], "id long, labels array<string>")
    assert quota.quota_split(none).count() == 0
    one = spark.createDataFrame([(1, ["a"])], "id long, labels array<string>")
    assert quota.quota_split(one).count() == 1
    with pytest.raises(ValueError):
        quota.quota_split(one, 1.0)


# --- sparse axes ---------------------------------------------------------------------------------------------------


def test_sparse_axes_equal_those_of_numpy(spark):
    rng = np.random.default_rng(9)
    x = (rng.random((120, 400)) < 0.03) * rng.exponential(1, (120, 400))
    x[:, :5] += rng.normal(size=(120, 1)) * [3, 2, 1, 1, 1] + rng.normal(size=(120, 1)) * [1, -2, 1, 0, 0]
    x[11] = 0
    cells = spark.createDataFrame([(int(i), f"c{j}", float(x[i, j])) for i, j in zip(*np.nonzero(x))], "id long, column string, value double")
    ids = spark.createDataFrame([(i,) for i in range(120)], "id long")
    found = sketch.fit(cells, ids, 2, passes=3)
    c = x - x.mean(axis=0)
    _, s, vt = np.linalg.svd(c, full_matrices=False)
    assert found.variances == pytest.approx(s[:2] ** 2 / 119, rel=1e-6) and found.total == pytest.approx((s**2).sum() / 119)
    axes = {r["column"]: r["axis"] for r in found.axes.collect()}
    a = np.array([axes.get(f"c{j}", [0, 0]) for j in range(400)])
    assert np.abs(np.abs(a.T @ vt[:2].T) - np.eye(2)).max() < 1e-4
    got = np.array([r["projection"] for r in found.project(cells, ids).orderBy("id").collect()])
    assert got == pytest.approx(c @ a, abs=1e-9)


def test_axes_of_empty_and_of_constant_rows(spark):
    ids = spark.createDataFrame([(1,), (2,)], "id long")
    none = spark.createDataFrame([], "id long, column string, value double")
    assert sketch.fit(none, ids).project(none, ids).count() == 2
    same = spark.createDataFrame([(1, "a", 2.0), (2, "a", 2.0)], "id long, column string, value double")
    assert sketch.fit(same, ids).total == pytest.approx(0)


def test_products_with_many_columns_are_neither_sorted_nor_kept_by_name(spark, monkeypatch):
    kept = {}
    monkeypatch.setattr(sketch, "written", lambda df, name, put=sketch.written: kept.setdefault(name, put(df, name)))
    columns = spark.range(3).select(F.concat(F.lit("c"), "id").alias("column"), F.array(F.col("id") + 1.0, F.col("id") * 2.0).alias("v"))
    cells = spark.createDataFrame([(1, "c0", 2.0), (1, "c2", 1.0), (2, "c1", -1.0)], "id long, column string, value double")
    y = sketch.dotted(cells, columns, "v", 2)
    assert {r["id"]: r["y"] for r in y.collect()} == {1: [5.0, 4.0], 2: [-2.0, -2.0]}
    plan = y._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan
    found = sketch.fit(cells, spark.range(1, 4), 2)
    assert kept["range"].schema["column"].dataType.simpleString() == "bigint"
    assert {r["column"] for r in found.axes.collect()} == {"c0", "c1", "c2"}


@pytest.mark.parametrize("joined", [False, True])
def test_vectors_of_columns_are_written_for_many_rows_only(spark, monkeypatch, joined):
    kept = []
    monkeypatch.setattr(sketch, "written", lambda df, name, put=sketch.written: kept.append((name, df.columns)) or put(df, name))
    monkeypatch.setattr(sketch, "SLICE_CELLS", 40)
    monkeypatch.setattr(sketch, "JOB_NUMBERS", 200)  # some jobs a pass
    if joined:
        monkeypatch.setattr(sketch, "ROW_NUMBERS", 0)
    rng = np.random.default_rng(4)
    x = (rng.random((50, 90)) < 0.2) * rng.exponential(1, (50, 90))
    x[:, 0], x[7] = rng.normal(size=50) * 3, 0
    cells = spark.createDataFrame([(f"r{i}", f"c{j}", float(x[i, j])) for i, j in zip(*np.nonzero(x))], "id string, column string, value double")
    ids = spark.createDataFrame([(f"r{i}",) for i in range(50)], "id string")
    found = sketch.fit(cells, ids, 2, passes=6)
    _, s, vt = np.linalg.svd(x - x.mean(axis=0), full_matrices=False)
    assert found.variances == pytest.approx(s[:2] ** 2 / 49, rel=1e-4) and found.total == pytest.approx((s**2).sum() / 49)
    a = np.array([r["axis"] for r in sorted(found.axes.collect(), key=lambda r: int(r["column"][1:]))])
    assert np.abs(np.abs(a.T @ vt[:2].T) - np.eye(2)).max() < 0.01
    assert joined or not any({"z", "axis", "y"} & set(c) for _, c in kept) and len(kept) == 2


def test_packed_rows_of_one_partition_are_dealt_to_all_cores(spark):
    one = F.array(F.lit(1).cast("tinyint"))
    rows = spark.range(64).coalesce(1).select(array_to_vector(F.array(F.col("id").cast("double"))).alias("features"), one.alias("y"), one.alias("copies"), F.lit(-1).alias("only"))
    blocks = linear.pack(rows)
    assert len(blocks.inputFiles()) == min(spark.sparkContext.defaultParallelism, 64)
    assert blocks.agg(F.sum("n")).first()[0] == 64


# --- stages --------------------------------------------------------------------------------------------------------

TEXTS = [("red apple pie", ["fruit"]), ("green apple", ["fruit", "green"]), ("green car green", ["green"]), ("", []), ("blue car", []), ("apple apple car", ["fruit"])]


@pytest.mark.parametrize("vectorizer", ["count", "tf-idf"])
@pytest.mark.parametrize("estimator", ["lreg", "bayes", "dt"])
def test_saved_stages_predict_the_same(spark, vectorizer, estimator):
    docs = spark.createDataFrame([(i, t, s) for i, (t, s) in enumerate(TEXTS)], "id long, description string, labels array<string>")
    line = Pipeline(stages=[stages.TermVectorizer(vectorizer=vectorizer, ngram=(1, 2)),
                            stages.PerLabelClassifier(vocabulary=["fruit", "green"], estimator=estimator, classWeight="balanced" if estimator == "lreg" else "")])
    fitted = line.fit(docs)
    path = scratch_path(spark, "stages")
    fitted.write().overwrite().save(path)
    again = PipelineModel.load(path)
    new = spark.createDataFrame([(7, "green apple unseen"), (8, ""), (9, None)], "id long, description string")
    show = lambda m: [(r["id"], r["proba"]) for r in m.transform(new).orderBy("id").collect()]
    assert show(again) == show(fitted) and len(show(again)) == 3
    assert again.stages[0].getOrDefault("ngram") == [1, 2] and again.stages[1].fitted.vocabulary == ["fruit", "green"]


def test_a_stage_of_another_format_is_refused(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a b", ["x"])], "id long, description string, labels array<string>")
    path = scratch_path(spark, "stages")
    monkeypatch.setattr(stages, "FORMAT", 99)
    stages.TermVectorizer().fit(docs).write().save(path)
    monkeypatch.setattr(stages, "FORMAT", 1)
    with pytest.raises(ValueError, match="99"):
        stages.TermVectorizerModel.load(path)
    with pytest.raises(ValueError):
        stages.TermVectorizer(vectorizer="nope")
    with pytest.raises(ValueError):
        stages.PerLabelClassifier(estimator="nope")


# --- run matrix ----------------------------------------------------------------------------------------------------


def test_a_stopped_matrix_goes_on(spark, monkeypatch):
    rng = random.Random(10)
    rows = [(i, " ".join(rng.choices(["red", "green", "blue", "car", "pie"], k=8)), ["a"] if i % 3 else ["a", "b"]) for i in range(90)]
    docs = spark.createDataFrame(rows, "id long, description string, labels array<string>")
    runs = [experiments.Config(f"run {k}", vectorizer=v, class_weight=w) for k, (v, w) in enumerate(
        [("count", None), ("tf-idf", None), ("count", "balanced")])]
    path, fits = scratch_path(spark, "ledger"), []
    fit = models.fit_multilabel

    def counted(*args, **options):
        if len(fits) == 1 and not counted.on:
            raise RuntimeError("stopped")
        fits.append(args[3])
        return fit(*args, **options)

    counted.on = False
    monkeypatch.setattr(models, "fit_multilabel", counted)
    with pytest.raises(RuntimeError):
        experiments.run_matrix(docs, ["a", "b"], runs, test=0.2, ledger=path)
    assert len(fits) == 1
    counted.on = True
    got = {(r["run"], r["metric"]): r["value"] for r in experiments.run_matrix(docs, ["a", "b"], runs, test=0.2, ledger=path).collect()}
    assert len(fits) == 3 and len(got) == 3 * len(experiments.METRICS)
    plain = experiments.run_matrix(docs, ["a", "b"], runs, test=0.2).collect()
    assert got == {(r["run"], r["metric"]): r["value"] for r in plain} and len(fits) == 6
    experiments.run_matrix(docs.limit(80), ["a", "b"], runs[:1], test=0.2, ledger=path)
    assert len(fits) == 7  # other records, another run


def test_ratios_share_the_neighbours_of_their_rows(spark, monkeypatch):
    rng = random.Random(11)
    rows = [(i, " ".join(rng.choices(["red", "green", "blue", "car", "pie"], k=8)), ["a"] if i % 4 else ["a", "b"]) for i in range(80)]
    docs = spark.createDataFrame(rows, "id long, description string, labels array<string>")
    runs = [experiments.Config(f"{v} {r}", vectorizer=v, balancing_ratio=r) for r in (0.6, 0.9) for v in ("count", "tf-idf")]
    value = lambda rows: {(r["run"], r["metric"]): r["value"] for r in rows}
    alone = [experiments.run_matrix(docs, ["a", "b"], [run], test=0.2).collect() for run in runs[2:]]
    searches = []
    monkeypatch.setitem(balance.SEARCHES, "exact", lambda *a, of=balance.SEARCHES["exact"], **k: searches.append(1) or of(*a, **k))
    got = value(experiments.run_matrix(docs, ["a", "b"], runs, test=0.2).collect())
    assert len(searches) == 2  # one label to balance, two kinds of rows
    assert value(r for rows in alone for r in rows) == {k: v for k, v in got.items() if "0.9" in k[0]}


# --- keywords ------------------------------------------------------------------------------------------------------


def test_keyword_index_equals_contains(spark):
    rng = random.Random(11)
    alphabet = "abAB é😀 ."
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 60))) for _ in range(200)] + [None, "", "x" * 100_000 + "needle"]
    words = list({"".join(rng.choices("abé😀 .", k=rng.randint(0, 6))) for _ in range(150)}) + ["needle", "AB", "zzzz", ""]
    lists = [(f"l{i % 4}", w) for i, w in enumerate(words)] + [("l0", "a"), ("l0", "a"), ("l9", None)]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, description string")
    table = spark.createDataFrame(lists, "label string, keyword string")
    got = {(r["id"], r["keyword"]) for r in keywords.keyword_hits(df, table).collect()}
    low = {i: t.lower() for i, t in enumerate(texts) if t is not None}
    assert got == {(i, w) for i, t in low.items() for w in set(words) | {"a"} if w in t}
    share = {(r["id"], r["label"]): r["fraction"] for r in keywords.keyword_fractions(df, table).collect()}
    for label in ("l0", "l1", "l2", "l3"):
        own = [w for v, w in lists if v == label]
        for i, t in low.items():
            assert share.get((i, label), 0.0) == pytest.approx(sum(w in t for w in own) / len(own))


def test_keyword_index_writes_nothing_that_grows_with_the_texts(spark, monkeypatch):
    kept = []
    monkeypatch.setattr(keywords, "written", lambda df, name, put=keywords.written: kept.append(put(df, name)) or kept[-1])
    table = spark.createDataFrame([("needle",), ("é",), ("",), ("ee",), ("nee zz",)], "keyword string")
    df = spark.range(300).select("id", F.concat(F.lit("a NEEDLE "), F.col("id").cast("string"), F.when(F.col("id") == 7, "É")).alias("description"))
    df = df.unionByName(spark.range(300, 600).select("id", F.concat(F.lit("no nee dle "), F.col("id").cast("string")).alias("description")))
    got = sorted((r["id"], r["keyword"]) for r in keywords.keyword_hits(df, table).collect())
    assert got == sorted([(7, "needle"), (7, "é"), (7, "ee"), (7, "")] + [(i, k) for i in range(300, 600) for k in ("ee", "")])
    assert sum(t.count() for t in kept) < 30


def test_boost_by_table_equals_boost_by_lists(spark):
    lists = {"x": ["red", "a"], "y": ["blue"], "z": []}
    df = spark.createDataFrame([(1, "Red car", [0.1, 0.2, 0.3]), (2, "blue", [0.5, 0.5, 0.5]), (3, "", [0.0, 0.0, 0.0])], "id long, description string, proba array<double>")
    table = spark.createDataFrame([(k, w) for k, v in lists.items() for w in v], "label string, keyword string")
    a = decide.boost_proba(df, lists, ["x", "y", "z"]).orderBy("id").collect()
    b = keywords.boost_proba_by_table(df, table, ["x", "y", "z"]).orderBy("id").collect()
    assert a == b
    assert keywords.keyword_hits(df, table.limit(0)).count() == 0


# --- word vectors --------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("block_words", [1000, 12])
def test_words_that_occur_together_end_near_each_other(spark, block_words):
    rng = random.Random(12)
    topics = [[f"t{k}w{j}" for j in range(12)] for k in range(3)]
    rows = [(i, " ".join(rng.choices(topics[i % 3], k=30))) for i in range(240)] + [(900, None), (901, ""), (902, "rare words")]
    df = spark.createDataFrame(rows, "id long, description string")
    got = {r["word"]: np.array(r["vec"]) for r in wordblocks.train_word_blocks(df, vector_size=16, epochs=20 if block_words > 36 else 8, block_words=block_words).collect()}
    assert sorted(got) == sorted(w for t in topics for w in t)
    unit = {w: v / np.linalg.norm(v) for w, v in got.items()}
    same = np.mean([unit[a] @ unit[b] for t in topics for a, b in combinations(t, 2)])
    other = np.mean([unit[a] @ unit[b] for a in topics[0] for b in topics[1] + topics[2]])
    assert same > other + 0.1
    assert wordblocks.train_word_blocks(df.where("id > 899")).count() == 0


@pytest.mark.parametrize("blocks", [1, 2, 3])
def test_packed_pairs_equal_those_counted_one_by_one(spark, blocks, monkeypatch):
    monkeypatch.setattr(wordblocks, "PACKED", 2)
    texts = ["a b c a d", "b b zz a c c e", None, "", "e"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, description string")
    words = spark.createDataFrame([(w, i) for i, w in enumerate("abcde")], "word string, place long")
    got, want = {}, {}
    lists = wordblocks.near_lists(df, words, "description", F.lit(0.5))
    for r in wordblocks.near_pairs(lists, 2, blocks).collect():
        for a, b, w in np.frombuffer(r["data"], wordblocks.PAIR):
            key = (int(a) * blocks + r["block"], int(b) * blocks + (r["block"] + r["turn"]) % blocks)
            assert key not in got
            got[key] = float(w)
    for text in texts:
        p = ["abcde".index(x) for x in (text or "").split() if x != "zz"]
        for i, d in ((i, d) for i in range(len(p)) for d in (1, 2) if i + d < len(p)):
            for key in {(p[i], p[i + d]), (p[i + d], p[i])}:
                want[key] = want.get(key, 0) + (3 - d) / 2 * 0.25
    assert got == pytest.approx(want)


def files_of_blocks(spark):
    return spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().size()


def test_written_tables_leave_no_shuffle_files(spark):
    before = files_of_blocks(spark)
    dealt = written(spark.range(1000).repartition(3, "id"), "dealt")
    assert files_of_blocks(spark) <= before and spark.conf.get(session.FREE_SHUFFLES) == "false"
    assert dealt.count() == 1000


def test_rounds_of_word_vectors_keep_one_set_of_blocks(spark, monkeypatch):
    paths = []
    monkeypatch.setattr(wordblocks, "scratch_path", lambda *a, of=wordblocks.scratch_path: paths.append(of(*a)) or paths[-1])
    texts = [(i, " ".join(random.Random(i).choices("abcdefgh", k=20))) for i in range(40)]
    before = files_of_blocks(spark)
    found = wordblocks.train_word_blocks(spark.createDataFrame(texts, "id long, description string"), vector_size=4, epochs=2, block_words=3)
    assert found.count() == 8
    kinds = [os.path.basename(p).rsplit("-", 1)[0] for p in paths]
    assert kinds.count("word-blocks") == 1 + 2 * 3 and kinds.count("pairs") == 1
    assert [k for k, p in zip(kinds, paths) if os.path.exists(p.removeprefix("file://"))] == ["word-blocks"]
    assert files_of_blocks(spark) <= before + 8  # those of the count above


def test_pairs_are_stored_once_in_few_bytes(spark):
    texts = [(i, " ".join(f"w{int(x)}" for x in np.random.default_rng(i).zipf(1.3, 400) % 300)) for i in range(30)]
    df = spark.createDataFrame(texts, "id long, description string")
    parts = written(wordblocks.pieces(df, "description"), "pieces")
    words = wordblocks.vocabulary(parts, 1)
    counted = wordblocks.pair_counts(wordblocks.known_lists(parts, words, F.lit(1.0)), 5, 2).where(f"turn <> {wordblocks.DEGREES}").collect()
    names = {r["place"]: r["word"] for r in words.collect()}
    got, want = {}, {}
    for r in counted:
        for a, b, n in zip(*wordblocks.unpacked(r["data"])):
            key = tuple(sorted((names[a * 2 + r["block"]], names[b * 2 + (r["block"] + r["turn"]) % 2])))
            assert key not in got
            got[key] = n
    for _, text in texts:
        t = text.split()
        for i, d in ((i, d) for i in range(len(t)) for d in range(1, 6) if i + d < len(t)):
            key = tuple(sorted((t[i], t[i + d])))
            want[key] = want.get(key, 0) + 6 - d
    assert got == want
    assert sum(len(zlib.compress(r["data"])) for r in counted) < 4 * len(got)


def test_rounds_do_not_grow_with_a_vocabulary_of_some_hundred_thousand_words():
    assert [wordblocks.block_count(n, 48, None) for n in (10, 5000, 78_778, 314_422, 901_737)] == [1, 2, 16, 16, 16]
    assert wordblocks.block_count(100, 48, 12) == 9
    assert -(-10**7 // wordblocks.block_count(10**7, 100, None)) * 800 <= wordblocks.BLOCK_BYTES


def test_a_large_vocabulary_is_not_trained_on_the_driver(spark, monkeypatch):
    monkeypatch.setattr(features, "DRIVER_VALUES", 12)
    monkeypatch.setattr("pyspark.ml.feature.Word2Vec", None)
    df = spark.createDataFrame([(i, "a b c d rare" if i == 0 else "a b c d") for i in range(6)], "id long, description string")
    got = features.train_word_vectors(df, vector_size=4, epochs=1).collect()
    assert sorted((r["word"], len(r["vec"])) for r in got) == [(w, 4) for w in "abcd"]


def test_word_vectors_of_a_large_vocabulary_leave_no_rounds(spark, monkeypatch):
    monkeypatch.setattr(features, "DRIVER_VALUES", 12)
    monkeypatch.setattr(wordblocks, "BLOCK_WORDS", 2)
    paths = []
    monkeypatch.setattr(wordblocks, "scratch_path", lambda *a, of=wordblocks.scratch_path: paths.append(of(*a)) or paths[-1])
    df = spark.createDataFrame([(i, "a b c d") for i in range(6)], "id long, description string")
    assert features.train_word_vectors(df, vector_size=4, epochs=3).count() == 4
    assert len(paths) == 2 + 1 + 3 * 2 and sum(os.path.exists(p.removeprefix("file://")) for p in paths) == 1


def test_both_binary_rules_share_one_model(spark, sf, monkeypatch):
    fits = []
    monkeypatch.setattr(models, "fit_multilabel", lambda *a, of=models.fit_multilabel, **k: fits.append(a[1]) or of(*a, **k))
    got = learning.run_binary(spark, sf)
    assert fits == [["en"]] and sorted(r["rule"] for r in got.collect()) == ["boosted", "plain"]
