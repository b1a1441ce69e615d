import random

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tagloom.operators import balance, explore, features, models, neighbours, similarity, split
from tagloom.functions import text as tx
from tagloom.plans import reports

TEXTS = ["apple banana apple", "banana cherry", "apple date", "", "cherry cherry date fig"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(
        [(i, t, ["x"] if i % 2 else ["x", "y"]) for i, t in enumerate(TEXTS)], "id long, description string, labels array<string>")


def test_tfidf_formula(docs):
    terms = sorted({w for t in TEXTS for w in t.split()})
    tf = np.array([[t.split().count(w) for w in terms] for t in TEXTS], dtype=float)
    idf = np.log((1 + len(TEXTS)) / (1 + (tf > 0).sum(0))) + 1
    for sub in (False, True):
        w = np.where(tf > 0, 1 + np.log(np.maximum(tf, 1)), 0) if sub else tf
        w = w * idf
        norm = np.sqrt((w ** 2).sum(1, keepdims=True))
        w = w / np.where(norm == 0, 1, norm)
        got = {(r["id"], r["term"]): r["weight"] for r in features.tfidf(docs, sublinear=sub).collect()}
        want = {(i, terms[j]): w[i, j] for i, j in zip(*np.nonzero(w))}
        assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)


def test_vocabulary_is_alphabetical(docs):
    v = features.vocabulary(features.count_vectorize(docs)).orderBy("index").collect()
    assert [(r["index"], r["term"]) for r in v] == list(enumerate(["apple", "banana", "cherry", "date", "fig"]))


def test_sparse_rows_keep_empty_texts(docs):
    tf = features.count_vectorize(docs).withColumn("weight", F.col("tf").cast("double"))
    index = features.vocabulary(tf)
    rows = {r["id"]: r["features"] for r in features.sparse_rows(tf, index, 5, docs.select("id")).collect()}
    assert rows[0].toArray().tolist() == [2, 1, 0, 0, 0] and rows[3].numNonzeros() == 0
    assert len(rows) == 5


def test_max_abs_scale_of_unseen_terms(spark):
    train = spark.createDataFrame([(1, "a", -4.0), (2, "a", 2.0), (1, "z", 0.0)], "id long, term string, weight double")
    test = spark.createDataFrame([(9, "a", 2.0), (9, "new", 3.0), (9, "z", 5.0)], "id long, term string, weight double")
    got = {r["term"]: r["weight"] for r in features.max_abs_apply(test, features.max_abs_fit(train)).collect()}
    assert got == {"a": 0.5, "new": 3.0, "z": 5.0}


def test_mean_embedding_ignores_unknown_words(spark):
    docs = spark.createDataFrame([(1, "a a b zzz"), (2, "zzz"), (3, "")], "id long, description string")
    vec = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 3.0])], "word string, vec array<float>")
    got = {r["id"]: r["embedding"] for r in features.mean_embedding(docs, vec, 2).collect()}
    assert got[1] == pytest.approx([2 / 3, 1.0]) and got[2] == [0.0, 0.0] and got[3] == [0.0, 0.0]


@pytest.mark.parametrize("kind", ["float", "double"])
def test_mean_embedding_of_a_large_table_shuffles_no_words(spark, monkeypatch, kind):
    texts = [(i, " ".join(random.Random(i).choices("abcdefghij", k=i % 7))) for i in range(40)] + [(98, None), (99, "zzz")]
    docs = spark.createDataFrame(texts, "id long, description string")
    vec = spark.createDataFrame([(w, [k + 0.1, 1.0 / (k + 1), -k * 1.7]) for k, w in enumerate("abcdefgh")], f"word string, vec array<{kind}>")
    want = {r["id"]: r["embedding"] for r in features.mean_embedding(docs, vec, 3).collect()}
    monkeypatch.setattr(features, "BROADCAST_VALUES", 6)
    monkeypatch.setattr(features, "SLICE_VALUES", 9)  # 3 words a slice
    found = features.mean_embedding(docs, vec, 3)
    got = {r["id"]: r["embedding"] for r in found.collect()}
    assert len(got) == 42 and all(got[i] == pytest.approx(want[i], abs=1e-12) for i in got) and got[99] == [0.0] * 3
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(word" not in plan and "hashpartitioning(id" in plan


def test_split_is_stratified_and_complete(spark, sf):
    from tagloom.catalog.tables import order_labels

    df = order_labels(spark, sf)
    s = split.stratified_split(df).select("id", "split", "dev", F.array_join("labels", "|").alias("g")).toPandas()
    assert len(s) == df.count() and s["id"].is_unique
    assert not (s["dev"] & (s["split"] == "test")).any()
    for _, g in s.groupby("g"):
        n = len(g)
        test = (g["split"] == "test").sum()
        assert abs(test - 0.1 * n) < 1
        assert abs(g["dev"].sum() - 0.1 * (n - test)) < 1
    parts = split.train_val_test(df).groupBy("split").count().toPandas().set_index("split")["count"]
    assert parts.sum() == len(s) and abs(parts["train"] / len(s) - 0.8) < 0.03
    folds = split.stratified_kfold(df, 5).groupBy(F.array_join("labels", "|").alias("g"), "fold").count().toPandas()
    for _, g in folds.groupby("g"):
        sizes = list(g["count"]) + [0] * (5 - len(g))
        assert max(sizes) - min(sizes) <= 1


@pytest.mark.parametrize("block_rows", [7, 2048])
def test_nearest_equals_brute_force(spark, block_rows):
    rng = np.random.default_rng(1)
    pts = np.concatenate([rng.normal(size=(120, 6)), np.zeros((60, 6)) + rng.normal(scale=1e-3, size=(60, 6))])
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(pts)], "id long, vector array<double>")
    got = neighbours.nearest(df, df, 4, exclude_self=True, block_rows=block_rows).collect()
    found = {}
    for r in sorted(got, key=lambda r: (r["id"], r["rank"])):
        found.setdefault(r["id"], []).append(r["neighbour_id"])
    d = np.sqrt(((pts[:, None] - pts[None]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    for i in range(len(pts)):
        assert found[i] == list(np.lexsort((np.arange(len(pts)), d[i]))[:4])


def test_nearest_sparse_equals_dense(spark):
    rng = np.random.default_rng(2)
    pts = rng.random((50, 30)) * (rng.random((50, 30)) < 0.2)
    dense = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(pts)], "id long, vector array<double>")
    sparse = spark.createDataFrame(
        [(i, (np.flatnonzero(p).tolist(), p[p != 0].tolist())) for i, p in enumerate(pts)],
        "id long, vector struct<indices:array<int>, values:array<double>>")
    a = {(r["id"], r["rank"]): r["distance"] for r in neighbours.nearest(dense, dense, 3, True).collect()}
    b = {(r["id"], r["rank"]): r["distance"] for r in neighbours.nearest(sparse, sparse, 3, True, block_rows=8).collect()}
    assert a.keys() == b.keys() and all(a[k] == pytest.approx(b[k], abs=1e-6) for k in a)


def test_fewer_points_than_k(spark):
    df = spark.createDataFrame([(i, [float(i)]) for i in range(3)], "id long, vector array<double>")
    assert neighbours.nearest(df, df, 10, exclude_self=True).count() == 6


def test_string_ids(spark):
    """The same neighbours, shares and synthetic rows, whether ids are strings or numbers past 2^62."""
    rng = np.random.default_rng(4)
    pts = rng.normal(size=(40, 4))
    pts[20:] = pts[:20]  # ties, decided by id
    def frame(name, kind):
        return spark.createDataFrame([(name(i), p.tolist(), ["x"] if i % 3 else []) for i, p in enumerate(pts)],
                                     f"id {kind}, vector array<double>, labels array<string>")
    text = frame(lambda i: f"tt{i:04d}", "string")
    big = frame(lambda i: 8 * 10**18 + i, "long")
    a = {(int(r["id"][2:]), r["rank"], int(r["neighbour_id"][2:])) for r in neighbours.nearest(text, text, 3, True).collect()}
    b = {(r["id"] - 8 * 10**18, r["rank"], r["neighbour_id"] - 8 * 10**18) for r in neighbours.nearest(big, big, 3, True).collect()}
    assert a == b and len(a) == 120
    assert all(0 < r["p"] <= 1 for r in neighbours.knn_proba(text, text, 3).collect())
    for df in (text, big):
        one = df.select("id", F.col("vector").alias("features"), F.size("labels").alias("y"))
        out = balance.smote(one, 30)
        assert out.schema["id"].dataType == df.schema["id"].dataType
        assert out.count() == 70 and out.select("id", "copy").distinct().count() == 70


def test_no_points(spark):
    df = spark.createDataFrame([("a", [1.0])], "id string, vector array<double>")
    assert neighbours.nearest(df, df.filter("false"), 2).count() == 0


def test_too_few_positives(spark):
    df = spark.createDataFrame([(i, [float(i)], int(i < 3)) for i in range(9)], "id long, features array<double>, y int")
    with pytest.raises(ValueError, match="3 positive"):
        balance.smote(df, 2)


def test_sparse_slices(spark, monkeypatch):
    """Columns cut into many slices give the same distances."""
    rng = np.random.default_rng(5)
    pts = rng.random((30, 40)) * (rng.random((30, 40)) < 0.3)
    cells = [[np.flatnonzero(p) for p in pts], [p[p != 0] for p in pts]]
    rows = neighbours.Rows(*cells, True)
    monkeypatch.setattr(neighbours, "SLICE_VALUES", 180)
    want = np.sqrt(((pts[:, None] - pts[None]) ** 2).sum(-1))
    assert np.allclose(neighbours.distances(rows, rows), want, atol=1e-6)
    i, j = np.nonzero(np.ones_like(want))
    assert np.allclose(neighbours.pair_distances(rows, rows, i, j), want[i, j], atol=1e-12)


def test_smote_counts_and_convexity(spark):
    rng = np.random.default_rng(3)
    pts = rng.normal(size=(60, 3))
    rows = [(i, p.tolist(), int(i < 12)) for i, p in enumerate(pts)]
    df = spark.createDataFrame(rows, "id long, features array<double>, y int")
    labels = df.select(F.when(F.col("y") == 1, F.array(F.lit("p"))).otherwise(F.array().cast("array<string>")).alias("labels"))
    plan = balance.smote_plan(labels, ["p"], 0.75).first()
    assert (plan["pos"], plan["neg"], plan["skip"], plan["synthesize"]) == (12, 48, False, 24)
    out = balance.smote(df, plan["synthesize"]).toPandas()
    assert (out["y"] == 1).sum() == 36 and not out.duplicated(["id", "copy"]).any()
    pos = pts[:12]
    assert (out["copy"] > 0).sum() == 24
    for v in out.loc[out["copy"] > 0, "features"]:
        # Each new point lies on the segment between two positives.
        v = np.array(v)
        gaps = [np.linalg.norm(v - a) + np.linalg.norm(v - b) - np.linalg.norm(a - b)
                for i, a in enumerate(pos) for b in pos[i + 1:]]
        assert min(gaps) < 1e-9
    again = balance.smote(df.repartition(3), plan["synthesize"]).toPandas()
    assert sorted(map(str, out["features"])) == sorted(map(str, again["features"]))
    assert balance.smote_plan(labels, ["p"], 0.2).first()["skip"]


def newton(x, y, w):
    """Exact minimum of |b|^2 / 2 + sum of w * logistic loss, intercept free."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    beta, ridge = np.zeros(x1.shape[1]), np.diag([1.0] * x.shape[1] + [0.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-x1 @ beta))
        g = x1.T @ (w * (p - y)) + ridge @ beta
        beta = beta - np.linalg.solve((x1 * (w * p * (1 - p))[:, None]).T @ x1 + ridge, g)
    return beta


@pytest.mark.parametrize("class_weight", [None, "balanced"])
def test_logistic_regression_is_the_regularised_optimum(spark, class_weight):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(200, 3))
    y = (x[:, 0] + rng.normal(size=200) > 0.8).astype(int)
    rows = spark.createDataFrame([(i, v.tolist(), ["p"] if t else []) for i, (v, t) in enumerate(zip(x, y))],
                                 "id long, v array<double>, labels array<string>")
    rows = rows.select("id", array_to_vector("v").alias("features"), "labels")
    model = models.fit_multilabel(rows, ["p"], "lreg", class_weight, tol=1e-10)
    w = np.ones(200) if class_weight is None else np.where(y == 1, 100 / y.sum(), 100 / (200 - y.sum()))
    got = model.models["p"][0]
    assert np.append(got.coefficients.toArray(), got.intercept) == pytest.approx(newton(x, y, w), abs=1e-4)
    index = spark.createDataFrame([(i, f"f{i}") for i in range(3)], "index int, term string")
    assert models.model_weights(model, index).count() == 3
    proba = model.predict_proba(rows).orderBy("id").first()["proba"]
    assert proba[0] == pytest.approx(1 / (1 + np.exp(-(np.append(x[0], 1) @ newton(x, y, w)))), abs=1e-4)


def test_unknown_names(spark, docs):
    with pytest.raises(ValueError):
        models.fit_multilabel(docs, ["x"], "nope")
    with pytest.raises(ValueError):
        tx.stop_list("klingon")


def test_naive_bayes(docs):
    counts = explore.words_by_combination(docs, tx.tokens(F.col("description")))
    got = {(r["label"], r["term"]): (r["log_pos"], r["log_neg"]) for r in
           models.bayes_weights(models.bayes_fit(counts, ["x", "y"]), ["x", "y"]).collect()}
    pos = " ".join(t for i, t in enumerate(TEXTS) if i % 2 == 0).split()
    neg = " ".join(t for i, t in enumerate(TEXTS) if i % 2 == 1).split()
    for term in ["apple", "banana", "cherry", "date", "fig"]:
        want = (np.log((pos.count(term) + 1) / (len(pos) + 5)), np.log((neg.count(term) + 1) / (len(neg) + 5)))
        assert got["y", term] == pytest.approx(want)
    tf = features.count_vectorize(docs)
    p = models.bayes_proba(tf, docs, models.bayes_fit(counts, ["y"]), models.bayes_priors(docs, ["y"]), ["y"])
    assert p.count() == 5


def test_class_weights(docs):
    w = balance.class_weights(docs, ["x", "y"]).collect()
    assert {r["label"]: (r["weight_pos"], r["weight_neg"]) for r in w} == {"x": (0.5, None), "y": (5 / 6, 5 / 4)}


def test_similarity_by_hand(spark):
    w = spark.createDataFrame([("r", "a", 1.0), ("r", "b", 0.0), ("s", "a", 3.0), ("s", "b", 4.0)],
                              "label string, term string, weight double")
    row = similarity.label_vector_similarity(w, "r").first()
    assert row["cosine"] == pytest.approx(0.6) and row["euclidean"] == pytest.approx(np.sqrt(20))
    assert similarity.shared_top_features(w, "r", 1).first()["share"] == 0.0


def test_explain_records(spark):
    scored = spark.createDataFrame([(1, "good bad none", ["l", "m"]), (2, "good", [])],
                                   "id long, description string, y_pred array<string>")
    w = spark.createDataFrame([("l", "good", 1.0), ("m", "good", 1.0), ("l", "bad", -1.0), ("l", "best", 4.0)],
                              "label string, term string, weight double")
    got = {(r["id"], r["word"]): r["score"] for r in similarity.explain_records(scored, w).collect()}
    assert got == {(1, "good"): 0.5, (1, "bad"): 0.0, (1, "none"): 0.0, (2, "good"): 0.0}


def test_bayes_model_equals_closed_form(spark, docs):
    rng = np.random.default_rng(5)
    x = rng.integers(0, 4, size=(40, 3)).astype(float)
    y = rng.random(40) < 0.3
    rows = spark.createDataFrame([(i, v.tolist(), ["p"] if t else []) for i, (v, t) in enumerate(zip(x, y))],
                                 "id long, v array<double>, labels array<string>")
    rows = rows.select("id", array_to_vector("v").alias("features"), "labels")
    model = models.fit_multilabel(rows, ["p"], "bayes")
    got = [r["proba"][0] for r in model.predict_proba(rows).orderBy("id").collect()]
    log = {c: np.log((x[y == c].sum(0) + 1) / (x[y == c].sum() + 3)) for c in (True, False)}
    score = x @ (log[True] - log[False]) + np.log(y.sum() / (~y).sum())
    assert got == pytest.approx(list(1 / (1 + np.exp(-score))))
    index = spark.createDataFrame([(i, f"f{i}") for i in range(3)], "index int, term string")
    w = [r["weight"] for r in models.model_weights(model, index).orderBy("term").collect()]
    assert w == pytest.approx(list(log[True]))


def test_runs_of_every_kind(spark, sf):
    from tagloom.catalog.learning import mark_docs
    from tagloom.plans.experiments import METRICS, Config, run_matrix

    d = mark_docs(spark, sf).select("id", "description", "labels", F.col("description").alias("lemmatized_description"))
    names = ["en", "quality", "toxic"]
    runs = [Config("w2v", vectorizer="word2vec", balancing_ratio=0.5), Config("knn", estimator="knn"),
            Config("nb", vectorizer="count", estimator="bayes", lemmatized=True)]
    out = run_matrix(d, names, runs, test=0.2, max_iter=5).collect()
    assert len(out) == len(runs) * len(METRICS)
    assert all(0 <= r["value"] <= 1 for r in out)


def test_out_of_fold_predicts_every_record_unseen(spark):
    df = spark.range(41).select("id", F.array(F.when(F.col("id") % 3 == 0, "a").otherwise("b")).alias("labels"))

    def fit_predict(train, test):
        known = [r["id"] for r in train.select("id").collect()]
        return test.select("id", F.lit(len(known)).alias("n"), F.col("id").isin(known).alias("seen"))

    got = split.out_of_fold(df, fit_predict, 4).collect()
    assert sorted(r["id"] for r in got) == list(range(41))
    assert not any(r["seen"] for r in got)
    sizes = {r["fold"]: r["n"] for r in got}
    assert len(sizes) == 4 and sum(41 - n for n in sizes.values()) == 41
    with pytest.raises(ValueError):
        split.out_of_fold(df, fit_predict, 1)


def test_out_of_fold_bayes_equals_a_model_per_fold(spark):
    rows = [(i, " ".join(["aa", "bb", "cc", "dd"][j % 4] for j in range(i, i + 1 + i % 5)) if i % 7 else None, ["x" if i % 3 else "y"]) for i in range(30)]
    df = spark.createDataFrame(rows, "id long, description string, labels array<string>")
    names, tf = ["x", "y"], features.count_vectorize(df)

    def fit_predict(train, test):
        model = models.bayes_fit(tf.join(train.select("id", "labels"), "id"), names)
        return models.bayes_proba(tf.join(test.select("id"), "id", "left_semi"), test, model, models.bayes_priors(train, names), names)

    want = {(r["id"], r["label"], r["fold"]): r["p"] for r in split.out_of_fold(df.select("id", "labels"), fit_predict, 3).collect()}
    got = {(r["id"], r["label"], r["fold"]): r["p"] for r in models.bayes_out_of_fold(df, names, 3).collect()}
    assert len(got) == 60 and got == pytest.approx(want)


def test_reports_hold_every_section(spark):
    rows = spark.createDataFrame([(1, ["a", "b"], ["a"], "one two"), (2, ["b"], ["b"], "three"), (3, [], ["a"], None)],
                                 "id long, y_true array<string>, y_pred array<string>, description string")
    told = reports.evaluation_report(rows, ["a", "b"]).collect()
    assert {r["section"] for r in told} == {"whole", "label", "predictions", "support", "average"}
    assert {r["name"]: r["value"] for r in told if r["section"] == "predictions"} == {"a": 2.0, "b": 1.0}
    seen = reports.exploration_report(rows.withColumnRenamed("y_true", "labels")).collect()
    assert {(r["name"], r["value"]) for r in seen if r["section"] == "words" and r["value"]} == {("0", 1.0), ("2", 1.0)}
    assert [r["value"] for r in seen if r["section"] == "combination"] == [1.0]
    nothing = reports.exploration_report(rows.where("false").withColumnRenamed("y_true", "labels")).where("value > 0").collect()
    assert nothing == []


def test_word_counts_of_shared_ids(spark):
    rows = [(1, "a b a"), (2, "b"), (1, "a c"), (None, "d"), (None, "d e"), (3, None), (4, "")]
    got = features.word_counts(spark.createDataFrame(rows, "id long, description string")).collect()
    assert {(r["id"], r["word"]): r["n"] for r in got} == {
        (1, "a"): 3, (1, "b"): 1, (1, "c"): 1, (2, "b"): 1, (None, "d"): 2, (None, "e"): 1} and len(got) == 6


def test_looked_up_words_are_not_shuffled(spark, sf):
    from tagloom.catalog import learning

    plan = learning.embed_lookup(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "HashAggregate" not in plan
