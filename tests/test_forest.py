import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tagloom.operators import forest, models, stages


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, x array<double>, labels array<string>").select("id", array_to_vector("x").alias("features"), "labels")


def made(spark, n=600, d=9, seed=1, names=("a", "b")):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    held = [[v for v, on in zip(names, (x[i, 0] * x[i, 1] > 0, x[i, 2] > 0.8)) if on] for i in range(n)]
    return frame(spark, [(i, x[i].tolist(), held[i]) for i in range(n)]), x, held


def test_first_split_is_the_best_of_all():
    rng = np.random.default_rng(3)
    bins, y, w = rng.integers(0, 6, (50, 4)).astype(np.uint8), rng.integers(0, 2, 50), rng.integers(1, 4, 50).astype(float)
    feature, cut, left, value, gains = forest.grow(bins, y, w, 1, 4, np.random.default_rng(0))

    def impurity(rows):
        t = w[rows].sum()
        return 2 * w[rows][y[rows] == 1].sum() * w[rows][y[rows] == 0].sum() / t if t else 0.0

    best = min((impurity(bins[:, j] <= c) + impurity(bins[:, j] > c), j, c) for j in range(4) for c in range(5))
    assert (feature[0], cut[0]) == best[1:] and gains[best[1]] == pytest.approx(impurity(np.ones(50, bool)) - best[0])
    went = bins[:, best[1]] <= best[2]
    assert left.tolist() == [1, -1, -1] and value[1] == pytest.approx(np.average(y[went], weights=w[went]))


def test_full_tree_gives_back_its_rows():
    rng = np.random.default_rng(4)
    bins, y = rng.integers(0, 32, (3000, 8)).astype(np.uint8), rng.integers(0, 2, 3000)
    feature, cut, left, value, _ = forest.grow(bins, y, np.ones(3000), 30, 3, np.random.default_rng(0))
    assert (value[forest.Nodes(feature, cut, left).descend(bins, 0)] == y).all()


@pytest.mark.parametrize("local_rows", [40, 1 << 14])
def test_forest_keeps_its_nodes_off_the_driver(spark, monkeypatch, local_rows):
    """The upper nodes are those of more rows than a task may hold; all others stay in a table, whatever their number."""
    monkeypatch.setattr(forest, "LOCAL_ROWS", local_rows)
    monkeypatch.setattr(forest, "SCORED_ROWS", 100)
    rows, x, held = made(spark)
    model = models.fit_multilabel(rows, ["a", "b"], "rf", n_features=9, n_estimators=12)
    top = model.models["a"][0]
    below = top.subtrees.collect()
    assert sum(len(r["left"]) for r in below) / 4 + len(top.value) > 12 * 60
    assert len(top.value) == 12 if local_rows > 600 else 12 < len(top.value) < 12 * 100
    assert len(below) == np.isnan(top.value[top.top.left < 0]).sum()
    got = {r["id"]: r["proba"] for r in model.predict_proba(rows).collect()}
    assert len(got) == 600
    for i, v in enumerate(("a", "b")):
        p, y = np.array([got[k][i] for k in range(600)]), np.array([v in h for h in held])
        assert ((p >= 0) & (p <= 1)).all() and ((p > 0.5) == y).mean() > 0.97
    # walked one tree at a time
    m, bins = model.models["a"][0], np.stack([np.searchsorted(c, x[:, j]) for j, c in enumerate(model.models["a"][0].cuts)], axis=1).astype(np.uint8)
    sub = {r["node"]: r for r in below}
    want = np.zeros(600)
    for t in range(12):
        for i, node in enumerate(m.top.descend(bins, t)):
            if np.isnan(m.value[node]):
                f, c, l = (np.frombuffer(sub[node][k], np.int32) for k in ("feature", "cut", "left"))
                want[i] += np.frombuffer(sub[node]["value"], float)[forest.Nodes(f, c, l).descend(bins[i : i + 1], 0)[0]] / 12
            else:
                want[i] += m.value[node] / 12
    assert [got[i][0] for i in range(600)] == pytest.approx(want.tolist())


def test_forest_like_mllib_on_new_rows(spark, monkeypatch):
    monkeypatch.setattr(forest, "LOCAL_ROWS", 100)
    train, _, _ = made(spark, 900)
    test, x, held = made(spark, 500, seed=2)
    ours = models.fit_multilabel(train, ["a", "b"], "rf", "balanced", 9, n_estimators=40)
    theirs = models.fit_multilabel(train, ["a", "b"], "rf", "balanced", 9, n_estimators=40, maxBins=32)
    assert isinstance(ours.models["a"][0], forest.Forest) and not isinstance(theirs.models["a"][0], forest.Forest)
    p, q = (np.array([r["proba"] for r in m.predict_proba(test).orderBy("id").collect()]) for m in (ours, theirs))
    y = np.array([[v in h for v in "ab"] for h in held])
    for i in range(2):
        assert abs(((p[:, i] > 0.5) == y[:, i]).mean() - ((q[:, i] > 0.5) == y[:, i]).mean()) < 0.06
        assert np.corrcoef(p[:, i], q[:, i])[0, 1] > 0.85
    index = spark.range(9).select(F.col("id").cast("int").alias("index"), F.col("id").cast("string").alias("term"))
    w = {(r["label"], r["term"]): r["weight"] for r in models.model_weights(ours, index).collect()}
    assert len(w) == 18 and w["b", "2"] > 0.4 and sum(v for k, v in w.items() if k[0] == "b") == pytest.approx(1)


def test_forest_of_one_class_and_equal_rows(spark, monkeypatch):
    """A hot group of equal vectors cannot be split and must not reach one task."""
    monkeypatch.setattr(forest, "LOCAL_ROWS", 20)
    rows = frame(spark, [(i, [1.0, 2.0], ["a"] if i % 4 else []) for i in range(200)])
    model = models.fit_multilabel(rows, ["a", "none"], "rf", n_features=2, n_estimators=20)
    assert model.models["a"][0].subtrees.count() == 0
    p = {tuple(r["proba"]) for r in model.predict_proba(rows).collect()}
    assert len(p) == 1 and abs(next(iter(p))[0] - 0.75) < 0.05 and next(iter(p))[1] == 0


def test_forest_is_saved(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(forest, "LOCAL_ROWS", 60)
    rows, _, _ = made(spark, 200)
    fitted = stages.PerLabelClassifier(vocabulary=["a", "b"], estimator="rf").fit(rows)
    fitted.save(str(tmp_path / "model"))
    back = stages.PerLabelModel.load(str(tmp_path / "model"))
    a, b = ([r["proba"] for r in m.transform(rows).orderBy("id").collect()] for m in (fitted, back))
    assert len(a) == 200 and np.array(a) == pytest.approx(np.array(b))
