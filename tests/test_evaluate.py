"""Metrics against straightforward numpy formulas, with the edge rules."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagloom.functions.labels import decode_labels
from tagloom.operators import decide, evaluate

NAMES = ["a", "b", "c", "d"]
TRUE = [["a", "b"], [], ["a"], [], ["c"], ["a", "b", "c"], ["b"]]
PRED = [["a"], [], [], ["b"], ["c"], ["a", "b"], ["c"]]


def hot(sets):
    return np.array([[int(v in s) for v in NAMES] for s in sets])


@pytest.fixture(scope="module")
def scored(spark):
    rows = [(i, t, p, "w " * (i + 1)) for i, (t, p) in enumerate(zip(TRUE, PRED))]
    return spark.createDataFrame(rows, "id long, y_true array<string>, y_pred array<string>, description string")


def ratio(a, b):
    return a / b if b else 0.0


def test_summary(scored):
    t, p = hot(TRUE), hot(PRED)
    tp, nt, np_, nu = (t & p).sum(1), t.sum(1), p.sum(1), (t | p).sum(1)
    want = {
        "jaccard": np.mean([ratio(a, b) for a, b in zip(tp, nu)]), "hamming": (t != p).mean(),
        "accuracy": (t == p).all(1).mean(), "precision": np.mean([ratio(a, b) for a, b in zip(tp, np_)]),
        "recall": np.mean([ratio(a, b) for a, b in zip(tp, nt)]),
        "f1": np.mean([ratio(2 * a, b) for a, b in zip(tp, nt + np_)]),
        "at_least_one": (tp >= 1).mean(), "at_least_two": (tp >= 2).mean(),
        "signed_overlap": np.mean((tp - (nu - tp)) / (nu + 1e-9)),
    }
    got = evaluate.multilabel_metrics(scored, len(NAMES)).first().asDict()
    for k, v in want.items():
        assert got[k] == pytest.approx(v), k


def test_confusion_and_absent_class(scored):
    t, p = hot(TRUE), hot(PRED)
    rows = {r["label"]: r for r in evaluate.confusion_per_label(scored, NAMES).collect()}
    for i, v in enumerate(NAMES):
        assert [rows[v][c] for c in ("tn", "fp", "fn", "tp")] == [
            ((1 - t[:, i]) * (1 - p[:, i])).sum(), ((1 - t[:, i]) * p[:, i]).sum(),
            (t[:, i] * (1 - p[:, i])).sum(), (t[:, i] * p[:, i]).sum()]
    per = {r["label"]: r["balanced_accuracy"] for r in evaluate.metrics_per_label(scored, NAMES).collect()}
    assert per["d"] == 1.0  # no positives: only the other class counts


def test_report_averages(scored):
    rep = {r["name"]: r for r in evaluate.classification_report(scored, NAMES).collect()}
    t, p = hot(TRUE), hot(PRED)
    tp, fp, fn = (t * p).sum(0), ((1 - t) * p).sum(0), (t * (1 - p)).sum(0)
    prec = np.array([ratio(a, a + b) for a, b in zip(tp, fp)])
    assert rep["micro avg"]["recall"] == pytest.approx(tp.sum() / (tp + fn).sum())
    assert rep["macro avg"]["precision"] == pytest.approx(prec.mean())
    assert rep["weighted avg"]["precision"] == pytest.approx((prec * (tp + fn)).sum() / (tp + fn).sum())
    assert rep["samples avg"]["support"] == t.sum()


def test_unknown_names_raise(scored):
    with pytest.raises(ValueError):
        evaluate.score_per_record(scored, 4, "nope")
    with pytest.raises(ValueError):
        evaluate.compute_metrics(scored, NAMES, ["nope"])


def test_compute_metrics_long_form(scored):
    rows = evaluate.compute_metrics(scored, NAMES).collect()
    assert {r["metric"] for r in rows} >= {"jaccard", "confusion_matrix:tp", "classification_report:f1"}
    assert len(rows) == 9 + 4 * 4 + 4 * (4 + 4)


def test_length_bins_leave_out_the_longest(scored):
    rows = evaluate.metrics_by_length(scored, len(NAMES)).orderBy("bin").collect()
    assert len(rows) == 9 and sum(r["n"] for r in rows) == len(TRUE) - 1
    lengths = np.arange(1, len(TRUE) + 1)
    want = np.digitize(lengths, np.linspace(0, lengths.max(), 10)) - 1
    for b, r in enumerate(rows):
        assert r["n"] == (want == b).sum()
        assert (r["score"] is None) == (r["n"] == 0)


def test_samples_are_ordered_with_ties_by_id(scored):
    worst = [r["id"] for r in evaluate.worst_records(scored, 4, 3).collect()]
    best = [r["id"] for r in evaluate.best_records(scored, 4, 3).collect()]
    assert worst == [1, 2, 3] and best == [4, 5, 0]


def test_decision_rules(spark):
    probs = [[0.2, 0.4, 0.4, 0.1], [0.6, 0.5, 0.1, 0.0], [0.0, 0.0, 0.0, 0.0], [0.45, 0.43, 0.425, 0.1]]
    df = spark.createDataFrame(list(enumerate(probs)), "id long, proba array<double>")
    run = lambda d: [r["pred"] for r in d.orderBy("id").collect()]
    assert run(decide.predict_threshold(df)) == [[0] * 4, [1, 1, 0, 0], [0] * 4, [0] * 4]
    assert run(decide.predict_at_least_one(df)) == [[0, 1, 1, 0], [1, 1, 0, 0], [1] * 4, [1, 0, 0, 0]]
    assert run(decide.predict_threshold_argmax(df)) == [[0, 1, 0, 0], [1, 1, 0, 0], [1, 0, 0, 0], [1, 1, 0, 0]]
    assert run(decide.predict_excluding(df, NAMES, "a")) == [[0, 1, 1, 0], [1, 1, 0, 0], [0, 1, 1, 1], [0, 1, 0, 0]]


def test_dense_scores_keep_empty_records(spark):
    long = spark.createDataFrame([(1, "b", 0.5), (1, "a", 0.25)], "id long, label string, p double")
    ids = spark.createDataFrame([(1,), (2,)], "id long")
    got = {r["id"]: r["proba"] for r in decide.dense_scores(long, ["a", "b", "c"], ids).collect()}
    assert got == {1: [0.25, 0.5, 0.0], 2: [0.0, 0.0, 0.0]}


def test_keyword_rules(spark):
    df = spark.createDataFrame([(1, "The WAR", 0.3, [0.3, 0.9])], "id long, description string, proba double, v array<double>")
    assert decide.predict_binary_boosted(df, ["war", "zz"]).first()["p"] == 1
    assert decide.predict_binary_boosted(df.withColumn("proba", F.lit(0.0)), ["war", "zz"]).first()["p"] == 0
    boosted = decide.boost_proba(df.drop("proba").withColumnRenamed("v", "proba"), {"a": ["war", "zz"]}, ["a", "b"]).first()
    assert boosted["proba"] == [0.8, 0.9]


def test_extreme_samples(spark):
    df = spark.createDataFrame([(i, i / 10, i % 2) for i in range(10)], "id long, proba double, y int")
    bad = evaluate.binary_bad_samples(df, 4).collect()
    assert [r["id"] for r in bad if r["side"] == "high"] == [1, 3]
    assert [r["id"] for r in bad if r["side"] == "low"] == [8, 6]


def test_labels_over_equal_the_dense_rule(spark):
    long = spark.createDataFrame([(1, "b", 0.5), (1, "a", 0.5), (2, "c", 0.49), (3, "a", None), (3, "b", 0.9), (5, "c", float("nan"))], "id long, label string, p double")
    ids = spark.createDataFrame([(i,) for i in range(1, 6)], "id long")
    names = ["a", "b", "c"]
    dense = decide.predict_threshold(decide.dense_scores(long, names, ids)).select("id", decode_labels(F.col("pred"), names).alias("labels"))
    got = {r["id"]: r["labels"] for r in decide.labels_over(long, ids).collect()}
    assert got == {r["id"]: r["labels"] for r in dense.collect()} and got[1] == ["a", "b"] and got[4] == []
    with pytest.raises(ValueError):
        decide.labels_over(long, ids, 0.0)
