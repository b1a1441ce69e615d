"""Whole reports in long form, (section, name, metric, value), each from one written table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.operators import evaluate, explore
from tagloom.session import written


def section(title: str, df: DataFrame, name: Column | None, metrics: list[str]) -> DataFrame:
    """Each of ``metrics`` as a row; the whole set has the name null."""
    name = F.lit(None) if name is None else name
    cells = [F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics]
    return df.select(F.lit(title).alias("section"), name.cast("string").alias("name"), F.inline(F.array(*cells)))


def evaluation_report(scored: DataFrame, vocabulary: list[str], metric: str = "jaccard") -> DataFrame:
    """Sections of (id, y_true, y_pred) records: whole (all summary metrics), label (scores and share),
    predictions (their number by label), support (records and mean score by label) and average (the
    classification report)."""
    rows = written(scored.select("id", "y_true", "y_pred"), "report-scored")
    n = len(vocabulary)
    label = F.col("label")
    return reduce(DataFrame.unionByName, [
        section("whole", evaluate.multilabel_metrics(rows, n), None, list(evaluate.SUMMARY)),
        section("label", evaluate.metrics_per_label(rows, vocabulary), label, ["balanced_accuracy", "precision", "recall", "share"]),
        section("predictions", evaluate.prediction_histogram(rows, vocabulary), label, ["n"]),
        section("support", evaluate.score_by_label_support(rows, n, metric), label, ["support", "score"]),
        section("average", evaluate.classification_report(rows, vocabulary), F.col("name"), ["precision", "recall", "f1", "support"]),
    ])


def exploration_report(df: DataFrame, text: str = "description", labels: str = "labels", k: int = 20) -> DataFrame:
    """Sections of labelled texts: label (n, share), combination (the ``k`` most frequent), words and chars
    (histograms, named by the lower end of a bin) and length (summary of the characters). Texts are read once."""
    t = F.col(text)
    rows = written(df.select(F.col(labels).alias("labels"), explore.text_length(t, "word").alias("word"),
                             explore.text_length(t, "char").alias("char")), "report-lengths")
    by_unit = {u: explore.histogram(rows.select(F.col(u).alias("len")), u) for u in ("word", "char")}
    return reduce(DataFrame.unionByName, [
        section("label", explore.label_share(rows), F.col("label"), ["n", "share"]),
        section("combination", explore.label_combinations(rows, k), F.col("combination"), ["n"]),
        section("words", by_unit["word"], F.col("low"), ["n"]),
        section("chars", by_unit["char"], F.col("low"), ["n"]),
        section("length", explore.summary(rows.select(F.col("char").alias("len"))), None, ["mean", "q1", "median", "q3", "longest"]),
    ])
