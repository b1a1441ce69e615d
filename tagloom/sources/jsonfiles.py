"""JSON outputs: one JSON value per line, written in parallel."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.fixed import DEFAULT_LABELS
from tagloom.session import bounded_list


def write_json(df: DataFrame, path: str) -> None:
    df.write.json(path)


def write_vocabulary(labels: DataFrame, path: str) -> None:
    """(label) rows; a vocabulary is small by definition and is checked on reading."""
    labels.select("label").write.json(path)


def read_vocabulary(spark: SparkSession, path: str | None = None, limit: int = 10_000) -> list[str]:
    """The label names in a written vocabulary; without a path the default names."""
    if path is None:
        return list(DEFAULT_LABELS)
    return bounded_list(spark.read.schema("label string").json(path), limit)


def write_top_words(top: DataFrame, path: str) -> None:
    """(label, rank, word) -> one object per label with its words in rank order; k words each."""
    lists = top.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("rank", "word"))).alias("w"))
    lists.select("label", F.col("w")["word"].alias("words")).write.json(path)
