"""Word vectors as a table (word, vec); loading takes the place of training."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def save_vectors(vectors: DataFrame, path: str) -> None:
    vectors.select("word", "vec").write.parquet(path)


def load_vectors(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("word string, vec array<float>").parquet(path)
