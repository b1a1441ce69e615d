"""Shared by the operators of this package: tables, written intermediates, connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.session import written


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until it meets no column of ``df``."""
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return name


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows whose labels are never learned from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def components(links: DataFrame, name: str) -> DataFrame:
    """(id, root) for every id of ``links`` (u, v): root is the smallest id that links lead to.

    Alternating large-star and small-star steps. Each step is one grouping with a map-side minimum and one join, so a hub
    is never held as a list; each round is written, and the end is reached when a round changes no edge.
    """
    edges = written(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v").distinct(), name)
    state = None
    while True:
        count = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(count) == state:
            break
        state = tuple(count)
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v")
        edges = written(small.union(low.select("u", F.col("m").alias("v"))).distinct(), name)
    roots = edges.select(F.col("u").alias("id"), F.col("v").alias("root"))
    return roots.union(edges.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct())
