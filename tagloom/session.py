"""Session helpers: a local session for tests, and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Upper bound for anything a query may pull to the driver or put in a literal.
MAX_DRIVER_ROWS = 1 << 20
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, **conf) -> SparkSession:
    """Session for tests and the local bench; on a cluster the caller brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tagloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared folder given by ``spark.checkpoint.dir``.

    Only a session with a local master may fall back to a machine-local folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="tagloom-")
    return f"{base.rstrip('/')}/tagloom/{name}-{uuid.uuid4().hex}"


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """The rows of a scan, dealt out by ``keys`` where it has fewer partitions than there are cores: one row group of a file is
    one task, however dear the rows are. A scan of many partitions is left as it is, so nothing is shuffled at scale. ``df``
    must be a scan with row-local steps only, as its partitions are counted."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *keys) if df.rdd.getNumPartitions() < cores else df


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what runs inside go when its job is done, not when the driver happens to collect its garbage."""
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(FREE_SHUFFLES, before) if before is not None else spark.conf.unset(FREE_SHUFFLES)


def written(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there, and every
    later reader sees the same rows even when executors are lost and tasks run again."""
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    with freed_shuffles(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, path: str) -> None:
    """Delete a folder of ``scratch_path`` that nothing reads any more."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def bounded_list(df: DataFrame, limit: int = MAX_DRIVER_ROWS) -> list:
    """First column of ``df`` as a sorted driver list, after checking that it is small."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} values: too many to keep on the driver")
    return sorted(r[0] for r in rows)


def names_table(spark: SparkSession, names: list[str], column: str = "label") -> DataFrame:
    """A driver list as a one-column table. Built from a literal, so that the optimizer knows
    how small it is and never broadcasts the other side instead."""
    values = F.lit(list(names)) if names else F.array().cast("array<string>")
    return spark.range(1).select(F.explode(values).alias(column))
