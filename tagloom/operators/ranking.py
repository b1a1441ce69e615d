"""Exact ranks, top-k and keep-first without putting one group into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.session import written


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the first by ``order``, then by the other columns.

    A struct minimum, so that each map task reduces its copies of a hot key before the shuffle.
    """
    rest = [c for c in order if c not in keys]
    rest += [c for c in df.columns if c not in keys and c not in rest]
    picked = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_first"))
    return picked.select(*keys, *[F.col("_first")[c].alias(c) for c in rest]).select(*df.columns)


def top_per_group(df: DataFrame, group: list[str], order: list[Column], k: int,
                  rank: str = "rank") -> DataFrame:
    """The k first rows of every group. Spark keeps only k rows per group in each map task
    before the shuffle (window group limit), so a hot group costs its final task little."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= k)


def exact_rank(df: DataFrame, group: list[str], levels: list[str], order: list[str],
               rank: str = "rank") -> DataFrame:
    """1-based rank of each row inside its group in the order (levels..., order...).

    The levels cut a group into many small ordered buckets. Bucket sizes give each bucket its
    starting rank; only the rows of one bucket are ever sorted together. All named columns must
    be non-null.
    """
    keys = [*group, *levels]
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))

    def before(table: DataFrame, upper: list[str], level: str, n: str) -> DataFrame:
        w = Window.partitionBy(*upper).orderBy(level).rowsBetween(Window.unboundedPreceding, -1)
        return table.withColumn("_o", F.coalesce(F.sum(n).over(w), F.lit(0)))

    if len(levels) == 1:
        starts = before(sizes, group, levels[0], "_n").select(*keys, F.col("_o").alias("_start"))
    else:
        # One sum per level: the rows before the bucket's outer level, plus those inside it.
        sizes = written(sizes, "sizes")
        starts = sizes.select(*keys, F.lit(0).cast("long").alias("_start"))
        for i, level in enumerate(levels):
            upper = [*group, *levels[:i]]
            part = sizes.groupBy(*upper, level).agg(F.sum("_n").alias("_s"))
            part = before(part, upper, level, "_s").select(*upper, level, "_o")
            starts = starts.join(part, [*upper, level]).withColumn("_start", F.col("_start") + F.col("_o")).drop("_o")
    w = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.join(starts, keys)
        .withColumn(rank, F.col("_start") + F.row_number().over(w))
        .drop("_start")
    )


def dense_position(df: DataFrame, order: list[str], position: str = "position") -> DataFrame:
    """0-based position of every row in the global order: range partitions are written down,
    counted, and each gets the number of rows before it. ``order`` must be unique."""
    parts = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
    )
    parts = written(parts, "position")
    sizes = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    w = Window.partitionBy("_part").orderBy(*order)
    return (
        parts.join(starts, "_part")
        .withColumn(position, F.col("_start") + F.row_number().over(w) - 1)
        .drop("_part", "_start")
    )


def head_n(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """The first n records in the given order (a distributed top-n, not a full sort)."""
    return df.orderBy(*order).limit(n)


def sample_every(df: DataFrame, step: int, order: list[str]) -> DataFrame:
    """Every step-th record in the given order, starting with the first; step 0 counts as 1."""
    step = max(int(step), 1)
    if step == 1:
        return df
    return dense_position(df, order, "_pos").filter(F.col("_pos") % step == 0).drop("_pos")


def equal_count_bins(df: DataFrame, value: str, identifier: str, bins: int = 20,
                     bin_col: str = "bin") -> DataFrame:
    """1-based bin of each row after sorting by ``value``: near-equal counts, the first
    (n mod bins) bins hold one row more. Equal values are ordered by md5 of the id. The rows are
    written first, since counting, ranking and the total all read them; pass narrow rows."""
    keyed = df.withColumn("_h", F.md5(F.col(identifier).cast("string")))
    keyed = written(keyed.withColumn("_hp", F.substring("_h", 1, 3)), "binned")
    ranked = exact_rank(keyed, [], [value, "_hp"], ["_h"], "_rank")
    total = keyed.agg(F.count(F.lit(1)).alias("n")).scalar()
    small = F.floor(total / bins)
    extra = F.pmod(total, F.lit(bins))
    at = F.col("_rank") - 1
    in_large = extra * (small + 1)
    bin_no = F.when(at < in_large, F.floor(at / (small + 1))).otherwise(
        extra + F.floor((at - in_large) / F.greatest(small, F.lit(1)))
    )
    return ranked.withColumn(bin_col, (bin_no + 1).cast("int")).drop("_h", "_hp", "_rank")
