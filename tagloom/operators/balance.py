"""Class weights and synthetic minority records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.fixed import SMOTE_SEED
from tagloom.operators.hashed import nearest_hashed
from tagloom.operators.neighbours import is_sparse, nearest
from tagloom.operators.ranking import exact_rank
from tagloom.session import names_table


SEARCHES = {"exact": nearest, "hashed": nearest_hashed}


def positives(df: DataFrame, vocabulary: list[str], labels: str = "labels") -> DataFrame:
    """(label, pos, neg, n) for the whole vocabulary, from counts of distinct label sets."""
    combos = df.groupBy(labels).agg(F.count(F.lit(1)).alias("c"))
    found = combos.select(F.explode(labels).alias("label"), "c").groupBy("label").agg(F.sum("c").alias("pos"))
    n = combos.agg(F.sum("c").alias("n")).scalar()
    names = names_table(df.sparkSession, vocabulary)
    return names.join(found, "label", "left").fillna(0, ["pos"]).withColumn("n", n) \
        .select("label", "pos", (F.col("n") - F.col("pos")).alias("neg"), "n")


def class_weights(df: DataFrame, vocabulary: list[str], labels: str = "labels") -> DataFrame:
    """(label, weight_pos, weight_neg): n / (2 x class size); null for an empty class."""
    n = F.col("n").cast("double")
    return positives(df, vocabulary, labels).select(
        "label", F.try_divide(n, 2.0 * F.col("pos")).alias("weight_pos"),
        F.try_divide(n, 2.0 * F.col("neg")).alias("weight_neg"),
    )


def log_class_weights(df: DataFrame, vocabulary: list[str], labels: str = "labels") -> DataFrame:
    """(label, weight): ln(n / (count + 1)), divided by the mean over labels."""
    raw = positives(df, vocabulary, labels).select(
        "label", F.log(F.col("n") / (F.col("pos") + 1.0)).alias("w")
    )
    mean = raw.agg(F.avg("w").alias("m")).scalar()
    return raw.select("label", (F.col("w") / mean).alias("weight"))


def smote_plan(df: DataFrame, vocabulary: list[str], ratio: float, labels: str = "labels") -> DataFrame:
    """(label, pos, neg, skip, synthesize): how many positives to add so that
    positives = floor(ratio x negatives); labels already above the share are skipped."""
    share = F.lit(ratio / (1.0 + ratio))
    skip = F.col("pos") > share * F.col("n")
    wanted = F.floor(F.lit(float(ratio)) * F.col("neg")) - F.col("pos")
    return positives(df, vocabulary, labels).select(
        "label", "pos", "neg", skip.alias("skip"),
        F.when(skip, 0).otherwise(F.greatest(wanted, F.lit(0))).cast("long").alias("synthesize"),
    )


def unit(*parts: Column) -> Column:
    """Repeatable number in [0, 1) from a hash of the parts."""
    h = F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def between(a: Column, b: Column, u: Column, sparse: bool) -> Column:
    """a + u (b - a) for dense arrays, or for sparse structs over the union of their indices."""
    if not sparse:
        return F.zip_with(a, b, lambda x, y: x + u * (y - x))
    as_map = lambda v: F.map_from_arrays(v["indices"], v["values"])
    zero = F.lit(0.0)
    mixed = F.map_zip_with(as_map(a), as_map(b), lambda _, x, y: F.coalesce(x, zero)
                           + u * (F.coalesce(y, zero) - F.coalesce(x, zero)))
    cells = F.array_sort(F.map_entries(mixed))
    return F.struct(cells["key"].alias("indices"), cells["value"].alias("values"))


def positive_neighbours(df: DataFrame, k: int = 5, target: str = "y", vector: str = "features", search: str = "exact") -> DataFrame:
    """(id, rank, neighbour_id): the k nearest positives of every positive. They do not depend on how many records are made of them."""
    pos = df.filter(F.col(target) == 1).select("id", F.col(vector).alias("vector"))
    return SEARCHES[search](pos, pos, k, exclude_self=True).select("id", "rank", "neighbour_id")


def smote(df: DataFrame, synthesize: int, k: int = 5, seed: int = SMOTE_SEED,
          target: str = "y", vector: str = "features", search: str = "exact", near: DataFrame | None = None) -> DataFrame:
    """(id, copy, vector, y): the records with copy 0, and ``synthesize`` positives x + u (nn - x),
    nn one of the k nearest positives of x, under the id of x with copy 1, 2, ... Every positive
    gives floor or ceil of the equal share, in md5 order; neighbour and u come from a hash of
    (id, copy, seed), so the result is repeatable. Ids may be of any type.

    ``synthesize`` is one line of smote_plan. At least k + 1 positives are needed. ``search`` "hashed" takes the
    neighbours from hash tables (near ones instead of the nearest), for many positives. ``near`` are the neighbours of the same
    positives, if they are known: ``positive_neighbours``.
    """
    if search not in SEARCHES:
        raise ValueError(f"unknown search {search!r}; known: {', '.join(SEARCHES)}")
    kept = df.select("id", F.lit(0).cast("long").alias("copy"), vector, F.col(target).cast("int").alias(target))
    if synthesize <= 0:
        return kept
    pos = df.filter(F.col(target) == 1).select("id", F.col(vector).alias("vector"))
    n = pos.count()
    if n <= k:
        raise ValueError(f"{n} positive records, but {k} neighbours of each are asked for")
    each, extra = divmod(synthesize, n)
    near = positive_neighbours(df, k, target, vector, search) if near is None else near

    copies, sources = F.lit(each).cast("long"), pos
    if extra:
        # One more copy for the `extra` first positives in hash order.
        order = pos.select("id", F.md5(F.concat_ws("|", F.col("id").cast("string"), F.lit(str(seed)))).alias("_h"))
        order = exact_rank(order.withColumn("_b", F.substring("_h", 1, 3)), [], ["_b"], ["_h", "id"], "_r")
        sources = pos.join(order.select("id", "_r"), "id")
        copies = copies + (F.col("_r") <= extra).cast("long")
    drawn = (
        sources.withColumn("_copies", copies).filter(F.col("_copies") > 0)
        .select("id", "vector", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))).alias("copy"))
        .withColumn("rank", (F.floor(unit(F.col("id"), F.col("copy"), F.lit(f"n{seed}")) * k) + 1).cast("int"))
        .withColumn("u", unit(F.col("id"), F.col("copy"), F.lit(f"u{seed}")))
    )
    other = pos.select(F.col("id").alias("neighbour_id"), F.col("vector").alias("other"))
    made = drawn.join(near, ["id", "rank"]).join(other, "neighbour_id")
    mixed = between(F.col("vector"), F.col("other"), F.col("u"), is_sparse(df, vector))
    return kept.unionByName(made.select("id", "copy", mixed.alias(vector), F.lit(1).alias(target)))
