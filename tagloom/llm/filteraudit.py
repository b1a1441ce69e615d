"""Audit of the interaction of filters: what every order of application removes, and which removals are redundant.

Every filter is a failing-id relation: a stored table of the keys of the rows that fail it. Left-semi and left-anti joins with
these tables answer all questions about a prefix of filters: who survives it, whom the next filter removes, which of its
failures are gone already, which labelled rows are lost. Rows that stand in the same relations fare alike in every prefix. So
one semi and one anti join a filter first split the keys into failure classes (at most 2^filters), each counted by part and label, and
the prefixes of all orders are then joined, as relations of classes, with semi and anti joins again. Work on the rows grows
with the number of filters, not with that of their orders.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.session import written

BLANK = r"[\x20\x09-\x0D]+"
MAX_FILTERS = 6  # 720 orders
HOT_SHARE = 1000  # a text is frequent when more than one row in so many has it
KEY = ("doc_id", "digest")


def words(text: Column) -> Column:
    return F.filter(F.split(text, BLANK), lambda w: w != "")


# Failure conditions of the row-local filters, over the columns text and words; E needs the whole table.
ROW_FILTERS: dict[str, Callable[[], Column]] = {
    "A": lambda: F.size("words") < 50,
    "B": lambda: 100 * F.size(F.array_distinct("words")) < 65 * F.size("words"),
    "C": lambda: 100 * (F.length("text") - F.length(F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))) > 5 * F.length("text"),
    "D": lambda: F.col("text").rlike(r"[#$%&*|]"),
}
REPEATED = "E"


def facts(docs: DataFrame, id: str, text: str, part: str) -> DataFrame:
    """(doc_id, digest, part, copies, fails): one row per distinct (id, text, part); null texts and parts read as empty. One
    scan of the texts, of which only a digest stays."""
    rows = docs.select(F.col(id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
                       F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"))
    rows = rows.withColumn("words", words(F.col("text")))
    failed = F.concat(*[F.when(test(), name).otherwise("") for name, test in ROW_FILTERS.items()])
    return rows.select("doc_id", F.unhex(F.sha2("text", 256)).alias("digest"), "part", failed.alias("fails")) \
        .groupBy("doc_id", "digest", "part", "fails").agg(F.count(F.lit(1)).alias("copies"))


def repeated(rows: DataFrame) -> DataFrame:
    """Keys of the rows whose text also stands under a smaller id.

    The smallest id of a text is a minimum with a map-side part. Digests of frequent texts, at most ``HOT_SHARE``, are broadcast, so
    their rows are not shuffled; the others meet their minimum in a join on the digest. A null id is smaller and larger than none."""
    first = written(rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1"), "first-ids")
    least = rows.agg(F.count(F.lit(1)).alias("n")).first()["n"] / HOT_SHARE
    hot = F.broadcast(first.where(F.col("n") > least).select("digest", "first"))
    cold = first.where(F.col("n") <= least).select("digest", "first")
    later = F.col("doc_id") > F.col("first")
    keys = rows.select(*KEY)
    return keys.join(hot, "digest").where(later).select(*KEY) \
        .union(keys.join(hot, "digest", "left_anti").join(cold, "digest").where(later).select(*KEY)).distinct()


def failing(rows: DataFrame) -> dict[str, DataFrame]:
    """The stored failing-id relations."""
    tables = {name: rows.where(F.contains("fails", F.lit(name))).select(*KEY).distinct() for name in ROW_FILTERS}
    tables[REPEATED] = repeated(rows)
    return {name: written(t, f"failing-{name}") for name, t in tables.items()}


def same_key(left: DataFrame, right: DataFrame) -> Column:
    return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["digest"] == right["digest"])


def classes(rows: DataFrame, relations: dict[str, DataFrame], labels: DataFrame | None, id: str = "doc_id") -> DataFrame:
    """(part, class, n, good, toxic): class names the filters that its rows fail. Semi and anti joins with each relation in turn."""
    split = rows.select(*KEY, "part", "copies", F.lit("").alias("class"))
    for name, table in relations.items():
        on = same_key(split, table)
        split = split.join(table, on, "left_semi").withColumn("class", F.concat("class", F.lit(name))) \
            .union(split.join(table, on, "left_anti"))
        split = written(split, f"split-{name}")
    for mark in ("quality", "toxic"):
        split = split.withColumn(mark, F.lit(0))
    if labels is not None:
        ids = labels.select(F.col(id).alias("doc_id"), "quality", "toxic").where("doc_id is not null").groupBy("doc_id") \
            .agg(F.max((F.col("quality") == 1).cast("int")).alias("quality"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
        split = split.drop("quality", "toxic").join(ids, "doc_id", "left")
    return split.groupBy("part", "class").agg(
        F.sum("copies").alias("n"), *[F.sum(F.when(F.col(c) == 1, F.col("copies")).otherwise(0)).alias(c) for c in ("quality", "toxic")])


def audit(docs: DataFrame, labels: DataFrame | None = None, id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) for every part, every order of
    the filters and every step of it.

    Null texts read as empty, null parts as the empty string. Repeated rows all count. A text stands "under a smaller id" by its ids
    alone; a null id is compared with none. A label of an id counts for all its rows, and holds if any of its label rows says so.
    Other columns are ignored. An empty table gives no rows. Parts are rows of the result, so they may be many.
    """
    rows = written(facts(docs, id, text, part), "facts")
    relations = failing(rows)
    names = sorted(relations)
    if len(names) > MAX_FILTERS:
        raise ValueError(f"more than {MAX_FILTERS} filters")
    kinds = written(classes(rows, relations, labels, id), "classes")

    # Relations over classes: who fails a filter, and which filters come before a step.
    orders = F.lit(["".join(p) for p in permutations(names)])
    fails = kinds.select(F.explode(F.filter(F.split("class", ""), lambda x: x != "")).alias("filter"), "class").distinct()
    steps = kinds.select("class").distinct().select("class", F.explode(orders).alias("filter_order")) \
        .select("*", F.explode(F.sequence(F.lit(1), F.lit(len(names)))).alias("step")) \
        .withColumn("filter", F.substr("filter_order", F.col("step"), F.lit(1)))
    earlier = steps.join(fails, ["class", "filter"], "left_semi") \
        .select(F.col("class").alias("of"), F.col("filter_order").alias("within"), F.col("step").alias("at"))
    prefix = F.expr("class = of and filter_order = within and at < step")
    state = steps.join(earlier, prefix, "left_anti").withColumn("gone", F.lit(0)) \
        .union(steps.join(earlier, prefix, "left_semi").withColumn("gone", F.lit(1)))
    state = state.join(fails, ["class", "filter"], "left_semi").withColumn("hit", F.lit(1)) \
        .union(state.join(fails, ["class", "filter"], "left_anti").select("class", "filter", "filter_order", "step", "gone").withColumn("hit", F.lit(0)))
    state = written(state, "prefixes")

    def total(column: str, condition: str) -> Column:
        return F.sum(F.when(F.expr(condition), F.col(column)).otherwise(0)).cast("long")

    counted = kinds.join(state, "class").groupBy("part", "filter_order", "step", "filter").agg(
        total("n", "gone = 0 and hit = 0").alias("kept"), total("n", "gone = 0 and hit = 1").alias("removed"),
        total("n", "gone = 1 and hit = 1").alias("redundant"), total("n", "hit = 1 and class = filter").alias("unique_fails"),
        total("quality", "gone = 0 and hit = 1").alias("good_lost"), total("toxic", "gone = 0 and hit = 1").alias("toxic_lost"))
    counted = written(counted, "audit")
    shares = counted.groupBy("part", "filter").agg(F.sum("removed").alias("shapley"))
    return counted.join(shares, ["part", "filter"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
