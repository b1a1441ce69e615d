"""From probabilities to labels. ``proba`` is a dense array<double> in vocabulary order, one row
per record, so every rule is a row-local array expression."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.fixed import LOGIT_THRESHOLD, PROBABILITY_THRESHOLD
from tagloom.functions.labels import keyword_fraction, literal_names, sigmoid


def dense_scores(long: DataFrame, vocabulary: list[str], ids: DataFrame | None = None,
                 value: str = "p", name: str = "proba") -> DataFrame:
    """Long (id, label, value), unique by (id, label) -> (id, dense array); missing is 0. The
    state of a record is bounded by the vocabulary; ids without scores stay."""
    rows = long.select("id", "label", value)
    if ids is not None:
        empty = ids.select("id", F.lit(None).cast("string").alias("label"),
                           F.lit(None).cast("double").alias(value))
        rows = rows.unionByName(empty)
    cell = F.when(F.col("label").isNotNull(), F.struct("label", value))
    table = rows.groupBy("id").agg(F.map_from_entries(F.collect_list(cell)).alias("_m"))
    dense = F.transform(literal_names(vocabulary),
                        lambda v: F.coalesce(F.try_element_at("_m", v), F.lit(0.0)))
    return table.select("id", dense.alias(name))


def over(proba: Column, threshold: float, strict: bool) -> Column:
    hit = (lambda x: x > threshold) if strict else (lambda x: x >= threshold)
    return F.transform(proba, lambda x: hit(x).cast("int"))


def any_set(hot: Column) -> Column:
    return F.array_contains(hot, 1)


def predict_threshold(df: DataFrame, threshold: float = PROBABILITY_THRESHOLD,
                      proba: str = "proba", name: str = "pred") -> DataFrame:
    return df.withColumn(name, over(F.col(proba), threshold, strict=False))


def labels_over(long: DataFrame, ids: DataFrame, threshold: float = PROBABILITY_THRESHOLD, value: str = "p",
                name: str = "labels") -> DataFrame:
    """(id, sorted names) of every id: the decoded predict_threshold of the dense scores, straight from long (id, label, value).
    No array over the vocabulary is made, so the threshold must be positive, as absent scores are 0."""
    if threshold <= 0:
        raise ValueError("the threshold must be positive")
    hits = long.select("id", F.when(F.col(value) >= threshold, F.col("label")).alias("label"))
    every = hits.unionByName(ids.select("id", F.lit(None).cast("string").alias("label")))
    return every.groupBy("id").agg(F.array_sort(F.collect_set("label")).alias(name))


def predict_at_least_one(df: DataFrame, threshold: float = PROBABILITY_THRESHOLD,
                         proba: str = "proba", name: str = "pred") -> DataFrame:
    """Records without a hit get every label whose probability equals the row maximum."""
    p = F.col(proba)
    top = F.array_max(p)
    hot = over(p, threshold, strict=False)
    ties = F.transform(p, lambda x: (x >= top).cast("int"))
    return df.withColumn(name, F.when(any_set(hot), hot).otherwise(ties))


def predict_threshold_argmax(df: DataFrame, threshold: float = LOGIT_THRESHOLD, proba: str = "proba",
                             logits: bool = False, name: str = "pred") -> DataFrame:
    """Strictly over the threshold; records without a hit get the first maximum only."""
    p = F.transform(F.col(proba), sigmoid) if logits else F.col(proba)
    first = F.array_position(p, F.array_max(p))
    hot = over(p, threshold, strict=True)
    one = F.transform(p, lambda _, i: (i + 1 == first).cast("int"))
    return df.withColumn(name, F.when(any_set(hot), hot).otherwise(one))


def predict_excluding(df: DataFrame, vocabulary: list[str], label: str,
                      threshold: float = PROBABILITY_THRESHOLD, proba: str = "proba",
                      name: str = "pred") -> DataFrame:
    """At-least-one whose fallback never picks ``label`` (so a record whose best label it is
    gets the second best)."""
    p, at = F.col(proba), vocabulary.index(label)
    others = F.transform(p, lambda x, i: F.when(i != at, x))
    top = F.array_max(others)
    hot = over(p, threshold, strict=False)
    fallback = F.transform(others, lambda x: F.coalesce((x >= top).cast("int"), F.lit(0)))
    return df.withColumn(name, F.when(any_set(hot), hot).otherwise(fallback))


def boost_proba(df: DataFrame, keywords: dict[str, list[str]], vocabulary: list[str],
                text: str = "description", proba: str = "proba") -> DataFrame:
    """Add each label's keyword fraction to its probability (the sum may exceed 1)."""
    parts = [F.get(F.col(proba), i) + keyword_fraction(F.col(text), keywords.get(v, []))
             for i, v in enumerate(vocabulary)]
    return df.withColumn(proba, F.array(*parts))


def predict_binary_boosted(df: DataFrame, keywords: list[str], text: str = "description",
                           proba: str = "proba", threshold: float = PROBABILITY_THRESHOLD,
                           name: str = "p") -> DataFrame:
    """One label: probability + keyword fraction strictly over the threshold."""
    boosted = F.col(proba) + keyword_fraction(F.col(text), keywords)
    return df.withColumn(name, (boosted > threshold).cast("int"))


def argmax_label(df: DataFrame, vocabulary: list[str], proba: str = "proba",
                 name: str = "label") -> DataFrame:
    """Name of the first most probable label."""
    p = F.col(proba)
    return df.withColumn(
        name, F.element_at(literal_names(vocabulary), F.array_position(p, F.array_max(p)).cast("int"))
    )
