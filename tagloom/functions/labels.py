"""Label expressions: name arrays, multi-hot arrays, and overlaps of two label sets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def literal_names(names: list[str]) -> Column:
    return F.lit(list(names)) if names else F.array().cast("array<string>")


def encode_labels(labels: Column, vocabulary: list[str]) -> Column:
    """Name array -> 0/1 array over the sorted vocabulary."""
    return F.transform(
        literal_names(vocabulary), lambda v: F.array_contains(labels, v).cast("int")
    )


def decode_labels(hot: Column, vocabulary: list[str]) -> Column:
    """0/1 array -> names; the inverse of encode_labels."""
    return F.filter(literal_names(vocabulary), lambda v, i: F.get(hot, i) == 1)


def parse_label_list(text: Column) -> Column:
    """``"['A' 'B']"`` or ``"[0 1]"`` -> array of strings."""
    return F.split(F.regexp_replace(text, r"[\[\]']", ""), " ")


def parse_token_list(text: Column) -> Column:
    """``"['a', 'b']"`` -> ``"a b"``."""
    return F.array_join(F.split(F.regexp_replace(text, r"[\[\],']", ""), " "), " ")


def safe_ratio(a: Column, b: Column) -> Column:
    """a / b, and 0 where b is 0."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def jaccard(a: Column, b: Column) -> Column:
    return safe_ratio(F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b)))


def signed_overlap(tp: Column, truth: Column, pred: Column) -> Column:
    """(|TP| - |FN| - |FP|) / (|T or P| + 1e-9), from the three set sizes."""
    wrong = truth + pred - F.lit(2) * tp
    return (tp - wrong).cast("double") / (truth + pred - tp + F.lit(1e-9))


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def word_score(weight: Column, largest: Column) -> Column:
    """0 for a missing or negative weight, else the share of the largest weight."""
    return F.when(weight > 0, F.coalesce(F.try_divide(weight, largest), F.lit(0.0))).otherwise(0.0)


def shade(score: Column, floor: float = 0.1) -> Column:
    return F.greatest(score, F.lit(floor))


def keyword_fraction(text: Column, keywords: list[str]) -> Column:
    """Share of the keywords that occur as substrings of the lower-cased text."""
    if not keywords:
        return F.lit(0.0)
    # The lowered text is the one element of an array, so that it is made once and not once per keyword.
    hits = F.transform(F.array(F.lower(text)), lambda low: F.size(F.filter(literal_names(keywords), lambda k: F.contains(low, k))))
    return F.get(hits, 0).cast("double") / F.lit(float(len(keywords)))
