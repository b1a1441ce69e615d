"""Comparing labels by their term weights ``(label, term, weight)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.functions.labels import safe_ratio
from tagloom.operators.features import idf, label_tfidf_sums
from tagloom.operators.ranking import top_per_group
from tagloom.session import written


def label_superdoc_tfidf(counts: DataFrame, sublinear: bool = True) -> DataFrame:
    """(label, term, weight): TF-IDF where all texts of a label form one document. ``counts`` is
    explore.words_by_combination; counts are added up, the long text is never built. The sums
    are written: label count, term frequencies, weights and norms all read them."""
    sums = written(counts.select(F.explode("labels").alias("label"), "term", "tf")
                   .groupBy("label", "term").agg(F.sum("tf").alias("tf")), "superdoc")
    n = sums.agg(F.count_distinct("label").cast("double").alias("n")).scalar()
    df = sums.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    raw = (F.lit(1.0) + F.log(F.col("tf"))) if sublinear else F.col("tf").cast("double")
    w = sums.join(df, "term").select("label", "term", (raw * idf(F.col("df"), n)).alias("w"))
    # Unit length per label: a label may own a third of all rows, so the norm is an
    # aggregation joined back, not a window over the label.
    norm = w.groupBy("label").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("_norm"))
    return w.join(norm, "label").select("label", "term", (F.col("w") / F.col("_norm")).alias("weight"))


def label_avg_tfidf(records: DataFrame, sublinear: bool = True) -> DataFrame:
    """(label, term, weight): mean of the TF-IDF vectors of the records (description, labels) of each label. The counts of a
    text carry its labels, so they are never joined with the records."""
    sums, labels = label_tfidf_sums(records, sublinear), records.select("labels")
    n = labels.groupBy("labels").agg(F.count(F.lit(1)).alias("n")) \
        .select(F.explode("labels").alias("label"), "n").groupBy("label").agg(F.sum("n").alias("n"))
    return sums.join(n, "label").select("label", "term", (F.col("w") / F.col("n")).alias("weight"))


def top_features(weights: DataFrame, k: int = 10) -> DataFrame:
    """(label, rank, term, weight): the k largest weights of each label, ties by term."""
    return top_per_group(weights, ["label"], [F.desc("weight"), F.asc("term")], k)


def feature_ranking(weights: DataFrame, k: int = 10) -> DataFrame:
    """top_features plus the largest weight over all labels."""
    top = weights.agg(F.max("weight").alias("m")).scalar()
    return top_features(weights, k).withColumn("global_max", top)


def shared_top_features(weights: DataFrame, reference: str, k: int = 500) -> DataFrame:
    """(label, share): part of the k top terms that the reference label's top k also holds."""
    top = top_features(weights, k).select("label", "term")
    ours = top.filter(F.col("label") == reference).select("term", F.lit(1).alias("_in"))
    return (
        top.filter(F.col("label") != reference).join(ours, "term", "left")
        .groupBy("label").agg((F.count("_in") / F.lit(float(k))).alias("share"))
    )


def against(weights: DataFrame, reference: str) -> DataFrame:
    """(label, term, weight, ref): weights beside the reference label's weight of the term."""
    ref = weights.filter(F.col("label") == reference).select("term", F.col("weight").alias("ref"))
    return weights.filter(F.col("label") != reference).join(ref, "term", "left").fillna(0.0, ["ref"])


def cosine(a: str, b: str) -> Column:
    dot = F.sum(F.col(a) * F.col(b))
    return safe_ratio(dot, F.sqrt(F.sum(F.col(a) * F.col(a))) * F.sqrt(F.sum(F.col(b) * F.col(b))))


def euclidean(a: str, b: str) -> Column:
    d = F.col(a) - F.col(b)
    return F.sqrt(F.sum(d * d))


def label_vector_similarity(weights: DataFrame, reference: str) -> DataFrame:
    """(label, cosine, euclidean) between full weight vectors; every label must hold every term
    (model coefficients do)."""
    return against(weights, reference).groupBy("label").agg(
        cosine("weight", "ref").alias("cosine"), euclidean("weight", "ref").alias("euclidean")
    )


def scaled_by_sign(weights: DataFrame) -> DataFrame:
    """Positive weights of a label scaled to [0, 1], negative ones to [-1, 0], each by their
    own minimum and maximum."""
    pos, neg = F.col("weight") > 0, F.col("weight") < 0
    ends = weights.groupBy("label").agg(
        F.min(F.when(pos, F.col("weight"))).alias("_pmin"), F.max(F.when(pos, F.col("weight"))).alias("_pmax"),
        F.min(F.when(neg, F.col("weight"))).alias("_nmin"), F.max(F.when(neg, F.col("weight"))).alias("_nmax"),
    )
    w = F.col("weight")
    up = safe_ratio(w - F.col("_pmin"), F.col("_pmax") - F.col("_pmin"))
    down = -safe_ratio(w - F.col("_nmax"), F.col("_nmin") - F.col("_nmax"))
    return weights.join(ends, "label").select(
        "label", "term", F.when(pos, up).when(neg, down).otherwise(0.0).alias("weight")
    )


def extreme_feature_similarity(weights: DataFrame, reference: str, k: int = 100) -> DataFrame:
    """(label, cosine, euclidean) on each label's k largest and k smallest weights, compared
    with the reference label's values of the same terms, both scaled by sign."""
    best = top_per_group(weights, ["label"], [F.desc("weight"), F.asc("term")], k)
    worst = top_per_group(weights, ["label"], [F.asc("weight"), F.asc("term")], k)
    chosen = best.select("label", "term").unionByName(worst.select("label", "term")).distinct()
    pairs = against(scaled_by_sign(weights), reference).join(chosen, ["label", "term"], "left_semi")
    return pairs.groupBy("label").agg(
        cosine("weight", "ref").alias("cosine"), euclidean("weight", "ref").alias("euclidean")
    )


def tfidf_topk_similarity(weights: DataFrame, reference: str, k: int = 100) -> DataFrame:
    """(label, cosine) of each label's k top terms and the reference's values of them. Reads the
    weights three times: pass a written table if they are costly."""
    chosen = top_features(weights, k).select("label", "term")
    pairs = against(weights, reference).join(chosen, ["label", "term"], "left_semi")
    return pairs.groupBy("label").agg(cosine("weight", "ref").alias("cosine"))


def explain_records(scored: DataFrame, weights: DataFrame, text: str = "description",
                    pred: str = "y_pred") -> DataFrame:
    """(id, position, word, score): each word of a text scored by the summed weights of the
    record's predicted labels, relative to the largest such sum.

    Weight sums are built once per distinct label combination, not per record, and divided by
    their largest there; words without a positive sum score 0, so one join over the words is all.
    """
    from tagloom.functions import text as tx
    from tagloom.functions.labels import word_score

    combos = scored.select(F.col(pred).alias("_combo")).filter(F.size("_combo") > 0).distinct()
    sums = (
        combos.select("_combo", F.explode("_combo").alias("label")).join(weights, "label")
        .groupBy("_combo", F.col("term").alias("word")).agg(F.sum("weight").alias("_w"))
    )
    sums = written(sums, "sums")
    largest = sums.groupBy("_combo").agg(F.max("_w").alias("_max"))
    shares = sums.filter(F.col("_w") > 0).join(largest, "_combo").select(
        "_combo", "word", word_score(F.col("_w"), F.col("_max")).alias("score"))
    words = scored.select("id", F.col(pred).alias("_combo"),
                          F.posexplode(tx.words(F.col(text))).alias("position", "word"))
    return (
        words.join(shares, ["_combo", "word"], "left")
        .select("id", "position", "word", F.coalesce("score", F.lit(0.0)).alias("score"))
    )
