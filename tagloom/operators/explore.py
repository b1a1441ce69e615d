"""Profiles of labels and texts. Records carry ``labels array<string>``.

Label reports first count distinct label combinations (a partial aggregation that shrinks any
hot label inside the map tasks) and only then unfold the combinations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.functions import text as tx
from tagloom.operators.ranking import top_per_group
from tagloom.session import names_table


def combinations(df: DataFrame, labels: str = "labels") -> DataFrame:
    return df.groupBy(labels).agg(F.count(F.lit(1)).alias("n"))


def label_distribution(df: DataFrame, labels: str = "labels") -> DataFrame:
    counts = combinations(df, labels).select(F.explode(labels).alias("label"), "n")
    return counts.groupBy("label").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "label")


def label_share(df: DataFrame, labels: str = "labels") -> DataFrame:
    """Each label's share of all label occurrences."""
    counts = label_distribution(df, labels)
    total = counts.agg(F.sum("n").alias("t")).scalar()
    return counts.withColumn("share", F.col("n") / total)


def label_combinations(df: DataFrame, k: int = 20, labels: str = "labels") -> DataFrame:
    """The k most frequent combinations of two or more labels; ties by name."""
    many = df.filter(F.size(labels) > 1)
    named = combinations(many, labels).select(F.array_join(labels, ", ").alias("combination"), "n")
    return named.orderBy(F.desc("n"), "combination").limit(k)


def pair_counts(df: DataFrame, labels: str = "labels") -> DataFrame:
    """(label_a, label_b, n) for ordered pairs of different labels that occur together.
    Pairs are unfolded once per distinct combination, not once per record."""
    first = combinations(df, labels).select(labels, "n", F.explode(labels).alias("label_a"))
    pairs = first.select("label_a", "n", F.explode(labels).alias("label_b"))
    return (
        pairs.filter(F.col("label_a") != F.col("label_b"))
        .groupBy("label_a", "label_b")
        .agg(F.sum("n").alias("n"))
    )


def cooccurrence(df: DataFrame, vocabulary: list[str], labels: str = "labels") -> DataFrame:
    """The full label x label matrix in long form, zeros and zero diagonal included."""
    spark = df.sparkSession
    # The first axis is dealt out before the second unfolds, or one task would make all cells.
    cells = names_table(spark, vocabulary, "label_a").repartition("label_a").select(
        "label_a", F.explode(F.lit(list(vocabulary))).alias("label_b")
    )
    found = pair_counts(df, labels)
    return cells.join(found, ["label_a", "label_b"], "left").fillna(0, ["n"])


def cooccurrence_normalized(df: DataFrame, vocabulary: list[str], labels: str = "labels") -> DataFrame:
    """Each column of the matrix divided by the total of its label."""
    total = label_distribution(df, labels).select(F.col("label").alias("label_b"), F.col("n").alias("_t"))
    matrix = cooccurrence(df, vocabulary, labels).join(total, "label_b", "left")
    share = F.coalesce(F.try_divide(F.col("n"), F.col("_t")), F.lit(0.0))
    return matrix.select("label_a", "label_b", share.alias("share"))


def conflicting_duplicates(df: DataFrame, key: str, target: str) -> DataFrame:
    """Keys whose target takes other than one distinct value: a row per (key, value) with its
    count and the key's number of distinct values. Null is a value; null keys are dropped.

    Long form on purpose: a list of all values of one key has no size bound.
    """
    pairs = (
        df.filter(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("key"), F.col(target).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    differing = (
        pairs.groupBy("key")
        .agg(F.count(F.lit(1)).alias("number_different_values"))
        .filter(F.col("number_different_values") != 1)
    )
    return pairs.join(differing, "key").orderBy(F.desc("number_different_values"), "key", "value")


# --- text lengths -------------------------------------------------------------------------

# Unit -> (number of bins, upper end); the lower end is 0.
HISTOGRAMS = {"word": (75, 150), "char": (500, 1000)}


def text_length(column: Column, unit: str) -> Column:
    if unit == "word":
        return tx.word_count(column)
    if unit == "char":
        return tx.char_count(column)
    raise ValueError(f"unknown unit {unit!r}")


def length_histogram(df: DataFrame, unit: str = "word", column: str = "description") -> DataFrame:
    """(bin, low, n) for all bins; lengths out of range are dropped, the last bin is closed."""
    return histogram(df.select(text_length(F.col(column), unit).alias("len")), unit)


def histogram(lengths: DataFrame, unit: str) -> DataFrame:
    """The same of lengths already taken, as (len)."""
    bins, high = HISTOGRAMS[unit]
    kept = lengths.filter(F.col("len").between(0, high))
    width = high // bins
    counts = kept.groupBy(
        F.least(F.floor(F.col("len") / width), F.lit(bins - 1)).cast("int").alias("bin")
    ).agg(F.count(F.lit(1)).alias("n"))
    every = lengths.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(counts, "bin", "left").select(
        "bin", (F.col("bin") * width).alias("low"), F.coalesce("n", F.lit(0)).alias("n")
    )


def length_summary(df: DataFrame, column: str = "description") -> DataFrame:
    """Mean, quartiles and maximum of the character count. Exact: the percentile state counts
    distinct lengths, which are few."""
    return summary(df.select(tx.char_count(F.col(column)).alias("len")))


def summary(lengths: DataFrame) -> DataFrame:
    return lengths.agg(
        F.avg("len").alias("mean"),
        F.percentile("len", 0.25).alias("q1"),
        F.percentile("len", 0.5).alias("median"),
        F.percentile("len", 0.75).alias("q3"),
        F.max("len").alias("longest"),
    )


# --- words --------------------------------------------------------------------------------

def corpus_top_words(df: DataFrame, tokens: str, n: int = 20,
                     stop_words: list[str] | str | None = "english") -> DataFrame:
    """Most common words (those that begin with a word character) without stop words."""
    found = df.select(F.explode(tokens).alias("raw")).select(F.lower("raw").alias("word"))
    kept = found.filter(F.col("word").rlike(f"^[{tx.WORD}]"))
    listed = tx.stop_list(stop_words)
    if listed:
        kept = kept.filter(~F.col("word").isin(listed))
    return kept.groupBy("word").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "word").limit(n)


def words_by_combination(df: DataFrame, words: Column, labels: str = "labels") -> DataFrame:
    """(labels, term, tf): words counted per distinct label combination. The map tasks shrink
    the texts to these counts; neither ids nor texts are shuffled."""
    return (
        df.select(F.col(labels).alias("labels"), F.explode(words).alias("term"))
        .groupBy("labels", "term").agg(F.count(F.lit(1)).alias("tf"))
    )


def words_by_label(df: DataFrame, words: Column, labels: str = "labels") -> DataFrame:
    """(label, word, n): a text counts once for each of its labels."""
    counts = words_by_combination(df, words, labels)
    return (
        counts.select(F.explode("labels").alias("label"), F.col("term").alias("word"), "tf")
        .groupBy("label", "word").agg(F.sum("tf").alias("n"))
    )


def top_words_per_label(df: DataFrame, k: int = 20, column: str = "description",
                        labels: str = "labels",
                        stop_words: list[str] | str | None = "english") -> DataFrame:
    """(label, rank, word, n); ties by word."""
    counts = words_by_label(df, tx.plain_words(F.col(column), stop_words), labels)
    return top_per_group(counts, ["label"], [F.desc("n"), F.asc("word")], k)


def drop_shared_keywords(top: DataFrame, min_labels: int = 2) -> DataFrame:
    """Remove words that are among the top words of ``min_labels`` or more labels."""
    shared = (
        top.groupBy("word").agg(F.count(F.lit(1)).alias("_k"))
        .filter(F.col("_k") >= min_labels).select("word")
    )
    return top.join(shared, "word", "left_anti")


def keyword_lists(top: DataFrame, limit: int = 100_000) -> dict[str, list[str]]:
    """label -> its words in rank order, for the keyword operators. Bounded by labels x k."""
    rows = top.select("label", "rank", "word").limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError("keyword lists are too large for the driver")
    lists: dict[str, list[str]] = {}
    for row in sorted(rows, key=lambda r: (r["label"], r["rank"])):
        lists.setdefault(row["label"], []).append(row["word"])
    return lists
