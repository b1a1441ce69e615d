"""Multi-label quality. The input is one row per record (empty records included) with
``y_true`` and ``y_pred`` as arrays of distinct label names, so every per-record score is a
row-local expression and every report is one partial-aggregable groupBy.

A zero division gives 0.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.functions import text as tx
from tagloom.functions.labels import decode_labels, safe_ratio, signed_overlap
from tagloom.operators.ranking import equal_count_bins
from tagloom.session import names_table, written


def align_truth_pred(ids: DataFrame, truth: DataFrame, pred: DataFrame) -> DataFrame:
    """(id) + long (id, label) tables -> one row per id with both label sets. One shuffle;
    ids without labels stay, with empty sets."""
    none = F.lit(None).cast("string")
    rows = (
        ids.select("id", none.alias("t"), none.alias("p"))
        .unionByName(truth.select("id", F.col("label").alias("t"), none.alias("p")))
        .unionByName(pred.select("id", none.alias("t"), F.col("label").alias("p")))
    )
    return label_sets(rows)


def label_sets(rows: DataFrame) -> DataFrame:
    """(id, t, p) with nulls for "none" -> (id, y_true, y_pred)."""
    return rows.groupBy("id").agg(
        F.array_sort(F.collect_set("t")).alias("y_true"),
        F.array_sort(F.collect_set("p")).alias("y_pred"),
    )


def align_long(truth: DataFrame, pred: DataFrame) -> DataFrame:
    """(id, label, t, p): every pair of truth or prediction, absent side 0."""
    both = (
        truth.select("id", "label", F.lit(1).alias("t"), F.lit(0).alias("p"))
        .unionByName(pred.select("id", "label", F.lit(0).alias("t"), F.lit(1).alias("p")))
    )
    return both.groupBy("id", "label").agg(F.max("t").alias("t"), F.max("p").alias("p"))


# --- per record ---------------------------------------------------------------------------

def counts(scored: DataFrame) -> DataFrame:
    """Add tp, n_true, n_pred."""
    return scored.withColumns({
        "tp": F.size(F.array_intersect("y_true", "y_pred")),
        "n_true": F.size("y_true"),
        "n_pred": F.size("y_pred"),
    })


def binary_scores(tp: Column, fp: Column, fn: Column, tn: Column) -> dict[str, Column]:
    """Scores of one 0/1 vector against another, from its four counts."""
    n = tp + fp + fn + tn
    recall = safe_ratio(tp, tp + fn)
    rejected = safe_ratio(tn, tn + fp)
    has_pos, has_neg = (tp + fn) > 0, (tn + fp) > 0
    balanced = (
        F.when(has_pos & has_neg, (recall + rejected) / 2.0)
        .when(has_pos, recall).otherwise(rejected)
    )
    accuracy = safe_ratio(tp + tn, n)
    return {
        "jaccard": safe_ratio(tp, tp + fp + fn),
        "hamming": safe_ratio(fp + fn, n),
        "accuracy": accuracy,
        "balanced_accuracy": balanced,
        "f1": safe_ratio(2 * tp, 2 * tp + fp + fn),
        "precision": safe_ratio(tp, tp + fp),
        "recall": recall,
    }


def pick(scores: dict[str, Column], metric: str) -> Column:
    if metric not in scores:
        raise ValueError(f"unknown metric {metric!r}; known: {sorted(scores)}")
    return scores[metric]


def record_scores(n_labels: int) -> dict[str, Column]:
    tp, nt, np_ = F.col("tp"), F.col("n_true"), F.col("n_pred")
    return binary_scores(tp, np_ - tp, nt - tp, F.lit(n_labels) - (nt + np_ - tp))


def score_per_record(scored: DataFrame, n_labels: int, metric: str = "jaccard",
                     name: str = "score") -> DataFrame:
    value = pick(record_scores(n_labels), metric)
    return counts(scored).withColumn(name, value).drop("tp", "n_true", "n_pred")


def signed_overlap_record(scored: DataFrame, name: str = "signed_overlap") -> DataFrame:
    value = signed_overlap(F.col("tp"), F.col("n_true"), F.col("n_pred"))
    return counts(scored).withColumn(name, value).drop("tp", "n_true", "n_pred")


# --- whole set ----------------------------------------------------------------------------

SUMMARY = ["jaccard", "hamming", "accuracy", "f1", "precision", "recall", "at_least_one",
           "at_least_two", "signed_overlap"]


def at_least_k(k: int) -> Column:
    return F.avg((F.col("tp") >= k).cast("double"))


def summary_aggregates(n_labels: int) -> dict[str, Column]:
    per_record = record_scores(n_labels)
    wrong = F.col("n_true") + F.col("n_pred") - 2 * F.col("tp")
    return {
        "jaccard": F.avg(per_record["jaccard"]),
        "hamming": F.sum(wrong) / (F.count(F.lit(1)) * F.lit(float(n_labels))),
        "accuracy": F.avg((wrong == 0).cast("double")),
        "f1": F.avg(per_record["f1"]),
        "precision": F.avg(per_record["precision"]),
        "recall": F.avg(per_record["recall"]),
        "at_least_one": at_least_k(1),
        "at_least_two": at_least_k(2),
        "signed_overlap": F.avg(signed_overlap(F.col("tp"), F.col("n_true"), F.col("n_pred"))),
    }


def multilabel_metrics(scored: DataFrame, n_labels: int, names: list[str] | None = None) -> DataFrame:
    """One row, one column per metric; one pass over the records."""
    known = summary_aggregates(n_labels)
    return counts(scored).agg(*[pick(known, m).alias(m) for m in names or SUMMARY])


def compute_metrics(scored: DataFrame, vocabulary: list[str],
                    names: list[str] | None = None) -> DataFrame:
    """(metric, label, value): the named metrics in long form. Whole-set metrics have label
    null; ``confusion_matrix`` and ``classification_report`` add rows per label or average."""
    names = list(names or [*SUMMARY, "confusion_matrix", "classification_report"])
    whole = [m for m in names if m in SUMMARY]
    parts = []
    if whole:
        one = multilabel_metrics(scored, len(vocabulary), whole)
        parts.append(one.select(F.inline(F.array(*[
            F.struct(F.lit(m).alias("metric"), F.lit(None).cast("string").alias("label"),
                     F.col(m).cast("double").alias("value")) for m in whole]))))
    tables = {"confusion_matrix": (confusion_per_label, ["tn", "fp", "fn", "tp"], "label"),
              "classification_report": (classification_report,
                                        ["precision", "recall", "f1", "support"], "name")}
    for m in names:
        if m in tables:
            build, columns, key = tables[m]
            rows = [F.struct(F.lit(f"{m}:{c}").alias("metric"), F.col(key).alias("label"),
                             F.col(c).cast("double").alias("value")) for c in columns]
            parts.append(build(scored, vocabulary).select(F.inline(F.array(*rows))))
        elif m not in SUMMARY:
            raise ValueError(f"unknown metric {m!r}")
    return reduce(DataFrame.unionByName, parts)


# --- per label ----------------------------------------------------------------------------

def label_set_pairs(scored: DataFrame) -> DataFrame:
    """(y_true, y_pred, n): records counted by their pair of label sets. Every report below
    starts from this one aggregation, so Spark runs it once and reuses its shuffle."""
    return scored.groupBy("y_true", "y_pred").agg(F.count(F.lit(1)).alias("n"))


def confusion_per_label(scored: DataFrame, vocabulary: list[str]) -> DataFrame:
    """(label, tn, fp, fn, tp) for the whole vocabulary."""
    return confusion(label_set_pairs(scored), vocabulary)


def confusion(pairs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """The same from label_set_pairs; each distinct pair is unfolded once."""
    cells = pairs.select(
        "y_true", "y_pred", "n", F.explode(F.array_union("y_true", "y_pred")).alias("label")
    )
    t, p = F.array_contains("y_true", F.col("label")), F.array_contains("y_pred", F.col("label"))

    def total(cond: Column) -> Column:
        return F.sum(F.when(cond, F.col("n")).otherwise(0))

    found = cells.groupBy("label").agg(
        total(t & p).alias("tp"), total(~t & p).alias("fp"), total(t & ~p).alias("fn")
    )
    names = names_table(pairs.sparkSession, vocabulary)
    n = pairs.agg(F.sum("n").alias("n")).scalar()
    full = names.join(found, "label", "left").fillna(0, ["tp", "fp", "fn"])
    tn = F.coalesce(n, F.lit(0)) - F.col("tp") - F.col("fp") - F.col("fn")
    return full.select("label", tn.alias("tn"), "fp", "fn", "tp")


def label_scores() -> dict[str, Column]:
    return binary_scores(F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn"))


def classification_report(scored: DataFrame, vocabulary: list[str]) -> DataFrame:
    """(name, precision, recall, f1, support): a row per label, then micro, macro, weighted
    and samples averages (named ``micro avg`` and so on)."""
    s = label_scores()
    pairs = label_set_pairs(scored)
    per_label = confusion(pairs, vocabulary).select(
        F.col("label").alias("name"), s["precision"].alias("precision"),
        s["recall"].alias("recall"), s["f1"].alias("f1"),
        (F.col("tp") + F.col("fn")).alias("support"), "tp", "fp", "fn",
    )
    def weighted(c):
        return safe_ratio(F.sum(F.col(c) * F.col("support")), F.sum("support"))
    tp, fp, fn, sup = F.sum("tp"), F.sum("fp"), F.sum("fn"), F.sum("support")
    # Both blocks read the aggregated per-label table, which has one row per label.
    averages = per_label.agg(
        F.array(
            F.struct(F.lit("micro avg").alias("name"), safe_ratio(tp, tp + fp).alias("precision"),
                     safe_ratio(tp, tp + fn).alias("recall"),
                     safe_ratio(2 * tp, 2 * tp + fp + fn).alias("f1"), sup.alias("support")),
            F.struct(F.lit("macro avg").alias("name"), F.avg("precision").alias("precision"),
                     F.avg("recall").alias("recall"), F.avg("f1").alias("f1"), sup.alias("support")),
            F.struct(F.lit("weighted avg").alias("name"), weighted("precision").alias("precision"),
                     weighted("recall").alias("recall"), weighted("f1").alias("f1"),
                     sup.alias("support")),
        ).alias("a")
    ).select(F.inline("a"))
    r = record_scores(len(vocabulary))
    def mean(c: Column) -> Column:
        return F.sum(c * F.col("n")) / F.sum("n")
    samples = counts(pairs).agg(
        mean(r["precision"]).alias("precision"), mean(r["recall"]).alias("recall"),
        mean(r["f1"]).alias("f1"), F.sum(F.col("n_true") * F.col("n")).alias("support"),
    ).select(F.lit("samples avg").alias("name"), "precision", "recall", "f1", "support")
    return (
        per_label.drop("tp", "fp", "fn").unionByName(averages).unionByName(samples)
    )


def metrics_per_label(scored: DataFrame, vocabulary: list[str],
                      names: tuple[str, ...] = ("balanced_accuracy", "precision", "recall")) -> DataFrame:
    """(label, metrics..., share) by balanced accuracy, best first; ties by label."""
    s = label_scores()
    pairs = label_set_pairs(scored)
    table = confusion(pairs, vocabulary)
    total = pairs.agg(F.sum(F.size("y_true") * F.col("n")).alias("t")).scalar()
    order = "balanced_accuracy" if "balanced_accuracy" in names else names[0]
    return table.select(
        "label", *[pick(s, m).alias(m) for m in names],
        safe_ratio(F.col("tp") + F.col("fn"), total).alias("share"),
    ).orderBy(F.desc(order), "label")


def prediction_histogram(scored: DataFrame, vocabulary: list[str]) -> DataFrame:
    """(label, n) predictions per label, by (n, label) descending."""
    return confusion_per_label(scored, vocabulary).select(
        "label", (F.col("tp") + F.col("fp")).alias("n")
    ).orderBy(F.desc("n"), F.desc("label"))


def score_by_label_support(scored: DataFrame, n_labels: int, metric: str = "jaccard") -> DataFrame:
    """(label, support, score): mean record score over the records that have the label."""
    return (
        score_per_record(label_set_pairs(scored), n_labels, metric)
        .select(F.explode("y_true").alias("label"), "score", "n")
        .groupBy("label")
        .agg(F.sum("n").alias("support"), (F.sum(F.col("score") * F.col("n")) / F.sum("n")).alias("score"))
    )


# --- one label ----------------------------------------------------------------------------

def binary_counts(df: DataFrame, truth: str = "y", pred: str = "p") -> list[Column]:
    t, p = F.col(truth) == 1, F.col(pred) == 1
    return [F.count_if(t & p).alias("tp"), F.count_if(~t & p).alias("fp"),
            F.count_if(t & ~p).alias("fn"), F.count_if(~t & ~p).alias("tn")]


BINARY = ["precision", "recall", "f1", "accuracy", "balanced_accuracy"]


def binary_report(df: DataFrame, truth: str = "y", pred: str = "p",
                  names: list[str] | None = None) -> DataFrame:
    """One row of scores for 0/1 columns."""
    s = label_scores()
    return df.agg(*binary_counts(df, truth, pred)).select(
        *[pick(s, m).alias(m) for m in names or BINARY]
    )


def binary_slice(scored: DataFrame, label: str) -> DataFrame:
    """Multi-label records seen as the 0/1 problem of one label."""
    return scored.withColumns({
        "y": F.array_contains("y_true", label).cast("int"),
        "p": F.array_contains("y_pred", label).cast("int"),
    })


# --- by length ----------------------------------------------------------------------------

def metrics_by_length(scored: DataFrame, n_labels: int, text: str = "description",
                      metric: str = "jaccard", bins: int = 9) -> DataFrame:
    """(bin, low, n, score) over equal-width word-count bins between 0 and the maximum.
    Records of exactly the maximal length fall in no bin; an empty bin has a null score."""
    rows = score_per_record(scored, n_labels, metric).select(
        tx.word_count(F.col(text)).alias("len"), "score"
    )
    # Written: the maximum comes from these counts too, not from a second pass over the texts.
    by_len = written(rows.groupBy("len").agg(F.count(F.lit(1)).alias("n"), F.sum("score").alias("s")), "by_length")
    longest = by_len.agg(F.max("len").alias("m")).scalar()
    # Bin edges are i * max / bins, as in an evenly spaced grid.
    edge = F.transform(F.sequence(F.lit(0), F.lit(bins)), lambda i: i * (F.col("_max") / F.lit(float(bins))))
    placed = by_len.withColumn("_max", longest).withColumn("_edges", edge).withColumn(
        "bin", F.size(F.filter("_edges", lambda e: e <= F.col("len"))) - 1
    )
    found = placed.filter(F.col("len") < F.col("_max")).groupBy("bin").agg(
        F.sum("n").alias("n"), F.sum("s").alias("s")
    )
    every = scored.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(found, "bin", "left").select(
        "bin", (F.col("bin") * (longest / F.lit(float(bins)))).alias("low"),
        F.coalesce("n", F.lit(0)).alias("n"), (F.col("s") / F.col("n")).alias("score"),
    )


def metrics_by_length_quantile(df: DataFrame, identifier: str = "id", text: str = "description",
                               truth: str = "y", pred: str = "p", metric: str = "f1",
                               bins: int = 20) -> DataFrame:
    """(bin, range, n, score): near-equal-count bins by word count, one binary score each."""
    narrow = df.select(identifier, F.col(truth), F.col(pred), tx.word_count(F.col(text)).alias("len"))
    binned = equal_count_bins(narrow, "len", identifier, bins)
    per_bin = binned.groupBy("bin").agg(
        *binary_counts(binned, truth, pred), F.min("len").alias("lo"), F.max("len").alias("hi"),
        F.count(F.lit(1)).alias("n"),
    )
    return per_bin.select(
        "bin", F.concat_ws("-", F.col("lo").cast("string"), F.col("hi").cast("string")).alias("range"),
        "n", pick(label_scores(), metric).alias("score"),
    )


# --- samples ------------------------------------------------------------------------------

def worst_records(scored: DataFrame, n_labels: int, n: int = 30) -> DataFrame:
    """Lowest Jaccard first, ties by id."""
    return score_per_record(scored, n_labels, "jaccard", "jaccard").orderBy("jaccard", "id").limit(n)


def best_records(scored: DataFrame, n_labels: int, n: int = 30) -> DataFrame:
    """Highest Jaccard first, ties by id descending (the tail of the ascending order)."""
    by = [F.desc("jaccard"), F.desc("id")]
    return score_per_record(scored, n_labels, "jaccard", "jaccard").orderBy(*by).limit(n)


def extreme_samples(df: DataFrame, score: Column, n: int = 30) -> DataFrame:
    half = n - n // 2
    ranked = df.withColumn("rank_score", score)
    high = ranked.orderBy(F.desc("rank_score"), F.desc("id")).limit(half).withColumn("side", F.lit("high"))
    low = ranked.orderBy("rank_score", "id").limit(n // 2).withColumn("side", F.lit("low"))
    return high.unionByName(low)


def binary_bad_samples(df: DataFrame, n: int = 30, truth: str = "y", proba: str = "proba") -> DataFrame:
    """Missed positives (high (1-p)+y) and false alarms (low)."""
    return extreme_samples(df, (F.lit(1.0) - F.col(proba)) + F.col(truth), n)


def binary_good_samples(df: DataFrame, n: int = 30, truth: str = "y", proba: str = "proba") -> DataFrame:
    """Confident hits (high p+y) and confident rejections (low)."""
    return extreme_samples(df, F.col(proba) + F.col(truth), n)


# --- comparing runs -----------------------------------------------------------------------

def compare_runs(a: DataFrame, b: DataFrame, keys: list[str], metrics: list[str]) -> DataFrame:
    """keys + a, b and b - a of every metric."""
    left = a.select(*keys, *[F.col(m).alias(f"{m}_a") for m in metrics])
    right = b.select(*keys, *[F.col(m).alias(f"{m}_b") for m in metrics])
    both = left.join(right, keys)
    for m in metrics:
        both = both.withColumn(f"{m}_diff", F.col(f"{m}_b") - F.col(f"{m}_a"))
    return both


def random_guess(ids: DataFrame, vocabulary: list[str], seed: int, rate: float = 0.5) -> DataFrame:
    """Add y_pred: each label predicted with the given rate, from a hash of (id, label, seed).
    Row-local: the label list travels as a literal."""
    def guessed(label: Column) -> Column:
        h = F.md5(F.concat_ws("|", F.col("id").cast("string"), label, F.lit(str(seed))))
        return F.conv(F.substring(h, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0) < rate
    return ids.withColumn("y_pred", F.filter(F.lit(list(vocabulary)), guessed))


def model_agreement(df: DataFrame, vocabulary: list[str], a: str = "pred_a", b: str = "pred_b") -> DataFrame:
    """(label, agreement, correlation) of two classifiers' 0/1 predictions; correlation is null
    where one of them is constant."""
    cells = confusion_per_label(df.select(F.col(a).alias("y_true"), F.col(b).alias("y_pred")), vocabulary)
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    spread_ = F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))
    return cells.select(
        "label", safe_ratio(tp + tn, tp + fp + fn + tn).alias("agreement"),
        F.try_divide(tp * tn - fp * fn, spread_).alias("correlation"),
    )


def decoded(scored: DataFrame, vocabulary: list[str], hot: str, name: str) -> DataFrame:
    return scored.withColumn(name, decode_labels(F.col(hot), vocabulary))


def rank_metrics(table: DataFrame, by: str, name: str = "label") -> DataFrame:
    return table.orderBy(F.desc(by), name)
