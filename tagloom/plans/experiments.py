"""Fit, predict and score runs over labelled texts: split -> features -> models -> decisions ->
metrics. Input records: (id, description, labels array<string>)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.ml.feature import MaxAbsScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.functions.labels import decode_labels
from tagloom.functions.text import clean_lemmas
from tagloom.operators import balance, clean, decide, evaluate, features, models, neighbours, split
from tagloom.session import scratch_path, written


@dataclass(frozen=True)
class Config:
    """One line of the run matrix."""

    run: str
    vectorizer: str = "tf-idf"
    sublinear: bool = False
    stop_words: str | None = None
    ngram: tuple[int, int] = (1, 1)
    prune: bool = False
    balancing_ratio: float | None = None
    class_weight: str | None = None
    at_least_one: bool = True
    estimator: str = "lreg"
    lemmatized: bool = False  # text from the column lemmatized_description, cleaned


# The published comparison, balancing x prune x vectorizer x class weight x at-least-one, all on lemmas.
PLAIN_RUNS = [
    Config("balanced, prune tf-idf", prune=True, class_weight="balanced", lemmatized=True),
    Config("balanced tf-idf", class_weight="balanced", lemmatized=True),
    Config("balanced word2vec", vectorizer="word2vec", class_weight="balanced", lemmatized=True),
    Config("baseline count", vectorizer="count", at_least_one=False, lemmatized=True),
    Config("atleast1 tf-idf", lemmatized=True),
    Config("atleast1 count", vectorizer="count", lemmatized=True),
    Config("atleast1, prune tf-idf", prune=True, lemmatized=True),
    Config("atleast1, prune count", vectorizer="count", prune=True, lemmatized=True),
]
SYNTHETIC_RUNS = [
    *[Config(f"atleast1, balancing {v} {r}", vectorizer=v, balancing_ratio=r, lemmatized=True)
      for r in (0.5, 0.75) for v in ("tf-idf", "count")],
    *[Config(f"full {v} {r}", vectorizer=v, balancing_ratio=r, prune=True, stop_words="english",
             sublinear=v == "tf-idf", class_weight="balanced", lemmatized=True)
      for r in (0.5, 0.75) for v in ("tf-idf", "count")],
]
STANDARD_RUNS = PLAIN_RUNS + SYNTHETIC_RUNS


def fit_features(train: DataFrame, test: DataFrame, cfg: Config,
                 scale: bool = True) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """(train rows, test rows, vocabulary index, size): vocabulary, idf and scale come from train."""
    if cfg.vectorizer == "word2vec":
        return embedding_features(train, test, scale)
    if cfg.vectorizer not in features.VECTORIZERS:
        raise ValueError(f"unknown vectorizer {cfg.vectorizer!r}; known: {features.VECTORIZERS}")
    # Counted once: vocabulary, document frequencies and rows all read the written counts.
    tf_train = written(features.count_vectorize(train, cfg.ngram, cfg.stop_words), "counts")
    tf_test = features.count_vectorize(test, cfg.ngram, cfg.stop_words)
    index = written(features.vocabulary(tf_train), "index")
    size = index.count()
    if cfg.vectorizer == "count":
        weights = [t.select("id", "term", F.col("tf").cast("double").alias("weight")) for t in (tf_train, tf_test)]
    else:
        idf = features.inverse_frequency(tf_train, train)
        weights = [features.weigh(t, idf, cfg.sublinear) for t in (tf_train, tf_test)]
    rows = [features.sparse_rows(w, index, size, d.select("id")) for w, d in zip(weights, (train, test))]
    return (*(scaled(rows) if scale else rows), index, size)


def scaled(rows: list[DataFrame]) -> list[DataFrame]:
    """Max-abs scaling of finished rows: row-local, its state is one number per feature."""
    scaler = MaxAbsScaler(inputCol="features", outputCol="scaled").fit(rows[0])
    return [scaler.transform(r).select("id", F.col("scaled").alias("features")) for r in rows]


def embedding_features(train: DataFrame, test: DataFrame, scale: bool) -> tuple[DataFrame, DataFrame, None, int]:
    """Mean word vectors, trained on the training texts; dense rows."""
    size = 100
    vectors = written(features.train_word_vectors(train, vector_size=size), "wordvectors")
    rows = [features.mean_embedding(d, vectors, size).select("id", array_to_vector("embedding").alias("features"))
            for d in (train, test)]
    rows = [written(r, "vectors") for r in rows]
    return (*(scaled(rows) if scale else rows), None, size)


def balanced_sets(rows: DataFrame, vocabulary: list[str], ratio: float, size: int,
                  dense: bool = False, near: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """label -> (id, copy, features, y) with synthetic positives, for labels that need them. A label
    with too few positives to interpolate between is an error. ``near`` keeps the neighbours found for a label, for other ratios of the same rows."""
    spark = rows.sparkSession
    plan = balance.smote_plan(rows, vocabulary, ratio).collect()  # one line per label
    path = scratch_path(spark, "smote")
    bare = rows.select("id", "labels", plain_vector(dense).alias("features"))

    def balanced(job):
        i, line = job
        one = bare.select("id", "features", F.array_contains("labels", line["label"]).cast("int").alias("y"))
        if near is not None and line["label"] not in near and line["pos"] > 5:  # fewer are refused below
            near[line["label"]] = written(balance.positive_neighbours(one), "near")
        made = balance.smote(one, line["synthesize"], near=(near or {}).get(line["label"]))
        if dense:
            return line["label"], written(made.withColumn("features", array_to_vector("features")), "smote")
        return line["label"], features.vector_table(made, size, f"{path}/{i}", extra=["copy", "y"])

    jobs = [(i, line) for i, line in enumerate(plan) if line["synthesize"] > 0]
    with ThreadPoolExecutor(max_workers=4) as pool:
        return dict(pool.map(balanced, jobs))


def plain_vector(dense: bool) -> Column:
    """The feature vector as an array or as sparse parts, for the neighbour search."""
    return vector_to_array("features") if dense else features.vector_parts("features")


def run_one(train: DataFrame, test: DataFrame, vocabulary: list[str], cfg: Config,
            prepared: tuple | None = None, max_iter: int = 1000) -> DataFrame:
    """(id, y_true, y_pred) of the test records."""
    return decided(score(train, test, vocabulary, cfg, prepared, max_iter), test, vocabulary, cfg)


def score(train: DataFrame, test: DataFrame, vocabulary: list[str], cfg: Config,
          prepared: tuple | None = None, max_iter: int = 1000, near: dict[str, DataFrame] | None = None) -> DataFrame:
    """(id, proba) of the test records. ``near`` is that of ``balanced_sets``, for runs on the same prepared rows."""
    if cfg.prune:
        train = clean.prune_texts(train)
    train_x, test_x, _, size = prepared or fit_features(train, test, cfg)
    rows = train_x.join(train.select("id", "labels"), "id")
    dense = cfg.vectorizer == "word2vec"
    if cfg.estimator == "knn":
        sides = [r.withColumn("vector", plain_vector(dense)) for r in (rows, test_x)]
        p = neighbours.knn_proba(sides[0], sides[1])
        return decide.dense_scores(p, vocabulary, test_x).select("id", "proba")
    sets = balanced_sets(rows, vocabulary, cfg.balancing_ratio, size, dense, near) if cfg.balancing_ratio else None
    options = {"max_iter": max_iter} if cfg.estimator in ("lreg", "svm", "mlp") else {}
    model = models.fit_multilabel(rows, vocabulary, cfg.estimator, cfg.class_weight, size, sets, **options)
    return model.predict_proba(test_x).select("id", "proba")


def decided(scored: DataFrame, test: DataFrame, vocabulary: list[str], cfg: Config) -> DataFrame:
    """(id, y_true, y_pred, proba): the decision rule of the run on its probabilities."""
    rule = decide.predict_at_least_one if cfg.at_least_one else decide.predict_threshold
    hot = rule(scored)
    return hot.join(test.select("id", F.array_sort("labels").alias("y_true")), "id").select(
        "id", "y_true", decode_labels(F.col("pred"), vocabulary).alias("y_pred"), "proba")


def lemma_text(df: DataFrame) -> DataFrame:
    """The cleaned lemmas in place of the text; pruning looks at the text before."""
    return df.withColumn("description", clean_lemmas(F.col("lemmatized_description")))


METRICS = ["jaccard", "hamming", "precision", "recall", "at_least_one", "at_least_two"]


LEDGER = "key string, run string, metric string, value double"


def run_key(records: DataFrame, vocabulary: list[str], cfg: Config, *settings) -> str:
    """Name of a run: a digest of its configuration and settings and of the contents of the records, whatever their order."""
    kept = [c for c in ("id", "description", "lemmatized_description", "labels") if c in records.columns]
    state = records.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*kept).cast("decimal(38,0)"))).first()
    return hashlib.sha256(repr((cfg, list(vocabulary), settings, [str(x) for x in state])).encode()).hexdigest()


def run_matrix(records: DataFrame, vocabulary: list[str], configs: list[Config] | None = None,
               test: float = 0.1, max_iter: int = 1000, dev: bool = False, ledger: str | None = None) -> DataFrame:
    """(run, metric, value) for every configuration, on one split; dev=True trains on the dev
    share of the training set. Lemmatized runs need the column lemmatized_description.

    ``ledger`` is a folder of finished runs, shared by any number of matrices: every run is added when it is done, and a
    run that it holds for the same configuration, settings and records is not repeated. A matrix that was stopped goes on
    with the run it was in."""
    wanted = configs or STANDARD_RUNS
    if ledger:
        spark = records.sparkSession
        spark.createDataFrame([], LEDGER).write.mode("append").parquet(ledger)
        keys = {cfg: run_key(records, vocabulary, cfg, test, max_iter, dev) for cfg in wanted}
        done = {r["key"] for r in spark.read.schema(LEDGER).parquet(ledger).where(F.col("key").isin(list(keys.values()))).select("key").distinct().collect()}
        for cfg, run in matrix_runs(records, vocabulary, [c for c in wanted if keys[c] not in done], test, max_iter, dev):
            run.select(F.lit(keys[cfg]).alias("key"), "run", "metric", "value").coalesce(1).write.mode("append").parquet(ledger)
        table = spark.read.schema(LEDGER).parquet(ledger).where(F.col("key").isin(list(keys.values())))
        # Two matrices that ran at the same time may both have written a run.
        return table.dropDuplicates(["key", "metric"]).select("run", "metric", "value")
    return reduce(DataFrame.unionByName, [run for _, run in matrix_runs(records, vocabulary, wanted, test, max_iter, dev)])


def matrix_runs(records: DataFrame, vocabulary: list[str], configs: list[Config], test: float, max_iter: int,
                dev: bool) -> Iterator[tuple[Config, DataFrame]]:
    """Each configuration with its (run, metric, value). Runs that differ only in their decision rule share their models."""
    if not configs:
        return
    parts = written(split.stratified_split(records, test), "split")
    train = parts.filter("dev" if dev else "split = 'train'")
    held = parts.filter("split = 'test'")
    prepared: dict[Config, tuple] = {}
    scores: dict[Config, DataFrame] = {}
    near: dict[Config, dict[str, DataFrame]] = {}
    for cfg in configs:
        # Runs that differ only in balancing, class weight or decision rule share their features.
        key = replace(cfg, run="", balancing_ratio=None, class_weight=None, at_least_one=True, estimator="")
        if key not in prepared:
            base = clean.prune_texts(train) if cfg.prune else train
            texts = [lemma_text(d) if cfg.lemmatized else d for d in (base, held)]
            prepared[key] = fit_features(texts[0], texts[1], cfg)
        model = replace(cfg, run="", at_least_one=True)
        if model not in scores:
            scores[model] = written(score(train, held, vocabulary, cfg, prepared[key], max_iter, near.setdefault(key, {})), "scores")
        one = evaluate.compute_metrics(decided(scores[model], held, vocabulary, cfg), vocabulary, METRICS)
        yield cfg, written(one.select(F.lit(cfg.run).alias("run"), "metric", "value"), "run")


def run_binary(records: DataFrame, label: str, vocabulary: list[str], keywords: list[str] | None = None,
               cfg: Config = Config("binary", vectorizer="count"), test: float = 0.1,
               max_iter: int = 1000) -> DataFrame:
    """One label: scores of the plain model, or with keywords of the boosted rule. No max-abs
    scaling, as opposed to the multi-label run."""
    return binary_decision(score_binary(records, label, vocabulary, cfg, test, max_iter), keywords)


def score_binary(records: DataFrame, label: str, vocabulary: list[str], cfg: Config = Config("binary", vectorizer="count"),
                 test: float = 0.1, max_iter: int = 1000) -> DataFrame:
    """(id, proba, description, y) of the test records by the model of one label, written once for any number of decision rules."""
    parts = written(split.stratified_split(records.select("id", "description", "labels"), test), "split")
    train, held = parts.filter("split = 'train'"), parts.filter("split = 'test'")
    train_x, test_x, _, size = fit_features(train, held, cfg, scale=False)
    rows = train_x.join(train.select("id", "labels"), "id")
    per_label = balanced_sets(rows, [label], cfg.balancing_ratio, size) if cfg.balancing_ratio else None
    model = models.fit_multilabel(rows, [label], cfg.estimator, cfg.class_weight, size, per_label,
                                  max_iter=max_iter)
    scored = model.predict_proba(test_x).select("id", F.get("proba", 0).alias("proba"))
    held = held.select("id", "description", F.array_contains("labels", label).cast("int").alias("y"))
    return written(scored.join(held, "id"), "scores")


def binary_decision(scored: DataFrame, keywords: list[str] | None = None) -> DataFrame:
    """The report of the plain rule on scored records, or of the boosted rule with keywords."""
    if keywords is None:
        return evaluate.binary_report(scored.withColumn("p", (F.col("proba") >= 0.5).cast("int")))
    return evaluate.binary_report(decide.predict_binary_boosted(scored, keywords))
