"""One binary model per label: logistic models fitted together (operators/linear.py), random forests of dense rows
(operators/forest.py), the others by MLlib, and naive Bayes as plain aggregations.

Training rows are (id, features vector, labels array<string>). MLlib fits share one written feature
table and run a few at a time.
"""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce
from itertools import accumulate

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.fixed import SEED
from tagloom.functions.labels import sigmoid
from tagloom.operators import forest, linear
from tagloom.operators.balance import positives, unit
from tagloom.session import written

ESTIMATORS = ("lreg", "svm", "bayes", "dt", "rf", "mlp")
# Cumulative Poisson(1) probabilities, to where they are 1 in double precision.
POISSON_STEPS = list(accumulate(math.exp(-1) / math.factorial(k) for k in range(18)))
BAGS = 10
MAX_DEPTH = 30  # MLlib accepts no deeper trees


def estimator(name: str, weight_total: float, n_features: int, **options):
    """The MLlib estimator for a name other than lreg, on columns features, y and w. Trees grow to MLlib's greatest
    depth unless ``max_depth`` says otherwise."""
    from pyspark.ml import classification as mc

    common = {"featuresCol": "features", "labelCol": "y"}
    if name == "svm":
        c = options.pop("C", 1.0)
        return mc.LinearSVC(**common, weightCol="w", standardization=False,
                            regParam=1.0 / (c * weight_total), maxIter=options.pop("max_iter", 100), **options)
    if name == "bayes":
        return mc.NaiveBayes(**common, modelType="multinomial", smoothing=options.pop("alpha", 1.0))
    if name == "dt":
        return mc.DecisionTreeClassifier(**common, weightCol="w", seed=SEED,
                                         maxDepth=options.pop("max_depth", MAX_DEPTH), **options)
    if name == "rf":
        return mc.RandomForestClassifier(**common, weightCol="w", seed=options.pop("seed", SEED),
                                         numTrees=options.pop("n_estimators", 100),
                                         maxDepth=options.pop("max_depth", MAX_DEPTH), **options)
    if name == "mlp":
        hidden = options.pop("hidden", [100])
        return mc.MultilayerPerceptronClassifier(
            **common, layers=[n_features, *hidden, 2], seed=options.pop("seed", SEED),
            maxIter=options.pop("max_iter", 200), **options)
    raise ValueError(f"unknown estimator {name!r}; known: {', '.join(ESTIMATORS)}, knn")


@dataclass
class MultiLabelModel:
    """Fitted models by label, in vocabulary order; a bagged label holds several. ``odds`` holds
    factors that turn MLlib's smoothed class priors of naive Bayes into the plain ones."""

    name: str
    vocabulary: list[str]
    models: dict[str, list] = field(default_factory=dict)
    odds: dict[str, float] = field(default_factory=dict)

    def predict_proba(self, rows: DataFrame, name: str = "proba") -> DataFrame:
        """Add the dense probability array; all models score in one pass over the rows."""
        if self.name == "lreg":
            scores = linear.margins("features", [self.models[label][0] for label in self.vocabulary])
            return rows.withColumn(name, F.transform(scores, sigmoid))
        if self.vocabulary and all(isinstance(self.models[label][0], forest.Forest) for label in self.vocabulary):
            placed = written(rows.withColumn("_row", F.monotonically_increasing_id()), "scored")
            parts = [self.models[label][0].score(placed.select("_row", "features")).withColumn("_i", F.lit(i))
                     for i, label in enumerate(self.vocabulary)]
            sums = reduce(DataFrame.unionByName, parts).groupBy("_row").agg(
                *[(F.sum(F.when(F.col("_i") == i, F.col("p"))) / self.models[v][0].trees).alias(f"_p{i}") for i, v in enumerate(self.vocabulary)])
            return placed.join(sums, "_row").select(*rows.columns, F.array(*[f"_p{i}" for i in range(len(parts))]).alias(name))
        kept, out, parts = rows.columns, rows, []
        for i, label in enumerate(self.vocabulary):
            votes = []
            for j, model in enumerate(self.models[label]):
                p = model.copy()
                tag = f"_{i}_{j}"
                p = p.setPredictionCol(f"_y{tag}").setRawPredictionCol(f"_r{tag}")
                if self.name == "svm":
                    votes.append(F.col(f"_y{tag}"))
                else:
                    p = p.setProbabilityCol(f"_p{tag}")
                    share = F.get(vector_to_array(f"_p{tag}"), 1)
                    if label in self.odds:
                        k = F.lit(self.odds[label])
                        share = share * k / (share * k + 1.0 - share)
                    votes.append(share)
                out = p.transform(out)
            total = votes[0]
            for v in votes[1:]:
                total = total + v
            parts.append((total / F.lit(float(len(votes)))).alias(label))
        return out.select(*kept, F.array(*parts).alias(name))


def class_weight_column(y: Column, pos: float, n: float, class_weight: str | None) -> Column:
    if class_weight not in (None, "balanced"):
        raise ValueError(f"unknown class_weight {class_weight!r}")
    if class_weight is None or not 0 < pos < n:
        return F.lit(1.0)
    return F.when(y == 1.0, F.lit(n / (2.0 * pos))).otherwise(F.lit(n / (2.0 * (n - pos))))


def label_frames(rows: DataFrame, vocabulary: list[str], class_weight: str | None) -> dict[str, tuple]:
    """label -> (frame with y and w, positives, rows), from one count over all labels."""
    frames = {}
    for line in positives(rows, vocabulary).collect():  # one line per label
        label, pos, n = line["label"], float(line["pos"]), float(line["n"])
        y = F.array_contains("labels", label).cast("double")
        w = class_weight_column(y, pos, n, class_weight)
        frames[label] = (rows.select("id", "features", y.alias("y"), w.alias("w")), pos, n)
    return frames


def resampled(frame: DataFrame, bag: int, seed: int) -> DataFrame:
    """Bootstrap by Poisson(1) weights from a hash of (id, bag): same rows on every rerun.
    Synthetic rows of one record differ in ``copy``."""
    key = [F.col("id"), F.col("copy")] if "copy" in frame.columns else [F.col("id")]
    u = unit(*key, F.lit(bag), F.lit(seed))
    copies = sum(((u >= s).cast("int") for s in POISSON_STEPS), F.lit(0))
    return frame.withColumn("w", F.col("w") * copies).filter(F.col("w") > 0)


def fit_multilabel(rows: DataFrame, vocabulary: list[str], name: str = "lreg",
                   class_weight: str | None = None, n_features: int | None = None,
                   per_label: dict[str, DataFrame] | None = None, threads: int = 4,
                   bags: int = BAGS, **options) -> MultiLabelModel:
    """``per_label`` holds balanced training sets (id, copy, features, y) of some labels: the rows of ``rows`` as
    copy 0, and synthetic ones. Logistic models are fitted together; MLlib fits run ``threads`` at a time
    over one table, which is written to the shared folder."""
    if name not in ESTIMATORS:
        raise ValueError(f"unknown estimator {name!r}; known: {', '.join(ESTIMATORS)}, knn")
    if n_features is None:
        n_features = rows.select("features").first()["features"].size
    if name == "lreg":
        fitted = linear.fit_logistic(linear_rows(rows, vocabulary, per_label), len(vocabulary), n_features, 1, class_weight, **options)
        return MultiLabelModel(name, list(vocabulary), dict(zip(vocabulary, fitted)))
    rows = written(rows.select("id", "features", "labels"), "training")
    frames = label_frames(rows, vocabulary, class_weight)
    for label, frame in (per_label or {}).items():
        frames[label] = weighted(frame, class_weight)
    jobs = [(label, bag) for label in vocabulary for bag in range(bags if name == "svm" else 1)]

    def fit(job):
        frame, _, total = frames[job[0]]  # the weights add up to the number of rows
        sample = resampled(frame, job[1], SEED) if name == "svm" else frame
        if name == "rf" and n_features <= forest.MAX_FEATURES and options.keys() <= {"n_estimators", "max_depth", "seed"}:
            return forest.fit_forest(frame, **{"seed": SEED, **options})
        return estimator(name, total, n_features, **options).fit(sample)

    with ThreadPoolExecutor(max_workers=threads) as pool:
        fitted = list(pool.map(fit, jobs))
    models: dict[str, list] = {}
    for (label, _), model in zip(jobs, fitted):
        models.setdefault(label, []).append(model)
    odds = {}
    if name == "bayes":
        for label, (_, pos, n) in frames.items():
            if 0 < pos < n:
                odds[label] = (pos / (n - pos)) / ((pos + 1.0) / (n - pos + 1.0))
    return MultiLabelModel(name, list(vocabulary), models, odds)


def linear_rows(rows: DataFrame, vocabulary: list[str], per_label: dict[str, DataFrame] | None = None) -> DataFrame:
    """(features, y by label, copies, only): the rows for all labels, and the synthetic rows of one label each."""
    held = F.transform(F.lit(list(vocabulary)), lambda v: F.coalesce(F.array_contains("labels", v), F.lit(False)).cast("tinyint"))
    one = F.array(F.lit(1).cast("tinyint"))
    out = rows.select("features", held.alias("y"), one.alias("copies"), F.lit(-1).alias("only"))
    for label, frame in (per_label or {}).items():
        y = F.array_repeat(F.col("y").cast("tinyint"), len(vocabulary))
        out = out.unionByName(frame.where("copy > 0").select("features", y.alias("y"), one.alias("copies"), F.lit(vocabulary.index(label)).alias("only")))
    return out


def weighted(frame: DataFrame, class_weight: str | None) -> tuple[DataFrame, float, float]:
    """Add w to (id, copy, features, y) rows; also the numbers of positives and of rows."""
    frame = frame.withColumn("y", F.col("y").cast("double"))
    pos, n = (float(x or 0) for x in frame.agg(F.sum("y"), F.count(F.lit(1))).first())
    return frame.withColumn("w", class_weight_column(F.col("y"), pos, n, class_weight)), pos, n


def model_weights(model: MultiLabelModel, index: DataFrame) -> DataFrame:
    """(label, term, weight): coefficients, else feature importances, else the log-probabilities
    of the positive class. ``index`` is (term, index). Empty for models without any of them."""
    spark = index.sparkSession
    rows = []
    for label in model.vocabulary:
        m = model.models[label][0]
        if len(model.models[label]) == 1:
            values = getattr(m, "coefficients", None)
            if values is None:
                values = getattr(m, "featureImportances", None)
            if values is None and hasattr(m, "theta"):
                values = m.theta.toArray()[1]
            if values is not None:
                values = values.toArray() if hasattr(values, "toArray") else values
                rows.append((label, [float(v) for v in values]))
    table = spark.createDataFrame(rows, "label string, w array<double>")
    return table.select("label", F.posexplode("w").alias("index", "weight")) \
        .join(index.select("index", "term"), "index").select("label", "term", "weight")


# --- multinomial naive Bayes ----------------------------------------------------------------

def bayes_fit(counts: DataFrame, vocabulary: list[str]) -> DataFrame:
    """(term, log_pos, log_neg): smoothed log-probabilities of every term within and outside each
    label, as arrays in vocabulary order, from explore.words_by_combination.

    One aggregation by term with a sum per label. The table is written: totals over it are taken
    first, then the logarithms.
    """
    inside = [F.sum(F.when(F.array_contains("labels", v), F.col("tf")).otherwise(0)).alias(f"c{i}")
              for i, v in enumerate(vocabulary)]
    table = written(counts.groupBy("term").agg(F.sum("tf").alias("all"), *inside), "bayes")
    totals = table.agg(F.count(F.lit(1)).alias("v"), F.sum("all").alias("all"),
                       *[F.sum(f"c{i}").alias(f"c{i}") for i in range(len(vocabulary))]).first()
    v, grand = float(totals["v"]), float(totals["all"] or 0)
    pos, neg = [], []
    for i in range(len(vocabulary)):
        held = float(totals[f"c{i}"] or 0)
        c = F.col(f"c{i}")
        pos.append(F.log((c + 1.0) / F.lit(held + v)))
        neg.append(F.log((F.col("all") - c + 1.0) / F.lit(grand - held + v)))
    return table.select("term", F.array(*pos).alias("log_pos"), F.array(*neg).alias("log_neg"))


def bayes_weights(model: DataFrame, vocabulary: list[str]) -> DataFrame:
    """The model in long form: (label, term, log_pos, log_neg)."""
    names = F.lit(list(vocabulary)).alias("label")
    return model.select("term", F.inline(F.arrays_zip(names, "log_pos", "log_neg"))) \
        .select("label", "term", "log_pos", "log_neg")


def bayes_priors(labels: DataFrame, vocabulary: list[str]) -> DataFrame:
    """(label, prior): ln of positive over negative record counts; null if one is empty."""
    return positives(labels, vocabulary).select(
        "label", F.log(F.try_divide(F.col("pos").cast("double"), F.col("neg").cast("double"))).alias("prior")
    )


def bayes_proba(tf: DataFrame, ids: DataFrame, model: DataFrame, priors: DataFrame,
                vocabulary: list[str]) -> DataFrame:
    """(id, label, p) for every id and every label with a prior. Unknown terms are ignored.

    A term of a text meets the model in one join row; the scores of a text are one sum per
    label, added up before the shuffle.
    """
    known = {r["label"]: r["prior"] for r in priors.filter("prior is not null").collect()}  # a row per label
    odds = [F.sum(F.col("tf") * (F.get("log_pos", i) - F.get("log_neg", i))).alias(f"s{i}")
            for i, v in enumerate(vocabulary) if v in known]
    scores = tf.join(model, "term").groupBy("id").agg(*odds)
    cells = [F.struct(F.lit(v).alias("label"),
                      sigmoid(F.coalesce(f"s{i}", F.lit(0.0)) + F.lit(known[v])).alias("p"))
             for i, v in enumerate(vocabulary) if v in known]
    return ids.select("id").join(scores, "id", "left").select("id", F.inline(F.array(*cells)))


def bayes_out_of_fold(df: DataFrame, vocabulary: list[str], k: int = 5, seed: int = SEED) -> DataFrame:
    """(id, label, p, fold): naive Bayes of every record (id, description, labels) on the folds that it is not in.

    The counts of a text carry its fold and labels, so they are never joined with the records: they are added up once per
    fold, label set and term, and a model reads the sums of the other folds. Each count is scored once, by its fold's model.
    """
    from tagloom.operators import features, split

    if k < 2:
        raise ValueError("at least two folds")
    folds = written(split.stratified_kfold(df.select("id", "labels"), k, seed), "folds")
    placed = df.select("id", "description").join(folds, "id").select(F.struct("id", "fold", "labels").alias("id"), "description")
    tf = written(features.count_vectorize(placed).select("id.*", "term", "tf"), "counts")
    sums = written(tf.groupBy("fold", "labels", "term").agg(F.sum("tf").alias("tf")), "fold-counts")
    parts = []
    for i in range(k):
        train, test = folds.where(F.col("fold") != i), folds.where(F.col("fold") == i)
        model = bayes_fit(sums.where(F.col("fold") != i), vocabulary)
        p = bayes_proba(tf.where(F.col("fold") == i).select("id", "term", "tf"), test, model, bayes_priors(train, vocabulary), vocabulary)
        parts.append(p.withColumn("fold", F.lit(i)))
    return reduce(DataFrame.unionByName, parts)
